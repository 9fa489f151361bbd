"""Centroid clustering (Lloyd rounds on integer vectors) with Ptolemaic pivot bounds.

A few starting centroids stay on as pivots. Every vector's distances to the pivots are taken once
and written beside it. For points x, c and pivots p, s Ptolemy's inequality gives
``d(x,c) * d(p,s) >= |d(x,p) * d(c,s) - d(x,s) * d(c,p)|``, so each pair of pivots bounds the distance
of a vector to a centroid from below without looking at the vector. The centroid with the least
bound is measured first; another one is measured, exactly, only if its bound is not above the best
distance so far. Bounds are taken in doubles and lowered by more than all rounding errors together
(``SAFE``), and only a strictly greater bound rules a centroid out, so ties still go to the smaller number.

Each round reads the written table once. Tasks hand over one sum a cluster and component; what reaches
the driver is the centroids (clusters x width numbers), however many vectors there are, and no
step sees a cluster as one group.

Defined results: a vector that is null, has another width, or holds a null or non-finite component takes no
part. A component beyond the range of long counts as the end of that range (the floor saturates);
distances and sums are exact and come as the largest long where they are beyond it. Repeated rows are vectors of
their own; of rows that share a vec_id only the least vector can start a centroid; rows without a
vec_id come last as starts. With fewer ids than clusters there are as many clusters as ids; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, read_table, saved, small_batches

WIDTH = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
PIVOTS = 8
SAFE = 2.0**-40  # far above the error of the dozen operations of a bound, about 2**-49
LONGEST = 2**63 - 1
EXACT = "decimal(38,0)"


def whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinite), F.lit(False)))
    return vector.isNotNull() & finite


def floors(vector: Column, scale: int) -> Column:
    """Components as integers ``floor(scale * x)``, with x as a double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def rows_of(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def fits(width: int, *tables: np.ndarray) -> bool:
    """Whether squared distances between rows of these tables are longs."""
    most = int((2**61 / width) ** 0.5)
    return all(t.max(initial=0) < most and t.min(initial=0) > -most for t in tables)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to rows (or to one): longs, or Python numbers if need be."""
    if fits(x.shape[1], x, c):
        d = x - c
        return np.einsum("ij,ij->i", d, d)
    d = x.astype(object) - c.astype(object)
    return (d * d).sum(axis=1)


def longs(values: np.ndarray) -> pa.Array:
    """Exact numbers as longs, at most the largest one."""
    if values.dtype == object:
        values = [min(int(v), LONGEST) for v in values]
    return pa.array(values, pa.int64())


class Bounds:
    """Lower bounds of distances to centroids, from distances to fixed pivots."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        between = np.array([self.distances(p[None]) for p in pivots]).reshape(len(pivots), len(pivots))
        self.pairs = [
            (p, s, between[p, s]) for p, s in itertools.combinations(range(len(pivots)), 2) if between[p, s] > 0]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Distances of rows to all pivots (rows x pivots)."""
        return np.stack([np.sqrt(squared(x, p[None]).astype(float)) for p in self.pivots], axis=1)

    def below(self, to_pivots: np.ndarray, centroid_to_pivots: np.ndarray) -> np.ndarray:
        """Squares that no squared distance (rows x centroids) is below."""
        least = np.zeros((len(to_pivots), len(centroid_to_pivots)))
        for p, s, apart in self.pairs:
            one = to_pivots[:, p, None] * centroid_to_pivots[None, :, s]
            two = to_pivots[:, s, None] * centroid_to_pivots[None, :, p]
            np.maximum(least, (np.abs(one - two) - SAFE * (one + two)) / apart, out=least)
        return least * least * (1 - SAFE)

    def nearest(self, x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray):
        """(number, exact squared distance, centroids measured) of the nearest centroid of each row."""
        bounds = self.below(to_pivots, self.distances(centroids))
        number = bounds.argmin(axis=1)
        distance = squared(x, centroids[number])
        measured, first = len(x), number.copy()
        for k in range(len(centroids)):
            left = np.flatnonzero(
                (first != k) & (bounds[:, k] <= distance.astype(float) * (1 + SAFE)))
            measured += len(left)
            if not len(left):
                continue
            d = squared(x[left], centroids[k][None])
            if d.dtype != distance.dtype:
                distance = distance.astype(object)
            better = (d < distance[left]) | ((d == distance[left]) & (k < number[left]))
            distance[left[better]], number[left[better]] = d[better], k
        return number, distance, measured


def first_by_id(vectors: DataFrame, order: Column, count: int) -> np.ndarray:
    """Vectors of the first ``count`` ids in an order (no id: last); of rows with one id the least vector."""
    ids = [r.vec_id for r in vectors.select("vec_id").distinct()
           .orderBy(order.asc_nulls_last(), "vec_id").limit(count).collect()]
    if not ids:
        return np.zeros((0, 0), np.int64)
    chosen = F.col("vec_id").isin([i for i in ids if i is not None])
    if None in ids:
        chosen = F.coalesce(chosen, F.lit(False)) | F.col("vec_id").isNull()
    found = {r.vec_id: r.x for r in vectors.where(chosen).groupBy("vec_id").agg(F.min("x").alias("x")).collect()}
    return np.array([found[i] for i in ids], np.int64)


def with_pivots(vectors: DataFrame, bounds: Bounds, width: int) -> DataFrame:
    """(vec_id, x, to_pivots): the table that every round reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            far = bounds.distances(rows_of(batch.column(1), width))
            offsets = pa.array(np.arange(len(far) + 1) * far.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "x", "to_pivots"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return saved(
        vectors.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, x array<long>, to_pivots array<double>"),
        "pivot-distances")


def cluster_sums(table: DataFrame, bounds: Bounds, centroids: np.ndarray) -> DataFrame:
    """(cluster, at, total, n, measured): component sums of the vectors nearest to each centroid."""
    clusters, width = centroids.shape
    names = ["cluster", "at", "total", "n", "measured"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, measured = np.zeros((clusters, width), object), [0] * clusters, 0
        for batch in small_batches(batches):
            x = rows_of(batch.column(0), width)
            number, _, looked = bounds.nearest(x, rows_of(batch.column(1), len(bounds.pivots)), centroids)
            measured += looked
            for k in range(clusters):
                own = x[number == k]
                if len(own):
                    total[k] += (own if fits(width, own) else own.astype(object)).sum(axis=0).astype(object)
                    count[k] += len(own)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(clusters), width), pa.int32()),
            pa.array(np.tile(np.arange(width), clusters), pa.int32()),
            pa.array([int(v) for v in total.ravel()], pa.decimal128(38, 0)),
            pa.array(np.repeat(count, width), pa.int64()),
            pa.array([measured] + [0] * (clusters * width - 1), pa.int64()),
        ], names)

    parts = table.select("x", "to_pivots").mapInArrow(
        run, f"cluster int, at int, total {EXACT}, n long, measured long")
    return parts.groupBy("cluster", "at").agg(
        F.sum("total").cast(EXACT).alias("total"), F.sum("n").alias("n"), F.sum("measured").alias("measured"))


def moved(centroids: np.ndarray, sums: list) -> np.ndarray:
    """Centroids at the floors of the means of their vectors; empty ones stay."""
    out = centroids.copy()
    for r in sums:
        if r.n:
            out[r.cluster, r.at] = int(r.total) // r.n
    return out


def assigned(table: DataFrame, bounds: Bounds, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance): the exact squared distance to the nearest centroid."""
    width = centroids.shape[1]
    kind = table.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            x = rows_of(batch.column(1), width)
            number, far, _ = bounds.nearest(x, rows_of(batch.column(2), len(bounds.pivots)), centroids)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(number, pa.int32()), longs(far)], ["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance, cluster_inertia, inertia), final centroids)."""
    vector = F.col(f"`{vector_col}`")
    vectors = saved(
        df.where(F.when(vector.isNull(), False).otherwise(F.size(vector) == width)).where(whole(vector))
        .select(F.col(f"`{id_col}`").alias("vec_id"), floors(vector, scale).alias("x")),
        "integer-vectors")
    # the smallest SHA-256 of ``seed:id``
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    centroids = first_by_id(vectors, digest, clusters)
    if not len(centroids):
        return vectors.select(
            "vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in (
                "distance", "cluster_inertia", "inertia"))), centroids
    bounds = Bounds(centroids[:pivots].copy())
    table = with_pivots(vectors, bounds, width)
    dropped(vectors)
    for _ in range(rounds):
        centroids = moved(centroids, cluster_sums(table, bounds, centroids).collect())
    placed = saved(assigned(table, bounds, centroids), "assigned")
    dropped(table)
    exact = F.sum(F.col("distance").cast("decimal(19,0)"))
    sums = placed.groupBy("cluster").agg(exact.alias("own")).collect()  # a row a cluster
    total = sum(int(r.own) for r in sums)
    table_of = df.sparkSession.createDataFrame(
        [(r.cluster, min(int(r.own), LONGEST), min(total, LONGEST)) for r in sums],
        "cluster int, cluster_inertia long, inertia long")
    rows = placed.join(F.broadcast(table_of), "cluster")
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia"), centroids


def op11_ptolemaic(spark, sf_dir: str) -> DataFrame:
    rows, centroids = cluster(read_table(spark, sf_dir, "embeddings"))
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    names = F.array(*map(F.lit, digests)) if digests else F.array().cast("array<string>")
    return rows.withColumn("centroid_sha256", F.get(names, "cluster"))


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED) -> str:
    """The same in SQL: one common table for each assignment and each set of centroids."""
    tables = [f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::HUGEINT) AS x FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: isfinite(x))) = {width})""",
              f"""c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1)::INT AS k, x
  FROM v ORDER BY k LIMIT {clusters})"""]
    for r in range(rounds + 1):
        tables.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(v.x) AS x, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT vec_id, v.x, k, list_sum(list_transform(range(1, {width + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS d
    FROM v, c{r} c) v GROUP BY vec_id)""")
        if r < rounds:
            tables.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT k, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT k, list(m ORDER BY i) AS x FROM (
      SELECT k, i, (sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS m FROM (
        SELECT k, unnest(x) AS e, unnest(range(1, {width + 1})) AS i FROM a{r}) GROUP BY k, i) GROUP BY k) m USING (k))""")
    return "WITH " + ",\n".join(tables) + f"""
SELECT vec_id, k AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c.x, lambda e: e::VARCHAR), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (k)"""


ORACLE = oracle()
