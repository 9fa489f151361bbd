"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Equal vectors are one node, named by their smallest id. The graph starts from the leaves of a few
random-projection trees (fitted on a bounded sample, ``TREE_SAMPLE`` vectors; a leaf of many
vectors is cut by hash into blocks of about ``LEAF``), inside which all distances are taken. Then
neighbours of neighbours are joined: every node gathers its neighbours and ``REVERSE`` of the
nodes that name it, takes the distances between them, and proposes to each those that are
nearer than its worst neighbour; the nearest ``DEGREE`` stay. Pairs that met before do not meet
again. Rounds end when fewer than ``SETTLED`` of all edges change.

A query starts at the nearest of ``ENTRIES`` seeded nodes and, if it is a node itself, there. Each step opens
its ``OPEN`` nearest unopened nodes among the best ``POOL`` and adds their neighbours in the graph
(both directions), until all of the best have been opened. All distances, those of the graph too, are
Euclidean, in double precision, on the original vectors, whatever their scale and however near they are.

Defined results: vectors that are null, zero, or hold null or non-finite components take no
part, nor do those whose length is not the most frequent one; rows without an id are left out;
repeated rows are one candidate; an empty table gives no rows; a query has fewer than ``k`` rows
only if there are fewer candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, read_table, saved

DEGREE = 28
REVERSE = 16
TREES = 10
LEAF = 400
TREE_SAMPLE = 16_384
SETTLED = 0.02
CANCELS = 1e-6
MOST_ROUNDS = 12
ENTRIES = 1024
POOL = 200
OPEN = 25
SEED = 4


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part; single-precision vectors stay such."""
    kind = df.schema[vec_col].dataType.simpleString()
    vec = F.col(vec_col) if kind == "array<float>" else F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))
                      & F.exists("vec", lambda x: x != 0))
    length = (
        rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    )
    return rows.where(F.size("vec") == (length["n"] if length else 0))


def trees_of(sample: np.ndarray, leaves: int) -> list[list]:
    """Random-projection trees: nested (direction, cut, left, right), or the number of a leaf."""
    rng = np.random.default_rng(SEED)
    depth = int(np.ceil(np.log2(max(1, min(leaves, len(sample) / 16)))))

    def grow(rows: np.ndarray, level: int, counter: list[int]):
        if level == 0 or len(rows) < 4:
            counter[0] += 1
            return counter[0]
        direction = rng.standard_normal(sample.shape[1]).astype(np.float32)
        at = sample[rows] @ direction
        cut = float(np.median(at))
        return (direction, cut, grow(rows[at <= cut], level - 1, counter),
                grow(rows[at > cut], level - 1, counter))

    return [grow(np.arange(len(sample)), depth, [0]) for _ in range(TREES)]


def leaf_of(tree, vectors: np.ndarray) -> np.ndarray:
    out = np.zeros(len(vectors), np.int64)

    def walk(node, rows: np.ndarray) -> None:
        if isinstance(node, int):
            out[rows] = node
        elif len(rows):
            low = vectors[rows] @ node[0] <= node[1]
            walk(node[2], rows[low])
            walk(node[3], rows[~low])

    walk(tree, np.arange(len(vectors)))
    return out


def matrix(column, kind: str) -> np.ndarray:
    """Vectors, as bytes of components of a kind, to a matrix in double precision."""
    rows = column.tolist() if isinstance(column, pd.Series) else column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(float)


def distances(x: np.ndarray) -> np.ndarray:
    """Norm expansion around one of the vectors; where it cancels (CANCELS), the differences themselves."""
    with np.errstate(over="ignore", invalid="ignore"):
        y = x - x[len(x) // 2]
        squares = (y * y).sum(axis=1)
        both = squares[:, None] + squares[None, :]
        d = both - 2 * (y @ y.T)
        rows, columns = np.nonzero(~(d >= CANCELS * both))  # overflow as well
        for start in range(0, len(rows), 1 << 15):
            i, j = rows[start:start + (1 << 15)], columns[start:start + (1 << 15)]
            d[i, j] = ((x[i] - x[j]) ** 2).sum(axis=1)
    return np.sqrt(d)


def compact(nodes: DataFrame) -> tuple[DataFrame, str]:
    """(node, packed) with vectors as bytes, and the kind of their components."""
    kind = "float32" if nodes.schema["vec"].dataType.simpleString() == "array<float>" else "float64"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(v, kind).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["node", "packed"])

    return nodes.select("node", "vec").mapInArrow(run, "node long, packed binary"), kind


def first_graph(vectors: DataFrame, kind: str, n: int) -> DataFrame:
    """Edges (u, v, d) from the leaves of the trees."""
    sample = vectors.orderBy(F.xxhash64(F.lit(SEED), "node")).limit(TREE_SAMPLE).select("packed").toArrow()
    trees = trees_of(matrix(sample["packed"], kind), max(1, n // LEAF))
    shared = vectors.sparkSession.sparkContext.broadcast(trees)  # TREES * TREE_SAMPLE / 16 directions at most

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), kind)
            for number, tree in enumerate(shared.value):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(np.full(len(x), number, np.int32)),
                    pa.array(leaf_of(tree, x))], ["node", "tree", "leaf"])

    placed = saved(vectors.mapInArrow(assign, "node long, tree int, leaf long"), "leaves")
    sizes = placed.groupBy("tree", "leaf").agg(
        F.ceil(F.count(F.lit(1)) / (2 * LEAF)).alias("blocks"))
    blocks = placed.join(sizes, ["tree", "leaf"]).withColumn(
        "block", F.pmod(F.xxhash64("node", "tree"), "blocks")).join(vectors, "node")

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        ids, d = group["node"].to_numpy(), distances(matrix(group["packed"], kind))
        np.fill_diagonal(d, np.nan)  # after infinity
        k = min(DEGREE, len(ids) - 1)
        if k < 1:
            return pd.DataFrame({"u": [], "v": [], "d": []})
        at = np.argpartition(d, k - 1, axis=1)[:, :k]
        return pd.DataFrame({"u": np.repeat(ids, k), "v": ids[at].ravel(),
                             "d": np.take_along_axis(d, at, axis=1).ravel()})

    edges = blocks.groupBy("tree", "leaf", "block").applyInPandas(meet, "u long, v long, d double")
    return saved(nearest(edges.withColumn("old", F.lit(0))), "graph")


def nearest(edges: DataFrame) -> DataFrame:
    """The DEGREE nearest of each node; an edge known before stays old. One shuffle, by node."""
    by = Window.partitionBy("u").orderBy("d", "v")
    return (
        edges.repartition("u").groupBy("u", "v").agg(F.min("d").alias("d"), F.max("old").alias("old"))
        .withColumn("n", F.row_number().over(by)).where(F.col("n") <= DEGREE).drop("n")
    )


def proposer(kind: str):
    """Edges between the members of each node's neighbourhood that improve on their worst."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = np.cumsum(lists.value_lengths().to_numpy())
            flat = lists.flatten()
            ids, old, worst = (flat.field(k).to_numpy() for k in range(3))
            vectors = matrix(flat.field(3), kind) if len(ids) else None
            u, v, near, start = [], [], [], 0
            for end in ends:
                own, at = np.unique(ids[start:end], return_index=True)
                at += start
                d = distances(vectors[at])
                known = old[at] == 1
                d[np.ix_(known, known)] = np.inf  # met in an earlier round
                np.fill_diagonal(d, np.inf)
                x, y = np.nonzero(d < worst[at][:, None])
                u.append(own[x])
                v.append(own[y])
                near.append(d[x, y])
                start = end
            empty = [np.zeros(0)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(u or empty), pa.int64()), pa.array(np.concatenate(v or empty), pa.int64()),
                pa.array(np.concatenate(near or empty), pa.float64())], ["u", "v", "d"])

    return propose


def descend(vectors: DataFrame, kind: str, graph: DataFrame, n: int) -> DataFrame:
    """Rounds of joining neighbours of neighbours."""
    for number in range(MOST_ROUNDS):
        # a node without DEGREE neighbours takes any
        worst = graph.groupBy("u").agg(
            F.when(F.count(F.lit(1)) < DEGREE, F.lit(float("inf"))).otherwise(F.max("d"))
            .alias("worst"))
        sampled = Window.partitionBy("center").orderBy("old", F.xxhash64(F.lit(number), "member"))
        back = (
            graph.select(F.col("v").alias("center"), F.col("u").alias("member"), "old")
            .withColumn("n", F.row_number().over(sampled)).where(F.col("n") <= REVERSE).drop("n")
        )
        met = graph.select(F.col("u").alias("center"), F.col("v").alias("member"), "old").union(back)
        met = saved(met, "met")
        fresh = met.groupBy("center").agg(F.min("old").alias("o")).where("o = 0").select("center")
        members = (
            met.join(fresh, "center", "left_semi")
            .join(worst.withColumnRenamed("u", "member"), "member")
            .join(vectors.withColumnRenamed("node", "member"), "member")
        )
        gathered = members.groupBy("center").agg(  # DEGREE + REVERSE members at most
            F.collect_list(F.struct("member", "old", "worst", "packed")).alias("members"))
        proposed = gathered.select("members").mapInArrow(proposer(kind), "u long, v long, d double")
        edges = graph.select("u", "v", "d", F.lit(1).alias("old")).union(
            proposed.select("u", "v", "d", F.lit(0)))
        moved = saved(nearest(edges), "graph")
        dropped(met)
        dropped(graph)
        graph = moved
        if graph.where("old = 0").count() < SETTLED * DEGREE * n:
            break
    return graph


def euclid(a: str, b: str) -> Column:
    """Distance in double precision."""

    def square(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    squares = F.zip_with(a, b, square)
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def entry_nodes(queries: DataFrame, nodes: DataFrame) -> DataFrame:
    """(query_id, node, d): the OPEN nearest of ENTRIES seeded nodes, which go to every task."""
    some = nodes.orderBy(F.xxhash64(F.lit(SEED + 1), "node")).limit(ENTRIES).collect()
    shared = queries.sparkSession.sparkContext.broadcast(
        (np.array([r["node"] for r in some], np.int64), np.array([r["vec"] for r in some], float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shared.value
        for batch in batches:
            for query, vec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                d = np.sqrt(((vectors - np.array(vec, float)) ** 2).sum(axis=1))
                at = np.lexsort((ids, d))[:OPEN]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), query, np.int64)), pa.array(ids[at]), pa.array(d[at])],
                    ["query_id", "node", "d"])

    return queries.select("query_id", "qvec").mapInArrow(run, "query_id long, node long, d double")


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """The POOL nearest nodes found for each query (query_id, qvec, own: its node or null)."""
    links = graph.select("u", "v").union(
        graph.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    # hubs keep the links that name them in seeded order; forward links are always kept
    forward = graph.select("u", "v", F.lit(0).alias("back"))
    links = (
        links.join(forward, ["u", "v"], "left").fillna(1, ["back"])
        .withColumn("n", F.row_number().over(
            Window.partitionBy("u").orderBy("back", F.xxhash64(F.lit(SEED), "v"))))
        .where(F.col("n") <= DEGREE + REVERSE).select("u", "v")
    )
    links = saved(links, "links")
    best = Window.partitionBy("query_id").orderBy("d", "node")

    def pooled(rows: DataFrame) -> DataFrame:
        return rows.withColumn("n", F.row_number().over(best)).where(F.col("n") <= POOL)

    first = entry_nodes(queries, nodes)
    own = queries.where("own IS NOT NULL").select("query_id", F.col("own").alias("node"), F.lit(0.0).alias("d"))
    pool = first.union(own).distinct().withColumn("opened", F.lit(0))
    pool = saved(pooled(pool).drop("n"), "pool")
    nearest_open = Window.partitionBy("query_id", "opened").orderBy("d", "node")
    while True:
        ranked = pool.withColumn("n", F.row_number().over(nearest_open))
        now = (F.col("opened") == 0) & (F.col("n") <= OPEN)
        frontier = ranked.where(now).select("query_id", F.col("node").alias("u"))
        found = (
            frontier.join(links, "u").select("query_id", F.col("v").alias("node")).distinct()
            .join(pool.select("query_id", "node"), ["query_id", "node"], "left_anti")
            .join(nodes, "node").join(queries.select("query_id", "qvec"), "query_id")
            .select("query_id", "node", euclid("qvec", "vec").alias("d"), F.lit(0).alias("opened"))
        )
        known = ranked.select("query_id", "node", "d", F.when(now, 1).otherwise(F.col("opened")).alias("opened"))
        grown = saved(pooled(known.union(found)).drop("n"), "pool")
        dropped(pool)
        pool = grown
        if pool.where("opened = 0").isEmpty():
            return pool.select("query_id", "node", "d")


def nearest_neighbours(
    queries: DataFrame, index: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` nearest rows found but its own.

    Ties go to the smaller id. ``k`` is at most POOL - 1.
    """
    if not 0 < k < POOL:
        raise ValueError(f"k must lie between 1 and {POOL - 1}")
    rows = valid_vectors(index, id_col, vec_col)
    keyed = saved(
        rows.withColumn("a", F.xxhash64("vec")).withColumn("b", F.xxhash64(F.lit(1), "vec")), "vectors")
    by = Window.partitionBy("a", "b").orderBy("vec_id")
    members = saved(  # of equal vectors only the k + 1 smallest ids can be results
        keyed.select("a", "b", "vec_id").distinct().withColumn("n", F.row_number().over(by))
        .where(F.col("n") <= k + 1), "members")
    heads = members.where("n = 1").select("a", "b", F.col("vec_id").alias("node"))
    nodes = saved(
        keyed.join(heads, (keyed["a"] == heads["a"]) & (keyed["b"] == heads["b"])
                   & (keyed["vec_id"] == heads["node"])).select("node", "vec").dropDuplicates(["node"]),
        "nodes")
    n = nodes.count()
    if not n:
        return index.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double")
    packed, kind = compact(nodes)
    vectors = saved(packed, "packed")
    graph = descend(vectors, kind, first_graph(vectors, kind, n), n)
    asked = valid_vectors(queries, id_col, vec_col).select(
        F.col("vec_id").alias("query_id"), F.col("vec").alias("qvec"),
        F.xxhash64("vec").alias("a"), F.xxhash64(F.lit(1), "vec").alias("b")).dropDuplicates(["query_id"])
    asked = saved(asked.join(heads, ["a", "b"], "left").select(
        "query_id", "qvec", F.col("node").alias("own")), "queries")
    found = search(asked, nodes, graph)
    ids = members.join(heads, ["a", "b"]).select("node", "vec_id")
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.join(ids, "node").where("vec_id <> query_id")
        .groupBy("query_id", "vec_id").agg(F.min("d").alias("score"))
        .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_nn_descent(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return nearest_neighbours(rows.where(F.col("vec_id") % 100 == 0), rows)
