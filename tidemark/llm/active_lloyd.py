"""Vector code compression: a codebook for each part of the vector, by Lloyd rounds over active entries.

Vectors are cut into equal consecutive parts; every part position has its own entries, and a vector is
coded by the number of the nearest entry of each part. The first assignment compares a part with all
entries and stores the number and the exact distance. After an update only the entries that moved are
active: a part whose own entry stayed fixed compares the moved entries alone against its stored
distance (all others stand where they were, and lost then), a part whose entry moved rescans completely.
Ties go to the lower index, also where a moved entry meets the stored distance.

The state (integers, codes, distances) is a written table that each round reads and writes once. Tasks
hand over one sum an entry and component; the driver holds the codebooks, whose size does not depend on
the number of vectors.

Defined results: a vector that is null, or holds a null or non-finite component, takes no part; nor does
one that cannot be cut like the others: vectors have the commonest length that is a multiple of the number
of parts (of equally common ones the greatest). A component beyond the range of long counts as its end
(the floor saturates); distances are compared exactly, and they and their sums come as the largest long
where they are beyond it. Repeated rows are coded each; of rows that share a vec_id only the least vector
can start an entry; rows without a vec_id come last as starts. With fewer ids than entries there are as
many entries as ids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, join_by_share, read_table, saved, small_batches
from tidemark.llm.ptolemaic import EXACT, LONGEST, first_by_id, fits, floors, longs, rows_of, whole

PARTS = 16
ENTRIES = 64
SCALE = 256
ROUNDS = 2


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows x entries): longs, or Python numbers if need be."""
    if not fits(x.shape[1], x, entries):
        x, entries = x.astype(object), entries.astype(object)
    out = 0
    for at in range(x.shape[1]):
        d = x[:, at, None] - entries[None, :, at]
        out = out + d * d
    return out


def first_scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, distance) of the nearest entry, the first one of equals."""
    d = distances(x, entries)
    number = d.argmin(axis=1)
    return number, np.minimum(d[np.arange(len(x)), number], LONGEST).astype(np.int64)


def next_scan(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, number: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, distance, distances taken) after some entries moved, from the last numbers and distances."""
    number, distance = number.copy(), distance.copy()
    # a stored distance that was beyond a long is no measure
    again = moved[number] | (distance == LONGEST)
    active = np.flatnonzero(moved)
    taken = int(again.sum()) * len(entries) + int((~again).sum()) * len(active)
    if len(active) and not again.all():
        fixed = np.flatnonzero(~again)
        d = distances(x[fixed], entries[active])
        best = d.argmin(axis=1)
        least, entry = d[np.arange(len(fixed)), best], active[best]
        won = (least < distance[fixed]) | ((least == distance[fixed]) & (entry < number[fixed]))
        number[fixed[won]], distance[fixed[won]] = entry[won], least[won]
    if again.any():
        number[again], distance[again] = first_scan(x[again], entries)
    return number, distance, taken


def assigned(table: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """(vec_id, label, x, code, far): the table with the codes of these books.

    ``books`` is (parts, entries, part width). With ``moved`` (parts, entries), the table has the codes
    and distances of the books before.
    """
    parts, _, size = books.shape
    names = ["vec_id", "label", "x", "code", "far"]
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n = batch.num_rows
            x = rows_of(batch.column(2), parts * size).reshape(n, parts, size)
            code, far = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
            if moved is not None:
                old = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, parts)
                last = rows_of(batch.column(4), parts)
            for p in range(parts):
                own = np.ascontiguousarray(x[:, p])
                if moved is None:
                    code[:, p], far[:, p] = first_scan(own, books[p])
                else:
                    code[:, p], far[:, p], _ = next_scan(own, books[p], moved[p], old[:, p], last[:, p])
            offsets = pa.array(np.arange(n + 1) * parts, pa.int32())
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array([c.tobytes() for c in code], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))], names)

    return table.mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, x array<long>, code binary, far array<long>")


def entry_sums(table: DataFrame, books: np.ndarray) -> list:
    """(part, entry, at, total, n) of the parts assigned to each entry: as many rows as the books have."""
    parts, entries, size = books.shape
    names = ["part", "entry", "at", "total", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(books.shape, object), np.zeros((parts, entries), np.int64)
        for batch in small_batches(batches):
            n = batch.num_rows
            x = rows_of(batch.column(0), parts * size).reshape(n, parts, size)
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, parts)
            kind = np.int64 if fits(size, x) else object
            for p in range(parts):
                sums = np.zeros((entries, size), kind)
                np.add.at(sums, code[:, p], x[:, p].astype(kind))
                total[p] += sums.astype(object)
                count[p] += np.bincount(code[:, p], minlength=entries)
        part, entry, at = (i.ravel() for i in np.indices(books.shape))
        used = count[part, entry] > 0
        yield pa.RecordBatch.from_arrays([
            pa.array(part[used], pa.int32()), pa.array(entry[used], pa.int32()), pa.array(at[used], pa.int32()),
            pa.array([int(v) for v in total.ravel()[used]], pa.decimal128(38, 0)),
            pa.array(count[part, entry][used], pa.int64())], names)

    found = table.select("x", "code").mapInArrow(run, f"part int, entry int, at int, total {EXACT}, n long")
    return found.groupBy("part", "entry", "at").agg(
        F.sum("total").cast(EXACT).alias("total"), F.sum("n").alias("n")).collect()


def common_width(lengths: DataFrame, parts: int) -> int:
    """The commonest length (column ``length``) that parts can be cut from; 0 if there is none."""
    fit = lengths.where((F.col("length") > 0) & (F.col("length") % parts == 0))
    most = fit.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    return most.length if most else 0


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error), books); a code has one byte for each part."""
    if not 0 < entries <= 256:
        raise ValueError("an entry number is one byte")
    vector = F.col(f"`{vector_col}`")
    good = df.where(whole(vector))
    width = common_width(good.select(F.size(vector).alias("length")), parts)
    state = saved(
        good.where(F.size(vector) == (width or -1)).select(
            F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
            floors(vector, scale).alias("x")),
        "integer-parts")
    first = first_by_id(state, F.col("vec_id"), entries) if width else np.zeros((0, 0), np.int64)
    if not len(first):
        return state.select(
            "vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((0, 0, 0))
    books = np.ascontiguousarray(first.reshape(len(first), parts, width // parts).transpose(1, 0, 2))
    moved = None
    for _ in range(rounds):
        placed = saved(assigned(state, books, moved), "coded")
        dropped(state)
        state, new = placed, books.copy()
        for r in entry_sums(state, books):
            new[r.part, r.entry, r.at] = int(r.total) // r.n
        books, moved = new, (new != books).any(axis=2)
    placed = saved(assigned(state, books, moved).select("vec_id", "label", "code", error_of("far").alias("error")), "codes")
    dropped(state)
    return placed, books


def error_of(far: str) -> Column:
    """The sum of the distances of the parts, at most the largest long."""
    total = F.aggregate(far, F.lit(0).cast(EXACT), lambda s, d: (s + d.cast("decimal(19,0)")).cast(EXACT))
    return F.least(total, F.lit(LONGEST).cast(EXACT)).cast("long")


def op12_active_lloyd(spark, sf_dir: str) -> DataFrame:
    coded, books = compress(read_table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.astype(np.int64).ravel().tolist())).encode()).hexdigest()
    exact = F.sum(F.col("error").cast("decimal(19,0)"))
    sums = saved(coded.groupBy("label").agg(
        F.count(F.lit(1)).alias("held"),
        F.least(exact, F.lit(LONGEST).cast(EXACT)).cast("long").alias("label_error")), "label-errors")
    rows = join_by_share(coded, sums, "label", "held")
    return rows.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL, with complete scans."""
    tables = [f"""v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x, len(embedding) // {parts} AS w
  FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), p AS MATERIALIZED (
  SELECT vec_id, label, part, x[part * w + 1 : part * w + w] AS x FROM v, range({parts}) r(part)
), c0 AS MATERIALIZED (
  SELECT part, (row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1)::INT AS k, x FROM p
  QUALIFY k < {entries})"""]
    for r in range(rounds + 1):
        tables.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, part, any_value(x) AS x, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT vec_id, label, part, p.x, k,
           list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) AS d
    FROM p JOIN c{r} c USING (part)) GROUP BY vec_id, part)""")
        if r < rounds:
            tables.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT part, k, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT part, k, list(m ORDER BY i) AS x FROM (
      SELECT part, k, i, (sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS m FROM (
        SELECT part, k, unnest(x) AS e, unnest(range(1, len(x) + 1)) AS i FROM a{r})
      GROUP BY part, k, i) GROUP BY part, k) m USING (part, k))""")
    return "WITH " + ",\n".join(tables) + f""", e AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', k), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: y::VARCHAR), ','), ',' ORDER BY part, k))
        FROM c{rounds}) AS codebooks_sha256
FROM e"""


ORACLE = oracle()
