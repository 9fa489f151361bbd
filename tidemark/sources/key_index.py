"""Which parts of a keyed table can hold a key, without a look into them.

With every part that is written, its range of the first key column goes into the commit log and a blocked
Bloom filter of its keys beside the data: ``<table>/_keys/version=<id>/part=<p>``, rows of (block, bits).
A key belongs to one block, in which ``PROBES`` bits are set; blocks have as many bits as Spark's bitmap
aggregate holds (4 KB) and a part as many blocks as its rows need at ``BITS_PER_KEY``, so
about one key in 300 that is not there looks as if it were. Keys with a NULL are in no filter: they match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_keys"
BLOCK_BITS = 32768
BITS_PER_KEY = 12
PROBES = 6


def blocks_for(rows: int) -> int:
    return max(1, -(-rows * BITS_PER_KEY // BLOCK_BITS))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def whole_key(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def _block(h: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(h, F.lit("block")), blocks)


def _bit(h: Column, probe: int) -> Column:
    return F.pmod(F.xxhash64(h, F.lit(probe)), F.lit(BLOCK_BITS))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1


def ranges(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(part, n, low, high) of stored rows with a column ``part``: their number and range of keys."""
    first = F.when(whole_key(keys), F.col(keys[0]).cast("string"))
    return rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min(first).alias("low"), F.max(first).alias("high"))


def filters_of(rows: DataFrame, keys: Sequence[str], blocks: dict[str, int]) -> DataFrame:
    """(part, block, bits) of stored rows with a column ``part``; ``blocks`` says how many each part gets.

    Hashes are brought to their block before any bits are set: a bitmap of 4 KB that stood for the few keys a task
    has of a block would be many times their size. Rows are sorted once, not once a probe.
    """
    numbered = [(part, i, n) for i, (part, n) in enumerate(blocks.items())]
    sizes = F.broadcast(rows.sparkSession.createDataFrame(numbered, "part string, _part int, blocks int"))  # a row a part
    hashed = rows.where(whole_key(keys)).select("part", key_hash(keys).alias("h"))
    placed = hashed.join(sizes, "part").select(
        "_part", _block(F.col("h"), F.col("blocks")).alias("block"), "h").repartition("_part", "block")
    probes = [F.bitmap_construct_agg(_bit(F.col("h"), i)).alias(f"bits_{i}") for i in range(PROBES)]
    return (
        placed.groupBy("_part", "block").agg(*probes)
        .select("_part", "block", F.explode(F.array(*[f"bits_{i}" for i in range(PROBES)])).alias("bits"))
        .groupBy("_part", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        .join(sizes.select("part", "_part"), "_part").select("part", "block", "bits")
    )


def write_filters(rows: DataFrame, keys: Sequence[str], blocks: dict[str, int], path: str) -> None:
    filters_of(rows, keys, blocks).write.mode("overwrite").partitionBy("part").parquet(path)


def parts_that_may_hold(
    spark: SparkSession, root: str, entries: Sequence, batch_keys: DataFrame, keys: Sequence[str]
) -> set[str]:
    """The parts of ``entries`` (committed parts of a keyed table) that may hold a key of the batch.

    The hash part of the name leaves one part a day for a key, the range and then the filter leave
    hardly any but those that hold it. A part that was written without a filter is left to the first test.
    """
    rows = []
    for e in entries:
        number, _, count = e.part.split("-")[1].partition("of")
        rows.append((e.part, int(number), int(count), e.key_low, e.key_high, e.key_blocks, e.version))
    if not rows:
        return set()
    parts = spark.createDataFrame(  # a row a part
        rows, "part string, number int, buckets int, low string, high string, blocks int, version string")
    counts = sorted({r[2] for r in rows})
    first = F.col(keys[0]).cast("string")
    hashed = batch_keys.where(whole_key(keys)).select(first.alias("first"), key_hash(keys).alias("h"))
    placed = hashed.select(
        "first", "h", F.explode(F.array(*[F.lit(c) for c in counts])).alias("of")
    ).withColumn("place", F.pmod("h", "of").cast("int"))
    met = placed.join(
        F.broadcast(parts),
        (F.col("of") == F.col("buckets")) & (F.col("place") == F.col("number"))
        & (F.col("blocks").isNull() | F.col("first").between(F.col("low"), F.col("high"))),
    )
    found = {r.part for r in met.where("blocks IS NULL").select("part").distinct().collect()} if any(
        r[5] is None for r in rows) else set()
    with_filter = met.where("blocks IS NOT NULL").withColumn("block", _block(F.col("h"), F.col("blocks")))
    wanted = with_filter.select("part").distinct().collect()  # names of parts
    if not wanted:
        return found
    names = {r.part for r in wanted}
    paths = [f"{root}/{FOLDER}/version={r[6]}/part={r[0]}" for r in rows if r[0] in names and r[5] is not None]
    at = F.regexp_extract(F.col("_metadata.file_path"), "part=([^/]+)/", 1)
    filters = spark.read.schema("block long, bits binary").parquet(*paths).select(at.alias("part"), "block", "bits")
    hit = F.lit(True)
    for probe in range(PROBES):
        hit = hit & _is_set(F.col("bits"), _bit(F.col("h"), probe))
    near = with_filter.select("part", "block", "h").join(filters, ["part", "block"]).where(hit)
    return found | {r.part for r in near.select("part").distinct().collect()}
