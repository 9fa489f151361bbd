"""SimHash near-dedup by anchor-point covering.

The fingerprint of a text has a bit set where more than half of its shingle hashes have it. Anchors are the
words of a covering code of the 64-bit space, a direct sum of perfect cyclic codes (two binary Golay codes
of 23 bits and covering radius 3; for very many fingerprints also a Hamming code of 15 bits and radius 1)
and of one all-zero block for the bits that are left, which any word covers. Every fingerprint
has exactly one anchor within the covering radius of every block, its home. Two
fingerprints that differ in at most ``threshold`` bits, counted block by block, exceed the radius at
each other's home by that many bits at most. So each distinct fingerprint is replicated to every anchor within
covering radius plus threshold (the blocks' excesses together are at most the threshold), and
each anchor compares its home fingerprints with what was replicated to it: no link is missed, and none
needs a look at other anchors. Error patterns of a block are found by syndrome, so the anchors of a
fingerprint are listed without a search.

What is compared are distinct fingerprints, so exact copies and texts that collide cost one row. A
fingerprint has few others within the threshold (2,080 within two bits), so links do not grow with the
square of a group; components of links are joined by large and small stars. Tables with a row a fingerprint or
more meet by shuffle and are never broadcast.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; a text of fewer
words than a shingle is one shingle; rows that share a doc_id are one document with the links of any of its
texts, one row each with its own fingerprint; a row without a doc_id has a fingerprint, links with nothing
and has no component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, join_by_share, read_table, saved, small_batches, words_of
from tidemark.llm.superminhash import components

BITS = 64
SEED = 42
THRESHOLD = 2
CHUNK = 1 << 17
# Perfect cyclic codes: length, covering radius, generator polynomial (fixed values).
GOLAY = (23, 3, 0xC75)
HAMMING = (15, 1, 0x13)
# Anchors of two Golay codes are 2**24; with more distinct fingerprints than this the third code is added.
MANY = 1 << 26


def shingle_hashes(words: list[bytes], width: int) -> list[int]:
    """XXH64 of the space-joined shingles of a text, repeats included."""
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    text = b" ".join(words)
    if len(words) <= width:
        return [digest(text, SEED)]
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [digest(text[a:b - 1], SEED) for a, b in zip(ends, ends[width:], strict=False)]


def majority(hashes: np.ndarray, sizes: list[int]) -> np.ndarray:
    """For each run of hashes the bits that more than half of them have; zero for an empty run."""
    size = np.array(sizes, np.int64)
    full = np.flatnonzero(size)
    ends = np.cumsum(size[full])
    ones = np.zeros((len(full), BITS), np.int64)
    for low in range(0, len(hashes), CHUNK):
        part = hashes[low:low + CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        first = np.searchsorted(ends, low, "right")
        last = np.searchsorted(ends, low + len(part) - 1, "right")
        begins = np.append(low, ends[first:last]) - low
        ones[first:last + 1] += np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
    out = np.zeros(len(size), np.uint64)
    set_ = (2 * ones > size[full, None]).astype(np.uint64)
    out[full] = (set_ << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(df: DataFrame, width: int) -> DataFrame:
    """(doc_id, fingerprint) of (doc_id, text); the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2 << 20):
            flat, sizes = [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_hashes(words_of(text.lower() if text else text), width)
                flat.append(np.array(hashes, np.uint64))
                sizes.append(len(hashes))
            found = majority(np.concatenate(flat), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    return df.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, fingerprint long")


class Block:
    """A perfect cyclic code on some bits: error patterns by syndrome, ordered by their excess over the radius."""

    def __init__(self, code: tuple[int, int, int], threshold: int):
        self.length, self.radius, generator = code
        check = generator.bit_length() - 1
        of_bit = [1]  # remainders of x**i
        for _ in range(self.length - 1):
            rest = of_bit[-1] << 1
            of_bit.append(rest ^ generator if rest >> check else rest)
        self.tables = []  # syndromes of each byte
        for low in range(0, self.length, 8):
            table = np.zeros(256, np.int64)
            for bit, rest in enumerate(of_bit[low:low + 8]):
                table[np.arange(256) >> bit & 1 == 1] ^= rest
            self.tables.append(table)
        found = []
        for weight in range(min(self.radius + threshold, self.length) + 1):
            places = np.array(list(combinations(range(self.length), weight)), np.int64).reshape(
                comb(self.length, weight), weight)
            patterns = (1 << places).sum(axis=1)
            found.append((patterns, np.full(len(patterns), max(0, weight - self.radius))))
        patterns, excess = (np.concatenate(c) for c in zip(*found, strict=True))
        syndrome = self.syndrome(patterns)
        order = np.lexsort((excess, syndrome))
        self.patterns, self.excess = patterns[order], excess[order]
        steps = syndrome[order] * (threshold + 1) + self.excess
        self.start = np.searchsorted(syndrome[order], np.arange(1 << check))
        self.end = np.searchsorted(
            steps, np.arange((1 << check) * (threshold + 1)).reshape(-1, threshold + 1), "right")

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for i, table in enumerate(self.tables):
            out ^= table[words >> 8 * i & 255]
        return out


def covering(codes: tuple, threshold: int) -> list[Block]:
    made = {code: Block(code, threshold) for code in set(codes)}
    return [made[code] for code in codes]


def anchors_of(words: np.ndarray, blocks: list[Block], extra: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of all anchors that exceed the covering radius by ``extra`` bits at most."""
    rows = np.arange(len(words))
    anchor, left = np.zeros(len(words), np.int64), np.full(len(words), extra)
    low = 0
    for block in blocks:
        own = (words[rows] >> np.uint64(low) & np.uint64((1 << block.length) - 1)).astype(np.int64)
        syndrome = block.syndrome(own)
        start = block.start[syndrome]
        n = block.end[syndrome, left] - start
        at = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
        rows, left = np.repeat(rows, n), np.repeat(left, n) - block.excess[at]
        anchor = np.repeat(anchor, n) | (np.repeat(own, n) ^ block.patterns[at]) << low
        low += block.length
    return rows, anchor


def at_anchors(words: DataFrame, codes: tuple, threshold: int, extra: int) -> DataFrame:
    """(anchor, fingerprint): each distinct fingerprint at its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = covering(codes, threshold)
        for batch in small_batches(batches, 64 << 10):
            own = batch.column(0).to_numpy(zero_copy_only=False)
            rows, anchor = anchors_of(own.view(np.uint64), blocks, extra)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(own[rows])], ["anchor", "fingerprint"])

    return words.select("fingerprint").mapInArrow(run, "anchor long, fingerprint long")


def links(words: DataFrame, codes: tuple, threshold: int) -> DataFrame:
    """(x, y): pairs of distinct fingerprints that differ in at most ``threshold`` bits."""
    home = at_anchors(words, codes, threshold, 0).withColumnRenamed("fingerprint", "x")
    others = at_anchors(words, codes, threshold, threshold).withColumnRenamed("fingerprint", "y")
    near = (F.col("x") < F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= threshold)
    # the smaller one is at home: each pair is met once; Spark sizes the anchors of a fingerprint like the fingerprint
    return home.join(others.hint("merge"), "anchor").where(near).select("x", "y")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    width: int = 3,
    threshold: int = THRESHOLD,
    many: int = MANY,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; the fingerprint as a long."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = saved(fingerprints(docs, width), "fingerprints")
    named = rows.where(F.col("doc_id").isNotNull())
    # a distinct fingerprint stands as the least document that has it
    words = saved(
        named.groupBy("fingerprint").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("held")), "words")
    codes = (GOLAY, GOLAY) if words.count() <= many else (GOLAY, GOLAY, HAMMING)
    met = links(words, codes, threshold)
    several = named.groupBy("doc_id").agg(
        F.min("fingerprint").alias("x"), F.max("fingerprint").alias("top")).where("x < top").drop("top")
    bound = named.join(several.hint("merge"), "doc_id").select("x", F.col("fingerprint").alias("y")).where("x < y").distinct()
    node = words.select("fingerprint", "node").hint("merge")
    edges = saved(
        met.union(bound)
        .join(node.toDF("x", "a"), "x").join(node.toDF("y", "b"), "y")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")
    found = components(edges)
    held = saved(
        words.join(found, words["node"] == found["id"], "left")
        .select("fingerprint", "held", F.coalesce("component", "node").alias("component_id")), "components")
    dropped(edges)
    joined = join_by_share(named, held, "fingerprint", "held")
    lost = rows.where(F.col("doc_id").isNull()).withColumn("component_id", F.lit(None).cast("long"))
    return joined.unionByName(lost).select("doc_id", "fingerprint", "component_id")


def op13_simhash_anchors(spark, sf_dir: str) -> DataFrame:
    rows = near_duplicates(read_table(spark, sf_dir, "documents"))
    return rows.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
