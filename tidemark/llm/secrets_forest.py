"""Secret scans with a random forest against false positives.

Candidates are runs of at least ``LEAST`` characters of the alphabets of keys, hashes and base64, and, at any
length and of any characters, values assigned to a name that holds one of ``NAMES`` and passwords inside
addresses (``scheme://user:password@host``); of overlapping ones the first of these kinds counts. A shorter run
that nothing names is no candidate: that is the floor. Each gets statistics: length and make-up; how likely its character transitions are in the corpus' own
words; how much of it dictionary words cover; whether it stands in a path, address or assignment; and
the words beside it (hashed). A random forest, trained on labelled findings, gives the probability
that a finding is a secret; those below ``threshold`` are marked as false positives.

The dictionary holds all words with at least ``1 / DICTIONARY`` of the corpus' letters-only tokens, counted over
all texts; character transitions are counted from it. The forest is fitted on a bounded sample: of each class at most
``MOST_LABELLED`` findings, by seeded hash. Where no labelled findings are given, :func:`weak_labels`
labels the clear cases: quoted values assigned to a name such as ``token`` are secrets; what has
only letters or only digits, or stands in an address, is none. What the labels are made from (``LABEL_GIVING``)
is kept from the forest, so that it has to learn how secrets look and what stands beside them.

Defined results: null and empty texts have no findings; a text may be as long as it likes; repeated rows are
scanned each; labelled findings that are not found again are left out; without labels of both
classes every finding gets the share of secrets among the labels (0 without any).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, saved, small_batches

LEAST = 20
DICTIONARY = 1 << 16
SHORTEST_WORD = 3
MOST_LABELLED = 10_000
BUCKETS = 12
TREES = 40
DEPTH = 8
SEED = 2
RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
NAMES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "private_key",
         "auth", "credential")
MEASURES = (
    "size", "digits", "uppers", "lowers", "others", "changes", "entropy", "hex_only",
    "transitions", "coverage", "longest_word", "in_path", "in_address", "assigned", "quoted",
)
LABEL_GIVING = ("digits", "in_address", "assigned", "quoted")
FEATURES = tuple(m for m in MEASURES if m not in LABEL_GIVING)
# bounded repeats: a text without spaces is searched in linear time
NAMED = re.compile(
    rb"(?i)(?:%s)[\w-]{0,32}[\"']?[ \t]{0,8}[=:][ \t]{0,8}(?:\"([^\"\n]{1,4096})\"|'([^'\n]{1,4096})'|([^\s\"',;]{1,4096}))"
    % "|".join(NAMES).encode())
PASSWORD = re.compile(rb"://[^\s/:@]{1,256}:([^\s/@]{1,256})@")
NEAR = tuple(f"{side}_{k}" for side in ("before", "before2", "after") for k in range(BUCKETS))


def dictionary_of(df: DataFrame) -> dict[bytes, int]:
    """Letters-only words (lower case) with a large share, and their counts; all texts count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                ["word", "c"])

        for batch in small_batches(batches):
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(text.lower().split())
            if len(counts) > 400_000:
                yield flush()
                counts.clear()
        yield flush()

    letters = F.col("word").cast("string").rlike(r"^\p{L}{%d,}$" % SHORTEST_WORD)
    counts = saved(
        df.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, c long")
        .where(letters).groupBy("word").agg(F.sum("c").alias("c")), "words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    rows = counts.where(F.col("c") * DICTIONARY >= total).collect()  # DICTIONARY rows at most
    return {bytes(r["word"]): r["c"] for r in rows}


def transitions_of(words: dict[bytes, int]) -> np.ndarray:
    """Log probability of a letter after a letter (26: any other byte), smoothed."""
    table = np.ones((27, 27))
    for word, n in words.items():
        codes = [c - 97 if 97 <= c < 123 else 26 for c in word]
        for a, b in zip([26, *codes], [*codes, 26], strict=True):
            table[a, b] += n
    return np.log(table / table.sum(axis=1, keepdims=True))


def candidates(text: bytes) -> list[tuple[int, int]]:
    """Spans that may be secrets, by place: named values, passwords in addresses, long runs beside them."""
    found: list[tuple[int, int]] = []
    for pattern in (NAMED, PASSWORD, RUN):
        taken, at = sorted(found), 0
        for match in pattern.finditer(text):
            start, stop = match.span(match.lastindex or 0)
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if at == len(taken) or taken[at][0] >= stop:
                found.append((start, stop))
    return sorted(found)


class Scanner:
    def __init__(self, words: dict[bytes, int]):
        import ahocorasick

        self.transitions = transitions_of(words)
        self.automaton = ahocorasick.Automaton()
        for word in words:
            text = word.decode()
            if text.isascii():
                self.automaton.add_word(text, len(text))
        if len(self.automaton):
            self.automaton.make_automaton()

    def measures(self, text: bytes, start: int, stop: int) -> list[float]:
        value = text[start:stop]
        n = len(value)
        raw = np.frombuffer(value, np.uint8)
        digit = (raw >= 48) & (raw < 58)
        upper = (raw >= 65) & (raw < 91)
        lower = (raw >= 97) & (raw < 123)
        kind = digit * 1 + upper * 2 + lower * 3
        shares = np.unique(raw, return_counts=True)[1] / n
        codes = np.where(upper, raw - 65, np.where(lower, raw - 97, 26)).astype(np.int64)
        covered, longest = self.coverage(value.lower().decode(errors="replace"))
        left, right = text[max(0, start - 8):start], text[stop:stop + 8]
        near = max(0, start - 256)
        outer = text[max(near, text.rfind(b" ", near, start)):start] + right
        return [
            n, digit.mean(), upper.mean(), lower.mean(), (kind == 0).mean(),
            (kind[1:] != kind[:-1]).mean() if n > 1 else 0.0, float(-(shares * np.log2(shares)).sum()),
            float(re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", value) is not None),
            float(self.transitions[codes[:-1], codes[1:]].mean()) if n > 1 else 0.0, min(covered / n, 1.0), longest,
            float(b"/" in value or left.endswith((b"/", b"\\")) or right.startswith((b"/", b"\\"))),
            float(left.endswith(b"@") or right.startswith((b"@", b".")) or b"://" in outer),
            float(re.search(rb"[=:]\s*[\"']?$", left) is not None),
            float(left.endswith((b'"', b"'")) and right.startswith((b'"', b"'"))),
        ]

    def coverage(self, value: str) -> tuple[int, int]:
        """Characters inside dictionary words, and the length of the longest word."""
        covered = longest = reach = 0
        if len(self.automaton):
            spans = sorted((end - size + 1, end + 1) for end, size in self.automaton.iter(value))
            for a, b in spans:
                longest = max(longest, b - a)
                if b > reach:
                    covered += b - max(a, reach)
                    reach = b
        return covered, longest

    def scan(self, text: bytes) -> Iterator[tuple]:
        """(start, length, value, measures, words beside it) of each candidate; offsets are code points."""
        points = last = 0
        raw = np.frombuffer(text, np.uint8)
        for start, stop in candidates(text):
            points += int(np.count_nonzero((raw[last:start] & 0xC0) != 0x80))
            last = start
            before = [w.lower() for w in re.findall(rb"[^\W\d_][\w]*", text[max(0, start - 64):start])][-2:]
            after = [w.lower() for w in re.findall(rb"[^\W\d_][\w]*", text[stop:stop + 48])][:1]
            near = ([b""] * (2 - len(before)) + before)[::-1] + (after or [b""])
            length = int(np.count_nonzero((raw[start:stop] & 0xC0) != 0x80))
            yield points, length, text[start:stop], self.measures(text, start, stop), near


def findings(df: DataFrame, words: dict[bytes, int]) -> DataFrame:
    """A row for each candidate of (doc_id, text)."""
    shared = df.sparkSession.sparkContext.broadcast(words)  # DICTIONARY words at most
    kind = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, value binary, key string, " + ", ".join(
        f"`{c}` double" for c in (*MEASURES, *NEAR))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in small_batches(batches):
            owner, rows, table = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for start, length, value, measures, near in scanner.scan(text or b""):
                    hashed = np.zeros((3, BUCKETS))
                    for side, word in enumerate(near):
                        if word:
                            hashed[side, zlib.crc32(word) % BUCKETS] = 1
                    owner.append(i)
                    rows.append((start, length, value, near[0].decode(errors="replace")))
                    table.append([*measures, *hashed.ravel()])
            starts, lengths, values, keys = zip(*rows, strict=True) if rows else ((), (), (), ())
            numbers = np.array(table, float).reshape(len(rows), len(MEASURES) + len(NEAR))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(owner, pa.int64())), pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()), pa.array(values, pa.binary()), pa.array(keys, pa.string()),
                *(pa.array(c) for c in numbers.T.copy()),
            ], ["doc_id", "start", "length", "value", "key", *MEASURES, *NEAR])

    return df.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def weak_labels(found: DataFrame) -> Column:
    """1, 0, or null where the case is not clear."""
    mixed = (F.col("digits") > 0) & (F.col("digits") < 1)
    named = F.col("key").isin(*NAMES) & (F.col("assigned") == 1)
    return (
        F.when(named & (F.col("quoted") == 1) & mixed, 1.0)
        .when(~named & ((F.col("digits") == 0) | (F.col("digits") == 1) | (F.col("in_address") == 1)), 0.0)
    )


def fit_forest(found: DataFrame):
    """A forest over findings with a column ``label``, or the label's mean if there is one class."""
    order = F.xxhash64(F.lit(SEED), "doc_id", "start", "value")
    names = [*FEATURES, *NEAR]
    some = [
        found.where(F.col("label") == label).orderBy(order).limit(MOST_LABELLED).select("label", *names)
        for label in (0.0, 1.0)
    ]
    sample = saved(some[0].union(some[1]), "labelled")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return 1.0 if 1.0 in counts else 0.0
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=names, outputCol="features").transform(sample))


def scan(df: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Findings of (doc_id, text): doc_id, start, length, value, score, is_secret.

    ``labelled`` holds (doc_id, start, label) with labels 0 and 1.
    """
    found = saved(findings(df, dictionary_of(df)), "findings")
    if labelled is None:
        trained = found.withColumn("label", weak_labels(found))
    else:
        marks = labelled.select(
            F.col("doc_id").alias("__id"), F.col("start").alias("__at"),
            F.col("label").cast("double").alias("label")).distinct()
        trained = found.join(marks, (F.col("doc_id") == F.col("__id")) & (F.col("start") == F.col("__at")))
    model = fit_forest(trained)
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        assembled = VectorAssembler(inputCols=[*FEATURES, *NEAR], outputCol="features").transform(found)
        scored = model.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "length", "value", "score",
                         (F.col("score") >= threshold).alias("is_secret"))


def op2_secrets_forest(spark, sf_dir: str) -> DataFrame:
    """Findings of all documents; values as digests."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).withColumn("value_sha256", F.sha2("value", 256)).drop("value")
