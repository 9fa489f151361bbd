"""Quality rules: a decision list learned by sequential covering.

Statistics of each text are counted in Arrow batches. From labelled rows (a documented, bounded
sample: the ``MOST_LABELLED`` rows with the smallest seeded hash) an ordered list of rules is
learned on the driver: a rule is grown on two thirds of the rows that no earlier rule covers, one
threshold at a time by FOIL gain, pruned from its end on the other third, and kept if it is
precise enough on both. The list becomes one ordered Spark conditional expression, which is then
applied to all rows in the same pass that counts their statistics; nothing is shuffled.

Defined results: a null or empty text has no words and fails the base rule; labels that are null,
or of documents that are not there, are left out; several labels of a document count by their mean;
without labels of both classes the list is empty and only the base rule rejects; repeated rows are
judged each; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, small_batches
from tidemark.llm.shingles import mix

MOST_LABELLED = 20_000
SPLITS = 8  # failed ones in a row that end the list
SEED = 6
SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_chars", "n_upper", "n_digits", "n_marks", "n_stops", "n_distinct", "n_most",
)


def byte_classes() -> np.ndarray:
    """One row for each count of bytes: code points, white space, symbols, and so on."""
    table = np.zeros((7, 256), np.uint8)
    codes = np.arange(256)
    table[0] = (codes & 0xC0) != 0x80  # first bytes of code points
    table[1, [32, *range(9, 14)]] = 1
    table[2, list(SYMBOLS)] = 1
    table[3, ord("A"):ord("Z") + 1] = 1
    table[4, ord("0"):ord("9") + 1] = 1
    table[5, list(b"!?\"'()[]{}=;:/\\^~`_+-")] = 1
    table[6, list(b".,")] = 1
    return table


def counted(texts: list[bytes], table: np.ndarray, kept: dict[bytes, int]) -> np.ndarray:
    """COUNTS (columns) of each text (rows)."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    if len(kept) > 400_000:
        kept.clear()
    flat: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.split()
        for word in words:
            if word not in kept:
                kept[word] = len(kept)
        flat.extend(map(kept.__getitem__, words))
        sizes[i] = len(words)
        lines = text.split(b"\n")
        out[i, 5] = len(lines)
        if len(lines) > 1:
            seen: set[bytes] = set()
            for line in lines:
                if line in seen:
                    out[i, 3] += not line.isspace()
                elif line:
                    seen.add(line)
        raw = np.frombuffer(text, np.uint8)
        of_class = np.bincount(raw, minlength=256)
        points, spaces, out[i, 2], out[i, 7], out[i, 8], out[i, 9], out[i, 10] = table @ of_class
        out[i, 6], out[i, 1] = points, points - spaces
    out[:, 0] = sizes
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    word = np.array(flat, np.uint64)
    if len(word):
        per_text = (owner << np.uint64(32)) | word
        distinct, times = np.unique(per_text, return_counts=True)
        of = (distinct >> np.uint64(32)).astype(np.int64)
        out[:, 11] = np.bincount(of, minlength=len(texts))
        np.maximum.at(out[:, 12], of, times)
    if len(word) >= 3:
        window = mix(mix(mix(owner + np.uint64(1))[:-2] + word[:-2]) + word[1:-1]) + word[2:]
        inside = owner[:-2] == owner[2:]
        _, at, times = np.unique(window, return_inverse=True, return_counts=True)
        # windows that reach into the next text are not windows
        times = np.bincount(at[inside], minlength=len(times))
        again = inside & (times[at] > 1)
        covered = np.zeros(len(word), bool)
        for k in range(3):
            covered[k:len(word) - 2 + k] |= again
        out[:, 4] = np.bincount(owner[covered].astype(np.int64), minlength=len(texts))
    return out


def with_counts(df: DataFrame, text_col: str, keep: list[str], prefix: str) -> DataFrame:
    """Columns ``keep`` and, prefixed, COUNTS of the text."""
    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join(kinds + [f"`{prefix}{c}` long" for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        table = byte_classes().astype(np.int64)
        for batch in small_batches(batches, 4 << 20):
            texts = [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
            counts = counted(texts, table, kept)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c) for c in counts.T.copy())],
                [str(i) for i in range(len(keep) + len(COUNTS))])

    text = F.col(f"`{text_col}`").cast("binary")
    return df.select(*(F.col(f"`{c}`") for c in keep), text.alias("__text")).mapInArrow(run, schema)


def features(prefix: str = "") -> dict[str, Column]:
    """Statistics the rules may test, as expressions over COUNTS."""
    def c(name: str) -> Column:
        return F.col(f"`{prefix}{name}`").cast("double")

    words, chars = F.greatest(c("n_words"), F.lit(1.0)), F.greatest(c("n_chars"), F.lit(1.0))
    return {
        "words": c("n_words"),
        "mean_word": c("word_chars") / words,
        "symbols_per_word": c("n_symbols") / words,
        "dup_line_share": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1.0)),
        "repeat_share": c("n_repeat_words") / words,
        "words_per_line": words / F.greatest(c("n_lines"), F.lit(1.0)),
        "upper_share": c("n_upper") / chars,
        "digit_share": c("n_digits") / chars,
        "mark_share": c("n_marks") / chars,
        "stops_per_word": c("n_stops") / words,
        "distinct_share": c("n_distinct") / words,
        "top_word_share": c("n_most") / words,
    }


@dataclass
class Rule:
    """A conjunction of (feature, "<=" or ">", threshold); what it covers is rejected."""

    tests: list[tuple[str, str, float]] = field(default_factory=list)

    def covers(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, sign, cut in self.tests:
            column = x[:, names.index(name)]
            out &= column <= cut if sign == "<=" else column > cut
        return out

    def column(self, values: dict[str, Column]) -> Column:
        return reduce(and_, (values[n] <= c if s == "<=" else values[n] > c
                             for n, s, c in self.tests))

    def __str__(self) -> str:
        return " AND ".join(f"{n} {s} {c:.6g}" for n, s, c in self.tests)


def best_test(x: np.ndarray, bad: np.ndarray, names: list[str], least: int):
    """The threshold of the highest FOIL gain over rows that the rule covers so far."""
    p0, n0 = bad.sum(), (~bad).sum()
    base = np.log2(p0 / (p0 + n0))
    best, found = 1e-9, None
    for k, name in enumerate(names):
        order = np.argsort(x[:, k], kind="stable")
        v, b = x[order, k], bad[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        p_low = np.cumsum(b)[cut]
        n_low = cut + 1 - p_low
        for sign, p, n in (("<=", p_low, n_low), (">", p0 - p_low, n0 - n_low)):
            gain = np.where(p >= least, p * (np.log2(np.maximum(p, 1e-9) / (p + n)) - base), 0)
            i = int(np.argmax(gain))
            if gain[i] > best:
                best = gain[i]
                found = (name, sign, float((v[cut[i]] + v[cut[i] + 1]) / 2))
    return found


def learn_rules(
    x: np.ndarray,
    bad: np.ndarray,
    names: list[str],
    *,
    most_rules: int = 24,
    most_tests: int = 4,
    precision: float = 0.9,
    least: int = 3,
) -> list[Rule]:
    """Sequential covering: rules for ``bad`` rows, in order.

    If a rule is not precise enough, others are tried from new splits before the list ends.
    """
    rules: list[Rule] = []
    rng = np.random.default_rng(SEED)
    left = np.ones(len(x), bool)
    failed = 0
    while len(rules) < most_rules and bad[left].sum() >= least and failed < SPLITS:
        rows = rng.permutation(np.flatnonzero(left))
        grow, prune = rows[: len(rows) * 2 // 3], rows[len(rows) * 2 // 3:]
        rule, at = Rule(), grow
        while len(rule.tests) < most_tests and bad[at].any() and not bad[at].all():
            test = best_test(x[at], bad[at], names, least)
            if test is None:
                break
            rule.tests.append(test)
            at = grow[rule.covers(x[grow], names)]

        def worth(tests, prune=prune) -> float:
            on = bad[prune[Rule(tests).covers(x[prune], names)]]
            return (2 * on.sum() - len(on)) / (len(on) + 1)

        lengths = range(len(rule.tests), 0, -1)
        if rule.tests:
            rule = Rule(rule.tests[:max(lengths, key=lambda k: worth(rule.tests[:k]))])
        covered = left & rule.covers(x, names)
        p, n = (bad & covered).sum(), covered.sum()
        if rule.tests and p >= least and (p == n or (p + 1) / (n + 2) >= precision):
            rules.append(rule)
            left &= ~covered
            failed = 0
        else:
            failed += 1
    return rules


def labelled_sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bad, features) of at most MOST_LABELLED labelled rows."""
    some = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("__id")).agg((F.avg("quality") < 0.5).alias("__bad"))
        .orderBy(F.xxhash64(F.lit(SEED), "__id"), "__id").limit(MOST_LABELLED)
    )
    rows = (
        df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__raw"))
        .join(F.broadcast(some), "__id")  # at most MOST_LABELLED rows
        .withColumn("__tie", F.xxhash64("__raw"))
    )
    # texts are counted where they are; only numbers are brought together
    counts = with_counts(rows, "__raw", ["__bad", "__id", "__tie"], "")
    return (
        counts.select("__bad", "__id", "__tie", *(v.alias(k) for k, v in features().items()))
        .orderBy(F.xxhash64(F.lit(SEED), "__id"), "__id", "__tie").limit(MOST_LABELLED).drop("__id", "__tie")
    )


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    sample = labelled_sample(df, labels, id_col, text_col).toPandas()
    names = list(sample.columns[1:])
    bad = sample["__bad"].to_numpy(dtype=bool)
    if not bad.any() or bad.all():
        return []
    return learn_rules(sample[names].to_numpy(dtype=float), bad, names)


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """The list as an ordered conditional: the place of the first rule that covers a row."""
    values = features(prefix)
    out = F.when(F.lit(False), F.lit(0))
    for place, rule in enumerate(rules, 1):
        out = out.when(rule.column(values), F.lit(place))
    return out


def base_failed(prefix: str = "") -> Column:
    words, again = F.col(f"`{prefix}n_words`"), F.col(f"`{prefix}n_repeat_words`")
    return (words < 50) | (100 * again > 50 * words)


def judged(df: DataFrame, rules: list[Rule], text_col: str, keep: list[str], prefix: str) -> DataFrame:
    """Columns ``keep``, the counts, ``base_failed``, ``rule`` (null: none) and ``kept``, prefixed."""
    counts = with_counts(df, text_col, keep, prefix)
    counts = counts.withColumn(f"{prefix}base_failed", base_failed(prefix))
    counts = counts.withColumn(f"{prefix}rule", verdict(rules, prefix))
    kept = ~F.col(f"{prefix}base_failed") & F.col(f"{prefix}rule").isNull()
    return counts.withColumn(f"{prefix}kept", kept)


def keep_good(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that the base rule and the learned list let pass, with their columns."""
    rules = fit(df, labels, id_col, text_col)
    marked = judged(df, rules, text_col, df.columns, "__q_")
    return marked.where("__q_kept").select(*(f"`{c}`" for c in df.columns))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rules = fit(docs, read_table(spark, sf_dir, "labels"))
    return judged(docs, rules, "text", ["doc_id"], "").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule")
