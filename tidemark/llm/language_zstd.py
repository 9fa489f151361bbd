"""Language identification by compression.

For each language a raw-content dictionary is put together from its learning texts. A text is
compressed whole with every dictionary; the language whose dictionary gives the smallest result
is chosen (ties: first by code point). If the runner-up is less than ``MARGIN`` larger, the choice
is marked as rejected.

The dictionaries are fitted on a bounded sample: of each language the ``SAMPLE_TEXTS`` distinct texts with
the smallest seeded hashes, cut into pieces of ``PIECE_BYTES`` anywhere in them, of which the first
``SAMPLE_PIECES`` in seeded order are taken, up to ``DICTIONARY_BYTES``. Where there are more than
``MOST_LANGUAGES`` values of the language, the most frequent ones (of equals the first by code point)
are learned; the others, a dirty column's, are no answers. All else covers every row and whole
texts, in one pass without a shuffle.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and everything if
nothing could be learned; learning rows with a null lang or text are left out; repeated rows are
judged each; other columns pass through the operator untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, saved, small_batches

SAMPLE_TEXTS = 400
PIECE_BYTES = 384
SAMPLE_PIECES = 2048
SPARE = 4
DICTIONARY_BYTES = 256 << 10
MOST_LANGUAGES = 500
LEVEL = 6
MARGIN = 0.01
SEED = 10


def dictionary_of(pieces: list[bytes]) -> bytes:
    """The pieces in their order, up to DICTIONARY_BYTES."""
    return b"".join(pieces)[:DICTIONARY_BYTES]


def least_of(rows: DataFrame, hashed: str, order: list[str], count: int) -> DataFrame:
    """Of each language the ``count`` rows with the least hashes.

    Rows whose hash is too large to be among them by far (``SPARE`` times as many are expected to stay) go
    first, where they are, so that what meets in a task does not grow with the language.
    """
    place = F.pmod(hashed, F.lit(1 << 30))
    held = rows.groupBy(F.col("lang").alias("__lang")).agg(F.count(F.lit(1)).alias("__held"))  # a row a language
    few = rows.join(F.broadcast(held), F.col("lang") == F.col("__lang")).where(
        place * F.col("__held") < float(SPARE * count * (1 << 30)))
    window = Window.partitionBy("lang").orderBy(place, *order)
    return few.withColumn("__n", F.row_number().over(window)).where(F.col("__n") <= count).drop("__n", "__lang", "__held")


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language of the rows."""
    rows = df.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")).where(
        "lang IS NOT NULL AND text <> ''")
    rows = rows.withColumn("key", F.xxhash64(F.lit(SEED), "text"))
    # hashes travel, not texts: copies of a text are one
    keys = saved(rows.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("held")), "learning-keys")
    known = (  # at most MOST_LANGUAGES rows
        keys.groupBy("lang").agg(F.sum("held").alias("held"))
        .orderBy(F.desc("held"), "lang").limit(MOST_LANGUAGES).select("lang")
    )
    chosen = least_of(
        keys.join(F.broadcast(known), "lang").select("lang", "key"), "key", ["key"], SAMPLE_TEXTS)
    # at most SAMPLE_TEXTS rows for each of MOST_LANGUAGES languages
    texts = rows.join(F.broadcast(chosen), ["lang", "key"], "left_semi").dropDuplicates(["lang", "key"])
    texts = saved(texts, "learning-texts")
    # places of pieces are drawn first, so that a long text is cut where it is
    last = F.floor((F.octet_length("text") - 1) / PIECE_BYTES)
    places = texts.select("lang", "key", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("at"))
    order = F.xxhash64(F.lit(SEED), "key", "at")
    drawn = least_of(places.withColumn("order", order), "order", ["order", "key", "at"], SAMPLE_PIECES).groupBy("lang", "key").agg(
        F.collect_list("at").alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20):
            rows = []
            for lang, key, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.lower().encode()
                rows += [(lang, key, at, raw[at * PIECE_BYTES:(at + 1) * PIECE_BYTES]) for at in places]
            lang, key, at, piece = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(key, pa.int64()), pa.array(at, pa.int64()),
                 pa.array(piece, pa.binary())], ["lang", "key", "at", "piece"])

    # at most SAMPLE_PIECES pieces of a language
    sample = texts.join(drawn, ["lang", "key"]).select("lang", "key", "text", "places").mapInArrow(
        cut, "lang string, key long, at long, piece binary").withColumn("order", order)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["order", "key", "at"])
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "content": [dictionary_of(list(group["piece"]))]})

    built = sample.groupBy("lang").applyInPandas(build, "lang string, content binary").collect()
    return {row["lang"]: bytes(row["content"]) for row in sorted(built, key=lambda r: r["lang"])}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import regex
        import zstandard

        self.languages = sorted(dictionaries)
        self.letter = regex.compile(r"\p{L}")
        self.compressors = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(
                dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False))

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected); the score is the share of ``2 ** -bits``."""
        if not text or not self.languages or not self.letter.search(text):
            return "und", 0.0, True
        raw = text.lower().encode()
        sizes = [len(c.compress(raw)) for c in self.compressors]
        best = min(sizes)
        at = sizes.index(best)
        score = 1.0 / sum(2.0 ** (-8 * min(s - best, 100)) for s in sizes)
        others = sizes[:at] + sizes[at + 1:]
        rejected = bool(others) and min(others) - best < MARGIN * min(others)
        return self.languages[at], score, rejected


def identify(df: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all) and lang_pred, score, rejected, which replace columns of these names."""
    new = ("lang_pred", "score", "rejected")
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    # DICTIONARY_BYTES for each of MOST_LANGUAGES languages at most
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)
    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kinds, "lang_pred string", "score double", "rejected boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in small_batches(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [classifier.classify(t) for t in texts]
            lang, score, rejected = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())],
                [str(i) for i in range(len(keep) + 3)])

    text = F.col(f"`{text_col}`").cast("string").alias("__text")
    return df.select(*(F.col(f"`{c}`") for c in keep), text).mapInArrow(run, schema)


def op10_language_zstd(spark, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs = read_table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(held_out, F.lit(False)))
    dictionaries = learn(docs.where(~F.col("held_out")))
    return identify(docs, dictionaries, keep=["doc_id", "held_out"])
