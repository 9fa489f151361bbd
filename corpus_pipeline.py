"""From raw documents to token ids: quality rules, line dedup, near-dedup, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; what it
returns is written as Parquet in the shared folder and read again as the next stage's rows. All but the last
return the columns of ``documents``. ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import lines, mixing, pieces, quality_rules, superminhash
from tidemark.llm.common import read_table, saved
from tidemark.operators.joins import broadcast_if_small

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIX = {"weights": (3.0, 1.0, 2.0), "share": 1.5, "most_repeats": 2, "block_words": 512}


def documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with ``n_chars`` of the text as it is now."""
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in two or more documents stay in the smallest doc_id only."""
    return documents(lines.dedup_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, and one of equal rows; rows without an id stay.

    Different texts under one id are judged each: the text with the least hash goes by the id, any other by a
    number of its own above all ids, so that a text goes only for what it resembles itself.
    """
    hashes = {"__h": F.xxhash64("text"), "__h2": F.xxhash64(F.lit(1), "text")}
    named = docs.where(F.col("doc_id").isNotNull()).withColumns(hashes)
    several = named.groupBy(F.col("doc_id").alias("__id")).agg(
        F.min("__h").alias("__least"), F.max("__h").alias("__most")).where(F.col("__least") < F.col("__most"))
    several = broadcast_if_small(several)  # few, as a rule: then texts stay where they are
    own = F.lit(1 << 62) + F.xxhash64("doc_id", "__h").bitwiseAND(F.lit((1 << 61) - 1))
    alone = F.col("__least").isNull() | (F.col("__h") == F.col("__least"))
    units = named.join(several, F.col("doc_id") == F.col("__id"), "left").withColumn(
        "__unit", F.when(alone, F.col("doc_id")).otherwise(own))
    found = superminhash.near_duplicates(units, "__unit", "text")
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("__unit"))
    by = Window.partitionBy("doc_id", "__h", "__h2").orderBy("source", "lang")
    one = units.withColumn("__n", F.row_number().over(by)).where(F.col("__n") == 1)
    kept = one.join(gone, "__unit", "left_anti").select(*COLUMNS)
    return kept.unionByName(docs.where(F.col("doc_id").isNull()).select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are the copies and parts of documents that the mix takes."""
    return documents(mixing.mixed_documents(docs, **MIX))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of the decoded text."""
    return pieces.encode(docs, pieces.model_bytes(), ids=True, decoded=False)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("mixing", mix),
    ("sentencepiece", sentencepiece),
]

# Learned rules, signatures, seeded hashes and a tokenizer are beyond SQL: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
