"""Line dedup: lines that many documents share are dropped.

Lines are cut at newlines and normalised to keys (white space stripped at both ends, A-Z lower
case). Keys are hashed to 128 bits; documents are counted per hash; a document loses the lines
whose key is found in too many documents, except in the smallest doc_id that holds it. Texts are
never shuffled by line: what travels is (hash, doc_id, position), and the positions that a
document loses then meet its text, which is reassembled from the stretches between them.

A hot line owns one row per document. Counting is partially aggregated. When the found hashes
meet their documents again, the few that a large share of all rows hold (at most
``1 / HOT_SHARE``) are broadcast, all others are joined by shuffle.

Defined results: a null or empty text is one empty line (and comes out as an empty text in the
digest); a null doc_id counts as one document that follows all others; repeated doc_ids are one
document in counts, and each row comes out; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CHARS, lower_ascii, read_table, saved

HOT_SHARE = 1 / 2000


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE_CHARS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def shared_lines(
    df: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int
) -> DataFrame:
    """(doc, row, pos) of the lines to drop; ``row`` is the hash of the text."""
    text = F.col(text_col)
    held = (
        df.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("row"),
                  F.transform(lines_of(text), line_key).alias("keys"))
        .select("doc", "row", F.posexplode("keys").alias("pos", "key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc", "row", "pos", F.xxhash64("key").alias("a"),
                F.xxhash64(F.lit(1), "key").alias("b"))
    )
    held = saved(held, "line-keys")
    if min_docs == 2:  # smallest and largest id differ: no need to count ids apart
        ids = held
        many = F.min("doc") < F.max("doc")
    else:
        ids = held.select("doc", "a", "b").distinct()
        many = F.count(F.lit(1)) >= min_docs
    found = (
        ids.groupBy("a", "b")
        .agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"),
             many.alias("many"), (F.count("doc") < F.count(F.lit(1))).alias("nameless"))
        # without counting apart, a null id is a further document beside any other
        .where(F.col("many") | (F.col("nameless") & F.col("first").isNotNull())
               if min_docs == 2 else F.col("many"))
        .drop("many", "nameless")
    )
    found = saved(found, "line-found")  # read twice below
    least = max(1.0, held.count() * HOT_SHARE)
    drops = ~F.col("doc").eqNullSafe(F.col("first"))
    hot = held.join(F.broadcast(found.where(F.col("n") >= least)), ["a", "b"]).where(drops)
    rest = held.join(found.where(F.col("n") < least), ["a", "b"]).where(drops)
    return hot.unionByName(rest).select("doc", "row", "pos")


def dedup_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    min_docs: int = 2,
    min_chars: int = 10,
) -> DataFrame:
    """All rows and columns, with the text reassembled from the lines that stay.

    Adds ``n_lines`` (before) and ``n_dropped``; columns of these names in the input are replaced.
    ``min_docs`` is the number of documents from which a line counts as shared, ``min_chars`` the
    least length of a key (code points).
    """
    lost = (
        shared_lines(df, id_col, text_col, min_docs, min_chars)
        .groupBy(F.col("doc").alias("__doc"), F.col("row").alias("__row"))
        .agg(F.sort_array(F.collect_set("pos")).alias("__lost"))
    )
    met = df.join(lost, F.col(id_col).eqNullSafe(F.col("__doc"))
                  & (F.xxhash64(text_col) == F.col("__row")), "left")
    return reassemble(met, text_col).drop("__doc", "__row", "__lost")


def reassemble(df: DataFrame, text_col: str) -> DataFrame:
    """Join the stretches of lines between the sorted positions in ``__lost`` (null: none)."""
    n = F.size("__lost")
    ends = F.concat("__lost", F.array(F.size("__lines")))

    def stretch(end: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get("__lost", i - 1) + 1)
        return F.slice("__lines", start + 1, end - start)

    kept = F.when(F.col("__lost").isNull(), F.col("__lines")).otherwise(
        F.flatten(F.transform(ends, stretch)))
    return (
        df.withColumn("__lines", lines_of(F.col(text_col)))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dropped", F.when(F.col("__lost").isNull(), 0).otherwise(n).cast("long"))
        .withColumn(text_col, F.array_join(kept, "\n"))
        .drop("__lines")
    )


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.first AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
