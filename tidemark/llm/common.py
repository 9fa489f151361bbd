"""Helpers of the operators: words, written tables in the shared folder, batches of rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

# Java patterns of white space and of words: everything but space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it: a cut of the lineage.

    The folder is shared, so the rows survive the loss of any executor.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table from :func:`saved` that no later step reads."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: ``bytes.split`` cuts at just the six characters of SPACE."""
    return text.split() if text else []


def small_batches(
    batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``max_bytes`` (one row at least)."""
    for batch in batches:
        start, n = 0, batch.num_rows
        step = max(1, int(n * max_bytes / max(batch.nbytes, 1)))
        while start < n:
            yield batch.slice(start, step)
            start += step


def join_by_share(rows: DataFrame, table: DataFrame, key: str, held: str, share: int = 1024) -> DataFrame:
    """``rows JOIN table`` on a key (null-safe), where ``table`` has one row a key and says in ``held``
    how many of the rows have it.

    Keys with at least 1 / ``share`` of all rows, at most ``share`` of them, are broadcast; the rows of all
    others meet by shuffle, where no key is hot. Both sides are read twice: pass written tables.
    """
    total = table.agg(F.sum(held)).first()[0] or 0
    own = F.col(held) * share >= total
    hot, cold = (table.where(w).drop(held).withColumnRenamed(key, "__key") for w in (own, ~own))
    same = F.col(key).eqNullSafe(F.col("__key"))
    near = rows.join(F.broadcast(hot), same)
    far = rows.join(F.broadcast(hot.select("__key")), same, "left_anti").join(cold, same)
    return near.unionByName(far).drop("__key")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
