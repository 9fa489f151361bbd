"""Full-refresh load of the raw CSV files into bronze, every value as text."""

from __future__ import annotations

import csv
import datetime as dt
import io
import sys
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from tidemark import config as C
from tidemark.sources import files
from tidemark.sources.lake import Lake

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors have no copy of this package

_OVERFLOW = "_overflow"


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether any quoted cell of the file contains a line break.

    Inside a quoted cell the number of quotes so far is odd, so a file in which every line
    has an even number of quotes has no such cell. One splittable pass over the raw lines,
    which stops at the first hit.
    """
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def logical_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, is_header) of every CSV record, put together from physical lines in parallel.

    A line starts a record if the quotes before it in the file are even in number. What earlier
    blocks of the file add is a running sum over one row per block, which goes to every task; the
    task that scans a block keeps the sum within it and joins the lines of records. Only what is
    open where a block begins or ends is shuffled, at most two pieces a block. The header is the
    first record of a file that is not blank, whether or not it spans lines.
    """
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        (quotes % 2).alias("odd"),
        _blank(_without_cr(value)).alias("blank"),
    )
    earlier_blocks = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = (
        lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"), F.bool_and("blank").alias("blank"))
        .select(
            "file", "block",
            (F.coalesce(F.sum("odd").over(earlier_blocks), F.lit(0)) % 2).alias("inside"),
            F.coalesce(F.bool_and("blank").over(earlier_blocks), F.lit(True)).alias("no_header"),
        )
    )
    pieces = (  # the lines of a block stay in order
        lines.join(F.broadcast(blocks), ["file", "block"])
        .select("file", "block", "inside", "no_header", "odd", "blank", "value")
        .mapInArrow(_joined_lines, "file string, block long, line long, record string, "
                                   "starts boolean, ends boolean, is_header boolean")
    )
    whole = F.col("starts") & F.col("ends")
    # The record that is open when a block begins started in an earlier one.
    so_far = Window.partitionBy("file").orderBy("block", "line").rowsBetween(Window.unboundedPreceding, 0)
    start = F.last(F.when(F.col("starts"), F.struct("block", "line")), ignorenulls=True).over(so_far)
    joined = (
        pieces.where(~whole).withColumn("start", start)
        .groupBy("file", "start").agg(
            F.array_sort(F.collect_list(F.struct("block", "line", "record"))).alias("pieces"),
            F.max("is_header").alias("is_header"),
        )
        .select(F.array_join(F.col("pieces.record"), "\n").alias("record"), "is_header")
    )
    records = pieces.where(whole).select("record", "is_header").unionByName(joined)
    return records.select(_without_cr(F.col("record")).alias("record"), "is_header")


def _joined_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the lines of blocks (file, block, inside, no_header, odd, blank, value), one block after the other.

    ``inside`` (odd quotes before the block) and ``no_header`` (only blank lines before it) hold for the whole
    block. A piece that does not start or end a record goes on in another block.
    """
    own = None  # block at hand
    pending: list[pa.Array] = []  # its lines since the last record that ended
    inside, no_header, line, starts, header = 0, False, 0, True, -1

    def rows(lines: list[pa.Array], sizes: np.ndarray, ends: bool) -> pa.RecordBatch:
        values = pa.concat_arrays(lines)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values)
        first = line - len(values) + offsets[:-1]
        n = len(sizes)
        return pa.RecordBatch.from_arrays([
            pa.array([own[0]] * n, pa.string()), pa.array([own[1]] * n, pa.int64()), pa.array(first, pa.int64()),
            pc.binary_join(lists, "\n"), pa.array(np.arange(n) > 0 if not starts else np.ones(n, bool)),
            pa.array([ends] * n, pa.bool_()), pa.array(first == header),
        ], ["file", "block", "line", "record", "starts", "ends", "is_header"])

    for batch in batches:
        files, places = batch.column("file"), batch.column("block").to_numpy()
        changes = np.flatnonzero(
            (places[1:] != places[:-1])
            | pc.not_equal(files.slice(1), files.slice(0, max(len(files) - 1, 0))).to_numpy(zero_copy_only=False)) + 1
        cuts = [0, *changes.tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            key = (part.column("file")[0].as_py(), part.column("block")[0].as_py())
            if key != own:
                if pending:
                    yield rows(pending, np.array([sum(map(len, pending))]), False)
                own, pending, line, header = key, [], 0, -1
                inside, no_header = part.column("inside")[0].as_py(), part.column("no_header")[0].as_py()
                starts = inside == 0
            if no_header:
                text = np.flatnonzero(~part.column("blank").to_numpy(zero_copy_only=False))
                if len(text):
                    header, no_header = line + int(text[0]), False
            after = (inside + np.cumsum(part.column("odd").to_numpy())) % 2
            last = np.flatnonzero(after == 0) + 1
            inside = int(after[-1])
            if not len(last):
                pending.append(part.column("value"))
                line += len(part)
                continue
            sizes = np.diff(last, prepend=-sum(map(len, pending)))
            line += int(last[-1])
            yield rows([*pending, part.column("value").slice(0, last[-1])], sizes, True)
            starts = True
            rest = part.column("value").slice(last[-1])
            pending = [rest] if len(rest) else []
            line += len(rest)
    if pending:
        yield rows(pending, np.array([sum(map(len, pending))]), False)


def _without_cr(text):
    return F.regexp_replace(text, "\r$", "")


def _blank(record: str):
    """Blank lines are no records; a quoted empty cell is one."""
    return F.trim(record) == ""


def require_closed_quotes(spark: SparkSession, path: str) -> None:
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), quotes.alias("n"))
    broken = lines.groupBy("file").agg(F.sum("n").alias("n")).where("n % 2 = 1").first()
    if broken is not None:
        raise ValueError(f"{broken.file}: a quoted cell is never closed")


def _all_text(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in (*names, _OVERFLOW)])


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file (or folder of files) with all columns as text.

    Column names come from the header. Empty cells, quoted or not, are NULL; ``NA`` stays
    text; a byte-order mark is dropped; doubled quotes are one quote; short rows are filled
    with NULL and rows with too many cells raise. Blank lines between records are skipped, line
    breaks inside cells kept as they are. Files without line breaks inside cells are split
    among tasks by Spark's reader; with such breaks that reader would take a whole file per task,
    so the records are put together in parallel first, whatever the size.
    """
    options = {"quote": '"', "escape": '"'}
    if spans_lines(spark, path):
        require_closed_quotes(spark, path)
        records = logical_records(spark, path)
        header = records.where("is_header").select(F.min("record")).first()[0] or ""
        names = [n or f"_c{i}" for i, n in enumerate(next(csv.reader(io.StringIO(header, newline="")), []))]
        records = records.where(~F.col("is_header") & ~_blank("record"))
        cells = F.from_csv("record", _all_text(names).toDDL(), options).alias("cells")
        raw = records.select(cells).select("cells.*")
    else:
        reader = spark.read.options(header=True, **options)
        names = reader.csv(path).columns
        raw = reader.schema(_all_text(names)).csv(path)
    first = F.when(
        F.col(_OVERFLOW).isNotNull(),
        F.raise_error(F.concat(F.lit(f"{path}: row with too many cells near "), F.col(names[0]))),
    ).otherwise(F.col(names[0]))
    return raw.select(first.alias(names[0]), *names[1:])


def with_lineage(df: DataFrame, ingested_at: str, source_file, batch_id: str) -> DataFrame:
    return df.withColumns({
        "_ingested_at": F.lit(ingested_at),
        "_source_file": source_file,
        "_batch_id": F.lit(batch_id),
    })


def utc_now_text() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def load_history_table(
    lake: Lake, raw_dir: str, file_name: str, table: str, batch_id: str, ingested_at: str
) -> int:
    """Replace one bronze table by one CSV file; the old rows stay if anything fails."""
    path = f"{raw_dir.rstrip('/')}/{file_name}"
    if not files.exists(lake.spark, path):
        raise FileNotFoundError(f"missing source file: {path}")
    raw = read_csv_text(lake.spark, path)
    tagged = with_lineage(raw, ingested_at, F.lit(file_name), batch_id)
    loaded_at = dt.datetime.fromisoformat(ingested_at)
    return lake.replace("bronze", table, tagged, batch_id, loaded_at, by_content=True)


def load_history(
    lake: Lake,
    raw_dir: str,
    batch_id: str,
    registry: Mapping[str, str] = C.HISTORY_FILES,
    ingested_at: str | None = None,
) -> DataFrame:
    """All history files, in registry order. Returns (table_name, source_file, row_count)."""
    lake.create_layers()
    summary = [
        (
            table, file_name,
            load_history_table(
                lake, raw_dir, file_name, table, batch_id, ingested_at or utc_now_text()
            ),
        )
        for file_name, table in registry.items()
    ]
    return lake.spark.createDataFrame(
        summary, "table_name string, source_file string, row_count long"
    )
