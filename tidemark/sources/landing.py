"""Exactly-once load of JSON Lines files from the landing zone into the live bronze tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from tidemark import config as C
from tidemark.session import scratch_dir
from tidemark.sources import file_blocks, files
from tidemark.sources.csv_history import utc_now_text, with_lineage
from tidemark.sources.lake import Change, Lake

log = logging.getLogger(__name__)

LOG_TABLE = "ingestion_log"
LOG_SCHEMA = (
    "source_file string, entity string, target_table string, file_sha256 string, "
    "row_count int, batch_id string, loaded_at timestamp, "
    "file_length long, modified_at timestamp"
)
LISTING_SCHEMA = (
    "path string, source_file string, file_length long, modified_at timestamp"
)

# SHA-256 of no bytes: a fixed value.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def landing_schema(entity: str, columns: Sequence[str] | None = None) -> StructType:
    names = columns or C.BRONZE_COLUMNS[C.LANDING_TABLES[entity]]
    return StructType([StructField(n, StringType()) for n in (*names, *C.LINEAGE)])


# --- listing and fingerprints ---------------------------------------------------------------


def _file_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]+$", 0)


def _decoded(name: Column) -> Column:
    """Metadata columns and ``inputFiles`` escape characters; the log and listings do not."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def list_landing(spark: SparkSession, landing_dir: str, entity: str) -> DataFrame:
    """Complete files of one entity: ``*.jsonl``, never ``*.jsonl.tmp``. Reads no content.

    The listing is taken once, by an executor, and written to the scratch folder: a file that arrives later is
    in the next one. Names do not come to the driver.
    """
    folder = files.qualified(spark, f"{landing_dir.rstrip('/')}/{entity}")
    if file_blocks.reachable(folder):
        found = file_blocks.list_folder(spark, folder, ".jsonl")
    else:
        found = _scanned_listing(spark, folder)
    kept = scratch_dir(spark, "listing")
    found.select(
        "path", F.concat(F.lit(f"{entity}/"), _file_name(F.col("path"))).alias("source_file"),
        "file_length", "modified_at",
    ).write.parquet(kept)
    return spark.read.schema(LISTING_SCHEMA).parquet(kept)


def _scanned_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The listing by Spark's file scan, for file systems that only the JVM opens. A scan gives no row for a
    zero-byte file, so such files are added from its file index."""
    scan = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl").load(folder)
    seen = scan.select("path", F.col("length").alias("file_length"), F.col("modificationTime").alias("modified_at"))
    plain = F.regexp_replace("path", "^file:/+", "file:/")
    listed = spark.createDataFrame([(p,) for p in scan.inputFiles()], "path string").select(
        _decoded(F.col("path")).alias("path"))
    empty = listed.withColumn("_plain", plain).join(seen.select(plain.alias("_plain")), "_plain", "left_anti").select(
        "path", F.lit(0).cast("long").alias("file_length"), F.lit(None).cast("timestamp").alias("modified_at"))
    return seen.unionByName(empty)


def classify(listing: DataFrame, loaded: DataFrame, rehash_known: bool = True) -> DataFrame:
    """Compare a listing with the ingestion log.

    ``status`` is ``new`` (not in the log), ``known`` (in the log with the same length and
    modification time) or ``check`` (in the log, but the content has to be compared). With
    ``rehash_known``, the default, every known file is compared by content.
    """
    logged = loaded.select(
        "source_file",
        F.col("file_sha256").alias("logged_sha256"),
        F.col("file_length").alias("logged_length"),
        F.col("modified_at").alias("logged_modified_at"),
    )
    untouched = (F.col("file_length") == F.col("logged_length")) & (
        F.col("modified_at").eqNullSafe(F.col("logged_modified_at"))
    )
    status = (
        F.when(F.col("logged_sha256").isNull(), "new")
        .when(F.lit(not rehash_known) & untouched, "known")
        .otherwise("check")
    )
    return (
        listing.join(logged, "source_file", "left")
        .withColumn("status", status)
        .drop("logged_length", "logged_modified_at")
    )


def fingerprints(spark: SparkSession, listing: DataFrame, entity: str) -> DataFrame:
    """(source_file, file_sha256) of the listed files: SHA-256 of their bytes, whatever their
    size, computed on the executors in constant memory.

    Where the file system allows it, a task reads a file in blocks, and only names are shuffled.
    """
    listing = listing.select("path", "source_file", "file_length")
    scheme = F.substring_index("path", ":", 1)
    foreign = listing.where(~scheme.isin(*file_blocks.SCHEMES))
    if foreign.isEmpty():
        return listing.join(file_blocks.digests(listing), "path").select("source_file", "file_sha256")
    return line_fingerprints(spark, listing, entity)


def line_fingerprints(spark: SparkSession, listing: DataFrame, entity: str) -> DataFrame:
    """``fingerprints`` through Spark's text scan, for file systems that only the JVM opens.

    The lines of a file are brought together in their order and fed to one running digest. The
    text reader leaves out a byte-order mark and does not tell whether the last line ends; both follow
    from the length of the file.
    """
    empty = F.col("file_length") == 0
    result = listing.where(empty).select("source_file", F.lit(EMPTY_SHA256).alias("file_sha256"))
    paths = [r.path for r in listing.where(~empty).select("path").collect()]
    if not paths:
        return result
    lines = spark.read.text(paths, lineSep="\n").select(
        F.concat(F.lit(f"{entity}/"), _decoded(F.col("_metadata.file_name"))).alias("source_file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.col("value").cast("binary").alias("line"),
    )
    in_order = lines.repartition("source_file").sortWithinPartitions("source_file", "block", "id")
    digests = in_order.select("source_file", "size", "line").mapInArrow(
        _line_digests(), "source_file string, file_sha256 string"
    )
    return result.unionByName(digests)


def _line_digests():
    """Digests of files whose lines come one after the other, in order. (A closure, so that
    executors need no copy of this package.)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, length, plain, marked = None, 0, 0, None, None

        def result() -> pa.RecordBatch:
            # ``length`` counts an end for every line but the last
            digest = marked if size - length >= 3 else plain
            if size - length in (1, 4):
                digest.update(b"\n")
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([digest.hexdigest()])], ["source_file", "file_sha256"]
            )

        for batch in batches:
            for file, file_size, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    if name is not None:
                        yield result()
                    name, size, length = file, file_size, len(line)
                    plain, marked = hashlib.sha256(line), hashlib.sha256(b"\xef\xbb\xbf" + line)
                else:
                    length += 1 + len(line)
                    for digest in (plain, marked):
                        digest.update(b"\n")
                        digest.update(line)
        if name is not None:
            yield result()

    return run


# --- parsing --------------------------------------------------------------------------------


def parse_lines(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per non-blank line: text columns, plus ``problem`` where the line is bad.

    The line is parsed as the only element of an array, so anything after the object
    (``{"a":1} x``) is malformed too. Scalars keep their text, null and missing fields are
    NULL, and so is an empty string, which the bronze tables do not tell from NULL.
    """
    fields = F.from_json(
        F.concat(F.lit("["), F.col("value"), F.lit("]")),
        "array<map<string,string>>",
        {"allowSingleQuotes": "false"},
    )
    record = F.when(F.size(fields) == 1, fields[0])
    extra = F.array_except(F.map_keys("_record"), F.array(*[F.lit(c) for c in columns]))
    problem = (
        F.when(F.col("_record").isNull(), F.lit("invalid JSON"))
        .when(F.size(extra) > 0, F.concat(F.lit("unexpected field "), extra[0]))
    )
    return (
        lines.where(F.col("value").rlike(r"\S"))
        .withColumn("_record", record)
        .withColumn("problem", problem)
        .select(
            *[c for c in lines.columns if c != "value"],
            *[F.nullif(F.col("_record")[c], F.lit("")).alias(c) for c in columns],
            "problem",
        )
    )


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with the name of their file. Large files are split among tasks."""
    return spark.read.text(list(paths)).select(
        "value", _decoded(F.col("_metadata.file_name")).alias("file_name")
    )


def locate_problems(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(file_name, line_no, problem) of every bad line, for error messages.

    Only run for files known to hold a bad line. Line numbers come from per-block line
    counts: within one block, generated ids grow by one per line, and the number of lines in
    earlier blocks of the file is a running sum over one row per block.
    """
    lines = spark.read.text(list(paths)).select(
        "value",
        _decoded(F.col("_metadata.file_name")).alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    block = ["file_name", "block"]
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = (
        lines.groupBy(*block)
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    )
    bad = parse_lines(lines, columns).where(F.col("problem").isNotNull())
    return bad.join(blocks, block).select(
        "file_name",
        (F.col("before") + F.col("id") - F.col("first_id") + 1).alias("line_no"),
        "problem",
    )


# --- loading --------------------------------------------------------------------------------


SHOWN_PROBLEMS = 20
GROUP_FILES = 10_000  # new files opened and committed together


class BadLandingFile(ValueError):
    """Landing files hold lines that cannot be loaded. The message names the first ones; ``problems`` is
    all of them: (file_name, line_no, problem)."""

    def __init__(self, problems: DataFrame):
        self.problems = problems
        first = problems.orderBy("file_name", "line_no").limit(SHOWN_PROBLEMS + 1).collect()
        shown = [f"{r.file_name}: {r.problem} on line {r.line_no}" for r in first[:SHOWN_PROBLEMS]]
        super().__init__("; ".join(shown) + ("; and more" if len(first) > SHOWN_PROBLEMS else ""))


def live_table(lake: Lake, entity: str) -> DataFrame:
    """Committed rows of a live table; empty with its declared columns before any load."""
    table = C.LANDING_TABLES[entity]
    return lake.read("bronze", table, schema=landing_schema(entity))


def ingestion_log(lake: Lake) -> DataFrame:
    schema = StructType.fromDDL(LOG_SCHEMA)
    return lake.read("bronze", LOG_TABLE, schema=schema)


def _stage_rows(
    lake: Lake, entity: str, paths: list[str], columns: Sequence[str], batch_id: str, version: str, ingested_at: str
) -> tuple[list[Change], list[str]]:
    """Write the rows of the good files. Returns the pending change and the bad file names.

    Bad lines are counted while the rows are written. Only if there are any are their files
    looked up and the batch written again without them.
    """
    spark, table = lake.spark, C.LANDING_TABLES[entity]
    parsed = parse_lines(read_lines(spark, paths), columns)
    source = F.concat(F.lit(f"{entity}/"), F.col("file_name"))

    def stage(rows: DataFrame) -> list[Change]:
        tagged = with_lineage(rows.where("problem IS NULL"), ingested_at, source, batch_id)
        return lake.stage(
            "bronze", table, tagged.select(*columns, *C.LINEAGE), version, "append",
            loaded_at=dt.datetime.fromisoformat(ingested_at), by_content=True,
        )

    watch = Observation()
    changes = stage(parsed.observe(watch, F.count("problem").alias("bad")))
    if not watch.get["bad"]:
        return changes, []
    names = parsed.where("problem IS NOT NULL").select("file_name").distinct().collect()
    bad = [r.file_name for r in names]
    return stage(_without(parsed, bad)), bad


def _without(rows: DataFrame, bad: Sequence[str]) -> DataFrame:
    """Rows of other files than the named ones, of which there are at most GROUP_FILES."""
    named = rows.sparkSession.createDataFrame([(n,) for n in bad], "file_name string")
    return rows.join(F.broadcast(named), "file_name", "left_anti")


def ingest_entity(
    lake: Lake,
    landing_dir: str,
    entity: str,
    batch_id: str,
    ingested_at: str | None = None,
    columns: Sequence[str] | None = None,
    rehash_known: bool = True,
    listing: DataFrame | None = None,
    group_files: int = GROUP_FILES,
) -> dict[str, int]:
    """Load the new files of one entity; rows and log entries become visible together. More than
    ``group_files`` new files are loaded in several commits, so the driver never holds more names.

    Known files are compared by content (without ``rehash_known`` only where length or
    modification time differ) and skipped; files that changed after they were loaded are reported and not
    loaded again. Files with a bad line are left out and named in the error that is raised
    after the good ones are committed.
    """
    spark = lake.spark
    counts = {"new": 0, "skipped": 0, "changed": 0, "rows": 0}
    folder = f"{landing_dir.rstrip('/')}/{entity}"
    if not files.exists(spark, folder):
        log.warning("no landing folder for %s, skipping", entity)
        return counts
    columns = list(columns or C.BRONZE_COLUMNS[C.LANDING_TABLES[entity]])
    loaded = ingestion_log(lake).where(F.col("entity") == entity)
    if listing is None:
        listing = list_landing(spark, landing_dir, entity)
    states = classify(listing, loaded, rehash_known)

    by_status = {r.status: r["count"] for r in states.groupBy("status").count().collect()}
    counts["skipped"] = by_status.get("known", 0)
    if by_status.get("check"):
        kept = scratch_dir(spark, "changed")
        changed_files(spark, states, entity).write.parquet(kept)
        differing = spark.read.schema("source_file string").parquet(kept)
        counts["changed"] = differing.count()
        counts["skipped"] += by_status["check"] - counts["changed"]
        for r in differing.orderBy("source_file").limit(SHOWN_PROBLEMS).collect():
            log.warning("changed after it was loaded, not loaded again: %s", r.source_file)
        if counts["changed"] > SHOWN_PROBLEMS:
            log.warning("%d files of %s changed after they were loaded; all are in %s", counts["changed"], entity, kept)
    if not by_status.get("new"):
        return counts

    new_files = states.where("status = 'new'").drop("logged_sha256", "status")
    groups = -(-by_status["new"] // group_files)
    ingested_at = ingested_at or utc_now_text()
    problems: list[DataFrame] = []
    for group in range(groups):
        # a run that is taken up again finds some groups committed, and cuts the rest anew
        version = batch_id if groups == 1 else f"{batch_id}-{uuid.uuid4().hex[:12]}"
        part = new_files.where(F.pmod(F.xxhash64("source_file"), F.lit(groups)) == group)
        found = _ingest_files(lake, entity, part, columns, batch_id, version, ingested_at)
        counts["new"] += found[0]
        counts["rows"] += found[1]
        problems += found[2]
    if problems:
        raise BadLandingFile(reduce(DataFrame.unionByName, problems))
    return counts


def changed_files(spark: SparkSession, states: DataFrame, entity: str) -> DataFrame:
    """(source_file) of the files of ``classify`` whose content is not what was loaded."""
    suspects = states.where("status = 'check'")
    return suspects.join(fingerprints(spark, suspects, entity), "source_file").where(
        "file_sha256 <> logged_sha256").select("source_file")


def _ingest_files(
    lake: Lake, entity: str, new_files: DataFrame, columns: Sequence[str], batch_id: str, version: str,
    ingested_at: str,
) -> tuple[int, int, list[DataFrame]]:
    """Rows and log entries of one group of new files, in one commit. Returns the numbers of files and rows,
    and the problems where files were left out."""
    spark = lake.spark
    with_rows = [r.path for r in new_files.where("file_length > 0").select("path").collect()]
    changes: list[Change] = []
    bad: list[str] = []
    if with_rows:
        changes, bad = _stage_rows(lake, entity, with_rows, columns, batch_id, version, ingested_at)

    good = new_files
    if bad:
        good = _without(new_files.withColumn("file_name", _file_name(F.col("path"))), bad).drop("file_name")
    if changes and changes[0].row_count:
        staged = lake.read_version("bronze", C.LANDING_TABLES[entity], version)
        per_file = staged.groupBy(F.col("_source_file").alias("source_file")).agg(
            F.count("*").cast("int").alias("loaded_rows")
        )
    else:
        per_file = spark.createDataFrame([], "source_file string, loaded_rows int")
    entries = (
        good.join(fingerprints(spark, good, entity), "source_file")
        .join(per_file, "source_file", "left")
        .select(
            "source_file",
            F.lit(entity).alias("entity"),
            F.lit(f"bronze.{C.LANDING_TABLES[entity]}").alias("target_table"),
            "file_sha256",
            F.coalesce("loaded_rows", F.lit(0)).alias("row_count"),
            F.lit(batch_id).alias("batch_id"),
            F.lit(ingested_at).cast("timestamp").alias("loaded_at"),
            "file_length",
            "modified_at",
        )
    )
    logged = lake.stage("bronze", LOG_TABLE, entries, f"{version}-{entity}", "append")
    if logged[0].row_count:
        lake.commit([*changes, *logged])
    problems = []
    if bad:
        left_out = set(bad)
        paths = [p for p in with_rows if p.rsplit("/", 1)[-1] in left_out]
        problems.append(locate_problems(spark, paths, columns))
    return logged[0].row_count, changes[0].row_count if changes else 0, problems


def ingest_landing(
    lake: Lake,
    landing_dir: str,
    batch_id: str,
    ingested_at: str | None = None,
    entities: Mapping[str, str] = C.LANDING_TABLES,
    rehash_known: bool = True,
) -> DataFrame:
    """All entities of the landing zone. Returns (entity, status, files, rows): rows loaded from
    new files, 0 for others."""
    summary = []
    for entity in entities:
        counts = ingest_entity(
            lake, landing_dir, entity, batch_id, ingested_at, rehash_known=rehash_known
        )
        summary += [
            (entity, status, counts[status], counts["rows"] if status == "new" else 0)
            for status in ("new", "skipped", "changed")
        ]
    return lake.spark.createDataFrame(
        summary, "entity string, status string, files int, rows long"
    )


# --- export ---------------------------------------------------------------------------------


def export_landing(rows: DataFrame, landing_dir: str, entity: str, tag: str) -> list[str]:
    """Write rows as ``<entity>_<tag>_<n>.jsonl`` for a later load to pick up: one object per
    line, nulls spelled out. Files are written elsewhere and renamed into place when they
    are complete, so a loader never sees half a file."""
    spark = rows.sparkSession
    root = landing_dir.rstrip("/")
    staging = f"{root}/.export/{entity}_{tag}"
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(staging)
    names = files.move_into(
        spark, staging, f"{root}/{entity}", lambda n: f"{entity}_{tag}_{n:05d}.jsonl"
    )
    files.delete(spark, staging)
    return names
