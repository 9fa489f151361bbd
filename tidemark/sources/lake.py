"""Tables in layers, with a commit log that makes writes all-or-nothing.

Layout: ``<root>/<layer>/<table>/version=<id>/[part=<p>/]*.parquet`` and one commit log
``<root>/commit_log``. Data files are written first, by ordinary Spark jobs, into a folder no
reader looks at. One small append to the commit log then makes everything the run wrote
visible together: several tables, or several parts of one table. A job or driver that dies
before that append leaves the previous state in place, and running it again is safe.

A log entry is one of
  replace  the version is the whole table (or, with parts, one part of the new whole),
  append   the version is added to the table,
  merge    the version replaces one part of the table (``rows`` = 0: the part is gone),
  past     (in snapshots only) a version was committed once and is no longer part of the table.

A commit is one folder ``commit=<number>`` of the log. Every ``FOLD`` commits all but the last few are put
into one ``snapshot=<number>``, written aside and renamed when it is whole: readers take the last
snapshot and the commits after it, so their number does not grow with the age of the lake. A driver that
dies while folding leaves the commits as they are.

Parts of a keyed table also have the range of their keys there, and a filter of them beside the data
(:mod:`tidemark.sources.key_index`). One writer per table at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import config as C
from tidemark.sources import files, key_index

FOLD = 16  # commits between two snapshots
RECENT = 4  # the last commits are not folded: another writer may have taken the same number

COMMIT_SCHEMA = (
    "seq long, layer string, table_name string, part string, version string, "
    "mode string, row_count long, loaded_at timestamp, committed_at timestamp, "
    "key_low string, key_high string, key_blocks int"
)


@dataclass(frozen=True)
class Change:
    """One part of a pending commit."""

    layer: str
    table: str
    version: str
    mode: str
    row_count: int
    part: str = ""
    loaded_at: dt.datetime | None = None
    key_low: str | None = None
    key_high: str | None = None
    key_blocks: int | None = None


@dataclass(frozen=True)
class TableState:
    """The committed state of a table at the time it was looked up."""

    lake: Lake
    layer: str
    table: str
    entries: tuple

    @property
    def exists(self) -> bool:
        return bool(self.entries)

    @property
    def parts(self) -> set[str]:
        return {e.part for e in self.entries if e.row_count > 0}

    @property
    def versions(self) -> list[str]:
        """Oldest first."""
        return list(dict.fromkeys(e.version for e in self.entries))

    def globs(self) -> list[str]:
        """One path per version, with the live parts of a version as alternatives."""
        root = self.lake.table_path(self.layer, self.table)
        by_version: dict[str, list[str]] = {}
        for e in self.entries:
            if e.row_count > 0 or not e.part:
                by_version.setdefault(e.version, []).append(e.part)
        return [
            f"{root}/version={version}" + ("" if parts == [""] else f"/part={{{','.join(parts)}}}")
            for version, parts in by_version.items()
        ]

    def read(
        self,
        schema: StructType | None = None,
        parts: Iterable[str] | None = None,
        newer_than: dt.datetime | None = None,
    ) -> DataFrame:
        """The rows; with ``parts`` those of some parts, with ``newer_than`` those of versions
        that may hold rows loaded later. Files of other versions and parts are not opened."""
        spark = self.lake.spark
        if not self.entries:
            if schema is None:
                raise FileNotFoundError(f"no committed table {self.layer}.{self.table}")
            return spark.createDataFrame([], schema)
        wanted = None if parts is None else set(parts)
        start = None if newer_than is None else int(newer_than.timestamp() * 1_000_000)
        root = self.lake.table_path(self.layer, self.table)
        paths = [
            f"{root}/version={e.version}" + (f"/part={e.part}" if e.part else "")
            for e in self.entries
            if (e.row_count > 0 or not e.part)
            and (wanted is None or e.part in wanted)
            and (start is None or e.loaded is None or e.loaded > start)
        ]
        reader = spark.read if schema is None else spark.read.schema(schema)
        if not paths and schema is not None:
            return spark.createDataFrame([], schema)
        if not paths:
            return reader.parquet(f"{root}/version={self.entries[-1].version}").drop("part").limit(0)
        return reader.parquet(*paths)


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = f"{self.root}/commit_log"

    def create_layers(self, layers: Iterable[str] = C.LAYERS) -> None:
        """Make the layer folders if they are missing; existing ones are left alone."""
        for layer in layers:
            files.make_folder(self.spark, f"{self.root}/{layer}")

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _version_path(self, layer: str, table: str, version: str) -> str:
        return f"{self.table_path(layer, table)}/version={version}"

    # --- reading ---------------------------------------------------------------------------

    def _log_folders(self) -> list[tuple[int, str]]:
        """(number, name) of the last snapshot and of the commits after it."""
        if not files.exists(self.spark, self._log):
            return []
        kinds: dict[str, list[int]] = {"commit": [], "snapshot": []}
        for name in files.child_names(self.spark, self._log):
            kind, _, number = name.partition("=")
            if kind in kinds and number.isdigit():
                kinds[kind].append(int(number))
        folded = max(kinds["snapshot"], default=-1)
        found = [(folded, f"snapshot={folded:012d}")] if folded >= 0 else []
        return found + [(n, f"commit={n:012d}") for n in sorted(kinds["commit"]) if n > folded]

    def commits(self) -> DataFrame:
        """The entries of the log, without those that a snapshot has left out."""
        paths = [f"{self._log}/{name}" for _, name in self._log_folders()]
        if not paths:
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(*paths)

    def _fold(self, last: int) -> None:
        """One snapshot of the commits up to a number; the commits of the snapshot before it go."""
        rows = self.commits().where(F.col("seq") <= last)
        table = ["layer", "table_name"]
        starts = rows.groupBy(*table).agg(F.max(F.when(F.col("mode") == "replace", F.col("seq"))).alias("start"))
        unit = F.when(F.col("mode") == "append", F.col("version")).otherwise(F.lit(""))
        live = (
            rows.where("mode <> 'past'").join(starts, table).where(F.col("seq") >= F.coalesce("start", F.lit(0)))
            .groupBy(*table, "part", unit.alias("unit"))
            .agg(F.max_by(F.struct(*rows.columns), "seq").alias("last")).select("last.*")
        )
        named = [*table, "version"]
        past = rows.select(*named).distinct().join(live.select(*named), named, "left_anti").select(
            F.lit(0).cast("long").alias("seq"), *table, F.lit("").alias("part"), "version", F.lit("past").alias("mode"))
        whole = live.unionByName(past, allowMissingColumns=True).select(*rows.columns)
        before = [n for n, name in self._log_folders() if name.startswith("snapshot")]
        aside = f"{self._log}/folding={last:012d}"
        whole.coalesce(1).write.mode("overwrite").parquet(aside)
        if not files.move(self.spark, aside, f"{self._log}/snapshot={last:012d}"):
            return
        # readers that found the snapshot before this one may still be at work: what is older than that goes
        for name in files.child_names(self.spark, self._log) if before else []:
            kind, _, number = name.partition("=")
            if kind in ("commit", "snapshot") and int(number) < before[0] + (kind == "commit"):
                files.delete(self.spark, f"{self._log}/{name}")

    def _own_commits(self, layer: str, table: str) -> DataFrame:
        return self.commits().where((F.col("layer") == layer) & (F.col("table_name") == table))

    def state(self, layer: str, table: str) -> TableState:
        """What makes up the table now: metadata, one row per part or appended batch."""
        unit = F.when(F.col("mode") == "append", F.col("version")).otherwise(F.lit(""))
        units = (
            self._own_commits(layer, table).where("mode <> 'past'")
            .groupBy("part", unit.alias("unit"))
            .agg(
                F.max_by(F.struct(
                    "seq", "version", "row_count", "loaded_at", "key_low", "key_high", "key_blocks"
                ), "seq").alias("last"),
                F.max(F.when(F.col("mode") == "replace", F.col("seq"))).alias("restarted"),
            )
            .select("part", "last.*", F.unix_micros("last.loaded_at").alias("loaded"), "restarted")
            .collect()
        )
        start = max((u.restarted for u in units if u.restarted is not None), default=0)
        live = sorted((u for u in units if u.seq >= start), key=lambda u: (u.seq, u.part))
        return TableState(self, layer, table, tuple(live))

    def committed_versions(self, layer: str, table: str) -> set[str]:
        """Every version ever committed for a table, replaced ones included."""
        own = self._own_commits(layer, table)
        return {r.version for r in own.select("version").distinct().collect()}

    def has_newer(self, layer: str, table: str, moment: dt.datetime) -> bool:
        """Whether some version of the table may hold rows loaded after a moment."""
        start = int(moment.timestamp() * 1_000_000)
        return any(e.loaded is None or e.loaded > start for e in self.state(layer, table).entries)

    def row_counts(self, layer: str) -> dict[str, int]:
        """Table -> rows of its last full version, for all tables of a layer."""
        own = self.commits().where((F.col("layer") == layer) & (F.col("mode") == "replace"))
        last = own.groupBy("table_name").agg(F.max_by("row_count", "seq").alias("n")).collect()
        return {r.table_name: r.n for r in last}

    def read_version(self, layer: str, table: str, version: str) -> DataFrame:
        return self.spark.read.parquet(self._version_path(layer, table, version))

    def read_versions(self, layer: str, table: str, versions: list[str]) -> DataFrame:
        return self.spark.read.parquet(*(self._version_path(layer, table, v) for v in versions))

    def read(self, layer: str, table: str, schema: StructType | None = None) -> DataFrame:
        """The committed rows. ``schema`` stands in when the table was never written."""
        return self.state(layer, table).read(schema)

    # --- writing ---------------------------------------------------------------------------

    def stage(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        version: str,
        mode: str,
        by_part: bool = False,
        loaded_at: dt.datetime | None = None,
        keys: Sequence[str] = (),
        by_content: bool = False,
    ) -> list[Change]:
        """Write a version nobody sees yet and check that every row arrived.

        With ``by_part`` the column ``part`` decides the folder; with ``keys`` too, each part gets
        its range and filter of keys. The rows going in are counted while they are written; the count
        read back comes from the file footers. ``by_content`` also compares the sum of all rows'
        hashes, whatever their order, with that of the stored copy, which is read for it. ``loaded_at``
        states that no row of the version was loaded later than that.
        """
        if version in self.committed_versions(layer, table):
            raise ValueError(f"version {version} of {layer}.{table} is already committed")
        path = self._version_path(layer, table, version)
        sent = Observation()
        hashes = F.coalesce(F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).cast("decimal(20,0)")), F.lit(0))
        content = [hashes.alias("content")] if by_content else []
        watched = df.observe(sent, F.count(F.lit(1)).alias("rows"), *content)
        writer = watched.write.mode("overwrite")
        (writer.partitionBy("part") if by_part else writer).parquet(path)
        ranges = {}
        if by_part and keys and sent.get["rows"]:
            kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
            rows = self.spark.read.schema(f"{kinds}, part string").parquet(path)
            ranges = {r.part: r for r in key_index.ranges(rows, keys).collect()}  # a row a part
            stored = {part: r.n for part, r in ranges.items()}
            key_index.write_filters(
                rows, keys, {p: key_index.blocks_for(n) for p, n in stored.items()},
                f"{self.table_path(layer, table)}/{key_index.FOLDER}/version={version}")
        elif by_part:
            stored = {
                r.part: r["count"]
                for r in self.spark.read.schema("part string").parquet(path)
                .groupBy("part").count().collect()
            } if sent.get["rows"] else {}
        else:
            stored = {"": self.spark.read.parquet(path).count()}
        if sum(stored.values()) != sent.get["rows"]:
            raise ValueError(
                f"row count mismatch for {layer}.{table}: "
                f"read {sent.get['rows']}, stored {sum(stored.values())}"
            )
        if by_content and sent.get["rows"]:
            copy = self.spark.read.schema(df.schema).parquet(path)
            if copy.agg(hashes.alias("content")).first().content != sent.get["content"]:
                raise ValueError(f"stored rows of {layer}.{table} differ from those that were read")
        return [
            Change(
                layer, table, version, mode, n, part, loaded_at,
                *((ranges[part].low, ranges[part].high, key_index.blocks_for(n)) if ranges else ()))
            for part, n in sorted(stored.items())
        ]

    def commit(self, changes: Iterable[Change]) -> None:
        """Make staged changes visible, all of them at once (one file is appended)."""
        folders = self._log_folders()
        seq = max((n for n, _ in folders), default=-1) + 1
        now = dt.datetime.now(dt.timezone.utc)
        rows = [
            (seq, c.layer, c.table, c.part, c.version, c.mode, c.row_count, c.loaded_at, now,
             c.key_low, c.key_high, c.key_blocks)
            for c in changes
        ]
        (
            self.spark.createDataFrame(rows, COMMIT_SCHEMA)
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self._log}/commit={seq:012d}")
        )
        if sum(name.startswith("commit") for _, name in folders) >= FOLD + RECENT:
            self._fold(seq - RECENT)

    def replace(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        version: str,
        loaded_at: dt.datetime | None = None,
        by_content: bool = False,
    ) -> int:
        """Full refresh; the old version stays readable until the new one is complete."""
        changes = self.stage(
            layer, table, df, version, "replace", loaded_at=loaded_at, by_content=by_content)
        self.commit(changes)
        return changes[0].row_count

    def compact(self, layer: str, table: str, version: str) -> int:
        """Rewrite a table of many small appended loads as one version of well-sized files. A
        table of parts keeps its parts."""
        state = self.state(layer, table)
        if any(state.parts):
            part = F.regexp_extract(F.col("_metadata.file_path"), "part=([^/]+)/", 1)
            rows = state.read().withColumn("part", part).hint("rebalance", "part")
            changes = self.stage(layer, table, rows, version, "replace", by_part=True)
            self.commit(changes)
            return sum(c.row_count for c in changes)
        times = [e.loaded for e in state.entries]
        latest = None
        if times and None not in times:
            epoch = dt.datetime.fromtimestamp(0, dt.timezone.utc)
            latest = epoch + dt.timedelta(microseconds=max(times))
        return self.replace(layer, table, state.read().hint("rebalance"), version, latest)

    def publish(self, layers: Iterable[str] = C.LAYERS) -> list[str]:
        """Make every committed table a view ``<layer>.<table>`` in the session's catalog, so
        that SQL can name it. A view shows the state it was published with: call this after
        each run. Returns the names."""
        known = self.commits().select("layer", "table_name").distinct().collect()
        names = []
        for layer, table in sorted(tuple(r) for r in known):
            if layer not in layers:
                continue
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
            selects = " UNION ALL ".join(
                f"SELECT * FROM parquet.`{path}`" for path in self.state(layer, table).globs()
            )
            self.spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{table}` AS {selects}")
            names.append(f"{layer}.{table}")
        return names

    def drop_old_versions(self, layer: str, table: str) -> list[str]:
        """Delete everything below a table that is not part of it: replaced versions and what
        interrupted runs left. Call it with no reader or writer active. Returns the names."""
        live = {f"version={v}" for v in self.state(layer, table).versions}
        path = self.table_path(layer, table)
        filters = f"{path}/{key_index.FOLDER}"
        if files.exists(self.spark, filters):
            for name in set(files.child_names(self.spark, filters)) - live:
                files.delete(self.spark, f"{filters}/{name}")
        gone = sorted(set(files.child_names(self.spark, path)) - live - {key_index.FOLDER})
        for name in gone:
            files.delete(self.spark, f"{path}/{name}")
        return gone
