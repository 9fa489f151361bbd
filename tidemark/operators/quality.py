"""Data-quality checks: each is a query for failing rows, and no rows means it passed."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.upsert import rows_with_keys
from tidemark.sources import key_index
from tidemark.sources.lake import Lake

ERROR, WARN = "error", "warn"


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (NULLs are not values)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once (NULLs are alike)."""
    return df.groupBy(*columns).agg(F.count("*").alias("duplicate_count")).where(
        "duplicate_count > 1"
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_flagged(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with how often they occur. NULL passes."""
    return (
        df.groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
        .where(~F.col("value_field").isin(*values))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, each with the number of child rows that carry it.

    Children are counted per value before they meet the parents: a hot value travels once per
    map task, and the join reuses the partitioning of the count.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("from_field"))
        .agg(F.count("*").alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias("from_field"))
    return used.join(known, "from_field", "left_anti")


@dataclass(frozen=True)
class Check:
    """A named check. Failing rows are ``rows`` of ``table`` where ``predicate`` holds, or the
    result of a query of its own; ``weight`` names the column that says how many failing
    table rows one result row stands for."""

    name: str
    failing: DataFrame
    severity: str = ERROR
    table: str | None = None
    predicate: Column | None = None
    weight: str | None = None


class Suite:
    """Checks over named relations, collected with one line each."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables
        self.checks: list[Check] = []

    def not_null(self, table: str, column: str) -> None:
        df = self.tables[table]
        self.checks.append(Check(
            f"not_null_{table}_{column}", not_null(df, column), ERROR, table, F.col(column).isNull()
        ))

    def not_flagged(self, table: str, column: str, severity: str = WARN) -> None:
        df = self.tables[table]
        self.checks.append(Check(
            f"not_flagged_{table}_{column}", not_flagged(df, column), severity, table, F.col(column)
        ))

    def rows_where(self, name: str, table: str, predicate: Column, columns: Sequence[str],
                   severity: str = ERROR) -> None:
        failing = self.tables[table].where(predicate).select(*columns)
        self.checks.append(Check(name, failing, severity, table, predicate))

    def unique(self, table: str, column: str) -> None:
        self.checks.append(Check(f"unique_{table}_{column}", unique(self.tables[table], column)))

    def unique_combination(self, table: str, columns: Sequence[str]) -> None:
        name = f"unique_combination_{table}_{'_'.join(columns)}"
        self.checks.append(Check(name, unique_combination(self.tables[table], columns)))

    def accepted_values(self, table: str, column: str, values: Sequence[str]) -> None:
        failing = accepted_values(self.tables[table], column, values)
        self.checks.append(Check(f"accepted_values_{table}_{column}", failing))

    def relationships(self, table: str, column: str, parent: str, parent_column: str) -> None:
        failing = relationships(self.tables[table], column, self.tables[parent], parent_column)
        name = f"relationships_{table}_{column}_{parent}"
        self.checks.append(Check(name, failing, weight="n_records"))

    def query(self, name: str, failing: DataFrame, severity: str = ERROR) -> None:
        self.checks.append(Check(name, failing, severity))


def duplicates_since(lake: Lake, layer: str, table: str, keys: Sequence[str], version: str) -> tuple[DataFrame, int]:
    """(keys..., duplicate_count) of the keys of a keyed table that a version has made double, and the number of
    older parts opened for it.

    What was unique before need not be compared again: only the keys of the parts that the version wrote are
    counted, together with the rows of older parts that share one of them. Older parts are opened where their
    range and filter of keys let one of them through. Keys with a NULL match nothing.
    """
    state = lake.state(layer, table)
    written = {e.part for e in state.entries if e.version == version and e.row_count > 0}
    paths = [f"{lake.table_path(layer, table)}/version={version}/part={p}" for p in sorted(written)]
    if not paths:
        return state.read().select(*keys).limit(0).withColumn("duplicate_count", F.lit(0).cast("long")), 0
    new = lake.spark.read.parquet(*paths).select(*keys).where(key_index.whole_key(keys))
    older = replace(state, entries=tuple(e for e in state.entries if e.version != version))
    rows, opened = rows_with_keys(older, broadcast_if_small(new.distinct()), keys)
    every = new if rows is None else new.unionByName(rows.select(*keys))
    return unique_combination(every, keys), len(opened)


def report(suite: Suite, rows_only: bool = False) -> DataFrame | None:
    """(check, severity, failures, status) of every check (or of the row checks), as one lazy relation.

    All row checks of a table share a single aggregate over it; every other check is one
    aggregate over its failing rows.
    """
    counted: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for check in suite.checks:
        if check.table is not None:
            by_table.setdefault(check.table, []).append(check)
        elif not rows_only:
            counted.append(check.failing.agg(_failures(check).alias("failures")).select(
                F.lit(check.name).alias("check"), F.lit(check.severity).alias("severity"), "failures"
            ))
    for table, checks in by_table.items():
        totals = suite.tables[table].agg(F.array(*[
            F.struct(
                F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"),
                F.count_if(c.predicate).alias("failures"),
            ) for c in checks
        ]).alias("counts"))
        counted.append(totals.select(F.inline("counts")))
    if not counted:
        return None
    merged = counted[0]
    for part in counted[1:]:
        merged = merged.unionByName(part)
    return _with_status(merged)


def _failures(check: Check) -> Column:
    return F.count("*") if check.weight is None else F.coalesce(F.sum(check.weight), F.lit(0))


def _with_status(merged: DataFrame) -> DataFrame:
    failed = F.when(F.col("severity") == ERROR, "fail").otherwise("warn")
    return merged.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(failed))


class ChecksFailed(RuntimeError):
    """At least one check of severity ``error`` has failing rows."""


def run_checks(
    suite: Suite, lake: Lake | None = None, run_id: str | None = None, raise_on_error: bool = True
) -> DataFrame:
    """Run a suite. With a lake, the failing rows of every check replace its audit table: one
    that passed is left with none. Warnings never raise.

    Row checks of a table are counted together first, and only those that fail are run again to store
    their rows. The rows of any other check are computed once: they are written, and counted in what was written.
    """
    spark = next(iter(suite.tables.values())).sparkSession
    schema = "check string, severity string, failures long, status string"
    if lake is None:
        results = report(suite).collect()  # one row per check
    else:
        results = _run_and_store(suite, lake, run_id or uuid.uuid4().hex)
    failed = [r.check for r in results if r.status == "fail"]
    if failed and raise_on_error:
        raise ChecksFailed(", ".join(failed))
    return spark.createDataFrame(results, schema)


def _run_and_store(suite: Suite, lake: Lake, run_id: str) -> list:
    counted = report(suite, rows_only=True)
    counts = {r.check: r.failures for r in counted.collect()} if counted is not None else {}
    stored = lake.row_counts("audit")
    changes = []
    for check in suite.checks:
        if check.name in counts:
            rows = check.failing if counts[check.name] else check.failing.limit(0)
            if counts[check.name] or stored.get(check.name) != 0:  # 0: nothing is there to be replaced
                changes += lake.stage("audit", check.name, rows, run_id, "replace")
            continue
        staged = lake.stage("audit", check.name, check.failing, run_id, "replace")
        kept = lake.read_version("audit", check.name, run_id)
        counts[check.name] = kept.agg(_failures(check)).first()[0] if check.weight else staged[0].row_count
        if staged[0].row_count or stored.get(check.name) != 0:
            changes += staged
    if changes:
        lake.commit(changes)
    lines = lake.spark.createDataFrame(
        [(c.name, c.severity, int(counts[c.name])) for c in suite.checks],
        "check string, severity string, failures long")
    return _with_status(lines).collect()  # one row per check
