"""Slowly changing history (type 2), by comparing columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.sources import files
from tidemark.sources.lake import Lake

META = ("scd_id", "updated_at", "valid_from", "valid_to")


def open_versions(state: DataFrame, key: str, as_of: Column) -> DataFrame:
    """A state as the first, open versions of its keys."""
    started = as_of.cast("timestamp")
    identity = F.md5(F.concat_ws(
        "|",
        F.coalesce(F.col(key).cast("string"), F.lit("")),
        started.cast("timestamp_ntz").cast("string"),
    ))
    return state.withColumns({
        "scd_id": identity,
        "updated_at": started,
        "valid_from": started,
        "valid_to": F.lit(None).cast("timestamp"),
    })


def compare_versions(
    current: DataFrame, state: DataFrame, key: str, check: Sequence[str], as_of: Column
) -> DataFrame:
    """Open versions after the state of ``as_of``, with those it closed.

    One full outer join on the key. A key that is new opens a version; one whose checked
    columns differ (NULL counts as a value) closes its version and opens another; an unchanged
    or vanished key keeps what it has. Each matched pair unfolds into one or two rows on the
    spot, so neither side is read or shuffled twice.
    """
    incoming = open_versions(state, key, as_of)
    columns = incoming.columns
    old = current.select(F.col(key).alias("_key"), F.struct(*columns).alias("old"))
    new = incoming.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))
    pairs = old.join(new, "_key", "full_outer")

    same = F.lit(True)
    for c in check:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    closed = F.col("old").withField("valid_to", as_of.cast("timestamp"))
    versions = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull() | same, F.array("old"))
        .otherwise(F.array(closed, F.col("new")))
    )
    return pairs.select(F.explode(versions).alias("v")).select("v.*")


def snapshot_check(
    history: DataFrame | None, state: DataFrame, key: str, check: Sequence[str], as_of: Column
) -> DataFrame:
    """The whole history after one more state. The key must be unique within the state."""
    if history is None:
        return open_versions(state, key, as_of)
    moved = compare_versions(history.where("valid_to IS NULL"), state, key, check, as_of)
    return history.where("valid_to IS NOT NULL").unionByName(moved)


def valid_at(history: DataFrame, moment: Column) -> DataFrame:
    """The versions that were valid at a moment."""
    return history.where(
        (F.col("valid_from") <= moment)
        & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))
    )


HOT_SHARE = 256  # a key with at least this part of all facts is cut by time
SLICES = 64


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    moment: str,
    columns: Sequence[str],
    hot_share: int = HOT_SHARE,
    slices: int = SLICES,
) -> DataFrame:
    """Every fact with the ``columns`` of the version of its key that was valid at its ``moment``.

    Facts and versions are put in one relation, ordered by key and time, and the last version is
    carried forward: one sort and one pass instead of a range condition for each pair. A fact whose
    key or moment is NULL, or that lies before the first version or in a gap, has NULL there and is
    kept. Versions of a key must not overlap, as in a type-2 history.

    Keys that at least one in ``hot_share`` facts has (so few) are cut into time slices of about equal numbers
    of facts; a version goes to the slices it was valid in. Facts of one very common moment
    are dealt to several slices by a hash. Facts are read several times: pass a written table.
    """
    taken = [c for c in facts.columns if c in columns]
    if taken:
        raise ValueError(f"columns of both sides: {', '.join(taken)}")
    placed = facts.select(
        F.col(key).alias("_key"), F.col(moment).cast("timestamp").alias("_at"), F.struct(*facts.columns).alias("_fact"))
    known = placed.where(F.col("_key").isNotNull() & F.col("_at").isNotNull())
    lost = placed.where(F.col("_key").isNull() | F.col("_at").isNull())

    sliced, bounds = time_slices(known, hot_share, slices)
    cold = F.col("_cuts").isNull()
    left = sliced.withColumn("_version", F.lit(None).cast(_version_type(history, columns)))
    versions = history.select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"),
        F.struct(*columns, F.col("valid_to").alias("_until")).alias("_version"),
    ).where(F.col("_key").isNotNull() & F.col("_at").isNotNull())
    begun = _below(F.unix_micros("_at"))
    last = F.when(F.col("_version._until").isNull(), slices - 1).otherwise(
        _up_to(F.unix_micros("_version._until")))
    right = versions.join(F.broadcast(bounds), "_key", "left").select(
        "_key", "_at", F.lit(None).cast(placed.schema["_fact"].dataType).alias("_fact"),
        F.explode(F.when(cold, F.array(F.lit(0))).otherwise(F.sequence(begun, F.greatest(begun, last)))).alias(
            "_slice"), "_version")
    # versions before facts of the same moment
    order = Window.partitionBy("_key", "_slice").orderBy("_at", F.col("_fact").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = left.unionByName(right).withColumn("_valid", F.last("_version", ignorenulls=True).over(order))
    alive = F.col("_valid._until").isNull() | (F.col("_valid._until") > F.col("_at"))
    met = carried.where(F.col("_fact").isNotNull()).select(
        "_fact.*", *(F.when(alive, F.col("_valid")[c]).alias(c) for c in columns))
    types = {f.name: f.dataType for f in met.schema}
    return met.unionByName(lost.select("_fact.*", *(F.lit(None).cast(types[c]).alias(c) for c in columns)))


def _below(t: Column) -> Column:
    return F.size(F.filter("_cuts", lambda c: c < t))


def _up_to(t: Column) -> Column:
    return F.size(F.filter("_cuts", lambda c: c <= t))


def time_slices(facts: DataFrame, hot_share: int, slices: int) -> tuple[DataFrame, DataFrame]:
    """Facts (_key, _at, _fact) with their ``_slice``, and (_key, _cuts) of the hot keys, which are few."""
    counts = facts.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    least = (counts.agg(F.sum("n")).first()[0] or 0) / hot_share
    hot = counts.where(F.col("n") >= max(least, 2 * slices)).select("_key")  # at most hot_share keys
    cuts = [i / slices for i in range(1, slices)]
    at = F.unix_micros("_at")
    bounds = (
        facts.join(F.broadcast(hot), "_key").groupBy("_key")
        .agg(F.percentile_approx(at, cuts, F.lit(10_000)).alias("_cuts"))
    )
    dealt = _below(at) + F.pmod(F.xxhash64("_fact"), _up_to(at) - _below(at) + 1).cast("int")
    sliced = facts.join(F.broadcast(bounds), "_key", "left").select(
        "_key", "_at", "_fact", F.when(F.col("_cuts").isNull(), 0).otherwise(dealt).alias("_slice"))
    return sliced, bounds


def _version_type(history: DataFrame, columns: Sequence[str]):
    row = F.struct(*columns, F.col("valid_to").alias("_until"))
    return history.select(row.alias("v")).schema["v"].dataType


# --- stored history -------------------------------------------------------------------------


def read_history(lake: Lake, table: str, layer: str = "snapshots") -> DataFrame:
    """Closed and open versions of a stored history."""
    current = lake.read(layer, f"{table}_open")
    return current.unionByName(lake.read(layer, f"{table}_closed", schema=current.schema))


def update_history(
    lake: Lake,
    table: str,
    state: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: Column,
    run_id: str,
    layer: str = "snapshots",
) -> dict[str, int]:
    """Store one more state. Closed versions are only ever appended; the open ones, which
    every run compares in full, are replaced. Both become visible in one commit."""
    open_table, closed_table = f"{table}_open", f"{table}_closed"
    current = lake.state(layer, open_table)
    if not current.exists:
        first = open_versions(state, key, as_of)
        changes = lake.stage(layer, open_table, first, run_id, "replace")
        lake.commit(changes)
        return {"open": changes[0].row_count, "closed": 0}
    moved = compare_versions(current.read(), state, key, check, as_of)
    # Written once: the comparison is split into its open and its closed rows.
    work = f"{lake.table_path(layer, open_table)}/incoming={run_id}"
    moved.write.mode("overwrite").parquet(work)
    moved = lake.spark.read.parquet(work)
    still_open = lake.stage(
        layer, open_table, moved.where("valid_to IS NULL"), run_id, "replace"
    )
    closed = lake.stage(
        layer, closed_table, moved.where("valid_to IS NOT NULL"), run_id, "append"
    )
    lake.commit([*still_open, *closed])
    files.delete(lake.spark, work)
    return {"open": still_open[0].row_count, "closed": closed[0].row_count}


def publish_history(lake: Lake, table: str, layer: str = "snapshots") -> None:
    """Name the whole history in SQL, over the views that ``Lake.publish`` made of its halves."""
    halves = [f"{table}_open"]
    if lake.state(layer, f"{table}_closed").exists:
        halves.append(f"{table}_closed")
    selects = " UNION ALL ".join(f"SELECT * FROM `{layer}`.`{half}`" for half in halves)
    lake.spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{table}` AS {selects}")
