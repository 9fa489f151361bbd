"""The landing zone as a stream: micro-batches into bronze and on into silver.

The streaming source only announces files. What has been loaded is decided by the ingestion
log, and what silver has seen by the commit log, so a micro-batch that is run again, or a new
checkpoint, neither loses nor repeats rows. There is no event time and no watermark: late
files are simply new files.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import config as C
from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.latest import latest_per_key
from tidemark.operators.upsert import rows_with_keys, write_keyed
from tidemark.plans import silver
from tidemark.sources import key_index
from tidemark.sources.lake import Change, Lake
from tidemark.sources.landing import BadLandingFile, ingest_entity

log = logging.getLogger(__name__)

NO_AGE = "36500d"  # files are known by the ingestion log; none is too old
PROBLEM_TABLE = "landing_problems"
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class Flow:
    """How bronze copies of one entity become silver rows."""

    silver_table: str
    history_table: str
    live_table: str
    columns: Sequence[str]
    keys: Sequence[str]
    rows: Callable[[DataFrame], DataFrame]


FLOWS = {
    "orders": Flow(
        "stg_orders", "orders", "live_orders", C.ORDER_COLUMNS, C.ORDER_KEY, silver.clean_orders
    ),
    "order_items": Flow(
        "stg_order_items", "order_items", "live_order_items", C.ITEM_COLUMNS, C.ITEM_KEY,
        lambda raw: silver.finish_order_items(silver.clean_order_items(raw)),
    ),
    "order_payments": Flow(
        "stg_order_payments", "order_payments", "live_order_payments", C.PAYMENT_COLUMNS,
        C.PAYMENT_KEY,
        lambda raw: silver.finish_order_payments(silver.clean_order_payments(raw)),
    ),
}


def current_table(entity: str) -> str:
    """Silver table kept up to date by upserts (the batch plans rebuild theirs)."""
    return f"{FLOWS[entity].silver_table}_current"


def upsert_copies(
    lake: Lake,
    entity: str,
    copies: DataFrame,
    run_id: str,
    buckets: int,
    rebuild: bool = False,
    applied: Sequence[str] = (),
) -> dict[str, int]:
    """Merge silver rows into the current table: per key the newest copy wins, whether it
    is in the table or in the batch, so late and repeated copies change nothing.

    With ``rebuild`` the batch is all copies there are. ``applied`` names what the batch holds;
    the names are committed together with the rows, even if there are none."""
    flow, table = FLOWS[entity], current_table(entity)
    state = lake.state("silver", table)
    holding = None
    if state.parts and not rebuild:
        keys = copies.select(*flow.keys).distinct()
        if keys.where(~key_index.whole_key(flow.keys)).isEmpty():
            # only the parts that may hold a key of the batch are opened
            stored, holding = rows_with_keys(state, broadcast_if_small(keys), flow.keys)
            if stored is not None:
                copies = copies.unionByName(stored.select(*copies.columns))
        else:  # keys with a NULL are alike here, and in no filter
            named = keys.select(*[F.col(k).alias(f"_batch_{k}") for k in flow.keys])
            match = [F.col(k).eqNullSafe(F.col(f"_batch_{k}")) for k in flow.keys]
            copies = copies.unionByName(state.read().join(named, match, "left_semi"))
    newest = latest_per_key(copies, flow.keys)
    marks = [Change("silver", table, name, "merge", 0, f"{_APPLIED}{name}") for name in applied]
    return write_keyed(
        lake, "silver", table, newest, flow.keys, run_id, buckets, rebuild=rebuild, extra=marks, holding=holding
    )


_APPLIED = "applied:"  # parts without rows that only record what has been merged


def catch_up(lake: Lake, entity: str, buckets: int = 16) -> list[str]:
    """Bring the current table up to all committed bronze versions it has not seen, in one merge.

    A bronze version is seen when the table has a commit under its name. A new history
    version replaces an older one, so then the table is built anew from all versions.
    """
    flow, table = FLOWS[entity], current_table(entity)
    seen = lake.committed_versions("silver", table)
    found = [
        (source, system, version)
        for source, system in (
            (flow.history_table, C.SOURCE_HISTORY), (flow.live_table, C.SOURCE_LIVE)
        )
        for version in lake.state("bronze", source).versions
    ]
    unseen = [f for f in found if f"{f[0]}-{f[2]}" not in seen]
    if not unseen:
        return []
    rebuild = bool(seen) and any(source == flow.history_table for source, _, _ in unseen)
    taken = found if rebuild else unseen
    copies = [
        flow.rows(
            lake.read_versions("bronze", source, [v for s, _, v in taken if s == source])
            .withColumn("source_system", F.lit(system))
        )
        for source, system in dict.fromkeys((s, system) for s, system, _ in taken)
    ]
    applied = [f"{source}-{version}" for source, _, version in unseen]
    upsert_copies(
        lake, entity, reduce(DataFrame.unionByName, copies), uuid.uuid4().hex, buckets, rebuild,
        applied,
    )
    return applied


def stream_landing(
    lake: Lake,
    landing_dir: str,
    entity: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    upsert_buckets: int | None = 16,
    continuous: str | None = None,
    reconcile_every: int = 100,
) -> StreamingQuery:
    """Start loading one landing folder. By default it takes what is there and stops;
    ``continuous`` (a trigger interval such as ``1 minute``) keeps it running. With
    ``upsert_buckets`` the current silver table follows; None loads bronze only.

    A file is loaded whatever its modification time. What the stream's own listing does not show
    (files without a byte, files changed after they were loaded) is found by comparing the whole
    folder with the ingestion log: when a run that stops is started, and at every
    ``reconcile_every``-th micro-batch of one that goes on.

    A file with a bad line stops nothing: it is left out, its problem is logged and appended to
    ``bronze.landing_problems``, and a batch load names it again until it is mended.
    """

    def bring_in(listing: DataFrame | None) -> None:
        batch_id = uuid.uuid4().hex
        try:
            ingest_entity(lake, landing_dir, entity, batch_id, listing=listing)
        except BadLandingFile as bad:
            log.error("not loaded: %s", bad)
            problems = bad.problems.select(
                F.lit(entity).alias("entity"), F.lit(batch_id).alias("batch_id"),
                F.format_string("%s: %s on line %d", "file_name", "problem", "line_no").alias("problem"))
            lake.commit(lake.stage("bronze", PROBLEM_TABLE, problems, batch_id, "append"))
        if upsert_buckets is not None:
            catch_up(lake, entity, upsert_buckets)

    def load(batch: DataFrame, epoch: int) -> None:
        if continuous and epoch % reconcile_every == 0:
            bring_in(None)
            return
        bring_in(batch.select(
            "path",
            F.concat(F.lit(f"{entity}/"), F.regexp_extract("path", "[^/]+$", 0)).alias("source_file"),
            F.col("length").alias("file_length"),
            F.col("modificationTime").alias("modified_at"),
        ))

    if not continuous:
        bring_in(None)
    found = (
        lake.spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*.jsonl")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", NO_AGE)
        .load(f"{landing_dir.rstrip('/')}/{entity}")
        .drop("content")
    )
    writer = found.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()
