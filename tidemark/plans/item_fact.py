"""The incremental item fact: one row per order item, fed by load time."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators.latest import latest_per_key
from tidemark.operators.upsert import (
    after_mark, newest_after, newest_day_parts, write_keyed,
)
from tidemark.plans.silver import clean_order_items, finish_order_items, union_sources
from tidemark.sources.lake import Lake, TableState

LAYER, TABLE = "gold", "fct_order_items"

COLUMNS = (
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_at", "price",
    "freight_value", "item_total", "is_negative_price", "source_system", "ingested_at",
    "source_file",
)


def fact_rows(items: DataFrame) -> DataFrame:
    return items.select(*COLUMNS, F.current_timestamp().alias("processed_at"))


def increment(
    history: DataFrame,
    live: DataFrame,
    mark: Column,
    lookback_hours: int = C.LOOKBACK_HOURS,
) -> DataFrame:
    """Silver items loaded after the mark minus the lookback, from the bronze copies.

    Only copies loaded since then (or without a load time) have to be given.
    """
    copies = clean_order_items(union_sources(history, live, C.ITEM_COLUMNS))
    return finish_order_items(newest_after(copies, C.ITEM_KEY, mark, lookback_hours))


def load_mark(state: TableState) -> dt.datetime | None:
    """Latest load time in the fact, read from one column of the latest day's parts."""
    parts = newest_day_parts(state.parts)
    if not parts:
        return None
    newest = state.read(parts=parts).agg(F.unix_micros(F.max("ingested_at"))).first()[0]
    if newest is None:
        return None
    return dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=newest)


def next_start(lake: Lake, lookback_hours: int = C.LOOKBACK_HOURS) -> dt.datetime | None:
    """Rows loaded up to this moment are of no use to the next run; None: all are needed."""
    newest = load_mark(lake.state(LAYER, TABLE))
    return None if newest is None else newest - dt.timedelta(hours=lookback_hours)


def update_item_fact(
    lake: Lake,
    history: DataFrame,
    live: DataFrame,
    run_id: str,
    buckets: int = 16,
    lookback_hours: int = C.LOOKBACK_HOURS,
    rebuild: bool = False,
) -> dict[str, int]:
    """One run from the bronze copies. The first (or ``rebuild``) builds the whole table; later
    ones take only newer rows, and need only be given copies loaded since :func:`next_start`.

    ``buckets`` is the number of hash parts per load day: choose it so that one part of a
    full-history load stays around a gigabyte or two.
    """
    state = lake.state(LAYER, TABLE)
    if state.parts and not rebuild:
        mark = F.lit(load_mark(state)).cast("timestamp")
        items = increment(history, live, mark, lookback_hours)
    else:
        copies = clean_order_items(union_sources(history, live, C.ITEM_COLUMNS))
        items = finish_order_items(latest_per_key(copies, C.ITEM_KEY))
    return _store(lake, items, run_id, buckets, rebuild)


def update_item_fact_from_silver(
    lake: Lake,
    items: DataFrame,
    run_id: str,
    buckets: int = 16,
    lookback_hours: int = C.LOOKBACK_HOURS,
    rebuild: bool = False,
) -> dict[str, int]:
    """The same from silver rows that were just written: the load-time filter reaches their
    files, and nothing is deduplicated again."""
    state = lake.state(LAYER, TABLE)
    if state.parts and not rebuild:
        mark = F.lit(load_mark(state)).cast("timestamp")
        items = items.where(after_mark(F.col("ingested_at"), mark, lookback_hours))
    return _store(lake, items, run_id, buckets, rebuild)


def _store(
    lake: Lake, items: DataFrame, run_id: str, buckets: int, rebuild: bool
) -> dict[str, int]:
    return write_keyed(
        lake, LAYER, TABLE, fact_rows(items), C.ITEM_KEY, run_id, buckets, period="ingested_at",
        rebuild=rebuild,
    )
