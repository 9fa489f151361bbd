"""One run of everything, in dependency order."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import config as C
from tidemark.operators.history import update_history
from tidemark.operators.joins import heavy_keys
from tidemark.operators.quality import run_checks
from tidemark.plans import gold
from tidemark.plans.checks import build_suite
from tidemark.plans.item_fact import (
    next_start, update_item_fact, update_item_fact_from_silver,
)
from tidemark.plans.silver import SILVER, silver_relations
from tidemark.session import prepare
from tidemark.sources.csv_history import load_history
from tidemark.sources.lake import Lake
from tidemark.sources.landing import ingest_landing

SNAPSHOT_COLUMNS = ("zip_code_prefix", "city", "state")


def bronze(lake: Lake, name: str, newer_than: dt.datetime | None = None) -> DataFrame:
    """A declared bronze table. Live tables read as empty before their first load. With
    ``newer_than`` only the loads that may hold rows loaded later are opened."""
    if name not in C.BRONZE_COLUMNS:
        raise KeyError(f"{name} is not a declared source")
    columns = (*C.BRONZE_COLUMNS[name], *C.LINEAGE)
    schema = StructType([StructField(c, StringType()) for c in columns])
    state = lake.state("bronze", name)
    if name.startswith("live_") or newer_than is not None:
        return state.read(schema, newer_than=newer_than)
    return state.read().select(*columns)


def build_silver(
    lake: Lake, run_id: str, payment_types: Sequence[str] = C.ACCEPTED_PAYMENT_TYPES
) -> None:
    """Write every silver relation once; gold, checks and history read it several times.
    The layer is switched over as a whole."""
    sources = {name: bronze(lake, name) for name in C.BRONZE_COLUMNS}
    relations = silver_relations(payment_types)
    changes = []
    for name, build in relations.items():
        changes += lake.stage("silver", name, build(sources), run_id, "replace")
    lake.commit(changes)


def build_gold(
    lake: Lake,
    run_id: str,
    item_buckets: int = 16,
    lookback_hours: int = C.LOOKBACK_HOURS,
    rebuild_items: bool = False,
) -> None:
    """Rebuild the gold tables and switch them over together; the item fact, which takes only
    what is new, follows."""
    s = {name: lake.read("silver", name) for name in SILVER}
    changes = []

    def write(name: str, df: DataFrame) -> DataFrame:
        changes.extend(lake.stage("gold", name, df, run_id, "replace"))
        return lake.read_version("gold", name, run_id)

    items = s["stg_order_items"]
    fct = write("fct_orders", gold.fct_orders(
        s["stg_orders"], items, s["stg_order_payments"], s["stg_customers"],
        heavy_keys(s["stg_orders"], "customer_id"),
    ))
    products = write("dim_products", gold.dim_products(s["stg_products"]))
    write("dim_customers", gold.dim_customers(fct, s["stg_customers"]))
    write("mart_daily_revenue", gold.mart_daily_revenue(fct))
    write("mart_category_performance", gold.mart_category_performance(
        items, fct, products, heavy_keys(items, "order_id"), heavy_keys(items, "product_id")
    ))
    lake.commit(changes)
    update_item_fact_from_silver(
        lake, items, run_id, item_buckets, lookback_hours, rebuild_items
    )


def refresh_item_fact(
    lake: Lake,
    run_id: str,
    item_buckets: int = 16,
    lookback_hours: int = C.LOOKBACK_HOURS,
    rebuild: bool = False,
) -> dict[str, int]:
    """Extend the item fact by what was loaded since, without rebuilding silver: the job to
    run after each landing load. Only loads newer than the fact are opened."""
    sides = ("order_items", "live_order_items")
    start = None if rebuild else next_start(lake, lookback_hours)
    if start is not None and not any(lake.has_newer("bronze", name, start) for name in sides):
        return {"parts": 0, "rows_written": 0}
    return update_item_fact(
        lake, *(bronze(lake, name, start) for name in sides), run_id, item_buckets,
        lookback_hours, rebuild,
    )


GOLD = (
    "fct_orders", "fct_order_items", "dim_customers", "dim_products",
    "mart_daily_revenue", "mart_category_performance",
)


def check_layers(lake: Lake, run_id: str, raise_on_error: bool = True) -> DataFrame:
    tables = {name: lake.read("silver", name) for name in SILVER}
    tables.update({name: lake.read("gold", name) for name in GOLD})
    return run_checks(build_suite(tables), lake, run_id, raise_on_error)


def run(
    lake: Lake,
    raw_dir: str | None = None,
    landing_dir: str | None = None,
    run_id: str | None = None,
    item_buckets: int = 16,
    raise_on_error: bool = True,
    lookback_hours: int = C.LOOKBACK_HOURS,
    payment_types: Sequence[str] = C.ACCEPTED_PAYMENT_TYPES,
    trust_file_times: bool = False,
    rebuild_items: bool = False,
) -> DataFrame:
    """Load what is given, rebuild silver and gold, extend the history, run the checks.

    ``trust_file_times`` takes known landing files of unchanged length and modification time as
    unchanged instead of comparing their content; ``rebuild_items`` builds the item fact anew.

    Returns the check results. Every table is switched over only when it is complete, so a
    run that dies half-way leaves readable tables and can be started again.
    """
    prepare(lake.spark)
    run_id = run_id or uuid.uuid4().hex
    lake.create_layers()
    if raw_dir is not None:
        load_history(lake, raw_dir, run_id)
    if landing_dir is not None:
        ingest_landing(lake, landing_dir, run_id, rehash_known=not trust_file_times)
    build_silver(lake, run_id, payment_types)
    build_gold(lake, run_id, item_buckets, lookback_hours, rebuild_items)
    now = F.lit(dt.datetime.now(dt.timezone.utc))
    update_history(
        lake, "snap_customers", lake.read("silver", "stg_customers"), "customer_id",
        SNAPSHOT_COLUMNS, now, run_id,
    )
    return check_layers(lake, run_id, raise_on_error)
