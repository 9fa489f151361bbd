"""The relations of one bronze set, wired together once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from tidemark.plans import gold, silver


class Warehouse:
    """Silver and gold relations over given bronze tables.

    Without ``root`` everything is lazy: a relation that two others read is planned into both.
    With it, every relation is written below ``root`` when first asked for and read back, as
    the pipeline does: right for results that read the same relation several times. ``columns`` names
    those silver relations of which some columns only will be read: others are neither shuffled nor written.
    """

    def __init__(
        self, bronze: silver.Bronze, root: str | None = None, columns: Mapping[str, Sequence[str]] | None = None
    ):
        self.bronze = bronze
        self._root = root
        self._columns = columns or {}
        self._kept: dict[str, DataFrame] = {}

    def _keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._kept:
            df = build()
            if self._root is not None:
                path = f"{self._root}/{name}"
                df.write.parquet(path)
                df = df.sparkSession.read.schema(df.schema).parquet(path)
            self._kept[name] = df
        return self._kept[name]

    def silver(self, name: str) -> DataFrame:
        def build() -> DataFrame:
            whole = silver.SILVER[name](self.bronze)
            return whole.select(*self._columns[name]) if name in self._columns else whole

        return self._keep(name, build)

    @property
    def fct_orders(self) -> DataFrame:
        return self._keep("fct_orders", lambda: gold.fct_orders(
            self.silver("stg_orders"), self.silver("stg_order_items"),
            self.silver("stg_order_payments"), self.silver("stg_customers"),
        ))

    @property
    def dim_products(self) -> DataFrame:
        return self._keep("dim_products", lambda: gold.dim_products(self.silver("stg_products")))

    @property
    def dim_customers(self) -> DataFrame:
        return self._keep("dim_customers", lambda: gold.dim_customers(
            self.fct_orders, self.silver("stg_customers")
        ))

    @property
    def mart_daily_revenue(self) -> DataFrame:
        return self._keep("mart_daily_revenue", lambda: gold.mart_daily_revenue(self.fct_orders))

    @property
    def mart_category_performance(self) -> DataFrame:
        return self._keep("mart_category_performance", lambda: gold.mart_category_performance(
            self.silver("stg_order_items"), self.fct_orders, self.dim_products
        ))
