"""The retail model bound onto one directory of benchmark tables.

Each property is a lazy DataFrame plan; nothing runs until a query is executed,
except the date anchors (a small aggregate job each, resolved lazily and once per
model: the sales span and the stock cutoff separately).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import dimensions as dim
from ..operators import facts as fct
from ..sources.files import LINEAGE
from . import bindings as b


class RetailModel:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        missing_rate: str = "null",
        drop_uncovered: bool = False,
        anchors: b.Anchors | None = None,
    ):
        self.spark = spark
        self.sf_dir = sf_dir
        self.missing_rate = missing_rate
        self.drop_uncovered = drop_uncovered
        if anchors is not None:
            self.__dict__["anchors"] = anchors

    BRONZE = ("pos_raw", "online_raw", "fx_raw", "catalog_raw", "mappings_raw", "stores_raw", "shelf_raw", "dispatch_raw")

    @classmethod
    def from_bronze(
        cls, spark: SparkSession, bronze: dict[str, DataFrame], anchors: b.Anchors, fx_rows: int | None = None, **kw
    ) -> "RetailModel":
        """A model whose raw feeds are given (e.g. read back from a bronze layer); stock
        as ``snapshots_raw`` or as ``shelf_raw`` and ``dispatch_raw``. ``fx_rows``: a proven
        bound of the rate dimension, if there is one."""
        m = cls(spark, sf_dir="", anchors=anchors, **kw)
        for name, df in bronze.items():
            m.__dict__[name] = df.drop(*LINEAGE)
        m.__dict__["fx_rows"] = fx_rows
        return m

    # ------------------------------------------------------------ anchors
    # resolved lazily and separately: a sales query never scans the events and
    # a stock query never scans the sales tables just to anchor its window
    @cached_property
    def anchors(self) -> b.Anchors:
        return b.Anchors(*self._sales_span, self.stock_cutoff)

    @cached_property
    def _sales_span(self):
        if "anchors" in self.__dict__:
            a = self.__dict__["anchors"]
            return a.first_sale, a.sales_cutoff
        return b.sales_span(self.spark, self.sf_dir)

    @property
    def sales_cutoff(self):
        return self._sales_span[1]

    @cached_property
    def stock_cutoff(self):
        if "anchors" in self.__dict__:
            return self.__dict__["anchors"].stock_cutoff
        return b.stock_cutoff(self.spark, self.sf_dir)

    # ------------------------------------------------------------ bronze
    @cached_property
    def pos_raw(self) -> DataFrame:
        return b.pos_raw(self.spark, self.sf_dir)

    @cached_property
    def online_raw(self) -> DataFrame:
        return b.online_raw(self.spark, self.sf_dir)

    @cached_property
    def fx_raw(self) -> DataFrame:
        return b.fx_raw(self.spark, self.sf_dir)

    @cached_property
    def catalog_raw(self) -> DataFrame:
        return b.catalog_raw(self.spark, self.sf_dir)

    @cached_property
    def mappings_raw(self) -> DataFrame:
        return b.mappings_raw(self.spark, self.sf_dir)

    @cached_property
    def stores_raw(self) -> DataFrame:
        return b.stores_raw(self.spark, self.sf_dir)

    @cached_property
    def shelf_raw(self) -> DataFrame:
        return b.shelf_snapshots(self.spark, self.sf_dir)

    @cached_property
    def dispatch_raw(self) -> DataFrame:
        return b.dispatch_snapshots(self.spark, self.sf_dir)

    @cached_property
    def snapshots_raw(self) -> DataFrame:
        return self.shelf_raw.unionByName(self.dispatch_raw)

    # ------------------------------------------------------------ silver
    @cached_property
    def fx(self) -> DataFrame:
        return dim.fx_dimension(self.fx_raw)

    @cached_property
    def products(self) -> DataFrame:
        return dim.dim_product(self.catalog_raw, self.mappings_raw)

    @cached_property
    def stores(self) -> DataFrame:
        return dim.dim_store(self.stores_raw)

    @cached_property
    def cost(self) -> DataFrame:
        return dim.cost_dimension(self.catalog_raw)

    @cached_property
    def fx_rows(self) -> int | None:
        return b.fx_rows_bound(*self._sales_span)

    @cached_property
    def pos(self) -> DataFrame:
        return fct.sales_fact_pos(self.pos_raw, self.fx, missing_rate=self.missing_rate, fx_rows=self.fx_rows)

    @cached_property
    def online(self) -> DataFrame:
        return fct.sales_fact_online(self.online_raw, self.fx, missing_rate=self.missing_rate, fx_rows=self.fx_rows)

    @cached_property
    def sales(self) -> DataFrame:
        return fct.unify_sales(self.pos, self.online)

    @cached_property
    def channels(self) -> list[DataFrame]:
        """``sales`` channel by channel, to be written one after another."""
        return [fct.unify_sales(self.pos), fct.unify_sales(self.online)]

    @cached_property
    def readings(self) -> DataFrame:
        return fct.inventory_readings(self.snapshots_raw)

    @cached_property
    def inventory(self) -> DataFrame:
        return fct.inventory_daily(self.snapshots_raw)

    @cached_property
    def valued(self) -> DataFrame:
        return fct.value_inventory(self.inventory, self.cost, self.drop_uncovered)

    @cached_property
    def costed(self) -> DataFrame:
        return fct.cost_sales(self.sales, self.cost, self.drop_uncovered)
