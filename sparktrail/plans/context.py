"""Per-call view of the driver tables through the adapters (lazy; each
property builds a DataFrame plan, nothing is read until an action)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sparktrail.operators.campaigns import activities, tenant_cells
from sparktrail.plans import adapters as A


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str, cells=None):
        self.spark, self.sf_dir, self.cells_map = spark, sf_dir, cells

    def table(self, name: str) -> DataFrame:
        return A.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def ev(self) -> DataFrame:
        return A.base_events(self.spark, self.sf_dir)

    @property
    def load(self) -> DataFrame:
        return A.load(self.ev)

    @property
    def accept(self) -> DataFrame:
        return A.accept(self.ev)

    @property
    def discard(self) -> DataFrame:
        return A.discard(self.ev)

    @property
    def send(self) -> DataFrame:
        return A.send(self.ev)

    @property
    def enter(self) -> DataFrame:
        return A.enter(self.ev)

    @property
    def purchase(self) -> DataFrame:
        return A.purchase(self.ev)

    @property
    def tagged(self) -> DataFrame:
        return A.tagged(self.ev)

    @property
    def clicks(self) -> DataFrame:
        return A.clicks(self.ev)

    @property
    def accept_af(self) -> DataFrame:
        return A.ad_accept_af(self.ev)

    @property
    def accept_ad(self) -> DataFrame:
        return A.ad_accept_ad(self.ev)

    @property
    def send_afad(self) -> DataFrame:
        return A.ad_send(self.ev)

    @cached_property
    def campaigns_raw(self) -> DataFrame:
        return A.campaigns(self.spark)

    @cached_property
    def settings(self) -> DataFrame:
        return A.settings(self.spark, self.cells_map)

    @cached_property
    def cells(self) -> DataFrame:
        return tenant_cells(self.settings)

    @cached_property
    def addfan_stat(self) -> DataFrame:
        return A.addfan_stat(self.spark)

    def activities(self, mode="all", **kw) -> DataFrame:
        return activities(self.campaigns_raw, mode, as_of=kw.pop("as_of", A.AS_OF), **kw)
