"""Lazily built, shared frames for one (session, table folder) pair."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from panelcast.config import ForecastConfig, FIXTURE_CONFIG
from panelcast.operators import panel as P
from panelcast.operators import features as FE
from panelcast.session import cut_lineage
from panelcast.sources.tables import joined_sales

_CACHE: dict = {}


class PanelContext:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: ForecastConfig = FIXTURE_CONFIG):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg

    @cached_property
    def joined(self) -> DataFrame:
        return joined_sales(self.spark, self.sf_dir)

    @cached_property
    def data(self) -> DataFrame:
        c = self.cfg
        return P.prepare_data(joined_sales(self.spark, self.sf_dir, c.train_start, c.prediction_end), c)

    @cached_property
    def facts(self) -> DataFrame:
        return cut_lineage(FE.fact_aggregates(self.data, self.cfg))

    @cached_property
    def panel(self) -> DataFrame:
        # The panel feeds a dozen consumers: written once, and from the fact aggregates if these are there
        sums = FE.daily_from(self.facts, self.cfg) if "facts" in self.__dict__ else None
        return cut_lineage(P.build_panel(self.data, self.cfg, sums))

    @cached_property
    def features(self) -> DataFrame:
        return FE.panel_features(self.panel, self.cfg)

    @cached_property
    def matrix(self) -> DataFrame:
        facts = self.facts          # before the panel, which then needs no fact read of its own
        return FE.build_feature_matrix(self.data, self.panel, self.cfg, facts)


def context(spark: SparkSession, sf_dir: str, cfg: ForecastConfig = FIXTURE_CONFIG) -> PanelContext:
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), cfg)
    if key not in _CACHE:
        _CACHE[key] = PanelContext(spark, sf_dir.rstrip("/"), cfg)
    return _CACHE[key]
