"""Shared lazy inputs for the query catalogue: driver tables -> engine layers.

Nothing is cached: each function returns a fresh lazy plan, so a query only
reads the columns its result needs (Catalyst prunes the rest).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoodcast.config import ADAPTER, ROAD_COLS
from hoodcast.operators import features as Fe
from hoodcast.operators import geo, panel
from hoodcast.session import cut_lineage
from hoodcast.sources import adapter as A

# unit squares on the adapter grid: 16 cells per side (most cells interior)
ADAPTER_CELL = 0.0625


def collision_daily(spark: SparkSession, sf: str, predicate: str = "within") -> DataFrame:
    return panel.collision_daily(A.collision_points(spark, sf), A.area_polygons(spark, sf),
                                 predicate=predicate, cell=ADAPTER_CELL)


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return panel.dense_panel(collision_daily(spark, sf), A.areas(spark, sf))


def ksi_daily(spark: SparkSession, sf: str) -> DataFrame:
    return panel.ksi_daily(A.ksi_persons(spark, sf))


def weather_daily(spark: SparkSession, sf: str) -> DataFrame:
    return panel.weather_daily(A.weather_raw(spark, sf))


def disruption_daily(spark: SparkSession, sf: str) -> DataFrame:
    return panel.disruption_daily(A.disruptions(spark, sf), A.area_polygons(spark, sf),
                                  cell=ADAPTER_CELL)


def gold(spark: SparkSession, sf: str, road: DataFrame | None = None) -> DataFrame:
    road = disruption_daily(spark, sf) if road is None else road
    return panel.gold(dense(spark, sf), ksi_daily(spark, sf), weather_daily(spark, sf), road)


def gold_and_facts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The gold panel and the road measures of the (date, area) pairs with a disruption, named as in
    the panel. Both read the daily disruptions, which are written once."""
    road = cut_lineage(disruption_daily(spark, sf))
    facts = road.select("date", "nbhd_id", *[F.col(c.removeprefix("road_")).alias(c) for c in ROAD_COLS])
    return gold(spark, sf, road), facts


def adjacency(spark: SparkSession, sf: str) -> DataFrame:
    return geo.adjacency(A.area_polygons(spark, sf), cell=ADAPTER_CELL)


def halo(spark: SparkSession, sf: str, variant: str = "production") -> DataFrame:
    g, facts = gold_and_facts(spark, sf)
    return Fe.halo_columns(g, adjacency(spark, sf), variant, facts)


def features(spark: SparkSession, sf: str, variant: str = "production") -> DataFrame:
    """The feature table as one lazy plan over the daily tables: the panel is read once, the
    neighbour sums come from the sparse road facts."""
    g, facts = gold_and_facts(spark, sf)
    return Fe.feature_table(g, adjacency(spark, sf), ADAPTER, variant, facts)


def panel_days(spark: SparkSession, sf: str) -> DataFrame:
    """The panel's (date, nbhd_id) spine without its counts: the first and last day that has a
    point with usable coordinates, times the areas. No spatial join."""
    days = A.usable_days(spark, sf).select(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    return A.areas(spark, sf).select("nbhd_id", F.explode(F.sequence(days["lo"], days["hi"])).alias("date"))
