"""Micro-weather feasibility operators.

Cells are 0.1-degree groups of area centroids; the cell set is bounded by
geography (a city has hundreds of such cells), so it travels as an array
scalar subquery and is exploded into each day's weather row — the grid x day
table is produced without a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.config import WEATHER_COLS
from hoodcast.functions.columns import clip, coord_key, flag
from hoodcast.operators import quality as Q

# Deterministic spatial perturbation factors of the proxy.
PERTURB = {"tavg": 0.6, "tmin": 0.7, "tmax": 0.5, "prcp": -0.15, "snow": 0.20, "wspd": 0.05}


#: Cells that one day's row carries at once, about; more cells are more parts.
CELLS_PER_ROW = 1_000


def centroid_cells(centroids: DataFrame, lat: str = "centroid_lat", lon: str = "centroid_lon") -> DataFrame:
    """Each area's 0.1-degree cell (half-even rounding) ``nbhd_id,
    coord_key, lat_round, lon_round``."""
    return centroids.select("nbhd_id", coord_key(lat, lon, 1).alias("coord_key"),
                            F.bround(lat, 1).alias("lat_round"), F.bround(lon, 1).alias("lon_round"))


def cell_members(cells: DataFrame) -> DataFrame:
    """Representative coordinate and member count per cell."""
    return cells.groupBy("coord_key").agg(F.min("lat_round").alias("lat_round"),
                                          F.min("lon_round").alias("lon_round"),
                                          F.count(F.lit(1)).alias("members"))


def micro_weather_proxy(city_weather: DataFrame, cells: DataFrame) -> DataFrame:
    """K28 (D2 + I13 + B24 + B21): city weather x cells with deterministic
    perturbations by latitude / longitude offset from the cells' mean, clipped
    at 0 for precipitation, snow and wind; flags recomputed."""
    meta = cells.select("coord_key", "lat_round", "lon_round").distinct()
    parts = 1 + meta.count() // CELLS_PER_ROW
    # a day meets the cells part by part, each an array of about CELLS_PER_ROW of them
    arrays = meta.groupBy(F.pmod(F.xxhash64("coord_key"), F.lit(parts)).cast("bigint").alias("part")).agg(
        F.collect_list(F.struct("coord_key", "lat_round", "lon_round")).alias("cells"))
    m = meta.select(F.struct(F.avg("lat_round").alias("la"), F.avg("lon_round").alias("lo"))).scalar()
    w = city_weather.select("date", *WEATHER_COLS, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part"))
    w = w.join(arrays, "part").select("date", *WEATHER_COLS, F.inline("cells"))
    dlat, dlon = F.col("lat_round") - m["la"], F.col("lon_round") - m["lo"]
    out = w.select(
        "coord_key", F.col("lat_round").alias("latitude"), F.col("lon_round").alias("longitude"), "date",
        (F.col("tavg") + dlat * PERTURB["tavg"]).alias("tavg"),
        (F.col("tmin") + dlat * PERTURB["tmin"]).alias("tmin"),
        (F.col("tmax") + dlat * PERTURB["tmax"]).alias("tmax"),
        clip(F.col("prcp") * (dlon * PERTURB["prcp"] + 1), lower=0.0).alias("prcp"),
        clip(F.col("snow") * (dlat * PERTURB["snow"] + 1), lower=0.0).alias("snow"),
        clip(F.col("wspd") * (dlon * PERTURB["wspd"] + 1), lower=0.0).alias("wspd"))
    return out.select("*", flag(F.col("tmin") <= 0).alias("freeze_day"), flag(F.col("snow") > 0).alias("snow_day"),
                      flag(F.col("prcp") > 0).alias("rain_day"))


def expand_to_areas(cell_weather: DataFrame, area_cells: DataFrame, source: str = "micro_proxy") -> DataFrame:
    """K27 (D12): cell weather -> per-area weather through the area->cell map.

    The cell side must be unique per (date, coord_key) (checked lazily by the
    caller with ``quality.duplicate_keys``); the area map is many-to-one.
    """
    j = area_cells.select("nbhd_id", "coord_key").join(cell_weather, "coord_key")
    return j.select("date", "nbhd_id", *WEATHER_COLS, "freeze_day", "snow_day", "rain_day",
                    F.lit(source).alias("weather_source"))


def replace_weather(panel: DataFrame, area_weather: DataFrame) -> DataFrame:
    """Drop the city weather columns and join the area-level ones."""
    drop = [c for c in (*WEATHER_COLS, "freeze_day", "snow_day", "rain_day") if c in panel.columns]
    return panel.drop(*drop).join(area_weather, ["date", "nbhd_id"], "left")


def weather_gate(area_weather: DataFrame) -> DataFrame:
    """N1 + E20: duplicate keys and the missing rate of ``tavg``."""
    d = Q.duplicate_keys(area_weather, ["date", "nbhd_id"]).select(F.count(F.lit(1)).alias("dup_keys"))
    m = area_weather.agg(F.avg(F.col("tavg").isNull().cast("double")).alias("tavg_missing_rate"))
    return d.select("dup_keys", m.select(F.struct("*")).scalar()["tavg_missing_rate"].alias("tavg_missing_rate"))


def dispersion(area_weather: DataFrame, digits: int = 6) -> DataFrame:
    """Cross-sectional standard deviation (ddof 1) of the weather columns per date."""
    return area_weather.groupBy("date").agg(
        *[F.bround(F.stddev_samp(c), digits).alias(c) for c in WEATHER_COLS])
