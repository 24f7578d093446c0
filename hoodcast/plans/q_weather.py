"""Queries for the micro-weather layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoodcast.config import WEATHER_COLS
from hoodcast.operators import geo
from hoodcast.operators import weather as Wx
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.plans.oracle_sql import sql
from hoodcast.sources import adapter as A

P = Wx.PERTURB

CELL_CTES = {
    "cells": """
  SELECT nbhd_id, concat_ws('_', CAST(lat_round AS VARCHAR), CAST(lon_round AS VARCHAR)) AS coord_key,
         lat_round, lon_round FROM (
    SELECT CAST(n_nationkey + 1 AS INTEGER) AS nbhd_id,
           round_even(CAST(43 + n_nationkey // 5 AS DOUBLE) + CAST(0.5 AS DOUBLE), 1) AS lat_round,
           round_even(CAST(-80 + n_nationkey % 5 AS DOUBLE) + CAST(0.5 AS DOUBLE), 1) AS lon_round
    FROM nation)""",
    "cmeta": "SELECT DISTINCT coord_key, lat_round, lon_round FROM cells",
    "proxy": f"""
  SELECT coord_key, latitude, longitude, date, tavg, tmin, tmax, prcp, snow, wspd,
         CAST(tmin <= 0 AS INTEGER) AS freeze_day, CAST(snow > 0 AS INTEGER) AS snow_day,
         CAST(prcp > 0 AS INTEGER) AS rain_day FROM (
    SELECT c.coord_key, c.lat_round AS latitude, c.lon_round AS longitude, w.date,
           w.tavg + (c.lat_round - m.la) * CAST({P['tavg']} AS DOUBLE) AS tavg,
           w.tmin + (c.lat_round - m.la) * CAST({P['tmin']} AS DOUBLE) AS tmin,
           w.tmax + (c.lat_round - m.la) * CAST({P['tmax']} AS DOUBLE) AS tmax,
           greatest(w.prcp * ((c.lon_round - m.lo) * CAST({P['prcp']} AS DOUBLE) + 1), 0.0) AS prcp,
           greatest(w.snow * ((c.lat_round - m.la) * CAST({P['snow']} AS DOUBLE) + 1), 0.0) AS snow,
           greatest(w.wspd * ((c.lon_round - m.lo) * CAST({P['wspd']} AS DOUBLE) + 1), 0.0) AS wspd
    FROM weather w CROSS JOIN cmeta c
    CROSS JOIN (SELECT avg(lat_round) AS la, avg(lon_round) AS lo FROM cmeta) m)""",
    "area_wx": """
  SELECT p.date, c.nbhd_id, p.tavg, p.tmin, p.tmax, p.prcp, p.snow, p.wspd, p.freeze_day, p.snow_day,
         p.rain_day, 'micro_proxy' AS weather_source
  FROM cells c JOIN proxy p USING (coord_key)""",
}


def _cells(spark, sf):
    return Wx.centroid_cells(geo.centroids(A.area_polygons(spark, sf)))


def _proxy(spark, sf):
    return Wx.micro_weather_proxy(I.weather_daily(spark, sf), _cells(spark, sf))


@query("micro_weather_proxy", sql("SELECT * FROM proxy", CELL_CTES))
def micro_weather_proxy(spark, sf):
    """City weather expanded to 0.1-degree centroid cells with deterministic perturbations."""
    return _proxy(spark, sf)


@query("centroid_cells", sql(
    "SELECT coord_key, min(lat_round) AS lat_round, min(lon_round) AS lon_round, count(*) AS members "
    "FROM cells GROUP BY 1", CELL_CTES))
def centroid_cells(spark, sf):
    """Area centroids grouped into 0.1-degree cells with member counts."""
    return Wx.cell_members(_cells(spark, sf))


@query("micro_weather_expand", sql("SELECT * FROM area_wx", CELL_CTES))
def micro_weather_expand(spark, sf):
    """Cell weather mapped back to areas, tagged with its source."""
    return Wx.expand_to_areas(_proxy(spark, sf), _cells(spark, sf))


@query("micro_weather_gold", sql(
    "SELECT g.date, g.nbhd_id, g.collisions, a.tavg, a.tmin, a.tmax, a.prcp, a.snow, a.wspd, "
    "a.freeze_day, a.snow_day, a.rain_day, a.weather_source "
    "FROM panel g LEFT JOIN area_wx a ON a.date = g.date AND a.nbhd_id = g.nbhd_id", CELL_CTES))
def micro_weather_gold(spark, sf):
    """The panel with city weather replaced by area-level weather."""
    aw = Wx.expand_to_areas(_proxy(spark, sf), _cells(spark, sf))
    p = I.dense(spark, sf).select("date", "nbhd_id", "collisions", *[F.lit(0.0).alias(c) for c in WEATHER_COLS])
    return Wx.replace_weather(p, aw)


@query("micro_weather_gate", sql(
    "SELECT (SELECT count(*) FROM (SELECT date, nbhd_id FROM area_wx GROUP BY 1, 2 HAVING count(*) > 1)) "
    "AS dup_keys, avg(CAST(tavg IS NULL AS DOUBLE)) AS tavg_missing_rate FROM area_wx", CELL_CTES))
def micro_weather_gate(spark, sf):
    """N1 + E20: no duplicate (date, area) keys, missing rate of tavg."""
    return Wx.weather_gate(Wx.expand_to_areas(_proxy(spark, sf), _cells(spark, sf)))


@query("weather_dispersion", sql(
    "SELECT date, " + ", ".join(f"round_even(stddev_samp({c}), 6) AS {c}" for c in WEATHER_COLS)
    + " FROM area_wx GROUP BY date", CELL_CTES))
def weather_dispersion(spark, sf):
    """Cross-sectional std of the six weather columns over areas, per date."""
    return Wx.dispersion(Wx.expand_to_areas(_proxy(spark, sf), _cells(spark, sf)))
