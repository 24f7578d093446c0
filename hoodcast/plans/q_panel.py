"""Queries for the panel layer."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hoodcast.operators import panel as Pn
from hoodcast.operators import windows as Wn
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.plans.oracle_sql import sql
from hoodcast.sources import adapter as A
from hoodcast.sources.tables import read_table


@query("collision_daily", sql("SELECT date, nbhd_id, area_id, area_name, collision_count "
                              "FROM coll_daily JOIN areas USING (nbhd_id)"))
def collision_daily(spark, sf):
    """K2: RFC-1123 text dates, bbox filter, ``within`` spatial join, counts."""
    return I.collision_daily(spark, sf)


@query("collision_daily_intersects",
       sql("SELECT date, nbhd_id, area_id, area_name, collision_count "
           "FROM coll_daily JOIN areas USING (nbhd_id)"))
def collision_daily_intersects(spark, sf):
    """``intersects`` with single assignment (lowest polygon id)."""
    return I.collision_daily(spark, sf, predicate="intersects")


@query("dense_panel", sql("SELECT date, nbhd_id, area_id, area_name, collisions FROM panel"))
def dense_panel(spark, sf):
    """K3: every area x every day, zero-filled."""
    return I.dense(spark, sf)


@query("ksi_daily", sql("SELECT * FROM ksi_daily"))
def ksi_daily(spark, sf):
    """K5: person -> accident -> day collapse."""
    return I.ksi_daily(spark, sf)


@query("weather_daily", sql("SELECT * FROM weather"))
def weather_daily(spark, sf):
    """K7: weather with freeze/snow/rain flags."""
    return I.weather_daily(spark, sf)


@query("disruption_daily", sql("SELECT * FROM road_daily"))
def disruption_daily(spark, sf):
    """K9: interval expansion, severity, closures, per-source measures."""
    return I.disruption_daily(spark, sf)


@query("panel_gold", sql("SELECT * FROM gold"))
def panel_gold(spark, sf):
    """K6 + K8 + K10: gold panel (KSI, weather, road measures)."""
    return I.gold(spark, sf)


TOPK_TRAILING_SQL = sql("""
SELECT date, nbhd_id, area_name, trailing30_mean, rank FROM (
  SELECT date, nbhd_id, area_name, trailing30_mean,
         row_number() OVER (ORDER BY trailing30_mean DESC NULLS LAST, nbhd_id) AS rank
  FROM (
    SELECT date, nbhd_id, area_name,
           CASE WHEN count(collisions) OVER w = 30 THEN avg(collisions) OVER w END AS trailing30_mean
    FROM panel
    WINDOW w AS (PARTITION BY nbhd_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
  WHERE date = (SELECT max(date) FROM panel))
WHERE rank <= 10""")


def topk_trailing(spark, sf, k: int = 10):
    """S0 flagship: rank areas by their trailing-30-day mean collisions on the
    latest date (F4 + C4 + F10 + G2)."""
    p = I.dense(spark, sf)
    last = p.select(F.max("date")).scalar()
    # the panel is dense, so the 30 rows before the last day are the 30 days
    # before it: only the last 31 days are read into the window
    p = p.where(F.col("date") >= F.date_sub(last, 30))
    w = Wn.area_window()
    t = p.select("date", "nbhd_id", "area_name",
                 Wn.trailing("collisions", 30, w, "mean").alias("trailing30_mean"))
    latest = t.where(F.col("date") == last)
    r = latest.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("trailing30_mean").desc_nulls_last(), "nbhd_id")))
    return r.where(F.col("rank") <= k)


query("topk_trailing30", TOPK_TRAILING_SQL)(topk_trailing)


@query("disruption_profile", sql("""
  SELECT d.source, d.severity, d.n, s.avg_days FROM (
    SELECT source, CASE WHEN source = 'event' THEN
             CASE o_orderpriority WHEN '1-URGENT' THEN 'Major' WHEN '2-HIGH' THEN 'Moderate'
                  WHEN '3-MEDIUM' THEN 'Minor' WHEN '4-NOT SPECIFIED' THEN 'Unknown' END
             ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'Major' WHEN '2-HIGH' THEN 'Moderate'
                  WHEN '3-MEDIUM' THEN 'Minor' WHEN '4-NOT SPECIFIED' THEN 'Unknown' END END AS severity,
           count(*) AS n
    FROM (SELECT o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'construction' ELSE 'event' END AS source
          FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY 1, 2) d
  JOIN (SELECT source, avg(CAST(datediff('day', start_date, end_date) AS DOUBLE)) AS avg_days
        FROM dis WHERE end_date IS NOT NULL GROUP BY 1) s USING (source)"""))
def disruption_profile(spark, sf):
    """E16 + I6: disruption counts by feed and severity with each feed's mean
    planned duration in (fractional) days."""
    from hoodcast.functions.columns import days_between
    d = A.disruptions(spark, sf)
    counts = d.groupBy("source", F.col("Severity").alias("severity")).agg(F.count(F.lit(1)).alias("n"))
    dur = (d.where(F.col("PlannedEndDate").isNotNull())
           .select("source", days_between(F.timestamp_seconds("StartDate"), F.timestamp_seconds("PlannedEndDate"))
                   .alias("days"))
           .groupBy("source").agg(F.avg("days").alias("avg_days")))
    return counts.join(dur, "source")


@query("area_dimension", sql(
    "SELECT CAST(n_nationkey + 1000 AS VARCHAR) AS area_id, CAST(n_nationkey + 1 AS INTEGER) AS nbhd_id, "
    "n_name AS area_name, true AS ids_unique, true AS enough_areas FROM nation"))
def area_dimension(spark, sf):
    """K1: area dimension built from polygons landed as GeoJSON, with gates."""
    from hoodcast.operators import panel as Pn
    from hoodcast.sources import readers as Rd
    path = Rd.landing_dir(spark, "dim-geojson")
    Rd.write_geojson_lines(A.area_polygons(spark, sf), path, ["area_id", "area_name", "nbhd_id"])
    dim = Pn.area_dimension(Rd.read_geojson(spark, path), min_areas=25)
    return dim.drop("rings")


@query("attach_nbhd_id", sql(
    "SELECT a.area_id, c.date, c.collision_count, c.nbhd_id FROM coll_daily c JOIN areas a USING (nbhd_id)"))
def attach_nbhd_id(spark, sf):
    """K4: daily counts keyed by area id mapped to nbhd_id (no-miss lookup)."""
    from hoodcast.operators import panel as Pn
    daily = I.collision_daily(spark, sf).select("area_id", "date", "collision_count")
    return Pn.attach_area_id(daily, A.areas(spark, sf))


@query("closure_sweep", """
  SELECT day::DATE AS date, o_custkey % 25 AS area, count(*) AS active, sum(o_orderkey % 5)::BIGINT AS severity
  FROM (SELECT o_custkey, o_orderkey, unnest(generate_series(o_orderdate::DATE, greatest(coalesce(CASE WHEN o_orderkey % 17 <> 0
        THEN o_orderdate::DATE + (o_orderkey % 3650 - 3)::INT END, o_orderdate::DATE), o_orderdate::DATE), INTERVAL 1 DAY)) AS day FROM orders)
  GROUP BY 1, 2""")
def closure_sweep(spark, sf):
    """D14 over closures of up to ten years, some without an end or with one before the start."""
    start = F.to_date("o_orderdate")
    end = F.when(F.col("o_orderkey") % 17 != 0, F.date_add(start, (F.col("o_orderkey") % 3650 - 3).cast("int")))
    d = read_table(spark, sf, "orders").select((F.col("o_custkey") % 25).alias("area"), start.alias("start_date"), end.alias("end_date"),
                                               (F.col("o_orderkey") % 5).alias("severity"))
    return Pn.sweep_intervals(d, "area", {"severity": F.col("severity")})
