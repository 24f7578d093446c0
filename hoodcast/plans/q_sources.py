"""Queries for sources and sinks (A2, A4-A10, A13 is in q_quality, A14).

Each query lands a payload that Spark derives from the driver's tables under
the shared checkpoint folder, then reads it back through the reader under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoodcast.operators import evaluate as Ev
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.plans.oracle_sql import sql
from hoodcast.plans.q_geo import ringed_shapes
from hoodcast.plans.q_eval import EV_CTE, Y, _metrics_sql, eval_frame
from hoodcast.sources import adapter as A
from hoodcast.sources import readers as Rd


@query("geojson_flatten", sql("""
  SELECT CAST(n_nationkey + 1000 AS VARCHAR) AS area_id, n_name AS area_name,
         CAST(n_nationkey + 1 AS INTEGER) AS nbhd_id, 'Polygon' AS geometry_type, 5 AS n_vertices,
         CAST(-80 + n_nationkey % 5 AS DOUBLE) AS minx, CAST(43 + n_nationkey // 5 AS DOUBLE) AS miny
  FROM nation"""))
def geojson_flatten(spark, sf):
    """A2: polygons landed as GeoJSON features, read back into rings."""
    path = Rd.landing_dir(spark, "areas-geojson")
    Rd.write_geojson_lines(A.area_polygons(spark, sf), path, ["area_id", "area_name", "nbhd_id"])
    g = Rd.read_geojson(spark, path)
    p = F.col("properties")
    return g.select(p["area_id"].alias("area_id"), p["area_name"].alias("area_name"),
                    p["nbhd_id"].try_cast("int").alias("nbhd_id"), "geometry_type",
                    F.size(F.col("rings")[0]).alias("n_vertices"),
                    F.array_min(F.transform(F.col("rings")[0], lambda q: q["x"])).alias("minx"),
                    F.array_min(F.transform(F.col("rings")[0], lambda q: q["y"])).alias("miny"))


@query("columnar_json_flatten", sql(
    "SELECT date, CAST(43.7 AS DOUBLE) AS latitude, CAST(-79.4 AS DOUBLE) AS longitude, tavg, tmin, tmax, prcp, snow, wspd FROM weather_raw"))
def columnar_json_flatten(spark, sf):
    """One columnar ``daily`` document per year (arrays of 365/366 values)
    landed and flattened back into daily rows."""
    w = A.weather_raw(spark, sf).withColumn("year", F.year("date"))
    inv = {v: k for k, v in Rd.DAILY_FIELDS.items()}
    docs = w.groupBy("year").agg(
        F.array_sort(F.collect_list(F.struct("date", *inv.keys()))).alias("d"))  # <= 366 per year
    def field(c):
        return lambda r: r[c]

    daily = F.struct(F.transform("d", lambda r: F.date_format(r["date"], "yyyy-MM-dd")).alias("time"),
                     *[F.transform("d", field(c)).alias(inv[c]) for c in inv])
    path = Rd.landing_dir(spark, "weather-daily")
    docs.select(F.lit(43.7).alias("latitude"), F.lit(-79.4).alias("longitude"), daily.alias("daily")) \
        .write.mode("overwrite").json(path)
    return Rd.read_columnar_daily(spark, path)


CITY_SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("collisions", T.LongType())])


@query("csv_roundtrip", sql("SELECT date, CAST(sum(collisions) AS BIGINT) AS collisions FROM panel GROUP BY date"))
def csv_roundtrip(spark, sf):
    """A9 + A4: city totals written as CSV, read back with a declared schema."""
    city = I.dense(spark, sf).groupBy("date").agg(F.sum("collisions").alias("collisions"))
    path = Rd.landing_dir(spark, "city-csv")
    Rd.write_small_csv(city, path)
    return Rd.read_csv(spark, path, CITY_SCHEMA)


METRIC_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("model", T.StringType()), ("roc_auc", T.DoubleType()), ("pr_auc", T.DoubleType()),
    ("brier", T.DoubleType()), ("n_test", T.LongType()), ("pos_rate", T.DoubleType()))])


@query("metrics_json", sql(_metrics_sql("score", "collision_prob_t1"), EV_CTE))
def metrics_json(spark, sf):
    """A10 + A5: metric records written as JSON and read back (a missing file
    would give an empty frame with the schema)."""
    m = Ev.classification_metrics(eval_frame(spark, sf), "score", Y, "collision_prob_t1")
    path = Rd.landing_dir(spark, "metrics")
    Rd.write_small_json(m, path)
    return Rd.read_json_records(spark, path, METRIC_SCHEMA)


@query("record_list", sql("""
  SELECT source, count(*) AS n, count(Severity) AS with_severity FROM (
    SELECT source, CASE WHEN source = 'event' THEN
             CASE o_orderpriority WHEN '1-URGENT' THEN 'Major' WHEN '2-HIGH' THEN 'Moderate'
                  WHEN '3-MEDIUM' THEN 'Minor' WHEN '4-NOT SPECIFIED' THEN 'Unknown' END END AS Severity
    FROM (SELECT o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'construction' ELSE 'event' END AS source
          FROM orders JOIN customer ON o_custkey = c_custkey))
  GROUP BY source"""))
def record_list(spark, sf):
    """JSON records whose keys differ by feed (construction has no
    Severity) read back as the union of keys."""
    d = A.disruptions(spark, sf)
    ev = d.where(F.col("source") == "event")
    co = d.where(F.col("source") == "construction").drop("Severity")
    path = Rd.landing_dir(spark, "disruption-records")
    ev.write.mode("overwrite").json(path + "/event")
    co.write.mode("overwrite").json(path + "/construction")
    r = Rd.read_json_records(spark, [path + "/event", path + "/construction"])
    return r.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("Severity").alias("with_severity"))


@query("partitioned_parquet", sql(
    "SELECT year(date) AS year, count(*) AS n_rows, CAST(sum(collisions) AS BIGINT) AS collisions "
    "FROM panel WHERE year(date) >= 2000 GROUP BY 1"))
def partitioned_parquet(spark, sf):
    """A8 + C1: the panel written partitioned by year, read back with a year
    filter that prunes partitions."""
    p = I.dense(spark, sf).withColumn("year", F.year("date"))
    path = Rd.landing_dir(spark, "panel")
    Rd.write_parquet(p, path, ["year"])
    back = spark.read.parquet(path).where(F.col("year") >= 2000)
    return back.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.sum("collisions").cast("bigint").alias("collisions"))


@query("provenance", sql(
    "SELECT date, 'citywide' AS weather_source, 'v1' AS model_version, true AS weather_source_ok FROM weather_raw"))
def provenance(spark, sf):
    """Constant provenance tags with a domain check."""
    w = A.weather_raw(spark, sf).select("date")
    return Rd.with_provenance(w, "weather_source", "citywide", ("citywide", "micro_proxy"), "v1")


@query("feature_collection", """
  SELECT CAST(c_custkey AS INTEGER) AS nbhd_id, 'Polygon' AS geometry_type, [2, 2, 2, 3, 3, 1][c_custkey % 6 + 1] AS n_rings,
         CAST(c_custkey % 1000 * 8 + CASE WHEN c_custkey % 6 = 3 THEN 2 ELSE 0 END AS DOUBLE) AS x FROM customer""")
def feature_collection(spark, sf):
    """A2: one FeatureCollection document with a polygon per customer, read back by as many tasks as it has blocks."""
    path = Rd.landing_dir(spark, "collection")
    Rd.write_feature_collection(ringed_shapes(spark, sf), path, ["nbhd_id"], "nbhd_id")
    g = Rd.read_geojson(spark, path, collection=True)
    return g.select(F.col("properties")["nbhd_id"].try_cast("int").alias("nbhd_id"), "geometry_type", F.size("rings").alias("n_rings"),
                    F.array_min(F.transform(F.col("rings")[0], lambda q: q["x"])).alias("x"))
