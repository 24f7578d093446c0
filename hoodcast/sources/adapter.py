"""Engine inputs derived from the driver's tables (see FIXTURES.md §3).

Every frame here is a lazy projection/join of the given parquet tables, so
its size grows with them. Integer arithmetic is used wherever possible so
that Spark and an SQL oracle agree bit for bit.

Fixed adapter values: areas are nations (``nbhd_id = n_nationkey + 1``) laid
out on a 5 x 5 grid of unit squares with lower-left corner
``(-80 + n % 5, 43 + n div 5)``; collision points sit strictly inside their
supplier nation's square except ``l_partkey % 50 = 0`` rows, which are (0, 0);
KSI persons are lineitems with ``l_quantity >= 40``; disruptions are orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoodcast.functions.columns import rfc1123_text
from hoodcast.sources.tables import read_table

GRID_X0, GRID_Y0, GRID_COLS = -80, 43, 5


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area dimension: ``nbhd_id INT, area_id STRING, area_name STRING``."""
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        (F.col("n_nationkey") + 1).cast("int").alias("nbhd_id"),
        (F.col("n_nationkey") + 1000).cast("string").alias("area_id"),
        F.col("n_name").alias("area_name"),
    )


def area_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas with one closed outer ring each:
    ``rings ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>``."""
    n = read_table(spark, sf_dir, "nation")
    x0 = (F.col("n_nationkey") % GRID_COLS + GRID_X0).cast("double")
    y0 = (F.floor(F.col("n_nationkey") / GRID_COLS) + GRID_Y0).cast("double")

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(pt(x0, y0), pt(x0 + 1, y0), pt(x0 + 1, y0 + 1), pt(x0, y0 + 1), pt(x0, y0))
    return n.select(
        (F.col("n_nationkey") + 1).cast("int").alias("nbhd_id"),
        (F.col("n_nationkey") + 1000).cast("string").alias("area_id"),
        F.col("n_name").alias("area_name"),
        F.array(ring).alias("rings"),
    )


def _lineitem_supplier(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", *cols)
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # No forced broadcast: supplier grows with the scale factor; AQE decides.
    return li.join(s, li.l_suppkey == s.s_suppkey).drop("l_suppkey", "s_suppkey")


def collision_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw collision points: ``OCC_DATE STRING`` (RFC-1123 text, GMT),
    ``LONG_WGS84, LAT_WGS84 DOUBLE``; about 2 % sit at (0, 0)."""
    j = _lineitem_supplier(spark, sf_dir, "l_orderkey", "l_partkey", "l_shipdate")
    bad = F.col("l_partkey") % 50 == 0
    lon = (F.col("s_nationkey") % GRID_COLS + GRID_X0) + (F.col("l_partkey") % 97 + 1) / 98.0
    lat = (F.floor(F.col("s_nationkey") / GRID_COLS) + GRID_Y0) + (F.col("l_orderkey") % 89 + 1) / 90.0
    return j.select(
        rfc1123_text(F.col("l_shipdate")).alias("OCC_DATE"),
        F.when(bad, F.lit(0.0)).otherwise(lon).alias("LONG_WGS84"),
        F.when(bad, F.lit(0.0)).otherwise(lat).alias("LAT_WGS84"),
    )


def ksi_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KSI person rows: ``OBJECTID, ACCNUM BIGINT, DATE STRING, HOOD_158 STRING,
    INJURY STRING, FATAL_NO INT``."""
    j = _lineitem_supplier(spark, sf_dir, "l_orderkey", "l_partkey", "l_linenumber",
                           "l_quantity", "l_shipdate").where(F.col("l_quantity") >= 40)
    injury = (F.when(F.col("l_quantity") >= 49, "Fatal")
              .when(F.col("l_quantity") >= 45, "Major").otherwise("Minor"))
    hood = F.when(F.col("l_partkey") % 41 == 0, F.lit("NSA")).otherwise(
        (F.col("s_nationkey") + 1).cast("string"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("OBJECTID"),
        F.col("l_orderkey").alias("ACCNUM"),
        rfc1123_text(F.col("l_shipdate")).alias("DATE"),
        hood.alias("HOOD_158"),
        injury.alias("INJURY"),
        F.when(F.col("l_quantity") >= 49, 1).otherwise(0).alias("FATAL_NO"),
    )


def disruptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road disruption intervals (events + construction feeds in one frame):
    ``ID, Latitude, Longitude, StartDate, PlannedEndDate (epoch s), Severity,
    IsFullClosure (text), source``."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    start = F.to_date(F.col("o_orderdate"))
    end = F.when(F.col("o_orderkey") % 17 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(start, (F.col("o_orderkey") % 12 - 1).cast("int")))
    def epoch(d):  # 10:00 UTC on that day, independent of the session time zone
        return F.unix_date(d).cast("bigint") * 86400 + 36000

    sev = (F.when(F.col("o_orderpriority") == "1-URGENT", "Major")
           .when(F.col("o_orderpriority") == "2-HIGH", "Moderate")
           .when(F.col("o_orderpriority") == "3-MEDIUM", "Minor")
           .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Unknown"))
    lon = (F.col("c_nationkey") % GRID_COLS + GRID_X0) + (F.col("o_custkey") % 97 + 1) / 98.0
    lat = (F.floor(F.col("c_nationkey") / GRID_COLS) + GRID_Y0) + (F.col("o_orderkey") % 89 + 1) / 90.0
    return j.select(
        F.col("o_orderkey").alias("ID"),
        lat.alias("Latitude"),
        lon.alias("Longitude"),
        epoch(start).alias("StartDate"),
        epoch(end).alias("PlannedEndDate"),
        sev.alias("Severity"),
        F.when(F.col("o_orderstatus") == "F", "True").otherwise("False").alias("IsFullClosure"),
        F.when(F.col("o_orderkey") % 2 == 0, "construction").otherwise("event").alias("source"),
    )


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every calendar day between the first and last ship date (one column ``date``)."""
    li = read_table(spark, sf_dir, "lineitem")
    b = li.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    return b.select(F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("date"))


def usable_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates of the points that do not sit at (0, 0), one column ``date``."""
    li = read_table(spark, sf_dir, "lineitem").where(F.col("l_partkey") % 50 != 0)
    return li.select(F.to_date("l_shipdate").alias("date"))


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily city weather (``date, tavg, tmin, tmax, prcp, snow, wspd`` as DOUBLE)
    by a fixed day-of-year rule over the data's calendar."""
    d = calendar_days(spark, sf_dir)
    doy, yr = F.dayofyear("date"), F.year("date")
    tmin = F.lit(18) - F.floor(F.abs(doy - 200) / 6)
    prcp = F.greatest((doy * 7 + yr) % 13 - 7, F.lit(0))
    return d.select(
        "date",
        (tmin + 5).cast("double").alias("tavg"),
        tmin.cast("double").alias("tmin"),
        (tmin + 10).cast("double").alias("tmax"),
        prcp.cast("double").alias("prcp"),
        F.when(tmin <= 0, prcp * 2).otherwise(0).cast("double").alias("snow"),
        ((doy * 11 + yr) % 45).cast("double").alias("wspd"),
    )


def score_column(date_col: str = "date", id_col: str = "nbhd_id"):
    """Deterministic lag-free score for the evaluation operators (ties on purpose)."""
    return ((F.col(id_col) * 7919 + F.datediff(F.col(date_col), F.lit("1995-01-01").cast("date")) * 104729)
            % 1000) / 1000.0
