"""Panel builders K1-K10: raw inputs -> daily measures -> dense (area x day) gold.

Every daily aggregate is a ``groupBy`` on ``(date, nbhd_id)``: Spark performs a
map-side partial aggregation before the shuffle, so a hot area/day (or a
source holding a third of all rows) is collapsed to one partial row per task
before anything moves. Lookups onto the panel are left joins on the panel key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoodcast.config import KSI_COLS, ROAD_COLS, WEATHER_COLS
from hoodcast.functions import columns as C
from hoodcast.operators import geo
from hoodcast.session import cut_lineage

def _parallelism(spark) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return spark.sparkContext.defaultParallelism


def collision_daily(points: DataFrame, polys: DataFrame, predicate: str = "within",
                    cell: float | None = None) -> DataFrame:
    """K2: parse date (B8), drop unparsable, bbox filter (C2), spatial join
    (D8, or D9 single assignment), count per (date, area) (E1).

    Output ``date, nbhd_id, area_id, area_name, collision_count``.
    """
    p = (points.select(C.rfc1123_to_date("OCC_DATE").alias("date"),
                       F.col("LONG_WGS84").cast("double").alias("lon"),
                       F.col("LAT_WGS84").cast("double").alias("lat"))
         .dropna(subset=["date", "lon", "lat"]))
    p = geo.bbox_filter(p, polys, "lon", "lat")
    j = geo.spatial_join(p, polys, "lon", "lat", predicate=predicate,
                         single=(predicate == "intersects"), cell=cell)
    daily = j.groupBy("date", "nbhd_id").agg(F.count(F.lit(1)).alias("collision_count"))
    # the area table is tiny next to the daily counts; Spark's size estimate
    # (autoBroadcastJoinThreshold) decides whether it is broadcast
    names = polys.select("nbhd_id", "area_id", "area_name")
    return daily.join(names, "nbhd_id").select("date", "nbhd_id", "area_id", "area_name",
                                                 "collision_count")


def dense_panel(daily: DataFrame, areas: DataFrame, count_col: str = "collision_count",
                out_col: str = "collisions") -> DataFrame:
    """K3 (D1 + D3): every area x every day between the first and last date of
    ``daily``; missing counts become 0.

    The spine is generated per area by ``explode(sequence(lo, hi))`` where
    ``lo``/``hi`` are scalar subqueries (no join at all); the spine then meets
    the daily counts in one equi-join on ``(date, nbhd_id)``. Bounds and join both read the
    daily table, and Spark does not reuse an exchange between a subquery and the plan
    around it here; so it is written once (it is small next to the events, which are then
    scanned and spatially joined once).
    """
    daily = cut_lineage(daily.select("date", "nbhd_id", count_col))
    b = daily.select(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    lo, hi = b["lo"], b["hi"]
    a = areas.select("nbhd_id", "area_id", "area_name").dropna(subset=["nbhd_id"])
    # spread the (small) area table over the shuffle partitions first, so the
    # spine rows are generated by many tasks; an explicit partition count is
    # kept as is by AQE
    a = a.repartition(_parallelism(areas.sparkSession), "nbhd_id")
    spine = a.select("nbhd_id", "area_id", "area_name", F.explode(F.sequence(lo, hi)).alias("date"))
    d = daily.select("date", "nbhd_id", F.col(count_col).alias("_c"))
    return (spine.join(d, ["date", "nbhd_id"], "left")
            .select("date", "nbhd_id", "area_id", "area_name",
                    F.coalesce(F.col("_c"), F.lit(0)).cast("bigint").alias(out_col)))


def ksi_daily(persons: DataFrame) -> DataFrame:
    """K5: person rows -> accident rows -> (date, area) measures.

    Unparsable dates and non-numeric hoods (``NSA``) are dropped; injury flags
    by case-insensitive regex; weighted score = 3 fatal + 2 serious.
    """
    p = (persons
         .select("OBJECTID", "ACCNUM",
                 C.rfc1123_to_date("DATE").alias("date"),
                 C.to_number(F.col("HOOD_158"), "double").alias("hood"),
                 C.regex_flag("INJURY", "fatal").alias("is_fatal"),
                 C.regex_flag("INJURY", "serious|major").alias("is_serious"))
         .dropna(subset=["date", "hood", "ACCNUM"])
         .withColumn("nbhd_id", F.col("hood").cast("int")))
    acc = p.groupBy("ACCNUM", "date", "nbhd_id").agg(
        F.max(F.col("is_fatal").cast("int")).alias("fatal_collision"),
        F.max(F.col("is_serious").cast("int")).alias("serious_collision"),
        F.sum(F.col("is_fatal").cast("int")).alias("fatal_victims"),
        F.count("OBJECTID").alias("victim_count"))
    # rows of ``acc`` are unique per (ACCNUM, date, nbhd_id) with ACCNUM non-null,
    # so the distinct accident count per (date, nbhd_id) is a plain count
    day = acc.groupBy("date", "nbhd_id").agg(
        F.count("ACCNUM").alias("ksi_collisions"),
        F.sum("fatal_collision").cast("bigint").alias("ksi_fatal_collisions"),
        F.sum("serious_collision").cast("bigint").alias("ksi_serious_collisions"),
        F.sum("fatal_victims").cast("bigint").alias("ksi_fatal_victims"),
        F.sum("victim_count").cast("bigint").alias("ksi_victim_count"))
    return day.withColumn(
        "ksi_weighted_score",
        (F.col("ksi_fatal_collisions") * 3 + F.col("ksi_serious_collisions") * 2).cast("bigint"))


def weather_daily(raw: DataFrame) -> DataFrame:
    """K7: required columns (N6), numeric coercion (B5), NaN to null (T8), flags."""
    missing = [c for c in ("date",) + WEATHER_COLS if c not in raw.columns]
    if missing:
        raise ValueError(f"weather input lacks columns {missing}")
    w = raw.select(F.to_date("date").alias("date"),
                   *[C.nan_to_null(C.to_number(F.col(c), "double")).alias(c) for c in WEATHER_COLS])
    return w.select("*",
                    C.flag(F.col("tmin") <= 0).alias("freeze_day"),
                    C.flag(F.col("snow") > 0).alias("snow_day"),
                    C.flag(F.col("prcp") > 0).alias("rain_day"))


def expand_intervals(df: DataFrame, start: str = "start_date", end: str = "end_date",
                     out: str = "date") -> DataFrame:
    """One row per active day. Null end -> start; reversed end -> start
    (fixed *before* ``sequence``, which rejects reversed bounds); null start ->
    no rows."""
    e = F.coalesce(F.col(end), F.col(start))
    e = F.greatest(e, F.col(start))
    return (df.where(F.col(start).isNotNull())
            .withColumn(out, F.explode(F.sequence(F.col(start), e))))


def sweep_intervals(df: DataFrame, keys, measures: dict, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """D14/E3 as a sweep line: per key and day the sums of whole-number ``measures`` over the intervals that hold the
    day, and ``active``, their number; days without any have no row.

    An interval is two rows, its measures added on its first day and taken away on the day after its last;
    these collapse per key and date before the shuffle. Running totals then hold from one such date to the next:
    a key's window is bounded by the calendar. Null end, reversed end and null start as in ``expand_intervals``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    first = F.col(start)
    last = F.greatest(F.coalesce(F.col(end), first), first)
    events = df.where(first.isNotNull()).select(
        *keys, *[m.alias(name) for name, m in measures.items()],
        F.inline(F.array(F.struct(first.alias("date"), F.lit(1).alias("sign")),
                         F.struct(F.date_add(last, 1).alias("date"), F.lit(-1).alias("sign")))))
    change = events.groupBy(*keys, "date").agg(
        F.sum("sign").alias("active"), *[F.sum(F.col("sign") * F.col(m)).alias(m) for m in measures])
    w = Window.partitionBy(*keys).orderBy("date")
    total = [F.coalesce(F.sum(c).over(w), F.lit(0)).cast("bigint").alias(c) for c in ("active", *measures)]
    held = change.select(*keys, "date", F.lead("date").over(w).alias("until"), *total).where("active > 0")
    # as many rows as the result has
    days = F.explode(F.sequence("date", F.date_sub("until", 1)))
    return held.select(days.alias("date"), *keys, "active", *measures)


def disruption_daily(raw: DataFrame, polys: DataFrame, cell: float | None = None) -> DataFrame:
    """K9: clean coords (C3), spatial join ``within`` (D8), severity weight
    (B17; construction feed has none -> 1), full-closure flag (B18), per-source
    daily counts (E3) by a sweep over the intervals' ends (D14), one row per
    (date, area) (the full outer join D5 of the two feeds), zero-filled.
    """
    d = geo.valid_coords(raw, "Latitude", "Longitude")
    d = d.select(
        "ID", "Latitude", "Longitude", "source",
        C.epoch_to_date("StartDate").alias("start_date"),
        C.epoch_to_date("PlannedEndDate").alias("end_date"),
        F.when(F.col("source") == "event", C.severity_weight("Severity")).otherwise(F.lit(1))
        .alias("severity_weight"),
        C.truthy_flag("IsFullClosure").alias("full_closure_flag"))
    d = geo.spatial_join(d, polys, "Longitude", "Latitude", predicate="within", cell=cell)
    measures = {}
    for source, name in (("event", "events"), ("construction", "construction")):
        own = F.col("source") == source
        for out, v in ((f"{name}_count", F.col("ID").isNotNull().cast("int")), (f"{name}_severity_weighted", F.col("severity_weight")),
                       (f"{name}_full_closure_count", F.col("full_closure_flag"))):
            measures[out] = F.when(own, v)
    return sweep_intervals(d, "nbhd_id", measures).select("date", "nbhd_id", *measures)


def left_fill(panel: DataFrame, facts: DataFrame, keys, cols, prefix: str = "",
              fill=0, cast: str | None = "bigint") -> DataFrame:
    """Left join measures onto the panel, missing -> ``fill``.

    The right side must be unique on ``keys`` (N1) so the row count cannot change (N5).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    f = facts.select(*keys, *[F.col(c).alias(prefix + c) for c in cols])
    out = panel.join(f, keys, "left")
    for c in cols:
        v = F.coalesce(F.col(prefix + c), F.lit(fill))
        out = out.withColumn(prefix + c, v.cast(cast) if cast else v)
    return out


def gold(panel: DataFrame, ksi: DataFrame, weather: DataFrame, road: DataFrame) -> DataFrame:
    """K6 + K8 + K10: panel <- KSI (zero-filled), weather by date, road
    measures prefixed ``road_`` (zero-filled).

    Weather is keyed by date only (one row per day), so it is joined on date;
    a missing weather day shows as null ``tavg`` (gate: ``missing_lookup``).
    """
    g = left_fill(panel, ksi, ["date", "nbhd_id"], list(KSI_COLS))
    g = g.join(weather, "date", "left")
    road_src = [c[len("road_"):] for c in ROAD_COLS]
    g = left_fill(g, road, ["date", "nbhd_id"], road_src, prefix="road_")
    return g


def area_dimension(features: DataFrame, min_areas: int = 1) -> DataFrame:
    """K1: area dimension from landed GeoJSON features (``properties`` map +
    ``rings``): ``area_id`` text, ``nbhd_id`` int (bad text -> null), name,
    rings; rows with a null id are dropped. Gate columns: ``ids_unique`` and
    ``enough_areas`` (evaluated as window-free scalar subqueries)."""
    p = F.col("properties")
    d = features.select(p["area_id"].cast("string").alias("area_id"),
                        C.to_number(p["nbhd_id"], "int").alias("nbhd_id"),
                        p["area_name"].alias("area_name"), "rings").dropna(subset=["area_id", "nbhd_id"])
    stats = d.select(F.struct(F.count(F.lit(1)).alias("n"), F.count_distinct("nbhd_id").alias("u"),
                              F.count_distinct("area_id").alias("v"))).scalar()
    return d.select("*", ((stats["n"] == stats["u"]) & (stats["n"] == stats["v"])).alias("ids_unique"),
                    (stats["u"] >= min_areas).alias("enough_areas"))


def attach_area_id(daily: DataFrame, dim: DataFrame, key: str = "area_id") -> DataFrame:
    """K4 (D4 + B7): map area ids to ``nbhd_id`` (keys aligned as text). Rows
    without a match are kept with a null id so that the caller's no-miss gate
    (``quality.missing_lookup`` / ``require_empty``) can report them."""
    m = dim.select(F.col(key).cast("string").alias(key), "nbhd_id").dropDuplicates([key])
    return daily.withColumn(key, F.col(key).cast("string")).join(m, key, "left")
