"""Queries for the feature layer (K12-K21, F1-F9). Oracle SQL is generated
from the same column lists the Spark builders use."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoodcast.config import ADAPTER, ROAD_COLS
from hoodcast.operators import features as Fe
from hoodcast.operators import windows as Wn
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.plans.oracle_sql import sql
from hoodcast.plans.q_geo import STREETS, road_exposure_frame
from hoodcast.session import cut_lineage

S = ADAPTER
HALO_COLS = [f"{c}_halo" for c in ROAD_COLS]
KEYS = ["date", "nbhd_id"]

# ----------------------------------------------------------------------------
# oracle SQL fragments
# ----------------------------------------------------------------------------

HOLIDAY_CTES = {
    "years": """
  SELECT unnest(range(lo, hi + 1)) AS y
  FROM (SELECT min(year(date)) AS lo, max(year(date)) + 1 AS hi FROM gold)""",
    "easter": """
  SELECT y, make_date(y, CAST(mo AS INTEGER), CAST(dy AS INTEGER)) AS e FROM (
    SELECT y, (h + l - 7 * m + 114) // 31 AS mo, (h + l - 7 * m + 114) % 31 + 1 AS dy FROM (
      SELECT y, h, l, (a + 11 * h + 22 * l) // 451 AS m FROM (
        SELECT y, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
          SELECT y, a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h FROM (
            SELECT y, y % 19 AS a, y // 100 AS b, (y // 100) // 4 AS d, (y // 100) % 4 AS e,
                   ((y // 100) - ((y // 100) + 8) // 25 + 1) // 3 AS g,
                   (y % 100) // 4 AS i, (y % 100) % 4 AS k
            FROM years)))))""",
    "hol": """
  SELECT DISTINCT d AS holiday FROM (
    SELECT make_date(y, 1, 1) AS d FROM years
    UNION ALL SELECT make_date(y, 2, 1) + CAST((7 - (isodow(make_date(y, 2, 1)) - 1)) % 7 + 14 AS INTEGER)
      FROM years WHERE y >= 2008
    UNION ALL SELECT CAST(e - INTERVAL 2 DAY AS DATE) FROM easter
    UNION ALL SELECT make_date(y, 5, 24) - CAST(isodow(make_date(y, 5, 24)) - 1 AS INTEGER) FROM years
    UNION ALL SELECT make_date(y, 7, 1) FROM years
    UNION ALL SELECT make_date(y, 9, 1) + CAST((7 - (isodow(make_date(y, 9, 1)) - 1)) % 7 AS INTEGER) FROM years
    UNION ALL SELECT make_date(y, 10, 1) + CAST((7 - (isodow(make_date(y, 10, 1)) - 1)) % 7 + 7 AS INTEGER) FROM years
    UNION ALL SELECT make_date(y, 12, 25) FROM years
    UNION ALL SELECT make_date(y, 12, 26) FROM years)""",
}


def _cal_sql(src: str) -> str:
    return f"""
  SELECT s.*, isodow(s.date) - 1 AS dow, month(s.date) AS month, year(s.date) AS year,
         CAST(isodow(s.date) - 1 >= 5 AS INTEGER) AS is_weekend,
         CAST(s.date IN (SELECT holiday FROM hol) AS INTEGER) AS is_holiday,
         CAST(s.date + 1 IN (SELECT holiday FROM hol) AS INTEGER) AS pre_holiday,
         CAST(s.date - 1 IN (SELECT holiday FROM hol) AS INTEGER) AS post_holiday,
         round(sin(2 * pi() * (isodow(s.date) - 1) / 7), 12) AS dow_sin,
         round(cos(2 * pi() * (isodow(s.date) - 1) / 7), 12) AS dow_cos,
         round(sin(2 * pi() * month(s.date) / 12), 12) AS month_sin,
         round(cos(2 * pi() * month(s.date) / 12), 12) AS month_cos
  FROM {src} s"""


WEATHER_FLAGS_SQL = """
  CAST(prcp > 0 AND tmin <= 0 AS INTEGER) AS freezing_rain,
  CAST(prcp > 2 AND wspd > 30 AS INTEGER) AS wind_rain,
  CAST(snow > 5 AS INTEGER) AS heavy_snow,
  CAST(tmin <= -10 AND prcp = 0 AS INTEGER) AS cold_dry,
  CAST((prcp > 0 AND tmin <= 0) OR (prcp > 2 AND wspd > 30) OR snow > 5 AS INTEGER) AS feels_bad"""


def _halo_sql(variant: str = "production") -> dict:
    sums = ", ".join(f"sum(g.{c}) AS {c}_halo" for c in ROAD_COLS)
    fills = ", ".join(f"CAST(coalesce(h.{c}, 0) AS BIGINT) AS {c}" for c in HALO_COLS)
    norms = ", ".join(f"ln(1 + {c}) AS {c}_norm" for c in HALO_COLS)
    zone = ("road_construction_count_halo > 0" if variant == "production"
            else "road_construction_count + road_construction_count_halo > 0")
    ev = "is_event_disrupted_halo" if variant == "production" else "is_road_disrupted_halo"
    return {
        "halo_sum": f"""
  SELECT g.date, a.nbhd_id, {sums}
  FROM adj a JOIN gold g ON g.nbhd_id = a.adjacent_nbhd_id GROUP BY 1, 2""",
        "halo_filled": f"""
  SELECT p.*, {fills}
  FROM gold p LEFT JOIN halo_sum h ON h.date = p.date AND h.nbhd_id = p.nbhd_id""",
        "halo": f"""
  SELECT *, {norms},
         CAST({zone} AS INTEGER) AS is_zone_disrupted,
         CAST(road_events_count_halo > 0 AS INTEGER) AS {ev},
         road_construction_count + road_construction_count_halo AS construction_total_pressure,
         ln(1 + road_construction_count + road_construction_count_halo) AS construction_pressure_norm
  FROM halo_filled""",
    }


def _lag_roll_sql(cols, lags, widths) -> list[str]:
    out = []
    for c in cols:
        out += [f"lag({c}, {L}) OVER w AS {c}_lag{L}" for L in lags]
        for W in widths:
            fw = f"(w ROWS BETWEEN {W} PRECEDING AND 1 PRECEDING)"
            out.append(f"CASE WHEN count({c}) OVER {fw} = {W} THEN sum(CAST({c} AS DOUBLE)) OVER {fw} END "
                       f"AS {c}_roll{W}_sum")
            out.append(f"CASE WHEN count({c}) OVER {fw} = {W} THEN avg(CAST({c} AS DOUBLE)) OVER {fw} END "
                       f"AS {c}_roll{W}_mean")
    return out


MOMENTUM_SQL = """coalesce(CASE WHEN (CASE WHEN count(collisions) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) = 14
    THEN avg(CAST(collisions AS DOUBLE)) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) END) <> 0
  THEN lag(collisions, 1) OVER w / (avg(CAST(collisions AS DOUBLE)) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)) END, 1.0)
  AS collision_momentum"""


def _targets_sql(horizons) -> list[str]:
    out = []
    for h in horizons:
        out += [f"lead(collisions, {h}) OVER w AS collisions_t{h}",
                f"CAST(coalesce(lead(collisions, {h}) OVER w, 0) >= 1 AS INTEGER) AS target_collision_t{h}",
                f"CAST(coalesce(lead(ksi_collisions, {h}) OVER w, 0) >= 1 AS INTEGER) AS target_ksi_t{h}"]
    return out


WIN = "WINDOW w AS (PARTITION BY nbhd_id ORDER BY date)"


def feature_table_ctes(variant: str = "production") -> dict:
    """CTEs ending in ``features`` (the K19 table) for DuckDB."""
    ctes = dict(HOLIDAY_CTES)
    ctes["cal"] = _cal_sql("gold")
    ctes["wx"] = f"SELECT *, {WEATHER_FLAGS_SQL} FROM cal"
    ctes["kr"] = ("SELECT *, coalesce(CASE WHEN collisions <> 0 THEN CAST(ksi_collisions AS DOUBLE) / collisions END,"
                  " 0.0) AS ksi_ratio FROM wx")
    h = _halo_sql(variant)
    h["halo_filled"] = h["halo_filled"].replace("FROM gold p", "FROM kr p")
    ctes.update(h)
    win = (["lag(ksi_ratio, 1) OVER w AS ksi_ratio_lag1"]
           + _lag_roll_sql(S.lag_cols, S.lags, S.windows) + [MOMENTUM_SQL]
           + _lag_roll_sql(HALO_COLS, S.halo_lags, S.halo_windows) + _targets_sql(S.horizons))
    ctes["feat_all"] = f"SELECT *, {', '.join(win)} FROM halo {WIN}"
    hmax = max(S.horizons)
    ctes["features"] = (f"SELECT * FROM feat_all WHERE collisions_t{hmax} IS NOT NULL "
                        "AND collisions_lag1 IS NOT NULL AND collisions_roll7_mean IS NOT NULL")
    return ctes


# ----------------------------------------------------------------------------
# Spark side helpers
# ----------------------------------------------------------------------------

def _round_cyclic(df):
    # sin/cos rounded to 12 decimals: libm implementations may differ in the last ulp
    return df.select(*[F.bround(c, 12).alias(c) if c in ("dow_sin", "dow_cos", "month_sin", "month_cos")
                       else F.col(c) for c in df.columns])


def spark_features(spark, sf, variant="production"):
    """The feature table, lazily: a query that reads a few columns builds only those."""
    return _round_cyclic(I.features(spark, sf, variant))


def staged_features(spark, sf, cols=None):
    """Written once, for the plans that read it several times; only ``cols`` when given."""
    f = spark_features(spark, sf)
    return cut_lineage(f.select(*cols) if cols else f)


# ----------------------------------------------------------------------------
# queries
# ----------------------------------------------------------------------------

CAL_COLS = ["dow", "month", "year", "is_weekend", "is_holiday", "pre_holiday", "post_holiday",
            "dow_sin", "dow_cos", "month_sin", "month_cos"]


@query("calendar_features", sql(
    f"SELECT date, nbhd_id, {', '.join(CAL_COLS)} FROM cal",
    {**HOLIDAY_CTES, "cal": _cal_sql("gold")}))
def calendar_features(spark, sf):
    """Calendar parts, statutory holidays (rule-built), cyclical encodings."""
    g = I.gold(spark, sf).select("date", "nbhd_id")
    return _round_cyclic(Fe.calendar_features(g, S).select("date", "nbhd_id", *CAL_COLS))


WX_COLS = ["freezing_rain", "wind_rain", "heavy_snow", "cold_dry", "feels_bad"]


@query("weather_interactions", sql(f"SELECT date, {WEATHER_FLAGS_SQL} FROM weather"))
def weather_interactions(spark, sf):
    """Compound weather flags per day."""
    return Fe.weather_interactions(I.weather_daily(spark, sf)).select("date", *WX_COLS)


@query("ksi_ratio", sql(
    "SELECT date, nbhd_id, ksi_ratio, lag(ksi_ratio, 1) OVER w AS ksi_ratio_lag1 FROM ("
    "SELECT date, nbhd_id, coalesce(CASE WHEN collisions <> 0 THEN CAST(ksi_collisions AS DOUBLE) / collisions END,"
    " 0.0) AS ksi_ratio FROM gold) " + WIN))
def ksi_ratio(spark, sf):
    """Same-day KSI ratio (0 when no collisions) and its lag (null on day 1)."""
    g = Fe.ksi_ratio_columns(I.gold(spark, sf).select("date", "nbhd_id", "collisions", "ksi_collisions"))
    w = Wn.area_window()
    return g.select("date", "nbhd_id", "ksi_ratio", Wn.lag("ksi_ratio", 1, w).alias("ksi_ratio_lag1"))


def _lag_names(cols, lags):
    return [f"{c}_lag{L}" for c in cols for L in lags]


def _roll_names(cols, widths):
    return [f"{c}_roll{W}_{k}" for c in cols for W in widths for k in ("sum", "mean")]


@query("lag_features", sql(
    "SELECT date, nbhd_id, " + ", ".join(
        f"lag({c}, {L}) OVER w AS {c}_lag{L}" for c in S.lag_cols for L in S.lags) + " FROM gold " + WIN))
def lag_features(spark, sf):
    """Lags 1/7/14 of the seven lag columns (null for the first L days)."""
    g = I.gold(spark, sf)
    w = Wn.area_window()
    return g.select("date", "nbhd_id", *[Wn.lag(c, L, w).alias(f"{c}_lag{L}")
                                         for c in S.lag_cols for L in S.lags])


@query("rolling_features", sql(
    "SELECT date, nbhd_id, " + ", ".join(
        x for x in _lag_roll_sql(S.lag_cols, [], S.windows)) + " FROM gold " + WIN))
def rolling_features(spark, sf):
    """Trailing 7/14/30-day sums and means excluding today."""
    g = I.gold(spark, sf)
    w = Wn.area_window()
    return g.select("date", "nbhd_id", *Wn.lag_roll_columns(S.lag_cols, [], S.windows, w))


@query("momentum", sql(f"SELECT date, nbhd_id, {MOMENTUM_SQL} FROM gold {WIN}"))
def momentum(spark, sf):
    """Yesterday / trailing-14 mean; null or zero baseline -> 1.0."""
    g = I.dense(spark, sf)
    w = Wn.area_window()
    base = Wn.trailing("collisions", 14, w, "mean")
    from hoodcast.functions.columns import safe_div
    return g.select("date", "nbhd_id", F.coalesce(safe_div(Wn.lag("collisions", 1, w), base), F.lit(1.0))
                    .alias("collision_momentum"))


HALO_OUT = HALO_COLS + [f"{c}_norm" for c in HALO_COLS] + [
    "is_zone_disrupted", "is_event_disrupted_halo", "construction_total_pressure", "construction_pressure_norm"]


@query("halo_features", sql(f"SELECT date, nbhd_id, {', '.join(HALO_OUT)} FROM halo", _halo_sql()))
def halo_features(spark, sf):
    """Neighbour sums over the adjacency graph, norms and flags."""
    return I.halo(spark, sf).select("date", "nbhd_id", *HALO_OUT)


HALO_LEGACY_OUT = [c if c != "is_event_disrupted_halo" else "is_road_disrupted_halo" for c in HALO_OUT]


@query("halo_features_legacy", sql(f"SELECT date, nbhd_id, {', '.join(HALO_LEGACY_OUT)} FROM halo",
                                   _halo_sql("legacy")))
def halo_features_legacy(spark, sf):
    """Legacy variant, ``is_zone_disrupted = total pressure > 0``."""
    return I.halo(spark, sf, "legacy").select("date", "nbhd_id", *HALO_LEGACY_OUT)


@query("halo_lag_roll", sql(
    "SELECT date, nbhd_id, " + ", ".join(_lag_roll_sql(HALO_COLS, S.halo_lags, S.halo_windows))
    + f" FROM halo {WIN}", _halo_sql()))
def halo_lag_roll(spark, sf):
    """F8: lag 1/7 and roll 7/14 of the six halo columns."""
    h = I.halo(spark, sf)
    w = Wn.area_window()
    return h.select("date", "nbhd_id", *Wn.lag_roll_columns(HALO_COLS, S.halo_lags, S.halo_windows, w))


TARGET_COLS = [f"{p}_t{h}" for h in S.horizons for p in ("collisions", "target_collision", "target_ksi")]


@query("targets", sql(
    f"SELECT * FROM (SELECT date, nbhd_id, {', '.join(_targets_sql(S.horizons))} FROM gold {WIN}) "
    f"WHERE collisions_t{max(S.horizons)} IS NOT NULL"))
def targets(spark, sf):
    """Future counts and binary targets; rows lacking the furthest lead dropped."""
    g = I.gold(spark, sf)
    w = Wn.area_window()
    cols = []
    for h in S.horizons:
        fc, fk = Wn.lead("collisions", h, w), Wn.lead("ksi_collisions", h, w)
        cols += [fc.alias(f"collisions_t{h}"),
                 (F.coalesce(fc, F.lit(0)) >= 1).cast("int").alias(f"target_collision_t{h}"),
                 (F.coalesce(fk, F.lit(0)) >= 1).cast("int").alias(f"target_ksi_t{h}")]
    return g.select("date", "nbhd_id", *cols).where(F.col(f"collisions_t{max(S.horizons)}").isNotNull())


@query("feature_table", sql("SELECT * FROM features", feature_table_ctes()))
def feature_table(spark, sf):
    """The full feature table (about 150 columns)."""
    return spark_features(spark, sf)


LEGACY_V1 = ["collisions", "ksi_collisions", "ksi_weighted_score"]


@query("legacy_features_v1", sql(
    "SELECT date, nbhd_id, " + ", ".join(
        [f"lag({c}, {L}) OVER w AS {c}_lag{L}" for c in LEGACY_V1 for L in (1, 7, 14)]
        + [x for x in _lag_roll_sql(LEGACY_V1, [], (7, 14)) if x.endswith("_mean")])
    + ", isodow(date) - 1 AS dow, month(date) AS month, year(date) AS year FROM gold " + WIN))
def legacy_features_v1(spark, sf):
    """Legacy lag/roll-mean features, grouped per area (trap T1 not reproduced)."""
    g = I.gold(spark, sf).select("date", "nbhd_id", *LEGACY_V1)
    out = Fe.legacy_features_v1(g)
    return out.drop(*LEGACY_V1)


def feature_column_names() -> list[str]:
    """Ordered column names of the K19 table (static, for generated SQL)."""
    from hoodcast.config import KSI_COLS, WEATHER_COLS
    gold = (["date", "nbhd_id", "area_id", "area_name", "collisions", *KSI_COLS, *WEATHER_COLS,
             "freeze_day", "snow_day", "rain_day", *ROAD_COLS])
    win = (["ksi_ratio_lag1"] + _lag_names(S.lag_cols, S.lags) + _roll_names(S.lag_cols, S.windows)
           + ["collision_momentum"] + _lag_names(HALO_COLS, S.halo_lags) + _roll_names(HALO_COLS, S.halo_windows)
           + TARGET_COLS)
    return gold + CAL_COLS + WX_COLS + ["ksi_ratio"] + HALO_OUT + win


@query("pressure_roll14", sql(
    "SELECT date, nbhd_id, construction_total_pressure, "
    "CASE WHEN count(construction_total_pressure) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) = 14 "
    "THEN sum(CAST(construction_total_pressure AS DOUBLE)) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) END "
    "AS construction_total_pressure_roll14, is_zone_disrupted FROM halo " + WIN, _halo_sql("legacy")))
def pressure_roll14(spark, sf):
    """Combined direct + neighbour construction pressure and its
    trailing 14-day sum (today excluded), legacy zone flag."""
    h = I.halo(spark, sf, "legacy")
    w = Wn.area_window()
    out = Wn.add_lag_roll(h.select("date", "nbhd_id", "construction_total_pressure", "is_zone_disrupted"),
                          ["construction_total_pressure"], [], [14], w)
    return out.select("date", "nbhd_id", "construction_total_pressure",
                      "construction_total_pressure_roll14_sum", "is_zone_disrupted").withColumnRenamed(
        "construction_total_pressure_roll14_sum", "construction_total_pressure_roll14")


V2_LAGS = ["collisions", "ksi_collisions", "ksi_weighted_score", "road_events_count", "road_events_severity_weighted",
           "road_events_full_closure_count", "road_construction_count", "road_construction_severity_weighted",
           "road_construction_full_closure_count"]
V2_SUMS = ["collisions", "ksi_collisions", "ksi_weighted_score", "road_events_count", "road_construction_count",
           "road_events_severity_weighted", "road_construction_severity_weighted"]


@query("legacy_features_v2", sql(
    "SELECT date, nbhd_id, " + ", ".join(
        [f"lag({c}, {L}) OVER w AS {c}_lag{L}" for c in V2_LAGS for L in (1, 7, 14)]
        + [x for x in _lag_roll_sql(V2_SUMS, [], (7, 14, 30)) if x.endswith("_sum")]) + " FROM gold " + WIN))
def legacy_features_v2(spark, sf):
    """Legacy v2 family, nine columns x three lags and seven columns x three trailing sums."""
    return Fe.legacy_features_v2(I.gold(spark, sf))


@query("road_statistics", sql("""
  SELECT g.date, g.nbhd_id, coalesce(r.n_roads, m.n_roads) AS n_roads, coalesce(r.length, m.length) AS length
  FROM gold g LEFT JOIN roads r USING (nbhd_id),
       (SELECT median(n_roads) AS n_roads, median(length) AS length FROM roads) m""", {"roads": """
  SELECT CAST(s_nationkey + 1 AS INTEGER) AS nbhd_id, CAST(count(*) AS DOUBLE) AS n_roads, CAST(sum(s_suppkey % 13) AS DOUBLE) AS length
  FROM supplier WHERE s_nationkey % 7 <> 3 GROUP BY 1"""}))
def road_statistics(spark, sf):
    """Per-area road statistics on the panel, areas without any filled with the median."""
    from hoodcast.sources.tables import read_table
    roads = read_table(spark, sf, "supplier").where("s_nationkey % 7 <> 3").groupBy(
        (F.col("s_nationkey") + 1).cast("int").alias("nbhd_id")).agg(
        F.count(F.lit(1)).cast("double").alias("n_roads"), F.sum(F.col("s_suppkey") % 13).cast("double").alias("length"))
    return Fe.with_road_stats(I.gold(spark, sf).select("date", "nbhd_id"), roads)


@query("street_features", sql("""
  SELECT g.date, g.nbhd_id, CAST(s.intersection_count AS DOUBLE) AS intersection_count,
         CAST(s.street_segment_count AS DOUBLE) AS street_segment_count, s.arterial_length_km, s.streets_per_node_avg
  FROM gold g JOIN streets s USING (nbhd_id)""", STREETS, recursive=True))
def street_features(spark, sf):
    """The areas' street networks as feature columns of the panel."""
    return Fe.with_road_stats(I.gold(spark, sf).select("date", "nbhd_id"), road_exposure_frame(spark, sf))


#: Columns of every window kind: running totals, frames over floats, leads, halo, row ratios.
BLOCK_COLS = ["date", "nbhd_id", "collisions_lag1", "collisions_lag14", "collisions_roll30_sum", "collisions_roll7_mean", "collision_momentum",
              "ksi_ratio_lag1", "collisions_t1", "target_ksi_t2"]


@query("feature_table_blocks", sql(f"SELECT {', '.join(BLOCK_COLS)} FROM features", feature_table_ctes()))
def feature_table_blocks(spark, sf):
    """K15-K19 over time blocks of 200 days: several tasks an area, the values of the whole history."""
    g, facts = I.gold_and_facts(spark, sf)
    return Fe.feature_table(g, I.adjacency(spark, sf), S, "production", facts, block_days=200).select(*BLOCK_COLS)
