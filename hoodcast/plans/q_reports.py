"""Queries for the serving / report layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoodcast.config import ADAPTER
from hoodcast.operators import evaluate as Ev
from hoodcast.operators import features as Fe
from hoodcast.operators import models as M
from hoodcast.operators import reports as R
from hoodcast.operators import windows as Wn
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.plans.oracle_sql import sql
from hoodcast.plans.q_eval import EV_CTE, Y, _lift_sql, eval_frame
from hoodcast.plans.q_features import WEATHER_FLAGS_SQL, _halo_sql, feature_table_ctes, spark_features, staged_features
from hoodcast.plans.q_surge import SURGE_PRED_CTE, surge_predictions
from hoodcast.session import cut_lineage
from hoodcast.sources import adapter as A
from hoodcast.sources import readers as Rd
from hoodcast.sources.tables import read_table

S = ADAPTER
SPLIT = f"DATE '{S.split_date.isoformat()}'"


# ----------------------------------------------------------------------------
# inputs: a prediction table from the counts and a narrow report base
# ----------------------------------------------------------------------------

def nbhd_predictions(spark, sf):
    """Test-period area predictions from the counts themselves (a frequency model that SQL can state):
    ``proba_collision_t{h}`` and ``proba_ksi_t{h}`` are the smoothed shares of the last 30 h days, the day
    itself included, that had a collision or a KSI collision; ``risk_score_t{h} = 0.6 p + 0.4 k`` (L8)."""
    first = F.date_sub(F.lit(S.split_date), 30 * max(S.horizons))
    p = I.dense(spark, sf).select("date", "nbhd_id", "collisions").where(F.col("date") >= first)
    p = p.join(I.ksi_daily(spark, sf).select("date", "nbhd_id", "ksi_collisions"), ["date", "nbhd_id"], "left")
    cols = []
    for h in S.horizons:
        w = Wn.area_window().rowsBetween(1 - 30 * h, 0)
        pc, pk = ((F.count_if(F.coalesce(F.col(c), F.lit(0)) > 0).over(w) + 1) / (F.count(F.lit(1)).over(w) + 2)
                  for c in ("collisions", "ksi_collisions"))
        cols += [pc.alias(f"proba_collision_t{h}"), pk.alias(f"proba_ksi_t{h}")]
    p = p.select("date", "nbhd_id", *cols).where(F.col("date") >= F.lit(S.split_date))
    risk = [M.blend(f"proba_collision_t{h}", f"proba_ksi_t{h}", S.blend_collision, S.blend_ksi).alias(f"risk_score_t{h}") for h in S.horizons]
    return p.select("date", "nbhd_id", *[x for h, r in zip(S.horizons, risk) for x in (f"proba_collision_t{h}", f"proba_ksi_t{h}", r)])


def _pred_sql():
    cols, risk = [], []
    for h in S.horizons:
        w = f"OVER (PARTITION BY nbhd_id ORDER BY date ROWS BETWEEN {30 * h - 1} PRECEDING AND CURRENT ROW)"
        for c, name in (("collisions", "collision"), ("ksi_collisions", "ksi")):
            cols.append(f"(sum(CASE WHEN {c} > 0 THEN 1 ELSE 0 END) {w} + 1)::DOUBLE / (count(*) {w} + 2)::DOUBLE AS proba_{name}_t{h}")
        risk += [f"proba_collision_t{h}", f"proba_ksi_t{h}",
                 f"{S.blend_collision}::DOUBLE * proba_collision_t{h} + {S.blend_ksi}::DOUBLE * proba_ksi_t{h} AS risk_score_t{h}"]
    return f"SELECT date, nbhd_id, {', '.join(risk)} FROM (SELECT date, nbhd_id, {', '.join(cols)} FROM gold) WHERE date >= {SPLIT}"


PRED_CTE = {"pred": _pred_sql(), "pred_latest": "SELECT * FROM pred WHERE date = (SELECT max(date) FROM pred)",
            **SURGE_PRED_CTE}


def report_base(spark, sf):
    """The rows the feature table keeps (lag1, roll7 and the furthest lead
    present), with the columns the reports read: a narrow window pass instead
    of the full feature build."""
    g = I.gold(spark, sf).select("date", "nbhd_id", "collisions", "ksi_collisions", "tavg", "tmin", "tmax",
                                 "prcp", "snow", "wspd", "road_construction_count")
    g = Fe.weather_interactions(g)
    w = Wn.area_window()
    keep = (Wn.lag("collisions", 1, w).isNotNull() & Wn.trailing("collisions", 7, w).isNotNull()
            & Wn.lead("collisions", max(S.horizons), w).isNotNull())
    return cut_lineage(g.withColumn("_k", keep).where("_k").drop("_k"))


BASE_CTE = {"rbase": f"""
  SELECT * EXCLUDE (keep) FROM (
    SELECT date, nbhd_id, collisions, ksi_collisions, tavg, tmin, tmax, prcp, snow, wspd, road_construction_count,
           {WEATHER_FLAGS_SQL},
           lag(collisions, 1) OVER w IS NOT NULL
           AND count(collisions) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7
           AND lead(collisions, 2) OVER w IS NOT NULL AS keep
    FROM gold WINDOW w AS (PARTITION BY nbhd_id ORDER BY date))
  WHERE keep""",
    "city": "SELECT date, CAST(sum(collisions) AS BIGINT) AS city_collisions FROM rbase GROUP BY date"}


# ----------------------------------------------------------------------------
# O1-O4
# ----------------------------------------------------------------------------

@query("latest_surge", sql(
    "SELECT strftime(date, '%Y-%m-%d') AS date, surge_proba_t1, surge_proba_t2 FROM surge_pred "
    "WHERE date = (SELECT max(date) FROM surge_pred)", SURGE_PRED_CTE))
def latest_surge(spark, sf):
    """O1: latest surge probabilities."""
    return R.latest_surge(surge_predictions(spark, sf))


def _topk_sql(h, k):
    return sql(f"""
  SELECT strftime(date, '%Y-%m-%d') AS date, nbhd_id, area_name, proba_collision_t{h}, risk_score_t{h}, rk AS rank_t{h}
  FROM (SELECT p.*, a.area_name, row_number() OVER (ORDER BY risk_score_t{h} DESC, p.nbhd_id) AS rk
        FROM pred_latest p LEFT JOIN areas a USING (nbhd_id))
  WHERE rk <= {k}""", PRED_CTE)


@query("topk_areas", _topk_sql(1, 10))
def topk_areas(spark, sf):
    """O2: top-10 areas for T+1 on the latest date, with names and rank."""
    return R.topk_areas(nbhd_predictions(spark, sf), A.areas(spark, sf), 1, 10)


@query("topk_areas_t2", _topk_sql(2, 5))
def topk_areas_t2(spark, sf):
    """O2: top-5 areas for T+2."""
    return R.topk_areas(nbhd_predictions(spark, sf), A.areas(spark, sf), 2, 5)


@query("slim_mart", sql(f"SELECT {', '.join(R.SLIM_COLS)} FROM features", feature_table_ctes()))
def slim_mart(spark, sf):
    """The dashboard's slim feature mart (wanted columns that exist)."""
    return R.slim_mart(spark_features(spark, sf))


@query("latest_mart", sql("SELECT * FROM pred_latest", PRED_CTE))
def latest_mart(spark, sf):
    """The area predictions of the latest date, all columns."""
    return R.latest(nbhd_predictions(spark, sf))


# ----------------------------------------------------------------------------
# O5-O11
# ----------------------------------------------------------------------------

LAST = "(SELECT max(date) FROM city)"


@query("city_overview", sql(f"""
  SELECT avg_30, p AS surge_proba, coalesce(CAST(trunc(avg_30 * (1 + (p - 0.5))) AS INTEGER), 0) AS expected,
         CASE WHEN p >= 0.7 THEN 'Elevated Readiness' WHEN p >= 0.4 THEN 'Watch' ELSE 'Normal Readiness' END AS posture
  FROM (SELECT avg(city_collisions) AS avg_30,
               (SELECT surge_proba_t1 FROM surge_pred WHERE date = (SELECT max(date) FROM surge_pred)) AS p
        FROM city WHERE date > {LAST} - 30)""", {**BASE_CTE, **SURGE_PRED_CTE}))
def city_overview(spark, sf):
    """30-day city average, expected collisions from the surge probability, posture."""
    city = R.city_series(report_base(spark, sf))
    sp = surge_predictions(spark, sf)
    p = R.latest(sp).select("surge_proba_t1").scalar()
    return R.city_overview(city, p)


@query("expected_collisions", sql("""
  SELECT p.nbhd_id, p.risk_score_t1, coalesce(r.avg_30d, 1.0) AS avg_30d,
         round_even(coalesce(r.avg_30d, 1.0) * p.risk_score_t1 * 2, 1) AS exp_coll
  FROM pred_latest p LEFT JOIN (
    SELECT nbhd_id, avg(collisions) AS avg_30d FROM (
      SELECT nbhd_id, collisions, row_number() OVER (PARTITION BY nbhd_id ORDER BY date DESC) AS rn FROM rbase)
    WHERE rn <= 30 GROUP BY nbhd_id) r USING (nbhd_id)""", {**BASE_CTE, **PRED_CTE}))
def expected_collisions(spark, sf):
    """Expected collisions per area = round(avg of last 30 rows x score x 2, 1)."""
    pl = R.latest(nbhd_predictions(spark, sf)).select("nbhd_id", "risk_score_t1")
    return R.expected_collisions(pl, R.area_recent_mean(report_base(spark, sf), 30), "risk_score_t1")


@query("trend_90d", sql(f"""
  SELECT date, city_collisions, a30 AS avg_30, least(CAST(city_collisions AS DOUBLE), a30) AS clipped,
         greatest(CAST(city_collisions AS DOUBLE), a30) AS upper, city_collisions > a30 AS above,
         CASE WHEN r7 > a30 THEN 'Above normal' ELSE 'Below normal' END AS recent_7_vs_avg
  FROM (SELECT *, (SELECT avg(city_collisions) FROM city WHERE date > {LAST} - 30) AS a30,
               (SELECT avg(city_collisions) FROM city WHERE date > {LAST} - 7) AS r7
        FROM city WHERE date > {LAST} - 90)""", BASE_CTE))
def trend_90d(spark, sf):
    """90-day city trend with the 30-day average band."""
    return R.trend_90d(R.city_series(report_base(spark, sf)))


@query("current_weather", sql("""
  SELECT date, tavg, prcp, snow, wspd,
         CASE WHEN fr = 1 AND hs = 1 THEN 'Freezing Rain, Heavy Snow' WHEN fr = 1 THEN 'Freezing Rain'
              WHEN hs = 1 THEN 'Heavy Snow' WHEN bad = 1 THEN 'Adverse' ELSE 'Normal' END AS conditions
  FROM (SELECT DISTINCT date, tavg, prcp, snow, wspd,
               CAST(prcp > 0 AND tmin <= 0 AS INT) AS fr, CAST(snow > 5 AS INT) AS hs,
               CAST((prcp > 0 AND tmin <= 0) OR (prcp > 2 AND wspd > 30) OR snow > 5 AS INT) AS bad
        FROM rbase WHERE date = (SELECT max(date) FROM rbase))""", BASE_CTE))
def current_weather(spark, sf):
    """Weather of the latest feature date with its condition labels."""
    return R.weather_card(report_base(spark, sf).where(F.col("nbhd_id") == 1))


@query("weather_conditions", sql("""
  SELECT DISTINCT date,
         CASE WHEN prcp > 0 AND tmin <= 0 AND snow > 5 THEN 'Freezing Rain, Heavy Snow'
              WHEN prcp > 0 AND tmin <= 0 THEN 'Freezing Rain' WHEN snow > 5 THEN 'Heavy Snow'
              WHEN prcp > 2 AND wspd > 30 THEN 'Adverse' ELSE 'Normal' END AS conditions
  FROM rbase""", BASE_CTE))
def weather_conditions(spark, sf):
    """O8 on every date: the card's condition label."""
    b = report_base(spark, sf).where(F.col("nbhd_id") == 1)
    return b.select("date", R.condition_label().alias("conditions"))


@query("risk_map", sql("""
  SELECT nbhd_id, area_name, s AS score, p1 AS proba, exp_coll, coalesce(rk <= 10, false) AS top_k,
         coalesce(CASE WHEN max(s) OVER () - min(s) OVER () <> 0
                       THEN (s - min(s) OVER ()) / (max(s) OVER () - min(s) OVER ()) END, 0.0) AS scaled
  FROM (SELECT a.nbhd_id, a.area_name, coalesce(round_even(p.risk_score_t1, 3), 0.0) AS s,
               round_even(p.proba_collision_t1, 3) AS p1, p.exp_coll, p.rk
        FROM areas a LEFT JOIN (
          SELECT nbhd_id, risk_score_t1, proba_collision_t1,
                 row_number() OVER (ORDER BY risk_score_t1 DESC, nbhd_id) AS rk,
                 round_even(coalesce(r.avg_30d, 1.0) * risk_score_t1 * 2, 1) AS exp_coll
          FROM pred_latest LEFT JOIN recent r USING (nbhd_id)) p USING (nbhd_id))""",
                        {**BASE_CTE, **PRED_CTE, "recent": """
    SELECT nbhd_id, avg(collisions) AS avg_30d FROM (
      SELECT nbhd_id, collisions, row_number() OVER (PARTITION BY nbhd_id ORDER BY date DESC) AS rn FROM rbase)
    WHERE rn <= 30 GROUP BY nbhd_id"""}))
def risk_map(spark, sf):
    """All areas with the latest score and probability (3 dp, missing score -> 0), expected
    collisions, top-10 flag, min-max scale."""
    pl = R.latest(nbhd_predictions(spark, sf))
    exp = R.expected_collisions(pl, R.area_recent_mean(report_base(spark, sf), 30), "risk_score_t1")
    return R.risk_map(A.areas(spark, sf), pl.join(exp.select("nbhd_id", "exp_coll"), "nbhd_id", "left"),
                      "risk_score_t1", 10, "proba_collision_t1")


REASON_COLS = ["date", "nbhd_id", "collisions", "collisions_lag1", "collision_momentum", "freezing_rain", "heavy_snow",
               "feels_bad", "is_holiday", "pre_holiday", "is_weekend", "road_construction_count_lag1", "is_zone_disrupted"]

#: Per area and date the reasons with their categories, over ``rows`` with ``avg_30d``.
REASONS_SQL = """
  SELECT date, nbhd_id,
         CASE WHEN len(r) = 0 THEN ['Elevated collision history in this area'] ELSE list_transform(r[1:4], lambda x: x[2]) END AS reasons,
         CASE WHEN len(r) = 0 THEN ['traffic'] ELSE list_transform(r[1:4], lambda x: x[1]) END AS categories
  FROM (
    SELECT date, nbhd_id, list_filter([
        CASE WHEN coalesce(CAST(collisions_lag1 AS DOUBLE), 0.0) > avg_30d * 1.5
             THEN ['traffic', printf('Yesterday had %d collisions (above average)', CAST(coalesce(collisions_lag1, 0) AS INTEGER))] END,
        CASE WHEN mom > 1.4
             THEN ['traffic', printf('Collision activity is %.1fx the recent baseline', round_even(mom, 1))] END,
        CASE WHEN freezing_rain = 1 THEN ['weather', 'Freezing rain forecast'] WHEN heavy_snow = 1 THEN ['weather', 'Heavy snow forecast']
             WHEN feels_bad = 1 THEN ['weather', 'Adverse weather conditions'] END,
        CASE WHEN is_holiday = 1 THEN ['calendar', 'Public holiday'] WHEN pre_holiday = 1 THEN ['calendar', 'Day before a public holiday']
             WHEN is_weekend = 1 THEN ['calendar', 'Weekend traffic patterns'] END,
        CASE WHEN road_construction_count_lag1 > 0 THEN ['road', 'Active road construction nearby']
             WHEN is_zone_disrupted = 1 THEN ['road', 'Road disruptions in adjacent zones'] END], lambda x: x IS NOT NULL) AS r
    FROM (SELECT *, CASE WHEN coalesce(collision_momentum, 0.0) = 0 THEN 1.0 ELSE collision_momentum END AS mom FROM rows_))"""


@query("why_high_risk", sql(REASONS_SQL, {**feature_table_ctes(), "rows_": """
    SELECT f.*, m.avg_30d FROM features f JOIN (
      SELECT nbhd_id, avg(collisions) AS avg_30d FROM (
        SELECT nbhd_id, collisions, row_number() OVER (PARTITION BY nbhd_id ORDER BY date DESC) AS rn FROM features)
      WHERE rn <= 30 GROUP BY nbhd_id) m USING (nbhd_id)
    WHERE f.date = (SELECT max(date) FROM features)"""}))
def why_high_risk(spark, sf):
    """Up to four ordered reasons per area on the latest date, with their categories."""
    return R.why_high_risk(staged_features(spark, sf, REASON_COLS))


@query("why_high_risk_history", sql(REASONS_SQL, {**feature_table_ctes(), "rows_": """
    SELECT *, avg(collisions) OVER (PARTITION BY nbhd_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS avg_30d
    FROM features"""}))
def why_high_risk_history(spark, sf):
    """O10 as of every date: the reasons of each (date, area)."""
    w = Wn.area_window().rowsBetween(-29, 0)
    f = spark_features(spark, sf).select(*REASON_COLS).withColumn("avg_30d", F.avg("collisions").over(w))
    return R.reasons(f)


@query("risk_bands", sql("""
  SELECT count(*) FILTER (WHERE risk_score_t1 >= 0.7) AS n_high,
         count(*) FILTER (WHERE risk_score_t1 >= 0.4 AND risk_score_t1 < 0.7) AS n_medium,
         count(*) FILTER (WHERE risk_score_t1 < 0.4) AS n_low FROM pred_latest""", PRED_CTE))
def risk_bands(spark, sf):
    """Areas per risk band on the latest date."""
    return R.risk_bands(R.latest(nbhd_predictions(spark, sf)), "risk_score_t1", S.band_high, S.band_medium)


# ----------------------------------------------------------------------------
# O12-O16
# ----------------------------------------------------------------------------

@query("seasonality_year", sql("""
  SELECT year, total, (SELECT avg(total) FROM yr) AS long_avg, total > (SELECT avg(total) FROM yr) AS above_avg
  FROM yr""", {**BASE_CTE, "yr0": """
  SELECT year(date) AS year, CAST(sum(city_collisions) AS BIGINT) AS total FROM city GROUP BY 1""",
                "yr": """
  SELECT * FROM yr0 WHERE year < (SELECT max(year(date)) FROM city)
     OR (SELECT count(DISTINCT month(date)) FROM city WHERE year(date) = (SELECT max(year(date)) FROM city)) >= 6"""}))
def seasonality_year(spark, sf):
    """Yearly totals vs the long-run mean (short final year dropped)."""
    out = R.seasonality_year(R.city_series(report_base(spark, sf)))
    return out.select("year", F.col("total").cast("bigint").alias("total"), "long_avg", "above_avg")


def _season_sql(key, keyexpr, names, name_col):
    arr = "[" + ", ".join(f"'{x}'" for x in names) + "]"
    idx = f"{key}" if key == "month" else f"{key} + 1"
    return sql(f"""
  SELECT {key}, {arr}[{idx}] AS {name_col}, avg,
         CASE WHEN row_number() OVER (ORDER BY avg DESC, {key}) <= 3 THEN 'high3'
              WHEN row_number() OVER (ORDER BY avg ASC, {key}) <= 3 THEN 'low3' ELSE 'typical' END AS label
  FROM (SELECT {keyexpr} AS {key}, avg(city_collisions) AS avg FROM city GROUP BY 1)""", BASE_CTE)


@query("seasonality_month", _season_sql("month", "month(date)", R.MONTHS, "month_name"))
def seasonality_month(spark, sf):
    """Monthly mean with top-3 / bottom-3 labels."""
    return R.seasonality_month(R.city_series(report_base(spark, sf)))


@query("seasonality_weekday", _season_sql("dow", "isodow(date) - 1", R.WEEKDAYS, "dow_name"))
def seasonality_weekday(spark, sf):
    """Weekday mean (Mon=0) with labels."""
    return R.seasonality_weekday(R.city_series(report_base(spark, sf)))


@query("weather_impact", sql("""
  SELECT ord, condition, avg, CASE WHEN norm > 0 THEN (avg - norm) / norm * 100 ELSE 0.0 END AS pct_vs_normal
  FROM (SELECT *, (SELECT avg(c) FROM d WHERE freezing_rain = 0 AND heavy_snow = 0 AND wind_rain = 0) AS norm FROM (
    SELECT 0 AS ord, 'Normal Days' AS condition, avg(c) AS avg FROM d WHERE freezing_rain = 0 AND heavy_snow = 0 AND wind_rain = 0
    UNION ALL SELECT 1, 'Freezing Rain', avg(c) FROM d WHERE freezing_rain = 1
    UNION ALL SELECT 2, 'Heavy Snow', avg(c) FROM d WHERE heavy_snow = 1
    UNION ALL SELECT 3, 'High Wind And Rain', avg(c) FROM d WHERE wind_rain = 1))
  WHERE avg IS NOT NULL""", {**BASE_CTE, "d": """
  SELECT date, sum(collisions) AS c, max(freezing_rain) AS freezing_rain, max(heavy_snow) AS heavy_snow,
         max(wind_rain) AS wind_rain FROM rbase GROUP BY date"""}))
def weather_impact(spark, sf):
    """Mean city collisions by weather condition vs normal days."""
    b = report_base(spark, sf)
    d = b.groupBy("date").agg(F.sum("collisions").alias("city_collisions"),
                              *[F.max(c).alias(c) for c in ("freezing_rain", "heavy_snow", "wind_rain")])
    return R.weather_impact(d)


@query("ksi_monthly", sql("""
  SELECT year, month, make_date(year, month, 1) AS period, ksi, avg(ksi) OVER () AS long_avg FROM (
    SELECT year(date) AS year, month(date) AS month, CAST(sum(ksi_collisions) AS BIGINT) AS ksi
    FROM rbase GROUP BY 1, 2)""", BASE_CTE))
def ksi_monthly(spark, sf):
    """KSI collisions per month vs the long-run monthly mean."""
    out = R.ksi_monthly(report_base(spark, sf))
    return out.select("year", "month", "period", F.col("ksi").cast("bigint").alias("ksi"), "long_avg")


@query("construction_timeline", sql(
    "SELECT date, CAST(sum(road_construction_count) AS BIGINT) AS construction_total, "
    "count(*) FILTER (WHERE road_construction_count > 0) AS active_areas FROM gold GROUP BY date"))
def construction_timeline(spark, sf):
    """City construction total and number of active areas per date."""
    g = I.gold(spark, sf)
    return g.groupBy("date").agg(F.sum("road_construction_count").cast("bigint").alias("construction_total"),
                                 F.count_if(F.col("road_construction_count") > 0).alias("active_areas"))


@query("neighbour_histogram", sql(
    "SELECT n_neighbours, count(*) AS n_areas FROM (SELECT nbhd_id, count(*) AS n_neighbours FROM adj GROUP BY 1) "
    "GROUP BY 1"))
def neighbour_histogram(spark, sf):
    """How many areas have N neighbours."""
    a = I.adjacency(spark, sf)
    per = a.groupBy("nbhd_id").agg(F.count(F.lit(1)).alias("n_neighbours"))
    return per.groupBy("n_neighbours").agg(F.count(F.lit(1)).alias("n_areas"))


@query("halo_argmax", sql("""
  SELECT nbhd_id, n_days FROM (
    SELECT nbhd_id, count(*) AS n_days FROM halo WHERE road_construction_count_halo > road_construction_count
    GROUP BY 1) ORDER BY n_days DESC, nbhd_id LIMIT 1""",
                           _halo_sql()))
def halo_argmax(spark, sf):
    """The area with the most days where neighbour construction
    exceeded its own (ties: lowest id)."""
    h = I.halo(spark, sf)
    c = (h.where(F.col("road_construction_count_halo") > F.col("road_construction_count"))
         .groupBy("nbhd_id").agg(F.count(F.lit(1)).alias("n_days")))
    return c.orderBy(F.col("n_days").desc(), "nbhd_id").limit(1)


@query("model_performance", sql(
    "SELECT metric, value FROM (" + _lift_sql((5, 10, 15, 20)) + ") UNPIVOT (value FOR metric IN (" + ", ".join(
        ["baseline_pos_rate"] + [f"{m}_at_{k}" for k in (5, 10, 15, 20) for m in ("precision", "recall", "lift")])
    + "))", EV_CTE))
def model_performance(spark, sf):
    """P@K / R@K / lift for K = 5, 10, 15, 20 and the base rate, as (metric, value) rows."""
    lf = Ev.lift_at_k(eval_frame(spark, sf), "score", Y, (5, 10, 15, 20))
    cols = [c for c in lf.columns]
    return lf.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "metric", "value").where(F.col("value").isNotNull())





@query("city_row_per_date", sql(
    "SELECT date, max(nbhd_id) AS nbhd_id, arg_max(collisions, nbhd_id) AS collisions FROM panel GROUP BY date"))
def city_row_per_date(spark, sf):
    """the highest-id area's row per date (the reference's scoring 'city row')."""
    return R.last_row_per_date(I.dense(spark, sf).select("date", "nbhd_id", "collisions"))


@query("area_batches", sql(
    "SELECT nbhd_id, area_name, CAST(floor((row_number() OVER (ORDER BY nbhd_id) - 1) / 10) AS INTEGER) AS batch "
    "FROM areas"))
def area_batches(spark, sf):
    """Areas in fixed batches of 10 by id."""
    return R.batch_ids(A.areas(spark, sf).select("nbhd_id", "area_name"), "nbhd_id", 10)


@query("expected_collisions_gaps", sql("""
  SELECT p.nbhd_id, p.risk_score_t1, a AS avg_30d, round_even(a * p.risk_score_t1 * 2, 1) AS exp_coll
  FROM (SELECT p.*, coalesce(r.avg_30d, (SELECT avg(city_collisions) FROM city WHERE date > (SELECT max(date) FROM city) - 30) / 25) AS a
        FROM pred_latest p LEFT JOIN (
          SELECT nbhd_id, avg(collisions) AS avg_30d FROM (
            SELECT nbhd_id, collisions, row_number() OVER (PARTITION BY nbhd_id ORDER BY date DESC) AS rn FROM rbase WHERE nbhd_id % 6 <> 0)
          WHERE rn <= 30 GROUP BY nbhd_id) r USING (nbhd_id)) p""", {**BASE_CTE, **PRED_CTE}))
def expected_collisions_gaps(spark, sf):
    """Areas without feature rows take their part of the city's average."""
    base = report_base(spark, sf)
    pl = R.latest(nbhd_predictions(spark, sf)).select("nbhd_id", "risk_score_t1")
    return R.expected_collisions(pl, R.area_recent_mean(base.where("nbhd_id % 6 <> 0"), 30), "risk_score_t1",
                                 R.city_share(R.city_series(base), 25))


@query("metric_cards", f"""
  SELECT h AS horizon, CASE h WHEN 1 THEN 'surge_t1' WHEN 2 THEN 'surge_t2' ELSE 'surge_t1' END AS model, count(*) AS n_test,
         round_even(avg(CASE WHEN l_quantity >= 25 + CASE WHEN h = 2 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END), 4) AS pos_rate, 2::BIGINT AS n_surge, 0::BIGINT AS n_nbhd
  FROM lineitem, (SELECT unnest([1, 2, 7]) AS h) GROUP BY h""")
def metric_cards(spark, sf):
    """O3 + O15: two landed metric lists (one file missing), and the card of three horizons, one without a model of its own."""
    rows = read_table(spark, sf, "lineitem")
    records = [rows.agg(F.lit(f"surge_t{h}").alias("model"), F.count("*").alias("n_test"),
                        F.bround(F.avg((F.col("l_quantity") >= 24 + h).cast("double")), 4).alias("pos_rate")) for h in S.horizons]
    path = Rd.landing_dir(spark, "metrics")
    Rd.write_small_json(records[1].unionByName(records[0]), path)
    schema = records[0].schema
    surge, nbhd = (Rd.read_json_records(spark, p, schema) for p in (path, f"{path}-none"))
    lists = R.metrics_lists(surge, nbhd)
    sizes = [lists.select(F.size(c).cast("bigint")).scalar().alias(f"n_{c.split('_')[0]}") for c in ("surge_metrics", "nbhd_metrics")]
    cards = [R.metric_card(lists.select(F.inline("surge_metrics")), h) for h in (1, 2, 7)]
    return cards[0].unionByName(cards[1]).unionByName(cards[2]).select("horizon", "model", "n_test", "pos_rate", *sizes)
