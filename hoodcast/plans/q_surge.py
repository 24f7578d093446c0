"""Queries for the city series and surge layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from hoodcast.config import ADAPTER, BASE_LEAKAGE
from hoodcast.operators import selection as Se
from hoodcast.operators import surge as Su
from hoodcast.operators import windows as Wn
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.session import cut_lineage
from hoodcast.plans.oracle_sql import sql
from hoodcast.plans.q_features import feature_column_names, feature_table_ctes, spark_features
from hoodcast.sources.tables import read_table

S = ADAPTER
SPLIT = f"DATE '{S.split_date.isoformat()}'"
NON_NUMERIC = {"date", "area_id", "area_name"}


def _rollup_cols():
    return [c for c in feature_column_names() if c not in NON_NUMERIC and c not in BASE_LEAKAGE]


#: The oracle's own statement of the roll-up rules: first fragment list that a name matches wins.
ROLLUP_SQL = {
    False: [("sum", ("count", "collisions", "weighted", "score", "victims", "halo", "pressure", "lag", "roll", "momentum"))],
    True: [("max", ("is_", "disrupted", "pressure")), ("sum", ("count", "collisions", "weighted"))],
}


def _city_sql(three_way: bool) -> str:
    parts = ["round(CAST(sum(collisions) AS DOUBLE), 6) AS collisions"]
    for c in _rollup_cols():
        fn = next((f for f, fragments in ROLLUP_SQL[three_way] if any(x in c for x in fragments)), "avg")
        parts.append(f"round(CAST({fn}({c}) AS DOUBLE), 6) AS {c}")
    return sql(f"SELECT date, {', '.join(parts)} FROM features GROUP BY date", feature_table_ctes())


def _rounded(df, digits=6):
    return df.select("date", *[F.bround(F.col(c).cast("double"), digits).alias(c)
                               for c in df.columns if c != "date"])


@query("city_daily_agg", _city_sql(False))
def city_daily_agg(spark, sf):
    """Name-driven sum/mean roll-up of the feature table to one row per day
    (float results rounded to 6 dp so that summation order cannot show)."""
    return _rounded(Su.city_daily(spark_features(spark, sf)))


@query("city_daily_agg_three_way", _city_sql(True))
def city_daily_agg_three_way(spark, sf):
    """Legacy three-way roll-up (sum / mean / max, max wins)."""
    return _rounded(Su.city_daily(spark_features(spark, sf), three_way=True))


def feature_rows_city(spark, sf):
    """City totals over the rows the feature table keeps (lag1, roll7 and the
    furthest lead present) without building the wide table: three window
    columns over the narrow panel."""
    p = I.dense(spark, sf).select("date", "nbhd_id", "collisions")
    w = Wn.area_window()
    keep = (Wn.lag("collisions", 1, w).isNotNull() & Wn.trailing("collisions", 7, w).isNotNull()
            & Wn.lead("collisions", max(S.horizons), w).isNotNull())
    return cut_lineage(Su.city_total(p.withColumn("_k", keep).where("_k"), "collisions", "collisions"))


CITY_CTE = {"city": """
  SELECT date, CAST(sum(collisions) AS BIGINT) AS collisions FROM (
    SELECT date, collisions,
           lag(collisions, 1) OVER w IS NOT NULL
           AND count(collisions) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7
           AND lead(collisions, 2) OVER w IS NOT NULL AS keep
    FROM panel WINDOW w AS (PARTITION BY nbhd_id ORDER BY date))
  WHERE keep GROUP BY date"""}


def _thr_sql(h: int, seasonal: bool) -> str:
    fut = (f"SELECT date, lead(collisions, {h}) OVER (ORDER BY date) AS f FROM city")
    train = f"SELECT date, CAST(f AS DOUBLE) AS x FROM ({fut}) WHERE f IS NOT NULL AND date < {SPLIT}"
    if not seasonal:
        return f"SELECT {h} AS horizon, round(quantile_cont(x, 0.9), 6) AS threshold FROM ({train})"
    w60 = "(ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)"
    t = (f"SELECT x, CASE WHEN count(x) OVER {w60} >= 14 THEN avg(x) OVER {w60} END AS roll60, "
         f"CASE WHEN count(x) OVER {w60} >= 14 THEN stddev_samp(x) OVER {w60} END AS std60 FROM ({train})")
    z = f"SELECT *, CASE WHEN std60 <> 0 THEN (x - roll60) / std60 END AS z FROM ({t})"
    return (f"SELECT {h} AS horizon, round(CASE WHEN count(z) >= 30 THEN median(roll60) + "
            f"quantile_cont(z, 0.9) * median(std60) ELSE quantile_cont(x, 0.9) END, 6) AS threshold, "
            f"CASE WHEN count(z) >= 30 THEN 'seasonal' ELSE 'raw_quantile' END AS method, "
            f"count(z) AS n_valid FROM ({z})")


def _thresholds(spark, sf, seasonal: bool):
    city = feature_rows_city(spark, sf)
    out = []
    for h in S.horizons:
        fut = Su.future_series(city, h)
        train = fut.where(F.col("date") < F.lit(S.split_date))
        if seasonal:
            t = Su.seasonal_threshold(train, "city_collisions_future", S)
            out.append(t.select(F.lit(h).alias("horizon"), F.bround("threshold", 6).alias("threshold"),
                                "method", "n_valid"))
        else:
            t = Su.raw_threshold(train, "city_collisions_future", S.surge_pct)
            out.append(t.select(F.lit(h).alias("horizon"), F.bround("threshold", 6).alias("threshold")))
    return reduce(lambda a, b: a.unionByName(b), out)


@query("surge_threshold_seasonal",
       sql(" UNION ALL ".join(f"SELECT * FROM ({_thr_sql(h, True)})" for h in S.horizons), CITY_CTE))
def surge_threshold_seasonal(spark, sf):
    """Z-score vs trailing 60-day baseline, 90th percentile, mapped back."""
    return _thresholds(spark, sf, True)


@query("surge_threshold_raw",
       sql(" UNION ALL ".join(f"SELECT * FROM ({_thr_sql(h, False)})" for h in S.horizons), CITY_CTE))
def surge_threshold_raw(spark, sf):
    """Raw 90th percentile of the training future totals."""
    return _thresholds(spark, sf, False)


def _label_sql():
    parts = []
    for h in S.horizons:
        thr = f"(SELECT threshold FROM ({_thr_sql(h, True)}))"
        parts.append(
            f"SELECT date, {h} AS horizon, f AS city_collisions_future, {thr} AS threshold, "
            f"CAST(f >= {thr} AS INTEGER) AS y FROM (SELECT date, lead(collisions, {h}) OVER (ORDER BY date) AS f "
            f"FROM city) WHERE f IS NOT NULL")
    return sql(" UNION ALL ".join(parts), CITY_CTE)


@query("surge_label", _label_sql())
def surge_label(spark, sf):
    """Future city total vs the train-only seasonal threshold, per horizon."""
    city = feature_rows_city(spark, sf)
    out = []
    for h in S.horizons:
        lab = Su.surge_labels(city, h, S)
        out.append(lab.select("date", F.lit(h).alias("horizon"), "city_collisions_future",
                              F.bround("threshold", 6).alias("threshold"),
                              (F.col("city_collisions_future") >= F.bround("threshold", 6)).cast("int").alias("y")))
    return reduce(lambda a, b: a.unionByName(b), out)


def surge_predictions(spark, sf):
    """City-level probabilities of the test period from the counts themselves (a model that SQL can state):
    ``surge_proba_t{h} = x / (x + m)`` for the day's city total x and the mean m of the last 30 h days, the day included."""
    city = Su.city_total(I.dense(spark, sf))
    cols = []
    for h in S.horizons:
        w = Window.orderBy("date").rowsBetween(1 - 30 * h, 0)  # one row per day
        weighted = F.col("city_collisions") * F.count(F.lit(1)).over(w)
        both = weighted + F.sum("city_collisions").over(w)
        cols.append(F.when(both > 0, weighted / both).otherwise(F.lit(0.5)).alias(f"surge_proba_t{h}"))
    return city.select("date", *cols).where(F.col("date") >= F.lit(S.split_date))


SURGE_PRED_CTE = {"city_total": "SELECT date, sum(collisions)::BIGINT AS x FROM panel GROUP BY date", "surge_pred": f"""
  SELECT * FROM (SELECT date, {', '.join(f"""CASE WHEN x * count(*) OVER w{h} + sum(x) OVER w{h} > 0
      THEN (x * count(*) OVER w{h})::DOUBLE / (x * count(*) OVER w{h} + sum(x) OVER w{h})::DOUBLE ELSE 0.5::DOUBLE END AS surge_proba_t{h}""" for h in S.horizons)}
    FROM city_total WINDOW {', '.join(f"w{h} AS (ORDER BY date ROWS BETWEEN {30 * h - 1} PRECEDING AND CURRENT ROW)" for h in S.horizons)})
  WHERE date >= {SPLIT}"""}


@query("surge_merge_neutral", sql(
    "SELECT p.date, p.nbhd_id, " + ", ".join(
        f"CASE WHEN p.date < {SPLIT} OR s.surge_proba_t{h} IS NULL THEN 0.5 ELSE s.surge_proba_t{h} END "
        f"AS surge_proba_t{h}" for h in S.horizons)
    + " FROM panel p LEFT JOIN surge_pred s ON s.date = p.date", SURGE_PRED_CTE))
def surge_merge_neutral(spark, sf):
    """Test-period surge probability as a feature; train rows -> 0.5."""
    p = I.dense(spark, sf).select("date", "nbhd_id")
    out = Su.merge_surge_neutral(p, surge_predictions(spark, sf), S)
    return out.select("date", "nbhd_id", *[f"surge_proba_t{h}" for h in S.horizons])


@query("surge_merge_median", sql(
    "SELECT p.date, p.nbhd_id, coalesce(r.surge_proba, (SELECT median(r2.surge_proba) FROM panel p2 "
    "LEFT JOIN (SELECT date, avg(surge_proba) AS surge_proba FROM (SELECT date, surge_proba_t1 AS surge_proba "
    "FROM surge_pred UNION ALL SELECT date, surge_proba_t2 FROM surge_pred) GROUP BY date) r2 ON r2.date = p2.date))"
    " AS surge_proba FROM panel p LEFT JOIN (SELECT date, avg(surge_proba) AS surge_proba FROM ("
    "SELECT date, surge_proba_t1 AS surge_proba FROM surge_pred UNION ALL "
    "SELECT date, surge_proba_t2 FROM surge_pred) GROUP BY date) r ON r.date = p.date", SURGE_PRED_CTE))
def surge_merge_median(spark, sf):
    """K26 (legacy): mean over duplicate runs per date, left join, null -> median."""
    p = I.dense(spark, sf).select("date", "nbhd_id")
    sp = surge_predictions(spark, sf)
    runs = sp.select("date", F.col("surge_proba_t1").alias("surge_proba")).unionByName(
        sp.select("date", F.col("surge_proba_t2").alias("surge_proba")))
    return Su.merge_surge_median(p, runs).select("date", "nbhd_id", "surge_proba")


@query("exact_quantiles", """
  SELECT l_returnflag, l_linestatus, unnest(ps) AS p, n, round_even(unnest(qs), 4) AS quantile
  FROM (SELECT l_returnflag, l_linestatus, count(*) AS n, [0.0, 0.05, 0.5, 0.9, 0.999, 1.0]::DOUBLE[] AS ps,
               quantile_cont(l_extendedprice, [0.0, 0.05, 0.5, 0.9, 0.999, 1.0]) AS qs FROM lineitem GROUP BY 1, 2)""")
def exact_quantiles(spark, sf):
    """E8 grouped: exact interpolated quantiles of every price, hot groups among them, by distributed selection."""
    q = Se.quantiles(read_table(spark, sf, "lineitem"), "l_extendedprice", [0.0, 0.05, 0.5, 0.9, 0.999, 1.0], ["l_returnflag", "l_linestatus"])
    return q.withColumn("quantile", F.bround("quantile", 4))


@query("median_per_supplier", """
  SELECT l_suppkey, count(*) AS n, round_even(median(l_quantity), 4) AS median FROM lineitem GROUP BY 1""")
def median_per_supplier(spark, sf):
    """E9 grouped: the median of many small groups."""
    q = Se.quantiles(read_table(spark, sf, "lineitem"), "l_quantity", [0.5], "l_suppkey")
    return q.select("l_suppkey", "n", F.bround("quantile", 4).alias("median"))
