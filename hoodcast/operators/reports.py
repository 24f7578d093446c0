"""Serving and report queries.

All results are DataFrames. "Latest" means ``date = max(date)`` as a scalar
subquery (C4), so a latest-day report scans one date partition of a
date-partitioned table. City series are one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoodcast.functions.columns import safe_div

# Abbreviated month / weekday names in calendar order.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def latest(df: DataFrame, date_col: str = "date") -> DataFrame:
    """C4: rows of the most recent date."""
    return df.where(F.col(date_col) == df.select(F.max(date_col)).scalar())


def latest_surge(surge: DataFrame, horizons=(1, 2)) -> DataFrame:
    """O1: latest date (``yyyy-MM-dd``) and its surge probabilities (null if absent)."""
    l = latest(surge)
    cols = [F.col(f"surge_proba_t{h}") if f"surge_proba_t{h}" in surge.columns
            else F.lit(None).cast("double") for h in horizons]
    return l.select(F.date_format("date", "yyyy-MM-dd").alias("date"),
                    *[c.alias(f"surge_proba_t{h}") for c, h in zip(cols, horizons)])


def topk_areas(preds: DataFrame, names: DataFrame, horizon: int = 1, k: int = 10) -> DataFrame:
    """O2: latest-date areas ranked by ``risk_score_t{h}`` (falling back to the
    collision probability), with names; 1 <= k <= 50, horizon in (1, 2)."""
    if horizon not in (1, 2):
        raise ValueError("horizon must be 1 or 2")
    if not 1 <= k <= 50:
        raise ValueError("k must be within 1..50")
    score = f"risk_score_t{horizon}" if f"risk_score_t{horizon}" in preds.columns \
        else f"proba_collision_t{horizon}"
    l = latest(preds).join(names.select("nbhd_id", "area_name").dropDuplicates(["nbhd_id"]), "nbhd_id", "left")
    w = Window.orderBy(F.col(score).desc_nulls_last(), "nbhd_id")  # one day of areas
    r = l.withColumn(f"rank_t{horizon}", F.row_number().over(w))
    keep = [c for c in (f"proba_collision_t{horizon}", f"risk_score_t{horizon}") if c in preds.columns]
    return (r.where(F.col(f"rank_t{horizon}") <= k)
            .select(F.date_format("date", "yyyy-MM-dd").alias("date"), "nbhd_id", "area_name", *keep,
                    f"rank_t{horizon}"))


#: The slim mart's columns.
SLIM_COLS = ("date", "nbhd_id", "collisions", "ksi_collisions", "collisions_lag1", "collisions_roll30_mean",
             "collision_momentum", "tavg", "prcp", "snow", "wspd", "freezing_rain", "heavy_snow", "feels_bad",
             "wind_rain", "is_holiday", "pre_holiday", "post_holiday", "is_weekend",
             "road_construction_count_lag1", "is_zone_disrupted")


def slim_mart(features: DataFrame, wanted=SLIM_COLS) -> DataFrame:
    """The wanted columns that exist."""
    return features.select(*[c for c in wanted if c in features.columns])


def city_series(df: DataFrame, col: str = "collisions", out: str = "city_collisions") -> DataFrame:
    return df.groupBy("date").agg(F.sum(col).alias(out))


def last_n_days(city: DataFrame, n: int, date_col: str = "date") -> DataFrame:
    """the last ``n`` rows of a one-row-per-day series."""
    return city.where(F.col(date_col) > F.date_sub(city.select(F.max(date_col)).scalar(), n))


def city_overview(city: DataFrame, surge_p: Column, value: str = "city_collisions") -> DataFrame:
    """30-day average, expected = int(avg30 * (1 + (p - 0.5))), posture."""
    a = last_n_days(city, 30).agg(F.avg(value).alias("avg_30"))
    p = surge_p
    posture = F.when(p >= 0.7, "Elevated Readiness").when(p >= 0.4, "Watch").otherwise("Normal Readiness")
    return a.select("avg_30", p.alias("surge_proba"),
                    F.coalesce((F.col("avg_30") * (F.lit(1) + (p - 0.5))).cast("int"), F.lit(0)).alias("expected"),
                    posture.alias("posture"))


def area_recent_mean(df: DataFrame, n: int = 30, col: str = "collisions", out: str = "avg_30d") -> DataFrame:
    """per area, mean of its ``n`` most recent rows."""
    w = Window.partitionBy("nbhd_id").orderBy(F.col("date").desc())
    return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
            .groupBy("nbhd_id").agg(F.avg(col).alias(out)))


def city_share(city: DataFrame, n_areas: int, value: str = "city_collisions") -> Column:
    """An area's part of the city's 30-day average, for areas without days of their own; 1 if there is no average."""
    avg30 = last_n_days(city, 30).select(F.avg(value)).scalar()
    return F.coalesce(F.when(avg30 != 0, avg30 / n_areas), F.lit(1.0))


def expected_collisions(preds_latest: DataFrame, recent: DataFrame, score: str, fallback: float | Column = 1.0) -> DataFrame:
    """``round(avg30 * score * 2, 1)`` with the average defaulting to ``fallback`` (a number or ``city_share``)."""
    fallback = fallback if isinstance(fallback, Column) else F.lit(fallback)
    j = preds_latest.join(recent, "nbhd_id", "left").withColumn(
        "avg_30d", F.coalesce(F.col("avg_30d"), fallback))
    return j.select("nbhd_id", score, "avg_30d", F.bround(F.col("avg_30d") * F.col(score) * 2, 1).alias("exp_coll"))


def trend_90d(city: DataFrame, value: str = "city_collisions") -> DataFrame:
    """Last 90 days with the 30-day average line, the value clipped at the
    line, above/below flags and the 7-day-vs-average verdict."""
    avg30 = last_n_days(city, 30).select(F.avg(value)).scalar()
    r7 = last_n_days(city, 7).select(F.avg(value)).scalar()
    t = last_n_days(city, 90)
    return t.select("date", value, avg30.alias("avg_30"),
                    F.least(F.col(value).cast("double"), avg30).alias("clipped"),
                    F.greatest(F.col(value).cast("double"), avg30).alias("upper"),
                    (F.col(value) > avg30).alias("above"),
                    F.when(r7 > avg30, "Above normal").otherwise("Below normal").alias("recent_7_vs_avg"))


def condition_label() -> Column:
    """Freezing rain and/or heavy snow joined by a comma, else adverse, else normal (fixed texts)."""
    both = F.concat_ws(", ", F.when(F.col("freezing_rain") == 1, "Freezing Rain"),
                       F.when(F.col("heavy_snow") == 1, "Heavy Snow"))
    return F.when(both != "", both).when(F.col("feels_bad") == 1, "Adverse").otherwise("Normal")


def weather_card(days: DataFrame) -> DataFrame:
    """The latest date's weather with its condition labels; ``days`` has one row per date."""
    return latest(days).select("date", "tavg", "prcp", "snow", "wspd", condition_label().alias("conditions"))


def risk_map(dim: DataFrame, preds_latest: DataFrame, score: str, top_k: int = 10, proba: str | None = None) -> DataFrame:
    """Every area with its latest score (3 dp, missing -> 0), a top-K flag and the score
    min-max scaled over the areas; with ``proba`` also that probability (3 dp) and the
    expected collisions (``exp_coll`` of ``preds_latest``)."""
    w = Window.orderBy(F.col(score).desc_nulls_last(), "nbhd_id")  # one day of areas
    more = [F.bround(proba, 3).alias("proba"), "exp_coll"] if proba else []
    ranked = preds_latest.select("nbhd_id", score, *more, F.row_number().over(w).alias("_rk"))
    j = dim.select("nbhd_id", "area_name").join(ranked, "nbhd_id", "left")
    s = F.coalesce(F.bround(F.col(score), 3), F.lit(0.0))
    mm = j.select(F.struct(F.min(s).alias("lo"), F.max(s).alias("hi"))).scalar()
    return j.select("nbhd_id", "area_name", s.alias("score"), *(["proba", "exp_coll"] if proba else []),
                    F.coalesce(F.col("_rk") <= top_k, F.lit(False)).alias("top_k"),
                    F.coalesce(safe_div(s - mm["lo"], mm["hi"] - mm["lo"]), F.lit(0.0)).alias("scaled"))


def why_high_risk(features: DataFrame) -> DataFrame:
    """``reasons`` per area on the latest date, against the mean of its last 30 rows."""
    return reasons(latest(features).join(area_recent_mean(features, 30), "nbhd_id"))


def reasons(rows: DataFrame) -> DataFrame:
    """Up to four ordered reasons per row, and their categories (fixed texts).

    lag1 > 1.5 x ``avg_30d``; momentum > 1.4 (rounded in the text only; none or 0 counts as 1);
    first of freezing rain / heavy snow / adverse weather; first of holiday / pre-holiday /
    weekend; construction yesterday else adjacent disruption; a default when none.
    """
    lag1 = F.coalesce(F.col("collisions_lag1").cast("double"), F.lit(0.0))
    mom = F.when(F.coalesce(F.col("collision_momentum"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("collision_momentum"))

    def reason(category: str, when: Column, text) -> Column:
        return F.when(when, F.struct(F.lit(category).alias("c"), (F.lit(text) if isinstance(text, str) else text).alias("t")))

    flag_ = lambda c: F.col(c) == 1
    found = F.array(
        reason("traffic", lag1 > F.col("avg_30d") * 1.5,
               F.format_string("Yesterday had %d collisions (above average)", lag1.cast("int"))),
        reason("traffic", mom > 1.4,
               F.format_string("Collision activity is %.1fx the recent baseline", F.bround(mom, 1))),
        F.coalesce(reason("weather", flag_("freezing_rain"), "Freezing rain forecast"),
                   reason("weather", flag_("heavy_snow"), "Heavy snow forecast"),
                   reason("weather", flag_("feels_bad"), "Adverse weather conditions")),
        F.coalesce(reason("calendar", flag_("is_holiday"), "Public holiday"),
                   reason("calendar", flag_("pre_holiday"), "Day before a public holiday"),
                   reason("calendar", flag_("is_weekend"), "Weekend traffic patterns")),
        F.coalesce(reason("road", F.col("road_construction_count_lag1") > 0, "Active road construction nearby"),
                   reason("road", flag_("is_zone_disrupted"), "Road disruptions in adjacent zones")))
    found = F.slice(F.filter(found, lambda x: x.isNotNull()), 1, 4)
    none = F.array(F.struct(F.lit("traffic").alias("c"), F.lit("Elevated collision history in this area").alias("t")))
    r = rows.select("date", "nbhd_id", F.when(F.size(found) == 0, none).otherwise(found).alias("r"))
    return r.select("date", "nbhd_id", F.col("r.t").alias("reasons"), F.col("r.c").alias("categories"))


def risk_bands(preds_latest: DataFrame, score: str, high: float = 0.70, medium: float = 0.40) -> DataFrame:
    """Counts of areas per band."""
    s = F.col(score)
    return preds_latest.agg(F.count_if(s >= high).alias("n_high"),
                            F.count_if((s >= medium) & (s < high)).alias("n_medium"),
                            F.count_if(s < medium).alias("n_low"))


def seasonality_year(city: DataFrame, value: str = "city_collisions", current_year=None) -> DataFrame:
    """Yearly totals vs the long-run mean; the current year (default:
    the last year present) is dropped when it has fewer than 6 months."""
    d = city.withColumn("year", F.year("date")).withColumn("month", F.month("date"))
    cy = F.lit(current_year) if current_year is not None else d.select(F.max("year")).scalar()
    months_cy = d.where(F.col("year") == cy).select(F.count_distinct("month")).scalar()
    annual = d.groupBy("year").agg(F.sum(value).alias("total"))
    annual = annual.where((months_cy >= 6) | (F.col("year") < cy))
    avg = annual.select(F.avg("total")).scalar()
    return annual.select("year", "total", avg.alias("long_avg"), (F.col("total") > avg).alias("above_avg"))


def _top_bottom(df: DataFrame, value: str, key: str, n: int = 3) -> Column:
    up = Window.orderBy(F.col(value).desc(), key)
    down = Window.orderBy(F.col(value).asc(), key)
    return F.when(F.row_number().over(up) <= n, "high3").when(F.row_number().over(down) <= n, "low3") \
        .otherwise("typical")


def seasonality_month(city: DataFrame, value: str = "city_collisions") -> DataFrame:
    """Mean daily total per calendar month, ordered Jan..Dec, with
    top-3 / bottom-3 labels (ties: earlier month first)."""
    m = city.groupBy(F.month("date").alias("month")).agg(F.avg(value).alias("avg"))
    names = F.element_at(F.array(*[F.lit(x) for x in MONTHS]), F.col("month"))
    return m.select("month", names.alias("month_name"), "avg", _top_bottom(m, "avg", "month").alias("label"))


def seasonality_weekday(city: DataFrame, value: str = "city_collisions") -> DataFrame:
    """Mean daily total per weekday (Mon=0), labels as for months."""
    m = city.groupBy(F.weekday("date").alias("dow")).agg(F.avg(value).alias("avg"))
    names = F.element_at(F.array(*[F.lit(x) for x in WEEKDAYS]), F.col("dow") + 1)
    return m.select("dow", names.alias("dow_name"), "avg", _top_bottom(m, "avg", "dow").alias("label"))


def weather_impact(daily: DataFrame, value: str = "city_collisions") -> DataFrame:
    """Mean daily total on normal / freezing-rain / heavy-snow /
    wind-rain days and % change vs normal. ``daily`` has one row per date with
    the day's flags (max over areas)."""
    conds = [("Normal Days", (F.col("freezing_rain") == 0) & (F.col("heavy_snow") == 0) & (F.col("wind_rain") == 0)),
             ("Freezing Rain", F.col("freezing_rain") == 1),
             ("Heavy Snow", F.col("heavy_snow") == 1),
             ("High Wind And Rain", F.col("wind_rain") == 1)]
    aggs = [F.avg(F.when(c, F.col(value))).alias(f"_a{i}") for i, (_, c) in enumerate(conds)]
    a = daily.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(lbl).alias("condition"), F.col(f"_a{i}").alias("avg"))
                     for i, (lbl, _) in enumerate(conds)])
    ex = a.select(F.col("_a0").alias("_norm"), F.inline(rows)).where(F.col("avg").isNotNull())
    pct = F.when(F.col("_norm") > 0, (F.col("avg") - F.col("_norm")) / F.col("_norm") * 100).otherwise(F.lit(0.0))
    return ex.select("ord", "condition", "avg", pct.alias("pct_vs_normal"))


def ksi_monthly(df: DataFrame, col: str = "ksi_collisions") -> DataFrame:
    """KSI sum per (year, month) with its period date and the long-run mean."""
    m = df.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum(col).alias("ksi"))
    avg = m.select(F.avg("ksi")).scalar()
    return m.select("year", "month", F.make_date("year", "month", F.lit(1)).alias("period"), "ksi",
                    avg.alias("long_avg"))


def last_row_per_date(df: DataFrame, by: str = "nbhd_id", cols=("collisions",)) -> DataFrame:
    """per date, the row with the highest ``by`` value (``max_by``)."""
    s = F.struct(by, *cols)
    return df.groupBy("date").agg(F.max_by(s, F.col(by)).alias("r")).select("date", "r.*")


def batch_ids(df: DataFrame, order: str, n: int) -> DataFrame:
    """Fixed-size batches of an ordered (bounded) table: ``(row_number - 1) div n``."""
    w = Window.orderBy(order)
    return df.withColumn("batch", F.floor((F.row_number().over(w) - 1) / n).cast("int"))


def metrics_lists(surge: DataFrame, nbhd: DataFrame) -> DataFrame:
    """O3: one row with the two lists of metric records, each in the order of ``model``; none is an empty list."""
    lists = [d.agg(F.array_sort(F.collect_list(F.struct("model", *[c for c in d.columns if c != "model"]))).alias(name))
             .select(name).scalar().alias(name) for d, name in ((surge, "surge_metrics"), (nbhd, "nbhd_metrics"))]
    return surge.sparkSession.range(1).select(*lists)


def metric_card(metrics: DataFrame, horizon: int) -> DataFrame:
    """The metric record of a horizon's model, else the first one by name."""
    own = F.col("model").contains(f"t{horizon}")
    first = F.min_by(F.struct(*metrics.columns), F.struct((~own).cast("int").alias("other"), F.col("model").alias("by")))
    return metrics.agg(first.alias("m")).where("m IS NOT NULL").select(F.lit(horizon).alias("horizon"), "m.*")


def leading_factors(importances: DataFrame, labels: dict, k: int = 15) -> DataFrame:
    """The ``k`` largest importances, positive ones only, with a readable label (the feature itself without one)."""
    top = importances.orderBy(F.desc("importance"), "feature").limit(k).where(F.col("importance") > 0)
    label = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[F.col("feature")] if labels else F.lit(None).cast("string")
    return top.select("feature", "importance", F.coalesce(label, F.col("feature")).alias("label"))
