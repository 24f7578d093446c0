"""City roll-ups, surge thresholds, surge labels and leakage-safe merges
(E4-E6, E8, E9, K22-K26, B13).

The city series holds one row per day, so its windows (F3, F5) run over a
small, date-ordered table; thresholds are one-row aggregates attached as
scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, BooleanType

from hoodcast.config import (BASE_LEAKAGE, DEFAULTS, LEGACY_MAX_KEYWORDS, LEGACY_SUM_KEYWORDS,
                             SUM_KEYWORDS, Settings)
from hoodcast.functions.columns import safe_div
from hoodcast.operators.selection import median


def numeric_columns(df: DataFrame, drop=frozenset()) -> list[str]:
    """numeric/bool columns minus the leakage set and ``drop``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (NumericType, BooleanType))
            and f.name not in BASE_LEAKAGE and f.name not in drop]


def rollup_rule(name: str, three_way: bool = False) -> str:
    """E5a / E5b column classification by name fragments (order-sensitive, T22)."""
    if not three_way:
        return "sum" if any(k in name for k in SUM_KEYWORDS) else "mean"
    how = "sum" if any(k in name for k in LEGACY_SUM_KEYWORDS) else "mean"
    if any(k in name for k in LEGACY_MAX_KEYWORDS):
        how = "max"
    return how


def city_daily(df: DataFrame, three_way: bool = False, drop=frozenset()) -> DataFrame:
    """One row per date; feature columns summed / averaged / maxed by
    name; ``collisions`` summed. Partial aggregation happens map-side."""
    cols = numeric_columns(df, drop)
    aggs = []
    for c in cols:
        how = rollup_rule(c, three_way)
        fn = {"sum": F.sum, "mean": F.avg, "max": F.max}[how]
        aggs.append(fn(c).alias(c))
    return df.groupBy("date").agg(F.sum("collisions").alias("collisions"), *aggs)


def city_total(df: DataFrame, col: str = "collisions", out: str = "city_collisions") -> DataFrame:
    """Sum over areas per date."""
    return df.groupBy("date").agg(F.sum(col).alias(out))


def future_series(city: DataFrame, horizon: int, col: str = "collisions",
                  out: str = "city_collisions_future") -> DataFrame:
    """the city total ``horizon`` days ahead; rows without it dropped.

    One row per day: the date-ordered window runs in one partition over a
    table of (number of days) rows, which stays small at any data volume.
    """
    w = Window.orderBy("date")
    return city.withColumn(out, F.lead(col, horizon).over(w)).where(F.col(out).isNotNull())


def seasonal_threshold(train: DataFrame, value: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Season-aware threshold from the training series only.

    z = (x - mean60) / std60 over the 60 prior days (>= 14 present); with fewer
    than 30 valid z the raw ``pct`` quantile is used, else
    ``median(mean60) + quantile(z, pct) * median(std60)``.
    One-row result ``threshold, method, n_valid``.
    """
    w = Window.orderBy("date").rowsBetween(-settings.seasonal_window, -1)
    x = F.col(value).cast("double")
    enough = F.count(value).over(w) >= settings.seasonal_min_periods
    t = train.select(
        x.alias("x"),
        F.when(enough, F.avg(x).over(w)).alias("roll60"),
        F.when(enough, F.stddev_samp(x).over(w)).alias("std60"))
    t = t.withColumn("z", safe_div(F.col("x") - F.col("roll60"), F.col("std60")))
    pct = settings.surge_pct
    agg = t.agg(
        F.count("z").alias("n_valid"),
        F.percentile("x", pct).alias("raw_q"),
        F.percentile("z", pct).alias("z_q"),
        F.median("roll60").alias("m_roll"),
        F.median("std60").alias("m_std"))
    seasonal = F.col("n_valid") >= settings.seasonal_min_valid
    return agg.select(
        F.when(seasonal, F.col("m_roll") + F.col("z_q") * F.col("m_std")).otherwise(F.col("raw_q"))
        .alias("threshold"),
        F.when(seasonal, F.lit("seasonal")).otherwise(F.lit("raw_quantile")).alias("method"),
        "n_valid")


def raw_threshold(train: DataFrame, value: str, pct: float = 0.90) -> DataFrame:
    """Exact linear-interpolated quantile of the training totals."""
    return train.agg(F.percentile(value, pct).alias("threshold"))


def surge_labels(city: DataFrame, horizon: int, settings: Settings = DEFAULTS,
                 seasonal: bool = True) -> DataFrame:
    """Future city total, threshold from dates before the split, label
    ``y = future >= threshold``."""
    fut = future_series(city, horizon)
    train = fut.where(F.col("date") < F.lit(settings.split_date))
    thr = (seasonal_threshold(train, "city_collisions_future", settings) if seasonal
           else raw_threshold(train, "city_collisions_future", settings.surge_pct))
    t = thr.select("threshold").scalar()
    return fut.select("date", "city_collisions_future", t.alias("threshold"),
                      (F.col("city_collisions_future") >= t).cast("int").alias("y"))


def merge_surge_neutral(features: DataFrame, surge: DataFrame, settings: Settings = DEFAULTS,
                        fill: float = 0.5) -> DataFrame:
    """Left join surge probabilities on date; training-period rows and
    missing values get the neutral ``fill`` (leakage guard, T21).

    The surge table has to be unique per date (the jobs gate it, N1); of several rows for a
    date the highest probabilities are taken, so that the row count holds in any case.
    """
    cols = [c for c in surge.columns if c.startswith("surge_proba")]
    s = surge.groupBy("date").agg(*[F.max(c).alias(c) for c in cols])
    out = features.join(s, "date", "left")
    for c in cols:
        out = out.withColumn(c, F.when((F.col("date") < F.lit(settings.split_date)) | F.col(c).isNull(),
                                       F.lit(fill)).otherwise(F.col(c)))
    return out


def merge_surge_median(features: DataFrame, runs: DataFrame, col: str = "surge_proba") -> DataFrame:
    """K26 (legacy): average duplicate runs per date (E6), left join, nulls ->
    the merged column's median (B13, by distributed selection over the whole panel)."""
    s = runs.groupBy("date").agg(F.avg(col).alias(col))
    out = features.join(s, "date", "left")
    med = median(out, col).scalar()
    return out.withColumn(col, F.coalesce(F.col(col), med))
