"""Feature builders K12-K21 over the dense gold panel.

Everything is one lazy plan: calendar, holiday and weather flags are row
expressions, the halo is a join against the (small) adjacency list,
and all lag / rolling / momentum / target columns are computed in one window
pass partitioned by area.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.config import DEFAULTS, ROAD_COLS, Settings
from hoodcast.functions import columns as C
from hoodcast.functions.calendar import holidays_of_year, is_holiday
from hoodcast.operators import windows as Wn

def calendar_features(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Dow (Mon=0), month, year, weekend, holiday, pre/post holiday,
    cyclical encodings.

    Holidays are row expressions: the nine rule dates of the row's year are
    built once per row and the three flags are membership tests (no lookup
    join, no pass over the data to find its year range). Across a year end
    only New Year's Day can follow (Dec 31 is pre-holiday) and no holiday can
    precede (Dec 31 is never one), which the flags encode directly.
    """
    obs = settings.include_observed_holidays
    d = F.col("date")
    src = df
    if obs:
        is_h, pre, post = (is_holiday(x, True) for x in ("`date`", "date_add(`date`, 1)", "date_sub(`date`, 1)"))
    else:
        # the year's holiday array is built once per row and referenced three times
        src = df.withColumn("__hol", holidays_of_year("year(`date`)"))
        hol = F.col("__hol")
        is_h = F.array_contains(hol, d)
        pre = F.array_contains(hol, F.date_add(d, 1)) | ((F.month(d) == 12) & (F.dayofmonth(d) == 31))
        post = F.array_contains(hol, F.date_sub(d, 1))
    dow = F.weekday("date")
    month = F.month("date")
    ds, dc = C.cyclic(dow, 7)
    ms, mc = C.cyclic(month, 12)
    return src.select(
        *[F.col(c) for c in df.columns],
        dow.alias("dow"), month.alias("month"), F.year("date").alias("year"),
        (dow >= 5).cast("int").alias("is_weekend"),
        is_h.cast("int").alias("is_holiday"), pre.cast("int").alias("pre_holiday"),
        post.cast("int").alias("post_holiday"),
        ds.alias("dow_sin"), dc.alias("dow_cos"), ms.alias("month_sin"), mc.alias("month_cos"),
    )


def weather_interactions(df: DataFrame) -> DataFrame:
    """Compound weather flags."""
    fr = C.flag((F.col("prcp") > 0) & (F.col("tmin") <= 0))
    wr = C.flag((F.col("prcp") > 2) & (F.col("wspd") > 30))
    hs = C.flag(F.col("snow") > 5)
    cd = C.flag((F.col("tmin") <= -10) & (F.col("prcp") == 0))
    return df.select("*", fr.alias("freezing_rain"), wr.alias("wind_rain"), hs.alias("heavy_snow"),
                     cd.alias("cold_dry"), F.greatest(fr, wr, hs).alias("feels_bad"))


def halo_sums(df: DataFrame, adj: DataFrame, cols=ROAD_COLS) -> DataFrame:
    """Per (date, area), the sums of ``cols`` over its adjacent areas."""
    # the edge list is bounded by geography (about 6 neighbours per area);
    # Spark's size estimate decides whether it is broadcast
    a = adj.select(F.col("nbhd_id").alias("_focus"), F.col("adjacent_nbhd_id").alias("nbhd_id")).dropna()
    nb = df.select("date", "nbhd_id", *cols).join(a, "nbhd_id")
    return nb.groupBy("date", F.col("_focus").alias("nbhd_id")).agg(
        *[F.sum(c).alias(f"{c}_halo") for c in cols])


def halo_columns(df: DataFrame, adj: DataFrame, variant: str = "production", facts: DataFrame | None = None) -> DataFrame:
    """K17 (and K21 variant): halo sums (null -> 0), log1p norms, disruption
    flags, total construction pressure.

    ``variant='production'``: ``is_zone_disrupted = construction halo > 0``;
    ``'legacy'``: ``is_zone_disrupted = total pressure > 0`` and the event flag
    is named ``is_road_disrupted_halo`` (T10).

    ``facts`` are the road measures (``ROAD_COLS``) of the (date, area) pairs that have any;
    given them the neighbour sums never touch the dense panel, which is then read once.
    """
    h = halo_sums(df if facts is None else facts, adj)
    out = df.join(h, ["date", "nbhd_id"], "left")
    hcols = [f"{c}_halo" for c in ROAD_COLS]
    out = out.select(*[c for c in out.columns if c not in hcols],
                     *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in hcols])
    total = F.col("road_construction_count") + F.col("road_construction_count_halo")
    zone = (F.col("road_construction_count_halo") > 0) if variant == "production" else (total > 0)
    ev_name = "is_event_disrupted_halo" if variant == "production" else "is_road_disrupted_halo"
    return out.select(
        "*",
        *[F.log1p(F.col(c)).alias(f"{c}_norm") for c in hcols],
        zone.cast("int").alias("is_zone_disrupted"),
        (F.col("road_events_count_halo") > 0).cast("int").alias(ev_name),
        total.alias("construction_total_pressure"),
        F.log1p(total).alias("construction_pressure_norm"),
    )


def ksi_ratio_columns(df: DataFrame) -> DataFrame:
    """K14 (row part): ``ksi_ratio = ksi / collisions``, 0 when collisions = 0."""
    return df.withColumn("ksi_ratio",
                         F.coalesce(C.safe_div(F.col("ksi_collisions").cast("double"),
                                               F.col("collisions")), F.lit(0.0)))


def window_family(df: DataFrame, settings: Settings = DEFAULTS, halo: bool = True,
                  targets: bool = True, block_days: int | None = None) -> DataFrame:
    """K14 (lag) + K15 + K16 + K17 (halo lag/roll) + K18 over one
    ``partitionBy(nbhd_id).orderBy(date)`` ordering: one exchange, one sort. With ``block_days``
    the windows run per area and time block, same values, so that there are more tasks than areas."""
    part = ["nbhd_id"]
    if block_days:
        back = 1 + max(*settings.lags, *settings.windows, *settings.halo_lags, *settings.halo_windows, 14)
        df, part = Wn.in_blocks(df, block_days, back, max(settings.horizons)), ["nbhd_id", "_block"]
    w = Wn.area_window(part, "date")
    extra = [Wn.lag("ksi_ratio", 1, w).alias("ksi_ratio_lag1")] if "ksi_ratio" in df.columns else []
    if targets:
        for h in settings.horizons:
            fc, fk = Wn.lead("collisions", h, w), Wn.lead("ksi_collisions", h, w)
            extra += [fc.alias(f"collisions_t{h}"),
                      (F.coalesce(fc, F.lit(0)) >= 1).cast("int").alias(f"target_collision_t{h}"),
                      (F.coalesce(fk, F.lit(0)) >= 1).cast("int").alias(f"target_ksi_t{h}")]
    out = Wn.add_lag_roll(df, settings.lag_cols, settings.lags, settings.windows, w, extra, part)
    if halo:
        out = Wn.add_lag_roll(out, [f"{c}_halo" for c in ROAD_COLS], settings.halo_lags,
                              settings.halo_windows, w, part=part)
    if "collisions_lag1" in out.columns and "collisions_roll14_mean" in out.columns:
        lag1, base = F.col("collisions_lag1"), F.col("collisions_roll14_mean")
    else:
        lag1, base = Wn.lag("collisions", 1, w), Wn.trailing("collisions", 14, w, "mean")
    out = out.withColumn("collision_momentum", F.coalesce(C.safe_div(lag1, base), F.lit(1.0)))
    return Wn.own_rows(out) if block_days else out


def feature_table(gold: DataFrame, adj: DataFrame, settings: Settings = DEFAULTS,
                  variant: str = "production", facts: DataFrame | None = None, block_days: int | None = None) -> DataFrame:
    """Calendar -> weather flags -> KSI ratio -> lag/roll -> momentum ->
    halo -> targets; rows without the furthest target, ``collisions_lag1`` or
    ``collisions_roll7_mean`` are dropped."""
    df = calendar_features(gold, settings)
    df = weather_interactions(df)
    df = ksi_ratio_columns(df)
    df = halo_columns(df, adj, variant, facts)
    df = window_family(df, settings, block_days=block_days)
    hmax = max(settings.horizons)
    return df.dropna(subset=[f"collisions_t{hmax}", "collisions_lag1", "collisions_roll7_mean"])


def with_road_stats(gold: DataFrame, stats: DataFrame) -> DataFrame:
    """Road statistics per area joined onto the panel, gaps filled with the column's median."""
    cols = [c for c in stats.columns if c != "nbhd_id"]
    medians = stats.select(F.struct(*[F.median(c).alias(c) for c in cols])).scalar()
    out = gold.join(stats, "nbhd_id", "left")
    return out.select(*gold.columns, *[F.coalesce(F.col(c).cast("double"), medians[c]).alias(c) for c in cols])


#: Columns of the legacy v2 family, those with lags and those with trailing sums.
LEGACY_V2_LAGS = ("collisions", "ksi_collisions", "ksi_weighted_score", *ROAD_COLS)
LEGACY_V2_SUMS = ("collisions", "ksi_collisions", "ksi_weighted_score", "road_events_count", "road_construction_count",
                  "road_events_severity_weighted", "road_construction_severity_weighted")


def legacy_features_v2(gold: DataFrame) -> DataFrame:
    """Nine columns with lags 1/7/14 and seven with trailing 7/14/30-day sums, per area."""
    out = Wn.add_lag_roll(gold.select("date", "nbhd_id", *LEGACY_V2_LAGS), list(LEGACY_V2_SUMS), [], [7, 14, 30])
    w = Wn.area_window()
    sums = [f"{c}_roll{W}_sum" for c in LEGACY_V2_SUMS for W in (7, 14, 30)]
    lags = [Wn.lag(c, L, w).alias(f"{c}_lag{L}") for c in LEGACY_V2_LAGS for L in (1, 7, 14)]
    return out.select("date", "nbhd_id", *lags, *sums)


def legacy_features_v1(gold: DataFrame) -> DataFrame:
    """Lags 1/7/14 of collisions and the KSI measures, roll 7/14 means,
    calendar parts (computed per area, i.e. without trap T1)."""
    w = Wn.area_window()
    cols = ["collisions", "ksi_collisions", "ksi_weighted_score"]
    out = []
    for c in cols:
        out += [Wn.lag(c, L, w).alias(f"{c}_lag{L}") for L in (1, 7, 14)]
        out += [Wn.trailing(c, W, w, "mean").alias(f"{c}_roll{W}_mean") for W in (7, 14)]
    return gold.select("*", *out, F.weekday("date").alias("dow"), F.month("date").alias("month"),
                       F.year("date").alias("year"))
