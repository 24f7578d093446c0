"""Evaluation operators M1-M11 as aggregate plans.

Global ranking metrics (ROC-AUC, average precision) first collapse rows to
one row per distinct score (map-side partial aggregation), then need running
sums in descending score order.  Those are computed with a two-level prefix
sum: scores are cut into ``buckets`` ranges by approximate quantiles (a scalar
subquery), per-bucket totals (a tiny table) get an exclusive prefix, and the
running sum inside each bucket is a window partitioned by bucket.  No step
puts all distinct scores into one task.

Per-day ranking metrics (P@K, recall, lift, sweep, overlap, drift) rank
within ``date`` partitions: each day holds one row per area, so a day is a
bounded group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoodcast.functions.columns import safe_div
from hoodcast.session import cut_lineage


def _r(c: Column, digits: int) -> Column:
    # half-even like Python's round()
    return F.bround(c, digits)


# ---------------------------------------------------------------------------
# M1-M4
# ---------------------------------------------------------------------------

def score_histogram(df: DataFrame, score: str, label: str) -> DataFrame:
    """``(s, pos, neg)`` per distinct score."""
    y = F.col(label).cast("long")
    return df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def descending_prefix(hist: DataFrame, cols=("pos", "neg"), buckets: int | None = None) -> DataFrame:
    """Adds ``{c}_above`` (sum over strictly higher scores) and ``{c}_cum``
    (inclusive) for each column of a one-row-per-score histogram."""
    # as many tasks share the ordered sum as a shuffle has partitions
    buckets = buckets or max(2, int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    qs = [i / buckets for i in range(1, buckets)]
    bounds = hist.select(F.percentile_approx("s", qs, 10000).alias("b")).scalar()
    # bucket 0 holds the highest scores; equal scores share a bucket
    h = (hist.withColumn("_bounds", bounds)
         .withColumn("_bk", F.size(F.filter("_bounds", lambda b: b > F.col("s")))).drop("_bounds"))
    tot = h.groupBy("_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wt = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_bk", *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in cols])
    # ``off`` holds one row per bucket (at most ``buckets`` rows)
    h = h.join(F.broadcast(off), "_bk")
    wb = Window.partitionBy("_bk").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = h
    for c in cols:
        cum = F.col(f"_o_{c}") + F.sum(c).over(wb)
        out = out.withColumn(f"{c}_cum", cum)
    for c in cols:
        out = out.withColumn(f"{c}_above", F.col(f"{c}_cum") - F.col(c))
    return out.drop("_bk", *[f"_o_{c}" for c in cols])


def auc_ap(df: DataFrame, score: str, label: str, buckets: int | None = None) -> DataFrame:
    """M1 ROC-AUC (Mann-Whitney, ties count one half) and M2 average precision
    (``sum (R_n - R_{n-1}) P_n`` over distinct scores, descending)."""
    c = descending_prefix(score_histogram(df, score, label), buckets=buckets)
    agg = c.agg(
        F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") * 0.5)).alias("_u"),
        F.sum(F.col("pos") * safe_div(F.col("pos_cum"), F.col("pos_cum") + F.col("neg_cum"))).alias("_ap"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(
        safe_div(F.col("_u"), F.col("P") * F.col("N")).alias("roc_auc"),
        safe_div(F.col("_ap"), F.col("P")).alias("pr_auc"), "P", "N")


def classification_metrics(df: DataFrame, score: str, label: str, model: str,
                           buckets: int | None = None) -> DataFrame:
    """M1-M4: one row ``model, roc_auc, pr_auc, brier, n_test, pos_rate`` (rounded
    6/6/6/-/4 like the reference)."""
    a = auc_ap(df, score, label, buckets).select("roc_auc", "pr_auc")
    b = df.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"),
               F.count(F.lit(1)).alias("n_test"),
               F.avg(F.col(label).cast("double")).alias("pos_rate")).select(F.struct("*")).scalar()
    return a.select(F.lit(model).alias("model"), _r(F.col("roc_auc"), 6).alias("roc_auc"),
                    _r(F.col("pr_auc"), 6).alias("pr_auc"), _r(b["brier"], 6).alias("brier"),
                    b["n_test"].alias("n_test"), _r(b["pos_rate"], 4).alias("pos_rate"))


#: Distinct scores that one task of ``metrics_by`` is to order.
SCORES_PER_TASK = 200_000


def metrics_by(df: DataFrame, score: str, label: str, by) -> DataFrame:
    """M1-M4 of many models in one plan: ``(*by, roc_auc, pr_auc, brier, n_test, pos_rate)`` per group of ``by``, rounded as in
    ``classification_metrics``; a group without both classes has no ROC-AUC.

    The groups' distinct scores are dealt by range of (group, score), as many ranges as their number asks for, and written; the
    running counts are a prefix over the ranges' totals and one within each range. A group of any size is
    spread over ranges, and small groups share one.
    """
    by = [by] if isinstance(by, str) else list(by)
    s, y = F.col(score).cast("double"), F.col(label).cast("long")
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    names = [f"_g{i}" for i in range(len(by))]
    hist = cut_lineage(df.groupBy(*keys, s.alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"), F.sum(F.pow(s - y, 2)).alias("err")))
    ranges = 1 + hist.count() // SCORES_PER_TASK
    h = cut_lineage(hist.repartitionByRange(ranges, *names, F.desc("s")).withColumn("range", F.spark_partition_id()))
    total = h.groupBy(*names, "range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    earlier = Window.partitionBy(*names).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select(*names, "range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_base") for c in "pn"])
    # null groups are groups: join null-safely
    on = [F.col(f"h.{c}").eqNullSafe(F.col(f"t.{c}")) for c in [*names, "range"]]
    j = h.alias("h").join(total.alias("t"), on).select("h.*", "p_base", "n_base")
    own = Window.partitionBy(*names, "range").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    j = j.withColumns({"pos_cum": F.col("p_base") + F.sum("pos").over(own), "neg_cum": F.col("n_base") + F.sum("neg").over(own)})
    out = j.groupBy(*names).agg(
        F.sum(F.col("neg") * (F.col("pos_cum") - F.col("pos") + F.col("pos") * 0.5)).alias("u"),
        F.sum(F.col("pos") * safe_div(F.col("pos_cum"), F.col("pos_cum") + F.col("neg_cum"))).alias("ap"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum("err").alias("err"))
    n = F.col("P") + F.col("N")
    return out.select(
        *[F.col(g).alias(c) for g, c in zip(names, by)], _r(safe_div(F.col("u"), F.col("P") * F.col("N")), 6).alias("roc_auc"),
        _r(safe_div(F.col("ap"), F.col("P")), 6).alias("pr_auc"), _r(F.col("err") / n, 6).alias("brier"), n.alias("n_test"),
        _r(F.col("P") / n, 4).alias("pos_rate"))


# ---------------------------------------------------------------------------
# per-day ranking: M5-M9, M11, F11
# ---------------------------------------------------------------------------

def day_rank(df: DataFrame, score: str, date_col: str = "date", id_col: str = "nbhd_id",
             out: str = "rank") -> DataFrame:
    """rank within each day by score desc, ties by area id ascending."""
    w = Window.partitionBy(date_col).orderBy(F.col(score).desc_nulls_last(), F.col(id_col))
    return df.withColumn(out, F.row_number().over(w))


def daily_hits(df: DataFrame, score: str, label: str, ks, date_col: str = "date",
               id_col: str = "nbhd_id") -> DataFrame:
    """Per day: hits in the top K for every K, and the day's positives."""
    r = day_rank(df, score, date_col, id_col)
    y = F.col(label).cast("long")
    return r.groupBy(date_col).agg(
        F.sum(y).alias("total_pos"),
        *[F.sum(F.when(F.col("rank") <= k, y).otherwise(0)).alias(f"hits_{k}") for k in ks])


def precision_recall_at_k(df: DataFrame, score: str, label: str, ks=(5, 10),
                          empty_recall: str = "zero", date_col: str = "date",
                          id_col: str = "nbhd_id") -> DataFrame:
    """Daily precision = hits / K (K fixed), recall = hits / positives;
    a day without positives has recall 0 (``zero``, production) or is skipped
    (``skip``, notebooks). Means over days, rounded to 6 dp."""
    d = daily_hits(df, score, label, ks, date_col, id_col)
    aggs = []
    for k in ks:
        rec = safe_div(F.col(f"hits_{k}").cast("double"), F.col("total_pos"))
        if empty_recall == "zero":
            rec = F.coalesce(rec, F.lit(0.0))
        aggs += [_r(F.avg(F.col(f"hits_{k}") / k), 6).alias(f"precision_at_{k}"),
                 _r(F.avg(rec), 6).alias(f"recall_at_{k}")]
    return d.agg(*aggs)


def lift_at_k(df: DataFrame, score: str, label: str, ks=(5, 10, 15, 20),
              empty_recall: str = "zero") -> DataFrame:
    """M6: precision@K / base rate (3 dp), null when the base rate is 0."""
    pr = precision_recall_at_k(df, score, label, ks, empty_recall)
    base = df.select(F.avg(F.col(label).cast("double"))).scalar()
    cols = [_r(base, 4).alias("baseline_pos_rate")]
    for k in ks:
        cols += [f"precision_at_{k}", f"recall_at_{k}",
                 F.when(base > 0, _r(F.col(f"precision_at_{k}") / base, 3)).alias(f"lift_at_{k}")]
    return pr.select(*cols)


def overlap_at_k(df: DataFrame, score: str, actual: str, k: int = 10, date_col: str = "date",
                 id_col: str = "nbhd_id") -> DataFrame:
    """M7/H3: |true top-K and predicted top-K| / K, mean over days."""
    r = day_rank(df, score, date_col, id_col, "p_rank")
    r = day_rank(r, actual, date_col, id_col, "t_rank")
    per_day = r.groupBy(date_col).agg(
        F.sum(((F.col("p_rank") <= k) & (F.col("t_rank") <= k)).cast("int")).alias("both"))
    return per_day.agg(_r(F.avg(F.col("both") / k), 6).alias(f"overlap_at_{k}"))


def k_sweep(df: DataFrame, score: str, label: str, kmax: int = 30, top: int = 5,
            date_col: str = "date", id_col: str = "nbhd_id") -> DataFrame:
    """Precision / recall (skip-empty) / lift for K = 1..kmax from one
    ranking pass, sorted by lift (ties: smaller K first), best ``top``."""
    r = day_rank(df, score, date_col, id_col)
    y = F.col(label).cast("long")
    wc = Window.partitionBy(date_col).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    cum = r.select(date_col, "rank", F.sum(y).over(wc).alias("cum"))
    days = r.groupBy(date_col).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("total_pos"))
    kd = days.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(kmax))))
    kd = kd.withColumn("rank", F.least(F.col("k"), F.col("n")))
    j = kd.join(cum, [date_col, "rank"])
    per_k = j.groupBy("k").agg(
        F.avg(F.col("cum") / F.col("k")).alias("precision"),
        F.avg(safe_div(F.col("cum").cast("double"), F.col("total_pos"))).alias("recall"))
    base = df.select(F.avg(F.col(label).cast("double"))).scalar()
    out = per_k.select("k", _r(F.col("precision"), 6).alias("precision"), _r(F.col("recall"), 6).alias("recall"),
                       F.when(base > 0, _r(F.col("precision") / base, 3)).alias("lift"))
    return out.orderBy(F.col("lift").desc_nulls_last(), F.col("k")).limit(top)


def drift_check(df: DataFrame, score: str, label: str, k: int = 10, warn: float = 0.15,
                date_col: str = "date", id_col: str = "nbhd_id") -> DataFrame:
    """M9: split the distinct test dates at index n//2; P@K early vs late;
    ``drop = (early - late) / early`` (0 when early is 0); flag above ``warn``."""
    days = df.select(date_col).distinct()
    w = Window.orderBy(date_col)
    idx = days.select(date_col, (F.row_number().over(w) - 1).alias("i"))
    n = days.select(F.count(F.lit(1))).scalar()
    mid = idx.where(F.col("i") == F.floor(n / 2)).select(date_col).scalar()
    d = daily_hits(df, score, label, [k], date_col, id_col)
    half = F.when(F.col(date_col) < mid, F.lit("early")).otherwise(F.lit("late"))
    p = d.groupBy(half.alias("half")).agg(_r(F.avg(F.col(f"hits_{k}") / k), 6).alias("p"))
    pv = p.groupBy().pivot("half", ["early", "late"]).agg(F.first("p"))
    drop = F.when(F.col("early") > 0, (F.col("early") - F.col("late")) / F.col("early")).otherwise(F.lit(0.0))
    return pv.select(F.col("early").alias(f"early_p_at_{k}"), F.col("late").alias(f"late_p_at_{k}"),
                     _r(drop, 6).alias("drop"), (drop > warn).alias("warning"))


def compare_models(baseline: DataFrame, candidate: DataFrame, min_gain: float = 0.01,
                   brier_slack: float = 0.002) -> DataFrame:
    """One row per pair; uplift when any of dP@10, dPR, dROC >= ``min_gain``
    and the candidate's Brier <= baseline + ``brier_slack``."""
    b = baseline.select(F.struct("*")).scalar()  # one-row metric record
    d10 = F.col("precision_at_10") - b["precision_at_10"]
    dpr = F.col("pr_auc") - b["pr_auc"]
    droc = F.col("roc_auc") - b["roc_auc"]
    ok = ((d10 >= min_gain) | (dpr >= min_gain) | (droc >= min_gain)) & \
         (F.col("brier") <= b["brier"] + brier_slack)
    return candidate.select(b["model"].alias("baseline"), F.col("model").alias("candidate"),
                            _r(d10, 6).alias("delta_p_at_10"), _r(dpr, 6).alias("delta_pr_auc"),
                            _r(droc, 6).alias("delta_roc_auc"),
                            _r(F.col("brier") - b["brier"], 6).alias("delta_brier"),
                            F.when(ok, "uplift").otherwise("no_uplift").alias("decision"))


def ranking_summary(df: DataFrame, score_cols, label: str, ks=(5, 10, 15),
                    date_col: str = "date", id_col: str = "nbhd_id") -> DataFrame:
    """P@K / R@K (skip-empty recall) for several score columns, unioned.

    The score columns are unpivoted so one ranking pass serves them all
    (ranked per (score column, day))."""
    long = df.unpivot([date_col, id_col, label], list(score_cols), "score_col", "score")
    w = Window.partitionBy("score_col", date_col).orderBy(F.col("score").desc_nulls_last(), F.col(id_col))
    r = long.withColumn("rank", F.row_number().over(w))
    y = F.col(label).cast("long")
    d = r.groupBy("score_col", date_col).agg(
        F.sum(y).alias("total_pos"),
        *[F.sum(F.when(F.col("rank") <= k, y).otherwise(0)).alias(f"hits_{k}") for k in ks])
    parts = []
    for k in ks:
        parts.append(d.groupBy("score_col").agg(
            F.lit(k).alias("k"),
            _r(F.avg(F.col(f"hits_{k}") / k), 6).alias("precision"),
            _r(F.avg(safe_div(F.col(f"hits_{k}").cast("double"), F.col("total_pos"))), 6).alias("recall")))
    return reduce(lambda a, b: a.unionByName(b), parts)
