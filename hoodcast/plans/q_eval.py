"""Queries for the evaluation layer (M1-M11, F11, G6, H3) on the test split,
scored with the adapter's deterministic score column (ties on purpose)."""

from __future__ import annotations



from pyspark.sql import functions as F

from hoodcast.config import ADAPTER
from hoodcast.operators import evaluate as Ev
from hoodcast.operators import windows as Wn
from hoodcast.plans import inputs as I
from hoodcast.plans.catalog import query
from hoodcast.plans.oracle_sql import sql
from hoodcast.session import cut_lineage
from hoodcast.sources.adapter import score_column

S = ADAPTER
SPLIT = f"DATE '{S.split_date.isoformat()}'"
Y = "target_collision_t1"


def eval_frame(spark, sf):
    """Test-split rows: next-day target, deterministic score and a lag-free
    candidate score (share of the 7 previous days with a collision).

    The metric plans read this frame several times (histogram, scalar
    aggregates, per-day ranks), so it is checkpointed once into the shared
    checkpoint folder: later reads scan those files instead of re-running the
    panel, and the lineage survives executor loss.
    """
    return cut_lineage(_eval_frame(spark, sf))


def _eval_frame(spark, sf):
    p = I.dense(spark, sf).select("date", "nbhd_id", "collisions")
    w = Wn.area_window()
    hit = (F.col("collisions") >= 1).cast("double")
    fw = w.rowsBetween(-7, -1)
    cand = F.coalesce(F.when(F.count("collisions").over(fw) == 7, F.avg(hit).over(fw)), F.lit(0.0))
    t = p.select("date", "nbhd_id", Wn.lead("collisions", 1, w).alias("collisions_t1"),
                 score_column().alias("score"), cand.alias("cand"))
    return (t.where(F.col("collisions_t1").isNotNull() & (F.col("date") >= F.lit(S.split_date)))
            .withColumn(Y, (F.col("collisions_t1") >= 1).cast("int")))


EV_CTE = {"ev": f"""
  SELECT *, CAST(collisions_t1 >= 1 AS INTEGER) AS {Y} FROM (
    SELECT date, nbhd_id, lead(collisions, 1) OVER w AS collisions_t1,
           ((nbhd_id * 7919 + datediff('day', DATE '1995-01-01', date) * 104729) % 1000) / 1000.0 AS score,
           coalesce(CASE WHEN count(collisions) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7
                    THEN avg(CAST(collisions >= 1 AS DOUBLE)) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
                    END, 0.0) AS cand
    FROM panel WINDOW w AS (PARTITION BY nbhd_id ORDER BY date))
  WHERE collisions_t1 IS NOT NULL AND date >= {SPLIT}"""}


def _metrics_sql(score: str, model: str) -> str:
    return f"""
  SELECT '{model}' AS model,
         round_even(sum(neg * (pos_cum - pos + 0.5 * pos)) / (sum(pos) * sum(neg)), 6) AS roc_auc,
         round_even(sum(pos * pos_cum / (pos_cum + neg_cum)) / sum(pos), 6) AS pr_auc,
         (SELECT round_even(avg(power({score} - {Y}, 2)), 6) FROM ev) AS brier,
         (SELECT count(*) FROM ev) AS n_test,
         (SELECT round_even(avg(CAST({Y} AS DOUBLE)), 4) FROM ev) AS pos_rate
  FROM (SELECT s, pos, neg,
               sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS pos_cum,
               sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS neg_cum
        FROM (SELECT CAST({score} AS DOUBLE) AS s, sum({Y}) AS pos, sum(1 - {Y}) AS neg FROM ev GROUP BY 1))"""


@query("auc_ap_brier", sql(_metrics_sql("score", "collision_prob_t1"), EV_CTE))
def auc_ap_brier(spark, sf):
    """M1-M4: ROC-AUC (tie-aware), average precision, Brier, n, positive rate."""
    return Ev.classification_metrics(eval_frame(spark, sf), "score", Y, "collision_prob_t1")


def _daily_sql(score: str, ks, part: str = "") -> str:
    hits = ", ".join(f"sum(CASE WHEN rk <= {k} THEN {Y} ELSE 0 END) AS hits_{k}" for k in ks)
    return f"""
  SELECT date{part and ', ' + part}, sum({Y}) AS total_pos, {hits} FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY {score} DESC, nbhd_id) AS rk FROM ev)
  GROUP BY date"""


def _prk_sql(ks, empty="zero") -> str:
    cols = []
    for k in ks:
        rec = f"CASE WHEN total_pos > 0 THEN CAST(hits_{k} AS DOUBLE) / total_pos END"
        if empty == "zero":
            rec = f"coalesce({rec}, 0.0)"
        cols += [f"round_even(avg(hits_{k} / {k}), 6) AS precision_at_{k}",
                 f"round_even(avg({rec}), 6) AS recall_at_{k}"]
    return f"SELECT {', '.join(cols)} FROM ({_daily_sql('score', ks)})"


@query("precision_recall_at_k", sql(_prk_sql((5, 10)), EV_CTE))
def precision_recall_at_k(spark, sf):
    """M5: daily P@K / R@K (recall 0 on days without positives), K = 5, 10."""
    return Ev.precision_recall_at_k(eval_frame(spark, sf), "score", Y, (5, 10), "zero")


@query("precision_recall_at_k_skip", sql(_prk_sql((5, 10, 15), "skip"), EV_CTE))
def precision_recall_at_k_skip(spark, sf):
    """Same with days without positives skipped for recall."""
    return Ev.precision_recall_at_k(eval_frame(spark, sf), "score", Y, (5, 10, 15), "skip")


def _lift_sql(ks) -> str:
    base = f"(SELECT avg(CAST({Y} AS DOUBLE)) FROM ev)"
    cols = [f"round_even({base}, 4) AS baseline_pos_rate"]
    for k in ks:
        cols += [f"precision_at_{k}", f"recall_at_{k}",
                 f"CASE WHEN {base} > 0 THEN round_even(precision_at_{k} / {base}, 3) END AS lift_at_{k}"]
    return f"SELECT {', '.join(cols)} FROM ({_prk_sql(ks)})"


@query("lift_at_k", sql(_lift_sql((5, 10, 15, 20)), EV_CTE))
def lift_at_k(spark, sf):
    """M6: precision@K over the base rate, K = 5, 10, 15, 20."""
    return Ev.lift_at_k(eval_frame(spark, sf), "score", Y, (5, 10, 15, 20))


@query("overlap_at_k", sql("""
  SELECT round_even(avg(both_ / 10), 6) AS overlap_at_10 FROM (
    SELECT date, sum(CASE WHEN p_rank <= 10 AND t_rank <= 10 THEN 1 ELSE 0 END) AS both_ FROM (
      SELECT date,
             row_number() OVER (PARTITION BY date ORDER BY score DESC, nbhd_id) AS p_rank,
             row_number() OVER (PARTITION BY date ORDER BY collisions_t1 DESC, nbhd_id) AS t_rank
      FROM ev) GROUP BY date)""", EV_CTE))
def overlap_at_k(spark, sf):
    """M7/H3: overlap of the true and predicted top-10 per day."""
    return Ev.overlap_at_k(eval_frame(spark, sf), "score", "collisions_t1", 10)


@query("k_sweep", sql(f"""
  SELECT k, round_even(avg(cum / k), 6) AS precision,
         round_even(avg(CASE WHEN total_pos > 0 THEN CAST(cum AS DOUBLE) / total_pos END), 6) AS recall,
         CASE WHEN (SELECT avg(CAST({Y} AS DOUBLE)) FROM ev) > 0
              THEN round_even(avg(cum / k) / (SELECT avg(CAST({Y} AS DOUBLE)) FROM ev), 3) END AS lift
  FROM (
    SELECT d.date, d.total_pos, d.k, c.cum FROM (
      SELECT date, n, total_pos, unnest(range(1, 31)) AS k FROM (
        SELECT date, count(*) AS n, sum({Y}) AS total_pos FROM ev GROUP BY date)) d
    JOIN (SELECT date, rk, sum({Y}) OVER (PARTITION BY date ORDER BY rk ROWS UNBOUNDED PRECEDING) AS cum
          FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY score DESC, nbhd_id) AS rk FROM ev)) c
      ON c.date = d.date AND c.rk = least(d.k, d.n))
  GROUP BY k ORDER BY lift DESC NULLS LAST, k LIMIT 5""", EV_CTE))
def k_sweep(spark, sf):
    """K = 1..30 sweep, best five by lift."""
    return Ev.k_sweep(eval_frame(spark, sf), "score", Y, 30, 5)


@query("drift_check", sql(f"""
  SELECT max(CASE WHEN half = 'early' THEN p END) AS early_p_at_10,
         max(CASE WHEN half = 'late' THEN p END) AS late_p_at_10,
         round_even(CASE WHEN max(CASE WHEN half = 'early' THEN p END) > 0
              THEN (max(CASE WHEN half = 'early' THEN p END) - max(CASE WHEN half = 'late' THEN p END))
                   / max(CASE WHEN half = 'early' THEN p END) ELSE 0.0 END, 6) AS drop,
         CASE WHEN max(CASE WHEN half = 'early' THEN p END) > 0
              THEN (max(CASE WHEN half = 'early' THEN p END) - max(CASE WHEN half = 'late' THEN p END))
                   / max(CASE WHEN half = 'early' THEN p END) ELSE 0.0 END > 0.15 AS warning
  FROM (
    SELECT half, round_even(avg(hits_10 / 10), 6) AS p FROM (
      SELECT *, CASE WHEN date < (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i
                                                   FROM (SELECT DISTINCT date FROM ev))
                                  WHERE i = (SELECT count(DISTINCT date) FROM ev) // 2)
                     THEN 'early' ELSE 'late' END AS half
      FROM ({_daily_sql('score', [10])})) GROUP BY half)""", EV_CTE))
def drift_check(spark, sf):
    """M9: P@10 in the first vs second half of the test dates."""
    return Ev.drift_check(eval_frame(spark, sf), "score", Y, 10, S.drift_warn)


def _model_row(df, score, model):
    m = Ev.classification_metrics(df, score, Y, model)
    p = Ev.precision_recall_at_k(df, score, Y, (10,), "zero").select("precision_at_10")
    return m.select("*", p.select(F.struct("*")).scalar()["precision_at_10"].alias("precision_at_10"))


def _cmp_sql():
    def row(score, model):
        return (f"SELECT *, (SELECT precision_at_10 FROM ({_prk_sql((10,)).replace(_daily_sql('score', (10,)), _daily_sql(score, (10,)))})) "
                f"AS precision_at_10 FROM ({_metrics_sql(score, model)})")
    b, c = row("score", "baseline"), row("cand", "candidate")
    return f"""
  SELECT b.model AS baseline, c.model AS candidate,
         round_even(c.precision_at_10 - b.precision_at_10, 6) AS delta_p_at_10,
         round_even(c.pr_auc - b.pr_auc, 6) AS delta_pr_auc,
         round_even(c.roc_auc - b.roc_auc, 6) AS delta_roc_auc,
         round_even(c.brier - b.brier, 6) AS delta_brier,
         CASE WHEN (c.precision_at_10 - b.precision_at_10 >= 0.01 OR c.pr_auc - b.pr_auc >= 0.01
                    OR c.roc_auc - b.roc_auc >= 0.01) AND c.brier <= b.brier + 0.002
              THEN 'uplift' ELSE 'no_uplift' END AS decision
  FROM ({b}) b, ({c}) c"""


@query("model_comparison", sql(_cmp_sql(), EV_CTE))
def model_comparison(spark, sf):
    """Baseline score vs a lag-free candidate; uplift decision rule."""
    ev = eval_frame(spark, sf)
    return Ev.compare_models(_model_row(ev, "score", "baseline"), _model_row(ev, "cand", "candidate"))


@query("ranking_summary", sql(" UNION ALL ".join(
    f"""SELECT '{sc}' AS score_col, {k} AS k, round_even(avg(hits_{k} / {k}), 6) AS precision,
       round_even(avg(CASE WHEN total_pos > 0 THEN CAST(hits_{k} AS DOUBLE) / total_pos END), 6) AS recall
       FROM ({_daily_sql(sc, (k,))})""" for sc in ("score", "cand") for k in (5, 10, 15)), EV_CTE))
def ranking_summary(spark, sf):
    """P@K / R@K for two score columns and K = 5, 10, 15 (unpivoted)."""
    return Ev.ranking_summary(eval_frame(spark, sf), ["score", "cand"], Y, (5, 10, 15))


@query("topk_per_day", sql("""
  SELECT date, nbhd_id, score, rk AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY score DESC, nbhd_id) AS rk FROM ev)
  WHERE rk <= 5""", EV_CTE))
def topk_per_day(spark, sf):
    """top-5 areas per test day (ties broken by area id)."""
    r = Ev.day_rank(eval_frame(spark, sf), "score")
    return r.where(F.col("rank") <= 5).select("date", "nbhd_id", "score", "rank")





@query("metrics_merge", sql(
    "SELECT m.*, l.* FROM (" + _metrics_sql("score", "collision_prob_t1") + ") m, (" + _lift_sql((5, 10)) + ") l",
    EV_CTE))
def metrics_merge(spark, sf):
    """Classification metrics joined with the ranking metrics of the same model."""
    ev = eval_frame(spark, sf)
    m = Ev.classification_metrics(ev, "score", Y, "collision_prob_t1")
    lf = Ev.lift_at_k(ev, "score", Y, (5, 10)).withColumn("model", F.lit("collision_prob_t1"))
    return m.join(lf, "model")


@query("metrics_by_model", sql(f"""
  SELECT model, yr, round_even(CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(neg * (pos_cum - pos + 0.5 * pos)) / (sum(pos) * sum(neg)) END, 6) AS roc_auc,
         round_even(sum(pos * pos_cum / (pos_cum + neg_cum)) / sum(pos), 6) AS pr_auc, round_even(sum(err) / sum(pos + neg), 6) AS brier,
         CAST(sum(pos + neg) AS BIGINT) AS n_test, round_even(sum(pos) / sum(pos + neg), 4) AS pos_rate
  FROM (SELECT *, sum(pos) OVER w AS pos_cum, sum(neg) OVER w AS neg_cum FROM (
          SELECT model, year(date) AS yr, s, sum({Y}) AS pos, sum(1 - {Y}) AS neg, sum(power(s - {Y}, 2)) AS err
          FROM (SELECT date, {Y}, 'score' AS model, CAST(score AS DOUBLE) AS s FROM ev
                UNION ALL SELECT date, {Y}, 'cand', CAST(cand AS DOUBLE) FROM ev) GROUP BY ALL)
        WINDOW w AS (PARTITION BY model, yr ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
  GROUP BY model, yr""", EV_CTE))
def metrics_by_model(spark, sf):
    """M1-M4 of two score columns in every test year, one plan for all."""
    e = eval_frame(spark, sf).select(F.year("date").alias("yr"), Y, F.inline(F.array(*[
        F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("s")) for c in ("score", "cand")])))
    return Ev.metrics_by(e, "s", Y, ["model", "yr"])
