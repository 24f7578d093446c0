import random

import pytest
from pyspark.sql import functions as F

from hoodcast.operators import models as M


def test_calibrated_ensemble_on_planted_signal(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        x = rnd.random()
        rows.append((i, x, rnd.random(), int((x > 0.5) != (rnd.random() < 0.1))))
    df = spark.createDataFrame(rows, "id int, x double, noise double, y int")
    ens = M.fit_calibrated(df, ["x", "noise"], "y", ["id"], M.TreeParams(max_iter=10, min_instances=5))
    p = ens.predict(df, "p").select("p", "y", "x").toPandas()
    assert p["p"].between(0, 1).all()
    assert p[p.x > 0.8]["p"].mean() > p[p.x < 0.2]["p"].mean()
    imp = ens.importances(spark).collect()
    assert imp[0]["feature"] == "x"


def test_no_positive_guard(spark):
    df = spark.createDataFrame([(i, float(i), 0) for i in range(20)], "id int, x double, y int")
    ens = M.fit_calibrated(df, ["x"], "y", ["id"], M.TreeParams(max_iter=3))
    assert ens.constant == 0.0
    assert ens.predict(df, "p").agg(F.max("p")).first()[0] == 0.0


def test_fits_read_rows_without_lineage(spark):
    df = spark.createDataFrame([(i, float(i % 7), i % 2) for i in range(40)], "id int, x double, y int")
    rows, pos, n = M._weighted(df, ["x"], "y", ["id"], M.TreeParams(), 3)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert (pos, n) == (20, 40) and "ExistingRDD" in plan and "parquet" not in plan
    assert M._classifier("y", M.TreeParams(), n).getCheckpointInterval() == M.CHECKPOINT_TREES


def test_area_training_rows_need_no_city_model(spark, monkeypatch):
    from hoodcast.plans import q_models as Q
    split = Q.S.split_date
    rows = [(split.replace(year=split.year - 1), 1, 2.0), (split, 1, 3.0), (None, 2, 4.0)]
    plain = spark.createDataFrame(rows, "date date, nbhd_id int, x double")
    monkeypatch.setattr(Q, "_plain", lambda *_: plain)
    monkeypatch.setattr(Q, "_shared", lambda spark, sf, what, make: make())
    monkeypatch.setattr(Q, "surge_models", lambda *_: "city")
    assert [tuple(r) for r in Q._train(spark, "").collect()] == [(rows[0][0], 1, 2.0, 0.5, 0.5)]
    assert Q._beside_city(spark, "", [lambda: "a", lambda: "b"]) == ["a", "b"]


class Fitted(Exception):
    pass


WHOLE_FITS = ["count_scores", "collision_models", "importances", "latest_scores", "planted_scores", "surge_models", "comparison", "legacy_surge_scores"]


@pytest.mark.parametrize("made", WHOLE_FITS)
def test_fits_read_every_labelled_row(spark, monkeypatch, made):
    from hoodcast.plans import q_models as Q
    days = spark.range(2_100).select(F.date_sub(F.lit(Q.S.split_date), (F.col("id") + 1).cast("int")).alias("date"), F.lit(1).alias("nbhd_id"),
                                     *[F.col("id").cast("double").alias(c) for c in (*Q.PLANTED, "collisions_t1")],
                                     *[(F.col("id") % 2).cast("int").alias(c) for c in ("y", "target_collision_t1")])
    monkeypatch.setattr(Q, "_shared", lambda spark, sf, what, make: make())
    monkeypatch.setattr(Q, "city_table", lambda *_: {1: days})
    for rows in ("_plain", "_train", "_features"):
        monkeypatch.setattr(Q, rows, lambda *_: days)
    if made != "surge_models":
        monkeypatch.setattr(Q, "surge_models", lambda *_: {})

    def fit(train, features, label, keys, params, *_):
        raise Fitted(M.bounded(train.where(F.col(label).isNotNull()), keys, params.fit_rows).count())

    for name in ("fit_calibrated", "fit_balanced", "fit_count_regressor"):
        monkeypatch.setattr(M, name, fit)
    with pytest.raises(Fitted, match="2100"):
        getattr(Q, made)(spark, "")


def _mixed(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(900):
        a, b, c = rnd.random(), rnd.gauss(0, 1), float(rnd.randrange(7))
        rows.append((i, a, b, c, 2 * b, 1.0, int((a * c + b > 1.5) != (rnd.random() < 0.2)), 3 * a + c))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, twice_b double, same double, y int, z double")


def test_fits_in_one_task_are_those_of_spark_ml(spark, monkeypatch):
    df, cols = _mixed(spark), ["a", "b", "c", "twice_b", "same"]
    params = M.TreeParams(max_iter=6, max_depth=4, min_instances=9, feature_subset="all")
    count = M.TreeParams(max_iter=6, max_depth=5, step_size=0.05)

    def scores():
        x = M.clean_features(df, cols)
        models = [gbt for gbt, _ in M.fit_calibrated(df, cols, "y", ["id"], params).members] \
            + [M.fit_balanced(df, cols, "y", ["id"], params).members[0][0], M.fit_count_regressor(df, cols, "z", ["id"], count)]
        return [{r.id: [r.prediction, *(r.probability if "probability" in r else ())] for r in m.transform(x).collect()} for m in models]

    here = scores()
    monkeypatch.setattr(M.boosting, "LOCAL_VALUES", 0)
    for mine, theirs in zip(here, scores(), strict=True):
        assert len(mine) == 900 and all(mine[i] == pytest.approx(theirs[i], abs=1e-9) for i in theirs)


def test_jobs_of_a_fit_do_not_grow_with_its_trees(spark):
    df, tracker = _mixed(spark), spark.sparkContext.statusTracker()
    taken = []
    for trees in (2, 40):
        first = max(tracker.getJobIdsForGroup())
        model = M.fit_count_regressor(df, ["a", "b", "c"], "z", ["id"], M.TreeParams(max_iter=trees, max_depth=4))
        taken.append(max(tracker.getJobIdsForGroup()) - first)
        assert model.stages[-1].getNumTrees == trees
    assert taken[1] <= taken[0] + 5 and taken[1] < 60


def test_whole_tables_bins_and_odd_labels():
    import numpy as np
    from hoodcast.operators import boosting as B
    rng = np.random.default_rng(0)
    x = np.stack([rng.normal(size=5_000), rng.integers(0, 3, 5_000), np.ones(5_000)], 1)
    cuts = [B.cut_points(x[:, f], np.ones(5_000), 32) for f in range(3)]
    assert [len(c) for c in cuts] == [31, 2, 0] and list(cuts[1]) == [0.5, 1.5]
    sizes = np.bincount(np.searchsorted(cuts[0], x[:, 0]))
    assert sizes.min() >= 150 and sizes.max() <= 165 and sizes.sum() == 5_000
    with pytest.raises(ValueError, match="labels"):
        B.boost(x, x[:, 1], np.ones(5_000), logistic=True, trees=1, step=0.1, max_depth=2, min_instances=1, feature_share=1.0, seed=1)
    # rows in another order, one constant column, features left out at random: the same trees
    y, order = (x[:, 0] > 0).astype(float), rng.permutation(5_000)
    args = {"logistic": True, "trees": 3, "step": 0.1, "max_depth": 3, "min_instances": 5, "feature_share": 0.5, "seed": 1}
    w = np.where(y == 1, 2.0, 1.0)
    for a, b in zip(B.boost(x, y, w, **args), B.boost(x[order], y[order], w[order], **args)):
        assert (a == b).all()
