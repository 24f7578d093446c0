import datetime as dt
import random

from hoodcast.operators import evaluate as Ev


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(rows):
    P = sum(y for _, y in rows)
    ap, tp, fp = 0.0, 0, 0
    for s in sorted({s for s, _ in rows}, reverse=True):
        grp = [y for t, y in rows if t == s]
        tp += sum(grp)
        fp += len(grp) - sum(grp)
        ap += sum(grp) / P * tp / (tp + fp)
    return ap


def test_auc_ap_with_ties(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 20) / 20.0, int(rnd.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, y int")
    r = Ev.auc_ap(df, "score", "y", buckets=8).first()
    assert abs(r["roc_auc"] - _brute_auc(rows)) < 1e-12
    assert abs(r["pr_auc"] - _brute_ap(rows)) < 1e-12
    m = Ev.classification_metrics(df, "score", "y", "m").first()
    assert m["n_test"] == 400 and 0 <= m["brier"] <= 1


def test_precision_recall_fixed_k_and_empty_days(spark):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    rows = [(d1, 1, 0.9, 1), (d1, 2, 0.9, 0), (d1, 3, 0.1, 1),  # tie at 0.9 -> area 1 first
            (d2, 1, 0.5, 0), (d2, 2, 0.4, 0)]                   # a day without positives
    df = spark.createDataFrame(rows, "date date, nbhd_id int, score double, y int")
    z = Ev.precision_recall_at_k(df, "score", "y", (1, 5), "zero").first()
    assert z["precision_at_1"] == 0.5 and z["recall_at_1"] == 0.25
    assert z["precision_at_5"] == round((2 / 5 + 0) / 2, 6)  # K fixed although fewer rows
    s = Ev.precision_recall_at_k(df, "score", "y", (1,), "skip").first()
    assert s["recall_at_1"] == 0.5


def test_k_sweep_and_drift(spark):
    rnd = random.Random(3)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=d), a, rnd.random(), int(rnd.random() < 0.5))
            for d in range(10) for a in range(1, 8)]
    df = spark.createDataFrame(rows, "date date, nbhd_id int, score double, y int")
    sw = Ev.k_sweep(df, "score", "y", kmax=10, top=3).collect()
    assert len(sw) == 3 and sw[0]["lift"] >= sw[-1]["lift"]
    dr = Ev.drift_check(df, "score", "y", k=3).first()
    assert dr["early_p_at_3"] is not None and dr["late_p_at_3"] is not None


def test_metrics_of_many_models(spark, monkeypatch):
    """One plan for all groups, whatever ranges they are dealt to: a large group, small ones, one class only, a null key, ties."""
    import random

    from hoodcast.operators import evaluate as Ev
    rnd = random.Random(8)
    rows = [("big", rnd.random(), int(rnd.random() < 0.3)) for _ in range(3000)]
    rows += [(g, rnd.randint(0, 4) / 4, rnd.randint(0, 1)) for g in ("a", "b", None) for _ in range(60)] + [("one", 0.5, 1), ("none", 0.2, 0), ("none", 0.9, 0)]
    df = spark.createDataFrame(rows, "m string, s double, y int").repartition(4)
    for size in (7, 200_000):
        monkeypatch.setattr(Ev, "SCORES_PER_TASK", size)
        got = {r.m: r for r in Ev.metrics_by(df, "s", "y", "m").collect()}
        assert set(got) == {"big", "a", "b", None, "one", "none"}
        for g, r in got.items():
            own = [(s, y) for m, s, y in rows if m == g]
            pos, neg = [s for s, y in own if y], [s for s, y in own if not y]
            assert r.n_test == len(own) and r.pos_rate == round(len(pos) / len(own), 4)
            assert abs(r.brier - sum((s - y) ** 2 for s, y in own) / len(own)) < 1e-6
            if not pos or not neg:
                assert r.roc_auc is None
            else:
                auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
                assert abs(r.roc_auc - auc) < 1e-6
            if pos:
                ap = sum(sum(p >= s for p in pos) / sum(x >= s for x, _ in own) for s in pos) / len(pos)
                assert abs(r.pr_auc - ap) < 1e-6
    assert Ev.metrics_by(df.limit(0), "s", "y", "m").count() == 0
