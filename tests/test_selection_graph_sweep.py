import datetime as dt
import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from hoodcast.operators import graph, panel, selection


def test_quantiles_equal_percentile(spark):
    rnd = random.Random(2)
    rows = [("hot", rnd.lognormvariate(0, 40)) for _ in range(4000)] + [("hot", 7.0)] * 3000 + [("one", 3.5)] + [("two", -1.0), ("two", 2.0)]
    rows += [(None, float(rnd.randint(0, 5))) for _ in range(500)] + [("same", 1.25)] * 400 + [("none", None)] * 3
    rows += [("wide", x) for x in (-1e308, 1e308, 5e-324, 0.0, -0.0, 1e-300, float("inf"), -5.0)] + [("hot", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    probs = [0.0, 0.01, 0.3333, 0.5, 0.9, 0.999, 1.0]
    groups = defaultdict(list)
    for k, v in rows:
        if v is not None and not math.isnan(v):
            groups[k].append(v)
    want = {r.k: list(r.q) for r in df.where("not isnan(v)").groupBy("k").agg(F.percentile("v", probs).alias("q")).where("q is not null").collect()}
    for read_out, pieces in ((1, 3), (50, 8), (1 << 14, 64)):
        got = selection.quantiles(df, "v", probs, "k", read_out=read_out, pieces=pieces).collect()
        assert len(got) == len(groups) * len(probs)
        for r in got:
            assert r.n == len(groups[r.k])
            w = want[r.k][probs.index(r.p)]
            assert r.quantile == w or math.isnan(r.quantile) and math.isnan(w), (r, w)
    assert selection.median(df.where("k = 'two'"), "v").first()[0] == 0.5
    assert selection.median(df.where("k = 'none'"), "v").first()[0] is None
    assert selection.quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_quantile_buffers_are_bounded(spark):
    """Every rank is read out of at most ``read_out`` rows, whatever the table's size."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    (r,) = selection.quantiles(df, "v", [0.25], read_out=100, pieces=16).collect()
    assert r.quantile == float(np.quantile([(i * 7919) % 200_003 for i in range(200_000)], 0.25))
    plan = selection.quantiles(df, "v", [0.25], read_out=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and "median" not in plan


def test_components_against_union_find(spark):
    rnd = random.Random(4)
    links = [(rnd.randint(0, 600), rnd.randint(0, 600)) for _ in range(450)] + [(k, k + 1) for k in range(1000, 1300)]
    links += [(2000 + k, 2000) for k in range(1, 200)] + [(5, 5), (777, 777), (None, 3), (3, None)] + [(1300 - k, 1299 - k) for k in range(50)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in graph.components(df, "a", "b").collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(df.limit(0), "a", "b").count() == 0


def test_street_network(spark):
    """A detached part, a segment across the border, a node on it, parallel streets, a loop, an empty area."""
    sq = lambda x: [[{"x": x + a, "y": float(b)} for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]]
    polys = spark.createDataFrame([(1, sq(0.0)), (2, sq(1.0)), (3, sq(5.0)), (4, sq(7.0))], "nbhd_id int, rings array<array<struct<x:double,y:double>>>")
    nodes = [(1, 0.1, 0.1), (2, 0.2, 0.2), (3, 0.3, 0.3), (4, 0.8, 0.8), (5, 0.9, 0.9), (6, 1.5, 0.5), (7, 1.6, 0.6), (8, 1.0, 0.5), (9, 9.0, 9.0),
             (10, 5.5, 0.5), (11, 7.5, 0.5)]
    segments = [(1, 2, 100), (2, 3, 200), (3, 1, 300), (3, 1, 50), (4, 5, 1000), (5, 6, 7), (6, 7, 40), (7, 7, 5), (8, 1, 9), (9, 9, 9), (10, 6, 3)]
    got = {r.nbhd_id: tuple(r)[1:] for r in graph.street_network(
        spark.createDataFrame(nodes, "node long, x double, y double"), spark.createDataFrame(segments, "u long, v long, length_m long"), polys, cell=0.25).collect()}
    assert got[1] == (3, 4, 0.65, 3.0)      # 1: 4 streets (one to the node on the border), 2: 2, 3: 3
    assert got[2] == (2, 2, 0.045, 3.0)     # 6: 3 streets, two across; 7: its loop counts twice
    assert got[3] == got[4] == (0, 0, 0.0, 0.0)


def test_sweep_equals_expansion(spark):
    rnd = random.Random(9)
    day = dt.date(2020, 1, 1)
    rows = []
    for i in range(400):
        s = None if rnd.random() < 0.05 else day + dt.timedelta(days=rnd.randint(0, 300))
        e = None if rnd.random() < 0.2 or s is None else s + dt.timedelta(days=rnd.randint(-5, 40))
        rows.append((rnd.choice([1, 2, 3, None]), s, e, rnd.choice([None, 0, 1, 5])))
    rows.append((1, day, day + dt.timedelta(days=3650), 2))
    df = spark.createDataFrame(rows, "area int, start_date date, end_date date, sev int")
    n, sev = Counter(), Counter()
    for a, s, e, v in rows:
        if s is not None:
            for k in range(max(0, ((e or s) - s).days) + 1):
                n[s + dt.timedelta(days=k), a] += 1
                sev[s + dt.timedelta(days=k), a] += v or 0
    got = {(r.date, r.area): (r.active, r.sev) for r in panel.sweep_intervals(df, "area", {"sev": F.col("sev")}).collect()}
    assert got == {k: (n[k], sev[k]) for k in n}
    long = df.where("sev = 2 AND end_date > '2029-01-01'")
    assert panel.sweep_intervals(long, "area", {"sev": F.col("sev")}).count() == 3651


def test_ranks_of_one_range_share_its_rows(spark):
    """However many ranks are wanted, a round looks at a value once per range, not once per rank."""
    vals = spark.range(3000).select(F.struct(F.lit(0).alias("_")).alias("g"), F.col("id").cast("double").alias("v"))
    ranks = spark.createDataFrame([(k, 0.0, 2999.0, 0, 3000) for k in (0, 5, 1500, 2999)], "k long, a double, b double, below long, inside long")
    ranks = ranks.select(F.struct(F.lit(0).alias("_")).alias("g"), "*")
    assert selection._inside(vals, ranks).count() == 3000
    for r in selection._refined(vals, ranks, 8).collect():
        assert r.a <= r.k <= r.b and r.below <= r.k < r.below + r.inside and r.a == r.below
