import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from hoodcast.operators import windows as Wn


def _ramp(spark, n=35, null_at=None):
    rows = []
    for a in (1, 2):
        for i in range(n):
            v = None if (null_at is not None and a == 1 and i == null_at) else float(i + 100 * a)
            rows.append((a, dt.date(2020, 1, 1) + dt.timedelta(days=i), v))
    return spark.createDataFrame(rows, "nbhd_id int, date date, x double")


def test_first_valid_positions(spark):
    df = _ramp(spark)
    w = Wn.area_window()
    out = df.select("nbhd_id", "date", *Wn.lag_roll_columns(["x"], [1, 7, 14], [7, 14, 30], w)).toPandas()
    for a, g in out.sort_values("date").groupby("nbhd_id"):
        g = g.reset_index(drop=True)
        for L in (1, 7, 14):
            assert g[f"x_lag{L}"].first_valid_index() == L
        for W in (7, 14, 30):
            assert g[f"x_roll{W}_mean"].first_valid_index() == W
            assert g[f"x_roll{W}_sum"].first_valid_index() == W


def test_matches_pandas_with_null(spark):
    df = _ramp(spark, null_at=10)
    w = Wn.area_window()
    got = df.select("nbhd_id", "date", Wn.trailing("x", 7, w, "mean").alias("m"),
                    Wn.trailing("x", 7, w, "sum").alias("s")).toPandas().sort_values(["nbhd_id", "date"])
    pdf = df.toPandas().sort_values(["nbhd_id", "date"]).reset_index(drop=True)
    sh = pdf.groupby("nbhd_id")["x"].shift(1)
    exp_m = sh.rolling(7).mean()  # the reference's flat rolling over a grouped shift (trap T2)
    exp_s = sh.rolling(7).sum()
    pd.testing.assert_series_equal(got["m"].reset_index(drop=True), exp_m, check_names=False)
    pd.testing.assert_series_equal(got["s"].reset_index(drop=True), exp_s, check_names=False)


def test_trailing_min_periods(spark):
    df = _ramp(spark, n=20).where(F.col("nbhd_id") == 1)
    w = Wn.area_window()
    r = df.select(Wn.trailing_minp("x", 60, 14, w, "mean").alias("m")).toPandas()["m"]
    assert r.first_valid_index() == 14


def test_blocks_do_not_change_values(spark):
    import datetime as dt
    import random

    import pytest

    from hoodcast.operators import windows as Wn
    rnd = random.Random(3)
    rows = [(a, dt.date(1969, 11, 1) + dt.timedelta(days=i), rnd.randint(0, 4), rnd.random()) for a in (1, 2) for i in range(400)]
    df = spark.createDataFrame(rows, "nbhd_id int, date date, collisions int, tavg double")
    w = Wn.area_window()
    whole = Wn.add_lag_roll(df, ["collisions", "tavg"], [1, 14], [7, 30], w, [Wn.lead("collisions", 2, w).alias("t2")])
    for days in (40, 150, 5000):
        b = Wn.in_blocks(df, days, 31, 2)
        part = ["nbhd_id", "_block"]
        got = Wn.own_rows(Wn.add_lag_roll(b, ["collisions", "tavg"], [1, 14], [7, 30], None,
                                          [Wn.lead("collisions", 2, Wn.area_window(part)).alias("t2")], part)).select(*whole.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    assert Wn.in_blocks(df, 40, 31, 2).select("nbhd_id", "_block").distinct().count() > 20
    with pytest.raises(ValueError, match="longer"):
        Wn.in_blocks(df, 33, 31, 2)
