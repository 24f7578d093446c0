import datetime as dt

from pyspark.sql import functions as F

from hoodcast.config import Settings
from hoodcast.operators import quality as Q
from hoodcast.operators import surge as Su


def test_density_and_duplicates(spark):
    rows = [(1, dt.date(2020, 1, d)) for d in (1, 2, 4)] + [(2, dt.date(2020, 1, d)) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows + [(2, dt.date(2020, 1, 3))], "nbhd_id int, date date")
    assert {r["nbhd_id"] for r in Q.density_violations(df).collect()} == {1, 2}
    assert Q.duplicate_keys(df, ["nbhd_id", "date"]).count() == 1
    c = Q.duplicate_count(df, ["nbhd_id", "date"]).first()
    assert (c["rows"], c["distinct_keys"], c["duplicates"]) == (7, 6, 1)


def test_incremental_merge_keeps_last(spark):
    old = spark.createDataFrame([(1, 10.0, 1), (2, 20.0, 1)], "k int, v double, load_seq int")
    new = spark.createDataFrame([(2, 21.0, 2), (3, 30.0, 2)], "k int, v double, load_seq int")
    got = sorted((r["k"], r["v"]) for r in Q.incremental_merge(old, new, ["k"]).collect())
    assert got == [(1, 10.0), (2, 21.0), (3, 30.0)]


def test_seasonal_threshold_fallback_and_quantile(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i % 4 + 1)) for i in range(20)]
    df = spark.createDataFrame(days, "date date, v double")
    r = Su.seasonal_threshold(df, "v", Settings()).first()
    assert r["method"] == "raw_quantile"
    q = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    assert abs(Su.raw_threshold(q, "v", 0.9).first()["threshold"] - 3.7) < 1e-12


def test_rollup_rules():
    assert Su.rollup_rule("intersection_count") == "sum"   # T22: caught by 'count'
    assert Su.rollup_rule("tavg") == "mean"
    assert Su.rollup_rule("construction_total_pressure", three_way=True) == "max"
    assert Su.rollup_rule("road_events_count", three_way=True) == "sum"
    assert Su.rollup_rule("is_weekend", three_way=True) == "max"


def test_merge_neutral(spark):
    f = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 2),), (dt.date(2024, 1, 3),)], "date date")
    s = spark.createDataFrame([(dt.date(2023, 12, 31), 0.9), (dt.date(2024, 1, 2), 0.8)],
                              "date date, surge_proba_t1 double")
    got = dict(Su.merge_surge_neutral(f, s, Settings()).select("date", "surge_proba_t1").collect())
    assert list(sorted(got.values())) == [0.5, 0.5, 0.8]
    assert f.select(F.count("*")).first()[0] == 3


def test_canonical_columns_first_wins(spark):
    df = spark.createDataFrame([(1, "a", "b")], "nbhd_id int, AREA_NAME string, area_name string")
    out = Q.canonical_columns(df, {"AREA_NAME": "area_name"})
    assert out.columns == ["nbhd_id", "area_name"] and out.first()["area_name"] == "a"


def test_column_profile_and_missing_rate(spark):
    df = spark.createDataFrame([(0, None), (2, 1.0), (4, None)], "a int, b double")
    p = {r["column"]: r for r in Q.column_profile(df, ["a", "b"]).collect()}
    assert (p["a"]["n"], p["a"]["nonzero"], p["a"]["mean"]) == (3, 2, 2.0)
    assert p["b"]["nulls"] == 2
    m = {r["column"]: r["missing_rate"] for r in Q.missing_rate(df, ["a", "b"]).collect()}
    assert m == {"a": 0.0, "b": 2 / 3}


def test_weather_of_any_number_of_cells(spark, monkeypatch):
    """Parts of the cells do not change the days' weather."""
    from hoodcast.operators import weather as We
    city = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-01-03')) AS date, 1.0 AS tavg, -1.0 AS tmin, 3.0 AS tmax, 2.0 AS prcp, "
                     "1.0 AS snow, 9.0 AS wspd")
    cells = spark.range(57).select(F.concat(F.lit("c"), "id").alias("coord_key"), (43 + F.col("id") / 10).alias("lat_round"),
                                   (-79 - F.col("id") / 10).alias("lon_round"))
    whole = sorted(map(tuple, We.micro_weather_proxy(city, cells).collect()))
    monkeypatch.setattr(We, "CELLS_PER_ROW", 5)
    assert sorted(map(tuple, We.micro_weather_proxy(city, cells.union(cells)).collect())) == whole and len(whole) == 3 * 57
