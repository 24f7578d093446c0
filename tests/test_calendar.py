import datetime as dt

from pyspark.sql import functions as F

from hoodcast.config import Settings
from hoodcast.operators.features import calendar_features


def test_named_holidays(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 2, 19), dt.date(2024, 3, 29), dt.date(2024, 5, 20),
            dt.date(2024, 7, 1), dt.date(2024, 9, 2), dt.date(2024, 10, 14), dt.date(2024, 12, 25),
            dt.date(2024, 12, 26), dt.date(2001, 4, 13), dt.date(2001, 2, 19)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    r = {x["date"]: x for x in calendar_features(df).collect()}
    assert all(r[d]["is_holiday"] == 1 for d in days[:10])
    assert r[dt.date(2001, 2, 19)]["is_holiday"] == 0  # no Family Day before 2008
    assert r[dt.date(2024, 12, 25)]["pre_holiday"] == 1 and r[dt.date(2024, 12, 26)]["post_holiday"] == 1
    assert r[dt.date(2024, 1, 1)]["dow"] == 0 and r[dt.date(2024, 1, 1)]["is_weekend"] == 0


def test_pre_post(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 30),), (dt.date(2024, 7, 2),), (dt.date(2024, 7, 3),)], "date date")
    r = sorted(calendar_features(df).select("date", "pre_holiday", "post_holiday").collect())
    assert [(x[1], x[2]) for x in r] == [(1, 0), (0, 1), (0, 0)]
    assert df.select(F.count("*")).first()[0] == 3


def test_year_end_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 2),), (dt.date(2024, 1, 1),)], "date date")
    r = {x["date"]: x for x in calendar_features(df).collect()}
    assert r[dt.date(2023, 12, 31)]["pre_holiday"] == 1 and r[dt.date(2023, 12, 31)]["is_holiday"] == 0
    assert r[dt.date(2024, 1, 2)]["post_holiday"] == 1
    assert r[dt.date(2024, 1, 1)]["post_holiday"] == 0


def test_observed(spark):
    """Boxing Day 2021 is a Sunday and Christmas a Saturday: the Monday after counts when asked for."""
    df = spark.createDataFrame([(dt.date(2021, 12, 27),), (dt.date(2021, 12, 28),)], "date date")
    for observed, want in ((False, [0, 0]), (True, [1, 0])):
        r = calendar_features(df, Settings(include_observed_holidays=observed)).orderBy("date").collect()
        assert [x["is_holiday"] for x in r] == want
