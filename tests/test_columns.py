import datetime as dt

from pyspark.sql import functions as F

from hoodcast.functions import columns as C


def test_rfc1123_and_epoch(spark):
    df = spark.createDataFrame([("Sun, 01 Jan 2006 10:00:00 GMT", 1136109600),
                                ("garbage", None), (None, 86399)], "s string, e long")
    r = df.select(C.rfc1123_to_date("s").alias("d"), C.epoch_to_date("e").alias("e")).collect()
    assert r[0]["d"] == dt.date(2006, 1, 1) and r[0]["e"] == dt.date(2006, 1, 1)
    assert r[1]["d"] is None and r[1]["e"] is None
    assert r[2]["d"] is None and r[2]["e"] == dt.date(1970, 1, 1)


def test_severity_truthy_regex_safe_div(spark):
    df = spark.createDataFrame([(" Major ", "TRUE", "Fatal", 4, 2), ("moderate", "yes", "MAJOR injury", 1, 0),
                                ("weird", "no", None, 0, 0), (None, "1", "minor", None, 1)],
                               "sev string, fc string, inj string, a int, b int")
    r = df.select(C.severity_weight("sev").alias("w"), C.truthy_flag("fc").alias("t"),
                  C.regex_flag("inj", "serious|major").alias("s"), C.safe_div("a", "b").alias("q")).collect()
    assert [x["w"] for x in r] == [3, 2, 1, 1]
    assert [x["t"] for x in r] == [1, 1, 0, 1]
    assert [x["s"] for x in r] == [False, True, False, False]
    assert [x["q"] for x in r] == [2.0, None, None, None]


def test_clean_feature_and_bround(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (2.5,)], "x double")
    assert [r[0] for r in df.select(C.clean_feature("x")).collect()] == [0.0, 0.0, 0.0, 2.5]
    k = spark.range(1).select(C.coord_key(F.lit(0.25), F.lit(0.35)).alias("k")).first()["k"]
    assert k == "0.2_0.4"  # half-even like numpy
