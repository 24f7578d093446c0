import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hoodcast.config import ADAPTER
from hoodcast.operators import quality as Q
from hoodcast.plans import inputs as I
from hoodcast.plans import jobs
from hoodcast.session import cut_lineage

from places import SF_SMALL


def test_build_features_and_refresh(spark):
    out = tempfile.mkdtemp(prefix="hoodcast-jobs-")
    panel = cut_lineage(I.dense(spark, SF_SMALL))
    gold = jobs.build_gold(panel, I.ksi_daily(spark, SF_SMALL), I.weather_daily(spark, SF_SMALL),
                           I.disruption_daily(spark, SF_SMALL), os.path.join(out, "gold"))
    f = jobs.build_features(gold, I.adjacency(spark, SF_SMALL), os.path.join(out, "features"), ADAPTER)
    assert Q.duplicate_keys(f, ["date", "nbhd_id"]).count() == 0
    assert f.select(F.countDistinct("nbhd_id")).first()[0] == 25
    # first 7 days (roll7 needs them) and last 2 days (furthest lead) are dropped per area
    assert f.count() == 25 * (2499 - 7 - 2)
    state = f.select("date", "nbhd_id", "collisions", F.lit(1).alias("load_seq"))
    landed = state.where(F.col("date") >= "2001-10-01").withColumn("collisions", F.col("collisions") + 1) \
        .withColumn("load_seq", F.lit(2))
    merged = jobs.refresh(spark, state, landed, out=os.path.join(out, "state_v2"))
    assert merged.count() == state.count()
    assert merged.where(F.col("load_seq") == 2).count() == landed.count()
    with pytest.raises(ValueError, match="off the grid"):
        jobs.refresh(spark, state, landed.withColumn("nbhd_id", F.lit(99)), grid=state)


def test_gates_raise(spark):
    gold = cut_lineage(I.gold(spark, SF_SMALL))
    adj = I.adjacency(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="hoodcast-gates-")
    faults = {
        "gold key": gold.union(gold.limit(1)),
        "distinct nbhd_id": gold.where("nbhd_id <> 4"),
        "collisions_ge_0": gold.withColumn("collisions", F.when(F.col("nbhd_id") == 4, -1).otherwise(F.col("collisions"))),
        "gold days": gold.where("nbhd_id <> 4 OR dayofmonth(date) <> 7"),
        "missing required": gold.drop("tavg"),
    }
    for text, bad in faults.items():
        with pytest.raises(ValueError, match=text):
            jobs.build_features(bad, adj, os.path.join(out, "f"), ADAPTER)
    weather = I.weather_daily(spark, SF_SMALL)
    with pytest.raises(ValueError, match="days without weather"):
        jobs.build_gold(gold.select("date", "nbhd_id", "area_id", "area_name", "collisions"), I.ksi_daily(spark, SF_SMALL),
                        weather.where("dayofmonth(date) <> 9"), I.disruption_daily(spark, SF_SMALL), os.path.join(out, "g"))


def test_train_and_score(spark):
    """Train both layers on a slice with few trees, save, reload and score every row."""
    from hoodcast.operators import models as M
    out = tempfile.mkdtemp(prefix="hoodcast-train-")
    f = cut_lineage(I.features(spark, SF_SMALL).where("nbhd_id <= 4 AND date >= '1999-01-01'"))
    few = M.TreeParams(max_iter=2, max_depth=3, fit_rows=400)
    surge = jobs.train_surge(f, os.path.join(out, "surge"), ADAPTER, few)
    # the last day has no next day to be labelled by
    assert surge.count() == f.where(F.col("date") >= F.lit(ADAPTER.split_date)).select("date").distinct().count() - 1
    preds = jobs.train_nbhd(f, surge, os.path.join(out, "nbhd"), ADAPTER, few)
    assert preds.count() == f.where(F.col("date") >= F.lit(ADAPTER.split_date)).count()
    assert Q.duplicate_keys(preds, ["date", "nbhd_id"]).count() == 0
    train = f.where(F.col("date") < F.lit(ADAPTER.split_date))
    city = M.fit_calibrated(train, ["collisions", "tavg"], "target_collision_t1", ["date", "nbhd_id"], few)
    area = M.fit_calibrated(train, ["collisions_lag1", "surge_proba_t1"], "target_collision_t1", ["date", "nbhd_id"],
                            few) if "surge_proba_t1" in train.columns else city
    M.save(area, os.path.join(out, "m"))
    area = M.load(os.path.join(out, "m"), area.features, len(area.members), constant=area.constant)
    c, a = jobs.score(f, city, area, os.path.join(out, "scores"), "now", "v")
    assert len(c.columns) == 8 and len(a.columns) == 14 and a.count() == f.count()
    last = a.groupBy("nbhd_id").agg(F.max("date").alias("date"))
    assert a.where("proba_collision_t2 IS NULL").join(last, ["nbhd_id", "date"]).count() == 4
    assert a.where("proba_collision_t2 IS NULL").count() == 4


def test_row_count_gate_raises_and_removes(spark, tmp_path):
    """A measure table with a key twice would multiply the panel's rows."""
    panel = cut_lineage(I.dense(spark, SF_SMALL).where("date < '1995-06-01'"))
    ksi = cut_lineage(I.ksi_daily(spark, SF_SMALL).where("date < '1995-06-01'"))
    weather, road = I.weather_daily(spark, SF_SMALL), I.disruption_daily(spark, SF_SMALL).where("date < '1995-06-01'")
    n = panel.count()
    with pytest.raises(ValueError, match=f"gold: {n} rows before, {n + ksi.count()} after"):
        jobs.build_gold(panel, ksi.union(ksi), weather, road, str(tmp_path / "g"))
    assert not os.path.exists(tmp_path / "g")
    gold = jobs.build_gold(panel, ksi, weather, road, str(tmp_path / "g"))
    assert gold.count() == n and "_year" not in gold.columns
    bad = panel.withColumn("collisions", F.when(F.col("nbhd_id") == 2, -1).otherwise(F.col("collisions")))
    with pytest.raises(ValueError, match="gold contract: .*collisions_ge_0"):
        jobs.build_gold(bad, ksi, weather, road, str(tmp_path / "h"))
    assert not os.path.exists(tmp_path / "h")


def test_written_tables_are_scanned_once(spark, tmp_path):
    """The result's gates come from the write itself: no job reads the table afterwards."""
    panel = cut_lineage(I.dense(spark, SF_SMALL).where("date < '1995-06-01'"))
    rows = panel.withColumns({"tavg": F.lit(1.0), "ksi_fatal_victims": F.lit(0), "ksi_victim_count": F.lit(0)})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("gated", "gated")
    jobs.write_gated(rows, str(tmp_path / "t"), "gold", expected=25, rows=panel.count())
    jobs_run = len(tracker.getJobIdsForGroup("gated"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_run <= 4  # the write, its count of the input, the schema of what was written
    with pytest.raises(ValueError, match="24 distinct nbhd_id"):
        jobs.write_gated(rows.where("nbhd_id <> 3"), str(tmp_path / "u"), "gold", expected=25)
    with pytest.raises(ValueError, match="rows with none"):
        jobs.write_gated(rows.withColumn("nbhd_id", F.when(F.col("collisions") > 0, 99_999).otherwise(F.col("nbhd_id"))),
                         str(tmp_path / "v"), "gold", expected=25)


def test_lookup_gates_raise(spark):
    daily = spark.createDataFrame([("1", 3), ("2", 4)], "area_id string, n int")
    dim = spark.createDataFrame([(1, 10), (2, 20)], "area_id int, nbhd_id int")
    assert {(r.area_id, r.nbhd_id) for r in jobs.attach_areas(daily, dim).collect()} == {("1", 10), ("2", 20)}
    with pytest.raises(ValueError, match="without a match"):
        jobs.attach_areas(daily, dim.where("area_id = 1"))
    with pytest.raises(ValueError, match="dimension key"):
        jobs.attach_areas(daily, dim.union(dim))
    w = spark.sql("SELECT DATE'2020-01-01' AS date, 'a' AS coord_key, 1.0 AS tavg, 1.0 AS tmin, 1.0 AS tmax, 0.0 AS prcp, 0.0 AS snow, 0.0 AS wspd, "
                  "0 AS freeze_day, 0 AS snow_day, 0 AS rain_day")
    cells = spark.createDataFrame([(1, "a")], "nbhd_id int, coord_key string")
    panel = spark.sql("SELECT DATE'2020-01-01' AS date, 1 AS nbhd_id, 0.0 AS tavg")
    assert jobs.expand_weather(panel, w, cells).first().tavg == 1.0
    for bad in ((w.union(w), cells, "cell weather key"), (w, cells.union(cells), "area cell key"),
                (w, spark.createDataFrame([(1, "b")], cells.schema), "without weather")):
        with pytest.raises(ValueError, match=bad[2]):
            jobs.expand_weather(panel, *bad[:2])


def test_contract_coerces_types(spark):
    """Texts are read as their contract's type; what is none counts as missing."""
    rows = spark.createDataFrame([("2020-01-01", "3", "0.5"), ("2020-01-02", "4", None), ("01/02", "5", "0.1")],
                                 "date string, nbhd_id string, proba_collision_t1 string")
    good = rows.where("date LIKE '2020%'")
    Q.require_contract(good, "nbhd_predictions")
    assert dict(Q.coerced(good, "nbhd_predictions").dtypes) == {"date": "date", "nbhd_id": "int", "proba_collision_t1": "double"}
    with pytest.raises(ValueError, match="date_not_null': 1"):
        Q.require_contract(rows, "nbhd_predictions")
    with pytest.raises(ValueError, match="proba_in_range"):
        Q.require_contract(good.withColumn("proba_collision_t1", F.lit("1.5")), "nbhd_predictions")
    with pytest.raises(ValueError, match="nbhd_id_ge_1"):
        Q.require_contract(good.withColumn("nbhd_id", F.lit("north")), "nbhd_predictions")


def test_merge_rewrites_only_touched_periods(spark, tmp_path):
    from hoodcast.sources import state as St
    path = str(tmp_path / "state")

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}

    def load(lo, hi, seq, value):
        return spark.range(2).select(F.explode(F.expr(f"sequence(date'{lo}', date'{hi}')")).alias("date"), F.col("id").cast("int").alias("nbhd_id")) \
            .withColumns({"v": F.lit(float(value)), "load_seq": F.lit(seq)})

    keys = ["date", "nbhd_id"]
    assert St.read_state(spark, path) is None and St.manifest(spark, path).count() == 0
    assert St.merge_load(load("2020-01-01", "2020-04-30", 1, 1), path, "a", keys)["status"] == "merged"
    first = files()
    got = St.merge_load(load("2020-03-15", "2020-03-20", 2, 2), path, "b", keys)
    assert got == {"status": "merged", "rows": 12, "periods": ["2020-03"]}
    kept = first & files()
    assert len(first) == 4 and len(kept) == 3 and not any("2020-03" in f for f in kept)
    state = St.read_state(spark, path)
    assert state.count() == 121 * 2 and state.where("v = 2").count() == 12
    before = files()
    assert St.merge_load(load("2020-03-15", "2020-03-20", 2, 2), path, "b", keys)["status"] == "repeated" and files() == before
    with pytest.raises(ValueError, match="with other rows"):
        St.merge_load(load("2020-03-15", "2020-03-20", 2, 3), path, "b", keys)
    St.merge_load(load("2020-03-15", "2020-03-20", 1, 9), path, "late", keys)  # an older load does not win
    assert St.read_state(spark, path).where("v = 9").count() == 0
    batch = load("2020-05-01", "2020-05-02", 3, 1)
    for bad, text in ((batch.union(batch), "batch keys"), (batch.withColumn("date", F.lit(None).cast("date")), "without a date")):
        with pytest.raises(ValueError, match=text):
            St.merge_load(bad, path, "c", keys)
    with pytest.raises(ValueError, match="off the grid"):
        St.merge_load(batch, path, "c", keys, grid=St.read_state(spark, path))
    assert {r.load_id for r in St.manifest(spark, path).collect()} == {"a", "b", "late"}
    got = St.merge_load(batch.withColumn("extra", F.lit("x")), path, "d", keys)
    assert got["status"] == "replaced" and St.read_state(spark, path).count() == 4 and St.manifest(spark, path).count() == 1


def test_records_by_glob(spark, tmp_path):
    from hoodcast.sources import readers as Rd
    for k in range(3):
        (tmp_path / f"m{k}.json").write_text('{"a": %d}\n' % k)
    assert Rd.read_json_records(spark, str(tmp_path / "m*")).count() == 3
    assert Rd.exists(spark, str(tmp_path / "m[01].json")) and not Rd.exists(spark, str(tmp_path / "n*"))
