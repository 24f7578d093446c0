import json

import pytest
from pyspark.sql import functions as F

from hoodcast.sources import readers as Rd
from hoodcast.sources.readers import DAILY_FIELDS

SQUARE = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]


def test_geojson_collection_and_multipolygon(spark, tmp_path):
    features = [
        {"type": "Feature", "properties": {"area_id": "1"}, "geometry": {"type": "Polygon", "coordinates": [SQUARE]}},
        {"type": "Feature", "properties": {"area_id": "2"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE], [SQUARE, SQUARE]]}},
    ]
    path = str(tmp_path / "c.json")
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": features}, f)
    rows = {r["id"]: r["n"] for r in Rd.read_geojson(spark, path, collection=True).select(
        F.col("properties")["area_id"].alias("id"), F.size("rings").alias("n")).collect()}
    assert rows == {"1": 1, "2": 3}


def test_missing_records_file(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert Rd.read_json_records(spark, str(tmp_path / "none"), schema).count() == 0
    with pytest.raises(FileNotFoundError):
        Rd.read_json_records(spark, str(tmp_path / "none"))


def _document(n, short=False):
    days = [f"2024-01-{d:02d}" for d in range(1, n + 1)]
    return {"latitude": 1.0, "longitude": 2.0,
            "daily": {"time": days, **{k: [0.5] * (n - short) for k in DAILY_FIELDS}}}


def test_columnar_documents_are_refused(spark, tmp_path):
    def write(name, *docs):
        path = tmp_path / name
        path.write_text("\n".join(map(json.dumps, docs)))
        return str(path)

    good = write("good.json", _document(3), _document(3))
    assert Rd.read_columnar_daily(spark, good, 3).count() == 6
    for name, doc, reason in (("short", _document(3, short=True), "unequal lengths"), ("days", _document(2), "day count"),
                              ("none", _document(0), "no days")):
        path = write(f"{name}.json", _document(3), doc)
        assert [r["reason"] for r in Rd.columnar_violations(spark, path, 3).collect()] == [reason]
        with pytest.raises(ValueError, match=reason):
            Rd.read_columnar_daily(spark, path, 3)


def test_feature_collection_read_by_several_tasks(spark, tmp_path):
    """Braces, quotes and escapes in strings, members that are no features, any key order and layout, cut anywhere."""
    import random
    rnd = random.Random(1)
    odd = ["}", "{", '"', "\\", '\\"', "a{b}c", 'x"}', "\n", "é😀", "\\}", "[{", "", "Feature", '{"type":"Feature"}']
    features = []
    for i in range(300):
        p = {"area_id": str(i), "note": "".join(rnd.choice(odd) for _ in range(rnd.randrange(6))), rnd.choice(["k}", "k"]): rnd.choice(["v", None])}
        f = [("type", "Feature"), ("properties", p), ("geometry", {"type": "Polygon", "coordinates": [SQUARE] * rnd.randint(1, 3)})]
        rnd.shuffle(f)
        features.append(dict(f))
    head = {"type": "FeatureCollection", "name": 'a"}{', "crs": {"type": "name", "properties": {"name": "x}"}}}
    for k, layout in enumerate(({"separators": (",", ":")}, {"indent": 1}, {"ensure_ascii": False})):
        path = tmp_path / f"c{k}"
        path.mkdir()
        for name, own in (("a.json", features), ("b.json", features[:3]), ("c.json", [])):
            (path / name).write_text(json.dumps(head | {"features": own, "tail": {"a": {}}}, **layout), encoding="utf-8")
        for size in ("777", "128m"):
            before = spark.conf.get("spark.sql.files.maxPartitionBytes")
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            try:
                tasks = spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions()
                got = Rd.split_features(spark, str(path)).collect()
                rows = Rd.read_geojson(spark, str(path), collection=True).collect()
            finally:
                spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            assert tasks > 50 or size == "128m"
            for name, own in (("a.json", features), ("b.json", features[:3]), ("c.json", [])):
                mine = [json.loads(r.feature) for r in sorted((r for r in got if r.file.endswith(name)), key=lambda r: r["at"])]
                assert mine == [head["crs"], *own, {"a": {}}]
            whole = spark.read.schema(Rd._COLLECTION).option("multiLine", True).json(str(path)).select(F.explode("features").alias("f"))
            want = sorted((sorted(r.f.properties.items(), key=str) for r in whole.collect()), key=str)
            assert sorted((sorted(r.properties.items(), key=str) for r in rows), key=str) == want
            assert sorted(len(r.rings) for r in rows) == sorted(len(f["geometry"]["coordinates"]) for f in [*features, *features[:3]])


def test_feature_collection_round_trip(spark, tmp_path):
    from hoodcast.plans.q_geo import ringed_shapes
    shapes = ringed_shapes(spark, "/root/testdata/sf0.001")
    Rd.write_feature_collection(shapes, str(tmp_path / "d"), ["nbhd_id"], "nbhd_id")
    back = Rd.read_geojson(spark, str(tmp_path / "d"), collection=True).select(F.col("properties")["nbhd_id"].cast("int").alias("nbhd_id"), "rings")
    assert back.exceptAll(shapes).isEmpty() and back.count() == shapes.count()
