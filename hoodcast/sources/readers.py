"""Readers and sinks (A2, A4-A10, A14) over landed files.

Landed payloads are read with explicit schemas (no inference at scale).
GeoJSON is accepted both as a FeatureCollection document, of any size and read by several
tasks (``split_features``), and as one feature per line (GeoJSON text sequences): each
line is parsed independently, in parallel.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoodcast.session import cut_lineage, ensure_checkpoint_dir

_GEOM = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
_FEATURE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", _GEOM),
])
_COLLECTION = T.StructType([T.StructField("type", T.StringType()),
                            T.StructField("features", T.ArrayType(_FEATURE))])
_RING = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def landing_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for landed payloads."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "landing", f"{name}-{uuid.uuid4().hex[:12]}")


def read_geojson(spark: SparkSession, path: str, collection: bool = False) -> DataFrame:
    """A2: features -> ``properties`` (map of text) + ``rings`` in the engine's
    polygon layout. Polygon and MultiPolygon are supported (parts' rings are
    concatenated; the even-odd rule treats disjoint parts correctly)."""
    if collection:
        feats = split_features(spark, path).select(F.from_json("feature", _FEATURE).alias("f")).where("f.type = 'Feature'").select("f.*")
    else:
        feats = spark.read.schema(_FEATURE).json(path)
    g = F.col("geometry")
    coords = F.when(g["type"] == "Polygon", F.from_json(g["coordinates"], _RING)).when(
        g["type"] == "MultiPolygon", F.flatten(F.from_json(g["coordinates"], _MULTI)))
    rings = F.transform(coords, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return feats.select("properties", g["type"].alias("geometry_type"), rings.alias("rings"))


def split_features(spark: SparkSession, path: str) -> DataFrame:
    """``(file, at, feature)``: the objects inside the root object of each JSON document, as text, for a
    FeatureCollection its features (and other members that are objects). ``at`` is their order within the file.

    The text is read by as many tasks as the file has blocks, cut after every ``}``. Whether a piece
    begins inside a string follows from the number of quotes before it, its depth from the braces
    outside strings: two running totals, over the blocks' sums and within each block. Where the depth comes back to one an
    object ends; its pieces are put together again. No task holds more than a block or a feature.
    """
    read = spark.read.option("lineSep", "}").text(path)
    pieces = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("seq"), "value")
    # the text between quotes; an escaped character is neither a quote nor a brace
    parts = F.split(F.regexp_replace("value", r"\\.", ""), '"', -1)
    braces = lambda odd: F.expr(
        f"aggregate(filter(parts, (p, i) -> i % 2 = {odd}), 0, (n, p) -> n + length(p) - length(replace(p, '{{', '')))")
    pieces = pieces.withColumn("parts", parts).select(
        "file", "block", "seq", "value", (F.size("parts") - 1).alias("quotes"), braces(0).alias("open0"), braces(1).alias("open1"))
    pieces = cut_lineage(pieces)
    light = pieces.drop("value")
    light = _before(light, "quotes", "quoted")
    light = light.withColumn("inside", F.col("quoted") % 2 == 1)
    ends_inside = (F.col("quoted") + F.col("quotes")) % 2 == 1
    # a piece ends with "}": outside strings it closes an object
    light = cut_lineage(light.select("file", "block", "seq", "inside", F.when(F.col("inside"), F.col("open1")).otherwise(F.col("open0")).alias("open"),
                                     F.when(ends_inside, 0).otherwise(1).alias("close")).withColumn("step", F.col("open") - F.col("close")))
    light = _before(light, "step", "depth")
    light = light.withColumn("ends", ((F.col("close") == 1) & (F.col("depth") + F.col("step") == 1)).cast("int"))
    light = cut_lineage(_before(light, "ends", "at").where("depth + open >= 2"))
    # the first piece of an object has what comes before it: the rest of a string, the root's own brace, commas, other members
    first = F.col("depth") <= 1
    head = r'^[^{"]*+(?:"(?:[^"\\]++|\\.)*+"[^{"]*+)*+'
    rest = r'^(?:[^"\\]++|\\.)*+"'
    body = F.when(F.col("inside"), F.regexp_replace("value", rest, "")).when(F.col("depth") == 0, F.regexp_replace("value", head + r"\{", "")).otherwise(F.col("value"))
    body = F.when(first, F.regexp_replace(body, head, "")).otherwise(F.col("value"))
    whole = pieces.select("file", "block", "seq", "value").join(light.select("file", "block", "seq", "at", "depth", "inside"), ["file", "block", "seq"])
    whole = whole.groupBy("file", "at").agg(F.sort_array(F.collect_list(F.struct("block", "seq", body.alias("text")))).alias("t"))
    return whole.select("file", "at", F.concat(F.array_join(F.transform("t", lambda t: t["text"]), "}"), F.lit("}")).alias("feature"))


def _before(rows: DataFrame, value: str, out: str) -> DataFrame:
    """The sum of ``value`` over a file's earlier rows: over the blocks before, then within the block."""
    blocks = rows.groupBy("file", "block").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    own = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_base") + F.coalesce(F.sum(value).over(own), F.lit(0))
    return rows.join(blocks, ["file", "block"]).withColumn(out, total).drop("_base")


def feature_json(polys: DataFrame, props) -> Column:
    """A row as a GeoJSON feature."""
    coords = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.create_map(*[x for c in props for x in (F.lit(c), F.col(c).cast("string"))]).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry")))


def write_geojson_lines(polys: DataFrame, path: str, props) -> None:
    """Land polygons as one GeoJSON feature per line."""
    polys.select(feature_json(polys, props).alias("value")).write.mode("overwrite").text(path)


def write_feature_collection(polys: DataFrame, path: str, props, order: str) -> None:
    """Land polygons as one FeatureCollection document, features by ``order`` (a distinct number): one file, hence one task."""
    spark = polys.sparkSession
    body = polys.select(F.col(order).cast("long").alias("k"), feature_json(polys, props).alias("value"))
    first = body.select(F.min("k")).scalar()
    body = body.select("k", F.when(F.col("k") == first, F.col("value")).otherwise(F.concat(F.lit(","), "value")).alias("value"))
    ends = spark.createDataFrame([(None, '{"type": "FeatureCollection", "name": "a{b}", "features": ['), (1 << 62, "]}")], "k long, value string")
    ends.unionByName(body).coalesce(1).sortWithinPartitions(F.col("k").asc_nulls_first()).select("value") \
        .write.mode("overwrite").text(path)


# Columnar daily weather payload names -> engine column names.
DAILY_FIELDS = {
    "temperature_2m_mean": "tavg",
    "temperature_2m_min": "tmin",
    "temperature_2m_max": "tmax",
    "precipitation_sum": "prcp",
    "snowfall_sum": "snow",
    "wind_speed_10m_max": "wspd",
}
_DAILY = T.StructType([
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("daily", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(k, T.ArrayType(T.DoubleType())) for k in DAILY_FIELDS])),
])


def columnar_violations(spark: SparkSession, path: str, expected_days: int | None = None) -> DataFrame:
    """A7 gate: documents without days, with arrays of unequal length, or (given ``expected_days``)
    with another number of days: ``latitude, longitude, n_days, reason``."""
    raw = spark.read.schema(_DAILY).json(path)
    n = F.coalesce(F.size("daily.time"), F.lit(-1))
    unequal = F.lit(False)
    for k in DAILY_FIELDS:
        unequal = unequal | F.coalesce(F.size(f"daily.{k}") != n, F.lit(True))
    reason = F.when(n <= 0, "no days").when(unequal, "unequal lengths")
    if expected_days is not None:
        reason = reason.when(n != expected_days, "day count")
    return raw.select("latitude", "longitude", n.alias("n_days"), reason.alias("reason")).where(F.col("reason").isNotNull())


def read_columnar_daily(spark: SparkSession, path: str, expected_days: int | None = None) -> DataFrame:
    """``{daily: {time: [...], <field>: [...]}}`` documents -> one row per day, renamed to the
    engine's weather columns. Raises when a document fails ``columnar_violations``."""
    bad = columnar_violations(spark, path, expected_days).limit(10).collect()
    if bad:
        raise ValueError(f"columnar documents refused: {bad}")
    zipped = F.arrays_zip(F.col("daily.time").alias("time"),
                          *[F.col(f"daily.{k}").alias(v) for k, v in DAILY_FIELDS.items()])
    rows = spark.read.schema(_DAILY).json(path).select("latitude", "longitude", F.inline(zipped))
    return rows.select(F.to_date("time").alias("date"), "latitude", "longitude", *DAILY_FIELDS.values())


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A4: CSV with header and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json_records(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """JSON records (one per line) from one path or a list of paths; a
    missing path yields an empty frame with ``schema``; without a schema the
    union of keys becomes the columns."""
    paths = [path] if isinstance(path, str) else list(path)
    paths = [p for p in paths if exists(spark, p)]
    if not paths:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(paths)


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or a glob names anything, asked of the file system that Spark reads it from."""
    fs, where = _fs(spark, path)
    return bool(fs.globStatus(where))


def file_stamp(spark: SparkSession, pattern: str) -> str:
    """Names, sizes and times of the files (or folders) that a glob names: another stamp, other contents."""
    fs, where = _fs(spark, pattern)
    return ";".join(sorted(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in fs.globStatus(where)))


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def write_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    """Overwrite, optionally partitioned (e.g. by ``year`` for pruning)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_observed(df: DataFrame, path: str, metrics: dict, partition_by=None) -> dict:
    """Write ``df`` as ``write_parquet`` does and return the aggregates ``metrics`` (name -> column) of its rows, taken in
    the pass that writes them."""
    seen = Observation()
    write_parquet(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), path, partition_by)
    return seen.get


def write_small_csv(df: DataFrame, path: str) -> None:
    """Tiny outputs (metrics, importances) as one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_small_json(df: DataFrame, path: str) -> None:
    """A10: metric records as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def with_provenance(df: DataFrame, source_col: str, source: str, allowed, model_version: str | None = None,
                    created_at: str | None = None) -> DataFrame:
    """Constant provenance columns plus a domain check column."""
    out = df.withColumn(source_col, F.lit(source))
    if model_version is not None:
        out = out.withColumn("model_version", F.lit(model_version))
    if created_at is not None:
        out = out.withColumn("created_at", F.lit(created_at))
    return out.withColumn(f"{source_col}_ok", F.col(source_col).isin(*allowed))
