"""Incremental state (A13): a table partitioned by period, into which loads are merged.

A load rewrites only the periods that it touches (dynamic partition overwrite); the files of
all others stay. A manifest beside the table lists the loads by id with their fingerprint, so that a repeated load is
recognised and does nothing, and an id used again for other rows is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoodcast.operators import quality as Q
from hoodcast.session import cut_lineage
from hoodcast.sources import readers as Rd

PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
_MANIFEST = "load_id string, fingerprint string, rows long, periods array<string>, merged_at timestamp"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The loads merged so far: id, fingerprint, rows, periods, time."""
    where = f"{path}-manifest"
    return spark.read.schema(_MANIFEST).parquet(where) if Rd.exists(spark, where) else spark.createDataFrame([], _MANIFEST)


def fingerprint(df: DataFrame) -> dict:
    """Rows and an order-independent digest of all their values."""
    cols = [F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]
    value = F.xxhash64(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)]), {"ignoreNullFields": "false"}))
    r = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(value.cast("decimal(38,0)")), F.lit(0)).alias("digest")).first()
    return {"rows": r.rows, "fingerprint": f"{r.rows}-{r.digest}"}


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state without its period column, or None."""
    return spark.read.parquet(path).drop("_period") if Rd.exists(spark, path) else None


def merge_load(batch: DataFrame, path: str, load_id: str, keys, date_col: str = "date", seq: str = "load_seq",
               period: str = "month", grid: DataFrame | None = None) -> dict:
    """Merge ``batch`` into the state at ``path``, last ``seq`` per key wins: ``{status, rows, periods}``.

    ``status`` is ``merged``, ``repeated`` (this load is in the manifest: nothing is written) or ``replaced`` (the
    state's schema differs from the batch's: it starts anew, as the reference's schema gate has it). A batch with a
    null date, with a key off ``grid`` or with a key twice in one load is refused before anything is
    written. The merged periods are written to the stage folder first, since a table cannot be
    read and overwritten in one go; should the job end between the table and the manifest, merging again gives the same.
    """
    spark, keys = batch.sparkSession, list(keys)
    batch = cut_lineage(batch)
    found = fingerprint(batch)
    known = manifest(spark, path).where(F.col("load_id") == load_id).select("fingerprint").first()
    if known is not None:
        if known.fingerprint != found["fingerprint"]:
            raise ValueError(f"load {load_id} was merged before with other rows")
        return {"status": "repeated", "rows": 0, "periods": []}
    Q.require_empty(batch.where(F.col(date_col).isNull()), "batch rows without a date")
    if grid is not None:
        Q.require_empty(batch.select(*keys).distinct().join(grid.select(*keys).distinct(), keys, "left_anti"), "batch keys off the grid")
    Q.require_empty(Q.duplicate_keys(batch, [*keys, seq]), "batch keys")
    own = batch.withColumn("_period", F.date_format(date_col, PERIODS[period]))
    # as many names as the batch has periods
    touched = sorted(r._period for r in own.select("_period").distinct().collect())
    stored = spark.read.parquet(path) if Rd.exists(spark, path) else None
    status = "merged"
    if stored is not None and sorted(stored.drop("_period").dtypes) != sorted(batch.dtypes):
        Rd.remove(spark, path)
        Rd.remove(spark, f"{path}-manifest")
        stored, status = None, "replaced"
    if stored is not None:
        stored = stored.withColumn("_period", F.col("_period").cast("string")).where(F.col("_period").isin(touched))
        own = cut_lineage(Q.incremental_merge(stored, own, keys, seq))
    own.repartition("_period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_period").parquet(path)
    spark.createDataFrame([(load_id, found["fingerprint"], found["rows"], touched)], "load_id string, fingerprint string, rows long, periods array<string>") \
        .withColumn("merged_at", F.current_timestamp()).write.mode("append").parquet(f"{path}-manifest")
    return {"status": status, "rows": found["rows"], "periods": touched}
