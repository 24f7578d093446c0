"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread
as the next one's input.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the
columns of ``documents``. No DuckDB SQL: tokenising and the set-similarity stage
are beyond it, so the tests hold the result against a brute-force version.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoodcast.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from hoodcast.llm.components import staged
from hoodcast.llm.registry import ship, table
from hoodcast.session import ensure_checkpoint_dir

#: The near-duplicate stage takes five words and a similarity of 0.8.
SHINGLE, PERCENT = 5, 80


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.keep_good(docs)


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, and documents of which nothing but such lines is there."""
    ship(spark)
    out = line_dedup.drop_recurring(docs).where("left")
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.char_length("kept")).otherwise(F.col("row.n_chars"))}
    kinds = dict(docs.dtypes)
    return out.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).cast(kinds[c]).alias(c) for c in docs.columns])


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays (one of them, if
    rows share it; documents without an id come last). Rows get a number of their own,
    written with them, so that ids need not be unique."""
    ship(spark)
    path = os.path.join(ensure_checkpoint_dir(spark), "near", uuid.uuid4().hex)
    # the row's own columns stay apart in a struct: no name of theirs can clash
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), whole.alias("doc")), path)
    linked = jaccard_join.link(rows.select("row", F.col("doc.text").alias("text")), "row", n=SHINGLE, percent=PERCENT)
    linked = linked.select("row", "component_id").join(rows.select("row", F.col("doc.doc_id").alias("doc_id")), "row")
    stay = linked.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    stay = staged(stay.select(F.col("first.row").alias("row")), path + "-stay")
    kept = rows.join(stay.hint("merge"), "row", "left_semi")
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, as it is or with other numbers and names, go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, tokenised and packed: pieces with their ids and places."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", _quality),
    ("line_dedup", _lines),
    ("ngram_jaccard_join", _near_duplicates),
    ("benchmark_decontamination", _decontaminate),
    ("best_fit_packing", _pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = os.path.join(ensure_checkpoint_dir(spark), "pipeline", uuid.uuid4().hex, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
