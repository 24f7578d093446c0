"""Queries of this subpackage: ``opN_<name>`` over its whole table, and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hoodcast.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


#: Rows of text that one Arrow batch carries: a few MB on either side of the worker's pipe.
BATCH_ROWS = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (Spark distributes the archive),
    and, unless the session has its own, a batch size fit for rows of text."""
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as Spark reads it: no local file access, no re-dealing."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    from hoodcast.llm import byte_bpe, chat_format, decontaminate, filter_audit, jaccard_join, language_id, line_dedup, packing, quality_classifier, quality_rules  # noqa: F401
    from hoodcast.llm import spelling_variants, substring_dedup, warc  # noqa: F401
