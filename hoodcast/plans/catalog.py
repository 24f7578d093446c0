"""Query catalogue: one entry per operator family of the blueprint, each a
``(spark, sf_dir) -> DataFrame`` callable over the driver's tables, most with
an equivalent DuckDB oracle query.

Column names are identical on both sides; results are compared as
order-insensitive multisets, so no query sorts unless the order is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from hoodcast.plans import (q_panel, q_features, q_geo, q_surge, q_eval,  # noqa: F401
                                q_quality, q_reports, q_sources, q_models, q_weather)
