"""A fixed-size set of bits over 64-bit keys, built by all tasks and broadcast.

It only saves work: a key in the set always passes, a few others do too, and
what passes is joined exactly afterwards. Its size (``2**bits`` bits) is a
parameter and does not grow with the data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.text import mix


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys.astype(np.int64).view(np.uint64) + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.int64)


def build(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bytes of the set of the non-null values of ``column`` (long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << bits >> 3, np.uint8)
        for b in batches:
            at = _place(b.column(0).to_numpy(), bits)
            np.bitwise_or.at(own, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(own[some].astype(np.int32))], ["at", "b"])

    got = keys.where(F.col(column).isNotNull()).select(F.col(column).cast("long")).mapInArrow(run, "at int, b int") \
        .groupBy("at").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << bits >> 3, np.uint8)
    out[got.column("at").to_numpy()] = got.column("b").to_numpy()
    return out


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _place(keys, int(len(filter_) * 8 - 1).bit_length())
    return (filter_[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
