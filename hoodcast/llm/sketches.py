"""Chunks of documents and sparse count-min sketches over them.

A chunk is one row: some documents' ids and their texts, compressed. A sketch counts,
for every cell of one count-min row ``2**bits`` wide, the items (hashes) of a chunk
that fall into it; being sparse it is kept as its sorted non-empty cells, cut into
blocks by their leading bits. ``merged`` adds the sketches block by block and tells
every chunk which of its cells have a total of two or more, and how many binary orders
that is. Totals are never below an item's true count. Blocks, and bits, grow with the
number of items, so that no block and no chunk gathers more than its share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.text import Slice, slices

#: log2 of the cells per item of the corpus: one unique item in 256 is passed on for nothing.
CELL_BITS = 8
#: Entries that one block is to hold.
BLOCK_ENTRIES = 1 << 21
#: Stands for a null id: after all others.
LAST = (1 << 63) - 1


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as compressed byte planes of their differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def pack(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def unpack_sorted(blob: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(blob, dtype), dtype=dtype)


def write_chunks(docs: DataFrame, path: str, count: Callable[[Slice], tuple[int, dict]], extra: str = "",
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as chunks, each in the order of ids, and read them back. ``count`` gives the number
    of items of a slice of texts and further columns (``extra``: their schema)."""
    names = ["chunk", "ids", "lengths", "texts", "n_items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in batches:
            ids = [LAST if x is None else x for x in b.column("id").to_pylist()]
            for s in slices(b.column("text")):
                own = ids[s.lo:s.hi]
                order = sorted(range(len(own)), key=own.__getitem__)
                texts = [s.text(i) for i in order]
                lengths = [len(t) for t in texts]
                whole = b"".join(texts)
                n, more = count(Slice(0, len(texts), np.frombuffer(whole, np.uint8),
                                      np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([[own[i] for i in order]], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int32())), pa.array([squeeze.compress(whole)], pa.binary()),
                    pa.array([n], pa.int64()), *[pa.array([v]) for v in more.values()]], [*names, *more])
                number += 1

    docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, "chunk long, ids array<long>, lengths array<int>, texts binary, n_items long" + extra).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def open_chunk(lengths, texts: bytes) -> Slice:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))]).astype(np.int64)
    return Slice(0, len(offsets) - 1, data, offsets)


def widths(chunks: DataFrame, cell_bits: int = CELL_BITS, block_entries: int = BLOCK_ENTRIES) -> tuple[int, int]:
    """(bits of the sketch, bits that name a block) for the items of these chunks."""
    total = chunks.agg(F.sum("n_items")).first()[0] or 0
    partitions = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_bits = max(2 * partitions - 1, total // block_entries).bit_length()
    return max(min(total.bit_length() + cell_bits, block_bits + 32), block_bits + 8), block_bits


def by_block(sorted_hashes: np.ndarray, block_bits: int) -> Iterator[tuple[int, slice]]:
    block = (sorted_hashes >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else \
        np.zeros(len(sorted_hashes), np.int64)
    edges = np.flatnonzero(np.diff(block, prepend=-1))
    for lo, hi in zip(edges, np.append(edges[1:], len(block))):
        yield int(block[lo]), slice(lo, hi)


def local(hashes: np.ndarray, bits: int, block_bits: int) -> np.ndarray:
    """A hash's cell within its block."""
    return ((hashes << np.uint64(block_bits)) >> np.uint64(64 - bits + block_bits)).astype(np.uint32)


def merged(chunks: DataFrame, items: Callable[[Slice], np.ndarray], bits: int, block_bits: int) -> DataFrame:
    """(chunk, block, cells, ranks): the chunk's cells with a total of two or more, and the totals'
    bit lengths less one (two or three: 1, four to seven: 2, ...)."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, lengths, texts in zip(*(b.column(c).to_pylist() for c in ("chunk", "lengths", "texts"))):
                h = np.sort(items(open_chunk(lengths, texts)))
                blocks, cells, counts = [], [], []
                for block, part in by_block(h, block_bits):
                    cell, count = np.unique(local(h[part], bits, block_bits), return_counts=True)
                    blocks.append(block)
                    cells.append(pack_sorted(cell))
                    counts.append(pack(np.minimum(count, 0xFFFF).astype(np.uint16)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks, pa.int32()), pa.array([chunk] * len(blocks), pa.int64()),
                     pa.array(cells, pa.binary()), pa.array(counts, pa.binary())], ["block", "chunk", "cells", "counts"])

    return chunks.select("chunk", "lengths", "texts") \
        .mapInArrow(sketch, "block int, chunk long, cells binary, counts binary") \
        .groupBy("block").applyInPandas(_merge, "chunk long, block int, cells binary, ranks binary")


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """Add up one block's sketches."""
    parts = [unpack_sorted(x, np.uint32) for x in group["cells"]]
    cell = np.concatenate(parts)
    count = np.concatenate([unpack(x, np.uint16) for x in group["counts"]]).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    c = cell[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    total = np.add.reduceat(count[order], first)
    rank = np.empty(len(cell), np.uint8)
    rank[order] = np.repeat(np.frexp(total.astype(np.float64))[1] - 1, np.diff(np.append(first, len(c))))
    out = []
    edges = np.cumsum([len(p) for p in parts])[:-1]
    for chunk, block, p, r in zip(group["chunk"], group["block"], parts, np.split(rank, edges)):
        own = r > 0
        if own.any():
            out.append((chunk, block, pack_sorted(p[own]), pack(r[own])))
    return pd.DataFrame(out, columns=["chunk", "block", "cells", "ranks"])


class Told:
    """What ``merged`` says about one chunk's cells."""

    def __init__(self, told: pd.DataFrame, bits: int, block_bits: int):
        told = told.sort_values("block")  # blocks in ascending order: the whole is sorted
        shift = np.uint64(bits - block_bits)
        self.bits = bits
        self.cells = np.concatenate([np.zeros(0, np.uint64), *[
            (np.uint64(b) << shift) + unpack_sorted(c, np.uint32).astype(np.uint64)
            for b, c in zip(told["block"], told["cells"])]])
        self.ranks = np.concatenate([np.zeros(0, np.uint8), *[unpack(r, np.uint8) for r in told["ranks"]]])

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """0 for items that occur once; else their cell's rank."""
        if not len(self.cells):
            return np.zeros(len(hashes), np.uint8)
        own = hashes >> np.uint64(64 - self.bits)
        place = np.minimum(np.searchsorted(self.cells, own), len(self.cells) - 1)
        return np.where(self.cells[place] == own, self.ranks[place], 0).astype(np.uint8)
