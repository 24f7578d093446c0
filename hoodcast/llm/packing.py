"""Best-fit packing of tokenised documents into fixed-length sequences.

Tokenising and packing are one pass without any exchange: each task keeps a fixed
number of open sequences in a bitset keyed by free space, puts every piece into
the open one it fills best, and closes the fullest when the number is exceeded.
Pieces arrive in small look-ahead blocks, the longest of a block first. Sequence
numbers are ``task << 40 | counter``; a lost task is recomputed whole, and its
pieces refer to no other task's sequences.

Edge cases: a null or empty text is the separator alone; repeated rows are packed
each for itself; a text of any length is tokenised whole and cut into pieces of
``capacity``, the first of which may be shorter; an empty table gives no pieces.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.registry import query, table

CAPACITY = 2048
OPEN = 4096
LOOK_AHEAD = 4096
SEPARATOR = 0


class OpenBins:
    """Best fit over at most ``limit`` open bins. Bit f of ``mask`` is set when some
    open bin has f free places, so the tightest fit is the lowest bit from the
    piece's length on, and the fullest bin is the lowest bit of all."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.mask, self.n_open, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.mask ^= 1 << free
        self.n_open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin number, offset) for a piece of 1 to ``capacity`` tokens."""
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.mask |= 1 << left
            self.n_open += 1
            if self.n_open > self.limit:
                self._take((self.mask & -self.mask).bit_length() - 1)
        return number, self.capacity - free


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def encoder(path: str):
    """``bytes -> ids`` of a byte-level BPE tokenizer file.

    Its vocabulary is run by tiktoken, several times faster than and (see the tests)
    identical to the file's own library, which takes over for a text tiktoken gives up on.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    import public_tokenizers
    fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: bytes) -> np.ndarray:
        s = text.decode("utf-8", "replace")
        try:
            return np.asarray(fast.encode(s, allowed_special="all"), "<u4")
        except BaseException as e:  # noqa: BLE001 - the Rust side panics on some very long runs
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            from tokenizers import Tokenizer
            return np.asarray(Tokenizer.from_file(path).encode(s, add_special_tokens=False).ids, "<u4")
    return encode


def pieces_of(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the remainder first, then full ones."""
    if n <= capacity:
        yield 0, n
        return
    start = n % capacity
    if start:
        yield 0, start
    for at in range(start, n, capacity):
        yield at, capacity


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, open_bins: int = OPEN, look_ahead: int = LOOK_AHEAD,
         separator: int = SEPARATOR) -> DataFrame:
    """(id, piece, start, length, ids, sequence_id, offset) of every piece; ``ids`` are
    little-endian unsigned 32-bit values. ``tokenizer`` is a path every worker can read."""
    tokenizer = tokenizer or default_tokenizer()
    id_type = dict(docs.dtypes)[id_col]
    names = ["id", "piece", "start", "length", "ids", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder(tokenizer), OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            held.sort(key=lambda x: -x[3])
            placed = [bins.place(x[3]) for x in held]
            ids, piece, start, length, tokens = zip(*held)
            out = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(tokens, pa.binary()),
                 pa.array([base | number for number, _ in placed], pa.int64()),
                 pa.array([offset for _, offset in placed], pa.int64())], names)
            held.clear()
            return out

        for b in batches:
            key = b.column("id")
            for i, text in enumerate(b.column("text").to_pylist()):
                tokens = np.append(encode(text), np.array([separator], "<u4")) if text else np.array([separator], "<u4")
                for k, (start, length) in enumerate(pieces_of(len(tokens), capacity)):
                    held.append((key.slice(i, 1), k, start, length, tokens[start:start + length].tobytes()))
                    if len(held) >= look_ahead:
                        yield flush()
        if held:
            yield flush()

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"id {id_type}, piece int, start long, length long, ids binary, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


@query("op2_best_fit_packing")
def op2(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
