"""Benchmark decontamination by template canonicalisation.

Words (outer punctuation removed, lower case) become template tokens: numbers
``<num>``, units after a number ``<unit>``, capitalised words inside a sentence
``<name>``, everything else itself. Windows of template tokens of the benchmark
are hash-joined with those of the documents, so that a question also matches when
its numbers, names and units were exchanged. A match counts when, along one
alignment, the placeholders' values are consistent: one value of the item always
stands for one value of the document, and two names or units never for the same.
Where the windows of an alignment contradict each other, those with the item's own values
count, and with them the others that agree with them and with one another; if no window has
the item's own values, none counts.

A (document, item) pair is contaminated when consistent windows of one alignment
cover ``coverage`` of the item's tokens and at least ``min_tokens`` of them (all of
a shorter item's).

Every text is read whole; a filter of fixed size over the benchmark's window hashes
lets only matching windows (and a few others, which the join then drops) leave a task.

Edge cases: null or wordless documents match nothing; items of fewer than
``min_literals`` plain words in every window cannot be told from chance and match
nothing; rows sharing a document id count as one document (null ids too); repeated
items with one id as one item; empty tables give an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm import bitfilter
from hoodcast.llm.components import staged
from hoodcast.llm.registry import query, table
from hoodcast.llm.text import Words, lower_ascii, slices, window_hashes, window_starts, word_hashes, words
from hoodcast.session import ensure_checkpoint_dir

WINDOW, MIN_LITERALS, COVERAGE, MIN_TOKENS, FILTER_BITS = 8, 5, 0.5, 12, 26

#: Units, lower case (fixed values).
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "meter", "meters",
    "metre", "metres", "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "ton", "tons", "tonne", "tonnes",
    "ounce", "ounces", "oz", "pound", "pounds", "lb", "lbs", "ml", "l", "liter", "liters", "litre", "litres", "gallon",
    "gallons", "second", "seconds", "s", "minute", "minutes", "min", "hour", "hours", "h", "day", "days", "week", "weeks",
    "month", "months", "year", "years", "percent", "degrees", "degree", "celsius", "dollar", "dollars", "cent", "cents",
    "euro", "euros", "usd", "eur", "mph", "kmh", "kb", "mb", "gb", "volt", "volts", "watt", "watts",
)
NUM, UNIT, NAME = (np.uint64(k) for k in (1, 2, 3))

_CORE = np.zeros(256, bool)
_CORE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".?!:\n"]] = True


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    return np.sort(word_hashes(data, words(data, np.array([0, len(data)]))))


_UNITS = _unit_hashes()


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
    """(template token hashes, value hashes, words): one entry per word that has a
    letter or digit; placeholders' template hashes are NUM, UNIT and NAME."""
    w = words(data, offsets)
    low = lower_ascii(data)
    core = np.flatnonzero(_CORE[data])
    padded = np.append(core, len(data) + 1)
    start = padded[np.searchsorted(core, w.starts)]
    some = start < w.ends
    start, raw_end = start[some], w.ends[some]
    end = core[np.searchsorted(core, raw_end) - 1] + 1 if len(core) else raw_end
    first = np.concatenate([[0], np.cumsum(some)])[w.first]
    t = Words(start, end, first)
    value = word_hashes(low, t)
    number = _DIGIT[data[start]]
    # capitalised: A-Z, or an upper-case Latin letter of two bytes, and no A-Z after it
    # (a word in capitals is not a name)
    byte = lambda k: data[np.minimum(start + k, len(data) - 1)] if len(data) else data[start]
    upper = lambda x: (x >= 65) & (x <= 90)
    latin = (byte(0) == 0xC3) & (byte(1) >= 0x80) & (byte(1) <= 0x9E)
    capital = np.where(latin, ~(upper(byte(2)) & (start + 2 < end)), upper(byte(0)) & ~(upper(byte(1)) & (start + 1 < end)))
    # a sentence begins at a text's first word and after a stop, which lies between two words
    stops = np.cumsum(np.append(0, _STOP[data]))
    opens = np.ones(len(start), bool)
    if len(start) > 1:
        opens[1:] = stops[start[1:]] > stops[end[:-1]]
    opens[first[:-1][np.diff(first) > 0]] = True
    after_number = np.zeros(len(start), bool)
    after_number[1:] = number[:-1]
    after_number[first[:-1][np.diff(first) > 0]] = False
    place = np.minimum(np.searchsorted(_UNITS, value), len(_UNITS) - 1)
    unit = after_number & ~number & (_UNITS[place] == value)
    token = value.copy()
    token[capital & ~opens & ~number & ~unit] = NAME
    token[unit] = UNIT
    token[number] = NUM
    return token, value, t


def template_windows(data: np.ndarray, offsets: np.ndarray, size: int, min_literals: int):
    """(word index, hash) of the windows with enough plain words, and the template's parts."""
    token, value, t = template(data, offsets)
    at = window_starts(t.first, size)
    plain = np.concatenate([[0], np.cumsum(token > NAME)])
    at = at[plain[at + size] - plain[at] >= min(min_literals, size)]
    return at, window_hashes(token, size)[at] if len(at) else np.zeros(0, np.uint64), token, value, t


_SCHEMA = "hash long, id {id}, at int, size int, total int, types binary, slots binary"


def _emit(sizes: tuple[int, ...], min_literals: int, keep=None, whole_only: bool = False):
    """Windows as rows. ``whole_only``: sizes below the largest only for texts of just that
    length (the benchmark's side)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column("text")):
                for size in sizes:
                    at, h, token, value, t = template_windows(s.data, s.offsets, size, min_literals)
                    if keep is not None:
                        good = bitfilter.passes(keep.value, h.view(np.int64))
                        at, h = at[good], h[good]
                    doc = np.searchsorted(t.first, at, "right") - 1
                    if whole_only and size < max(sizes):
                        good = t.counts[doc] == size
                        at, h, doc = at[good], h[good], doc[good]
                    if not len(at):
                        continue
                    span = at[:, None] + np.arange(size)
                    kinds = np.where(token[span] <= NAME, token[span], 0).astype(np.uint8)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(h.view(np.int64)), b.column("id").take(pa.array(s.lo + doc)),
                        pa.array((at - t.first[doc]).astype(np.int32)), pa.array(np.full(len(at), size, np.int32)),
                        pa.array(t.counts[doc].astype(np.int32)),
                        pa.array([k.tobytes() for k in kinds], pa.binary()),
                        pa.array([v.tobytes() for v in value[span]], pa.binary())],
                        ["hash", "id", "at", "size", "total", "types", "slots"])
    return run


class Mapping:
    """Placeholder values of the item and what they stand for (numbers: many to one; others one to one)."""

    def __init__(self):
        self.forward: dict[tuple[int, int], int] = {}
        self.backward: dict[tuple[int, int], int] = {}

    def takes(self, pairs: list[tuple[int, int, int]]) -> bool:
        """Add these (kind, ours, theirs) unless they contradict what is there or each other."""
        forward, backward = {}, {}
        for k, x, y in pairs:
            if self.forward.get((k, x), forward.setdefault((k, x), y)) != y or forward[k, x] != y:
                return False
            if k > NUM and (self.backward.get((k, y), backward.setdefault((k, y), x)) != x or backward[k, y] != x):
                return False
        self.forward |= forward
        self.backward |= backward
        return True


def _pairs(kinds: bytes, ours: bytes, theirs: bytes) -> list[tuple[int, int, int]]:
    values = zip(kinds, np.frombuffer(ours, np.uint64).tolist(), np.frombuffer(theirs, np.uint64).tolist())
    return [(k, x, y) for k, x, y in values if k]


def consistent(types: list[bytes], ours: list[bytes], theirs: list[bytes]) -> np.ndarray:
    """Which of an alignment's windows count: all, if their placeholder values map one to one (numbers:
    to one); else those with equal values and, the pairs of values that most windows have first, those
    that agree with them and each other."""
    windows = [_pairs(*w) for w in zip(types, ours, theirs)]
    if Mapping().takes([p for w in windows for p in w]):
        return np.ones(len(windows), bool)
    same = np.array([a == b for a, b in zip(ours, theirs)])
    if not same.any():
        return same
    mapping = Mapping()
    mapping.takes([p for w, own in zip(windows, same) if own for p in w])
    often = Counter(p for w, own in zip(windows, same) if not own for p in set(w))
    agreed = {p for p, _ in often.most_common() if mapping.takes([p])}
    return np.array([own or agreed.issuperset(w) for w, own in zip(windows, same)])


def _judge(coverage: float, min_tokens: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        best = None
        for shift, g in group.groupby(group["at"] - group["item_at"]):
            g = g.sort_values("item_at")
            total, same = int(g["item_total"].iloc[0]), (g["slots"] == g["item_slots"]).all()
            g = g[consistent(g["types"].tolist(), g["item_slots"].tolist(), g["slots"].tolist())]
            hit = np.zeros(total, bool)
            for at, size in zip(g["item_at"], g["size"]):
                hit[at:at + size] = True
            covered = int(hit.sum())
            if covered >= coverage * total and covered >= min(min_tokens, total):
                found = (covered, bool(same), -int(g["at"].iloc[0]), total)
                best = found if best is None or found > best else best
        if best is None:
            return pd.DataFrame(columns=["id", "item_id", "covered", "total", "start", "exact"])
        return pd.DataFrame([(group["id"].iloc[0], group["item_id"].iloc[0], best[0], best[3], -best[2], best[1])],
                            columns=["id", "item_id", "covered", "total", "start", "exact"])
    return run


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
         min_literals: int = MIN_LITERALS, coverage: float = COVERAGE, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(id, item, covered, total, start, exact) of every contaminated pair: the item's
    tokens covered, its tokens, the word of the document at which the match begins,
    and whether numbers, names and units are the item's own."""
    spark = docs.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "decontaminate", uuid.uuid4().hex)
    id_type, item_type = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    items = benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).cast("binary").alias("text"))
    sizes = tuple(range(min_literals, window + 1))
    theirs = staged(items.mapInArrow(_emit(sizes, min_literals, whole_only=True), _SCHEMA.format(id=item_type))
                    .distinct(), os.path.join(path, "items"))
    # short windows are looked for only if some item is that short: at most window - min_literals sizes more
    used = tuple(sorted(r["size"] for r in theirs.select("size").distinct().collect())) or (window,)
    keep = spark.sparkContext.broadcast(bitfilter.build(theirs.select("hash").distinct(), "hash", FILTER_BITS))
    ours = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")) \
        .where("text is not null").mapInArrow(_emit(used, min_literals, keep), _SCHEMA.format(id=id_type))
    items_ = theirs.select("hash", "size", F.col("id").alias("item_id"), F.col("at").alias("item_at"),
                           F.col("total").alias("item_total"), F.col("slots").alias("item_slots"),
                           F.col("types").alias("item_types"))
    hits = ours.drop("total").join(items_, ["hash", "size"]).where("types = item_types").drop("item_types").distinct()
    return hits.groupBy("id", "item_id").applyInPandas(
        _judge(coverage, min_tokens),
        f"id {id_type}, item_id {item_type}, covered int, total int, start int, exact boolean") \
        .withColumnsRenamed({"id": id_col, "item_id": item_col})


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text matches no item. Judged by text: copies share
    the verdict, ids need not be unique or present."""
    spark = docs.sparkSession
    key = F.sha2(F.col(text_col).cast("binary"), 256)
    texts = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    bad = staged(find(texts, benchmark, id_col="key", text_col="text", **options).select("key").distinct(),
                 os.path.join(ensure_checkpoint_dir(spark), "decontaminate", uuid.uuid4().hex))
    # the row's own columns stay apart in a struct; sort-merge at every size: a broadcast would fit small inputs only
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("key"))
    return rows.join(bad.hint("merge"), "key", "left_anti").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


@query("op3_benchmark_decontamination")
def op3(spark, sf_dir):
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
