"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training is one pass: each task adds up a (language x bucket) count matrix in
numpy, Spark sums the tasks' cells. The log-probability matrix, whose size is
``languages x 2**bits`` and checked, is broadcast; scoring is a second pass in
sparse batches: a gather per n-gram and a segmented sum per text.

Edge cases: a null text, an empty one or one without any letter is ``und`` with
score 0; so is every text when there is nothing to learn from. Languages that
tie go to the alphabetically first. Repeated rows give repeated rows. Other
input columns are never read.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.registry import query, table
from hoodcast.llm.text import Slice, slices

BITS = 14
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: Cells of the broadcast matrix at most (8 bytes each).
MAX_CELLS = 1 << 24
UNKNOWN = "und"
_GAP = np.uint32(32)


@functools.cache
def _fold() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else a space."""
    top = 0x30000
    out = np.full(top + 1, _GAP, np.uint32)
    for c in range(top):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of a slice's texts, runs of non-letters as one space,
    and the offsets of the texts in them; every text begins and ends with a space."""
    texts = [s.text(i).decode("utf-8", "replace") for i in range(s.hi - s.lo)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    codes = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "replace"), np.uint32)
    fold = _fold()
    c = fold[np.minimum(codes, len(fold) - 1)]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    gap = c == _GAP
    keep = np.ones(len(c), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    keep[offsets[:-1]] = True
    return c[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def grams(c: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams that lie within one text, and the offsets of the texts in them."""
    counts = np.maximum(np.diff(offsets) - n + 1, 0)
    h = np.full(max(len(c) - n + 1, 0), 0x811C9DC5 + n, np.uint32)
    for k in range(n):
        h = (h ^ c[k:len(c) - n + 1 + k]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    if n > 1:  # drop those that run over a text's end
        ok = np.ones(len(h), bool)
        for k in range(1, n):
            at = offsets[1:-1] - k
            ok[at[(at >= 0) & (at < len(h))]] = False
        h = h[ok]
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits), np.concatenate([[0], np.cumsum(counts)])


def _count(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, total, docs = 1 << bits, {}, {}
        for b in batches:
            lang = np.array(b.column("lang").to_pylist(), object)
            for s in slices(b.column("text")):
                own = lang[s.lo:s.hi]
                names = sorted(set(own))
                code = np.searchsorted(names, own) if names else []
                c, offsets = letters(s)
                cells = np.zeros(len(names) * size, np.int64)
                for n in ORDERS:
                    h, at = grams(c, offsets, n, bits)
                    cells += np.bincount(np.repeat(code, np.diff(at)) * size + h, minlength=len(cells))
                for i, name in enumerate(names):
                    total[name] = total.get(name, 0) + cells[i * size:(i + 1) * size]
                    docs[name] = docs.get(name, 0) + int((code == i).sum())
        for name, cells in total.items():
            at = np.flatnonzero(cells)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * (len(at) + 1), pa.string()),
                "bucket": pa.array(np.append(at, -1), pa.int32()),
                "n": pa.array(np.append(cells[at], docs[name]), pa.int64())})
    return run


class Model:
    """Languages (sorted) and ``log_p[language, bucket]``."""

    def __init__(self, langs: list[str], log_prior: np.ndarray, log_p: np.ndarray, bits: int):
        self.langs, self.log_prior, self.log_p, self.bits = langs, log_prior, log_p, bits

    def score(self, c: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the likeliest language and its posterior, per text."""
        total = np.tile(self.log_prior, (len(offsets) - 1, 1))
        for n in ORDERS:
            h, at = grams(c, offsets, n, self.bits)
            some = np.flatnonzero(np.diff(at))
            if len(some):
                for k in range(len(self.langs)):
                    total[some, k] += np.add.reduceat(self.log_p[k][h], at[some], dtype=np.float64)
        best = total.argmax(1)
        return best, 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> Model | None:
    """Learn from every row with a text and a language; None when there is none."""
    known = rows.select(F.col(text_col).cast("binary").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("text is not null and lang is not null")
    cells = known.mapInArrow(_count(bits), "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    n_langs = known.select("lang").distinct().count()
    if n_langs << bits > MAX_CELLS:
        raise ValueError(f"{n_langs} languages x {1 << bits} buckets exceed {MAX_CELLS} cells; lower bits")
    got = cells.toArrow()
    if not got.num_rows:
        return None
    lang = np.array(got.column("lang").to_pylist(), object)
    bucket, n = got.column("bucket").to_numpy(), got.column("n").to_numpy()
    langs = sorted(set(lang))
    row = np.searchsorted(langs, lang)
    counts = np.full((len(langs), 1 << bits), SMOOTHING)
    docs = np.zeros(len(langs))
    docs[row[bucket < 0]] = n[bucket < 0]
    counts[row[bucket >= 0], bucket[bucket >= 0]] += n[bucket >= 0]
    log_p = np.log(counts) - np.log(counts.sum(1, keepdims=True))
    return Model(langs, np.log((docs + 1) / (docs + 1).sum()), log_p.astype(np.float32), bits)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            names, scores = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
            for s in slices(b.column("text")) if m else ():
                c, offsets = letters(s)
                best, p = m.score(c, offsets)
                some = np.add.reduceat(c != _GAP, offsets[:-1]) > 0
                for i in np.flatnonzero(some):
                    names[s.lo + i], scores[s.lo + i] = m.langs[best[i]], p[i]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, f"id {id_type}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id", modulus: int = 5, fold: int = 0) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == fold


@query("op1_language_id")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
