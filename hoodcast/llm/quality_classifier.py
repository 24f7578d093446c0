"""Quality classifier: random-indexing word vectors, pooled per document, then a
two-layer numpy network with temperature-calibrated probabilities.

1. Every token has an index vector: a few entries of +1 and -1 at places given by
   its hash. A word's vector is the sum of the index vectors of its neighbours
   over the whole corpus; words share rows of a fixed table by hash. Tasks add up
   their table in numpy, Spark sums the rows.
2. A document is the mean of its tokens' unit vectors, and the mean cosine between
   tokens one and two apart (how much a text repeats itself from word to word).
3. The network learns from at most ``fit_rows`` labelled documents (those with the
   smallest hash of their id), on the driver; a fifth of them sets the temperature.

Edge cases: null and empty texts pool to the zero vector and are scored like any
other; without labels of both kinds every score is the base rate (0.5 without
any). Several labels of one document count as their rounded mean. Repeated rows
give repeated rows; other columns are not read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.registry import query, table
from hoodcast.llm.text import SPACE, Words, slices, word_hashes
from hoodcast.session import ensure_checkpoint_dir

ROWS, DIMS, NONZERO, REACH = 1 << 13, 48, 2, 2
WIDTH = DIMS + REACH
#: Labelled documents that the network is fitted on at most.
FIT_ROWS = 20_000
HIDDEN, EPOCHS, BATCH = 32, 60, 256

#: Byte classes: 0 space, 1 letter (all bytes of multi-byte characters), 2 digit, 3 other.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[SPACE] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2


def tokens(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of one class: letters, digits or other signs; none spans two texts."""
    n = len(data)
    c = np.zeros(n + 1, np.uint8)
    c[:n] = _CLASS[data]
    border = np.ones(n + 1, bool)
    border[1:] = c[1:] != c[:-1]
    border[offsets] = True
    at = np.flatnonzero(border)
    starts, ends = at[:-1], at[1:]
    some = c[starts] > 0
    starts, ends = starts[some], ends[some]
    return Words(starts, ends, np.searchsorted(starts, offsets))


def _row(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(ROWS)).astype(np.int64)


def context_cells(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """ROWS x DIMS sums of the neighbours' index vectors."""
    row, out = _row(h), np.zeros(ROWS * DIMS)
    for k in range(NONZERO):
        bits = h >> np.uint64(20 + 16 * k)
        place = (bits % np.uint64(DIMS)).astype(np.int64)
        sign = np.where(h >> np.uint64(60 + k) & np.uint64(1), 1.0, -1.0)
        for d in range(1, REACH + 1):
            same = doc[d:] == doc[:-d]
            for a, b in ((slice(None, -d), slice(d, None)), (slice(d, None), slice(None, -d))):
                out += np.bincount((row[a] * DIMS + place[b])[same], sign[b][same], ROWS * DIMS)
    return out.reshape(ROWS, DIMS)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((ROWS, DIMS))
    for b in batches:
        for s in slices(b.column("text")):
            t = tokens(s.data, s.offsets)
            if len(t.starts) > 1:
                total += context_cells(word_hashes(s.data, t), t.doc())
    some = np.flatnonzero(np.abs(total).sum(1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), *[pa.array(total[some, k].astype(np.int64)) for k in range(DIMS)]],
        ["row", *[f"v{k}" for k in range(DIMS)]])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit vectors (ROWS x DIMS) learnt from every text; a table of fixed size."""
    parts = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(
        _tables, "row int, " + ", ".join(f"v{k} long" for k in range(DIMS)))
    got = parts.groupBy("row").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(DIMS)]).toArrow()
    out = np.zeros((ROWS, DIMS))
    if got.num_rows:
        out[got.column("row").to_numpy()] = np.stack([got.column(f"v{k}").to_numpy() for k in range(DIMS)], 1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.maximum(norm, 1e-12)).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the mean of the tokens' unit vectors and the mean cosine of tokens 1 to
    REACH apart, as little-endian float32 bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            x = np.zeros((b.num_rows, WIDTH), np.float32)
            for s in slices(b.column("text")):
                t = tokens(s.data, s.offsets)
                row, some, doc = _row(word_hashes(s.data, t)), np.flatnonzero(t.counts), t.doc()
                if not len(some):
                    continue
                cosine = np.zeros((REACH, len(row)), np.float32)  # of a token and the one d before it
                for k in range(DIMS):
                    v = table[row, k]
                    x[s.lo + some, k] = np.add.reduceat(v, t.first[some], dtype=np.float64) / t.counts[some]
                    for d in range(1, REACH + 1):
                        cosine[d - 1, d:] += v[d:] * v[:-d]
                for d in range(1, REACH + 1):
                    cosine[d - 1, d:] *= doc[d:] == doc[:-d]
                    cosine[d - 1, :d] = 0
                    x[s.lo + some, DIMS + d - 1] = np.add.reduceat(cosine[d - 1], t.first[some], dtype=np.float64) \
                        / t.counts[some]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "x"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, f"id {id_type}, x binary").withColumnRenamed("id", id_col)


class Network:
    """x -> tanh hidden layer -> logit / temperature -> probability."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        tune, learn = order[:len(y) // 5], order[len(y) // 5:]
        self.mean, self.scale = x[learn].mean(0), x[learn].std(0) + 1e-6
        p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.p, self.temperature = p, 1.0
        m, v, step = [0 * a for a in p], [0 * a for a in p], 0
        z = self._scaled(x)
        for _ in range(EPOCHS):
            for at in np.array_split(rng.permutation(learn), max(1, len(learn) // BATCH)):
                hid = np.tanh(z[at] @ p[0] + p[1])
                err = (_sigmoid(hid @ p[2] + p[3]) - y[at]) / len(at)
                back = np.outer(err, p[2]) * (1 - hid ** 2)
                grads = [z[at].T @ back + 1e-4 * p[0], back.sum(0), hid.T @ err + 1e-4 * p[2], err.sum(keepdims=True)]
                step += 1
                for k, g in enumerate(grads):
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    p[k] -= 0.005 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        logit, grid = self.logits(x[tune]), np.geomspace(0.25, 8, 61)
        losses = [np.logaddexp(0, np.where(y[tune] > 0, -1, 1) * logit / t).mean() for t in grid] if len(tune) else [0]
        self.temperature = float(grid[int(np.argmin(losses))]) if len(tune) else 1.0

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._scaled(x) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


class Constant:
    def __init__(self, p: float):
        self.p = p

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.p)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, WIDTH).astype(np.float64)


def fit(x: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        fit_rows: int = FIT_ROWS) -> Network | Constant:
    """Fit on the labelled documents of ``x``; ``fit_rows`` bounds what reaches the driver."""
    y = labels.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.round(F.avg(label_col)).alias("y"))
    rows = x.join(y, id_col).orderBy(F.xxhash64(id_col), id_col).limit(fit_rows).select("x", "y").toArrow()
    target = rows.column("y").to_numpy()
    if len(target) < 20 or len(set(target.tolist())) < 2:
        return Constant(float(target.mean()) if len(target) else 0.5)
    return Network(_matrix(rows.column("x")), target)


def score(x: DataFrame, model: Network | Constant, id_col: str = "doc_id") -> DataFrame:
    shared = x.sparkSession.sparkContext.broadcast(model)
    id_type = dict(x.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shared.value(_matrix(b.column("x"))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(p, pa.float64())], ["id", "score"])

    return x.select(F.col(id_col).alias("id"), "x").mapInArrow(run, f"id {id_type}, score double") \
        .withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id", modulus: int = 4, fold: int = 2) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == fold


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = 0.7, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(id, score, predicted) for every row of ``docs``; the pooled vectors are written
    once under the session's checkpoint folder, read for the fit and for the scores."""
    spark = docs.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "quality", uuid.uuid4().hex)
    pooled(docs, word_vectors(docs, text_col), id_col, text_col).write.parquet(path)
    x = spark.read.parquet(path)
    out = score(x, fit(x, labels, id_col, label_col, fit_rows), id_col)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query("op10_quality_classifier")
def op10(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return classify(docs, labels.where(~held_out()).select("doc_id", "quality")).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
