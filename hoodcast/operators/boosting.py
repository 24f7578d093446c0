"""Boosted trees of a training set that one task holds.

Spark ML grows a tree by a few jobs for each of its levels; hundreds of trees on a small table are then
thousands of jobs, and nearly all of their time is the jobs' own. Here every fit is one task that
holds its rows, and fits run beside one another. The trees are Spark ML's: at most 32 bins a feature cut at the
same quantiles (of all rows, Spark ML takes them from a sample above 10,000), variance gain, at least
``min_instances`` rows a child, the first tree on the label with weight 1, later ones on the loss's
negative gradient with the step size as weight. They are returned as the rows in which Spark ML saves a
tree and are read back as its own model: scores, importances, saving and loading are Spark ML's.
A training set above ``LOCAL_VALUES`` is fitted by Spark ML over all executors (``models.py``).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.session import cut_lineage, ship_package, stage_folder

#: Values (rows x features) up to which a fit is one task's: 128 MB of doubles beside 16 MB of bins.
LOCAL_VALUES = 16_000_000
EPSILON = 2.0 ** -52
NODES = "fit int, tree int, id int, prediction double, impurity double, weight double, total double, squares double, rows bigint, " \
        "gain double, left int, right int, feature int, threshold double"


def cut_points(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Thresholds between at most ``most`` bins of about equal weight (all midpoints if there are few values)."""
    distinct, at = np.unique(values, return_inverse=True)
    mid = (distinct[:-1] + distinct[1:]) / 2
    if len(mid) < most:
        return mid
    total = np.cumsum(np.bincount(at, weights))
    half = (total[:-1] + total[1:]) / 2
    stride, i, cuts = total[-1] / most, 0, []
    target = stride
    while (i := max(i, int(np.searchsorted(half, target, "right")))) < len(mid):
        cuts.append(mid[i])
        target, i = target + stride, i + 1
    return np.array(cuts)


class Bins:
    """A training set's features as numbers of bins. Columns that are constant are left out; columns with the same
    bins in every row (a sum and its mean) have the same histograms and are counted once."""

    def __init__(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, max_bins: int):
        self.cuts = [cut_points(x[:, f], w, min(max_bins, len(y))) for f in range(x.shape[1])]
        columns = [np.searchsorted(c, x[:, f]).astype(np.uint8) for f, c in enumerate(self.cuts)]
        groups: dict[bytes, list[int]] = {}
        for f, column in enumerate(columns):
            if len(self.cuts[f]):
                groups.setdefault(hashlib.sha256(column).digest(), []).append(f)
        self.members = [*groups.values()]
        self.order = np.array([f for g in self.members for f in g], int)
        self.starts = np.cumsum([0, *map(len, self.members)])[:-1]
        self.width = max((len(c) for c in self.cuts), default=0) + 1
        bins = np.array([columns[g[0]] for g in self.members], np.uint8).reshape(len(self.members), len(y))
        self.rows = np.lexsort((y, *bins))  # sums, and so trees, do not depend on the order in which rows arrive
        self.bins = np.ascontiguousarray(bins[:, self.rows])

    def histograms(self, rows, slot, k: int, *values) -> list[np.ndarray]:
        """Rows, and sums of each of ``values``, by (slot, column, bin)."""
        out = [np.empty((k, len(self.bins), self.width)) for _ in range(1 + len(values))]
        base, whole = slot * self.width, len(rows) == self.bins.shape[1]
        for g, column in enumerate(self.bins):
            i = base + (column if whole else column.take(rows))
            for h, v in zip(out, (None, *values)):
                h[:, g] = np.bincount(i, v, k * self.width).reshape(k, self.width)
        return out


def _best_splits(hists, allowed, min_instances: int):
    """Per node (gain, column, bin) of the split with the largest gain of variance, -inf if there is none."""
    (left_n, left_s), left_w = (h.cumsum(2) for h in hists[:2]), (hists[2] if len(hists) > 2 else hists[0]).cumsum(2)
    n, s, w = (x[:, :, -1:] for x in (left_n, left_s, left_w))
    left_n, left_s, left_w = (x[:, :, :-1] for x in (left_n, left_s, left_w))
    right_w = w - left_w
    ok = (left_n >= min_instances) & (n - left_n >= min_instances) & (left_w > 0) & (right_w > 0)
    if allowed is not None:
        ok &= allowed[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left_s ** 2 / left_w + (s - left_s) ** 2 / right_w - s ** 2 / w) / w
    gain = np.where(ok, gain, -np.inf).reshape(len(ok), -1)
    best = gain.argmax(1)
    return gain[np.arange(len(ok)), best], best // ok.shape[2], best % ok.shape[2]


def grow_tree(b: Bins, y, w, weighted: bool, max_depth: int, min_instances: int, features_a_node: int, rng) -> tuple[list, np.ndarray]:
    """One regression tree, level by level: (its nodes' columns, the prediction of every row). Of two children the
    smaller is counted; the larger has what is left of their parent."""
    rows, slot, ids, made = np.arange(len(y)), np.zeros(len(y), np.int64), np.zeros(1, int), 1
    out, predicted, above = [], np.empty(len(y)), None
    for level in range(max_depth + 1):
        k, wt, t = len(ids), w[rows], y[rows]
        wr = wt * t
        n, weight, total, squares = np.bincount(slot, minlength=k), *(np.bincount(slot, v, k) for v in (wt, wr, wr * t))
        some = weight > 0
        mean = np.divide(total, weight, out=np.zeros(k), where=some)
        impurity = np.divide(squares - total * mean, weight, out=np.zeros(k), where=some)
        gain, feature, cut = np.full(k, -1.0), np.full(k, -1), np.full(k, -1)
        free = some & (np.abs(impurity) >= EPSILON) & (n >= 2 * min_instances) & (level < max_depth) & (len(b.bins) > 0)
        if free.any():
            values = (wr, wt) if weighted else (wr,)
            if level == 0:
                hists = b.histograms(rows, slot, 1, *values)
            else:
                pairs = np.flatnonzero(free.reshape(-1, 2).any(1))
                small = 2 * pairs + (n[2 * pairs + 1] < n[2 * pairs])
                to = np.full(k, -1)
                to[small] = np.arange(len(pairs))
                mine = to[slot] >= 0
                counted = b.histograms(rows[mine], to[slot[mine]], len(pairs), *(v[mine] for v in values))
                hists = []
                for h, parent in zip(counted, above):
                    both = np.empty((k, *h.shape[1:]))
                    both[small], both[small ^ 1] = h, parent[pairs] - h
                    hists.append(both[free])
                for h in hists[1:]:
                    h[hists[0] == 0] = 0.0  # no rows, no remainder of rounding
            allowed = columns = None
            if features_a_node < len(b.cuts):
                allowed = rng.random((len(hists[0]), len(b.cuts))).argsort(1) < features_a_node
                columns = np.logical_or.reduceat(allowed[:, b.order], b.starts, 1)
            best, column, at_bin = _best_splits(hists, columns, min_instances)
            good = np.flatnonzero(best > 0)
            at, above = np.flatnonzero(free)[good], [h[good] for h in hists]
            gain[at], cut[at] = best[good], at_bin[good]
            feature[at] = [next(f for f in b.members[column[i]] if allowed is None or allowed[i, f]) for i in good]
            where = np.full(k, -1)
            where[at] = column[good]
        split = feature >= 0
        left = np.full(k, -1)
        left[split] = made + 2 * np.arange(split.sum())
        threshold = np.array([b.cuts[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut)])
        out.append((ids, mean, impurity, weight, total, squares, n, gain, left, np.where(split, left + 1, -1), feature, threshold))
        done = ~split[slot]
        predicted[rows[done]] = mean[slot[done]]
        if not split.any():
            break
        made += 2 * int(split.sum())
        rows, slot = rows[~done], slot[~done]
        slot = 2 * (np.cumsum(split) - 1)[slot] + (b.bins[where[slot], rows] > cut[slot])
        ids = np.stack([left[split], left[split] + 1], 1).ravel()
    return [np.concatenate(c) for c in zip(*out)], predicted


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, *, logistic: bool, trees: int, step: float, max_depth: int, min_instances: int,
          feature_share: float, seed: int, max_bins: int = 32) -> list:
    """The nodes' columns of all trees, the tree's number first."""
    if logistic and not np.isin(y, (0, 1)).all():
        raise ValueError("labels other than 0 and 1")
    b = Bins(x, y, w, max_bins)
    y, w = (2.0 * y - 1 if logistic else y)[b.rows], w[b.rows]
    weighted, margin, rng, out = bool((w != 1).any()), np.zeros(len(y)), np.random.default_rng(seed), []
    features_a_node = int(np.ceil(feature_share * len(b.cuts)))
    for m in range(trees):
        target = y if m == 0 else 2 * (y - margin) if not logistic else 4 * y / (1 + np.exp(np.minimum(2 * y * margin, 700)))
        nodes, predicted = grow_tree(b, target, w, weighted, max_depth, min_instances, features_a_node, rng)
        margin += predicted if m == 0 else step * predicted
        out.append([np.full(len(nodes[0]), m), *nodes])
    return [np.concatenate(c) for c in zip(*out)]


def _fit_task(batches, options: dict):
    """The nodes of every fit whose rows this task has."""
    batches = [*batches]
    rows = pa.Table.from_batches(batches) if batches else None
    fields = [f.split() for f in NODES.split(", ")]
    types = {"int": pa.int32(), "double": pa.float64(), "bigint": pa.int64()}
    for fit in rows["fit"].unique().to_pylist() if batches else ():
        r = rows.filter(pc.equal(rows["fit"], fit))
        y, w = r["y"].to_numpy(), r["w"].to_numpy()
        x = r["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
        nodes = boost(x, y, w, **options)
        yield from pa.table({c: pa.array(v, types[t]) for (c, t), v in zip(fields, [np.full(len(nodes[0]), fit), *nodes])}).to_batches()


def fit_local(x: DataFrame, fits: int, **options) -> DataFrame:
    """Trees of ``fits`` independent fits, one task each: ``x`` has the fit's number (0, 1, ...), the
    features as an array, label and weight (fit, x, y, w); a row of each node (``NODES``), written once."""
    ship_package(x.sparkSession)
    x = x.select(F.col("fit").cast("int").alias("fit"), "x", F.col("y").cast("double").alias("y"), F.col("w").cast("double").alias("w"))
    nodes = cut_lineage(x.repartitionById(fits, F.col("fit")).mapInArrow(partial(_fit_task, options=options), NODES))
    if nodes.agg(F.countDistinct("fit")).first()[0] < fits:
        raise ValueError("no rows to fit on")
    return nodes


def as_model(nodes: DataFrame, estimator, reader, features: int):
    """Spark ML's model of one fit's nodes: written in the form in which it saves models, and loaded by ``reader``."""
    spark = nodes.sparkSession
    path = f"{stage_folder(spark)}/trees/{uuid.uuid4().hex}"
    trees, step = estimator.getMaxIter(), estimator.getStepSize()

    def stated(kind: str, uid: str, known=None, **more) -> str:
        maps = [{p.name: v for p, v in m.items() if known is None or p.name in known}
                for m in (estimator._paramMap, estimator._defaultParamMap)]
        return json.dumps({"class": kind, "timestamp": 0, "sparkVersion": spark.version, "uid": uid, "paramMap": maps[0],
                           "defaultParamMap": maps[1], **more})

    known = {p.name for p in DecisionTreeRegressor().params}
    kind = f"org.apache.spark.ml.{reader.__module__.rpartition('.')[2]}.{reader.__name__}"
    spark.createDataFrame([(stated(kind, estimator.uid, numFeatures=features, numTrees=trees),)], "value string") \
        .coalesce(1).write.text(f"{path}/metadata")
    tree = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    spark.createDataFrame([(t, stated(tree, f"{estimator.uid}_{t}", known), 1.0 if t == 0 else step) for t in range(trees)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    none = F.array().cast("array<double>")
    split = F.struct(F.col("feature").alias("featureIndex"), F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(none)
                     .alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    nodes.select(F.col("tree").alias("treeID"), F.struct(
        "id", "prediction", "impurity", F.array("weight", "total", "squares").alias("impurityStats"), F.col("rows").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")).alias("nodeData")) \
        .coalesce(1).write.parquet(f"{path}/data")
    return reader.load(path)
