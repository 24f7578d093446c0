"""Model operators L1-L13 on Spark ML.

* weighted boosted trees (``GBTClassifier`` with a weight column playing the
  role of ``scale_pos_weight``), 3-fold isotonic calibration: for each fold a
  model is fit on the other two folds and an ``IsotonicRegression`` maps its
  probabilities to the held-out fold's labels; predictions average the three
  calibrated outputs (L1-L3);
* folds come from a hash of the row key (deterministic, no shuffle, no global
  ordering), which is stratified in expectation;
* features are cleaned in the JVM (NaN/inf/null -> 0, B14) before assembly;
* the no-positives guard (L7) returns a constant-0 scorer and placeholder metrics;
* a fit may be bounded to ``fit_rows`` labelled rows, those with the smallest hash of their
  key; scoring always covers every row. Independent fits run side by side (``fit_many``);
* a fit whose training set one task can hold is one task (``boosting.py``), the folds' fits beside one another;
* above that Spark ML fits over all executors. There a boosted fit is hundreds of trees of several small jobs each, and every
  task carries its input's lineage: fits read checkpointed rows, and the trees' errors are checkpointed every few trees.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoodcast.functions.columns import clean_feature
from hoodcast.operators import boosting
from hoodcast.operators.reports import last_row_per_date
from hoodcast.session import cut_lineage


@dataclass
class TreeParams:
    """Defaults mirror the reference (learning rate .04; 31 leaves ~ depth 5;
    tree count chosen from the training size)."""
    step_size: float = 0.04
    max_depth: int = 5
    min_instances: int = 20
    feature_subset: str = "0.8"
    small_trees: int = 200
    large_trees: int = 400
    small_below: int = 500
    seed: int = 42
    max_iter: int | None = None  # explicit override of the size rule
    fit_rows: int | None = None  # labelled rows that a fit reads at most; None: all

    def trees(self, n_train: int) -> int:
        if self.max_iter is not None:
            return self.max_iter
        return self.small_trees if n_train < self.small_below else self.large_trees


SURGE_PARAMS = TreeParams()
NBHD_PARAMS = TreeParams(max_depth=6, min_instances=30, small_below=10_000)
# L4: legacy surge classifiers (300 trees / 31 leaves; 100 trees / 15 leaves for the recent era)
LEGACY_SURGE_PARAMS = TreeParams(max_iter=300, max_depth=5, step_size=0.05)
LEGACY_RECENT_SURGE_PARAMS = TreeParams(max_iter=100, max_depth=4, step_size=0.05)
# Strict / enhanced comparison (300 trees, balanced classes, no calibration)
COMPARISON_PARAMS = TreeParams(max_iter=300, max_depth=5, step_size=0.05)
# Next-day count regressor
COUNT_PARAMS = TreeParams(max_iter=800, max_depth=6, step_size=0.05)


#: Trees between two checkpoints of a fit's errors; no tree depends on it.
CHECKPOINT_TREES = 5


def fit_many(fits: list[Callable], workers: int = 8) -> list:
    """Results of independent fits, run side by side: their many small jobs then share the cluster."""
    with ThreadPoolExecutor(min(workers, max(1, len(fits)))) as pool:
        return list(pool.map(lambda f: f(), fits))


def bounded(train: DataFrame, keys, fit_rows: int | None) -> DataFrame:
    """At most ``fit_rows`` rows of a training set: those with the smallest key hash."""
    return train if fit_rows is None else train.orderBy(F.xxhash64(*keys), *keys).limit(fit_rows)


def clean_features(df: DataFrame, cols) -> DataFrame:
    """Every feature column present, NaN / inf / null -> 0.0."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"scoring input lacks feature columns {missing}")
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[clean_feature(c).alias(c) for c in cols])


def with_folds(df: DataFrame, keys, k: int = 3, seed: int = 42) -> DataFrame:
    return df.withColumn("_fold", F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(k)).cast("int"))


def balance_weight(df: DataFrame, label: str) -> DataFrame:
    """``scale_pos_weight = neg / max(pos, 1)`` as a per-row weight (a scalar
    subquery over the training rows)."""
    stats = df.select(F.struct(F.sum(F.col(label)).alias("pos"),
                               F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    spw = (stats["n"] - stats["pos"]) / F.greatest(stats["pos"], F.lit(1))
    return df.withColumn("_w", F.when(F.col(label) == 1, spw).otherwise(F.lit(1.0)).cast("double"))


@dataclass
class CalibratedEnsemble:
    features: list
    members: list  # [(PipelineModel (assembler + gbt), IsotonicRegressionModel)]
    constant: float | None = None  # L7 guard: no positives -> constant score

    def predict(self, df: DataFrame, out: str = "proba") -> DataFrame:
        if self.constant is not None:
            return df.withColumn(out, F.lit(float(self.constant)))
        x = clean_features(df, self.features)
        cols = []
        for i, (gbt, iso) in enumerate(self.members):
            p = gbt.transform(x).withColumn(f"_raw{i}", vector_to_array("probability")[1]) \
                .drop("probability", "rawPrediction", "prediction", "_vec")
            p = iso.setFeaturesCol(f"_raw{i}").setPredictionCol(f"_cal{i}").transform(p) if iso is not None \
                else p.withColumn(f"_cal{i}", F.col(f"_raw{i}"))
            x = p
            cols.append(F.col(f"_cal{i}"))
        avg = sum(cols[1:], cols[0]) / len(cols)
        drop = [f"_raw{i}" for i in range(len(cols))] + [f"_cal{i}" for i in range(len(cols))]
        return x.withColumn(out, avg).drop(*drop)

    def importances(self, spark) -> DataFrame:
        """Mean importance over the fold models, sorted descending."""
        if not self.members:
            return spark.createDataFrame([], "feature string, importance double")
        imp = [0.0] * len(self.features)
        for gbt, _ in self.members:
            v = gbt.stages[-1].featureImportances.toArray()
            imp = [a + b for a, b in zip(imp, v)]
        rows = [(f, float(v) / len(self.members)) for f, v in zip(self.features, imp)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def _weighted(train: DataFrame, features, label: str, keys, params: TreeParams, folds: int) -> tuple[DataFrame, int, int]:
    """(assembled rows with weight and fold, positives, rows): written once, without lineage for every fit."""
    rows = clean_features(bounded(train.where(F.col(label).isNotNull()), keys, params.fit_rows), features)
    rows = with_folds(rows, keys, folds, params.seed)
    rows = VectorAssembler(inputCols=list(features), outputCol="_vec").transform(rows).select("_vec", label, "_fold")
    rows = cut_lineage(rows)
    stats = rows.agg(F.sum(label).alias("pos"), F.count(F.lit(1)).alias("n")).first()
    return balance_weight(rows, label).checkpoint(), int(stats["pos"] or 0), int(stats["n"])


def _classifier(label: str, params: TreeParams, n: int) -> GBTClassifier:
    return GBTClassifier(featuresCol="_vec", labelCol=label, weightCol="_w", maxIter=params.trees(n),
                         stepSize=params.step_size, maxDepth=params.max_depth, minInstancesPerNode=params.min_instances,
                         featureSubsetStrategy=params.feature_subset, subsamplingRate=1.0, seed=params.seed,
                         checkpointInterval=CHECKPOINT_TREES)


def _scorer(features, model) -> PipelineModel:
    return PipelineModel(stages=[VectorAssembler(inputCols=list(features), outputCol="_vec"), model])


def _boosted(x: DataFrame, fits: int, estimator, features, n: int) -> list:
    """Spark ML's fitted models of the fits numbered in ``fit`` (0, 1, ...): each in one task if that can hold the
    training set's ``n`` rows, else by Spark ML over all executors."""
    label, regression = estimator.getLabelCol(), isinstance(estimator, GBTRegressor)
    if n * len(features) > boosting.LOCAL_VALUES:
        return fit_many([lambda f=f: estimator.copy().fit(x.where(F.col("fit") == f).drop("fit")) for f in range(fits)])
    share = estimator.getFeatureSubsetStrategy()
    nodes = boosting.fit_local(
        x.select("fit", vector_to_array("_vec").alias("x"), F.col(label).alias("y"), (F.lit(1.0) if regression else F.col("_w")).alias("w")),
        fits, logistic=not regression, trees=estimator.getMaxIter(), step=estimator.getStepSize(), max_depth=estimator.getMaxDepth(),
        min_instances=estimator.getMinInstancesPerNode(), feature_share=1.0 if share == "all" else float(share),
        seed=estimator.getSeed(), max_bins=estimator.getMaxBins())
    reader = GBTRegressionModel if regression else GBTClassificationModel
    return [boosting.as_model(nodes.where(F.col("fit") == f), estimator, reader, len(features)) for f in range(fits)]


def fit_calibrated(train: DataFrame, features, label: str, keys, params: TreeParams,
                   folds: int = 3) -> CalibratedEnsemble:
    """L1/L2 + L3: per fold a classifier on the other folds and an isotonic map of its scores on the fold."""
    x, pos, n = _weighted(train, features, label, keys, params, folds)
    if pos == 0:
        return CalibratedEnsemble(list(features), [], constant=0.0)
    others = x.withColumn("fit", F.explode(F.array(*[F.lit(f) for f in range(folds)]))).where("fit <> _fold")
    models = _boosted(others.select("fit", "_vec", label, "_w"), folds, _classifier(label, params, n), features, n)

    def member(f: int):
        gbt = models[f]
        raw = gbt.transform(x.where(F.col("_fold") == f)).select(vector_to_array("probability")[1].alias("_raw"), label)
        # equal scores pool into one weighted row: the same fit, and what reaches the driver stays small
        raw = raw.groupBy("_raw").agg(F.avg(label).alias("_y"), F.count(F.lit(1)).cast("double").alias("_n"))
        iso = IsotonicRegression(featuresCol="_raw", labelCol="_y", weightCol="_n", isotonic=True).fit(raw)
        return _scorer(features, gbt), iso

    return CalibratedEnsemble(list(features), [member(f) for f in range(folds)])


def fit_balanced(train: DataFrame, features, label: str, keys, params: TreeParams) -> CalibratedEnsemble:
    """One classifier with balanced classes, not calibrated."""
    x, pos, n = _weighted(train, features, label, keys, params, 1)
    if pos == 0:
        return CalibratedEnsemble(list(features), [], constant=0.0)
    gbt = _boosted(x.select(F.lit(0).alias("fit"), "_vec", label, "_w"), 1, _classifier(label, params, n), features, n)[0]
    return CalibratedEnsemble(list(features), [(_scorer(features, gbt), None)])


def fit_count_regressor(train: DataFrame, features, label: str, keys, params: TreeParams = COUNT_PARAMS) -> PipelineModel:
    """Next-day count regressor."""
    x = clean_features(bounded(train.where(F.col(label).isNotNull()), keys, params.fit_rows), features)
    x = VectorAssembler(inputCols=list(features), outputCol="_vec").transform(x).select(F.lit(0).alias("fit"), "_vec", label)
    x = cut_lineage(x).checkpoint()
    gbt = GBTRegressor(featuresCol="_vec", labelCol=label, maxIter=params.max_iter, stepSize=params.step_size,
                       maxDepth=params.max_depth, seed=params.seed, checkpointInterval=CHECKPOINT_TREES)
    return _scorer(features, _boosted(x, 1, gbt, features, x.count())[0])


def blend(p_col: str, p_ksi: str, w_col: float = 0.6, w_ksi: float = 0.4):
    """Combined risk score."""
    return F.col(p_col) * w_col + F.col(p_ksi) * w_ksi


def label_from_proba(p: str, threshold: float = 0.5):
    """``p >= 0.5``; null stays null."""
    return F.when(F.col(p).isNotNull(), (F.col(p) >= threshold).cast("int"))


def save(model: CalibratedEnsemble, path: str) -> None:
    """Every member under ``path``, in Spark's own model format."""
    for i, (gbt, iso) in enumerate(model.members):
        gbt.write().overwrite().save(f"{path}/gbt{i}")
        if iso is not None:
            iso.write().overwrite().save(f"{path}/iso{i}")


def load(path: str, features, members: int, calibrated: bool = True, constant: float | None = None) -> CalibratedEnsemble:
    return CalibratedEnsemble(list(features), [
        (PipelineModel.load(f"{path}/gbt{i}"), IsotonicRegressionModel.load(f"{path}/iso{i}") if calibrated else None)
        for i in range(members)], constant)


def score_city(features: DataFrame, model: CalibratedEnsemble, created_at: str, version: str,
               threshold: float = 0.5) -> DataFrame:
    """L10-L13, city: the last area's row of every date is scored; T+2 is the next date's T+1 (null
    at the end). Eight columns, one row per date."""
    city = last_row_per_date(features, "nbhd_id", [c for c in features.columns if c not in ("date", "nbhd_id")])
    w = Window.orderBy("date")  # one row per day
    s = model.predict(city, "surge_proba_t1").select("date", "surge_proba_t1")
    s = s.withColumn("surge_proba_t2", F.lead("surge_proba_t1", 1).over(w))
    return s.select("date", "surge_proba_t1", label_from_proba("surge_proba_t1", threshold).alias("surge_label_t1"),
                    F.lit(threshold).alias("threshold"), "surge_proba_t2",
                    label_from_proba("surge_proba_t2", threshold).alias("surge_label_t2"),
                    F.lit(created_at).alias("created_at"), F.lit(version).alias("model_version"))


def score_areas(features: DataFrame, city: DataFrame, model: CalibratedEnsemble, created_at: str, version: str,
                w_col: float = 0.6, w_ksi: float = 0.4) -> DataFrame:
    """L8, L10-L13, areas: every feature row, with the city's probabilities as features; T+2 is the
    area's next row's T+1; KSI is not scored (0). Fourteen columns."""
    f = features.drop("surge_proba_t1", "surge_proba_t2") \
        .join(city.select("date", "surge_proba_t1", "surge_proba_t2"), "date", "left")
    targets = [c if c in f.columns else F.lit(None).cast("int").alias(c)
               for h in (1, 2) for c in (f"target_collision_t{h}", f"target_ksi_t{h}")]
    s = model.predict(f, "proba_collision_t1").select("date", "nbhd_id", "proba_collision_t1", *targets)
    w = Window.partitionBy("nbhd_id").orderBy("date")
    s = s.withColumn("proba_collision_t2", F.lead("proba_collision_t1", 1).over(w)) \
        .withColumn("proba_ksi_t1", F.lit(0.0)).withColumn("proba_ksi_t2", F.lit(0.0))
    out = ["date", "nbhd_id"]
    for h in (1, 2):
        out += [f"target_collision_t{h}", f"target_ksi_t{h}", f"proba_collision_t{h}", f"proba_ksi_t{h}",
                blend(f"proba_collision_t{h}", f"proba_ksi_t{h}", w_col, w_ksi).alias(f"risk_score_t{h}")]
    return s.select(*out, F.lit(created_at).alias("created_at"), F.lit(version).alias("model_version"))
