"""End-to-end jobs (the reference's pipeline stages) as plain functions.

Stage boundaries are written tables (parquet, panel tables partitioned by
``year``), which also cut lineage: a lost executor only recomputes its stage.

    gold      raw inputs -> dense gold panel                         (K1-K10)
    features  gold + adjacency -> feature table                     (K12-K19)
    surge     features -> city roll-up -> threshold -> models        (E5, K22-K24, L1, L3, M1-M4)
    nbhd      features + surge -> collision / KSI models -> metrics  (K25, L2, L3, L7, L8, M1-M6, M9)
    refresh   merge newly landed feature rows                          (A13)
    score     saved models over every feature row                      (L8, L10-L13)

Gates on a stage's input raise before anything is written: unique keys, expected areas, contracts, daily density,
lookups. Those on its result (contract, areas, row counts of joins) are observed in the pass that
writes it; a table that fails is removed again.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hoodcast.config import BASE_LEAKAGE, DEFAULTS, Settings
from hoodcast.operators import evaluate as Ev
from hoodcast.operators import features as Fe
from hoodcast.operators import models as M
from hoodcast.operators import panel as Pn
from hoodcast.operators import quality as Q
from hoodcast.operators import surge as Su
from hoodcast.operators import weather as We
from hoodcast.session import cut_lineage
from hoodcast.sources import readers as Rd


#: Days of a time block: an area's windows are the work of as many tasks as its history has blocks.
BLOCK_DAYS = 1024


def write_gated(df: DataFrame, out: str, name: str, partition_by=None, expected: int | None = None, rows=None) -> DataFrame:
    """Write ``df`` and check it in the same pass: contract (N3), areas (N2), row count (N5; ``rows`` is a number or a
    function called after the write). A table that fails is removed and the job raises."""
    spark = df.sparkSession
    df = Q.coerced(df, name)
    metrics = {"rows": F.count(F.lit(1))} | Q.contract_metrics(name) | (Q.entity_metrics() if expected is not None else {})
    found = Rd.write_observed(df, out, metrics, partition_by)
    try:
        Q.refuse(found, name, expected, rows() if callable(rows) else rows)
    except ValueError:
        Rd.remove(spark, out)
        raise
    return spark.read.parquet(out)


def attach_areas(daily: DataFrame, dim: DataFrame, key: str = "area_id") -> DataFrame:
    """K4: area numbers for daily rows; any row without a match, or an area listed twice, stops the job."""
    text = [x.withColumn(key, F.col(key).cast("string")) for x in (daily, dim)]
    Q.require_lookup(*text, key, key, "areas")
    return Pn.attach_area_id(daily, dim, key)


def expand_weather(panel: DataFrame, cell_weather: DataFrame, area_cells: DataFrame) -> DataFrame:
    """Cell weather onto the panel through the areas' cells. A cell twice a day or an area with two cells
    would multiply rows (D12), a cell without weather would lose an area (N4): each stops the job."""
    Q.require_empty(Q.duplicate_keys(cell_weather, ["date", "coord_key"]), "cell weather key")
    Q.require_empty(Q.duplicate_keys(area_cells, ["nbhd_id"]), "area cell key")
    Q.require_empty(Q.missing_lookup(area_cells, cell_weather, "coord_key", "coord_key"), "area cells without weather")
    return We.replace_weather(panel, We.expand_to_areas(cell_weather, area_cells))


def build_gold(panel: DataFrame, ksi: DataFrame, weather: DataFrame, road: DataFrame, out: str) -> DataFrame:
    """K6 + K8 + K10 with the row-count invariant (N5) and a weather row for every day, written by year. The panel's
    rows and the result's are counted in the one pass that writes it."""
    Q.require_empty(Q.duplicate_keys(weather, ["date"]), "weather key")
    Q.require_empty(Q.set_difference(panel, weather, ["date"]), "days without weather")
    before = Observation()
    gold = Pn.gold(panel.observe(before, F.count(F.lit(1)).alias("rows")), ksi, weather, road)
    return write_gated(gold.withColumn("_year", F.year("date")), out, "gold", ["_year"], rows=lambda: before.get["rows"]).drop("_year")


def build_features(gold: DataFrame, adj: DataFrame, out: str, settings: Settings = DEFAULTS,
                   road_stats: DataFrame | None = None) -> DataFrame:
    """Gates on the input in one pass (unique key, expected areas, contract, one row per day), optional road
    statistics (left join on a unique key, gaps filled with the median), build, gates on the
    result in the pass that writes it, by year."""
    Q.require_panel(gold, "gold", settings.expected_areas)
    if road_stats is not None:
        Q.require_empty(Q.duplicate_keys(road_stats, ["nbhd_id"]), "road statistics key")
        gold = cut_lineage(Fe.with_road_stats(gold, road_stats))
    f = Fe.feature_table(gold, adj, settings, block_days=BLOCK_DAYS)
    f = write_gated(f.withColumn("_year", F.year("date")), out, "features", ["_year"], settings.expected_areas).drop("_year")
    Q.require_empty(Q.duplicate_keys(f, ["date", "nbhd_id"]), "feature key")
    return f


def _targets(settings: Settings) -> set:
    return {f"{p}_t{h}" for h in settings.horizons for p in ("target_collision", "target_ksi", "collisions")}


def train_surge(features: DataFrame, out: str, settings: Settings = DEFAULTS,
                params: M.TreeParams = M.SURGE_PARAMS):
    """Per horizon: E5a roll-up, train-only seasonal threshold, calibrated
    ensemble; predictions merged across horizons (D5) and metric records."""
    spark = features.sparkSession
    daily = Su.city_daily(features)
    preds, metrics = [], []
    for h in settings.horizons:
        lab = Su.surge_labels(daily.select("date", "collisions"), h, settings)
        d = cut_lineage(daily.join(lab, "date"))
        xcols = Su.numeric_columns(d, drop={"city_collisions_future", "y", "threshold"} | _targets(settings))
        split = F.lit(settings.split_date)
        ens = M.fit_calibrated(d.where(F.col("date") < split), xcols, "y", ["date"], params)
        p = cut_lineage(ens.predict(d.where(F.col("date") >= split), f"surge_proba_t{h}").select(
            "date", f"surge_proba_t{h}", F.col("y").alias(f"surge_label_t{h}"), "threshold"))
        metrics.append(Ev.classification_metrics(p, f"surge_proba_t{h}", f"surge_label_t{h}", f"surge_t{h}"))
        preds.append(p if h == settings.horizons[0] else p.drop("threshold"))
        M.save(ens, os.path.join(out, f"surge_model_t{h}"))
    merged = cut_lineage(reduce(lambda a, b: a.join(b, "date", "full"), preds))
    Q.require_empty(Q.duplicate_keys(merged, ["date"]), "surge prediction key")
    Q.require_contract(merged, "surge_predictions")
    Rd.write_parquet(merged, os.path.join(out, "surge_predictions"))
    Rd.write_small_json(reduce(lambda a, b: a.unionByName(b), metrics), os.path.join(out, "surge_metrics"))
    return spark.read.parquet(os.path.join(out, "surge_predictions"))


def train_nbhd(features: DataFrame, surge: DataFrame, out: str, settings: Settings = DEFAULTS,
               params: M.TreeParams = M.NBHD_PARAMS):
    """Per horizon: collision and KSI ensembles (KSI guarded), blended risk,
    classification + ranking metrics, drift; horizons merged (D5)."""
    Q.require_empty(Q.duplicate_keys(surge, ["date"]), "surge prediction key")
    f = cut_lineage(Su.merge_surge_neutral(features, surge, settings))
    Q.require_same_rows(features, f, "surge merge")
    xcols = Su.numeric_columns(f, drop=_targets(settings) | BASE_LEAKAGE)
    split = F.lit(settings.split_date)
    train, test = f.where(F.col("date") < split), f.where(F.col("date") >= split)
    preds, metrics, drift = [], [], []
    for h in settings.horizons:
        ct, kt = f"target_collision_t{h}", f"target_ksi_t{h}"
        m_col, m_ksi = M.fit_many([lambda t=t: M.fit_calibrated(train, xcols, t, ["date", "nbhd_id"], params)
                                   for t in (ct, kt)])
        M.save(m_col, os.path.join(out, f"collision_model_t{h}"))
        p = m_ksi.predict(m_col.predict(test, f"proba_collision_t{h}"), f"proba_ksi_t{h}")
        p = p.withColumn(f"risk_score_t{h}", M.blend(f"proba_collision_t{h}", f"proba_ksi_t{h}",
                                                     settings.blend_collision, settings.blend_ksi))
        p = cut_lineage(p.select("date", "nbhd_id", ct, kt, f"proba_collision_t{h}", f"proba_ksi_t{h}",
                                 f"risk_score_t{h}"))
        metrics.append(Ev.classification_metrics(p, f"proba_collision_t{h}", ct, f"collision_prob_t{h}"))
        drift.append(Ev.drift_check(p, f"risk_score_t{h}", ct, 10, settings.drift_warn)
                     .withColumn("horizon", F.lit(h)))
        preds.append(p)
    merged = cut_lineage(reduce(lambda a, b: a.join(b, ["date", "nbhd_id"], "full"), preds))
    Q.require_empty(Q.duplicate_keys(merged, ["date", "nbhd_id"]), "area prediction key")
    Q.require_contract(merged, "nbhd_predictions")
    Rd.write_parquet(merged.withColumn("_year", F.year("date")), os.path.join(out, "nbhd_predictions"), ["_year"])
    Rd.write_small_json(reduce(lambda a, b: a.unionByName(b), metrics), os.path.join(out, "nbhd_metrics"))
    Rd.write_small_json(reduce(lambda a, b: a.unionByName(b), drift), os.path.join(out, "drift"))
    return merged


def refresh(spark: SparkSession, state: DataFrame, landed: DataFrame, keys=("date", "nbhd_id"),
            out: str | None = None, grid: DataFrame | None = None) -> DataFrame:
    """Daily refresh: merge newly landed rows into the state (last load wins,
    A13); the result is written to a new path, never over its own input."""
    merged = Q.incremental_merge(state, landed, list(keys), grid=grid)
    if out:
        Rd.write_parquet(merged, out)
        return spark.read.parquet(out)
    return merged


def score(features: DataFrame, city_model: M.CalibratedEnsemble, area_model: M.CalibratedEnsemble, out: str,
          created_at: str, version: str) -> tuple[DataFrame, DataFrame]:
    """Batch scoring of every feature row: the city table (8 columns) and the area table (14)."""
    city = M.score_city(features, city_model, created_at, version)
    city = write_gated(city, os.path.join(out, "surge_scores"), "surge_predictions")
    areas = M.score_areas(features, city, area_model, created_at, version)
    areas = write_gated(areas, os.path.join(out, "nbhd_scores"), "nbhd_predictions", rows=features.count)
    return city, areas
