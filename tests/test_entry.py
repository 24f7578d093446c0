import duckdb

import __spark_entry__ as E
from hoodcast.sources.tables import TABLES, table_path

from places import SF_SMALL

#: Some of every family; ``tools/check_oracle.py`` runs them all.
FAST = ["dense_panel", "ksi_daily", "weather_daily", "disruption_daily", "topk_trailing30", "adjacency_touches",
        "dq_duplicate_count", "coord_clusters", "road_exposure", "current_weather", "weather_conditions", "latest_mart",
        "why_high_risk", "risk_map", "trend_90d", "gate_density", "gate_contract", "valid_shapes", "shapes_within",
        "shapes_intersects", "one_way_pairs", "road_statistics", "surge_label", "columnar_json_flatten",
        "ringed_centroids", "closure_sweep", "exact_quantiles", "median_per_supplier", "feature_collection", "merge_loads",
        "audit_statuses", "gate_prediction_contract", "gate_feature_contract", "merged_feeds", "metric_cards",
        "metrics_by_model", "topk_areas", "latest_surge", "risk_bands", "canonical_columns", "join_row_counts",
        "micro_weather_proxy"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["date", "nbhd_id", "area_name", "trailing30_mean", "rank"]


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len([n for n in q if not n.startswith("op") and n != "pipeline"]) >= 140
    assert {n for n in q if not n.startswith("op") and n != "pipeline"} == {n for n in o if not n.startswith("op")}


def test_fast_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    q, o = E.queries(), E.oracle_sql()
    for name in FAST:
        df = q[name](spark, SF_SMALL)
        cols = df.columns
        got = sorted((tuple(r) for r in df.collect()), key=repr)
        cur = con.execute(o[name])
        ocols = [d[0] for d in cur.description]
        exp = sorted((tuple(r[ocols.index(c)] for c in cols) for r in cur.fetchall()), key=repr)
        assert sorted(cols) == sorted(ocols), name
        assert got == exp, name
