import re

import corpus_pipeline as P
from samples import MEDIUM
from test_packing_warc_chat import check_packing
from test_pairs_and_passages import brute_components, families

import __spark_entry__ as E


def test_registered():
    queries = E.queries()
    assert "pipeline" in queries
    assert [len([q for q in queries if q.startswith(f"op{n}_")]) for n in range(1, 11)] == [1] * 10


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    columns, path = docs.columns, None
    seen = {}
    for name, stage in P.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, MEDIUM)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "best_fit_packing":
            assert docs.columns == columns
            after = {r.doc_id: r for r in docs.collect()}
            assert set(after) <= set(before)
        seen[name] = (before, after if name != "best_fit_packing" else docs.collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    before, after = seen["quality_rules"]
    for k, r in before.items():
        if len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) < 50 or labels.get(k) == 0:
            assert k not in after
        elif labels.get(k) == 1:
            assert k in after
    before, after = seen["line_dedup"]
    for k, r in after.items():
        kept, all_ = r.text.split("\n"), before[k].text.split("\n")
        at = iter(all_)
        assert all(x in at for x in kept) and r.n_chars == len(r.text)
    assert any(len(after[k].text) < len(before[k].text) for k in after)
    before, after = seen["ngram_jaccard_join"]
    want = brute_components([(k, r.text) for k, r in before.items()], P.SHINGLE, P.PERCENT)
    assert set(after) == {k for k, (_, c) in want.items() if c == k} and after.items() <= before.items()
    before, after = seen["benchmark_decontamination"]
    items = [r.text for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
    held = {k for k, r in before.items() if any(t in r.text for t in items)}
    assert set(after) == set(before) - held
    before, rows = seen["best_fit_packing"]
    made, bound = check_packing(rows, [(k, r.text) for k, r in before.items()], 2048)
    assert made <= 1.02 * bound + 1


def test_run_equals_the_stages(spark):
    out = P.run(spark, MEDIUM)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    assert out.select("doc_id").distinct().count() > 500


def test_stages_on_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        frame = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS long) AS n_chars",
                                "score", "kept", "'v' AS __row", "'w' AS __key", "1 AS `row`", "2 AS key", "3 AS doc")
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, frame, MEDIUM)
            assert out.columns == frame.columns
            n = out.count()
            assert n <= frame.count() and (n > 0 or name == "quality_rules" or docs is nothing)
    many = [(k, " ".join(t.split() * 3)) for k, t in families(8)] + [(3, families(8)[0][1]), (None, "a b c d e f")] * 2
    frame = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in many],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    left = P._near_duplicates(spark, frame, MEDIUM).collect()
    want = brute_components([((k if k is not None else 10_000, i), t) for i, (k, t) in enumerate(many)], 5, 80)
    assert len(left) == len({c for _, c in want.values()})
