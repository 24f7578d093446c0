from pyspark.sql import functions as F

from samples import MEDIUM, ODD, SMALL
from hoodcast.llm import language_id, quality_classifier, quality_rules, registry


def test_rules_match_sql(against_oracle):
    rows = against_oracle("op8_quality_rules", MEDIUM)
    assert 0 < sum(r[-1] for r in rows) < len(rows)


def test_rules_run_without_python_or_exchange(spark):
    plan = registry.QUERIES["op8_quality_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_rules_on_odd_rows(odd, nothing):
    rows = quality_rules.quality_rules(odd).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[7].n_words == 100_000 and by[7].n_repeat_words == 100_000 and by[7].base_failed
    assert by[6].word_chars == 300_000
    assert by[5].failed == ["length"]
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == 0
    assert quality_rules.quality_rules(nothing).count() == 0


def test_rules_keep_labelled_good_and_drop_bad(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    found = quality_rules.quality_rules(docs).join(labels, "doc_id").where("not base_failed")
    assert found.where("(quality = 1) <> kept").count() == 0


def test_language_held_out_accuracy(spark):
    out = registry.QUERIES["op1_language_id"](spark, MEDIUM)
    lang = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    r = out.join(lang, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert r[0] >= 0.98
    assert out.where("score < 0 or score > 1").count() == 0


def test_language_on_odd_rows(spark, odd, nothing):
    learn = spark.createDataFrame([("der und die das", "de"), ("the and of it", "en"), (None, "fr"), ("la", None)],
                                  "text string, lang string")
    model = language_id.fit(learn)
    assert model.langs == ["de", "en"]
    rows = language_id.predict(odd, model).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert {by[k].lang_pred for k in (1, 2, 3, 10)} == {"und"} and by[1].score == 0
    assert by[7].lang_pred == "en" and by[5].lang_pred == "en"
    assert language_id.predict(nothing, model).count() == 0
    assert language_id.fit(learn.limit(0)) is None
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}


def test_language_brute_force(spark):
    """The vectorised score is the plain sum of log-probabilities."""
    import math

    import numpy as np
    import pyarrow as pa

    from hoodcast.llm.text import slices
    learn = spark.createDataFrame([("Der Und die", "de"), ("the and of", "en")], "text string, lang string")
    m = language_id.fit(learn)
    (s,) = slices(pa.array([b"Und The, 7 of", b"die"], pa.binary()))
    c, offsets = language_id.letters(s)
    assert "".join(map(chr, c[:offsets[1]])) == " und the of "
    best, p = m.score(c, offsets)
    for i in range(2):
        own = c[offsets[i]:offsets[i + 1]]
        total = m.log_prior.copy()
        for n in language_id.ORDERS:
            for k in range(len(own) - n + 1):
                h, _ = language_id.grams(own[k:k + n], np.array([0, n]), n, m.bits)
                total = total + m.log_p[:, h[0]]
        assert best[i] == int(np.argmax(total))
        assert math.isclose(p[i], 1 / np.exp(total - total.max()).sum(), rel_tol=1e-5)


def test_quality_classifier_held_out_accuracy(spark):
    out = registry.QUERIES["op10_quality_classifier"](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality")
    r = out.join(labels, "doc_id").where("held_out").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int")),
        F.avg(F.when(F.col("quality") == 1, F.col("score"))) - F.avg(F.when(F.col("quality") == 0, F.col("score")))).first()
    assert r[0] >= 0.9 and r[1] >= 0.7
    assert out.where("score < 0 or score > 1 or (score >= 0.7) <> (predicted = 1)").count() == 0
    assert out.count() == 1000


def test_quality_classifier_on_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(5, None)], "doc_id long, quality int")
    rows = quality_classifier.classify(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality_classifier.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.classify(nothing, labels).count() == 0
