"""Classifiers: parts against brute force, odd rows, one class, no rows; accuracy is in test_queries.py."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_documents import ODD, nothing, odd  # noqa: F401  two of them are fixtures
from pyspark.sql import functions as F

from lakebars.llm import cotraining, language_id, toxicity
from lakebars.llm.boosting import fit_isotonic, fit_trees

LABELS = "doc_id long, quality int, toxic int, text string"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1)), min_size=1, max_size=40))
def test_isotonic_is_the_best_rising_fit(rows):
    margin, y = (np.array(c, float) for c in zip(*rows, strict=True))
    fitted = fit_isotonic(margin, y, weight=0.0)(margin)
    assert (np.diff(fitted[np.argsort(margin, kind="stable")]) >= -1e-12).all()
    # min-max formula of isotonic regression
    points = np.unique(margin)
    for at in points:
        want = max(min(y[(margin >= low) & (margin <= high)].mean() for high in points[points >= at]) for low in points[points <= at])
        assert abs(fitted[margin == at][0] - want) < 1e-9


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.3)).astype(float)
    assert ((fit_trees(x, y).margin(x) > 0) == (y > 0)).mean() > 0.99


def test_logistic_learns_a_category():
    rng = np.random.default_rng(0)
    x = np.stack([rng.integers(0, 4, 800), 4 + rng.integers(0, 4, 800)], axis=1)
    y = (x[:, 1] == 6).astype(float)
    model = cotraining.fit_logistic(x, y, 8)
    assert ((model.margin(x) > 0) == (y > 0)).all()


def test_views_teach_each_other():
    """Few labels; the metadata view knows the class of most rows, the text view learns it from there."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 3000)
    content = np.stack([y + rng.normal(0, 0.3, 3000), rng.random(3000)], axis=1)
    metadata = np.where(rng.random(3000) < 0.97, y, 1 - y)[:, None]
    known = np.arange(3000) < 60
    labels, held = np.where(known, y, -1), known & (np.arange(3000) % 3 == 0)
    alone = cotraining.fit_views(content, metadata, labels, held, columns=1, rounds=0)
    taught = cotraining.fit_views(content, metadata, labels, held, columns=1, rounds=3)
    right = [((m.scores(content, metadata)[0] >= 0.5) == (y > 0))[~known].mean() for m in (alone, taught)]
    assert right[1] >= right[0] and right[1] > 0.95


def test_mixture_shares_and_language_set():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.full(language_id.BUCKETS, 0.02), 3)
    model = language_id.LanguageModel(("a", "b", "c"), np.log(np.maximum(p, 1e-12)))
    draws = np.concatenate([rng.choice(language_id.BUCKETS, 700, p=p[0]), rng.choice(language_id.BUCKETS, 300, p=p[2])])
    shares = model.shares(np.bincount(draws, minlength=language_id.BUCKETS))
    assert np.allclose(shares, [0.7, 0, 0.3], atol=0.06) and shares[1] == 0
    alone = model.shares(np.bincount(draws[:700], minlength=language_id.BUCKETS))
    assert alone.tolist() == [1, 0, 0]


@pytest.mark.parametrize("text", [None, "", " \n", "123 !?", "…"])
def test_no_letters_is_undetermined(text):
    model = language_id.LanguageModel(("a",), np.log(np.full((1, language_id.BUCKETS), 1 / language_id.BUCKETS)))
    assert model.predict(text) == ("und", 0.0)


def labelled(spark, toxic=lambda i: i % 2):
    rows = []
    for i in range(60):
        text = "you are a vile grobnik and a fool" if i % 2 else "a calm note on gardens and rivers"
        rows.append((1000 + i, i % 2, toxic(i), f"{text} number{i}"))
    return spark.createDataFrame(rows, LABELS)


def test_toxicity_of_odd_rows(spark, odd):
    model = toxicity.fit_toxicity(labelled(spark).select("text", "toxic"))
    assert "grobnik" in model.lexicon.words
    scored = toxicity.score_toxicity(odd, model)
    assert scored.columns == [*(c for c in odd.columns if c not in ("score", "predicted")), "score", "predicted"]
    assert scored.filter("score between 0 and 1").count() == len(ODD)
    hard = spark.createDataFrame([("such a GR0BNIK you are",), ("a calm note on rivers",)], "text string")
    assert [r.predicted for r in toxicity.score_toxicity(hard, model).collect()] == [1, 0]


def test_toxicity_with_one_class_or_no_labels(spark, odd, nothing):
    one = toxicity.fit_toxicity(labelled(spark, toxic=lambda i: 0).select("text", "toxic"))
    assert {r.predicted for r in toxicity.score_toxicity(odd, one).collect()} == {0}
    rows = toxicity.training_rows(odd, spark.createDataFrame([], LABELS), F.lit(True))
    none = toxicity.fit_toxicity(rows)
    assert {(r.score, r.predicted) for r in toxicity.score_toxicity(odd, none).collect()} == {(0.5, 0)}
    assert toxicity.score_toxicity(nothing, none).count() == 0


def test_toxicity_labels_may_be_null_or_repeat(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 1, None), (None, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.training_rows(odd, labels, F.lit(True))
    assert sorted(r.toxic for r in rows.collect()) == [0, 1]


def test_rare_toxic_labels_all_teach_and_scores_keep_the_base_rate(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("such a GR0BNIK").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 50 == 0).cast("int").alias("toxic"))
    rows = toxicity.training_rows(docs, labels, F.lit(True), train_rows=400)
    found = {r.toxic: (r["count"], r.w) for r in rows.groupBy("toxic").agg(F.count("*").alias("count"), F.max("stands_for").alias("w")).collect()}
    assert found[1] == (60, 1.0)
    assert 280 <= found[0][0] <= 400 and abs(found[0][1] - 2940 / 340) < 1e-9
    model = toxicity.fit_toxicity(rows)  # one text with both labels: its score is the share of toxic rows
    score = toxicity.score_toxicity(docs.limit(1), model).first().score
    assert abs(score - 0.02) < 0.01


def test_language_of_odd_rows(spark, odd, nothing):
    rows = language_id.training_rows(odd, F.lit(True))
    model = language_id.fit_languages(rows)
    assert model.languages == ("en", "fr")  # the German text has no letters
    found = language_id.predict_language(odd, model)
    assert found.filter("lang_pred = 'und' and score = 0").count() == sum(not any(c.isalpha() for c in d.text or "") for d in ODD)
    assert found.filter("score between 0 and 1").count() == len(ODD)
    none = language_id.fit_languages(language_id.training_rows(nothing, F.lit(True)))
    assert none.languages == ()
    assert {r.lang_pred for r in language_id.predict_language(odd, none).collect()} == {"und"}
    assert language_id.predict_language(nothing, model).count() == 0


def test_quality_of_odd_rows(spark, odd, nothing):
    known = labelled(spark)
    docs = known.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("a").alias("source"), F.length("text").alias("n_chars"))
    names = ["doc_id", "text", *cotraining.METADATA]
    rows = cotraining.training_rows(docs.unionByName(odd.select(*names)), known.select("doc_id", "quality"), F.lit(True))
    model = cotraining.fit_quality(rows)
    scored = cotraining.score_quality(odd, model)
    assert scored.filter("score between 0 and 1 and predicted in (0, 1)").count() == len(ODD)
    assert cotraining.score_quality(nothing, model).count() == 0
    none = cotraining.fit_quality(cotraining.training_rows(odd.select(*names), known.select("doc_id", "quality"), F.lit(True)))
    assert {r.score for r in cotraining.score_quality(odd, none).collect()} == {0.5}


def test_the_whole_pool_is_co_trained_on(spark):
    """More unlabelled documents than any sample held; one source is among them only."""
    docs = spark.range(24_000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.lit("word"), F.col("id") % 7).alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") == 23_999, "rare").otherwise("often").alias("source"),
        F.lit(6).alias("n_chars"),
    )
    labels = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    rows = cotraining.training_rows(docs, labels, F.col("doc_id") < 50)
    assert rows.filter("quality is not null").count() == 50
    assert rows.filter("quality is null").count() == 23_900
    assert rows.filter("quality is null and source = 'rare'").count() == 1


def test_a_spread_pool_teaches_as_a_local_one(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 3000)
    content = np.stack([y + rng.normal(0, 0.3, 3000), rng.random(3000)], axis=1)
    metadata = np.where(rng.random(3000) < 0.97, y, 1 - y)[:, None]
    own = content[:60], metadata[:60], y[:60], np.arange(60) % 3 == 0
    blocks = [(content[at : at + 490], metadata[at : at + 490]) for at in range(60, 3000, 490)]
    here = cotraining.co_train(*own, cotraining.Here(blocks), 1, rounds=1)
    spread = cotraining.co_train(*own, cotraining.Spread(spark.sparkContext.parallelize(blocks[::-1], 4)), 1, rounds=1)
    for a, b in zip(here.scores(content, metadata), spread.scores(content, metadata), strict=True):
        assert (a == b).all()


def test_new_columns_replace_those_that_differ_in_case(spark):
    docs = spark.createDataFrame([(1, "some text", "en", "a", 9, "x", "y", "z")], "doc_id long, text string, lang string, source string, n_chars int, Score string, PREDICTED string, Lang_Pred string")
    labels = spark.createDataFrame([(1, 0, 1)], "doc_id long, toxic int, quality int")
    toxic = toxicity.fit_toxicity(toxicity.training_rows(docs, labels, F.lit(True)))
    kept = ["doc_id", "text", "lang", "source", "n_chars"]
    assert toxicity.score_toxicity(docs, toxic).columns == [*kept, "Lang_Pred", "score", "predicted"]
    assert toxicity.score_toxicity(docs, toxic).collect()[0].predicted == 0
    languages = language_id.fit_languages(language_id.training_rows(docs, F.lit(True)))
    assert language_id.predict_language(docs, languages).columns == [*kept, "PREDICTED", "lang_pred", "score"]
    good = cotraining.fit_quality(cotraining.training_rows(docs, labels, F.lit(True)))
    assert cotraining.score_quality(docs, good).columns == [*kept, "Lang_Pred", "score", "content_score", "metadata_score", "predicted"]
