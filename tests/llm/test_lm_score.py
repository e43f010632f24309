from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from staylake.llm import queries as Q
from staylake.llm.lm_score import SMOOTH, fit_pair_models, with_loss_difference

from tests.conftest import SF_CHECK
from tests.llm.conftest import edge_documents, no_documents

TEXTS = ["the house by the lake", "The lake by the house is the lake", "zxq zxq vvv", "a lake", "by by by", "a house of one word vvv"]


def brute_loss(texts, model, text):
    """Mean loss of a text under a word-pair model of ``model``, vocabulary of all ``texts``."""
    words = lambda t: t.lower().split()
    vocabulary = {w for t in texts for w in words(t)}
    one, two, begin = Counter(), Counter(), 0
    for t in model:
        w = words(t)
        begin += bool(w)
        one.update(w)
        two.update(zip([None, *w], w))
    total, loss = sum(one.values()), 0.0
    for a, b in zip([None, *words(text)], words(text)):
        single = (one[b] + 1) / (total + len(vocabulary) + 1)
        context = begin if a is None else one[a]
        loss -= math.log((two[a, b] + SMOOTH * single) / (context + SMOOTH))
    return loss / len(words(text))


def test_losses_against_definition(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    trusted = spark.createDataFrame([(0,), (1,), (1,), (None,), (99,)], "doc_id long")
    models = fit_pair_models(df, trusted)
    for r in with_loss_difference(df, models).collect():
        t = r["text"]
        assert r["n_tokens"] == len(t.split())
        assert r["target_loss"] == pytest.approx(brute_loss(TEXTS, TEXTS[:2], t))
        assert r["background_loss"] == pytest.approx(brute_loss(TEXTS, TEXTS, t))
        assert r["score"] == pytest.approx(r["target_loss"] - r["background_loss"])


def test_equal_texts_and_long_parts(spark, monkeypatch):
    """Each of several equal texts has its own words; a text that is dealt in parts has all of them."""
    from staylake.llm import lm_score

    long = "a b a c d " * 250_000  # two parts
    texts = ["one two two three", *TEXTS, "one two two three", "One  two\ntwo three", "one two two three", long, long]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    df = df.select("*", *[F.lit(0).alias(c) for c in ("loss_key", "losses", "batch", "bucket", "part", "n_tokens")])
    trusted = spark.createDataFrame([(0,), (1,)], "doc_id long")
    want = {t: (brute_loss(texts, texts[:2], t), brute_loss(texts, texts, t)) for t in set(texts)}
    for dealt in (200_000, 5):
        monkeypatch.setattr(lm_score, "DEALT", dealt)
        out = with_loss_difference(df, fit_pair_models(df, trusted))
        assert set(df.columns) < set(out.columns)
        for r in out.collect():
            t = texts[r["doc_id"]]
            assert r["n_tokens"] == len(t.split())
            assert (r["target_loss"], r["background_loss"]) == pytest.approx(want[t])


def test_query_counts_every_document(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    rows = Q.op10_loss_difference(spark, SF_CHECK).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len((t or "").encode().split()) for i, t in texts.items()}
    assert len(rows) == len(texts)


def test_edges(spark):
    docs = edge_documents(spark)
    models = fit_pair_models(docs, spark.createDataFrame([(8,)], "doc_id long"))
    rows = with_loss_difference(docs, models).collect()
    assert len(rows) == 11
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["n_tokens"] == 0 and by[i]["score"] is None for i in (1, 2, 3))
    assert by[5]["n_tokens"] == 60_000 and by[8]["score"] < by[6]["score"]
    assert by[6]["score"] == by[7]["score"]
    empty = fit_pair_models(no_documents(spark), no_documents(spark).select("doc_id"))
    assert with_loss_difference(no_documents(spark), empty).count() == 0
    assert with_loss_difference(docs, empty).count() == 11


def test_rare_words_keep_their_own_counts(spark, monkeypatch):
    """Exact losses whatever is known to all tasks, with more words and pairs than any fixed table holds."""
    from staylake.llm import lm_score

    texts = [" ".join(f"w{(i * 7919 + j * j) % 5003} the x{j % 7}" for j in range(40)) for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trusted = spark.range(0, 200, 3).withColumnRenamed("id", "doc_id")
    for frequent, hot in ((65_535, 65_536), (4, 2)):
        monkeypatch.setattr(lm_score, "FREQUENT", frequent)
        monkeypatch.setattr(lm_score, "HOT", hot)
        models = fit_pair_models(df, trusted)
        assert models.vocabulary == len({w for t in texts for w in t.split()})
        rows = {r["doc_id"]: r for r in with_loss_difference(df, models).collect()}
        for i in (0, 1, 77, 198):
            assert rows[i]["target_loss"] == pytest.approx(brute_loss(texts, texts[::3], texts[i]))
            assert rows[i]["background_loss"] == pytest.approx(brute_loss(texts, texts, texts[i]))
    seen = spark.createDataFrame([(1, "the the nowhere x1 the w1")], "doc_id long, text string")
    r = with_loss_difference(seen, models).first()
    assert r["n_tokens"] == 6 and r["target_loss"] == pytest.approx(brute_loss(texts, texts[::3], "the the nowhere x1 the w1"))
