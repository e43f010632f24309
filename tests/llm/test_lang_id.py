from __future__ import annotations

import math
import zlib

import pytest

from staylake.llm.lang_id import LanguageModel, fit_languages, held_out, ngrams, prepared, with_language

from tests.conftest import SF_CHECK
from tests.llm.conftest import edge_documents, no_documents


def brute_kernel(a, b):
    """Shared n-grams of one to three characters over the geometric mean of both counts."""
    sets = []
    for t in (prepared(a), prepared(b)):
        t = f" {t} "
        sets.append({t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)})
    return len(sets[0] & sets[1]) / math.sqrt(len(sets[0]) * len(sets[1]))


def test_kernel_against_definition():
    marks = ["Ein Haus am See", "une maison près du lac", "a house by the lake 42"]
    texts = marks + ["la maison", "ΣΑΣ 漢字 text", "x"]
    model = LanguageModel.of_landmarks([ngrams(prepared(t)) for t in marks])
    got = model.kernel([ngrams(prepared(t)) for t in texts])
    for i, t in enumerate(texts):
        for j, m in enumerate(marks):
            assert got[i, j] == pytest.approx(brute_kernel(t, m), abs=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = fit_languages(docs)
    rows = with_language(docs.withColumn("held_out", held_out("doc_id")), model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.98 * len(test) > 100
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark):
    docs = edge_documents(spark)
    model = fit_languages(docs)
    rows = with_language(docs, model).collect()
    assert len(rows) == 11 and set(docs.columns) < set(rows[0].asDict())
    by = {r["doc_id"]: r for r in rows}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3, 9))
    assert by[5]["lang_pred"] in model.langs
    none = fit_languages(no_documents(spark))
    assert {r["lang_pred"] for r in with_language(docs, none).collect()} == {"und"}
    assert with_language(no_documents(spark), model).count() == 0
