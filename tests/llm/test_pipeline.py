from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline as P
from staylake.llm.lang_id import fit_languages, prepared

from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_documents, no_documents
from tests.llm.test_quality import brute_kept
from tests.llm.test_simhash import brute_roots, slow_fingerprint


def test_run_against_brute_force(spark):
    kept = {i: t for i, t, _, _, ok in brute_kept(spark, SF_SMALL) if ok}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.col("doc_id").isin(list(kept)))
    model = fit_languages(docs)
    for i in list(kept):
        (lang,), (score,) = model.predict([kept[i]])
        if not prepared(kept[i]) or lang == "und" or score < P.MIN_LANGUAGE_SCORE:
            del kept[i]
    fps = {i: slow_fingerprint(t, 4) for i, t in kept.items()}
    roots, low = brute_roots(fps.values(), 4), {}
    for i, f in fps.items():
        low[roots[f]] = min(low.get(roots[f], i), i)
    want = {i: len((kept[i] or "").split()) + 1 for i in low.values()}
    rows = P.run(spark, SF_SMALL).collect()
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want
    used = {r["bin_id"]: (r["bin_used"], r["bin_capacity"]) for r in rows}
    assert sum(u for u, _ in used.values()) == sum(want.values()) and all(u <= c for u, c in used.values())


def test_clean_documents_stay(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    good = docs.where(F.size(F.split("text", " ")) >= 10)
    stays = P.language(spark, P.quality(spark, docs, SF_SMALL), SF_SMALL)
    lost = good.join(stays.select("doc_id"), "doc_id", "left_anti").count()
    assert lost <= 0.03 * good.count()


def test_stages_on_edges(spark):
    for docs in (edge_documents(spark), no_documents(spark)):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns
            out.collect()
        assert P.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count()
