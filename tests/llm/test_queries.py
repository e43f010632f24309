"""The registered queries over whole tables: their columns against plain computations."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest

from staylake.llm import queries as Q

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.REGISTRY) == list(range(1, 14))


def test_balanced_sharding(spark, documents):
    rows = Q.op1_balanced_sharding(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(documents) and len(rows) == len(documents)
    counts = Counter(r["shard"] for r in rows)
    assert max(counts[s] for s in range(16)) - min(counts[s] for s in range(16)) <= 1
    by: dict = {}
    for r in rows:
        text = documents[r["doc_id"]]["text"]
        raw = (text or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_language_id(spark, documents):
    rows = Q.op4_language_id(spark, SF_SMALL).collect()
    assert len(rows) == len(documents)
    right = total = 0
    for r in rows:
        d = documents[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        letters = any(c.isalpha() for c in d["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        if r["held_out"] and d["lang"] and letters:
            total += 1
            right += r["lang_pred"] == d["lang"]
    assert total > 20 and right >= 0.95 * total


def test_best_fit_packing(spark, documents):
    got: Counter = Counter()
    for r in Q.op6_best_fit_packing(spark, SF_SMALL).collect():
        got[r["doc_id"]] += r["length"]
    assert got == {i: len((d["text"] or "").encode().split()) + 1 for i, d in documents.items()}


def test_token_counts(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(Q.tokenizer_file("word_bpe_49k.json"))
    rows = Q.op7_token_counts(spark, SF_SMALL).collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r["doc_id"]]["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_piece_codec(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_file("piece_bpe_32k.model"))
    rows = Q.op8_piece_codec(spark, SF_SMALL).collect()
    assert len(rows) == len(documents)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = library.encode(documents[r["doc_id"]]["text"] or "", add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
