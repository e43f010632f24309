from __future__ import annotations

import hashlib
import random

import pytest

from staylake.llm.bpe_count import BpeCounter, merge_count, token_counts
from staylake.llm.piece_codec import PieceCodec, piece_digests, piece_ids, piece_text
from staylake.llm.queries import tokenizer_file

from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_documents, no_documents

WORD, PIECE = "word_bpe_49k.json", "piece_bpe_32k.model"


def odd_texts(n, seed):
    rnd = random.Random(seed)
    chars = [lambda: chr(rnd.randrange(32, 127)), lambda: chr(rnd.randrange(0x80, 0x250)), lambda: chr(rnd.randrange(0x370, 0x500)),
             lambda: chr(rnd.randrange(0x3000, 0x9FFF)), lambda: chr(rnd.randrange(0x1F300, 0x1F700)), lambda: rnd.choice(" \n\t▁́")]
    plain = lambda: rnd.choice("ab aA▁  \n\tnot thein'sII'LL")
    return ["".join((rnd.choice(chars) if k % 2 else plain)() for _ in range(rnd.randrange(50))) for k in range(n)] + [
        "", " ", "  a  b ", "▁", "a" * 3000, " " * 200 + "x", "a<|endoftext|>b <|startoftext|>", "<s>a</s><unk><0x41>", "\x00\x85\x1c ſt"]


def brute_merges(symbols, ranks):
    """Merge the leftmost of the lowest-ranked adjacent pairs until none is left."""
    symbols, n = list(symbols), 0
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not pairs:
            return n
        i = min(pairs)[1]
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        n += 1


def test_heap_against_brute_force():
    rnd = random.Random(1)
    for _ in range(300):
        pairs = [(rnd.choice(["a", "b", "ab", "ba", "aa"]), rnd.choice(["a", "b", "ab", "aa"])) for _ in range(8)]
        ranks = {p: r for r, p in enumerate(dict.fromkeys(pairs))}
        word = [rnd.choice("ab") for _ in range(rnd.randrange(1, 25))]
        assert merge_count(word, ranks) == brute_merges(word, ranks)


def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    lib, own = Tokenizer.from_file(tokenizer_file(WORD)), BpeCounter(tokenizer_file(WORD))
    for t in odd_texts(3000, 2):
        assert own.count(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for r in token_counts(docs, tokenizer_file(WORD)).collect():
        assert r["n_tokens"] == len(lib.encode(r["text"] or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(tokenizer_file(PIECE))


def expected(lib, text):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    ids = lib.encode(text, add_eos=True)
    return len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids))


def test_pieces_equal_the_library(spark, codec):
    texts = odd_texts(3000, 3)
    assert codec.digests(texts) == [expected(codec.lib, t) for t in texts]
    rnd = random.Random(4)
    for _ in range(500):
        ids = [rnd.randrange(3, 259 if rnd.random() < 0.5 else 32_000) for _ in range(rnd.randrange(12))]
        assert codec.decode(ids) == codec.lib.decode(ids), ids
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for r in piece_digests(docs, tokenizer_file(PIECE)).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(codec.lib, r["text"] or "")


def test_ids_round_trip(spark, codec):
    texts = ["Plain words.", "日本語 and ﬁ", "", None, "two  spaces\nand a line"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = piece_text(piece_ids(df, tokenizer_file(PIECE)), tokenizer_file(PIECE)).collect()
    for r in rows:
        assert r["ids"] == codec.lib.encode(r["text"] or "", add_eos=True)
        assert r["decoded"] == codec.lib.decode(r["ids"])


def test_edges(spark, codec):
    docs = edge_documents(spark)
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, tokenizer_file(WORD)).collect()}
    assert counts[1] == counts[2] == counts[3] == 0 and counts[5] > 60_000
    rows = piece_digests(docs, tokenizer_file(PIECE)).collect()
    assert len(rows) == 11
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(codec.lib, r["text"] or "")
    assert token_counts(no_documents(spark), tokenizer_file(WORD)).count() == 0
    assert piece_digests(no_documents(spark), tokenizer_file(PIECE)).count() == 0
