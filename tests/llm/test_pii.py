from __future__ import annotations

import hashlib
import re
import time

from pyspark.sql import functions as F

from staylake.llm import queries as Q
from staylake.llm.pii import BASE, base_spans, find_spans, listed, luhn, redacted, with_pii

from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_documents, no_documents

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain_luhn(s):
    total = 0
    for k, c in enumerate(s[::-1]):
        total += sum(divmod(int(c) * 2, 10)) if k % 2 else int(c)
    return total % 10 == 0


def brute_base(text):
    text, out = text or "", []
    only = lambda s: re.sub("[^0-9]", "", s)
    out += [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(CARD, text) if 12 <= len(only(m.group())) <= 19 and plain_luhn(only(m.group()))]
    out += [("phone", *m.span()) for m in re.finditer(PHONE, text) if 9 <= len(only(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], BASE.index(s[0])))


TRICKY = [
    "a@b.c@d.e and x.y_z%+-@mail-1.example.co.uk. a@b a@.b @c.d a@@b.c a@b.c_d@e.f",
    "1.2.3.4.5 1.2.3.4.5.6.7.8.9 256.1.1.1 1.2.3 001.002.003.255 1..2.3.4 9.9.9.9999 .1.2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 5500 0000 0000 0004 12 4111  1111 00000000000000000000",
    "+1 (523) 555-1055 +49.30.1234567- call +1+2 +12 +1 555 +44 20 7946 0958 4111 +(1) 2345 ++1 234 567 890",
    "é@ü.de ＠ a1@b2.c3… 🙂 1.2.3.4 🙂 +1 234 567 8901 🙂",
]


def test_base_spans_are_those_of_the_patterns():
    for text in TRICKY:
        assert [s[:3] for s in find_spans(text) if s[0] in BASE] == brute_base(text), text


def test_checksums_and_context_add_spans():
    kinds = lambda t: [(s[0], t[s[1] : s[2]]) for s in find_spans(t) if s[0] not in BASE]
    assert kinds("pay to DE89 3704 0044 0532 0130 00 AND more") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("pay to DE88 3704 0044 0532 0130 00 today") == []  # fails mod 97
    assert kinds("GB82WEST12345698765432.") == [("iban", "GB82WEST12345698765432")]
    assert kinds("his ssn is 123-45-6789 now") == [("national_id", "123-45-6789")]
    assert kinds("part 123-45-6789 now") == [] and kinds("ssn 000-45-6789 and 666-12-1234") == []
    assert kinds("call 555-123-4567 now") == [("local_phone", "555-123-4567")]
    assert kinds("invoice 555-123-4567 call") == [] and kinds("it is 555-123-4567") == []
    assert kinds('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"') == [("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff")]
    assert kinds("the hash 24be64439e3e49cf46b2d7c90f3602a3d0b907ff of words that stand far far far away from any token") == []
    by = {s[0]: s[3] for s in find_spans("my credit card 4111111111111111")}
    assert by["card"] == 1.0 and find_spans("order 4111111111111111")[0][3] < by["card"]
    # an added span never overlaps a base one
    assert kinds("ssn call 123-45-6789@b.com") == []
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_long_runs_take_linear_time():
    start = time.time()
    n = 400_000
    for text in ("7" * n, "a" * n, "a." * n, "1." * n, "+1(" * n, "1 " * n, "a@b" * n, "token " + "aB3-" * n, "AB12" * n, "+" + "(" * n, "1.2.3.4 " * (n // 10)):
        find_spans(text)
    assert time.time() - start < 60
    assert len(find_spans("9" * 5_000 + ".1.1.1")) == 0


def test_query_against_brute_force(spark):
    rows = Q.op13_personal_data(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 20
    for r in rows:
        base = brute_base(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in BASE)
        assert r.base_sha256 == hashlib.sha256(",".join("%s:%d:%d" % s for s in base).encode()).hexdigest()
        assert {"%s:%d:%d" % s for s in base} <= set(r.spans.split(","))


def test_edges(spark):
    docs = edge_documents(spark).withColumn("pii", F.lit("clash")).withColumn("start", F.lit(0))
    out = with_pii(docs)
    assert out.columns == [c for c in docs.columns]
    rows = out.collect()
    assert len(rows) == 11 and all(r.pii == [] for r in rows if r.doc_id in (1, 2, 3))
    assert with_pii(no_documents(spark)).count() == 0


def test_redaction(spark):
    text = "🙂 mail a@b.co or +1 234 567 8901, 1.2.3.4"
    df = with_pii(spark.createDataFrame([(text,), (None,), ("clean",)], "text string"))
    got = df.select(redacted(F.col("text"), F.col("pii")).alias("r"), listed(base_spans(F.col("pii"))).alias("b")).collect()
    assert [r.r for r in got] == ["🙂 mail [email] or [phone], [ip]", "", "clean"]
    assert got[1].b == ""
