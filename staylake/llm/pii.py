"""Personal data: patterns propose spans, checksums confirm them, words near by adjust their scores.

Four base kinds are found by their patterns and checks alone and always stay.
Further kinds are kept when their score reaches ``KEPT``: what the pattern is
worth, a passed checksum, and context words on either side.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds in their order, then the kinds that the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "national_id", "local_phone", "secret")
#: Lowest score of a span of an added kind, and what a context word of either sort is worth.
KEPT, NEAR, AGAINST = 0.5, 0.3, -0.3
#: What a span is worth by its pattern, and by a check it has passed.
PATTERN = {"email": 0.7, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.3, "national_id": 0.3, "local_phone": 0.3, "secret": 0.3}
CHECKED = {"card": 0.4, "iban": 0.5}
#: Code points on either side of a span in which context words count.
BEFORE, AFTER = 48, 24
#: Words that speak for a kind, and words that speak against every kind of number.
CONTEXT = {
    "email": ("email", "mail", "contact", "write", "address"),
    "ip": ("ip", "address", "host", "login", "client"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "iban": ("iban", "account", "bank", "transfer"),
    "national_id": ("ssn", "social", "security"),
    "local_phone": ("phone", "tel", "telephone", "call", "mobile", "fax"),
    "secret": ("token", "secret", "password", "passwd", "api", "key", "apikey"),
}
CONTRARY = ("version", "invoice", "order", "isbn", "sku", "part", "serial")
#: Lengths of international account numbers by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
    "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15,
    "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26,
}

# Possessive repeats: each pattern passes over a text once, however long its runs are.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_NATIONAL = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_LOCAL_PHONE = re.compile(r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}")
_SECRET = re.compile(r"[A-Za-z0-9_+/=-]++")
_WORD = re.compile(r"[a-z]+")

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number without spaces leaves 1, its first four signs moved to the end."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """Matches of the local part, ``@`` and the domain: from each ``@``, the local part is what lies before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        seg = text[end:at]
        start = end + len(seg.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield "email", start, found.end()
        end = found.end() if found else at + 1
        at = text.find("@", end)


def addresses(text: str) -> Iterator[Span]:
    """Four numbers of a chain of numbers joined by dots, then the next four."""
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        at, parts = m.start(), m.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield "ip", at, at + size
            at += size + 1


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = _digits(m.group()) if m.end() - m.start() <= 40 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            yield "phone", m.start(), m.end()


def _alone(text: str, start: int, end: int) -> bool:
    return not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum())


def _ibans(text: str) -> Iterator[Span]:
    for m in _IBAN.finditer(text):
        size = IBAN_LENGTHS.get(m.group()[:2], 0)
        seen = 0
        for k, c in enumerate(m.group()):
            seen += c != " "
            if seen == size:
                end = m.start() + k + 1
                if _alone(text, m.start(), end) and mod97(text[m.start() : end].replace(" ", "")):
                    yield "iban", m.start(), end
                break


def _national_ids(text: str) -> Iterator[Span]:
    for m in _NATIONAL.finditer(text):
        area, group, serial = m.group().split("-")
        real = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        if real and _alone(text, *m.span()):
            yield "national_id", *m.span()


def _local_phones(text: str) -> Iterator[Span]:
    for m in _LOCAL_PHONE.finditer(text):
        if _alone(text, *m.span()):
            yield "local_phone", *m.span()


def _secrets(text: str) -> Iterator[Span]:
    for m in _SECRET.finditer(text):
        s = m.group()
        if 24 <= len(s) <= 256 and any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and len(set(s)) >= 10:
            yield "secret", *m.span()


def score(text: str, span: Span) -> float:
    """Worth of the pattern, of its check, and of the context words within the window, between 0 and 1."""
    kind, start, end = span
    near = set(_WORD.findall(f"{text[max(0, start - BEFORE) : start]} {text[end : end + AFTER]}".lower()))
    worth = PATTERN[kind] + CHECKED.get(kind, 0.0)
    worth += NEAR * (not near.isdisjoint(CONTEXT[kind])) + AGAINST * (not near.isdisjoint(CONTRARY))
    return round(min(1.0, max(0.0, worth)), 3)


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans sorted, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """``kind, start, end, score`` of the personal data of a text, by start and kind; ends are exclusive.

    Base spans are all kept, whatever their score. A span of an added kind
    that overlaps one found before (the base kinds first, then the added
    ones in order) is left out, as is one whose score is below ``KEPT``.
    """
    text = text or ""
    base: list[Span] = list(emails(text))
    has_digit = _DIGIT.search(text)
    if has_digit:
        base += [*addresses(text), *cards(text)]
        if "+" in text:
            base += phones(text)
    found = [(*s, score(text, s)) for s in base]
    if has_digit:
        taken = _merged((a, b) for _, a, b in base)
        more = [_ibans, _national_ids, _local_phones]
        low = text.lower()
        if any(w in low for w in CONTEXT["secret"]):
            more.append(_secrets)
        for propose in more:
            for s in propose(text):
                k = bisect(taken, (s[1], s[2]))
                free = (k == 0 or taken[k - 1][1] <= s[1]) and (k == len(taken) or s[2] <= taken[k][0])
                if free and (worth := score(text, s)) >= KEPT:
                    taken.insert(k, (s[1], s[2]))
                    found.append((*s, worth))
    kinds = {k: i for i, k in enumerate(BASE + ADDED)}
    return sorted(found, key=lambda s: (s[1], kinds[s[0]]))


def with_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with the column ``out``: array of ``kind, start, end, score`` of each whole text, in code points.

    A row-wise operator without a shuffle. Null, empty and blank texts have
    an empty array; repeated rows each get theirs; an empty table gives an
    empty table. A column named ``out`` is replaced, all others pass through.
    """

    @F.pandas_udf(SPANS)
    def spans(s: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), f)) for f in find_spans(t)] for t in s], dtype=object)

    return docs.withColumn(out, spans(F.col(f"`{text}`")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(spans: Column, *kinds: str) -> Column:
    """The spans of the base kinds (or of some kinds) of a column of ``with_pii``."""
    return F.filter(spans, lambda s: s["kind"].isin(*(kinds or BASE)))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span (of overlapping ones the first) replaced by its kind in brackets."""
    text = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        before = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        out = F.when(s["start"] >= a["at"], F.concat(a["out"], before, F.lit("["), s["kind"], F.lit("]"))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
