"""Token counts by byte-pair merging with a heap and a linked list.

The count of a word is its initial symbols minus the merges done; token
identifiers are never looked up or emitted.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Counts of distinct space-separated strings kept by a task; when full, the memory starts anew.
WORD_MEMORY = 400_000


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Merges done on a word: the lowest-ranked adjacent pair first, the leftmost of equals.

    Symbols form a doubly linked list; a heap holds ``(rank, position, pair)``
    of adjacent pairs. An entry whose pair has changed since is skipped.
    """
    n = len(symbols)
    syms = list(symbols)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        pair = (syms[i], syms[i + 1])
        if pair in ranks:
            heap.append((ranks[pair], i, pair))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = nxt[i]
        if j >= n or syms[i] != pair[0] or syms[j] != pair[1]:
            continue
        syms[i], syms[j] = pair[0] + pair[1], ""
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        merges += 1
        for k in (prv[i], i):
            if k >= 0 and nxt[k] < n:
                new = (syms[k], syms[nxt[k]])
                if new in ranks:
                    heapq.heappush(heap, (ranks[new], k, new))
    return merges


def space_free(spec: dict) -> bool:
    """Whether the tokens of a text are those of its space-separated strings.

    So it is when the pre-tokenizer is a ``Split`` that keeps the matches of a
    pattern in which nothing matches a space (no literal space, dot or class
    escape, and every negated class names white space), and the normalizer
    only composes, lower-cases and turns white space into a space.
    """
    norm, pre = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}, spec.get("pre_tokenizer")
    for step in norm.get("normalizers", [norm]):
        white = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if not white and step["type"] not in ("NFC", "Lowercase"):
            return False
    steps = pre["pretokenizers"] if pre and pre["type"] == "Sequence" else [pre]
    if len(steps) != 2 or steps[0]["type"] != "Split" or steps[1]["type"] != "ByteLevel":
        return False
    split, level = steps
    if split["behavior"] != "Removed" or not split["invert"] or level["add_prefix_space"] or level["use_regex"]:
        return False
    pattern = split["pattern"].get("Regex", " ").replace(r"[^\s", "")
    return not re.search(r"[ .]|\[\^|\\[sSWDP]", pattern)


class BpeCounter:
    """Counts the tokens that a tokenizers BPE file gives for a text.

    The file's own normalizer and pre-tokenizer split the text (they are the
    library's); added special tokens inside a text count as one token each, as
    is the library's default. Words are merged here. Every symbol a word
    starts with must be in the vocabulary, as in byte-level files; other model
    kinds are refused.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "unk_token") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"not a plain BPE file: {model['type']} {odd}")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with context rules are not supported")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): r for r, (a, b) in enumerate(merges)}
        self.suffix = model.get("end_of_word_suffix") or ""
        lib = Tokenizer.from_file(path)
        self.normalizer, self.pre = lib.normalizer, lib.pre_tokenizer
        names = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        self.by_space = space_free(spec)
        if self.by_space:
            import regex

            steps = (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]])
            self.lower = any(x and x["type"] == "Lowercase" for x in steps)
            self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.strings: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Tokens of a word, a string of byte-level symbols."""
        c = self.words.get(word)
        if c is None:
            if len(self.words) >= WORD_MEMORY:
                self.words.clear()
            symbols = list(word)
            symbols[-1] += self.suffix
            c = self.words[word] = len(symbols) - merge_count(symbols, self.ranks)
        return c

    def string(self, text: str) -> int:
        """Tokens of a text that is not normalized yet."""
        if self.by_space and text.isascii() and text.isprintable():
            # Printable ASCII: lower-casing is all the normalizer does, and each byte is its own symbol.
            return sum(map(self.word, self.pattern.findall(text.lower() if self.lower else text)))
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        pieces = self.pre.pre_tokenize_str(text) if self.pre is not None else [(text, None)]
        return sum(self.word(w) for w, _ in pieces if w)

    def plain(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        if not self.by_space:
            return self.string(text)
        known, total = self.strings, 0
        for w in text.replace("\n", " ").split(" "):
            if w:
                c = known.get(w)
                if c is None:
                    if len(known) >= WORD_MEMORY:
                        known.clear()
                    c = known[w] = self.string(w)
                total += c
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None:
            return self.plain(text)
        parts = self.added.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


def token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the long column ``out``: tokens of the whole text.

    One pass, no shuffle; each task reads the vocabulary file at ``path`` (it
    must be at the same place on every executor). A null or empty text has 0
    tokens. A column already named ``out`` is replaced.
    """

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = BpeCounter(path)
        for s in batches:
            yield pd.Series([counter.count(t) for t in s], dtype="int64")

    return docs.withColumn(out, count(F.col(text)))
