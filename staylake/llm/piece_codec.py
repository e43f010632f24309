"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

Words wait in flat numpy arrays. A round finds the best adjacent pair of every
word at once (a segmented minimum of pair ranks), merges its leftmost
non-overlapping occurrences in all words, and compacts the arrays, until no
pair is left.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct words whose encoding a task keeps; when full, the memory starts anew.
WORD_MEMORY = 400_000
#: Longest run of symbols encoded in one go; more words take another go.
FLAT_LIMIT = 2_000_000
MARK = "▁"  # stands for a space in pieces (fixed by the format)
NONE = np.iinfo(np.int64).max


class PieceCodec:
    """Encodes and decodes as the sentencepiece library does with a BPE model file.

    The library reads the model file and normalizes texts; encoding and
    decoding are done here. Model files with user-defined or unused pieces,
    without byte pieces, or with a white-space mark inside a piece are refused.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.lib = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.end = lib.eos_id()
        special = [lib.is_control(i) or lib.is_unknown(i) for i in range(n)]
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in range(n) if lib.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        plain = [i for i in range(n) if not special[i] and i not in self.byte_of]
        # Pieces and their order of merging: a higher score merges first.
        order = sorted(plain, key=lambda i: (-lib.get_score(i), i))
        if len(self.byte_id) != 256 or any(lib.is_unused(i) for i in range(n)):
            raise ValueError("needs byte pieces and no unused pieces")
        if any(MARK in self.pieces[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece holds the space mark after another character")
        rank = {i: r for r, i in enumerate(order)}
        by_text = {self.pieces[i]: i for i in plain}
        # Symbols: piece ids, and above them the code points of characters that are no piece.
        self.base = n
        self.symbol = np.arange(n, n + 0x110000, dtype=np.int64)
        chars = {self.pieces[i]: i for i in plain if len(self.pieces[i]) == 1}
        self.symbol[[ord(c) for c in chars]] = list(chars.values())
        pairs = []
        for text, i in by_text.items():
            for k in range(1, len(text)):
                a, b = by_text.get(text[:k]), by_text.get(text[k:])
                if a is not None and b is not None:
                    pairs.append((a * n + b, rank[i], i))
        pairs.sort()
        self.pair_key = np.array([p[0] for p in pairs], np.int64)
        self.pair_rank = np.array([p[1] for p in pairs], np.int64)
        self.pair_to = np.array([p[2] for p in pairs], np.int64)
        # Two characters that are no pieces may still form one.
        if any(len(t) > 1 and not all(c in chars for c in t) for t in by_text):
            raise ValueError("a piece holds a character that is no piece")
        self.known: dict[str, tuple[int, str, str]] = {}
        self.id_text = [str(i) for i in range(n)]
        self.shown = [" ⁇ " if lib.is_unknown(i) else "" if special[i] else t.replace(MARK, " ") for i, t in enumerate(self.pieces)]

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Index into the pair table for each adjacent pair, -1 where there is none."""
        key = np.where((a < self.base) & (b < self.base), a * self.base + b, -1)
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, at, -1)

    def merge_words(self, words: list[str]) -> list[list[int]]:
        """Symbols of each word after all merges."""
        sym = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done_sym, done_word = [], []
        while len(sym) > 1:
            at = np.where(word[1:] == word[:-1], self.pair(sym[:-1], sym[1:]), -1)
            rank = np.where(at >= 0, self.pair_rank[at], NONE)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            # The pair after a word's last symbol has no rank, so it may count with the word.
            best = np.minimum.reduceat(np.r_[rank, NONE], starts)
            sizes = np.diff(np.r_[starts, len(sym)])
            best_of = np.repeat(best, sizes)
            still = best_of < NONE
            if not still.all():  # words without a pair are ready
                done_sym.append(sym[~still])
                done_word.append(word[~still])
                keep = np.flatnonzero(still)
                if not len(keep):
                    sym, word = sym[:0], word[:0]
                    break
                pair_keep = keep[:-1]  # pairs inside kept words stay adjacent
                at, rank = at[pair_keep], rank[pair_keep]
                sym, word, best_of = sym[keep], word[keep], best_of[keep]
            hit = rank == best_of[:-1]
            hit &= word[1:] == word[:-1]
            hit = self._leftmost(hit)
            hit = self._safe(sym, word, at, hit, best_of)
            i = np.flatnonzero(hit)
            sym[i] = self.pair_to[at[i]]
            left = np.ones(len(sym), bool)
            left[i + 1] = False
            sym, word = sym[left], word[left]
        done_sym.append(sym)
        done_word.append(word)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        bounds = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        symbols = sym.tolist()
        return [symbols[a:b] for a, b in zip(bounds, bounds[1:])]

    @staticmethod
    def _leftmost(hit: np.ndarray) -> np.ndarray:
        """Of overlapping marked pairs (runs of marks) every second one, from the left."""
        i = np.flatnonzero(hit)
        if len(i) < 2:
            return hit
        fresh = np.r_[True, np.diff(i) > 1]
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(i)), 0))
        hit = hit.copy()
        hit[i[(np.arange(len(i)) - run_start) % 2 == 1]] = False
        return hit

    def _safe(self, sym, word, at, hit, best_of) -> np.ndarray:
        """Only the first merge of a word, where a merge makes a pair that goes before the rest.

        A merged symbol next to its neighbours may form a pair of lower rank
        than the one at hand; merging one at a time keeps to the order then.
        """
        i = np.flatnonzero(hit)
        w = word[i]
        several = np.r_[False, w[1:] == w[:-1]] | np.r_[w[1:] == w[:-1], False]
        if not several.any():
            return hit
        j = i[several]
        new = self.pair_to[at[j]]
        early = np.zeros(len(j), bool)
        prev, nxt = np.maximum(j - 1, 0), np.minimum(j + 2, len(sym) - 1)
        for ok, p in (
            ((j > 0) & (word[prev] == word[j]), self.pair(sym[prev], new)),
            ((j + 2 < len(sym)) & (word[nxt] == word[j]), self.pair(new, sym[nxt])),
        ):
            early |= ok & (p >= 0) & (self.pair_rank[p] < best_of[j])
        # Neighbours may be merged in the same round too: test the pair of two merged symbols.
        both = np.flatnonzero((np.diff(j) == 2) & (word[j[1:]] == word[j[:-1]])) if len(j) > 1 else []
        if len(both):
            p = self.pair(new[both], new[both + 1])
            early[both] |= (p >= 0) & (self.pair_rank[p] < best_of[j[both]])
        if not early.any():
            return hit
        slow = np.unique(word[j[early]])
        first = np.r_[True, w[1:] != w[:-1]]
        hit = hit.copy()
        hit[i[np.isin(w, slow) & ~first]] = False
        return hit

    def ids(self, symbols: list[int]) -> list[int]:
        """Piece ids of merged symbols; a character that is no piece gives its UTF-8 byte pieces."""
        if max(symbols) < self.base:
            return symbols
        out = []
        for s in symbols:
            if s < self.base:
                out.append(s)
            else:
                out.extend(self.byte_id[b] for b in chr(s - self.base).encode("utf-8"))
        return out

    def decode_pieces(self, ids: list[int]) -> str:
        """Text of ids, without the handling of a text's first space.

        Runs of byte pieces are read as UTF-8; a byte that does not fit gives
        U+FFFD. Control pieces give nothing.
        """
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.shown[i] for i in ids])
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if i is not None:
                out.append(self.shown[i])
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids as the library gives it: the space that encoding puts before a text goes."""
        ids = [i for i in ids if not self.lib.is_control(i)]
        text = self.decode_pieces(ids)
        return text[1:] if ids and self.pieces[ids[0]].startswith(MARK) else text

    def words(self, text: str) -> list[str]:
        """The normalized text, cut before each run of space marks: no piece crosses such a cut."""
        return _WORD.findall(self.lib.normalize(text))

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet: number of ids, the ids as text, the decoded text."""
        start, size = 0, 0
        for k, w in enumerate(words):
            size += len(w)
            if size >= FLAT_LIMIT or k == len(words) - 1:
                part = words[start : k + 1]
                for x, symbols in zip(part, self.merge_words(part)):
                    ids = self.ids(symbols)
                    self.known[x] = (len(ids), " ".join([self.id_text[i] for i in ids]), self.decode_pieces(ids))
                start, size = k + 1, 0

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text, the end id last."""
        words = self.words(text or "")
        return [i for s in self.merge_words(words) for i in self.ids(s)] + [self.end] if words else [self.end]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text: number of ids, SHA-256 of the ids as text, SHA-256 of the decoded text."""
        split = [self.words(t or "") for t in texts]
        if len(self.known) > WORD_MEMORY:
            self.known.clear()
        known, out = self.known, []
        self.learn([w for w in dict.fromkeys(chain.from_iterable(split)) if w not in known])
        for ws in split:
            found = [known[w] for w in ws]
            ids = " ".join([f[1] for f in found] + [str(self.end)])
            text = "".join([f[2] for f in found])
            if ws and ws[0].startswith(MARK):
                text = text[1:]
            out.append((sum(f[0] for f in found) + 1, _sha(ids), _sha(text)))
        return out


_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _utf8(run: bytes) -> str:
    """UTF-8 text of bytes; each byte that starts no valid character gives one U+FFFD."""
    out = []
    while run:
        try:
            out.append(run.decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out.append(run[: e.start].decode("utf-8") + "�")
            run = run[e.start + 1 :]
    return "".join(out)


def piece_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each whole text.

    Ids end with the end id; they are joined by one space before hashing. One
    pass, no shuffle; the model file must be at ``path`` on every executor. A
    null or empty text has the end id only. Columns of these names are replaced.
    """
    kind = T.StructType(
        [T.StructField("n", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("dec", T.StringType())]
    )

    @F.pandas_udf(kind)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = PieceCodec(path)
        for s in batches:
            rows = []
            for k in range(0, len(s), 1000):
                rows += codec.digests(s.iloc[k : k + 1000].tolist())
            yield pd.DataFrame(rows, columns=["n", "ids", "dec"])

    out = docs.withColumn("_digest", digest(F.col(text)))
    return out.withColumns(
        {"n_tokens": F.col("_digest.n"), "ids_sha256": F.col("_digest.ids"), "decoded_sha256": F.col("_digest.dec")}
    ).drop("_digest")


def piece_ids(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the array of ids of each whole text, the end id last."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = PieceCodec(path)
        for s in batches:
            yield pd.Series([codec.encode(t) for t in s])

    return docs.withColumn(out, encode(F.col(text)))


def piece_text(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text that an array of ids stands for; null ids give an empty text."""

    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = PieceCodec(path)
        for s in batches:
            yield pd.Series([codec.decode([] if i is None else list(i)) for i in s])

    return rows.withColumn(out, decode(F.col(ids)))
