"""Language identification with a blended-spectrum string kernel.

The kernel of two texts counts the n-grams (one to three characters) that are
present in both, normalised by the geometric mean of their own counts. A
Nyström map onto landmark texts makes it a vector; one-versus-rest kernel
ridge regression on the vectors gives a weight per language, so that a batch
of texts is scored by matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The bounded sample the classifier is fitted on: per language, at most about
#: this many landmark texts and training texts (the first by a hash of the id).
LANDMARKS, TRAINING = 24, 400
#: Weight of the ridge, relative to the number of training texts.
RIDGE = 1e-3
#: Texts scored in one matrix product.
BATCH = 64
UNKNOWN = "und"


def prepared(text: str | None) -> str:
    """Lower-cased, every run of characters other than letters turned into one space; empty without a letter."""
    return " ".join("".join([c if c.isalpha() else " " for c in (text or "").lower()]).split())


def ngrams(text: str) -> np.ndarray:
    """Sorted distinct n-grams of one to three characters, as numbers (21 bits a character)."""
    c = np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    two = (c[:-1] << np.uint64(21)) | c[1:]
    three = (two[:-1] << np.uint64(21)) | c[2:]
    return np.concatenate([np.unique(c), np.unique(two), np.unique(three)])


@dataclass
class LanguageModel:
    """Landmark presences and language weights; its size is set by the sample bounds."""

    grams: np.ndarray  # sorted n-grams of all landmarks
    presence: np.ndarray  # one row per n-gram, one column per landmark
    norms: np.ndarray  # square roots of the landmarks' n-gram counts
    weights: np.ndarray  # one column per language
    langs: list[str]

    @classmethod
    def of_landmarks(cls, sets: list[np.ndarray]) -> "LanguageModel":
        grams = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        presence = np.zeros((len(grams), len(sets)), np.float32)
        for j, s in enumerate(sets):
            presence[np.searchsorted(grams, s), j] = 1
        return cls(grams, presence, np.sqrt([max(len(s), 1) for s in sets]), np.zeros((len(sets), 0)), [])

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Normalised kernel of each text (by its n-grams) with each landmark, a batch at a time."""
        out = np.zeros((len(sets), len(self.norms)))
        rows = np.zeros((min(BATCH, len(sets)), len(self.grams)), np.float32)
        for k in range(0, len(sets), BATCH):
            part = sets[k : k + BATCH]
            rows[:] = 0
            for i, s in enumerate(part):
                at = np.minimum(np.searchsorted(self.grams, s), len(self.grams) - 1)
                rows[i, at[self.grams[at] == s]] = 1
            own = np.sqrt([max(len(s), 1) for s in part])
            out[k : k + len(part)] = (rows[: len(part)] @ self.presence) / own[:, None] / self.norms[None, :]
        return out

    def fit(self, kernels: np.ndarray, labels: list[str], among: np.ndarray, ridge: float) -> None:
        """One-versus-rest ridge regression on the Nyström vectors of training texts.

        ``kernels``: training texts by landmarks; ``among``: landmarks by landmarks.
        """
        self.langs = sorted(set(labels))
        values, vectors = np.linalg.eigh(among)
        some = values > 1e-6 * values.max()
        root = vectors[:, some] / np.sqrt(values[some])
        x = kernels @ root
        at = {c: i for i, c in enumerate(self.langs)}
        y = np.zeros((len(labels), len(self.langs)))
        y[np.arange(len(labels)), [at[c] for c in labels]] = 1
        # Each language weighs the same, however many texts it has.
        share = 1 / np.maximum(y.sum(0), 1)
        w = (y @ share)[:, None]
        gram = x.T @ (w * x) + ridge * len(self.langs) * np.eye(x.shape[1])
        self.weights = root @ np.linalg.solve(gram, x.T @ (w * y))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (the best language's regression value, held to 0 to 1) of each text."""
        clean = [prepared(t) for t in texts]
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        some = [i for i, t in enumerate(clean) if t]
        if some and self.langs:
            values = self.kernel([ngrams(clean[i]) for i in some]) @ self.weights
            best = values.argmax(1)
            for i, b, v in zip(some, best, values):
                langs[i], scores[i] = self.langs[b], min(max(v[b], 0.0), 1.0)
        return langs, scores


def held_out(doc_id: str) -> Column:
    """The fold that is never learned from: CRC-32 of the id as text, modulo 4, is 2. Null ids are in it."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(True))


def fit_languages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    landmarks: int = LANDMARKS,
    training: int = TRAINING,
    ridge: float = RIDGE,
) -> LanguageModel:
    """Fit on a bounded sample of the rows outside the held-out fold with a language and a letter.

    For each language the rows with the smallest hashes of their id are taken:
    about ``training`` of them, of which about ``landmarks`` are landmarks.
    Only n-gram sets of landmarks and kernel values of training texts come to
    the driver. Without such rows the model predicts ``und``.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(~held_out("id") & F.col("lang").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel.of_landmarks([])
    # The share of a language's rows that makes the sample: no sort, no group in one task.
    share = F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, min(1.0, training / n))])
    place = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.withColumn("share", F.element_at(share, F.col("lang"))).withColumn("place", place).where("place < share")
    mark = F.col("place") < F.col("share") * F.lit(landmarks / training)
    few = [c for c, n in counts.items() if n <= training]  # their landmarks are a share of all their rows
    if few:
        part = F.create_map(*[F.lit(x) for c in few for x in (c, min(1.0, landmarks / counts[c]))])
        mark = F.when(F.col("lang").isin(few), F.col("place") < F.element_at(part, F.col("lang"))).otherwise(mark)
    sample = sample.select("lang", "text", mark.alias("mark"))

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for c, t in zip(f["lang"], map(prepared, f["text"])):
                if t:
                    yield pd.DataFrame({"lang": [c], "grams": [ngrams(t).view(np.int64)]})

    marks = sample.where("mark").select("lang", "text").mapInPandas(sets, "lang string, grams array<long>").collect()
    found = sorted((r.lang, tuple(r.grams)) for r in marks)
    model = LanguageModel.of_landmarks([np.array(g, np.int64).view(np.uint64) for _, g in found])
    if not found:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernels(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            clean = [(c, t) for c, t in zip(f["lang"], map(prepared, f["text"])) if t]
            if clean:
                k = shared.value.kernel([ngrams(t) for _, t in clean])
                yield pd.DataFrame({"lang": [c for c, _ in clean], "k": list(k)})

    train = sample.select("lang", "text").mapInPandas(kernels, "lang string, k array<double>").collect()
    train = sorted((r.lang, tuple(r.k)) for r in train)
    among = model.kernel([model.grams[model.presence[:, j] > 0] for j in range(model.presence.shape[1])])
    model.fit(np.array([k for _, k in train]), [c for c, _ in train], among, ridge)
    return model


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of each whole text; only the text is read.

    A null text or one without a letter is ``und`` with score 0. Columns of
    these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def predict(s: pd.Series) -> pd.DataFrame:
        langs, scores = shared.value.predict(s.tolist())
        return pd.DataFrame({"lang": langs, "score": scores})

    out = docs.withColumn("_predicted", predict(F.col(text)))
    return out.withColumns({"lang_pred": F.col("_predicted.lang"), "score": F.col("_predicted.score")}).drop("_predicted")
