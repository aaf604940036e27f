"""Language of whole texts by the nearest of several centroids per language.

A text becomes a vector of letter n-grams (three bytes of its lowered letters, words set apart by single spaces), hashed
to ``DIMENSIONS``, weighted by (1 + log count) * idf and brought to length one.  Each language of the training rows gets
``CENTROIDS`` centroids by spherical k-means over a bounded sample of its rows.  A text takes the language of the centroid
with the largest cosine; it is rejected if that cosine is far below what training texts of its length have.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.llm.common import cut_lineage, keep_rows, map_rows, reachable

DIMENSIONS = 4096
CENTROIDS = 4
PER_LANGUAGE = 1500  # training rows of a language, about
ROUNDS = 12
MARGIN = 0.5  # rejected: a cosine below this part of what all but QUANTILE of the training texts of that length have
QUANTILE = 0.01
UNKNOWN = "und"
PIECE = 1 << 20  # bytes whose n-grams are counted at once
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Dimensions and counts of the n-grams of a whole text; None if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    data = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    counts = np.zeros(DIMENSIONS, np.int64)
    for start in range(0, len(data) - 2, PIECE):
        a = np.frombuffer(data, np.uint8, min(PIECE + 2, len(data) - start), start).astype(np.uint32)
        code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
        counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def length_class(n: int) -> int:
    """Texts are compared with training texts of like length: powers of two of n-grams."""
    return min(int(n).bit_length(), 14)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray  # (dimension, centroid)
    idf: np.ndarray
    least: np.ndarray  # smallest cosine that is not rejected, by length class

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine in 0 to 1, rejected."""
        found = grams(text)
        if found is None or not self.languages:
            return UNKNOWN, 0.0, True
        at, counts = found
        weights = (1 + np.log(counts)) * self.idf[at]
        norm = float(np.sqrt(weights @ weights))
        cosines = (weights @ self.centroids[at]) / norm if norm else np.zeros(len(self.languages))
        best = int(cosines.argmax())
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[best], score, score < self.least[length_class(counts.sum())]


def _vector(at, counts, idf: np.ndarray) -> np.ndarray:
    v = np.zeros(DIMENSIONS, np.float32)
    v[at] = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt(v @ v)
    return v / norm if norm else v


def cluster_centroids(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; starts from vectors that are far from those taken before, so the result is fixed."""
    mean = vectors.mean(axis=0)
    first = int((vectors @ mean).argmax())
    taken, nearest = [first], vectors @ vectors[first]
    while len(taken) < min(k, len(vectors)):
        taken.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[taken[-1]])
    centroids = vectors[taken]
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[own == c].sum(axis=0) if (own == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows of ``docs`` that have a text and a language.

    About ``per_language`` rows of each language are taken, by a hash of the text, so that the sample is the same for any
    order or partitioning of the rows.  What reaches the driver has a size given by the number of languages: their
    counts, their centroids, and the document counts of the n-gram dimensions.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    empty = Model((), np.zeros((DIMENSIONS, 0), np.float32), np.ones(DIMENSIONS), np.zeros(16))
    if not sizes:
        return empty
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(part < share[F.col("lang")])

    def count(columns):
        found = [(lang, g) for text, lang in zip(*columns) if (g := grams(text)) is not None]
        return [[lang for lang, _ in found], [g[0] for _, g in found], [g[1] for _, g in found]]

    vectors = cut_lineage(map_rows(sample, count, "lang string, at array<int>, counts array<bigint>"))
    found = vectors.select(F.explode("at").alias("at")).groupBy("at").count().collect()
    total = vectors.count()
    if not total:
        return empty
    df = np.zeros(DIMENSIONS)
    for r in found:
        df[r["at"]] = r["count"]
    idf = np.log((total + 1) / (df + 1)) + 0.1

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([_vector(a, c, idf) for a, c in zip(rows["at"], rows["counts"])])
        centroids = cluster_centroids(x, CENTROIDS)
        cosines = (x @ centroids.T).max(axis=1)
        classes = np.array([length_class(sum(c)) for c in rows["counts"]])
        low = [float(np.quantile(cosines[classes == k], QUANTILE)) if (classes == k).any() else None for k in range(16)]
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": list(centroids), "low": [low] * len(centroids)})

    trained = reachable(vectors).groupBy("lang").applyInPandas(train, "lang string, centroid array<float>, low array<double>")
    rows_ = sorted(trained.collect(), key=lambda r: (r["lang"], r["centroid"]))
    least = np.zeros(16)
    for k in range(16):
        seen = [r["low"][k] for r in rows_ if r["low"][k] is not None]
        least[k] = MARGIN * min(seen) if seen else (least[k - 1] if k else 0.0)
    return Model(tuple(r["lang"] for r in rows_), np.array([r["centroid"] for r in rows_], np.float32).T.copy(), idf, least)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id, ``lang_pred``, ``score`` (cosine, 0 to 1), ``rejected``; one row per row of ``docs``.

    A text that is null, empty or without letters is ``und`` with score 0 and rejected; so is every text if nothing was
    learned.  Equal cosines go to the language that sorts first.  Only the text is looked at.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few centroids per language

    def run(columns):
        langs, scores, rejected = zip(*map(held.value.predict, columns[1]))
        return [columns[0], langs, scores, list(map(bool, rejected))]

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), run, f"{id_col} {id_type}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text is not rejected, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, [text_col], lambda columns: [not held.value.predict(t)[2] for t in columns[0]])


def training_rows(rest: Column) -> Column:
    """The rows the registered query learns from: all but a third, told by their id."""
    return rest != 1
