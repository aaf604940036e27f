"""Quality rules and an isolation forest over the statistics of the rules.

Each whole text gets the counts of the rules.  A forest of random splits is grown over the statistics (shares of the
counts) of a bounded sample of labelled rows; a document that few splits set apart from the others is an anomaly.  The
sample's labels choose the statistics (those that tell good from bad at all; others only add rare but harmless values) and
the size of a tree.  How short a mean path may be is calibrated on all labelled rows: the threshold that misjudges fewest
of them, among those that reject at most ``MOST_GOOD_LOST`` of the good ones.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklode.llm.common import cut_lineage, keep_rows, map_rows

TREES = 200
SUBSAMPLES = (32, 64, 128, 256)  # rows a tree is grown from; the labels choose
SEPARATES = 0.1  # statistics used: a good and a bad row come in one order this much more often than in half the cases
SAMPLE = 20_000  # labelled rows the trees draw from, about, if there are more
MOST_GOOD_LOST = 0.01
BINS = 1000
#: The characters counted as symbols, the least words, the largest share of repeated words in percent.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?.,;:'\"()[]{}-_/\\\\=+@^~`"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["word_length", "symbols", "dup_lines", "repeated", "upper", "digits", "marks", "variety", "line_words"]


def _without(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    n, covered = 0, 0  # covered: words up to here are counted
    for i, w in enumerate(windows):
        if counts[w] > 1:
            n += i + 3 - max(covered, i)
            covered = i + 3
    return n


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts and the features of one whole text."""
    data = text.encode() if text else b""
    words = data.split()
    joined = b"".join(words)
    chars = len(joined) if data.isascii() else len(joined.decode())
    lines = [x for x in data.split(b"\n") if x.strip()]
    duplicates = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    symbols = _without(data, SYMBOLS)
    n, c = max(len(words), 1), max(chars, 1)
    features = [
        chars / n, symbols / c, duplicates / max(len(lines), 1), repeated / n, _without(joined, _UPPER) / c,
        _without(joined, _DIGITS) / c, _without(joined, _MARKS) / c,
        float(np.log1p(len(set(words))) / np.log1p(n)), float(np.log1p(n / max(len(lines), 1))),
    ]
    return [len(words), chars, symbols, duplicates, repeated], features


def base_failed(counts: list[int]) -> bool:
    return counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]


def mean_path(n: np.ndarray | float) -> np.ndarray | float:
    """Mean path length of an unsuccessful search among n points."""
    n = np.maximum(n, 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays (tree, node): feature (-1: leaf), split value, left child (the right one is next), path length."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    scale: float
    used: tuple[int, ...]  # the features that the trees know
    threshold: float = 1.0  # anomalies from it on are rejected

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length) of each row: near 1 for anomalies."""
        x = x[:, self.used]
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[trees, node]
            if (f < 0).all():
                break
            right = x[rows, np.maximum(f, 0)] >= self.value[trees, node]
            node = np.where(f < 0, node, self.left[trees, node] + right)
        return 2.0 ** (-self.path[trees, node].mean(axis=1) / self.scale)


def grow(x: np.ndarray, subsample: int, used: tuple[int, ...] | None = None, trees: int = TREES, seed: int = 1) -> Forest:
    """Isolation trees over random subsamples of ``x``, with random features and random split values."""
    rng, used = np.random.default_rng(seed), tuple(range(x.shape[1])) if used is None else used
    x = x[:, used]
    size = min(subsample, len(x))
    limit = int(np.ceil(np.log2(max(size, 2))))
    most = 2 ** (limit + 1)
    feature, left = np.full((trees, most), -1), np.zeros((trees, most), np.int64)
    value, path = np.zeros((trees, most)), np.zeros((trees, most))
    for t in range(trees):
        open_, free = [(0, x[rng.choice(len(x), size, replace=False)], 0)], 1
        while open_:
            node, rows, depth = open_.pop()
            usable = np.flatnonzero(rows.min(axis=0) < rows.max(axis=0)) if len(rows) > 1 and depth < limit else ()
            if not len(usable):
                path[t, node] = depth + float(mean_path(float(len(rows))))
                continue
            f = int(rng.choice(usable))
            v = rng.uniform(rows[:, f].min(), rows[:, f].max())
            below = rows[:, f] < v
            feature[t, node], value[t, node], left[t, node] = f, v, free
            open_ += [(free, rows[below], depth + 1), (free + 1, rows[~below], depth + 1)]
            free += 2
    return Forest(feature, value, left, path, float(max(mean_path(float(size)), 1e-9)), used)


def ranks(x: np.ndarray) -> np.ndarray:
    """Ranks from 1, equal values sharing their mean rank."""
    _, at, n = np.unique(x, return_inverse=True, return_counts=True)
    return (np.cumsum(n) - (n - 1) / 2)[at]


def separation(x: np.ndarray, good: np.ndarray) -> float:
    """How much more often than in half the cases a good and a bad row come in one order."""
    n, m = good.sum(), (~good).sum()
    return abs((ranks(x)[~good].sum() - m * (m + 1) / 2) / (n * m) - 0.5) if n and m else 0.0


def cut(good: np.ndarray, bad: np.ndarray) -> tuple[int, float]:
    """From which bin on to reject, and how many rows that misjudges; counts of good and bad rows by bin of anomaly."""
    lost = np.append(good[::-1].cumsum()[::-1], 0)
    wrong = lost + np.concatenate([[0], bad.cumsum()])
    wrong = np.where(lost > MOST_GOOD_LOST * good.sum(), np.inf, wrong)
    k = int(np.argmin(wrong))
    return k, float(wrong[k])


def bins(anomaly: np.ndarray) -> np.ndarray:
    return np.minimum(anomaly * BINS, BINS - 1).astype(int)


def best_forest(x: np.ndarray, good: np.ndarray) -> Forest:
    """The forest whose size of tree misjudges fewest of the rows it was grown from."""
    used = tuple(k for k in range(x.shape[1]) if separation(x[:, k], good) > SEPARATES) or tuple(range(x.shape[1]))
    found = []
    for size in SUBSAMPLES:
        forest = grow(x, size, used)
        at = bins(forest.anomaly(x))
        found.append((cut(*(np.bincount(at[g], minlength=BINS) for g in (good, ~good)))[1], size, forest))
    return min(found, key=lambda f: f[:2])[2]


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, the rule counts, ``base_failed`` and ``features`` of every whole text; a null text has no words."""

    def run(columns):
        found = [statistics(t) for t in columns[1]]
        counts = [[f[0][k] for f in found] for k in range(len(COUNTS))]
        return [columns[0], *counts, [base_failed(f[0]) for f in found], [f[1] for f in found]]

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, features array<double>"
    return map_rows(docs.select(id_col, text_col), run, schema)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Forest:
    """Grow the forest and calibrate its threshold from the labelled rows of ``stats`` that pass the base rules.

    The forest is grown from about ``SAMPLE`` of them, taken by a hash of the row, so that no more is collected.  The threshold is calibrated on all
    of them, from counts by anomaly in ``BINS`` bins.  Without rows of both labels nothing is rejected.
    """
    known = labels.select(id_col, F.col(label_col).alias("_good")).filter("_good is not null").groupBy(id_col).agg(F.max("_good").alias("_good"))
    rows = stats.filter(~F.col("base_failed")).select(id_col, "features").join(known, id_col)
    rows = cut_lineage(rows.select(id_col, "features", F.col("_good").cast("int").alias("good")))
    share = SAMPLE / max(rows.count(), SAMPLE)
    luck = F.pmod(F.xxhash64(F.col(id_col), F.col("features")), F.lit(1 << 30)) / float(1 << 30)
    sample = sorted(rows.filter(luck < share).select("features", "good").collect())
    if not sample:
        return grow(np.zeros((1, len(FEATURES))), 1, trees=1)
    forest = best_forest(np.array([r[0] for r in sample]), np.array([bool(r[1]) for r in sample]))

    def score(columns):
        return [bins(forest.anomaly(np.array(columns[0]))), columns[1]]

    counts = map_rows(rows.select("features", "good"), score, "bin int, good int").groupBy("bin", "good").count()
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for r in counts.collect():  # BINS rows for each label
        (good if r["good"] else bad)[r["bin"]] += r["count"]
    if not good.sum() or not bad.sum():
        return forest
    return replace(forest, threshold=cut(good, bad)[0] / BINS)


def judge(stats: DataFrame, forest: Forest, id_col: str = "doc_id") -> DataFrame:
    """``stats`` with ``anomaly`` and ``kept``: passes the base rules and is no anomaly."""
    held = stats.sparkSession.sparkContext.broadcast(forest)
    names = [id_col, *COUNTS, "base_failed", "features"]

    def run(columns):
        anomaly = held.value.anomaly(np.array(columns[-1]))
        kept = [not failed and a < held.value.threshold for failed, a in zip(columns[-2], anomaly)]
        return [*columns[:-1], anomaly, kept]

    id_type = stats.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, anomaly double, kept boolean"
    return map_rows(stats.select(*names), run, schema)


def assess(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """Counts, ``base_failed``, ``anomaly`` and ``kept`` of every document; one row per row of ``docs``.

    Null, empty and blank texts have no words and fail the base rules.  Labels of unknown documents and null labels are
    left out; of several labels of an id the best counts.  Empty tables give an empty result or a forest that rejects nothing.
    """
    stats = cut_lineage(rule_statistics(docs, id_col, text_col))
    return judge(stats, fit(stats, labels, id_col, label_col), id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The statistics are made twice, for the fit and for the verdict, so that no text has to be shuffled.
    """
    stats = cut_lineage(rule_statistics(docs, id_col, text_col))
    held = docs.sparkSession.sparkContext.broadcast(fit(stats, labels, id_col, label_col))

    def good(columns):
        found = [statistics(t) for t in columns[0]]
        anomaly = held.value.anomaly(np.array([f[1] for f in found]))
        return [not base_failed(f[0]) and bool(a < held.value.threshold) for f, a in zip(found, anomaly)]

    return keep_rows(docs, [text_col], good)
