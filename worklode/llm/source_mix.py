"""Rates per document that bring the expected tokens of each domain to target weights.

The labelled table says of some documents which domain they are of; a classifier over their words gives every document
its domain posteriors, so a document belongs to several domains in part.  With n the tokens, p the posteriors and r the
rates, the expected tokens of domain k are the sum of r * n * p_k.  Rates of zero or more (and at most ``most`` if set) are
fitted by projected gradient steps on the squared distance of these totals from the targets, plus ``RIDGE`` times the
token-weighted squared distance of the rates from one.

A step needs no more than the K totals: all documents with equal posteriors have equal rates, and the rates of any document
follow from the totals of the steps so far.  So posteriors are rounded to ``1 / STEPS``, documents are counted by them
before anything is shuffled, and each step is one Spark job over these counts that returns K numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.llm.common import arrow_schema, cut_lineage, keep_rows, map_batches, map_rows, record_batch, words_of

SAMPLE = 3000  # labelled documents of a domain that the classifier is fitted on, about
WORDS = 256  # words it knows
STEPS = 1000
RIDGE = 0.001
ROUNDS = 100
_MARKS = bytes.maketrans(b".,;:!?\"'()", b" " * 10)
NEAR_ONE = 0.95  # rates of drawn documents that count as one
NEAR = 2e-5  # the fit ends when no total moves by more than this part of all tokens
SHARE = 50_000  # rows of counts that a task of a step takes, about


def terms(text: str | None) -> set[bytes]:
    """The distinct lowered words of a whole text, as they are and without the marks around and inside them."""
    if not text:
        return set()
    data = text.encode().lower()
    return set(data.split()) | set(data.translate(_MARKS).split())


@dataclass(frozen=True)
class Classifier:
    """Multinomial logistic regression on which known words a text has."""

    domains: tuple[str, ...]
    words: dict[bytes, int]
    weights: np.ndarray  # (word, domain)
    bias: np.ndarray

    def posteriors(self, text: str | None) -> np.ndarray:
        """In parts of ``STEPS``, adding up to it; largest remainders are rounded up, ties to the first domain."""
        known = self.words
        at = [i for w in terms(text) if (i := known.get(w)) is not None]
        z = self.bias + (self.weights[at].sum(axis=0) if at else 0.0)
        p = np.exp(z - z.max())
        p *= STEPS / p.sum()
        parts = np.floor(p).astype(np.int64)
        for k in np.argsort(parts - p, kind="stable")[: STEPS - parts.sum()]:
            parts[k] += 1
        return parts


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Learn from the documents that ``labelled`` (id, ``domain``) names, about ``SAMPLE`` of each domain by a hash of the id."""
    known = labelled.filter(F.col("domain").isin(domains)).groupBy(id_col).agg(F.min("domain").alias("domain"))
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    k = len(domains)
    if len(sizes) < 2:
        only = np.array([0.0 if d in sizes or not sizes else -50.0 for d in domains])
        return Classifier(tuple(domains), {}, np.zeros((0, k)), only)
    share = F.create_map(*[x for d, n in sizes.items() for x in (F.lit(d), F.lit(min(1.0, SAMPLE / n)))])
    part = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) / float(1 << 20)
    known = known.filter(part < share[F.col("domain")])
    rows = docs.select(id_col, text_col).join(F.broadcast(known), id_col)  # k * SAMPLE rows, about

    def distinct(columns):
        return [columns[1], [sorted(terms(t)) for t in columns[0]]]

    texts = cut_lineage(map_rows(rows.select(text_col, "domain"), distinct, "domain string, words array<binary>"))
    per = texts.select("domain", F.explode("words").alias("word")).groupBy("word").pivot("domain", domains).count().na.fill(0)
    total = {r["domain"]: r["count"] for r in texts.groupBy("domain").count().collect()}
    n = [total.get(d, 0) for d in domains]
    # The words whose share of documents differs most between a domain and the others, in bits.
    rates = [(F.col(f"`{d}`") + 0.5) / (n[i] + 1.0) for i, d in enumerate(domains)]
    others = [(sum(F.col(f"`{e}`") for e in domains if e != d) + 0.5) / (sum(n) - n[i] + 1.0) for i, d in enumerate(domains)]
    gain = [F.abs(a - b) * F.abs(F.log(a / b)) for a, b in zip(rates, others)]
    best = per.select("word", F.greatest(*gain).alias("gain")).orderBy(F.desc("gain"), "word").limit(WORDS)
    words = {bytes(r["word"]): i for i, r in enumerate(best.collect())}

    def reduce_(columns):
        return [columns[0], [[i for w in ws if (i := words.get(w)) is not None] for ws in columns[1]]]

    x = map_rows(texts, reduce_, "domain string, at array<int>").collect()
    x.sort(key=lambda r: (r["domain"], r["at"]))
    row = np.repeat(np.arange(len(x)), [len(r["at"]) for r in x])
    col = np.array([i for r in x for i in r["at"]], np.int64)
    y = np.zeros((len(x), k))
    y[np.arange(len(x)), [domains.index(r["domain"]) for r in x]] = 1
    # Each domain has the weight of its true share, whatever part of it was taken.
    weight = np.array([sizes[r["domain"]] / total[r["domain"]] for r in x])
    weight /= weight.sum()
    weights, bias = _regression(row, col, y, weight, len(words))
    return Classifier(tuple(domains), words, weights, bias)


def _regression(row, col, y, weight, m: int, rounds: int = 300, rate: float = 0.1, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Gradient descent with momentum estimates per weight (Adam)."""
    k = y.shape[1]
    w = np.zeros((m + 1, k))  # the last row is the bias
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.stack([np.bincount(row, w[col, d], len(y)) for d in range(k)], axis=1) + w[m]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        e = (p - y) * weight[:, None]
        g = np.concatenate([np.stack([np.bincount(col, e[row, d], m) for d in range(k)], axis=1), e.sum(axis=0)[None]])
        g[:m] += l2 * w[:m]
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w -= rate / (1 + t / 50) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-6)
    return w[:m], w[m]


def predict(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``n_tokens`` (words) and ``parts`` (posteriors by domain, in thousandths) of every whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # WORDS words and their weights

    def run(columns):
        return [columns[0], [len(words_of(t)) for t in columns[1]], [held.value.posteriors(t) for t in columns[1]]]

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), run, f"{id_col} {id_type}, n_tokens long, parts array<bigint>")


@dataclass(frozen=True)
class Rates:
    """Rates by posteriors: the projected gradient steps are taken again from the totals they were taken from."""

    targets: np.ndarray  # parts of all tokens
    most: float | None
    totals: tuple[np.ndarray, ...]  # of the looked-ahead rates of each step

    def steps(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates after all steps, and those looked ahead to for the next, for rows of posteriors."""
        rate = ahead = np.ones(len(p))
        t = 1.0
        for total in self.totals:
            slope = p @ (total - self.targets) + RIDGE * (ahead - 1)
            new = np.clip(ahead - slope / (1 + RIDGE), 0, self.most)
            after = (1 + np.sqrt(1 + 4 * t * t)) / 2
            rate, ahead, t = new, new + (t - 1) / after * (new - rate), after
        return rate, ahead


def fit_rates(predicted: DataFrame, targets: list[float], most: float | None = None) -> Rates:
    """Fit rates to ``targets``: the tokens wanted of each domain, as parts of all tokens there are."""
    counts = cut_lineage(predicted.filter("n_tokens > 0").groupBy("parts").agg(F.sum("n_tokens").alias("n")))
    rates = Rates(np.array(targets, float), most, ())
    tokens, size = counts.agg(F.sum("n"), F.count("*")).first()
    if not tokens:
        return rates
    # The steps are many and read little each: their tasks are as many as the rows ask for, not as the shuffle had.
    counts = cut_lineage(counts.coalesce(-(-size // SHARE)))
    schema = "ahead array<double>, now array<double>"
    arrow = arrow_schema(schema)
    for _ in range(ROUNDS):

        def sums(batches, rates=rates):
            for batch in batches:
                p = batch["parts"].flatten().to_numpy().astype(float).reshape(-1, len(targets)) / STEPS
                rate, ahead = rates.steps(p)
                n = batch["n"].to_numpy().astype(float) / tokens
                yield record_batch([[(n * ahead) @ p], [(n * rate) @ p]], arrow)

        rows = map_batches(counts, sums, schema)
        k = range(len(targets))
        total = rows.agg(*[F.sum(F.col(c)[i]).alias(f"{c}{i}") for c in ("ahead", "now") for i in k]).first()
        ahead = np.array([total[f"ahead{i}"] for i in k])
        last = rates.totals[-1] if rates.totals else None
        rates = Rates(rates.targets, most, (*rates.totals, ahead))
        if last is not None and np.abs(ahead - last).max() < NEAR:
            break
    return rates


def mix(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], most: float | None = None, budget: float = 1.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Posteriors, rate and number of copies of every document, for the given weights of the domains.

    ``labelled`` has the id and a ``domain``; domains outside ``weights`` are left out.  The tokens wanted of a domain are its
    share of the weights times ``budget`` times all tokens.  Columns: the id, ``n_tokens``, ``domain`` (the likeliest),
    ``posteriors`` (map), ``rate``, ``copies`` (the rate rounded up or down, by a hash of the id, so that it holds on
    average).  A null or blank text has no tokens and the classifier's prior.  One row per row of ``docs``; an empty table
    gives an empty result; without labels the posteriors are equal and the rates the same for all.
    """
    domains, held, rates = _fitted(docs, labelled, weights, most, budget, id_col, text_col)

    def run(columns):
        p = np.array(columns[2], float).reshape(len(columns[2]), -1) / STEPS
        best = [domains[i] for i in p.argmax(axis=1)]
        return [columns[0], columns[1], best, [list(zip(domains, x)) for x in p.tolist()], rates.steps(p)[0]]

    id_type = docs.schema[id_col].dataType.simpleString()
    out = map_rows(held, run, f"{id_col} {id_type}, n_tokens long, domain string, posteriors map<string,double>, rate double")
    return out.withColumn("copies", copies(F.col("rate"), F.col(id_col)))


def copies(rate: Column, id_: Column) -> Column:
    luck = F.pmod(F.xxhash64(id_, F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + luck).cast("long")


def _fitted(docs, labelled, weights, most, budget, id_col, text_col) -> tuple[list[str], DataFrame, Rates]:
    domains = sorted(weights)
    model = fit_classifier(docs, labelled, domains, id_col, text_col)
    predicted = cut_lineage(predict(docs, model, id_col, text_col))
    total = sum(weights.values())
    return domains, predicted, fit_rates(predicted, [budget * weights[d] / total for d in domains], most)


def keep_mixed(
    docs: DataFrame, labelled: DataFrame, shares: dict[str, float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` drawn at rates of at most one, with all their columns, none twice.

    ``shares`` are parts of the tokens that are there of each domain: one keeps all, zero none.  What a document without
    words has in rates does not matter: it stays.
    """
    domains = sorted(shares)
    model = fit_classifier(docs, labelled, domains, id_col, text_col)
    predicted = cut_lineage(predict(docs, model, id_col, text_col))
    now = predicted.agg(F.sum("n_tokens"), *[F.sum(F.col("parts")[i] * F.col("n_tokens")) for i in range(len(domains))]).first()
    if not now[0]:
        return docs
    targets = [shares[d] * float(now[i + 1]) / STEPS / now[0] for i, d in enumerate(domains)]
    rates = fit_rates(predicted, targets, 1.0)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def drawn(columns):
        ids, texts = columns
        p = np.array([held.value.posteriors(t) for t in texts], float).reshape(len(texts), -1) / STEPS
        rate = rates.steps(p)[0]
        return [not t or not t.strip() or r > NEAR_ONE or _luck(i) < r for i, t, r in zip(ids, texts, rate)]

    return keep_rows(docs, [id_col, text_col], drawn)


def _luck(id_) -> float:
    return xxhash.xxh64_intdigest(repr(id_).encode(), 42) / 2.0**64


def label_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The domain of each labelled document: toxic, else good or poor by its quality; none if the labels are null."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select(id_col, domain.alias("domain")).filter("domain is not null")


