"""Personal data in texts: base patterns, and further spans that weak labelers, weighed by expectation-maximisation, teach a classifier."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklode.llm.common import map_rows, written

KINDS = ("email", "ip", "card", "phone")
#: Distinct candidates of a kind, with their counts, that the classifier is fitted on: all if there are no more, else about so
#: many, a share of their hashes.
SAMPLE = 20_000
#: Hashed features of a kind.
FEATURES = 512
#: Characters around a candidate that the context labelers look at.
NEAR = 48

# The base patterns of the contract, written so that no text takes more than linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# What else may be one: written apart, with words for signs, without a plus, in the longer form of addresses.
AT = re.compile(r"\s?[\[({<]\s?(?:at|AT|@)\s?[\])}>]\s?|\s(?:at|AT|@)\s")
DOTTED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s)[A-Za-z0-9-]{1,63})+")
SIX = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4})(?::[0-9A-Fa-f]{1,4}){0,5}(?![0-9A-Za-z:])")
SPREAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?[\[({]\s?(?:\.|dot)\s?[\])}]\s?[0-9]{1,3}){3}(?![0-9])")
LONG = re.compile(r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])|(?<![0-9A-Za-z.])[0-9]{4}(?:[ ._/ –-]{1,2}[0-9]{4,6}){2,3}(?![0-9A-Za-z])")
CALL = re.compile(r"(?<![0-9A-Za-z+.])(?:00[1-9][0-9]?(?:[ ./()-]{0,2}[0-9]{2,5}){2,4}|\(0?[0-9]{2,4}\) ?[0-9]{3,4}[ .-]?[0-9]{3,5}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])")

# Gazetteers.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io ai app dev de fr es it uk us eu ch at nl be pl pt se no dk fi ie br mx jp cn in ru au ca".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "351", "352", "353", "358", "420", "421")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "35", "6011", "65", "22", "23", "24", "25", "26", "27")
CUES = {
    "email": "mail email e-mail contact write reach correo courriel kontakt send address",
    "ip": "ip host server address addr client node dns login from remote",
    "card": "card credit debit visa mastercard amex payment pay karte carte tarjeta number",
    "phone": "phone tel telephone call mobile cell fax whatsapp dial telefon téléphone teléfono",
}
CUE_WORDS = {kind: frozenset(words.split()) for kind, words in CUES.items()}
OTHER_WORDS = frozenset("version ver release isbn issn order invoice id sku ref serial part item token hash key commit build section figure page chapter".split())
WORD = re.compile(r"[^\W\d_][\w-]*")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), leftmost and non-overlapping per kind, by kind and start."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start, end = at, None
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            end = last = found.end()
            out.append((0, start, end))
        at = text.find("@", end or at + 1)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def wide_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans that may be personal data, beside the base ones; per kind non-overlapping."""
    out, last = [], 0
    for m in AT.finditer(text):
        start = m.start()
        while start > max(last, m.start() - 64) and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start() and (found := DOTTED.match(text, m.end())):
            last = found.end()
            out.append((0, start, last))
    out += [(1, *m.span()) for p in (SIX, SPREAD) for m in p.finditer(text)]
    out += [(2, *m.span()) for m in LONG.finditer(text) if 13 <= len(_digits(m.group())) <= 19]
    out += [(3, *m.span()) for m in CALL.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# Labelers -----------------------------------------------------------------------------------------


def _shape(kind: int, s: str) -> int:
    """Regex labeler: is it written in a usual form?"""
    if kind == 0:
        return 1 if "@" in s and " " not in s or re.search(r"[\[({<]\s?(?:at|AT|@)", s) or re.search(r"[\[({<\s](?:dot|DOT)", s) else -1
    if kind == 1:
        return 1 if s.count(".") == 3 or s.count(":") == 7 or "::" in s else -1
    if kind == 2:
        return 1 if re.fullmatch(r"[0-9]{13,19}|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", s) else -1
    return 1 if re.search(r"^\+|^00|\)", s) or re.fullmatch(r"[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}", s) else -1


def _checks(kind: int, s: str) -> int:
    """Regex labeler: do its numbers add up?"""
    d = _digits(s)
    if kind == 0:
        return 1 if re.search(r"[A-Za-z]{2,10}$", s) else -1
    if kind == 1:
        return 1 if ":" in s or all(int(p) <= 255 for p in re.findall(r"[0-9]+", s) if len(p) < 5) else -1
    if kind == 2:
        return 1 if luhn(d) else -1
    return 1 if 10 <= len(d.lstrip("0")) <= 13 else -1


def _gazetteer(kind: int, s: str) -> int:
    d = _digits(s)
    if kind == 0:
        return 1 if re.split(r"[^A-Za-z0-9]+", s)[-1].lower() in TOP_DOMAINS else -1
    if kind == 1:
        return 0 if ":" in s else 1 if 1 <= int(d and re.match(r"[0-9]{1,3}", s).group()) <= 223 else -1
    if kind == 2:
        return 1 if d.startswith(ISSUERS) else -1
    return 1 if d.lstrip("0").startswith(CALLING_CODES) else 0


def _cue(kind: int, before: list[str]) -> int:
    """Context labeler: words before it that go with this kind, or with other numbers."""
    near = before[-4:]
    return 1 if any(w in CUE_WORDS[KINDS[kind]] for w in near) else -1 if any(w in OTHER_WORDS for w in near) else 0


def _apart(kind: int, left: str, right: str) -> int:
    """Context labeler: does it stand by itself?"""
    return -1 if left[-1:].isalnum() or right[:1].isalnum() or left[-1:] in ("_", "#", "=", "$") or right[:1] == "_" else 0


def _company(kind: int, others: int) -> int:
    """Context labeler: other personal data in the text."""
    return 1 if others else 0


LABELERS = 6


def _votes(votes: list[int]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v + 1
    return code


def described(text: str, base: list, wide: list) -> list[dict]:
    """All candidates of a text, by kind and start, with their votes and hashed features; wide ones that touch a base one are left out."""
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken])
    tops = np.maximum.accumulate([e for _, e in taken]) if taken else starts
    kept = []
    for span in wide:
        k = int(np.searchsorted(starts, span[2])) - 1 if taken else -1
        if k < 0 or tops[k] <= span[1]:
            kept.append(span)
    out = []
    for known, (kind, start, end) in [*((True, s) for s in base), *((False, s) for s in kept)]:
        s, left, right = text[start:end], text[max(0, start - NEAR) : start], text[end : end + NEAR]
        before = [w.lower() for w in WORD.findall(left)]
        after = WORD.search(right)
        votes = [_shape(kind, s), _checks(kind, s), _gazetteer(kind, s), _cue(kind, before), _apart(kind, left, right), _company(kind, len(base) - known)]
        form = re.sub(r"[A-Z]+", "A", re.sub(r"[a-z]+", "a", re.sub(r"[0-9]", "9", s)))[:40]
        names = [f"form {form}", f"length {min(len(s), 40)}", f"before {before[-1] if before else ''}", f"after {after.group().lower() if after else ''}"]
        names += [f"vote {i} {v}" for i, v in enumerate(votes)]
        marks = sorted({zlib.crc32(n.encode()) % FEATURES for n in names})
        out.append({"kind": kind, "start": start, "end": end, "base": known, "votes": _votes(votes), "features": marks})
    out.sort(key=lambda c: (c["kind"], c["start"]))
    return out


# Model --------------------------------------------------------------------------------------------


def posteriors(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Chance that each pattern of votes (rows of -1, 0, 1) is of personal data, by expectation-maximisation.

    Two classes and, for each labeler, the chances of its three votes in each; votes are independent given the class.  Pseudo-
    counts that take a labeler for right in seven of ten cases keep the classes from changing places and rule nothing out.
    """
    onehot = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)  # pattern, labeler, vote
    right = np.array([[4.0, 3.0, 1.7], [1.7, 3.0, 4.0]])  # for the classes no and yes
    post = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))
    for _ in range(rounds):
        shares = np.stack([(1 - post) * counts, post * counts])
        chances = np.einsum("cp,plv->clv", shares, onehot) + right[:, None, :]
        chances /= chances.sum(axis=2, keepdims=True)
        prior = (shares.sum(axis=1) + 2) / (counts.sum() + 4)
        logs = np.einsum("plv,clv->pc", onehot, np.log(chances)) + np.log(prior)
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if np.abs(new - post).max() < 1e-9:
            return new
        post = new
    return post


def logistic(features: list, targets: np.ndarray, weights: np.ndarray, rounds: int = 20, ridge: float = 1.0) -> np.ndarray:
    """Weights of FEATURES and a constant, by Newton steps on soft targets."""
    x = np.zeros((len(features), FEATURES + 1))
    for i, marks in enumerate(features):
        x[i, marks] = 1
    x[:, -1] = 1
    w = np.zeros(FEATURES + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (targets - p)) - ridge * w
        step = np.linalg.solve((x.T * (weights * p * (1 - p))) @ x + ridge * np.eye(len(w)), slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Detector:
    """Per kind: the classifier's weights, and the labelers' reliabilities as (pattern of votes: chance)."""

    weights: dict[int, np.ndarray] = field(default_factory=dict)
    chances: dict[int, dict[int, float]] = field(default_factory=dict)

    def chance(self, kind: int, features: list[int]) -> float:
        w = self.weights.get(kind)
        return 0.0 if w is None else float(1 / (1 + np.exp(-np.clip(w[features].sum() + w[-1], -30, 30))))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``spans`` (kind, start, end, base, votes, features) of every whole text; each text is read once."""

    def run(columns):
        out = []
        for text in columns[1]:
            text = text or ""
            base = base_spans(text)
            wide = wide_spans(text)
            out.append(described(text, base, wide) if base or wide else [])
        return [columns[0], out]

    id_type = docs.schema[id_col].dataType.simpleString()
    span = "struct<kind:int,start:int,end:int,base:boolean,votes:int,features:array<int>>"
    return map_rows(docs.select(id_col, text_col), run, f"{id_col} {id_type}, spans array<{span}>")


def fit(found: DataFrame, sample: int = SAMPLE) -> Detector:
    """Reliabilities from the votes on all candidates of :func:`candidates`, and a classifier per kind.

    Votes are counted by pattern, of which there are at most 3 ** LABELERS per kind.  The classifier sees each distinct
    candidate once with its count, so that copies of a text take no more room; of a kind with more than ``sample`` of them
    it sees those whose hash is in the lowest ``sample / number`` of all hashes, which needs no order over a kind.
    """
    spans = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features")
    counted = written(spans.groupBy("kind", "votes", "features").count())
    patterns = counted.groupBy("kind", "votes").agg(F.sum("count").alias("n")).orderBy("kind", "votes").collect()
    numbers = counted.groupBy("kind").agg(F.count("*").alias("n")).collect()
    shares = F.create_map(*[F.lit(x) for r in numbers for x in (r["kind"], min(1.0, sample / r["n"]))])
    luck = F.pmod(F.xxhash64("votes", "features"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    kept = counted.filter(luck < shares[F.col("kind")]).collect() if numbers else []
    kept.sort(key=lambda r: (r["votes"], r["features"]))
    weights, chances = {}, {}
    for kind in sorted({r["kind"] for r in patterns}):
        codes = [r["votes"] for r in patterns if r["kind"] == kind]
        counts = np.array([r["n"] for r in patterns if r["kind"] == kind], float)
        votes = np.array([[c // 3**i % 3 - 1 for i in reversed(range(LABELERS))] for c in codes])
        chances[kind] = dict(zip(codes, posteriors(votes, counts).tolist()))
        rows = [r for r in kept if r["kind"] == kind]
        targets = np.array([chances[kind][r["votes"]] for r in rows])
        weights[kind] = logistic([r["features"] for r in rows], targets, np.log1p([float(r["count"]) for r in rows]))
    return Detector(weights, chances)


def detect(found: DataFrame, model: Detector, id_col: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """Spans of every document of :func:`candidates`: the id, ``base`` and ``spans``, arrays of (kind, start, end) by kind as in
    KINDS, then start; ``spans`` holds all of ``base`` and the candidates that the classifier takes at ``threshold``, likelier
    ones first where two of them overlap."""
    held = found.sparkSession.sparkContext.broadcast(model)  # FEATURES weights per kind

    def run(columns):
        m, base, spans = held.value, [], []
        for listed in columns[1]:
            known = [(s["kind"], s["start"], s["end"]) for s in listed if s["base"]]
            more = [(-p, s["start"], s["end"], s["kind"]) for s in listed if not s["base"] and (p := m.chance(s["kind"], s["features"])) >= threshold]
            taken: list[tuple[int, int, int]] = []
            for _, start, end, kind in sorted(more):
                if all(end <= a or b <= start for _, a, b in taken):
                    taken.append((kind, start, end))
            base.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in known])
            spans.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(known + taken)])
        return [columns[0], base, spans]

    id_type = found.schema[id_col].dataType.simpleString()
    span = "array<struct<kind:string,start:int,end:int>>"
    return map_rows(found.select(id_col, "spans"), run, f"{id_col} {id_type}, base {span}, spans {span}")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``, as :func:`detect` gives them, with a detector fitted on all of ``docs``.

    A null or empty text has no spans; ids may be null or repeat, equal texts have equal spans; other columns do not matter;
    an empty table gives an empty result.  Offsets are code points, the end exclusive.
    """
    found = written(candidates(docs, id_col, text_col))
    return detect(found, fit(found, sample), id_col, threshold)


def digests(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind and digest of the base spans, and all spans as text."""

    def joined(name: str):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def counted(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(counted, KINDS)
    return spans.select(id_col, *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


__all__ = ["Detector", "base_spans", "candidates", "detect", "digests", "find_personal_data", "fit", "posteriors", "wide_spans"]
