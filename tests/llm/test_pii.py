"""Personal data: base spans against plain patterns, further spans on planted ones."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from worklode.llm import pii
from worklode.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            s = m.group()
            digits = re.sub(r"[^0-9]", "", s)
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            good = [True, all(int(p) <= 255 for p in s.split(".")) if kind == 1 else True, 13 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0, 9 <= len(digits) <= 15][kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text("ab1234567890..@@--_%+ ()é\n", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["x@y.z_a@b.c", "a@b@c.de", "1.2.3.4.5.6.7.8", "999.1.1.1.1", "+1 (017) 555-7713.", "4111 1111 1111 1111 1", "a@b..c@d.e", "+12+345678901 2", "0001.02.3.4"])
def test_corners(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1 " * 200_000, "1." * 200_000, "+1" * 200_000, "a@" * 200_000, "@" * 400_000, "a:" * 200_000, "(1)" * 130_000, " at " * 100_000, "a at b." * 60_000])
def test_long_texts_take_linear_time(text):
    pii.described(text, pii.base_spans(text), pii.wide_spans(text)[:1000])


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_pii"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = plain(texts[r["doc_id"]] or "")
        named = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in spans) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r["spans"].split(","))


def planted(n=300):
    """(texts, spans that base patterns do not know, spans of decoys) drawn at random."""
    rng, rows = random.Random(3), []

    def card(valid):
        while True:
            d = rng.choice("45") + "".join(rng.choice("0123456789") for _ in range(15))
            if pii.luhn(d) == valid:
                return d

    for i in range(n):
        words = [rng.choice("the of and house tree water runs green old time".split()) for _ in range(60)]
        a, b = f"{rng.randint(200, 989)}", f"{rng.randint(1000, 9999)}"
        name, host = rng.choice(["ann", "bob.lee", "kim7"]), rng.choice(["mail", "example", "corp"])
        good = rng.choice([f"{name} [at] {host} [dot] com", f"{name}(at){host}(dot)org", f"phone ({a}) 555-{b}", f"call {a}-555-{b}", f"card {'.'.join(re.findall('....', card(True)))}"])
        bad = rng.choice([f"order {card(False)}", f"id {card(False)}", "look at home.then", f"part {a}.{b[:2]}", f"version 1.2.{b}"])
        known = rng.choice([f"mail {name}@{host}.com", f"+1 ({a}) 555-{b}", f"{rng.randint(1, 220)}.8.8.{rng.randint(0, 255)}", card(True), ""])
        words[10], words[30], words[50] = good, bad, known
        rows.append((i, " ".join(words), good.removeprefix("phone ").removeprefix("call ").removeprefix("card "), bad.split(" ", 1)[1]))
    return rows


def test_planted(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string, good string, bad string")
    got = {r["doc_id"]: r for r in pii.find_personal_data(df).collect()}
    hits = wrong = 0
    for i, text, good, bad in rows:
        found = {text[s["start"] : s["end"]] for s in got[i]["spans"]}
        hits += good in found
        wrong += any(s in bad or bad in s for s in found)
        assert {tuple(s) for s in got[i]["base"]} <= {tuple(s) for s in got[i]["spans"]}
    assert hits >= 0.9 * len(rows) and wrong <= 0.02 * len(rows), (hits, wrong)


def test_odd_rows(docs, no_docs):
    df = docs.withColumn("text", F.when(F.col("doc_id") == 7, F.concat("text", F.lit(" ä.b@c.de 1.2.3.4"))).otherwise(F.col("text"))).withColumn("spans", F.lit(1))
    got = pii.digests(pii.find_personal_data(df)).collect()
    assert len(got) == docs.count() and [r["spans"] for r in got if r["spans"]] == ["email:33:40,ip:41:48"]
    assert {r["base_sha256"] for r in got if not r["spans"]} == {hashlib.sha256(b"").hexdigest()}
    assert pii.digests(pii.find_personal_data(no_docs)).collect() == []


def test_reliabilities():
    """Labelers that are right most of the time are told from ones that guess."""
    import numpy as np

    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    right = np.array([0.95, 0.9, 0.8, 0.5, 0.5, 0.85])
    votes = np.where(rng.random((4000, 6)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    votes[rng.random((4000, 6)) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    chance = dict(zip(map(tuple, patterns), pii.posteriors(patterns, counts.astype(float))))
    assert np.mean([(chance[tuple(v)] > 0.5) == t for v, t in zip(votes, truth)]) > 0.95
