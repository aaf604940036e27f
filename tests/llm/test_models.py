"""Learned operators: against plain versions of their parts, on held-out rows, and on odd tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from worklode.llm import language, mixing_lm, quality_forest, source_mix
from worklode.llm.common import table
from worklode.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_on_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in table(spark, MEDIUM, "documents").collect()}
    got = QUERIES["op4_language"](spark, MEDIUM).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.rejected for r in held]) < 0.01
    assert all(0 <= r.score <= 1 for r in got)


def test_language_rejects_what_it_does_not_know(spark, docs, no_docs):
    model = language.fit(table(spark, MEDIUM, "documents"))
    odd = spark.createDataFrame([(1, "Привет как дела что нового у вас"), (2, "你好世界"), (3, "12 34 %%"), (4, None), (5, "the and that")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert got[1].rejected and got[2].rejected and not got[5].rejected
    assert [(got[k].lang_pred, got[k].score) for k in (3, 4)] == [("und", 0.0)] * 2
    assert got[1].lang_pred in {"en", "de", "fr", "es"}
    assert language.identify(docs, model).count() == docs.count()
    none = language.fit(no_docs)
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.keep_identified(docs, model).columns == docs.columns


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return [len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)]


def test_quality_counts(spark, docs, no_docs):
    for r in [*table(spark, SF, "documents").collect(), *docs.collect()]:
        assert quality_forest.statistics(r.text)[0] == plain_counts(r.text)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality_forest.assess(docs, labels)
    assert got.count() == docs.count() and not got.filter("kept").count()
    assert quality_forest.assess(no_docs, labels).count() == 0
    assert quality_forest.assess(docs, labels.limit(0)).count() == docs.count()


def test_quality_verdicts(spark):
    quality = {r.doc_id: r.quality for r in table(spark, MEDIUM, "labels").collect()}
    got = [r for r in QUERIES["op9_quality_forest"](spark, MEDIUM).collect() if not r.base_failed and quality.get(r.doc_id) is not None]
    kept = {q: np.mean([r.kept for r in got if quality[r.doc_id] == q]) for q in (0, 1)}
    assert kept[1] > 0.97 and kept[0] < 0.3


def test_isolation_paths():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (500, 3)), [[9.0, 9.0, 9.0]]])
    anomaly = quality_forest.grow(x, 128).anomaly(x)
    assert anomaly.argmax() == 500 and anomaly.max() > 0.6 > np.median(anomaly)
    assert quality_forest.separation(np.array([1.0, 2, 3, 4]), np.array([False, False, True, True])) == 0.5


def test_mixing_meets_its_targets(spark):
    docs, labels = table(spark, MEDIUM, "documents"), source_mix.label_domains(table(spark, MEDIUM, "labels"))
    weights = {"good": 0.8, "poor": 0.15, "toxic": 0.05}
    rows = source_mix.mix(docs, labels, weights).collect()
    total = sum(r.n_tokens for r in rows)
    for d, w in weights.items():
        assert abs(sum(r.n_tokens * r.rate * r.posteriors[d] for r in rows) / total - w) < 0.02
    assert all(r.rate >= 0 and math.isclose(sum(r.posteriors.values()), 1) for r in rows)
    assert all(abs(r.copies - r.rate) < 1 for r in rows)


def test_mixing_classifier_on_held_out_labels(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), source_mix.label_domains(table(spark, "/root/testdata/sf0.1", "labels"))
    held = labels.filter("doc_id % 5 = 0")
    model = source_mix.fit_classifier(docs, labels.filter("doc_id % 5 <> 0"), ["good", "poor", "toxic"])
    rows = source_mix.predict(docs.join(held.select("doc_id"), "doc_id", "left_semi"), model).join(held, "doc_id").collect()
    assert np.mean([model.domains[int(np.argmax(r.parts))] == r.domain for r in rows]) > 0.88


def test_mixing_odd_tables(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, "a"), (7, "b"), (None, "a"), (99, "b"), (8, "other")], "doc_id long, domain string")
    assert source_mix.mix(docs, labels, {"a": 1.0, "b": 1.0}).count() == docs.count()
    assert source_mix.mix(no_docs, labels, {"a": 1.0, "b": 1.0}).count() == 0
    even = source_mix.mix(docs, labels.limit(0), {"a": 1.0, "b": 1.0}).collect()
    assert len({round(r.rate, 6) for r in even}) == 1
    assert source_mix.keep_mixed(docs, labels, {"a": 1.0, "b": 1.0}).columns == docs.columns


def test_projected_gradient_against_a_plain_one(spark):
    rng = np.random.default_rng(5)
    parts = rng.multinomial(source_mix.STEPS, [0.5, 0.3, 0.2], 60) * 1
    parts[:30] = rng.multinomial(source_mix.STEPS, [0.1, 0.1, 0.8], 30)
    n = rng.integers(1, 100, 60)
    df = spark.createDataFrame([(int(a), p.tolist()) for a, p in zip(n, parts)], "n_tokens long, parts array<bigint>")
    target = np.array([0.4, 0.3, 0.1])
    got = source_mix.fit_rates(df, target.tolist()).steps(parts / source_mix.STEPS)[0]
    p, w, r = parts / source_mix.STEPS, n / n.sum(), np.ones(60)
    for _ in range(20_000):
        r = np.maximum(0, r - 0.5 * (p @ ((w * r) @ p - target) + source_mix.RIDGE * (r - 1)))
    loss = [((w * x) @ p - target) @ ((w * x) @ p - target) + source_mix.RIDGE * (w * (x - 1) ** 2).sum() for x in (got, r)]
    assert loss[0] < loss[1] + 3e-4 and (got >= 0).all()


def test_language_model(spark):
    rows = table(spark, MEDIUM, "documents").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    tokens = {r.doc_id: [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text)), None] for r in rows}
    c = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    total, distinct = sum(c.values()), len(c)
    base = {k: sum(math.log10((c[t] + 1) / (total + distinct + 1)) for t in ts) for k, ts in tokens.items()}
    got = {r.doc_id: r for r in QUERIES["op3_mixing_lm"](spark, MEDIUM).collect()}
    assert set(got) == set(held)
    for k, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(tokens[k]), sum(c[t] > 0 for t in tokens[k]), total)
        assert math.isclose(r.base_score, base[k], rel_tol=1e-9) and r.score < 0
    # The model is a distribution over texts, the base spends nothing on spelling unknown words; known ones tell them apart.
    known = [k for k, r in got.items() if held[k] and r.n_known >= 0.97 * r.n_tokens]
    assert sum(got[k].score for k in known) > sum(base[k] for k in known)


def test_bit_chances_add_up():
    """The chances of all closed one-byte words and their beginnings add up: each bit has a chance of one or zero."""
    words = sorted(w + b" " for w in (b"aa", b"ab", b"abcdef", b"abcdeg", b"b", b"\xc3\xa9t\xc3\xa9"))
    counts = np.arange(1.0, 13).reshape(6, 2)
    places = mixing_lm.Places(2)
    total = np.zeros((2, places.total))
    mixing_lm.slot_counts(places, words, counts, total)
    table_ = total.T.astype(np.float32)
    model = mixing_lm.Model(2, table_, np.tile(np.array(mixing_lm.FIRST_WEIGHTS), (16, 1)), np.zeros((64, 24, 2)))
    total = np.zeros(2)
    for byte in range(1, 256):
        mark = bytes([byte, 32]) if byte != 32 else None
        if mark:
            total += 10 ** mixing_lm.score_words(model, [mark], np.zeros((1, 2)))[0]
    assert (total <= 1 + 1e-6).all()
    for bits in (8,):
        first = sum(10 ** _first_byte(model, b) for b in range(2**bits))
        assert np.allclose(first, 1, atol=1e-5)


def _first_byte(model, byte):
    c = mixing_lm.Contexts.of(bytes([byte]))
    out = np.zeros(2)
    for b in range(8):
        node = (1 << b) | (c.byte.astype(np.int64) >> (8 - b))
        bit = int(c.byte[0]) >> (7 - b) & 1
        shared = [model.counts[s] for s in model.places.shared(c, node)]
        for g in range(2):
            p = model.refined(model.predict(c, node, g, None, [], shared)[2], b)[0]
            out[g] += np.log10(p if bit else 1 - p)
    return out


def test_counts_of_words_so_far():
    """Counts from sorted words are those of all words with the same beginning."""
    rng = np.random.default_rng(2)
    words = sorted({bytes(rng.choice(list(b"ab\xc3\x01"), rng.integers(1, 9))) + b" " for _ in range(200)})
    counts = rng.integers(0, 5, (len(words), 2)).astype(float)
    for go, c, b, node, bits, sofar in mixing_lm.walk(words, counts, 2):
        if sofar is None:
            continue
        for i, k in enumerate(go.tolist()):
            w = words[k]
            same = [x for x, v in enumerate(words) if v[: c.at] == w[: c.at] and len(v) > c.at and v[c.at] >> (8 - b) == w[c.at] >> (8 - b)]
            assert sofar[1][0][i] == counts[same, 0].sum()
            assert sofar[0][1][i] == sum(counts[x].sum() for x in same if words[x][c.at] >> (7 - b) & 1)


def test_weights_are_learned_from_all_words(spark):
    words = spark.range(210_000).selectExpr("cast(lower(hex(id)) as binary) as word", "1 + id % 2 as n0")
    model = mixing_lm._train(words, 1)
    assert model.refine[:, :, 0].sum() == words.selectExpr("sum(n0 * 8 * (length(word) + 1))").first()[0]


def test_language_model_on_odd_tables(docs, no_docs):
    from pyspark.sql import functions as F

    got = mixing_lm.score_documents(docs, F.col("doc_id") > 1)
    assert got.count() == docs.count()
    assert all(math.isfinite(r.score) for r in got.collect())
    assert mixing_lm.score_documents(docs, F.lit(False)).filter("n_known = 0").count() == docs.count()
    assert mixing_lm.score_documents(no_docs, F.lit(True)).count() == 0


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage got and gave."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, MEDIUM, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, MEDIUM).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_stages_take_effect_and_keep_clean_documents(spark, stages):
    columns = table(spark, MEDIUM, "documents").columns
    labels = {r.doc_id: r for r in table(spark, MEDIUM, "labels").collect()}
    for name, (before, after) in stages.items():
        if name != "encode":
            assert after.columns == columns and after.exceptAll(before).isEmpty()
    ids = {name: {r.doc_id for r in after.select("doc_id").collect()} for name, (_, after) in stages.items()}
    assert len(ids["encode"]) == len(ids["mix"]) == stages["encode"][1].count() and stages["encode"][1].filter("exact").count() == len(ids["mix"])
    quality = [r for r in labels.values() if r.doc_id in ids["language"]]
    assert np.mean([r.doc_id in ids["quality"] for r in quality if r.quality == 0]) < 0.2
    # A label may be wrong at random, so toxic documents are told by what the toxic ones of these tables have in common.
    insults = re.compile("idiot|moron|scum|loser|stupid|trash|clown|pathetic|worthless|disgusting", re.I)
    left = stages["near_duplicates"][1].collect()
    toxic = [r for r in left if insults.search(r.text)]
    clean = [r for r in left if not insults.search(r.text) and r.doc_id in labels and labels[r.doc_id].toxic == 0 and labels[r.doc_id].quality == 1]
    assert np.mean([r.doc_id in ids["mix"] for r in toxic]) < 0.15
    assert np.mean([r.doc_id in ids["mix"] for r in clean]) > 0.98
    texts = [r.text for r in stages["near_duplicates"][1].collect()]
    assert len(texts) == len(set(texts))


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids", "exact"]
