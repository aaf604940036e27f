"""Merkle manifest against a plain recursive version."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from worklode.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def up(nodes, paths):
    """(root, siblings of every leaf on the way) of one tree; ``paths`` holds the leaves below each node."""
    steps = defaultdict(list)
    while len(nodes) > 1:
        above, below = [], []
        for k in range(0, len(nodes), 3):
            run = nodes[k : k + 3]
            for i, _ in enumerate(run):
                for leaf in paths[k + i]:
                    steps[leaf].append((run[:i], run[i + 1 :]))
            above.append(h(*run))
            below.append([x for p in paths[k : k + 3] for x in p])
        nodes, paths = above, below
    return nodes[0], steps


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"], h(*[field(r[c]) for c in COLUMNS]), r))
    subroots, inner, order = [], {}, sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        leaves = sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        root, steps = up([x[1] for x in leaves], [[i] for i in range(len(leaves))])
        subroots.append(root)
        inner[s] = (leaves, steps)
    root, outer = up(subroots, [[s] for s in order])
    out = []
    for s, sub in zip(order, subroots):
        for i, (doc_id, leaf, r) in enumerate(inner[s][0]):
            steps = inner[s][1][i] + outer[s]
            touched = dict(r)
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and r["text"] is not None:
                touched["text"] = r["text"].replace("\n", "")
            digest = h(*[field(touched[c]) for c in COLUMNS])
            for left, right in steps:
                digest = h(*left, digest, *right)
            out.append((doc_id, leaf, sub, root, h(*[x for left, right in steps for x in left + right]), digest, digest == root))
    return out


def checked(df):
    touched = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.check(merkle.build(df, COLUMNS, altered={"text": touched}).proofs)


def same(df):
    got = checked(df).collect()
    assert Counter(map(tuple, got)) == Counter(plain([r.asDict() for r in df.collect()]))
    return got


def test_odd_rows(docs):
    df = docs.withColumns({"n_chars": F.length("text"), "tree": F.lit("t"), "at": F.lit(1), "steps": F.lit(2), "_row": F.lit(3)})
    same(df.unionByName(df.filter("doc_id = 8")))


def test_no_rows(no_docs):
    built = merkle.build(no_docs, ["doc_id", "text"])
    assert merkle.check(built.proofs).collect() == [] and built.groups.collect() == []


@pytest.mark.parametrize("sizes", [[1], [4], [27, 28], [1] * 28 + [82, 5]])
def test_sizes(spark, sizes):
    rows = [(i * 7 % 1009, f"s{g}" if g else None, "en", None if i % 5 == 0 else i, f"text {i}\n{g}\n") for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = same(df)
    assert len(got) == sum(sizes) and any(r.verified for r in got) or len(rows) < 4


def test_hot_group_of_equal_rows(spark):
    df = spark.range(400).select(F.lit(5).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("a\nb").alias("text"))
    other = spark.range(50).select("id", F.lit("t"), F.lit("de"), F.lit(2), F.concat(F.lit("x\n"), "id"))
    same(df.union(other))


def test_a_moved_row_is_found(docs):
    built = merkle.build(docs, ["doc_id", "text"])
    one = built.proofs.filter("doc_id = 7").select("doc_id", "leaf", "steps", "subroot", "root")
    assert merkle.check(one.withColumn("held", F.col("leaf"))).first().verified
    assert not merkle.check(one.withColumn("held", merkle.leaf_digest([F.lit(7), F.lit("other")]))).first().verified


def test_groups(docs):
    built = merkle.build(docs, ["doc_id", "text"])
    groups = {r["source"]: r for r in built.groups.collect()}
    assert sum(r["leaves"] for r in groups.values()) == docs.count() and groups["a"]["leaves"] == 6
    assert len({r["root"] for r in groups.values()}) == 1
