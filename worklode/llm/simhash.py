"""Near-duplicate documents by SimHash: fingerprints of word shingles, linked by a self-join of a binary trie.

Two fingerprints link if they differ in at most ``budget`` bits.  The fingerprints are cut into ``budget + 1`` blocks of
bits.  If two of them differ in at most ``budget`` bits, there is a block from which on, going round, the first j blocks
hold at most j - 1 differing bits, for every j (else the blocks would hold more than ``budget`` together).  So one trie is
built for each block to start with, and node pairs are followed from the root down with the bits that differ so far: none
in the first block, one by the end of the second, and so on.  Pairs beyond that are pruned.

The upper levels of the tries are walked by Spark: a fingerprint goes to the node of its first bits, and below the first
block also to the node pairs that differ in one bit.  How deep follows from the number of fingerprints.  Node pairs that
still hold too many are cut into pairs of slices.  Each part is walked level by level with arrays in one task of bounded
size, depth first in chunks; node pairs whose fingerprints are all connected already are dropped, and a part returns each
fingerprint with the least one that it is connected to, so that thousands of copies give thousands of links, not millions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklode.llm.common import cut_lineage, map_rows, reachable, words_of
from worklode.operators.identity import clusters

BITS = 64
SEED = 42
NODE = 16_384  # fingerprints in a node to aim at
MOST = 131_072  # fingerprints of one slice of a node
CHUNK = 32_768  # node pairs walked at once
SMALL = 32  # pairs of fingerprints below a node pair that are compared straight away
PIECE = 65_536  # shingles whose bits are counted at once


def shingle_hashes(words: list[bytes], size: int) -> list[bytes]:
    """XXH64 (seed 42) of every shingle of ``size`` words joined by spaces, as big-endian bytes, repeats included."""
    digest = xxhash.xxh64_digest
    if not words:
        return []
    text = b" ".join(words)
    if len(words) <= size:
        return [digest(text, SEED)]
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[: len(ends) - size]]]
    return [digest(text[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])]


def fingerprint(hashes: list[bytes]) -> int:
    """Bit set: set in over half the hashes.  No hashes: zero."""
    if not hashes:
        return 0
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), PIECE):
        part = np.frombuffer(b"".join(hashes[k : k + PIECE]), np.uint8)
        counts += np.unpackbits(part).reshape(-1, BITS).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``fp`` (64 bits as a long) of every whole text; null and blank texts have fingerprint zero."""

    def run(columns):
        return [columns[0], [fingerprint(shingle_hashes(words_of(t, lower=True), size)) for t in columns[1]]]

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), run, f"{id_col} {id_type}, fp long")


def block_widths(budget: int) -> list[int]:
    n = budget + 1
    return [BITS // n + (k < BITS % n) for k in range(n)]


def depth_budgets(widths: list[int]) -> list[int]:
    """Differing bits allowed at each depth: as many as there are whole blocks above."""
    return [k for k, w in enumerate(widths) for _ in range(w)]


def join_classes(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of positions a[i] and b[i], in place; a label is the least position of its class."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        np.minimum.at(labels, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while not (labels[labels] == labels).all():
            labels[:] = labels[labels]


def class_runs(labels: np.ndarray) -> np.ndarray:
    """Equal numbers at two positions: all labels between them are the same."""
    return np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])


def _middle(keys: np.ndarray, low: np.ndarray, depth: int) -> np.ndarray:
    """Where the nodes that start at ``low`` have their first key with the bit at ``depth`` set."""
    bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
    above = ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.uint64(0)
    return np.searchsorted(keys, (keys[low] & above) | bit)


def walk(first: np.ndarray, second: np.ndarray | None, allowed: list[int], budget: int) -> np.ndarray:
    """Classes of keys that are linked by pairs within ``first``, or between ``first`` and ``second``.

    Both are sorted and distinct (uint64).  A pair links if it differs in ``budget`` bits or fewer; only pairs whose first
    d + 1 bits differ in ``allowed[d]`` at most, for every d, need be found.  Gives a label for each position of the keys
    (``second`` after ``first``); nodes are ranges of positions.
    """
    one = second is None
    other, shift = (first, 0) if one else (second, len(first))
    labels = np.arange(shift + len(other))
    if not len(first) or not len(other):
        return labels
    start = np.zeros(1, np.int64)
    stack = [(0, start, start + len(first), start, start + len(other), start)]
    runs = class_runs(labels)
    while stack:
        depth, *nodes = stack.pop()
        al, ah, bl, bh, err = nodes
        joined = (runs[ah - 1] == runs[al]) & (runs[shift + bh - 1] == runs[shift + bl]) & (labels[al] == labels[shift + bl])
        al, ah, bl, bh, err = (x[~joined] for x in nodes)
        pairs = (ah - al) * (bh - bl)
        small = (pairs <= SMALL) | (depth == BITS)
        if small.any():
            n, width = pairs[small], (bh - bl)[small]
            at = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            i, j = al[small][at] + k // width[at], bl[small][at] + k % width[at]
            near = np.bitwise_count(first[i] ^ other[j]) <= budget
            if one:
                near &= i < j
            if near.any():
                join_classes(labels, i[near], shift + j[near])
                runs = class_runs(labels)
        al, ah, bl, bh, err = (x[~small] for x in (al, ah, bl, bh, err))
        if not len(al):
            continue
        am, bm = _middle(first, al, depth), _middle(other, bl, depth)
        twice = one & (al == bl)  # a node with itself: its two children meet once
        parts = [(al, am, bl, bm, err), (am, ah, bm, bh, err), (al, am, bm, bh, err + 1), (am, ah, bl, bm, err + 1)]
        parts[3] = tuple(x[~twice] for x in parts[3])
        al, ah, bl, bh, err = (np.concatenate(x) for x in zip(*parts))
        keep = (al < ah) & (bl < bh) & (err <= allowed[depth])
        nodes = [x[keep] for x in (al, ah, bl, bh, err)]
        for k in range(0, len(nodes[0]), CHUNK):
            stack.append((depth + 1, *(x[k : k + CHUNK] for x in nodes)))
    return labels


def _turned(keys, by: int):
    """uint64 keys rotated to the left."""
    return keys if not by % BITS else (keys << np.uint64(by)) | (keys >> np.uint64(BITS - by))


def near_links(fps: DataFrame, budget: int) -> DataFrame:
    """(``fp``, ``root``): links between distinct fingerprints that have the same classes as all links within ``budget``.

    ``fps`` has one row per fingerprint in column ``fp`` (long).
    """
    widths = block_widths(budget)
    starts = [sum(widths[:k]) for k in range(len(widths))]
    deepest = min(widths) if budget == 0 else min(widths[k] + widths[(k + 1) % len(widths)] for k in range(len(widths)))
    depth = min(max(fps.count() - 1, 0) // NODE, 2**deepest - 1).bit_length()
    fp = F.col("fp")
    turns = [F.shiftleft(fp, s).bitwiseOR(F.shiftrightunsigned(fp, BITS - s)) if s else fp for s in starts]
    rows = fps.select(F.posexplode(F.array(*turns)).alias("turn", "key"))
    node = F.shiftrightunsigned("key", BITS - depth) if depth else F.lit(0).cast("long")
    rows = rows.withColumn("node", node)
    flips = [F.col("node").bitwiseXOR(F.lit(1 << k).cast("long")) for k in range(depth - min(widths))]
    own = F.struct(F.col("node").alias("lo"), F.col("node").alias("hi"))
    pairs = [F.struct(F.least("node", f).alias("lo"), F.greatest("node", f).alias("hi")) for f in flips]
    rows = rows.withColumn("pair", F.explode(F.array(own, *pairs)) if pairs else own).select(
        "turn", "key", "pair.lo", "pair.hi", (F.col("node") > F.col("pair.lo")).alias("high")
    )
    part = ["turn", "lo", "hi"]
    large = rows.groupBy(*part).count().filter(F.col("count") > MOST)
    large = large.select(*part, F.ceil(F.col("count") / MOST).cast("int").alias("slices"))
    rows = rows.join(large, part, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int"))
    rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    second = F.when(F.col("lo") == F.col("hi"), F.col("own") > F.col("met")).otherwise(F.col("high"))
    rows = rows.select(
        *part, "key", second.alias("second"), F.when(second, F.col("met")).otherwise(F.col("own")).alias("i"),
        F.when(second, F.col("own")).otherwise(F.col("met")).alias("j"),
    )
    schedules = [depth_budgets(widths[k:] + widths[:k]) for k in range(len(widths))]

    def link(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        turn, lo, hi, i, j = (int(x) for x in key)
        keys, second = rows["key"].to_numpy(np.int64).view(np.uint64), rows["second"].to_numpy(bool)
        first = np.unique(keys[~second])
        behind = None if lo == hi and i == j else np.unique(keys[second])
        labels = walk(first, behind, schedules[turn], budget)
        keys = _turned(first if behind is None else np.concatenate([first, behind]), BITS - starts[turn])
        linked = labels != np.arange(len(labels))
        return pd.DataFrame({"fp": keys[linked].view(np.int64), "root": keys[labels[linked]].view(np.int64)})

    return reachable(rows).groupBy(*part, "i", "j").applyInPandas(link, "fp long, root long")


def near_duplicates(
    docs: DataFrame, size: int = 4, budget: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprint and class of every document: texts link at ``budget`` or fewer differing bits, and classes are what
    links connect, named by their smallest id.

    Columns: the id, ``fingerprint`` (16 lowercase hex digits), ``component_id``, in one row per row of ``docs``.  Words are
    lowered A-Z; shingles have ``size`` words; a text of fewer words is one shingle.  Null, empty and blank texts have
    fingerprint zero and link to each other like any other.  Rows with equal ids keep their own fingerprints.  A null id
    never names a class unless the class has no other (then the name is null).  An empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(docs, size, id_col, text_col))
    fps = cut_lineage(rows.groupBy("fp").agg(F.min(id_col).alias("least")))
    groups = clusters(near_links(fps.select("fp"), budget), "fp", "root").select(F.col("node").alias("fp"), "cluster")
    names = groups.join(fps, "fp").groupBy("cluster").agg(F.min("least").alias("name"))
    named = fps.join(groups.join(names, "cluster"), "fp", "left").select("fp", F.coalesce("name", "least").alias("component_id"))
    out = rows.join(named, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    return out


def keep_one(docs: DataFrame, size: int, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each class, with all its columns; of rows with one id, one stays.

    Rows without an id pass as they are: nothing tells them apart, and no class can be named by them.
    """
    named = docs.filter(F.col(id_col).isNotNull())
    classes = near_duplicates(named, size, budget, id_col, text_col)
    kept = classes.filter(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    one = named.join(kept, id_col, "left_semi").dropDuplicates([id_col])
    return one.unionByName(docs.filter(F.col(id_col).isNull()))
