"""Exact top rows by inner product over a bit-sliced index.

The index holds, for a block of rows, each quantised attribute as bit slices: one bitmap over the rows per binary digit of
(value - least value of the block).  The scores of a query against all rows of a block are made with bitmap arithmetic:
a weight is a sum of powers of two, so its attribute's slices are added, moved up by these powers; a negative weight adds
the complement.  All slices that belong to one digit are added three at a time (sum and carry bitmaps) until one is left,
from the lowest digit up.  The best rows are then selected from the highest digit of the score down: rows that are sure to
be in, and rows that are level so far, the boundary.  Boundary rows that are level to the last digit have equal scores, and
the smaller ids among them are taken.

Blocks and parts of the queries meet in tasks; each task returns the best rows of its block for each of its queries, and a
ranking by query takes the best of those.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklode.llm.common import cut_lineage, reachable

BLOCK = 65_536  # rows of a block, about
QUERIES = 2048  # queries that meet a block in one task, at most about
TASKS = 48  # tasks to aim at while there are few blocks


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null, or one is not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("long")))


def _stack(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Slices:
    """One block: bitmaps (attribute digit, 64-bit words of rows), rows in the order of their ids."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, digits: np.ndarray, bits: np.ndarray):
        self.ids, self.low, self.digits = ids, low, digits
        self.bits = np.concatenate([bits, ~bits])  # the complements follow
        self.first = np.concatenate([[0], np.cumsum(digits)])
        self.words = bits.shape[1]
        self.rows = _bitmap(np.ones(len(ids), bool), self.words)

    @staticmethod
    def cut(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least values, digits and bitmaps of the attributes (columns) of rows in the order of ``ids``."""
        low = values.min(axis=0)
        above = (values - low).astype(np.uint64)
        digits = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
        words = -(-len(ids) // 64)
        bits = [_bitmap((above[:, d] >> np.uint64(s)) & np.uint64(1) == 1, words) for d in range(values.shape[1]) for s in range(digits[d])]
        return low, digits, np.array(bits, np.uint64).reshape(-1, words)

    def scores(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """Bitmaps of the binary digits of (score - base), lowest first, and base."""
        most = (1 << self.digits) - 1
        size = np.abs(query)
        if float(np.abs(query).astype(float) @ (np.abs(self.low) + most).astype(float)) >= 2**62:
            raise ValueError("scores do not fit 64 bits")
        base = int(query @ self.low) - int(size[query < 0] @ most[query < 0])
        rows: list[list[int]] = [[] for _ in range(64)]
        for d in np.flatnonzero(query):
            start = int(self.first[d]) + (len(self.bits) // 2 if query[d] < 0 else 0)
            weight = int(size[d])
            for t in range(weight.bit_length()):
                if weight >> t & 1:
                    for s in range(int(self.digits[d])):
                        rows[s + t].append(start + s)
        top = int(size @ most).bit_length()
        out = np.zeros((top, self.words), np.uint64)
        carry = np.zeros((0, self.words), np.uint64)
        for p in range(top):
            level = np.concatenate([self.bits[rows[p]], carry]) if rows[p] else carry
            carries = []
            while len(level) > 1:
                n = len(level) // 3
                if n:
                    a, b, c, rest = level[:n], level[n : 2 * n], level[2 * n : 3 * n], level[3 * n :]
                    differ = a ^ b
                    carries.append((a & b) | (c & differ))
                    level = np.concatenate([differ ^ c, rest])
                else:
                    carries.append(level[:1] & level[1:])
                    level = level[:1] ^ level[1:]
            if len(level):
                out[p] = level[0]
            carry = np.concatenate(carries) if carries else np.zeros((0, self.words), np.uint64)
        return out, base

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows other than ``own``; ties to smaller ids."""
        planes, base = self.scores(query)
        level, sure = self.rows.copy(), np.zeros(self.words, np.uint64)
        for at in range(*np.searchsorted(self.ids, [own, own + 1])):
            level[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
        for plane in planes[::-1]:
            upper = level & plane
            n = int(np.bitwise_count(sure | upper).sum())
            if n > k:
                level = upper
            elif n < k:
                sure |= upper
                level &= ~plane
            else:
                sure |= upper
                level[:] = 0
                break
        inside = _positions(sure)
        taken = np.concatenate([inside, _positions(level)[: k - len(inside)]])
        scores = np.full(len(taken), base, np.int64)
        for p, plane in enumerate(planes):
            scores += ((plane[taken >> 6] >> (taken & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << p
        return self.ids[taken], scores


def _bitmap(flags: np.ndarray, words: int) -> np.ndarray:
    packed = np.packbits(flags, bitorder="little")
    return np.concatenate([packed, np.zeros(words * 8 - len(packed), np.uint8)]).view("<u8").astype(np.uint64)


def _positions(bitmap: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(bitmap)
    if not len(at):
        return at
    flags = np.unpackbits(bitmap[at].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    row, bit = np.nonzero(flags)
    return at[row] * 64 + bit


def build_index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """The index: a row per block with ``block``, ``scale``, ``ids``, ``low``, ``digits`` and ``bits`` (arrays as bytes), written once.

    Rows without an id, and rows whose vector is null or holds null or non-finite components, are not indexed.  A shorter
    vector has zeros behind; rows may repeat.
    """
    rows = rows.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
    rows = rows.filter("id is not null and v is not null")
    n, dims = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks, dims = max(1, -(-n // BLOCK)), int(dims or 0)

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        values, ids = _stack(rows["v"], dims), rows["id"].to_numpy(np.int64)
        order = np.lexsort((*values.T[::-1], ids))
        ids = ids[order]
        low, digits, bits = Slices.cut(ids, values[order])
        parts = {"ids": ids, "low": low, "digits": digits, "bits": bits}
        return pd.DataFrame({"block": rows["block"].iloc[:1], "scale": scale, **{k: [v.tobytes()] for k, v in parts.items()}})

    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    schema = "block int, scale int, ids binary, low binary, digits binary, bits binary"
    return cut_lineage(reachable(rows).groupBy("block").applyInPandas(cut, schema))


def search(index: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of the index with the largest inner product with each query, other than the query's own id.

    Columns: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; fewer rows if the index has fewer; ties to the smaller
    id.  Queries without an id or with a vector that cannot be indexed give no rows; equal query rows count once.
    Components of a query beyond those of the index meet zeros; they are quantised by the index's own scale.  Every query
    meets every block once.
    """
    held = index.select("block", "scale").collect()  # two numbers per block
    scale = held[0]["scale"] if held else 1
    queries = queries.select(F.col(id_col).cast("long").alias("query_id"), quantised(F.col(vector_col), scale).alias("v"))
    queries = cut_lineage(queries.filter("query_id is not null and v is not null").dropDuplicates())
    blocks, n = len(held), queries.count()
    parts = max(-(-n // QUERIES), min(-(-TASKS // max(blocks, 1)), -(-n // 16)), 1)

    def best(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in held.itertuples():
            ids, low, digits = (np.frombuffer(x, np.int64) for x in (row.ids, row.low, row.digits))
            bits = np.frombuffer(row.bits, np.uint64).reshape(-1, -(-len(ids) // 64))
            block = Slices(ids, low, digits, bits)
            for query_id, v in zip(asked["query_id"], asked["v"]):
                query = np.zeros(len(low), np.int64)
                query[: len(v)] = v[: len(low)]
                found, scores = block.top(query, k, query_id)
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    numbers = F.array(*[F.lit(r["block"]) for r in held]) if held else F.array().cast("array<int>")
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    asked = asked.withColumn("block", F.explode(numbers))
    found = reachable(index).groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
    found = found.applyInPandas(best, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
