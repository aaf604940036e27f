"""What several operators of this subpackage share: tables, batches of rows, bounded caches, the checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from worklode.session import cut_lineage, shared_dir


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table of its own in the shared folder and go on from there: unlike a checkpoint it has sizes that the
    optimizer knows, and one plan may use it several times."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words in UTF-8: maximal runs of characters other than the space and tab to carriage return; A-Z lowered if asked for.

    These six characters are the ones that ``bytes.split`` and ``bytes.lower`` know, and no part of other UTF-8 characters.
    """
    data = text.encode() if text else b""
    return data.lower().split() if lower else data.split()


def blocks(batch: pa.RecordBatch, step: int = 256) -> Iterator[list[list]]:
    """The columns of an Arrow batch as Python lists, ``step`` rows at a time, so that few texts are held twice."""
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        yield [column.to_pylist() for column in part.columns]


def reachable(df: DataFrame) -> DataFrame:
    """Let the Python workers of this session import this package from where the driver has it."""
    root, env = str(Path(__file__).resolve().parents[2]), df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])
    return df


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package at hand."""
    return reachable(df).mapInArrow(fn, schema)


def arrow_schema(schema: str) -> pa.Schema:
    """Arrow's form of a schema string; on the driver only."""
    return to_arrow_schema(_parse_datatype_string(schema))


def record_batch(columns: Sequence, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def map_rows(df: DataFrame, fn: Callable[[list[list]], list[list]], schema: str) -> DataFrame:
    """Apply ``fn`` (lists of columns in, lists of columns out) to small blocks of rows, within tasks."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in blocks(batch):
                yield record_batch(fn(columns), arrow)

    return map_batches(df, run, schema)


def keep_rows(df: DataFrame, columns: list[str], fn: Callable[[list[list]], list[bool]]) -> DataFrame:
    """The rows of ``df`` for which ``fn`` (lists of the named columns in) says so; all columns pass by untouched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = batch.select(columns)
            for start, part in zip(range(0, batch.num_rows, 256), blocks(seen)):
                yield batch.slice(start, 256).filter(pa.array(fn(part), pa.bool_()))

    return map_batches(df, run, df.schema)


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def read_file(path: str) -> bytes:
    """A small local parameter file (a vocabulary), read on the driver."""
    return Path(path).read_bytes()


class Cache(dict):
    """``cache[key]`` computes missing values with ``make``.

    At most ``most`` keys are held, in two generations: when the younger is full it becomes the older one, and keys that
    are asked for again move back, so that frequent keys stay and memory is bounded.
    """

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


__all__ = [
    "Cache", "arrow_schema", "blocks", "cut_lineage", "keep_rows", "map_batches", "map_rows", "reachable", "read_file", "record_batch", "remainder", "table", "words_of", "written",
]
