"""Token counts of whole texts by a two-tier lookup of pre-tokens, without shuffling any pre-token.

A text falls into pre-tokens that the tokenizer encodes independently of one another, so its token count is the sum of
their counts.  First tier: a table of the most frequent pre-tokens of all documents and their counts, broadcast to the
workers.  Second tier: pre-tokens that are not in it are encoded by the library and kept in a bounded cache per worker.

The frequent pre-tokens are found by one pass over all texts: each task keeps a bounded counter and hands on one row, and
such rows are merged in groups until few are left.  The counters may lose rare pre-tokens, which changes the speed only:
whatever is not in the table is encoded.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from worklode.llm.common import Cache, blocks, map_batches, map_rows, read_file

FREQUENT = 65_536  # pre-tokens in the broadcast table; about 1 MB
CACHED = 200_000  # pre-tokens in a worker's cache
LONGEST = 64  # longer pre-tokens are encoded, but not kept
FAN_IN = 16  # rows of frequent pre-tokens that one task merges
SPACE = "▁"


class Pieces:
    """Pre-tokens of a sentencepiece model: a word with the space before it.

    No piece may hold a space after another character, so a border lies before each space that follows one.
    """

    def __init__(self, model: bytes):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()) if not self.sp.is_control(i)]
        probe = " a  b \tCÉ "
        kept = self.sp.decode(self.sp.encode(probe)) == probe
        self.splits = kept and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain)

    def split(self, text: str) -> list[str] | None:
        """The words, or None if the text must be encoded as a whole: other spacing than single spaces between words."""
        if not self.splits or "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            return None
        return text.split(" ")

    def length(self, word: str) -> int:
        return len(self.sp.encode(word))

    whole = length


class Merges:
    """Pre-tokens of a tokenizers file, made by its own normalizer and pre-tokenizer."""

    def __init__(self, model: bytes):
        self.t = Tokenizer.from_str(model.decode())
        self.t.no_padding()
        self.t.no_truncation()
        self.special = [t.content for t in self.t.get_added_tokens_decoder().values()]

    def split(self, text: str) -> list[str] | None:
        if self.t.pre_tokenizer is None or any(s in text for s in self.special):
            return None
        text = self.t.normalizer.normalize_str(text) if self.t.normalizer else text
        return [w for w, _ in self.t.pre_tokenizer.pre_tokenize_str(text)]

    def length(self, word: str) -> int:
        return len(self.t.model.tokenize(word))

    def whole(self, text: str) -> int:
        return len(self.t.encode(text, add_special_tokens=False))


class Lengths(dict):
    """The first tier; what it lacks is asked of the second."""

    def __init__(self, tokenizer, table: dict[str, int]):
        super().__init__(table)
        self.tokenizer = tokenizer
        self.rest = Cache(tokenizer.length, CACHED)

    def __missing__(self, word: str) -> int:
        return self.rest[word] if len(word) <= LONGEST else self.tokenizer.length(word)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        words = self.tokenizer.split(text)
        return self.tokenizer.whole(text) if words is None else sum(map(self.__getitem__, words))


_KEPT: dict[str, object] = {}


def _once(key: str, make: Callable):
    """What a worker process keeps between tasks."""
    if key not in _KEPT:
        if len(_KEPT) >= 4:
            _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def _tokenizer(kind: str, model: bytes):
    return Pieces(model) if kind == "model" else Merges(model)


def _bounded(counts: Counter, most: int) -> Counter:
    return counts if len(counts) <= most else Counter(dict(counts.most_common(most)))


def _row(counts: Counter) -> pa.RecordBatch:
    top = counts.most_common(FREQUENT)
    return pa.RecordBatch.from_pydict(
        {"words": pa.array([[w for w, _ in top]], pa.list_(pa.string())), "counts": pa.array([[c for _, c in top]], pa.list_(pa.int64()))}
    )


def frequent_pretokens(docs: DataFrame, path: str, text_col: str = "text") -> list[str]:
    """The pre-tokens met most often in all texts, at most ``FREQUENT``, by bounded counters per task."""
    kind, model = path.rpartition(".")[2], read_file(path)
    key = "split" + hashlib.sha256(model).hexdigest()
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = "words array<string>, counts array<bigint>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _once(key, lambda: _tokenizer(kind, held.value)).split
        counts: Counter = Counter()
        for batch in batches:
            for (texts,) in blocks(batch):
                for text in texts:
                    counts.update(w for w in (split(text) or ()) if len(w) <= LONGEST) if text else None
                if len(counts) > 4 * FREQUENT:
                    counts = _bounded(counts, 2 * FREQUENT)
        yield _row(counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for words, numbers in zip(*(c.to_pylist() for c in batch.columns)):
                counts.update(dict(zip(words, numbers)))
                counts = _bounded(counts, 2 * FREQUENT)
        yield _row(counts)

    rows = map_batches(docs.select(text_col), count, schema)
    parts = docs.select(text_col).rdd.getNumPartitions()
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        rows = rows.coalesce(parts) if parts == 1 else rows.repartition(parts)
        rows = map_batches(rows, merge, schema)
    total: Counter = Counter()
    for row in rows.toLocalIterator():  # FAN_IN rows of bounded size at most, one after the other
        total.update(dict(zip(row.words, row.counts)))
        total = _bounded(total, 2 * FREQUENT)
    return [w for w, _ in total.most_common(FREQUENT)]


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text as the library for ``path`` gives them (.model: sentencepiece, .json: tokenizers).

    Columns: the id, ``n_bytes`` (UTF-8), ``n_tokens`` (no begin, end or other added tokens), ``over_limit`` (more than
    ``limit`` tokens).  Strings of special tokens inside texts are handled as the library does by default.  A null or empty
    text has 0 bytes and 0 tokens.  Rows are mapped one to one; ids may be null or repeat; an empty table gives an empty result.
    """
    kind, model = path.rpartition(".")[2], read_file(path)
    tokenizer = _tokenizer(kind, model)
    words = frequent_pretokens(docs, path, text_col)
    table = {w: tokenizer.length(w) for w in words}
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast((model, table))
    key = hashlib.sha256(model + repr(sorted(table.items())).encode()).hexdigest()

    def run(columns):
        lengths = _once(key, lambda: Lengths(_tokenizer(kind, held.value[0]), held.value[1]))
        n = [lengths.count(t) for t in columns[1]]
        return [columns[0], [len(t.encode()) if t else 0 for t in columns[1]], n, [x > limit for x in n]]

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col), F.col(text_col)), run, f"{id_col} {id_type}, n_bytes long, n_tokens long, over_limit boolean"
    )
