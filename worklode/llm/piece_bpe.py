"""SentencePiece encoding and decoding with a merge-type vocabulary, by backtracking over longest matches.

A sequence of tokens is the merge result of its text exactly if every token is the merge result of its own text and
every two neighbours stay apart when their joined text is merged.  So the encoder goes left to right: it takes the longest
token at a position (one Aho-Corasick pass finds the longest at every position), keeps it if it is compatible with the
token before, else tries that token's longest prefix token, and steps back when none is left.  A bit per position
remembers where the rest was found impossible, so no position is tried twice and the work is linear.

The compatibility check merges again: undoing the last merges of the two neighbours one at a time, from the latest on, it
looks whether a merge across their border would have come first.
"""

from __future__ import annotations

import codecs
import hashlib
import struct
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklode.llm.common import Cache, map_rows, read_file

SPACE = "▁"
MARKS = ".,;:!?$%&*#\n"


@dataclass(frozen=True)
class Vocabulary:
    """A merge-type vocabulary: the pieces by id, the byte ids, begin and end, and the merge that makes each piece."""

    pieces: tuple[str, ...]
    normal: np.ndarray  # bool by id: takes part in merges and is the merge result of its own text
    rank: np.ndarray  # order of the merge that makes it, below 0 for single characters
    left: np.ndarray
    right: np.ndarray
    shorter: np.ndarray  # longest proper prefix that is a token, or -1
    byte_ids: tuple[int, ...]
    control: tuple[int, ...]
    begin: int
    end: int


def merged(text: str, ids: dict[str, int], rank: dict[int, int]) -> tuple[list[str], tuple[str, str] | None]:
    """The merge result of a short text by plain repeated merging, leftmost of the best first; and the last merge."""
    parts, last = list(text), None
    while len(parts) > 1:
        best = min(
            ((rank[t], i) for i in range(len(parts) - 1) if (t := ids.get(parts[i] + parts[i + 1])) is not None), default=None
        )
        if best is None:
            break
        i = best[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> Vocabulary:
    """Read a sentencepiece model of merge type with byte fallback and no text normalization.

    Raises ValueError for models that normalize text in another way than marking spaces and putting one in front.
    """
    sp = sentencepiece.SentencePieceProcessor(model_proto=read_file(path))
    n = sp.get_piece_size()
    pieces = tuple(sp.id_to_piece(i) for i in range(n))
    byte_of = {i: int(pieces[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
    control = tuple(i for i in range(n) if sp.is_control(i))
    plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    probe = " a  b \tCÉéﬁ "
    if len(byte_of) != 256 or sp.decode(sp.encode(probe)) != probe or any(" " in pieces[i] for i in plain):
        raise ValueError("only merge-type vocabularies with byte fallback and without text normalization are supported")
    ids = {pieces[i]: i for i in plain}
    score = {i: sp.get_score(i) for i in plain}
    order = {i: k for k, i in enumerate(sorted((i for i in plain if len(pieces[i]) > 1), key=lambda i: (-score[i], i)))}
    order |= {i: -1 for i in plain if len(pieces[i]) == 1}
    normal, rank = np.zeros(n, bool), np.full(n, -1, np.int64)
    left, right, shorter = (np.full(n, -1, np.int64) for _ in range(3))
    for i in plain:
        parts, last = merged(pieces[i], ids, order)
        if len(parts) == 1:
            normal[i], rank[i] = True, order[i]
            if last:
                left[i], right[i] = ids[last[0]], ids[last[1]]
                if max(order[left[i]], order[right[i]]) >= order[i]:
                    raise ValueError(f"piece {i} is made of later pieces")
    for i in plain:
        if normal[i]:
            text = pieces[i]
            shorter[i] = next((ids[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in ids and normal[ids[text[:k]]]), -1)
    byte_ids = tuple(sorted(byte_of, key=byte_of.get))
    return Vocabulary(pieces, normal, rank, left, right, shorter, byte_ids, control, sp.bos_id(), sp.eos_id())


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one_byte", _one_byte)


class Encoder:
    """Encodes and decodes texts; lives in a worker and keeps bounded caches of words and of parts of words."""

    def __init__(self, v: Vocabulary, most: int = 400_000, longest: int = 64):
        self.v = v
        self.rank, self.left, self.right, self.shorter = v.rank.tolist(), v.left.tolist(), v.right.tolist(), v.shorter.tolist()
        self.length = [len(p) for p in v.pieces]
        self.longest, self.size = longest, len(v.pieces)
        usable = np.flatnonzero(v.normal).tolist()
        self.ids = {v.pieces[i]: i for i in usable}
        #: Two characters that no token holds side by side always have a border between them.
        self.inside = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.pair = {(self.left[i], self.right[i]): self.rank[i] for i in usable if self.left[i] >= 0}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if len(p) > 1:
                self.automaton.add_word(p, (len(p) - 1, i))
        self.automaton.make_automaton()
        self.parts = Cache(self._part, most)
        self.words = Cache(self._word, most)
        self.compatible = Cache(lambda ab: self._apart(*divmod(ab, self.size)), most)
        table = [b"" if i in v.control else p.replace(SPACE, " ").encode() for i, p in enumerate(v.pieces)]
        for byte, i in enumerate(v.byte_ids):
            table[i] = bytes([byte])
        self.table = table

    def _apart(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two tokens gives these two tokens."""
        rank, limit = self.rank, float("inf")
        while True:
            joined = self.pair.get((a, b))
            if joined is not None and joined < limit:
                return False
            if self.left[a] < 0 and self.left[b] < 0:
                return True
            if rank[a] > rank[b]:  # a was made last; at its own rank the merge to the left comes first
                limit, a = rank[a], self.right[a]
            else:
                limit, b = rank[b] + 1, self.left[b]

    def _backtrack(self, text: str) -> list[int]:
        n, size, length, shorter, compatible = len(text), self.size, self.length, self.shorter, self.compatible
        longest = [self.ids[c] for c in text]
        # Matches at a start come by growing end, so the last one is the longest.
        for end, (k, i) in self.automaton.iter(text):
            longest[end - k] = i
        failed = bytearray(n // 8 + 1)
        out = [longest[0]]
        at = length[longest[0]]
        while at < n:
            token, before = longest[at], out[-1] * size
            while True:
                while token >= 0:
                    end = at + length[token]
                    if not failed[end >> 3] >> (end & 7) & 1 and compatible[before + token]:
                        break
                    token = shorter[token]
                if token >= 0:
                    break
                # Nothing fits here after the token before: never come back to this position; shorten that token.
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                at -= length[token]
                token = shorter[token]
                if out:
                    before = out[-1] * size
                    continue
                while token >= 0 and failed[length[token] >> 3] >> (length[token] & 7) & 1:
                    token = shorter[token]
                if token < 0:
                    raise ValueError("the vocabulary cannot express this text")
                end = length[token]
                break
            out.append(token)
            at = end
        return out

    def _part(self, text: str) -> bytes:
        i = self.ids.get(text)
        if i is not None:
            ids = [i]
        elif len(text) == 1:
            ids = [self.v.byte_ids[b] for b in text.encode()]
        else:
            ids = self._backtrack(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _segment(self, text: str) -> bytes:
        """Cut where no token can lie across, and encode the parts."""
        inside, parts, out, start = self.inside, self.parts, [], 0
        for k in range(1, len(text)):
            if text[k - 1 : k + 1] not in inside:
                out.append(parts[text[start:k]] if k - start <= self.longest else self._part(text[start:k]))
                start = k
        out.append(parts[text[start:]] if len(text) - start <= self.longest else self._part(text[start:]))
        return b"".join(out)

    def _word(self, word: str) -> bytes:
        """A word with the space before it; most words are letters of the vocabulary with marks behind them."""
        stem = word.rstrip(MARKS)
        k = len(stem)
        if 0 < k <= self.longest and stem.isalpha() and all(map(self.ids.__contains__, stem)):
            if k == len(word):
                return self.parts[SPACE + word]
            if word[k - 1 : k + 1] not in self.inside:
                return self.parts[SPACE + stem] + self._segment(word[k:])
        return self._segment(SPACE + word)

    def encode(self, text: str) -> bytes:
        """Ids without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if text[0] == " " or "  " in text or text[-1] == " " or SPACE in text:
            return self._segment(SPACE + text.replace(" ", SPACE))
        words = text.split(" ")
        if len(max(words, key=len)) > self.longest:  # long words are not worth keeping
            return b"".join([self.words[w] if len(w) <= self.longest else self._word(w) for w in words])
        return b"".join(map(self.words.__getitem__, words))

    def decode(self, ids: list[int]) -> str:
        """Begin and end are left out, one space in front is taken off, bytes that are not UTF-8 become U+FFFD."""
        text = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "one_byte")
        first = next((i for i in ids if i not in self.v.control), None)
        return text[1:] if first is not None and self.v.pieces[first].startswith(SPACE) else text


_ENCODERS: dict[str, Encoder] = {}


def encoder(key: str, v: Vocabulary) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(v)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Ids of every whole text, with begin and end, checked by decoding them; the decoded text too if asked for.

    Columns: the id, ``n_tokens``, ``ids`` array<int>, ``exact`` (the decoded text is the text), ``decoded`` (null unless
    asked for).  A null text counts as empty, and an empty text has begin and end only.  Rows are mapped one to one within
    their tasks; ids may be null or repeat; an empty table gives an empty result.  The vocabulary is broadcast: its size is
    that of the model file, whatever the input.
    """
    v = read_vocabulary(path)
    key = hashlib.sha256(read_file(path)).hexdigest()
    held = docs.sparkSession.sparkContext.broadcast(v)
    begin, end = struct.pack("<I", v.begin), struct.pack("<I", v.end)

    def run(columns):
        e = encoder(key, held.value)
        out = [np.frombuffer(begin + e.encode(t or "") + end, "<u4").astype(np.int32) for t in columns[1]]
        back = [e.decode(i.tolist()) for i in out]
        exact = [b == (t or "") for b, t in zip(back, columns[1])]
        return [columns[0], [len(i) for i in out], out, exact, back if decoded else [None] * len(out)]

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, n_tokens long, ids array<int>, exact boolean, decoded string"
    return map_rows(docs.select(id_col, text_col), run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every document as digests, made where the ids are, so that only digests leave the worker.

    Columns: the id, ``n_tokens`` (begin and end count), ``ids_sha256``, ``decoded_sha256``, ``exact`` (the decoded text is
    the text).  Nulls, empty texts and repeated rows as in :func:`encode_documents`.
    """
    v = read_vocabulary(path)
    key = hashlib.sha256(read_file(path)).hexdigest()
    held = docs.sparkSession.sparkContext.broadcast(v)
    begin, end = struct.pack("<I", v.begin), struct.pack("<I", v.end)

    def run(columns):
        e = encoder(key, held.value)
        n, digests, texts, exact = [], [], [], []
        for t in columns[1]:
            packed = begin + e.encode(t or "") + end
            back = e.decode(np.frombuffer(packed, "<u4").tolist())
            n.append(len(packed) // 4)
            digests.append(hashlib.sha256(packed).hexdigest())
            texts.append(hashlib.sha256(back.encode()).hexdigest())
            exact.append(back == (t or ""))
        return [columns[0], n, digests, texts, exact]

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean"
    return map_rows(docs.select(F.col(id_col), F.col(text_col)), run, schema)
