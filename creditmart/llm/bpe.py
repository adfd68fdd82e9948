"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece there is exactly one token that ends its BPE encoding. An automaton of
all tokens with suffix links lists, for each prefix, the tokens that end there; the right one is
the token whose pair with the last token of the remaining prefix is one that merging would leave
alone. That pair test walks back through the merges of both tokens. The last tokens, followed back
from the end, are the encoding: no merge is ever carried out, and time is linear in the piece.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from creditmart.llm.tables import ready_workers, text_of

REMEMBERED = 250_000        # words and pieces that a worker remembers, twice; only time depends on it
LONGEST_REMEMBERED = 40

# A space that begins a word is where a piece begins, unless white space follows it.
LOOSE_SPACE = re.compile(r" (?:\s|$)")
# The published pre-tokenisation pattern, for words of Latin letters, digits and ASCII signs.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af"
LATIN = re.compile(rf"[\x21-\x7e\n{LETTERS}]*")
LATIN_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairs(dict):
    """A vocabulary with its automaton; ``encode`` and ``decode`` are exact inverses.

    As a dictionary it holds the ids of words it has met, with the space before them.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = byte_characters()
        vocabulary = spec["model"]["vocab"]
        # Ranks: single bytes first, then merges in file order. Tests compare ranks, not ids.
        self.rank_of = {t: r for r, t in enumerate(sorted(t for t in vocabulary if len(t) == 1))}
        self.parts = [(r, r) for r in self.rank_of.values()]
        self.merge_of: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = self.rank_of[left], self.rank_of[right]
            rank = self.rank_of.setdefault(left + right, len(self.parts))
            if rank == len(self.parts):
                self.parts.append(pair)
            self.merge_of.setdefault(pair, rank)
        self.id_of = [vocabulary[t] for t in self.rank_of]
        self.size_of = [len(t) for t in self.rank_of]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        as_bytes = str.maketrans({c: chr(b) for c, b in byte_of.items()})
        self.whole = {t.translate(as_bytes): vocabulary[t] for t in self.rank_of}
        for token, rank in self.rank_of.items():
            self.automaton.add_word(token.translate(as_bytes), rank)
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.specials = re.compile("(" + "|".join(
            re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in vocabulary.items()}
        tokens.update({i: t.encode() for t, i in self.special.items()})
        self.spelled = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)
        self.width = np.zeros(max(tokens) + 1, np.int64)
        self.width[list(tokens)] = [len(t) for t in tokens.values()]
        self.begin = np.cumsum(self.width) - self.width
        self.split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.compatible: dict[int, bool] = {}
        self.older: dict[str, bytes] = {}           # what was known before it grew too large
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` as neighbours, alone in a piece.

        Merges are undone from the latest to the earliest, on whichever side made the later one.
        At each step the two tokens that touch must not have a merge that would have come first.
        """
        limit = len(self.parts)
        while True:
            merged = self.merge_of.get((left, right))
            if merged is not None and merged < limit:
                return False
            if left > right:
                limit, left = left, self.parts[left][1]
                if left == limit:
                    return True
            else:
                inner = self.parts[right][0]
                if inner == right:
                    # Right is a byte, so is left: both ranks are below every merge.
                    return True
                limit, right = right + 1, inner

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece, given as a character for each of its bytes."""
        whole = self.whole.get(piece)
        if whole is not None:
            return whole.to_bytes(4, "little")
        start = len(self.parts)                     # what stands before the first token
        last = [start] * (len(piece) + 1)           # the unique last token of each prefix
        compatible, size_of, done = self.compatible, self.size_of, -1
        for end, rank in self.automaton.iter(piece):
            if end == done:
                continue
            left = last[end - size_of[rank]]
            pair = left << 32 | rank
            fit = compatible.get(pair)
            if fit is None:
                if len(compatible) >= 2 * REMEMBERED:
                    compatible.clear()
                fit = compatible[pair] = left == start or self.stays_apart(left, rank)
            if fit:
                last[end], done = rank, end
        ids, at = [], len(piece) - 1
        while at >= 0:                              # follow the back-pointers
            ids.append(self.id_of[last[at]])
            at -= size_of[last[at]]
        return np.array(ids[::-1], "<u4").tobytes()

    def _ids(self, text: str, latin: bool) -> bytes:
        out, known, old = [], self.pieces, self.older_pieces
        pieces = LATIN_PIECES.findall(text) if latin else \
            [text[a:b] for _, (a, b) in self.split(text)]
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = old.get(piece) or self._piece(piece.encode("utf-8").decode("latin-1"))
                if len(piece) <= LONGEST_REMEMBERED:
                    if len(known) >= REMEMBERED:
                        known, old = {}, known
                        self.pieces, self.older_pieces = known, old
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._ids(" " + word, LATIN.fullmatch(word) is not None)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for i, part in enumerate(self.specials.split(text) if self.special else [text]):
            if i % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            elif LOOSE_SPACE.search(part):
                out.append(self._ids(part, False))
            elif part:
                first, *words = part.split(" ")
                if first:
                    out.append(self._ids(first, False))
                out.extend(map(self.__getitem__, words))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        ids = np.frombuffer(ids, "<u4")
        width = self.width[ids]
        shift = self.begin[ids] - (np.cumsum(width) - width)
        spelled = self.spelled[np.arange(width.sum()) + np.repeat(shift, width)]
        return spelled.tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> BytePairs:
    return BytePairs(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: ids as binary, little-endian unsigned 32-bit integers.

    One row per input row. A null text is empty and has no ids, as has the empty one; the string of
    a special token inside a text is that token. Other columns are ignored. ``path`` names a
    byte-level vocabulary file in the tokenizers format that every executor can read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = vocabulary(path)
        for batch in batches:
            ids = pa.array([pairs.encode(t) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.record_batch([batch.column(0), ids], ["doc_id", "ids"])

    ready_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` of ``encode``'s rows; bytes that are no UTF-8 become U+FFFD."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = vocabulary(path)
        for batch in batches:
            texts = pa.array([pairs.decode(i) for i in batch.column(1).to_pylist()], pa.string())
            yield pa.record_batch([*batch.columns, texts], ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(work, f"doc_id {kind}, ids binary, text string")
