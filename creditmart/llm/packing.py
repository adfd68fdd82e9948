"""Packing documents into training sequences by lexical retrieval.

Documents are tokenised once and stored. Document frequencies over all of them weigh the terms, and
each document is dealt into a shard by its rarest term, so that documents with rare terms in common
meet. A shard keeps a BM25 inverted index over blocks of bounded size: the document that opens a
window is the seed, the index returns its nearest unused neighbours, and they fill the window. A
document that does not fit is cut there and its rest is the next seed, so only the last sequence of
a shard has padding.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.bpe import byte_characters
from creditmart.llm.tables import Scratch, Stored, frugal, keeps, ready_workers, text_of

WINDOW = 2048
END_ID = 1                          # closes every document
BLOCK_TOKENS = 4 << 20              # tokens indexed together
SHARD_TOKENS = 16 << 20             # tokens of a shard, one task's work
QUERY_TERMS = 16                    # terms of a seed that are looked up
K1, B = 1.2, 0.75                   # the usual BM25 constants
TERMS = 1 << 16                     # ids are stored in 16 bits
REMEMBERED, LONGEST_REMEMBERED = 200_000, 40    # words and pieces of a worker, twice; only time depends on it

# Words of Latin letters, digits and ASCII signs, and their pieces under the published pattern.
LETTERS = "a-z\xc0-\xd6\xd8-\xf6\xf8-įı-ʯ"
ENDING = ".,:;!?"
SIMPLE = re.compile(rf"([{LETTERS}]+)([{ENDING}]*)").fullmatch       # two pieces at most
LATIN = re.compile(rf"[\x21-\x7e{LETTERS}]*").fullmatch
PLAIN = re.compile(rf"[ -~\n{LETTERS}]*").fullmatch                    # texts of such words alone
LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+").findall


class Words(dict):
    """Ids by word, as the tokenizers library gives them: words not met before are worked out.

    A piece of a word has the ids that it has as a word, so both are remembered in one place. Of
    texts with Latin words alone, each word is looked up once for all texts of a batch, and only
    its pieces are remembered.
    """

    def __init__(self, path: str):
        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        if self.tokenizer.get_vocab_size() > TERMS:
            raise ValueError("ids must fit in 16 bits")
        self.spelling = {b: c for c, b in byte_characters().items()}
        self.tokenizer.model._resize_cache(0)       # what it is asked for is remembered here
        self.tokens = self.tokenizer.model.tokenize
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.older: dict[str, bytes] = {}           # what was known before it grew too large

    def _remember(self, text: str, ids: bytes) -> bytes:
        if len(text) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
                self[""] = b""
            self[text] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            spelled = piece if piece.isascii() else \
                piece.encode("utf-8").decode("latin-1").translate(self.spelling)
            ids = array("H", [t.id for t in self.tokens(spelled)]).tobytes()
        return self._remember(piece, ids)

    def _word(self, word: str) -> bytes:
        lower = word.lower()
        if simple := SIMPLE(lower):
            letters, rest = simple.groups()
            ids = self.get(letters) or self._piece(letters)
            return ids + (self.get(rest) or self._piece(rest)) if rest else ids
        if LATIN(lower) and not ("<|" in word and any(s in word for s in self.special)):
            known, piece = self.get, self._piece
            return b"".join([known(p) or piece(p) for p in LATIN_PIECES(lower)])
        return array("H", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        return self._remember(word, self._word(word) if ids is None else ids)

    def encode(self, text: str) -> bytes:
        """Ids in 16 bits each. Spaces and line feeds separate pieces under any pattern."""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def encode_all(self, texts: list[str], closing: bytes = b"") -> list[bytes]:
        """Ids of each text, and ``closing``."""
        lower = [t.lower() for t in texts]
        plain = [i for i, t in enumerate(lower) if PLAIN(t) and "<|" not in t]
        found = [b""] * len(texts)
        for i in sorted(set(range(len(texts))).difference(plain)):
            found[i] = self.encode(texts[i]) + closing
        split = pc.ascii_split_whitespace(pa.array([lower[i] for i in plain], pa.large_string()))
        coded = split.values.dictionary_encode()
        known, piece, ids = self.get, self._piece, []
        for word in coded.dictionary.to_numpy(zero_copy_only=False):
            of_word = known(word)
            if of_word is None:
                letters = word.rstrip(ENDING)
                if letters.isalpha():
                    of_word = known(letters) or piece(letters)
                    if rest := word[len(letters):]:
                        of_word += known(rest) or piece(rest)
                else:
                    of_word = b"".join([known(p) or piece(p) for p in LATIN_PIECES(word)])
            ids.append(of_word)
        _, begins, data = pa.array(ids, pa.large_binary()).take(coded.indices).buffers()
        begins = np.frombuffer(begins, np.int64) if begins else np.zeros(1, np.int64)
        ends, data = begins[split.offsets.to_numpy()].tolist(), memoryview(data or b"")
        for i, begin, end in zip(plain, ends, ends[1:]):
            found[i] = bytes(data[begin:end]) + closing
        return found


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


keeps("packing", words.cache_clear)       # also for the tasks of the index, which need no vocabulary


def tokenise(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int = END_ID) -> DataFrame:
    """``doc_id, ids``: ids of each row's text and ``end_id``, as binary with 16 bits each.

    A null text counts as empty and has ``end_id`` alone. Other columns are ignored.
    """
    closing = np.array([end_id], "<u2").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = words(path).encode_all
        for batch in batches:
            ids = pa.array(encode(batch.column(1).to_pylist(), closing), pa.binary())
            yield pa.record_batch([batch.column(0), ids], ["doc_id", "ids"])

    ready_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(frugal("packing", work), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def _by_document(ids: list[np.ndarray]) -> np.ndarray:
    """The ids of some documents, each with its document's number above it, in order."""
    kind = np.uint32 if len(ids) < TERMS else np.uint64
    number = np.repeat(np.arange(len(ids), dtype=kind), [len(i) for i in ids])
    return np.sort((number << kind(16)) | np.concatenate(ids))


def _starts(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)])


def document_frequencies(stored: Stored) -> tuple[np.ndarray, int]:
    """In how many documents each id occurs, and the tokens of all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, tokens = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            packed = [np.frombuffer(ids.as_py(), "<u2") for ids in batch.column(0)]
            terms = _by_document(packed)
            found += np.bincount(terms[_starts(terms)] & (TERMS - 1), minlength=TERMS)
            tokens += len(terms)
        terms = np.flatnonzero(found)
        yield pa.record_batch([np.r_[terms, -1], np.r_[found[terms], tokens]], ["term", "n"])

    rows = (stored.df.select("ids").mapInArrow(frugal("packing index", count), "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())      # a row per vocabulary id
    found = np.zeros(TERMS + 1, np.int64)
    found[[r.term for r in rows]] = [r.n for r in rows]
    return found[:TERMS], int(found[TERMS])


class Block:
    """A BM25 index over some documents, which are handed out once each."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float):
        lengths = np.array([len(i) for i in ids])
        order = _by_document(ids)
        at = _starts(order)
        doc, term = (order[at] >> 16).astype(np.int32), order[at].astype(np.uint16)
        tf = np.diff(np.r_[at, len(order)])
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / mean))
        self.begins = np.searchsorted(doc, np.arange(len(ids) + 1))
        self.term, self.impact = term, impact
        by_term = np.argsort(term, kind="stable")
        self.posted_doc, self.posted_impact = doc[by_term], impact[by_term]
        self.opens = np.searchsorted(term[by_term], np.arange(TERMS + 1))
        self.free = np.ones(len(ids), bool)
        self.next = 0

    def take(self, doc: int) -> int:
        self.free[doc] = False
        return doc

    def first(self) -> int | None:
        """The first unused document."""
        while self.next < len(self.free) and not self.free[self.next]:
            self.next += 1
        return self.take(self.next) if self.next < len(self.free) else None

    def scores(self, seed: int) -> np.ndarray:
        """What each document scores for the seed's weightiest terms."""
        a, b = self.begins[seed], self.begins[seed + 1]
        impact, terms = self.impact[a:b], self.term[a:b]
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(impact, -QUERY_TERMS)[-QUERY_TERMS:]]
        spans = [slice(*self.opens[int(t):int(t) + 2]) for t in terms]
        docs = np.concatenate([self.posted_doc[s] for s in spans])
        found = np.concatenate([self.posted_impact[s] for s in spans])
        return np.bincount(docs, found, minlength=len(self.free))

    def neighbour(self, scores: np.ndarray) -> int | None:
        """The unused document that scores best, if any scores."""
        left = scores * self.free
        best = int(np.argmax(left))
        return self.take(best) if left[best] > 0 else None


class Sequences:
    """Cuts a stream of documents into windows and lists the pieces."""

    FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def __init__(self, shard: int, window: int):
        self.sequence, self.window, self.used = shard << 32, window, 0
        self.pieces: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        wide, start = ids.astype("<u4"), 0
        while start < len(ids):
            length = min(len(ids) - start, self.window - self.used)
            self.pieces.append((doc_id, start, length, zlib.crc32(wide[start:start + length]),
                                len(ids), self.sequence, self.used))
            start += length
            self.used += length
            if self.used == self.window:
                self.sequence, self.used = self.sequence + 1, 0

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*self.pieces)) or [[]] * len(self.FIELDS)
        self.pieces = []
        return pa.record_batch([pa.array(columns[0], id_type),
                                *[pa.array(c, pa.int64()) for c in columns[1:]]], self.FIELDS)


def _fill(block: Block, ids: list[np.ndarray], doc_ids: list, out: Sequences) -> None:
    """Fills each window with the neighbours of the document that opens it, best first.

    Where the seed has none left, the first unused document is taken and is the seed of the rest.
    """
    doc, scores = block.first(), None
    while doc is not None:
        window = out.sequence if out.used else None
        out.add(doc_ids[doc], ids[doc])
        if scores is None or window != out.sequence:
            scores = block.scores(doc)
        doc = block.neighbour(scores)
        if doc is None:
            doc, scores = block.first(), None


def pack(stored: Stored, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents of ``doc_id, ids``, each id in exactly one.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: the piece holds
    ``length`` ids from ``start`` of its document and lies at ``offset`` of its sequence. Sequences
    hold ``window`` ids, save the last of each shard. Rows that repeat an id are documents of their
    own; equal scores go to the document that comes first by rarest term, then id.
    """
    spark = stored.df.sparkSession
    ready_workers(spark)
    frequency, tokens = document_frequencies(stored)
    n = max(stored.rows, 1)
    idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
    mean = max(tokens / n, 1.0)
    # Terms of one document only lead nowhere, so they come last.
    rarity = np.where(frequency > 1, frequency, n + 1)
    id_type = stored.df.schema["doc_id"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rarest = []
            for ids in batch.column(1):
                ids = np.frombuffer(ids.as_py(), "<u2")
                rarest.append(int(ids[np.argmin(rarity[ids])]))
            yield pa.record_batch([*batch.columns, pa.array(rarest, pa.int32())],
                                  ["doc_id", "ids", "term"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, kind = Sequences(TaskContext.get().partitionId(), window), None
        doc_ids, ids, size = [], [], 0
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(np.frombuffer(packed.as_py(), "<u2"))
                doc_ids.append(doc_id)
                size += len(ids[-1])
                if size >= BLOCK_TOKENS:
                    _fill(Block(ids, idf, mean), ids, doc_ids, out)
                    yield out.batch(kind)
                    doc_ids, ids, size = [], [], 0
        if ids:
            _fill(Block(ids, idf, mean), ids, doc_ids, out)
            yield out.batch(kind)

    shards = max(1, -(-tokens // SHARD_TOKENS))
    dealt = (stored.df.mapInArrow(frugal("packing index", deal), f"doc_id {id_type}, ids binary, term int")
             .repartitionByRange(shards, "term", "doc_id").sortWithinPartitions("term", "doc_id"))
    return dealt.select("doc_id", "ids").mapInArrow(
        frugal("packing index", fill), f"doc_id {id_type}, " + ", ".join(f"{f} long" for f in Sequences.FIELDS[1:]))


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """All rows of ``docs`` tokenised with the vocabulary file at ``path``, and packed."""
    return pack(Scratch(docs.sparkSession).save(tokenise(docs, path), "tokens"), window)
