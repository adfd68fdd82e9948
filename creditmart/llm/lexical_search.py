"""Ranked lexical search with Block-Max MaxScore over a sharded index.

Every task turns its documents into segments: for each term the documents that hold it, in blocks of
BLOCK, packed, with what bounds a block's scores beside it. Segments are gathered into shards, and a
shard is searched by a group of items at a time. Terms whose bounds together cannot reach the score of
the last hit so far are non-essential: only documents of the other terms are candidates. The block
bounds of the non-essential terms then reject candidates, and only blocks with candidates left are
unpacked. The hits of all shards are merged in a tree.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm import vectors
from creditmart.llm.tables import Scratch, Stored, fits, ready_workers

TOP = 20
BLOCK = 128                         # postings packed together
SEGMENT_TOKENS = 1 << 20            # tokens a task indexes at once
SHARD_TOKENS = 4 << 20              # tokens that one task searches
ITEM_GROUP = 256                    # items that search a shard together
SPAN = 4096                         # documents looked at in one step
SALT = 32                           # pieces of a term's lists where both sides are shuffled
ROWS_OUT = 20_000

# A-Z in lower case; what is not a letter or digit of ASCII, nor beyond ASCII, becomes a space.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
# Of a block: first and last document, postings, bytes of a gap and of a frequency, the highest
# frequency, and the fewest terms of a document that has the term once, or more often.
HEADER = np.dtype([("first", "<u4"), ("last", "<u4"), ("n", "<u4"), ("gap", "u1"), ("times", "u1"),
                   ("most", "<u4"), ("once", "<u4"), ("often", "<u4")])
NONE = 0xFFFFFFFF
HELD = ["segment", "term", "blocks", "data", "docs", "lengths"]       # what a shard reads of an index


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(FOLDED).split()


def _widths(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)).astype(np.int64)


def _sliced(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Slices of an array of bytes as binary values."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [
        None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _scattered(out: np.ndarray, at: np.ndarray, values: np.ndarray, widths: np.ndarray) -> None:
    """Writes each value in its width, lowest byte first."""
    for width in (1, 2, 4):
        chosen = np.flatnonzero(widths == width)
        for byte in range(width):
            out[at[chosen] + byte] = (values[chosen] >> (8 * byte)) & 255


def packed_lists(doc: np.ndarray, term: np.ndarray, times: np.ndarray, lengths: np.ndarray,
                 terms: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """How many postings each term has, and the headers and the contents of its blocks.

    Postings come in order of term and document.
    """
    begins = np.searchsorted(term, np.arange(terms + 1))
    place = np.arange(len(doc)) - begins[term]
    opens = np.flatnonzero(place % BLOCK == 0)
    header = np.zeros(len(opens), HEADER)
    sizes = np.diff(np.r_[opens, len(doc)])
    header["first"], header["last"], header["n"] = doc[opens], doc[opens + sizes - 1], sizes
    gaps = np.diff(doc, prepend=0)
    gaps[opens] = 0
    header["gap"] = gap = _widths(np.maximum.reduceat(gaps, opens))
    header["most"] = most = np.maximum.reduceat(times, opens)
    header["times"] = wide = _widths(most)
    own = lengths[doc]
    header["once"] = np.minimum.reduceat(np.where(times == 1, own, NONE), opens)
    header["often"] = np.minimum.reduceat(np.where(times > 1, own, NONE), opens)
    ends = np.cumsum(sizes * (gap + wide))
    at = ends - sizes * (gap + wide)
    within = place % BLOCK
    of = np.repeat(np.arange(len(opens)), sizes)
    data = np.zeros(int(ends[-1]), np.uint8)
    _scattered(data, at[of] + within * gap[of], gaps, gap[of])
    _scattered(data, at[of] + sizes[of] * gap[of] + within * wide[of], times, wide[of])
    blocks = np.searchsorted(opens, begins)
    return (np.diff(begins), _sliced(header.view(np.uint8), blocks * HEADER.itemsize),
            _sliced(data, np.r_[at, ends[-1]][blocks]))


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of ``docs``: ``segment, term, n, tokens, blocks, data, docs, lengths``.

    A row per segment and term, with its ``n`` documents; and a row per segment without a term, with
    its documents and how many terms each and all have. Documents without terms are in no segment.
    """
    id_type, most = docs.schema[id_col].dataType, SEGMENT_TOKENS

    def segment(number: int, ids: list, numbers: list[np.ndarray], vocabulary: dict, kind: pa.DataType
                ) -> Iterator[pa.RecordBatch]:
        names = ["segment", "term", "n", "tokens", *HELD[2:]]
        lengths = np.array([len(x) for x in numbers], np.int64)
        keys = np.concatenate(numbers).astype(np.int64) << 32 | np.repeat(np.arange(len(ids)), lengths)
        keys.sort()
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        times, keys = np.diff(np.r_[at, len(keys)]), keys[at]
        n, blocks, data = packed_lists(keys & NONE, keys >> 32, times, lengths, len(vocabulary))
        yield pa.record_batch(
            [pa.array([number]), pa.nulls(1, pa.binary()), pa.array([len(ids)]),
             pa.array([int(lengths.sum())]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([ids], pa.list_(kind)),
             pa.array([lengths.astype("<u4").tobytes()], pa.binary())], names)
        terms = pa.array(list(vocabulary), pa.binary())
        for a in range(0, len(terms), ROWS_OUT):
            rows = min(ROWS_OUT, len(terms) - a)
            yield pa.record_batch(
                [pa.array(np.full(rows, number)), terms[a:a + rows], pa.array(n[a:a + rows]),
                 pa.nulls(rows, pa.int64()), blocks[a:a + rows], data[a:a + rows], pa.nulls(rows, pa.list_(kind)),
                 pa.nulls(rows, pa.binary())], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, kind = TaskContext.get().partitionId() << 24, None
        ids, numbers, size, vocabulary = [], [], 0, defaultdict(count().__next__)
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                ids.append(doc_id)
                numbers.append(np.fromiter(map(vocabulary.__getitem__, terms), np.uint32, len(terms)))
                size += len(terms)
                if size >= most:
                    yield from segment(number, ids, numbers, vocabulary, kind)
                    number += 1
                    ids, numbers, size, vocabulary = [], [], 0, defaultdict(count().__next__)
        if ids:
            yield from segment(number, ids, numbers, vocabulary, kind)

    ready_workers(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).mapInArrow(
        work, "segment long, term binary, n long, tokens long, blocks binary, data binary, "
              f"docs array<{id_type.simpleString()}>, lengths binary")


def asked_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, item_id, terms``: each row's terms and how often it has them, under a number."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            terms = [[{"term": t, "times": n} for t, n in Counter(terms_of(x)).items()]
                     for x in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [pa.array(range(number, number + len(terms)), pa.int64()), batch.column(0),
                 pa.array(terms, pa.list_(pa.struct([("term", pa.binary()), ("times", pa.int64())])))],
                ["item", "item_id", "terms"])
            number += len(terms)

    ready_workers(items.sparkSession)
    return items.select(F.col(id_col).alias("item_id"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).mapInArrow(
        work, f"item long, item_id {items.schema[id_col].dataType.simpleString()}, "
              "terms array<struct<term: binary, times: bigint>>")


def impact(times: np.ndarray, damp: np.ndarray) -> np.ndarray:
    """What a term that a document holds so often adds, per unit of weight."""
    return 1_000_000_000 * times // (1000 * times + 12 * damp)


class Lists:
    """A term's postings in a shard. A block is unpacked when it is first needed."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]], shard: "Shard"):
        headers = [np.frombuffer(blocks, HEADER) for _, blocks, _ in rows]
        header = np.concatenate(headers)
        base = np.repeat([b for b, _, _ in rows], [len(h) for h in headers])
        self.data = np.frombuffer(b"".join(d for _, _, d in rows), np.uint8)
        self.shard, self.header, self.base = shard, header, base
        self.first, self.last = header["first"] + base, header["last"] + base
        n = header["n"].astype(np.int64)
        size = n * (header["gap"].astype(np.int64) + header["times"])
        self.at, self.place = np.cumsum(size) - size, np.r_[0, np.cumsum(n)]
        bound = lambda times, fewest: np.where(fewest == NONE, 0, impact(
            times, shard.damp(fewest.astype(np.int64))))
        self.bounds = np.maximum(bound(np.ones(len(n), np.int64), header["once"]),
                                 bound(header["most"].astype(np.int64), header["often"]))
        self.top = int(self.bounds.max())
        self.docs, self.impacts = np.repeat(self.last, n), np.zeros(int(self.place[-1]), np.int64)
        self.ready = np.zeros(len(n), bool)

    def unpack(self, blocks: np.ndarray) -> None:
        for b in blocks[~self.ready[blocks]].tolist():
            h, at = self.header[b], int(self.at[b])
            n, gap, wide = int(h["n"]), int(h["gap"]), int(h["times"])
            part = slice(self.place[b], self.place[b + 1])
            docs = np.cumsum(self.data[at:at + n * gap].view(f"<u{gap}"), dtype=np.int64) + self.first[b]
            times = self.data[at + n * gap:at + n * (gap + wide)].view(f"<u{wide}").astype(np.int64)
            self.docs[part], self.impacts[part] = docs, impact(times, self.shard.damps[docs])
            self.ready[b] = True

    def span(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``lo`` on before ``hi`` and their impacts."""
        a, b = np.searchsorted(self.last, lo), np.searchsorted(self.first, hi)
        if a >= b:
            return self.docs[:0], self.impacts[:0]
        self.unpack(np.arange(a, b))
        part = self.docs[self.place[a]:self.place[b]]
        inside = slice(self.place[a] + np.searchsorted(part, lo), self.place[a] + np.searchsorted(part, hi))
        return self.docs[inside], self.impacts[inside]

    def blocks_of(self, docs: np.ndarray) -> np.ndarray:
        """The block that may hold each document, or -1."""
        b = np.searchsorted(self.last, docs)
        found = b < len(self.last)
        found[found] = self.first[b[found]] <= docs[found]
        return np.where(found, b, -1)

    def found(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The impact in each document, 0 where it does not hold the term."""
        out, some = np.zeros(len(docs), np.int64), np.flatnonzero(blocks >= 0)
        if len(some):
            self.unpack(np.unique(blocks[some]))
            at = np.searchsorted(self.docs, docs[some])
            out[some] = np.where(self.docs[at] == docs[some], self.impacts[at], 0)
        return out


class Shard:
    """Segments that are searched together; ``n`` and ``tokens`` are of all documents of the index."""

    def __init__(self, held: pa.Table, n: int, tokens: int):
        self.n, self.tokens = n, tokens
        is_head = pc.is_null(held["term"])
        heads, lists = held.filter(is_head), held.filter(pc.invert(is_head))
        self.ids = pa.chunked_array([c.flatten() for c in heads["docs"].chunks]).combine_chunks()
        lengths = [np.frombuffer(x, "<u4") for x in heads["lengths"].to_pylist()]
        bases = np.cumsum([0, *map(len, lengths)])
        base = dict(zip(heads["segment"].to_pylist(), bases.tolist()))
        self.damps = self.damp(np.concatenate(lengths).astype(np.int64))
        # The document that comes first by id, null last, wins where scores are equal.
        order = pc.sort_indices(self.ids, null_placement="at_end").to_numpy()
        self.size = len(order)
        self.bonus = np.empty(self.size, np.int64)
        self.bonus[order] = np.arange(self.size - 1, -1, -1)
        self.rows = defaultdict(list)
        for segment, term, blocks, data in zip(*[lists[c].to_pylist() for c in ("segment", "term", "blocks", "data")]):
            self.rows[term].append((base[segment], blocks, data))
        self.lists: dict[bytes, Lists] = {}

    def damp(self, lengths: np.ndarray) -> np.ndarray:
        return 75 + 25 * lengths * self.n // self.tokens

    def of(self, term: bytes) -> Lists | None:
        if term in self.rows:
            self.lists[term] = Lists(sorted(self.rows.pop(term), key=lambda r: r[0]), self)
        return self.lists.get(term)

    def search(self, weights: list[tuple[bytes, int]], k: int, span: int = SPAN) -> list[tuple[int, int]]:
        """Score and document of the ``k`` best, above 0, best first.

        Scores are compared as keys, with the order of ids below them.
        """
        lists = [(w * found.top, w, found) for t, w in weights if w > 0 and (found := self.of(t))]
        lists.sort(key=lambda x: x[0])
        reach = np.cumsum([bound for bound, _, _ in lists])
        size, keys, docs = self.size, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lo in range(0, size, span):
            hi = min(lo + span, size)
            least = int(keys[-1]) if len(keys) == k else size - 1       # to be passed by a hit
            rest = int(np.searchsorted(reach, least // size))           # terms that alone cannot pass it
            scores = np.zeros(hi - lo, np.int64)
            for _, w, found in lists[rest:]:
                at, gain = found.span(lo, hi)
                scores[at - lo] += w * gain
            some = np.flatnonzero(scores)
            scores, some = scores[some], some + lo
            blocks = [found.blocks_of(some) for _, _, found in lists[:rest]]
            bounds = [np.where(b >= 0, w * found.bounds[b], 0) for b, (_, w, found) in zip(blocks, lists)]
            open_ = sum(bounds, np.zeros(len(some), np.int64))
            for i in range(rest - 1, -1, -1):
                left = (scores + open_) * size + self.bonus[some] > least
                if not left.all():
                    some, scores, open_ = some[left], scores[left], open_[left]
                    blocks, bounds = [b[left] for b in blocks[:i + 1]], [b[left] for b in bounds[:i + 1]]
                if not len(some):
                    break
                scores += lists[i][1] * lists[i][2].found(some, blocks[i])
                open_ -= bounds[i]
            own = scores * size + self.bonus[some]
            passed = own > least
            keys, docs = np.r_[keys, own[passed]], np.r_[docs, some[passed]]
            if len(keys) > k:
                by = np.argpartition(-keys, k - 1)[:k]
                keys, docs = keys[by], docs[by]
            by = np.argsort(-keys)
            keys, docs = keys[by], docs[by]
        return list(zip((keys // size).tolist(), docs.tolist()))


def _chosen(index: DataFrame, wanted: Stored) -> DataFrame:
    """The lists of ``wanted`` (term, group), whose terms may be of any frequency."""
    lists = index.where(F.col("term").isNotNull())
    if fits(wanted, 128):
        return lists.join(F.broadcast(wanted.df), "term")
    salted = wanted.df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return lists.withColumn("_salt", F.pmod("segment", F.lit(SALT)).cast("int")).join(
        salted, ["term", "_salt"]).drop("_salt")


def search(items: DataFrame, docs: DataFrame, k: int = TOP, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 per item.

    Terms are runs of letters and digits of ASCII and all characters beyond it, with A-Z in lower
    case. A term weighs floor(1000 * ln((2 N + 2) / (2 df + 1))), with df of the N documents that have
    terms holding it. A document that holds it tf times adds 10^9 tf div (1000 tf + 12 m) for each time
    that the item has it, where m is 75 + 25 n N div L for its n terms out of all L. Equal scores go by smaller id, null last.
    A null text has no terms; an item without hits has no rows. Items that repeat an id are answered
    one by one, and documents that repeat one are hits of their own. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    index = scratch.save(index_documents(docs, id_col, text_col), "index").df
    asked = scratch.save(asked_terms(items, item_col, item_text), "asked")
    groups = max(1, -(-asked.rows // ITEM_GROUP))
    asked = asked.df.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int"))
    spelled = asked.select("item", "item_id", "group", F.inline("terms"))
    wanted = scratch.save(spelled.select("term", "group").distinct(), "wanted")
    heads = index.where(F.col("term").isNull())
    n, tokens = heads.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "tokens")]).first()
    found = scratch.save(_chosen(index, wanted), "found").df
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.sum("n") + 1))).cast("long")
    weights = found.groupBy("group", "term").agg(weight.alias("weight"))
    asked = spelled.join(weights, ["group", "term"]).groupBy("group", "item", "item_id").agg(
        F.collect_list(F.struct("term", (F.col("times") * F.col("weight")).alias("weight"))).alias("terms"))
    shards = max(1, -(-tokens // SHARD_TOKENS))
    shard = F.pmod(F.xxhash64("segment"), F.lit(shards)).cast("int").alias("shard")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = found.select(*HELD, "group", shard).unionByName(heads.select(*HELD, every(groups).alias("group"), shard))
    id_type, span = docs.schema[id_col].dataType, SPAN

    def work(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if len(asked) and len(held):
            shard = Shard(held, n, tokens)
            for item, terms in zip(asked["item"].to_pylist(), asked["terms"].to_pylist()):
                hits = shard.search([(t["term"], t["weight"]) for t in terms], k, span)
                ids = [shard.ids[doc].as_py() for _, doc in hits]
                out.append((item, held["shard"][0].as_py(), [
                    {"cost": -score, "unknown": i is None, "doc_id": i} for (score, _), i in zip(hits, ids)]))
        kind = pa.list_(pa.struct([("cost", pa.int64()), ("unknown", pa.bool_()),
                                   ("doc_id", held["docs"].type.value_type)]))
        columns = list(zip(*out)) or [[]] * 3
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                         pa.array(columns[2], kind)], ["item", "shard", "top"])

    hits = vectors.cogrouped(asked.withColumn("shard", every(shards)), held, groups * shards,
                             "item long, shard int, top array<struct<cost: bigint, unknown: boolean, "
                             f"doc_id: {id_type.simpleString()}>>", work)
    ranked = vectors.merged(hits, ["item"], shards, k)
    ranked = ranked.join(asked.select("item", "item_id"), "item").select(
        "item_id", F.posexplode("top").alias("rank", "hit"))
    return ranked.select("item_id", (F.col("rank") + 1).alias("rank"), "hit.doc_id",
                         (-F.col("hit.cost")).alias("score"))
