"""Removal of byte strings that repeat, found on Burrows-Wheeler transforms of bounded blocks.

Every string of LENGTH bytes has an anchor: of its GRAM-byte grams the one with the smallest hash,
the leftmost of equal ones. Equal strings have equal anchors, so strings need to meet only where
anchors do. The strings in a row that share one anchor are a segment. Segments whose anchor occurs
once repeat nothing; equal segments repeat as a whole and count as one from then on. What is left
are anchors with several different segments. Their bytes are dealt into blocks by anchor, and each
block's Burrows-Wheeler transform is searched breadth first: backward extension finds the places
where neighbouring suffixes have common prefixes of 0, 1, 2 ... bytes, and stops at LENGTH. Where
nothing was found, neighbours share LENGTH bytes or more.

An anchor with more segments than a block should hold is split further, by the content of its
strings: equal strings are counted, with partial counts made where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from creditmart.llm.tables import Scratch, Stored, fits, frugal, ready_workers, text_of, with_size

LENGTH, GRAM = 200, 80
CHUNK = 1 << 20             # bytes hashed together
PART = 8 << 20              # longer texts are hashed in parts
BLOCK_BYTES = 512 << 10     # bytes of a transform: small enough for a processor's cache
CROWDED = 20_000            # segments of one anchor beyond which it is split
INDEX_BITS = np.uint64(24)
SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each position, built from those of powers of two."""
    with np.errstate(over="ignore"):
        power, step = np.uint64(0x9E3779B97F4A7C15), 1
        block, found, length = data.astype(np.uint64) + np.uint64(1), None, 0
        while True:
            if size & step:
                if found is None:
                    found = block
                else:
                    n = len(block) - length
                    found = found[:n] * power + block[length:]
                length += step
            if length == size:
                break
            block = block[:-step] * power + block[step:]
            power, step = power * power, 2 * step
        found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return found ^ (found >> np.uint64(29))


def segments(data: bytes, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Begin, end and anchor hash of each segment of texts that lie end to end in ``data``.

    ``bounds`` are the texts' first bytes and the end of the last. A segment's end is that of its
    last string.
    """
    hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
    window, step = length - gram + 1, 1
    least = (hashes >> INDEX_BITS << INDEX_BITS) | np.arange(len(hashes), dtype=np.uint64)
    while 2 * step <= window:
        least, step = np.minimum(least[:-step], least[step:]), 2 * step
    if step < window:
        least = np.minimum(least[:step - window], least[window - step:])
    anchor = (least & np.uint64((1 << int(INDEX_BITS)) - 1)).astype(np.int64)
    text = np.searchsorted(bounds, np.arange(len(anchor)), side="right")
    whole = np.arange(len(anchor)) + length <= bounds[np.minimum(text, len(bounds) - 1)]
    change = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
                                  | (whole[1:] != whole[:-1])])
    stop = np.r_[change[1:], len(anchor)]
    own = whole[change]
    return change[own], stop[own] + length - 1, hashes[anchor[change[own]]]


def _chunks(texts: list[bytes], length: int):
    """Texts joined into chunks: bytes, bounds, and for each text its row and first byte there."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for first in range(0, max(len(text) - length + 1, 0), PART):
            part = text[first:first + PART + length - 1]
            held.append((row, first, part))
            size += len(part)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def occurrences(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, _hash, start, len, anchor, seg`` of every segment of ``doc_id, _hash, text``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8") for t in batch.column(2).to_pylist()]
            for held in _chunks(texts, length):
                data = b"".join(part for _, _, part in held)
                ends = np.cumsum([len(part) for _, _, part in held])
                begin, end, anchor = segments(data, np.r_[0, ends], length, gram)
                content = [xxhash.xxh3_64_intdigest(data[a:b])
                           for a, b in zip(begin.tolist(), end.tolist())]
                part = np.searchsorted(ends, begin, side="right")
                rows = np.array([row for row, _, _ in held])[part]
                shift = np.array([first for _, first, _ in held]) - np.r_[0, ends[:-1]]
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                     pa.array((begin + shift[part]).astype(np.int32)),
                     pa.array((end - begin).astype(np.int32)), pa.array(anchor.view(np.int64)),
                     pa.array(np.array(content, np.uint64).view(np.int64))],
                    ["doc_id", "_hash", "start", "len", "anchor", "seg"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "_hash", "text").mapInArrow(
        frugal("suffix", work), f"doc_id {kind}, _hash long, start int, len int, anchor long, seg long")


class Transform:
    """The Burrows-Wheeler transform of some texts, each ended by a mark of its own."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
        self.lengths = np.array([len(t) for t in texts])
        self.begins = np.cumsum(self.lengths + 1) - self.lengths - 1
        joined[self.begins + self.lengths] = 0
        self.symbols, n = joined, len(joined)
        longest = int(self.lengths.max()) + 1
        key, step = np.zeros(n, np.int64), 7
        for i in range(step):
            key <<= 9
            key[:n - i] |= joined[i:]
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
            if step >= longest or rank[order[-1]] == n - 1:
                break
            key = rank * (n + 1)
            key[:n - step] += rank[step:] + 1
            step *= 2
        self.order = order.astype(np.int32)

    def repeated(self, length: int) -> np.ndarray:
        """Positions from which ``length`` symbols or more also stand elsewhere.

        ``apart`` marks each suffix that shares fewer symbols with the one before it in order than
        the level reached. A suffix extended backward by a symbol comes right after the extension
        of the last earlier one that the same symbol precedes, and shares with it one symbol more
        than the least that any neighbours between the two share.
        """
        order, symbols = self.order, self.symbols
        first, before = symbols[order], symbols[order - 1]
        by_symbol = np.argsort(before.astype(np.int16), kind="stable").astype(np.int32)
        target = np.empty(len(order), np.int32)         # where each suffix's extension stands
        target[by_symbol] = np.arange(len(order), dtype=np.int32)
        same = before[by_symbol[1:]] == before[by_symbol[:-1]]
        earlier = np.full(len(order), -1, np.int32)
        earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
        apart = np.r_[True, first[1:] != first[:-1]] | (first == 0)
        open_ = np.flatnonzero((before != 0) & (earlier >= 0)).astype(np.int32)
        open_ = open_[~apart[target[open_]]]
        low, to = earlier[open_], target[open_]
        for _ in range(length - 1):
            marks = np.cumsum(apart, dtype=np.int32)
            hit = marks[open_] != marks[low]
            if not hit.any():
                break
            apart[to[hit]] = True
            rest = ~hit
            open_, low, to = open_[rest], low[rest], to[rest]
        joined = np.flatnonzero(~apart)
        return np.union1d(order[joined], order[joined - 1])


def _spans(starts: np.ndarray, group: np.ndarray, length: int):
    """Runs of starts within each group: the group, the first start and the last one's end."""
    opens = np.r_[True, (starts[1:] > starts[:-1] + length) | (group[1:] != group[:-1])][:len(starts)]
    at = np.flatnonzero(opens)
    last = np.r_[at[1:], len(starts)] - 1
    return group[at], starts[at], starts[last] + length


def _span_batch(columns: dict, rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """A row with its spans for each row number; ``rows`` is in order."""
    kept, counts = np.unique(rows, return_counts=True)
    spans = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                                   ["a", "b"]))
    return pa.table({**{k: v.take(pa.array(kept)) for k, v in columns.items()}, "spans": spans})


def _search(length: int):
    def work(table: pa.Table) -> pa.Table:
        texts = [t.as_py() for t in table.column("bytes")]
        transform = Transform(texts)
        found = transform.repeated(length)
        row = np.searchsorted(transform.begins, found, side="right") - 1
        rows, a, b = _spans(found, row, length)
        shift = transform.begins[rows]
        columns = {k: table.column(k).combine_chunks() for k in ("anchor", "seg")}
        return _span_batch(columns, rows, a - shift, b - shift)
    return work


def _strings(length: int):
    """Every string of a segment with two hashes, for anchors that are split by content."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, seg = (batch.column(i).to_pylist() for i in range(2))
            rows = []
            for a, s, data in zip(anchor, seg, batch.column(2).to_pylist()):
                for i in range(len(data) - length + 1):
                    h = xxhash.xxh3_128_intdigest(data[i:i + length])
                    rows.append((a, s, i, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                                  ["anchor", "seg", "at", "h1", "h2"])
    return work


def _fetched(docs: DataFrame, wanted: Stored, scratch: Scratch) -> DataFrame:
    """``anchor, seg, bytes`` of ``wanted``, cut from the documents that hold each segment."""
    place = F.shiftleft(F.col("rep.start").cast("long"), 32).bitwiseOR(F.col("rep.len").cast("long"))
    lists = scratch.save(wanted.df.groupBy(F.col("rep.doc_id").alias("_id"), F.col("rep._hash").alias("_h")).agg(
        F.flatten(F.collect_list(F.array("anchor", "seg", place))).alias("list")), "lists")
    side = F.broadcast(lists.df) if fits(wanted, 32) else lists.df
    held = docs.join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(anchor, seg, data[place >> 32:(place >> 32) + (place & 0xFFFFFFFF)])
                    for text, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for data in [text.encode("utf-8")]
                    for anchor, seg, place in zip(flat[::3], flat[1::3], flat[2::3])]
            kinds = [pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows)) or [[]] * 3
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                                  ["anchor", "seg", "bytes"])

    cuts = held.select("text", "list").mapInArrow(frugal("suffix", cut), "anchor long, seg long, bytes binary")
    # Rows that repeat an id and its text give a segment more than once.
    return cuts.dropDuplicates(["anchor", "seg"])


def _islands(spans: DataFrame) -> DataFrame:
    """``doc_id, _hash, spans``: the spans (a, b) of each document, those that touch made one."""
    order = Window.partitionBy("doc_id", "_hash").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("a") > before).cast("int"), F.lit(1))
    numbered = spans.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order))
    merged = numbered.groupBy("doc_id", "_hash", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return merged.groupBy("doc_id", "_hash").agg(
        F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   crowded: int = CROWDED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, _hash, spans``: the byte spans to remove, for documents of ``doc_id, _hash, text``
    that have any."""
    scratch = Scratch(docs.sparkSession)
    ready_workers(docs.sparkSession)
    found = scratch.save(occurrences(docs, length, gram), "segments").df
    repeated = scratch.save(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
                            .where("n > 1").select("anchor"), "anchors")
    found = scratch.save(found.join(with_size(repeated, row_bytes=24), "anchor"), "repeated").df
    place = F.struct("doc_id", "_hash", "start", "len")
    distinct = scratch.save(found.groupBy("anchor", "seg").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("rep")), "distinct").df
    mixed = scratch.save(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("segs"))
                         .where("segs > 1"), "mixed")
    wanted = scratch.save(distinct.join(with_size(mixed, row_bytes=32), "anchor"), "wanted")
    size, most = wanted.df.agg(F.sum("rep.len"), F.max("segs")).first()
    spans = "anchor long, seg long, spans array<struct<a:int,b:int>>"
    whole = distinct.where("n > 1").select("anchor", "seg", F.array(F.struct(
        F.lit(0).alias("a"), F.col("rep.len").alias("b"))).alias("spans"))
    verdicts = [whole]
    if wanted.rows:
        cuts = _fetched(docs, wanted, scratch)
        if most > crowded:
            cuts = scratch.save(cuts, "cuts").df
            split = F.broadcast(mixed.df.where(F.col("segs") > crowded).select("anchor"))   # few: each is large
            crowds, cuts = cuts.join(split, "anchor", "left_semi"), cuts.join(split, "anchor", "left_anti")
        blocks = size // block_bytes + 1
        verdicts.append(
            cuts.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block"))
            .applyInArrow(_search(length), spans))
        if most > crowded:
            strings = scratch.save(
                crowds.select("anchor", "seg", "bytes").mapInArrow(frugal("suffix", _strings(length)), "anchor long, seg long, at int, h1 long, h2 long"),
                "strings").df
            equal = strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            verdicts.append(
                strings.join(equal.drop("n"), ["h1", "h2"]).groupBy("anchor", "seg")
                .agg(F.transform(F.collect_list("at"), lambda i: F.struct(
                    i.alias("a"), (i + length).alias("b"))).alias("spans")))
    verdict = verdicts[0]
    for more in verdicts[1:]:
        verdict = verdict.unionByName(more)
    verdict = scratch.save(verdict, "verdicts").df
    spread = found.join(verdict, ["anchor", "seg"]).select(
        "doc_id", "_hash", "start", F.explode("spans").alias("s"))
    return _islands(spread.select("doc_id", "_hash", (F.col("start") + F.col("s.a")).alias("a"),
                                  (F.col("start") + F.col("s.b")).alias("b")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   as_text: bool = False, **settings) -> DataFrame:
    """``docs`` without ``text_col``, with ``kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans``.

    Every byte goes that is covered by a string of LENGTH bytes which also starts anywhere else, in
    the same text or another; strings are judged on the input. Texts are taken as UTF-8 and a null
    one as empty. ``kept`` may hold parts of a character; ``as_text`` makes it a string without
    them. Rows that repeat an id and its text are texts like any others, so both go. Extra columns
    are carried along, but for the four named.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    short = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_hash"),
                        text.alias("text"))
    spans = Scratch(spark).save(repeated_spans(short, **settings).select(
        F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "spans"), "spans")
    made = ["kept", "n_bytes", "n_removed", "n_spans"]
    rest = [c for c in docs.columns if c != text_col and c not in made]
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest])
    rows = docs.select(row.alias("_row"), F.col(id_col).alias("_doc"), text.alias("_text")).join(
        with_size(spans, row_bytes=160), F.col("_doc").eqNullSafe(F.col("_id"))
        & (F.xxhash64("_text") == F.col("_h")), "left").select("_text", "spans", "_row")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, counts = [], [], [], []
            for value, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = value.encode("utf-8")
                gone = [(s["a"], s["b"]) for s in spans or ()]
                at = [0, *[x for span in gone for x in span], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(at[::2], at[1::2])))
                sizes.append(len(data))
                removed.append(len(data) - len(kept[-1]))
                counts.append(len(gone))
            kept = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text \
                else pa.array(kept, pa.binary())
            yield pa.record_batch([batch.column(2), kept,
                                   *[pa.array(c, pa.int64()) for c in (sizes, removed, counts)]],
                                  ["_row", *made])

    kind = StringType() if as_text else BinaryType()
    schema = StructType([rows.schema["_row"], *[
        StructField(c, kind if c == "kept" else LongType()) for c in made]])
    found = rows.mapInArrow(frugal("suffix", work), schema)
    return found.select(*[F.col("_row").getField(c).alias(c) for c in rest], *made)
