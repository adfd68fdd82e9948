"""Similarity join of documents by the Jaccard coefficient of their word n-grams.

Documents with equal sets are one class from the start. The order of n-gram hashes is cut into
fragments. A set that reaches the threshold with another can have few n-grams of its own, so own
n-grams are counted fragment by fragment: first over a part of the order for every class, then over
all of it for the few classes left. Every task first combines what it holds, so a common n-gram
comes to a fragment once per task.

For the remaining candidates the order becomes rarest first, and each set keeps the prefix in which
any partner must share an n-gram. Pairs are not listed within the groups that share one. For some
turns each candidate meets one other, first the most typical of all its groups, then the one that
most of its groups offer, always from another component. The pairs between components that are then left are
compared one by one, if the n-grams they share in their prefixes leave room for the threshold.
Overlaps are counted per fragment and summed per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.tables import Scratch, Stored, frugal, keeps, ready_workers, text_of, with_size

WORDS, THRESHOLD = 5, 80            # words of an n-gram; per cent
FIRST_CUT = 0.3                     # part of the order that all classes are counted over
RANGE_GRAMS = 2 << 20               # n-grams of a fragment that one task compares
FLUSH_DOCS, FLUSH_GRAMS = 4096, 1 << 20
FRAGMENTS = 4                       # in which overlaps of pairs are counted; a power of two
TURNS = 3
CHUNK = 1 << 18                     # bytes of text worked on at once, but for longer texts
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []      # for the bytes of one piece of work


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    made = lambda size: [np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)])
                         for b in (BASE, pow(BASE, -1, 1 << 64))]
    if n > 2 * CHUNK:
        return tuple(made(n))
    if not _POWERS:
        _POWERS[:] = made(2 * CHUNK)
    return _POWERS[0], _POWERS[1]


keeps("jaccard", _POWERS.clear)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _chunk_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts).translate(LOWER), np.uint8)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    power, inverse = _powers(len(data) + 1)
    word = ~SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[False, word, False].view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)])]
    hashes = _mixed((sums[end] - sums[begin]) * inverse[begin])
    grams = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for i in range(words):
        grams = grams * np.uint64(BASE) + hashes[i:i + len(grams)]
    grams = _mixed(grams)
    first = np.searchsorted(begin, bounds)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(grams[a:b - words + 1]))
        elif b > a:         # the whole sequence; its hash also depends on its length
            sets.append(np.frombuffer(xxhash.xxh3_64_digest(hashes[a:b].tobytes()), np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def gram_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The distinct hashed word n-grams of each text, in order of hash.

    A text of fewer words has its whole sequence as one; a text without words has none.
    """
    sets, held, size = [], [], 0
    with np.errstate(over="ignore"):
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= CHUNK:
                sets += _chunk_sets(held, words)
                held, size = [], 0
        if held:
            sets += _chunk_sets(held, words)
    return sets


def _sets(batch: pa.RecordBatch, column: int, words: int) -> list[np.ndarray]:
    return gram_sets([t.encode("utf-8") for t in batch.column(column).to_pylist()], words)


def set_classes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, _hash, n, cls``: size and digest of each document's set."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _sets(batch, 2, words)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())],
                ["doc_id", "_hash", "n", "cls"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "_hash", "text").mapInArrow(
        frugal("jaccard", work), f"doc_id {kind}, _hash long, n long, cls binary")


def _packed(held: list[tuple[bytes, np.ndarray]], ranges: int, part: float) -> pa.RecordBatch:
    """What a task holds, as a row per range of hashes: its n-grams, each once, how many classes
    have each, and those classes' numbers. The first row also names the classes."""
    sizes = np.array([len(s) for _, s in held])
    grams = np.concatenate([s for _, s in held])
    owner = np.repeat(np.arange(len(held), dtype=np.uint16), sizes)
    span = int(part * (1 << 64))
    inside = grams <= np.uint64(span - 1)
    grams, owner = grams[inside], owner[inside]
    by = np.argsort(grams, kind="stable")
    grams, owner = grams[by], owner[by]
    at = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]][:len(grams)])
    count = np.diff(np.r_[at, len(grams)]).astype(np.uint16)
    unique = grams[at]
    cuts = [*np.searchsorted(unique, np.array([span * r // ranges for r in range(ranges)], np.uint64)),
            len(unique)]
    owned = np.r_[at, len(grams)]
    classes = b"".join(c for c, _ in held)
    blob = xxhash.xxh3_128_digest(classes)
    rows = [(r, blob, unique[a:b].tobytes(), count[a:b].tobytes(), owner[owned[a]:owned[b]].tobytes(),
             None if r else classes, None if r else sizes.astype("<i8").tobytes())
            for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a or not r]
    return pa.record_batch([pa.array(c, k) for c, k in zip(
        zip(*rows), [pa.int32(), *[pa.binary()] * 6])], PACKED)


PACKED = ["range", "blob", "grams", "count", "owner", "classes", "sizes"]


def _range_frequencies(table: pa.Table):
    """Each row's arrays, and in how many classes its n-grams occur."""
    read = lambda c, kind: [np.frombuffer(x, kind) for x in table.column(c).to_pylist()]
    grams, count, owner = read("grams", np.uint64), read("count", np.uint16), read("owner", np.uint16)
    every = np.concatenate(grams)
    by = np.argsort(every, kind="stable")
    at = np.flatnonzero(np.r_[True, every[by][1:] != every[by][:-1]][:len(every)])
    total = np.add.reduceat(np.concatenate(count)[by].astype(np.int64), at) if len(at) else at
    frequency = np.empty(len(every), np.int32)
    frequency[by] = np.repeat(total, np.diff(np.r_[at, len(every)]))
    return grams, count, owner, np.split(frequency, np.cumsum([len(g) for g in grams])[:-1])


def _own_in_range(table: pa.Table) -> pa.Table:
    """Per blob, how many n-grams of this range each of its classes has for itself."""
    _, count, owner, frequency = _range_frequencies(table)
    own = [np.bincount(o[np.repeat(f == 1, c)], minlength=1).astype("<i8").tobytes()
           for c, o, f in zip(count, owner, frequency)]
    return table.select(["blob", "classes", "sizes"]).append_column("own", pa.array(own, pa.binary()))


def _blob_classes(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    classes = b"".join(c for c in table.column("classes").to_pylist() if c)
    sizes = np.frombuffer(b"".join(s for s in table.column("sizes").to_pylist() if s), "<i8")
    return [classes[i:i + 16] for i in range(0, len(classes), 16)], sizes


def _few_own(threshold: int):
    def work(table: pa.Table) -> pa.Table:
        """Classes of a blob whose own n-grams leave room for a partner."""
        classes, sizes = _blob_classes(table)
        own = np.zeros(len(classes), np.int64)
        for counts in table.column("own").to_pylist():
            counts = np.frombuffer(counts, "<i8")
            own[:len(counts)] += counts
        fit = np.flatnonzero(100 * own <= (100 - threshold) * sizes)
        return pa.table({"cls": pa.array([classes[i] for i in fit.tolist()], pa.binary())})
    return work


def _with_frequency(table: pa.Table) -> pa.Table:
    *_, frequency = _range_frequencies(table)
    return table.select(PACKED[1:]).append_column(
        "df", pa.array([f.astype("<i4").tobytes() for f in frequency], pa.binary()))


def _orders(table: pa.Table) -> pa.Table:
    """Per class its shared n-grams, rarest first, and how typical it is: their frequencies' sum by
    its size, so that own n-grams count against it."""
    classes, sizes = _blob_classes(table)
    read = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
    count, owner = read("count", np.uint16), read("owner", np.uint16)
    grams, df = (np.repeat(read(c, k), count) for c, k in (("grams", np.int64), ("df", "<i4")))
    by = np.lexsort((grams, df, owner))
    by = by[df[by] > 1]
    grams, df, owner = grams[by], df[by], owner[by]
    cuts = np.searchsorted(owner, np.arange(len(classes) + 1))
    sums = np.r_[0.0, np.cumsum(df)]
    order = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(grams))
    return pa.table({"cls": pa.array(classes, pa.binary()), "n": pa.array(sizes), "order": order,
                     "typical": (sums[cuts[1:]] - sums[cuts[:-1]]) / sizes})


def _in_fragments(docs: DataFrame, grams: int, part: float, words: int) -> DataFrame:
    """The n-grams of ``cls, text``, packed by task, in groups by range of the order."""
    ranges = int(grams * part) // RANGE_GRAMS + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for cls, s in zip(batch.column(0).to_pylist(), _sets(batch, 1, words)):
                held.append((cls, s))
                size += len(s)
                if len(held) == FLUSH_DOCS or size >= FLUSH_GRAMS:
                    yield _packed(held, ranges, part)
                    held, size = [], 0
        if held:
            yield _packed(held, ranges, part)

    return docs.select("cls", "text").mapInArrow(
        frugal("jaccard", pack), "range int, " + ", ".join(f"{c} binary" for c in PACKED[1:])).groupBy("range")


def with_company(docs: DataFrame, grams: int, part: float, words: int = WORDS,
                 threshold: int = THRESHOLD) -> DataFrame:
    """``cls`` of ``cls, text`` whose n-grams in the first ``part`` of the order are, but for few,
    also found in other classes. ``grams`` is how many all of them have."""
    counted = _in_fragments(docs, grams, part, words).applyInArrow(
        _own_in_range, "blob binary, classes binary, sizes binary, own binary")
    return counted.groupBy("blob").applyInArrow(_few_own(threshold), "cls binary")


def rarest_first(docs: DataFrame, grams: int, words: int = WORDS) -> DataFrame:
    """``cls, n, order, typical``: the n-grams that each class shares with others, rarest first."""
    counted = _in_fragments(docs, grams, 1.0, words).applyInArrow(
        _with_frequency, ", ".join(f"{c} binary" for c in [*PACKED[1:], "df"]))
    return counted.groupBy("blob").applyInArrow(
        _orders, "cls binary, n long, order array<long>, typical double")


def components(nodes: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``nodes`` (cls, comp) with the components that ``links`` (a, b) join made one.

    Every component takes the smallest neighbouring one, then that one's own, until none changes.
    """
    at = lambda df, c: df.join(nodes.select(F.col("cls").alias(c), F.col("comp").alias(f"_{c}")), c)
    ends = at(at(links, "a"), "b").where("_a != _b").select(F.col("_a").alias("x"), F.col("_b").alias("y"))
    edges = scratch.save(ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y")))
                         .distinct(), f"{name}-edges")
    if not edges.rows:
        return nodes
    labels = scratch.save(edges.df.groupBy("x").agg(F.min("y").alias("y")).select(
        F.col("x").alias("c"), F.least("x", "y").alias("to")), f"{name}-0")
    step, changed = 0, True
    while changed:
        step += 1
        far = labels.df.select(F.col("c").alias("y"), F.col("to").alias("near"))
        least = edges.df.join(far, "y").groupBy(F.col("x").alias("c")).agg(F.min("near").alias("near"))
        moved = labels.df.join(least, "c").select("c", F.col("to").alias("old"),
                                                  F.least("to", "near").alias("mid"))
        jump = labels.df.select(F.col("c").alias("mid"), F.col("to").alias("end"))
        moved = moved.join(jump, "mid", "left").select("c", "old", F.least(
            "mid", F.coalesce("end", "mid")).alias("to"))
        moved = scratch.save(moved, f"{name}-{step}")
        changed = moved.df.where("old != to").limit(1).count() > 0
        labels = Stored(moved.df.select("c", "to"), moved.rows, moved.path)
    found = nodes.join(labels.df, nodes["comp"] == labels.df["c"], "left")
    return scratch.save(found.select("cls", F.coalesce("to", "comp").alias("comp")), f"{name}-nodes").df


def linked(pairs: Stored, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The ``pairs`` (a, b) that reach the threshold; ``sets`` has cls, n, fragment, grams."""
    side = lambda c: sets.select(F.col("cls").alias(c), "fragment", F.col("n").alias(f"n_{c}"),
                                 F.col("grams").alias(f"grams_{c}"))
    partial = side("a").join(with_size(pairs), "a").join(side("b"), ["b", "fragment"]).select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("both"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("both").alias("both"))
    return total.where(100 * F.col("both") >= threshold * (
        F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def _near_in_size(a: str, b: str, threshold: int):
    return 100 * F.least(a, b) >= threshold * F.greatest(a, b)


def _one_each(places: DataFrame, nodes: DataFrame, turn: int, threshold: int) -> DataFrame:
    """A pair (a, b) for each candidate that shares an n-gram with another component."""
    placed = places.join(nodes, "cls")
    best = F.struct("typical", "cls", "n", "comp")
    groups = placed.groupBy("gram", "comp").agg(F.max(best).alias("best"))
    tops = groups.groupBy("gram").agg(F.max("best").alias("top"), F.count(F.lit(1)).alias("comps"))
    tops = tops.where("comps > 1").select("gram", "top")
    seconds = groups.join(tops, "gram").where(F.col("comp") != F.col("top.comp")).groupBy("gram", "top").agg(
        F.max("best").alias("second"))
    other = F.when(F.col("comp") != F.col("top.comp"), F.col("top")).otherwise(F.col("second"))
    met = placed.join(seconds, "gram").select("cls", "n", "pos", other.alias("o")).where(
        _near_in_size("n", "o.n", threshold))
    offers = met.groupBy("cls", "o.cls", "o.typical").agg(
        F.count(F.lit(1)).alias("shared"), F.min("pos").alias("pos")).toDF("cls", "o", "typical", "shared", "pos")
    rank = F.struct("typical", "o") if turn == 0 else F.struct("shared", (-F.col("pos")).alias("p"), "typical", "o")
    chosen = offers.groupBy("cls").agg(F.max_by("o", rank).alias("o"))
    return chosen.select(F.least("cls", "o").alias("a"), F.greatest("cls", "o").alias("b")).distinct()


def _all_left(places: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Every pair (a, b) of different components that may reach the threshold.

    At the first n-gram that two such sets share, both have as many left as they need to share. So a
    pair is found where that holds, and so are all n-grams shared up to the last one found; after it
    either set has only so many.
    """
    placed = places.join(nodes, "cls")
    sizes = placed.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("size"))
    mains = sizes.groupBy("gram").agg(F.max_by("comp", F.struct("size", "comp")).alias("main"),
                                      F.count(F.lit(1)).alias("comps")).where("comps > 1")
    members = placed.join(mains.select("gram", "main"), "gram")
    other = members.select("gram", *[F.col(c).alias(f"o_{c}") for c in ("cls", "n", "pos", "comp", "main")])
    needed = F.ceil(threshold * (F.col("n") + F.col("o_n")) / (100 + threshold))
    reach = F.least(F.col("n") - F.col("pos"), F.col("o_n") - F.col("o_pos"))
    # One side is outside the largest component; of two outside, one leads.
    met = members.where("comp != main").join(other, "gram").where(
        (F.col("comp") != F.col("o_comp"))
        & ((F.col("o_comp") == F.col("o_main")) | (F.col("cls") < F.col("o_cls")))
        & _near_in_size("n", "o_n", threshold) & (reach >= needed))
    turned = F.col("cls") > F.col("o_cls")
    ends = [F.when(turned, F.col(y)).otherwise(F.col(x)).alias(name) for name, x, y in (
        ("a", "cls", "o_cls"), ("b", "o_cls", "cls"), ("n_a", "n", "o_n"), ("n_b", "o_n", "n"),
        ("pos_a", "pos", "o_pos"), ("pos_b", "o_pos", "pos"))]
    pairs = met.select(*ends).groupBy("a", "b", "n_a", "n_b").agg(
        F.count(F.lit(1)).alias("found"), F.max("pos_a").alias("last_a"), F.max("pos_b").alias("last_b"))
    after = F.least(F.col("n_a") - 1 - F.col("last_a"), F.col("n_b") - 1 - F.col("last_b"))
    needed = F.ceil(threshold * (F.col("n_a") + F.col("n_b")) / (100 + threshold))
    return pairs.where(F.col("found") + after >= needed).select("a", "b")


def similar_classes(texts: DataFrame, grams: int, scratch: Scratch, words: int = WORDS,
                    threshold: int = THRESHOLD) -> DataFrame:
    """``cls, comp`` of candidate classes, given their ``cls, text`` and how many n-grams they have."""
    ordered = scratch.save(rarest_first(texts, grams, words)
                           .withColumn("id", F.monotonically_increasing_id()), "ordered").df
    named = ordered.select("cls", "id")
    ordered = ordered.select(F.col("id").alias("cls"), "n", "order", "typical")
    # Own n-grams come first in the order and meet nobody; they only use up the prefix.
    own = F.col("n") - F.size("order")
    prefix = F.floor(F.col("n") * (100 - threshold) / 100).cast("int") + 1 - own
    places = scratch.save(ordered.where(prefix > 0).select(
        "cls", "n", "typical", own.alias("own"),
        F.posexplode(F.slice("order", 1, F.greatest(prefix, F.lit(0)).cast("int"))).alias("pos", "gram"))
        .select("gram", "cls", "n", "typical", (F.col("pos") + F.col("own")).alias("pos")), "places").df
    bits = FRAGMENTS.bit_length() - 1
    cut = lambda f: F.filter("order", lambda g: F.shiftrightunsigned(g, 64 - bits) == f)
    sets = ordered.select("cls", "n", F.posexplode(F.array(*[cut(f) for f in range(FRAGMENTS)]))
                          .alias("fragment", "grams")).where(F.size("grams") > 0)
    nodes = scratch.save(ordered.select("cls", F.col("cls").alias("comp")), "nodes").df
    for turn in range(TURNS + 1):
        pairs = _one_each(places, nodes, turn, threshold) if turn < TURNS else \
            _all_left(places, nodes, threshold)
        pairs = scratch.save(pairs, f"pairs{turn}")
        if pairs.rows:
            found = scratch.save(linked(pairs, sets, threshold), f"links{turn}").df
            nodes = components(nodes, found, scratch, f"turn{turn}")
    least = named.join(nodes.withColumnRenamed("cls", "id"), "id")
    return least.select("cls", F.col("comp").cast("string").alias("comp"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, _hash, n_shingles, component_id, _group``; one row per row.

    Words are runs of anything but white space, with A-Z in lower case. Two documents link when
    their sets' intersection is ``threshold`` per cent of their union or more, and component_id is
    the smallest id that links reach, and _group names the component itself, also where rows of
    several components repeat an id; it is null for empty sets. Equal sets link. A text without words, or null, has an empty
    set and is alone. Rows that repeat an id and its text get the same answer; a null id is never
    the smallest, unless it is alone.
    """
    scratch = Scratch(docs.sparkSession)
    ready_workers(docs.sparkSession)
    text = text_of(text_col)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_hash"), text.alias("text"))
    rows = scratch.save(set_classes(docs, words), "classes").df
    own = rows.where("n > 0").groupBy("cls", "n", "doc_id", "_hash").agg(F.count(F.lit(1)).alias("rows"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash", "rows")
    classes = scratch.save(own.groupBy("cls", "n").agg(F.min(first).alias("first")), "first")
    several = classes.df.where("first.rows > 1").limit(1).count() > 0

    def texts(kept: Stored) -> DataFrame:
        """One text of each class, also where rows repeat an id and its text."""
        held = docs.join(with_size(kept, row_bytes=96), F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                         & (F.col("_hash") == F.col("first._hash")))
        once = held.where("first.rows = 1" if several else "true").select("cls", "text")
        if not several:
            return once
        return once.unionByName(held.where("first.rows > 1").select("cls", "text").dropDuplicates(["cls"]))

    kept = classes
    grams = lambda: kept.df.agg(F.sum("n")).first()[0] or 0
    for part in (FIRST_CUT, 1.0):
        few = with_company(texts(kept), grams(), part, words, threshold)
        kept = scratch.save(kept.df.join(few, "cls"), f"kept-{part}")
    comps = similar_classes(texts(kept), grams(), scratch, words, threshold)
    ids = classes.df.select("cls", F.col("first.doc_id").alias("doc_id")).join(comps, "cls", "left")
    ids = ids.withColumn("_comp", F.coalesce("comp", F.hex("cls")))
    least = ids.groupBy("_comp").agg(F.min("doc_id").alias("_least"))
    named = scratch.save(ids.join(least, "_comp").select(F.col("cls").alias("_cls"), "_least", F.col("_comp").alias("_group")), "named")
    joined = rows.join(with_size(named), F.col("cls") == F.col("_cls"), "left")
    return joined.select("doc_id", "_hash", F.col("n").alias("n_shingles"), F.when(
        F.col("n") == 0, F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"), "_group")
