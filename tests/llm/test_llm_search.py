"""Searches of vectors and texts against plain versions, on several tiles and with odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditmart.llm import hard_negatives, lexical_search, topk_search, vectors

VECTORS = "vec_id long, embedding array<double>, label int, score long, rank string"


def whole(vector, scale):
    """Scaled components, or None where the row takes no part."""
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * x) for x in vector]


def order(hit):
    score, vec_id = hit
    return -score, vec_id is None, vec_id or 0


def usable(rows, scale):
    return [(i, x, label) for i, v, label, *_ in rows if (x := whole(v, scale)) is not None]


def dot(x, y):
    return sum(a * b for a, b in zip(x, y))


def plain_top(rows, k, scale):
    rows = usable(rows, scale)
    out = []
    for q, x, _ in rows:
        if q is not None and q % 5 == 0:
            hits = sorted(((dot(x, y), i) for i, y, _ in rows if i is None or i != q), key=order)[:k]
            out += [(q, r, i, s) for r, (s, i) in enumerate(hits, 1)]
    return out


def plain_negatives(rows, scale):
    rows = [r for r in usable(rows, scale) if r[2] is not None]
    out = []
    for q, x, label in rows:
        if q is None or q % 5:
            continue
        scored = [((dot(x, y), i), z == label) for i, y, z in rows if i is None or i != q]
        for s, p in sorted((h for h, same in scored if same), key=order)[:5]:
            hits = sorted((h for h, same in scored if not same and 30 * s <= 100 * h[0] <= 90 * s), key=order)
            out += [(q, p, r, i, s, n) for r, (n, i) in enumerate(hits[:10], 1)]
    return out


def vector_rows(seed, n=160, dim=7, size=1.0):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=dim) * size).tolist(), int(rng.integers(3)), 7, "x") for i in range(n)]
    rows += [(1000 + i, rows[3][1], i % 2, None, None) for i in range(60)]        # a group of copies
    rows += [rows[5], rows[10], rows[10], (None, rows[0][1], 1, 1, "y"), (None, rows[0][1], 2, 1, "y")]
    rows += [(200, None, 1, 1, ""), (205, [], 1, 1, ""), (210, [1.0, None, 2.0], 1, 1, ""),
             (215, [float("nan")] * dim, 1, 1, ""), (220, [float("inf")] * dim, 1, 1, ""),
             (225, [0.5] * (dim + 2), 1, 1, ""), (230, [0.25], None, 1, "")]
    return rows


def text(rows):
    return sorted(tuple(map(str, r)) for r in rows)


@pytest.mark.parametrize("size", [1.0, 1e4, 3e5])       # sums exact in 32 bits, in 64, and as integers only
def test_top_k(spark, monkeypatch, size):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 11)
    monkeypatch.setattr(vectors, "QUERY_GROUP", 9)
    rows = vector_rows(1, size=size)
    df = spark.createDataFrame(rows, VECTORS).repartition(6)
    got = topk_search.top_k(df.where("vec_id % 5 = 0"), df, 4)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert text(got.collect()) == text(plain_top(rows, 4, 1024))


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0], 1, 1, ""), (1, [2.0], 1, 1, "")], VECTORS)
    assert text(topk_search.top_k(df.where("vec_id = 0"), df).collect()) == text([(0, 1, 1, 1024 * 2048)])
    assert topk_search.top_k(df.where("vec_id = 0"), df.where("vec_id = 0")).collect() == []
    assert topk_search.top_k(df, df.limit(0)).collect() == []
    assert topk_search.top_k(df.limit(0), df).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        topk_search.top_k(df, spark.createDataFrame([(0, [1e16], 1, 1, "")], VECTORS)).collect()


@pytest.mark.parametrize("size", [1.0, 1e5])
def test_hard_negatives(spark, monkeypatch, size):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 11)
    monkeypatch.setattr(vectors, "QUERY_GROUP", 9)
    rows = vector_rows(2, size=size)
    df = spark.createDataFrame(rows, VECTORS).repartition(6)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 5 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain_negatives(rows, 256)
    assert len(expected) > 100 and text(got.collect()) == text(expected)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 5 == 0).collect() == []


@pytest.mark.parametrize("dim, size", [(1, 10), (64, 256), (300, 2000), (9000, 3), (5000, 4000), (3, 2**27)])
def test_residues(dim, size):
    rng = np.random.default_rng(dim)
    x, y = rng.integers(-size, size + 1, (5, dim)), rng.integers(-size, size + 1, (9, dim))
    primes = hard_negatives.primes_for(dim, dim * size * size)
    reduced = [hard_negatives.residues(y, p) for p in primes]
    assert len(primes) > 1 or size == 10
    assert (hard_negatives.scores_of(x, reduced, primes) == x @ y.T).all()


def plain_search(items, docs, k):
    terms = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = [(i, c, sum(c.values())) for i, t in docs if (c := Counter(terms(t)))]
    n, total = len(found), sum(x for *_, x in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, t in items:
        hits = []
        for i, c, length in found:
            m = 75 + (25 * length * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                        * (1_000_000_000 * c[x] // (1000 * c[x] + 12 * m)) for x in terms(t) if x in c)
            hits += [(score, i)] if score > 0 else []
        out += [(item, r, i, s) for r, (s, i) in enumerate(sorted(hits, key=order)[:k], 1)]
    return out


def text_rows(seed, n=400):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["ñandú", "É", "中文", "it's", "A-B", "x_y", " z"]
    chance = 1 / np.arange(1, len(vocabulary) + 1)
    say = lambda size: " ".join(rng.choice(vocabulary, size, p=chance / chance.sum()))
    docs = [(i, say(int(rng.integers(1, 60)))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(150)]                    # a group of copies
    docs += [docs[9], docs[9], (None, docs[9][1]), (5000, None), (5001, ""), (5002, " .,;\t\n"),
             (5003, say(40_000)), (5004, "é" * 5000 + " w1 W1")]
    items = [(i, say(int(rng.integers(1, 25)))) for i in range(40)]
    items += [items[0], (None, "w5 w5 w9"), (90, None), (91, ""), (92, "nowhere"), (93, "w1 w1 w1 w2")]
    return items, docs


@pytest.mark.parametrize("tiled, broadcast", [(False, True), (True, True), (True, False)])
def test_search(spark, monkeypatch, tiled, broadcast):
    if tiled:
        for name, value in (("SEGMENT_TOKENS", 700), ("SHARD_TOKENS", 3000), ("ITEM_GROUP", 7), ("SPAN", 50)):
            monkeypatch.setattr(lexical_search, name, value)
    if not broadcast:
        monkeypatch.setattr(lexical_search, "fits", lambda *_: False)
    items, docs = text_rows(3)
    asked = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, doc_id int, score int")
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, item_id int, rank int")
    got = lexical_search.search(asked, df.repartition(5), 20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert text(got.collect()) == text(plain_search(items, docs, 20))


def test_search_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(items, df.where("doc_id = 2")).collect() == []
    assert lexical_search.search(items, df.limit(0)).collect() == []
    assert lexical_search.search(items.limit(0), df).collect() == []


def test_few_blocks_are_unpacked():
    """Candidates that the bounds of their blocks reject leave those blocks packed."""
    import pyarrow as pa
    n = 100 * lexical_search.BLOCK
    lengths = np.where(np.arange(n) < lexical_search.BLOCK, 2, 60)
    times = np.ones(2 * n, np.int64)
    doc, term = np.tile(np.arange(n), 2), np.repeat([0, 1], n)
    keep = (term == 1) | (doc % 3 == 0)
    postings, blocks, data = lexical_search.packed_lists(doc[keep], term[keep], times[keep], lengths, 2)
    held = pa.table({
        "segment": [0, 0, 0], "term": pa.array([None, b"rare", b"often"], pa.binary()),
        "blocks": pa.array([None, *blocks.to_pylist()], pa.binary()),
        "data": pa.array([None, *data.to_pylist()], pa.binary()),
        "docs": pa.array([list(range(n)), None, None], pa.list_(pa.int64())),
        "lengths": pa.array([lengths.astype("<u4").tobytes(), None, None], pa.binary())})
    shard = lexical_search.Shard(held, n, int(lengths.sum()))
    hits = shard.search([(b"rare", 900), (b"often", 100)], 20, 1000)
    assert [d for _, d in hits] == list(range(0, 60, 3)) and postings.tolist() == [-(-n // 3), n]
    assert shard.lists[b"often"].ready.sum() <= 8
