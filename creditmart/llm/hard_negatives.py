"""Hard negatives of labelled vectors, with scores by residue number system.

Component matrices are reduced modulo several primes and multiplied in float32. Primes are small
enough for every sum to be exact there, and enough for their product to cover all scores; the signed
scores come back by Chinese remaindering. A first round of tiles selects the positives of every
anchor, a second one, for each positive, the rows whose score lies in its window.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm import vectors
from creditmart.llm.tables import Scratch

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90                  # per cent of the positive's score
EXACT = 1 << 24                     # whole numbers of float32 are exact below
DEEP = 4096                         # components summed up before they are reduced


def primes_for(dim: int, bound: float) -> list[int]:
    """The largest primes whose residues sum up exactly over ``dim``, until they cover +-``bound``."""
    half = isqrt((EXACT - 1) // max(1, min(dim, DEEP)))
    found, product, p = [], 1, min(2 * half + 1, 4095) | 1
    while product <= 2 * bound + 1:
        if all(p % q for q in range(3, isqrt(p) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
        if p < 3:
            raise ValueError("scores are too large for this residue system")
    return found


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """The residues of whole numbers modulo an odd ``p``, from -(p - 1) / 2 on."""
    x = np.mod(x, p)
    return np.where(x > p // 2, x - p, x)


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    return centred(matrix.astype(np.int64), p).astype(np.float32)


def residue_product(queries: np.ndarray, rows: np.ndarray, p: int) -> np.ndarray:
    """Inner products modulo ``p`` of two matrices of residues."""
    total = np.zeros((len(queries), len(rows)), np.int32)
    for at in range(0, queries.shape[1], DEEP):
        part = slice(at, at + DEEP)
        total += centred((queries[:, part] @ rows[:, part].T).astype(np.int32), p)
    return centred(total, p)


def signed(remainders: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Whole numbers from their remainders, by digits of mixed radix around zero."""
    digits = []
    for i, (r, p) in enumerate(zip(remainders, primes)):
        value = r.astype(np.int64)
        for digit, q in zip(digits, primes[:i]):
            value = centred((value - digit) * pow(q, -1, p), p)
        digits.append(value)
    total = np.zeros_like(digits[0])
    with np.errstate(over="ignore"):        # what passes 64 bits on the way comes back
        for digit, p in zip(reversed(digits), reversed(primes)):
            total = total * np.int64(p) + digit
    return total


def scores_of(queries: np.ndarray, rows: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact scores; ``rows`` has the residues of the rows for each prime."""
    return signed([residue_product(residues(queries, p), r, p) for p, r in zip(primes, rows)], primes)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
                   id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(scale * x); a score is the integer inner product with the anchor, with
    the shorter of two vectors filled up with zeros. An anchor's positives are its ``positives`` best
    other rows of the same label; the negatives of a positive are the ``negatives`` best rows of
    other labels with a score of ``low`` to ``high`` per cent of the positive's. Equal scores go by
    smaller id, null last. Rows with a null label, or a vector that is null or holds a null, infinite
    or undefined component, take no part. A row with the anchor's id is the anchor's own. Anchors
    that repeat an id are treated one by one, and rows that repeat one are rows of their own. A
    positive without negatives has no rows. Other columns are ignored.
    """
    scratch = Scratch(rows.sparkSession)
    label = F.col(label_col)
    rows = rows.where(label.isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.col(vector_col).alias("_vector"), is_anchor.alias("_anchor"))

    def packs(df: DataFrame, size: int, name: str):
        df = scratch.save(vectors.pack(df, "_vector", scale, ["vec_id", "label"], size), name).df
        return df, *vectors.extent(df)

    asked, n_asked, _, norm_asked = packs(rows.where("_anchor"), vectors.QUERY_PACK, "anchors")
    held, n_held, dim, norm = packs(rows, vectors.ROW_PACK, "rows")
    bound = norm * norm_asked
    if bound * 100 >= vectors.WHOLE:
        raise ValueError("scores may not fit in 64 bits")
    primes = primes_for(dim, bound)

    def tile(asked: pa.Table, held: pa.Table):
        """Of each packed row of anchors: its place, ids, scores, and rows of the same label."""
        rows = vectors.Rows(held, dim, "label")
        reduced = [residues(rows.matrix, p) for p in primes]
        for i in range(len(asked)):
            ids = asked["vec_id"][i].values
            labels = asked["label"][i].values.to_numpy(zero_copy_only=False)
            scores = scores_of(vectors.matrix(asked, i, dim), reduced, primes)
            yield i, rows, ids, scores, rows.labels == labels[:, None]

    near_names = ["query", "anchor_id", "shard"]

    def near(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if len(asked) and len(held):
            for i, rows, ids, scores, same in tile(asked, held):
                allowed = same & rows.others(ids)
                for j, top in enumerate(vectors.best(scores, positives, allowed)):
                    out.append(((asked["pack"][i].as_py() << vectors.PACK_BITS) + j, ids[j].as_py(),
                                held["shard"][0].as_py(), vectors.listed(scores[j], top, rows)))
        return vectors.lists_table(out, near_names)

    found, shards = vectors.tiles(asked, held, n_asked, n_held, near_names, near)
    own = vectors.merged(found, ["query", "anchor_id"], shards, positives)
    own = own.groupBy(F.shiftright("query", vectors.PACK_BITS).alias("pack")).agg(
        F.collect_list(F.struct("query", "top")).alias("positives"))       # of one packed row
    asked = scratch.save(asked.join(own, "pack"), "asked").df
    keys = ["query", "place", "anchor_id", "positive_id", "positive_score"]

    def windowed(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if len(asked) and len(held):
            for i, rows, ids, scores, same in tile(asked, held):
                own = {p["query"] & (1 << vectors.PACK_BITS) - 1: p for p in asked["positives"][i].as_py()}
                for place in range(positives):
                    lines = np.array([j for j, p in own.items() if len(p["top"]) > place], np.int64)
                    if not len(lines):
                        break
                    hits = [own[j]["top"][place] for j in lines.tolist()]
                    limit = -np.array([h["cost"] for h in hits], np.int64)[:, None]
                    some = scores[lines]
                    inside = (low * limit <= 100 * some) & (100 * some <= high * limit) & ~same[lines]
                    for j, hit, line, top in zip(lines.tolist(), hits, some, vectors.best(some, negatives, inside)):
                        if len(top):
                            out.append((own[j]["query"], place, ids[j].as_py(), hit["vec_id"], -hit["cost"],
                                        held["shard"][0].as_py(), vectors.listed(line, top, rows)))
        return vectors.lists_table(out, [*keys, "shard"])

    found, shards = vectors.tiles(asked, held, n_asked, n_held, [*keys, "shard"], windowed)
    ranked = vectors.merged(found, keys, shards, negatives).select(
        *keys, F.posexplode("top").alias("rank", "hit"))
    return ranked.select("anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"),
                         F.col("hit.vec_id").alias("negative_id"), "positive_score",
                         (-F.col("hit.cost")).alias("negative_score"))
