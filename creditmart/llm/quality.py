"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model predicts bytes from the ORDER - 1 bytes before. Every task counts its n-grams before they
meet; the counts of all documents' n-grams, sharded by n-gram, are joined level by level with those
of their contexts and of their endings, which gives a log probability to each n-gram of the corpus,
seen in trusted text or not. Documents are scored against that table shard by shard, so that no
worker holds more than one shard of it, and a document's partial sums are added up.

A fifth of the trusted documents is left out of the counts. Their bits per byte set the limit of
their language. As the mean over few bytes varies, a text of n bytes has SHORT / sqrt(n) taken off
first; the limit is the QUANTILE of what is left, and for each text its own SHORT / sqrt(n) more.
Text that costs more is rejected, and so is 1 - QUANTILE of held-out text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.tables import Scratch, frugal, ready_workers, text_of, with_size

ORDER = 5
SYMBOLS = 256
FOLDS = 5                       # one of them sets the limits
HELD_TOGETHER = 2 << 20         # n-grams a counting task keeps before it hands them on
CHUNK_BYTES = 1 << 20           # bytes of text worked on at once
SHARD_ROWS = 4 << 20            # rows of the table sent to workers at once, 16 bytes each
QUANTILE, SHORT = 0.99, 4.0
STEPS = 10_000                  # of a bit, in which limits are found
FEWEST = 20                     # held-out documents a language needs for a limit of its own


def _chunks(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The n-gram that ends at each byte, as an integer, some bytes at a time.

    With it come the rows of the chunk's parts and their lengths. Before a text stand zero bytes,
    and before a later part of a long text the bytes that precede it.
    """
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text), CHUNK_BYTES):
            before = text[max(at - order + 1, 0):at]
            rows.append(row)
            parts.append(bytes(order - 1 - len(before)) + before + text[at:at + CHUNK_BYTES])
            size += len(parts[-1])
            if size >= CHUNK_BYTES:
                yield (*_grams(parts, order), np.array(rows))
                rows, parts, size = [], [], 0
    if parts:
        yield (*_grams(parts, order), np.array(rows))


def _grams(parts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of parts that begin with ``order`` - 1 bytes of context, and their lengths."""
    lengths = np.array([len(p) for p in parts], np.int64)
    joined = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    n = len(joined) - order + 1
    grams = np.zeros(n, np.int64)
    for i in range(order):
        grams <<= 8
        grams |= joined[i:i + n]
    own = np.ones(n, bool)
    for end in np.cumsum(lengths)[:-1].tolist():        # those that would reach into the next part
        own[end - order + 1:end] = False
    return grams[own], lengths - order + 1


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n``: all n-grams of ``text``, and how often each occurs where ``fits``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            texts = [t.encode("utf-8") for t in batch.column(0).to_pylist()]
            fits = np.array(batch.column(1).to_pylist(), bool)
            for grams, lengths, rows in _chunks(texts, order):
                grams = np.sort((grams << 1) | np.repeat(fits[rows], lengths))
                at = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
                n = np.diff(np.r_[at, len(grams)])
                grams = grams[at]
                n[grams & 1 == 0] = 0
                both = np.r_[kept, grams >> 1]
                by = np.argsort(both, kind="stable")
                both, n = both[by], np.r_[total, n][by]
                at = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
                kept, total = both[at], np.add.reduceat(n, at)
                if len(kept) > HELD_TOGETHER:
                    yield pa.record_batch([kept, total], ["gram", "n"])
                    kept, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(kept):
            yield pa.record_batch([kept, total], ["gram", "n"])

    ready_workers(docs.sparkSession)
    return (docs.select("text", "fits").mapInArrow(frugal("quality", work), "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ of a level, from how many n-grams occur once to four times."""
    row = counts.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = (row[f"n{i}"] for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    steps = [(1, n1, n2), (2, n2, n3), (3, n3, n4)]
    return [min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) if a else 0.5 for i, a, b in steps]


def _discount(n: Column, d: list[float]) -> Column:
    return F.when(n == 1, d[0]).when(n == 2, d[1]).when(n >= 3, d[2]).otherwise(0.0)


def gram_scores(counts: DataFrame, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """``gram, bits``: what each n-gram's last byte costs under the model; all of ``counts``.

    At the highest level n-grams count as often as they occur in trusted text, below by how many
    different bytes they follow. An n-gram not seen falls to the level below with what its context
    has left over, or whole where the context is new too; below single bytes all are equal.
    """
    levels = {order: scratch.save(counts.where("n > 0"), f"level{order}").df}
    for m in range(order - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << 8 * m) - 1)
        levels[m] = scratch.save(levels[m + 1].groupBy(shorter.alias("gram"))
                                 .agg(F.count(F.lit(1)).alias("n")), f"level{m}").df
    # Endings of all n-grams, each level's from the one above, scored from the shortest up.
    wanted = {order: scratch.save(counts.select("gram"), "wanted").df}
    for m in range(order - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << 8 * m) - 1)
        wanted[m] = wanted[m + 1].select(shorter.alias("gram")).distinct()
    scored = None
    for m in range(1, order + 1):
        d = _discounts(levels[m])
        contexts = levels[m].groupBy(F.shiftright("gram", 8).alias("_context")).agg(
            F.sum("n").alias("_all"), F.sum(_discount(F.col("n"), d)).alias("_left"))
        level = (wanted[m].join(levels[m].withColumnRenamed("n", "_n"), "gram", "left")
                 .withColumn("_context", F.shiftright("gram", 8))
                 .join(contexts, "_context", "left"))
        if scored is None:
            level = level.withColumn("_below", F.lit(1.0 / SYMBOLS))
        else:
            shorter = F.col("gram").bitwiseAND((1 << 8 * (m - 1)) - 1)
            below = scored.select(F.col("gram").alias("_ending"), F.col("p").alias("_below"))
            level = level.withColumn("_ending", shorter).join(below, "_ending")
        n = F.coalesce("_n", F.lit(0))
        own = F.greatest(n - _discount(n, d), F.lit(0.0)) / F.col("_all")
        p = F.when(F.col("_all").isNull(), F.col("_below")).otherwise(
            own + F.col("_left") / F.col("_all") * F.col("_below"))
        scored = scratch.save(level.select("gram", p.alias("p")), f"scored{m}").df
    return scored.select("gram", (-F.log2("p")).alias("bits"))


def score(docs: DataFrame, table: DataFrame, rows: int, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes`` and ``bits``, the cost of its text; a row per row.

    The table goes to the workers in shards of bounded size, one after another, and each is let go
    when it is done; each gives the sum over the n-grams it holds. Equal rows have equal sums, so
    they are added up together and come back as often as they were there.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    shards = max(1, -(-rows // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("gram"), F.lit(shards))
    rest = [c for c in docs.columns if c != "text"]
    docs = docs.select("text", *rest)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    parts = []
    for s in range(shards):
        held = table.where(shard == s).toArrow()
        gram, bits = (held.column(c).to_numpy() for c in ("gram", "bits"))
        by = np.argsort(gram)
        sent = spark.sparkContext.broadcast((gram[by], bits[by].astype(np.float32)))

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known, cost = sent.value
            for batch in batches:
                texts = [t.encode("utf-8") for t in batch.column(0).to_pylist()]
                bits = np.zeros(len(texts))
                for grams, lengths, rows in _chunks(texts, order):
                    each = np.zeros(len(grams))
                    if len(known):
                        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                        each = np.where(known[at] == grams, cost[at], 0.0)
                    sums = np.r_[0.0, np.cumsum(each, dtype=np.float64)]
                    ends = np.cumsum(lengths)
                    np.add.at(bits, rows, sums[ends] - sums[ends - lengths])
                yield pa.record_batch(
                    [*batch.columns[1:], pa.array([len(t) for t in texts], pa.int64()), pa.array(bits)],
                    [*rest, "n_bytes", "bits"])

        parts.append(scratch.save(docs.mapInArrow(frugal("quality", work), f"{schema}, n_bytes long, bits double"),
                                  f"scores{s}").df)
        sent.destroy()
    if shards == 1:
        return parts[0]
    every = reduce(DataFrame.unionByName, parts).groupBy(*rest, "n_bytes").agg(
        F.sum("bits").alias("_sum"), (F.count(F.lit(1)) / shards).cast("long").alias("_times"))
    return every.select(*rest, "n_bytes", (F.col("_sum") / F.col("_times")).alias("bits"),
                        F.explode(F.sequence(F.lit(1).cast("long"), "_times")).alias("_each")).drop("_each")


def classify(docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, _hash, lang, bits_per_byte, perplexity, limit, kept``; a row per row.

    Trusted are documents whose labels all say quality 1 and none toxic. ``perplexity`` is per byte.
    A text without bytes, or null, has no perplexity and is kept; so is every text where no
    trusted document is held out. A null language is a language of its own. Languages with fewer
    than FEWEST held-out documents take the limit of all languages together. Rows that repeat an
    id and its text get the same answer.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    trusted = scratch.save(
        labels.groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"),
                                     F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
        .where("q = 1 and t = 0 and doc_id is not null").select(F.col("doc_id").alias("_id")),
        "trusted")
    rows = docs.select("doc_id", "lang", text_of("text").alias("text"))
    rows = rows.join(with_size(trusted), F.col("doc_id") == F.col("_id"), "left")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    rows = rows.select("doc_id", "lang", "text", F.xxhash64("text").alias("_hash"),
                       (F.col("_id").isNotNull() & ~held).alias("fits"),
                       (F.col("_id").isNotNull() & held).alias("held"))
    counts = scratch.save(count_grams(rows), "counts")
    scores = score(rows, gram_scores(counts.df, scratch), counts.rows, scratch)
    scores = scores.withColumn("x", F.col("bits") / F.when(F.col("n_bytes") > 0, F.col("n_bytes")))
    short = SHORT / F.sqrt(F.greatest("n_bytes", F.lit(1)))
    # In steps, of which there are few, so that the quantile needs no more memory with more documents.
    stepped = F.ceil((F.col("x") - short) * STEPS) / STEPS
    limits = F.struct(F.percentile(stepped, F.lit(QUANTILE)).alias("q"), F.count("x").alias("n"))
    held_out = scores.where("held")
    every = held_out.agg(limits.alias("every"))                     # one row
    own = scratch.save(held_out.groupBy(F.col("lang").alias("_lang")).agg(limits.alias("own")), "own")
    judged = (scores.join(with_size(own, 256), F.col("lang").eqNullSafe(F.col("_lang")), "left")
              .join(F.broadcast(every)))
    q = F.when(F.col("own.n") >= FEWEST, F.col("own.q")).otherwise(F.col("every.q"))
    judged = judged.withColumn("limit", q + short)
    return judged.select("doc_id", "_hash", "lang", F.col("x").alias("bits_per_byte"),
                         F.pow(F.lit(2.0), F.col("x")).alias("perplexity"), "limit",
                         F.coalesce(F.col("x") <= F.col("limit"), F.lit(True)).alias("kept"))
