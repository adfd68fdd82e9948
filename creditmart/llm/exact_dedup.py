"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

A first scan reads each text's normalised length and a hash of its first characters. Only where
both repeat does the second scan hash the whole content, so a text whose length and beginning are
its own is never hashed in full unless the caller asks for every digest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.tables import Scratch, fits, text_of

WHITE_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
PREFIX_CHARS = 64
GROUP_BYTES = 160               # memory of a broadcast group
PARTS = 16                      # that the rows of a group are dealt to, where groups are not broadcast


def normalised(text: Column) -> Column:
    """The text without white space; case, punctuation and order of characters count."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE_SPACE, text)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                all_digests: bool = False, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after removing white space. Of equal texts the one with the most
    code points before that stays, then the one with the smallest id; a null id counts as largest.
    A null text counts as empty, and all empty texts are one group. Rows that repeat an id and its
    text get the same answer and count in ``group_size``. An empty table gives no rows; other
    columns are ignored, whatever their names. ``text_sha256`` is the digest of the normalised
    text; for a text that no other equals it is null, unless ``all_digests`` asks for it.
    """
    scratch = Scratch(docs.sparkSession)
    text = text_of(text_col)
    content = docs.select(F.col(id_col).alias("doc_id"), F.char_length(text).alias("_chars"),
                          normalised(text).alias("_norm"))
    content = content.withColumns({"_len": F.char_length("_norm"),
                                   "_prefix": F.xxhash64(F.substring("_norm", 1, prefix_chars))})
    shared = scratch.save(content.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
                          .where("_n > 1").select("_len", "_prefix", F.lit(True).alias("_shared")),
                          "shared")
    if fits(shared):
        found = content.join(F.broadcast(shared.df), ["_len", "_prefix"], "left")
        found = found.withColumn("_shared", F.coalesce("_shared", F.lit(False)))
    else:       # moving texts to a join costs more than hashing them all where they are
        found = content.withColumn("_shared", F.lit(True))
    read = F.lit(True) if all_digests else F.col("_shared")
    rows = scratch.save(found.select("doc_id", "_chars", "_shared",
                                     F.when(read, F.sha2("_norm", 256)).alias("text_sha256")),
                        "rows").df
    first = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("doc_id").isNull().alias("n"),
                           F.col("doc_id").alias("id")))
    groups = (rows.where("_shared").groupBy(F.col("text_sha256").alias("_key"))
              .agg(first.alias("_first"), F.count(F.lit(1)).alias("_size")).where("_size > 1"))
    groups = scratch.save(groups, "groups")
    own = F.col("text_sha256") == F.col("_key")
    if fits(groups, GROUP_BYTES):
        joined = rows.join(F.broadcast(groups.df), own & F.col("_shared"), "left")
    else:       # a group may have any number of rows, so its rows are dealt to several tasks
        every = groups.df.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        part = F.pmod(F.xxhash64("doc_id", "_chars", F.monotonically_increasing_id()), F.lit(PARTS)).cast("int")
        joined = rows.where("_shared").withColumn("_own", part).join(
            every, own & (F.col("_own") == F.col("_part")), "left")
        joined = joined.unionByName(rows.where(~F.col("_shared")), allowMissingColumns=True)
    digest = F.col("text_sha256") if all_digests else F.when(F.col("_size").isNotNull(), F.col("text_sha256"))
    return joined.select(
        "doc_id", F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_first.id"))
        .alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("_size").isNull() | F.col("doc_id").eqNullSafe(F.col("_first.id"))).alias("kept"),
        digest.alias("text_sha256"))
