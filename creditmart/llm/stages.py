"""The operators as stages over tables with the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.llm.jaccard_join import jaccard_components
from creditmart.llm.line_dedup import line_dedup
from creditmart.llm.packing import pack_documents
from creditmart.llm.quality import classify
from creditmart.llm.suffix_dedup import remove_repeats
from creditmart.llm.tables import Scratch, table, text_of, with_size

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _as_documents(rows: DataFrame) -> DataFrame:
    """The columns of ``documents``, with ``n_chars`` of the text as it is now."""
    return rows.withColumn("n_chars", F.char_length(text_of("text")).cast("long")).select(*COLUMNS)


def _is(other: str) -> Column:
    """Join condition on id and text with a table's ``_id`` and ``_h``."""
    return (F.col("doc_id").eqNullSafe(F.col(f"{other}._id"))
            & (F.xxhash64(text_of("text")) == F.col(f"{other}._h")))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. Null and empty texts stay; rows that repeat an
    id and its text go or stay together."""
    judged = classify(docs, table(spark, sf_dir, "labels"))
    rejected = Scratch(spark).save(judged.where(~F.col("kept")).select(
        F.col("doc_id").alias("_id"), F.col("_hash").alias("_h")).distinct(), "rejected")
    return docs.select(*COLUMNS).join(with_size(rejected).alias("r"), _is("r"), "left_anti")


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; one of which only white space is left goes.

    Other empty texts, and null, stay. Rows that repeat an id and its text get the same answer.
    """
    rows = line_dedup(docs)
    return _as_documents(rows.where((F.col("n_dropped") == 0) | text_of("text").rlike(r"[^\x20\x09-\x0D]")))


def similar_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that with the smallest id.

    Of rows that have it, the one with the smallest hash of its text stays, and of equal rows one.
    Rows of unlike texts are groups of their own, also where they repeat an id. Documents without
    words stay, and so do those without an id where the whole group has none.
    """
    scratch = Scratch(spark)
    joined = scratch.save(jaccard_components(docs), "components").df
    alone = (F.col("n_shingles") == 0) | F.col("component_id").isNull()
    own = F.col("doc_id") == F.col("component_id")
    first = joined.where(~alone & own).groupBy("_group", "doc_id", "_hash").agg(F.count(F.lit(1)).alias("n"))
    keeper = first.groupBy("_group").agg(F.min(F.struct("_hash", "doc_id", "n")).alias("k")).select("k.*")
    stays = keeper.unionByName(joined.where(alone).select("doc_id", "_hash").distinct()
                               .withColumn("n", F.lit(1).cast("long")))
    stays = scratch.save(stays.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "n"),
                         "stays")
    kept = docs.select(*COLUMNS).join(with_size(stays).alias("s"), _is("s"))
    single = kept.where("n = 1").select(*COLUMNS)
    repeated = kept.where("n > 1").dropDuplicates(["doc_id", "_h"]).select(*COLUMNS)
    return single.unionByName(repeated)


def repeat_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without long strings that repeat; every document stays, if need be empty."""
    rows = remove_repeats(docs.select(*COLUMNS), as_text=True)
    return _as_documents(rows.withColumnRenamed("kept", "text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences; a null text is an empty document. Rows that
    repeat an id are documents of their own."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
