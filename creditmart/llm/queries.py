"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.llm import bpe, warc
from creditmart.llm.chat_format import conversation_digests, format_conversations
from creditmart.llm.exact_dedup import exact_dedup
from creditmart.llm.fingerprints import edited_fingerprints
from creditmart.llm.hard_negatives import hard_negatives
from creditmart.llm.jaccard_join import jaccard_components
from creditmart.llm.lexical_search import search
from creditmart.llm.line_dedup import line_dedup
from creditmart.llm.packing import pack_documents
from creditmart.llm.quality import classify
from creditmart.llm.sql import SQL
from creditmart.llm.suffix_dedup import remove_repeats
from creditmart.llm.tables import Scratch, table, text_of
from creditmart.llm.topk_search import top_k
from creditmart.sources.tables import delete_folder


def op1_bpe(spark: SparkSession, sf_dir: str,
            vocabulary: str = public_tokenizers.path("byte_bpe_50k.json")) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary)
    return bpe.decode(encoded, vocabulary).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the equal document that stays."""
    return exact_dedup(table(spark, sf_dir, "documents"), all_digests=True)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back as a capture."""
    scratch = Scratch(spark)
    folder = f"{scratch.path}/archives"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = scratch.save(warc.read_records(spark, folder, with_payload=False), "records").df
    delete_folder(spark, folder)                    # all that is asked of the archives is stored
    return warc.page_table(scratch.save(warc.assemble(records), "captures").df)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of an edited text, and how near both and the next are."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template recurs in other documents."""
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.char_length(text_of("text")).cast("long").alias("kept_chars"),
        F.sha2(text_of("text"), 256).alias("kept_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings that stand elsewhere too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                       F.sha2("kept", 256).alias("kept_sha256"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are control strings, read back from its windows."""
    said = F.lit("</s>[INST] ok [/INST]")
    own = F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                             F.lit(role).alias("role"), said.alias("text"))
                    for i, role in enumerate(("user", "assistant"))])
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.range(1).select(F.inline(own)))
    return conversation_digests(format_conversations(rows))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its similar ones."""
    return jaccard_components(table(spark, sf_dir, "documents")).drop("_hash", "_group")


def op9_packing(spark: SparkSession, sf_dir: str,
                vocabulary: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    """Every document packed with its lexical neighbours, piece by piece."""
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's perplexity under the model of trusted text, and whether it is kept."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("_hash")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every hundredth one."""
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows.where(F.col("vec_id") % 100 == 0), rows)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty documents that rank highest for each benchmark item."""
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the positives of every hundredth vector."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_warc": op3_warc,
    "op4_fingerprints": op4_fingerprints,
    "op5_line_dedup": op5_line_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_chat_format": op7_chat_format,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_topk_search": op11_topk_search,
    "op12_lexical_search": op12_lexical_search,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = dict(SQL)
