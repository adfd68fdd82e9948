"""The corpus pipeline: stages that turn ``documents`` into packed training sequences."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from creditmart.llm import stages
from creditmart.sources.tables import scratch_root

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", stages.quality_filter),
    ("lines", stages.line_filter),
    ("similar", stages.similar_filter),
    ("repeats", stages.repeat_filter),
    ("packing", stages.packed),
]

ORACLE_SQL = None       # similarity, language-model and retrieval stages have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    folder = f"{scratch_root(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
