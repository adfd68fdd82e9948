"""Inputs and intermediate tables shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import creditmart
from creditmart.sources.tables import Scratch, Stored

BROADCAST_BYTES = 64 << 20      # most that a side may take, by its counted rows, to be broadcast
ROW_BYTES = 64                  # memory of a broadcast row with a few numeric columns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fits(side: Stored, row_bytes: int = ROW_BYTES) -> bool:
    """Whether a written table is small enough, by its counted rows, to be broadcast."""
    return side.rows * row_bytes <= BROADCAST_BYTES


def with_size(side: Stored, row_bytes: int = ROW_BYTES) -> DataFrame:
    """The written table, to be broadcast if its counted rows allow; else joined by shuffle."""
    return F.broadcast(side.df) if fits(side, row_bytes) else side.df


__all__ = ["BROADCAST_BYTES", "Scratch", "Stored", "fits", "table", "text_of", "with_size"]


_KEPT: dict[str, Callable[[], object]] = {}     # of a worker: how to forget what an operator keeps


def keeps(operator: str, forget: Callable[[], object]) -> None:
    """Name what drops the caches that an operator keeps in a worker between its tasks."""
    _KEPT[operator] = forget


def forget_others(operator: str) -> None:
    for name, forget in _KEPT.items():
        if name != operator:
            forget()


def give_back() -> None:
    """Return freed memory to the system, where the platform can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(operator: str, work: Callable) -> Callable:
    """``work`` over batches, as a task that holds no more memory than it needs.

    A worker serves one operator after another. Before the first batch it drops what others keep,
    and after the last one it gives back what it has freed.
    """
    def task(batches: Iterator) -> Iterator:
        forget_others(operator)
        yield from work(batches)
        give_back()

    return task


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}      # the driver serves it until it ends


def ready_workers(spark: SparkSession) -> None:
    """Prepare the session for functions that run in Python workers.

    Workers get this package, and take few rows and bytes at once, as texts are long; smaller
    settings stay.
    """
    for name, most in (("maxRecordsPerBatch", 1000), ("maxBytesPerBatch", 32 << 20)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(re.sub(r"\D", "", spark.conf.get(name)) or 0) <= most:
            spark.conf.set(name, str(most))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        folder = _SHIPPED[context.applicationId] = tempfile.TemporaryDirectory()
        archive = f"{folder.name}/creditmart.zip"
        root = Path(creditmart.__file__).parent
        with zipfile.ZipFile(archive, "w") as package:
            for file in sorted(root.rglob("*.py")):
                package.write(file, file.relative_to(root.parent))
        context.addPyFile(archive)
