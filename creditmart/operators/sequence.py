"""Gap-free surrogate keys from 1, without sorting or counting all rows in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.sources.local import local_frame

POSITION = "_posicion"
_SHIFT = 33      # fixed value: bits below the partition number in monotonically_increasing_id


def arrange(df: DataFrame, numbered: Column, order: list[str]) -> DataFrame:
    """Sort by ``order``, the ``numbered`` rows first, and add each row's partition and place.

    Keys therefore follow ``order``, however the rows came to be stored. The result must be stored
    before ``number`` reads it: only stored positions are stable.
    """
    group = F.when(numbered, 0).otherwise(1).cast("int")
    grouped = df.withColumn("_grupo", group).repartitionByRange("_grupo", *order)
    return (grouped.sortWithinPartitions("_grupo", *order)
            .drop("_grupo")
            .withColumn(POSITION, F.monotonically_increasing_id()))


def number(stored: DataFrame, numbered: Column, name: str) -> DataFrame:
    """The ``numbered`` rows of an arranged, stored table, with key ``name`` counting from 1.

    In every partition the numbered rows come first, so a row's key is its place plus the
    numbered rows of earlier partitions. One count per partition is all the driver sees.
    """
    rows = stored.where(numbered)
    part = F.shiftright(F.col(POSITION), _SHIFT).cast("int")
    counts = sorted(tuple(r) for r in
                    rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect())
    starts = [0, *accumulate(n for _, n in counts)]
    offsets = local_frame(stored.sparkSession,
                          [(p, start) for (p, _), start in zip(counts, starts)],
                          "_p int, _previas long")
    place = F.col(POSITION).bitwiseAND(F.lit((1 << _SHIFT) - 1))
    return (rows.withColumn("_p", part)
            .join(F.broadcast(offsets), "_p")          # one row per written partition
            .withColumn(name, F.col("_previas") + place + 1)
            .drop("_p", "_previas", POSITION))
