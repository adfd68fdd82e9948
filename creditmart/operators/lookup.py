"""Many-to-one lookup that stays even when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMES = "_veces"
PIECE = "_pieza"
_BUCKETS = 1 << 16       # keys are counted by bucket before they are counted one by one


@dataclass(frozen=True)
class JoinLimits:
    """``broadcast_bytes``: largest side sent to every executor, measured when it was written.
    ``rows_per_piece``: a key with more rows than this is spread over several tasks."""

    broadcast_bytes: int = 64 << 20
    rows_per_piece: int = 2_000_000


DEFAULT_LIMITS = JoinLimits()


def key_counts(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Rows per key, with further aggregates; combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(TIMES),
                                 *[col.alias(name) for name, col in aggregates.items()])


def repeated_keys(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Keys that occur more than once, with their row count in ``TIMES``."""
    return key_counts(df, keys, **aggregates).where(F.col(TIMES) > 1)


def frequent_keys(df: DataFrame, keys: list[str], rows_per_piece: int) -> DataFrame:
    """Rows per key of all keys with more than ``rows_per_piece`` rows, and perhaps of a few others.

    Rows are counted by a hash of their key first. Only in buckets with that many rows can such a
    key be, so just their rows are grouped by key: as a rule none.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)).cast("int").alias("_cubo")
    crowded = (df.groupBy(bucket).agg(F.count(F.lit(1)).alias(TIMES))
               .where(F.col(TIMES) > rows_per_piece).select("_cubo"))      # _BUCKETS rows at most
    return key_counts(df.select(*keys, bucket).join(F.broadcast(crowded), "_cubo", "left_semi"), keys)


def hot_keys(counts: DataFrame, keys: list[str], rows_per_piece: int) -> DataFrame:
    """Keys with more than ``rows_per_piece`` rows and the number of pieces to cut them into.

    At most one key per ``rows_per_piece`` rows can qualify, which bounds the result for any
    input and makes it safe to broadcast.
    """
    return (counts.where(F.col(TIMES) > rows_per_piece)
            .select(*keys, F.ceil(F.col(TIMES) / rows_per_piece).cast("int").alias("_piezas")))


def attach(left: DataFrame, right: DataFrame, keys: list[str], *, right_bytes: int,
           counts: DataFrame, salt_by: list[str],
           limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Left join against ``right``, which holds each key once.

    A right side measured as small is broadcast, so ``left`` is not moved. Otherwise both sides
    are shuffled on key and piece: rows of a hot key are spread over its pieces by a hash of
    ``salt_by``, and only hot keys are repeated on the right. ``counts`` holds rows per key
    (``TIMES``) for the hot keys at least; it is read in the second case only.
    """
    if right_bytes <= limits.broadcast_bytes:
        return left.join(F.broadcast(right), keys, "left")
    hot = F.broadcast(hot_keys(counts, keys, limits.rows_per_piece))
    return (_in_pieces(left, hot, keys, salt_by)
            .join(_in_all_pieces(right, hot, keys), [*keys, PIECE], "left").drop(PIECE))


def _in_pieces(rows: DataFrame, hot: DataFrame, keys: list[str], salt_by: list[str]) -> DataFrame:
    pieces = F.coalesce(F.col("_piezas"), F.lit(1))
    return (rows.join(hot, keys, "left")
            .withColumn(PIECE, F.when(pieces > 1, F.pmod(F.xxhash64(*salt_by), pieces))
                        .otherwise(0).cast("int"))
            .drop("_piezas"))


def _in_all_pieces(right: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    pieces = F.coalesce(F.col("_piezas"), F.lit(1))
    return (right.join(hot, keys, "left")
            .withColumn(PIECE, F.explode(F.sequence(F.lit(0), pieces - 1)))
            .drop("_piezas"))


def attach_marked(left: DataFrame, right: DataFrame, keys: list[str], marks: DataFrame, identity: list[str], *,
                  right_bytes: int, marks_bytes: int, counts: DataFrame, salt_by: list[str],
                  limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """``attach``, and on the same way the columns of ``marks``, which hold for some rows of ``left``.

    ``identity`` tells the rows of ``left`` apart as far as marks do, and includes ``keys`` and
    ``salt_by``. So marks too many to be broadcast are dealt like ``left``, which moves but once.
    """
    if marks_bytes <= limits.broadcast_bytes:
        marked = left.join(F.broadcast(marks), identity, "left")
        return attach(marked, right, keys, right_bytes=right_bytes, counts=counts, salt_by=salt_by, limits=limits)
    hot = F.broadcast(hot_keys(counts, keys, limits.rows_per_piece))
    rows, found = (_in_pieces(df, hot, keys, salt_by) for df in (left, marks))
    if right_bytes <= limits.broadcast_bytes:
        rows = rows.join(F.broadcast(right), keys, "left").repartition(*keys, PIECE)
    else:
        rows = rows.join(_in_all_pieces(right, hot, keys), [*keys, PIECE], "left")
    return rows.join(found.repartition(*keys, PIECE), [*identity, PIECE], "left").drop(PIECE)
