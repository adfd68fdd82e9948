"""Integer vectors packed as matrices, tiles of queries and rows, and top lists merged by a tree."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.tables import ready_workers

QUERY_PACK, ROW_PACK = 128, 1024    # vectors of a packed matrix
QUERY_GROUP, SHARD_ROWS = 4096, 16384       # the two sides of a tile
PACK_BITS = 16                      # a vector's number is its pack's, shifted, and its place there
FAN = 16                            # lists that one merge takes
PARTITIONS = 4096                   # most that tiles are dealt to at once
WHOLE = 2.0 ** 62                   # components and scores stay below


def _components(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of doubles, shorter ones filled with zeros, and which rows are usable.

    A vector that is null, or has a component that is null, infinite or no number, is not.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    rows = np.zeros((len(column), width))
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows, column.is_valid().to_numpy(zero_copy_only=False) & np.isfinite(rows).all(axis=1)


def pack(df: DataFrame, vector: str, scale: int, carried: list[str], rows: int) -> DataFrame:
    """Matrices of up to ``rows`` vectors of ``df``, each component x as floor(scale * x).

    ``pack, dim, width, norm, matrix`` and the ``carried`` columns as arrays; ``width`` is the bytes
    of a component, ``norm`` bounds the length of each vector. Unusable vectors are left out.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            found, usable = _components(batch.column(0))
            whole = np.floor(scale * found[usable])
            if (np.abs(whole) >= WHOLE).any():
                raise ValueError("a component does not fit in 64 bits")
            whole = whole.astype(np.int64)
            most = int(np.abs(whole).max(initial=0))
            whole = whole.astype(f"<i{next(w for w in (2, 4, 8) if most < 1 << 8 * w - 1)}")
            norms = np.sqrt(np.square(whole, dtype=np.float64).sum(axis=1)) * (1 + 1e-9)
            kept = batch.filter(pa.array(usable))
            for at in range(0, len(whole), rows):
                part = slice(at, at + rows)
                matrix = whole[part]
                yield pa.record_batch(
                    [pa.array([number]), pa.array([matrix.shape[1]], pa.int32()),
                     pa.array([matrix.itemsize], pa.int32()), pa.array([norms[part].max(initial=0.0)]),
                     pa.array([matrix.tobytes()], pa.binary()),
                     *[pa.array([c[part].to_pylist()], pa.list_(c.type)) for c in kept.columns[1:]]],
                    ["pack", "dim", "width", "norm", "matrix", *carried])
                number += 1

    ready_workers(df.sparkSession)
    kinds = ", ".join(f"{c} array<{df.schema[c].dataType.simpleString()}>" for c in carried)
    return df.select(F.col(vector).cast("array<double>").alias("_v"), *carried).mapInArrow(
        work, f"pack long, dim int, width int, norm double, matrix binary, {kinds}")


def matrix(table: pa.Table, row: int, dim: int) -> np.ndarray:
    """The matrix of a packed row, as whole numbers, with ``dim`` columns."""
    width = table["dim"][row].as_py()
    found = np.frombuffer(table["matrix"][row].as_py(), f"<i{table['width'][row].as_py()}")
    found = found.reshape(len(found) // width, width) if width else \
        np.zeros((len(table["vec_id"][row]), 0), np.int16)
    return np.pad(found, ((0, 0), (0, dim - width)))


def products(queries: np.ndarray, rows: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products, none of which, nor any partial sum, is over ``bound``."""
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return (queries.astype(kind) @ rows.astype(kind).T).astype(np.int64)


class Rows:
    """The candidates of a tile in order of id, null last, so that ties go to the first."""

    def __init__(self, held: pa.Table, dim: int, label: str | None = None):
        ids = pa.chunked_array([c.flatten() for c in held["vec_id"].chunks]).combine_chunks()
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        self.ids = ids.take(pa.array(order))
        self.known = self.ids.is_valid().to_numpy(zero_copy_only=False)
        self.numbers = pc.fill_null(self.ids, 0).to_numpy(zero_copy_only=False)
        self.matrix = np.concatenate([matrix(held, i, dim) for i in range(len(held))])[order]
        if label:
            labels = pa.chunked_array([c.flatten() for c in held[label].chunks]).combine_chunks()
            self.labels = labels.to_numpy(zero_copy_only=False)[order]

    def others(self, queries: pa.Array) -> np.ndarray:
        """Per query, the rows that do not have its id; a null id is nobody's."""
        known = queries.is_valid().to_numpy(zero_copy_only=False)[:, None]
        numbers = pc.fill_null(queries, 0).to_numpy(zero_copy_only=False)[:, None]
        return ~(self.known & known & (self.numbers == numbers))


def best(scores: np.ndarray, k: int, allowed: np.ndarray) -> list[np.ndarray]:
    """Per line of ``scores``, the places of the ``k`` highest allowed ones, equal ones in order."""
    n = scores.shape[1]
    k = min(k, n)
    if not k:
        return [np.zeros(0, np.int64)] * len(scores)
    most = int(np.abs(scores).max())
    if (most + 1) * n < 1 << 62:        # score and place in one number, selected without a full sort
        keys = np.where(allowed, scores * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
        top = np.argpartition(keys, n - k, axis=1)[:, n - k:]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(keys, top, 1), axis=1), 1)
    else:
        falling = np.where(allowed, ~scores, np.iinfo(np.int64).max)
        top = np.argsort(falling, axis=1, kind="stable")[:, :k]
    return [t[a[t]] for t, a in zip(top, allowed)]


LISTED = "array<struct<cost: bigint, unknown: boolean, vec_id: bigint>>"


def listed(scores: np.ndarray, places: np.ndarray, rows: Rows) -> list[dict]:
    """A top list, whose entries sort as they rank."""
    return [{"cost": -int(scores[p]), "unknown": not rows.known[p], "vec_id": rows.ids[int(p)].as_py()}
            for p in places]


LIST = pa.list_(pa.struct([("cost", pa.int64()), ("unknown", pa.bool_()), ("vec_id", pa.int64())]))


def lists_schema(names: list[str]) -> str:
    """Spark's schema of long columns and a ``top`` list."""
    return ", ".join(f"{n} long" for n in names) + f", top {LISTED}"


def lists_table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * (len(names) + 1)
    return pa.table([*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], LIST)],
                    [*names, "top"])


def tiles(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int, names: list[str],
          work: Callable[[pa.Table, pa.Table], pa.Table]) -> tuple[DataFrame, int]:
    """``work`` over each group of packed queries with each shard of packed rows; and the shards.

    Both sides of a tile have a size that does not grow with the tables.
    """
    groups, shards = max(1, -(-n_queries // QUERY_GROUP)), max(1, -(-n_rows // SHARD_ROWS))
    number = lambda n: F.pmod(F.xxhash64("pack"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return cogrouped(queries.select("*", number(groups).alias("group"), every(shards).alias("shard")),
                     rows.select("*", every(groups).alias("group"), number(shards).alias("shard")),
                     groups * shards, lists_schema(names), work), shards


def cogrouped(asked: DataFrame, held: DataFrame, n: int, schema: str,
              work: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """``work`` over the two sides of each of ``n`` tiles; ``group`` and ``shard`` name a tile."""
    tile, parts = ["group", "shard"], min(3 * n, PARTITIONS)
    return (asked.repartition(parts, *tile).groupBy(*tile)
            .cogroup(held.repartition(parts, *tile).groupBy(*tile)).applyInArrow(work, schema))


def merged(lists: DataFrame, keys: list[str], shards: int, k: int) -> DataFrame:
    """One top list of ``k`` for each of ``keys``, from the ``top`` of every ``shard``.

    FAN neighbouring shards are merged at a time, so no group grows with the number of shards.
    """
    while shards > 1:
        shards = -(-shards // FAN)
        together = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k)
        lists = lists.groupBy(*keys, F.floor(F.col("shard") / FAN).alias("shard")).agg(together.alias("top"))
    return lists.select(*keys, "top")


def extent(packs: DataFrame) -> tuple[int, int, float]:
    """Vectors of all packs, their widest dimension, and a bound of their lengths."""
    row = packs.agg(F.coalesce(F.sum(F.size("vec_id")), F.lit(0)), F.coalesce(F.max("dim"), F.lit(0)),
                    F.coalesce(F.max("norm"), F.lit(0.0))).first()
    return tuple(row)
