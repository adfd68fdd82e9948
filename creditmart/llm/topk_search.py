"""Exact search for the vectors with the highest inner products.

Queries and rows are packed as integer matrices and dealt into tiles, a group of queries with a shard
of rows each. A tile multiplies its matrices block by block and selects the best rows of each query;
the lists of a query are then merged shard by shard in a tree.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm import vectors
from creditmart.llm.tables import Scratch

SCALE, TOP = 1024, 10


def top_k(queries: DataFrame, rows: DataFrame, k: int = TOP, scale: int = SCALE,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the highest scores for each query.

    Components become floor(scale * x); a score is the integer inner product, with the shorter of two
    vectors filled up with zeros. Equal scores go by smaller id, null last. A row with the query's id is the query's own and
    no candidate of it. Vectors that are null or hold a null, infinite or undefined component take no
    part; a query without candidates has no rows. Queries that repeat an id are answered one by one,
    and rows that repeat one are candidates of their own. Other columns are ignored. A score that may
    not fit in 64 bits raises an error.
    """
    scratch = Scratch(rows.sparkSession)

    def packs(df: DataFrame, size: int, name: str):
        named = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("_vector"))
        df = scratch.save(vectors.pack(named, "_vector", scale, ["vec_id"], size), name).df
        return df, *vectors.extent(df)

    asked, n_asked, dim_asked, norm_asked = packs(queries, vectors.QUERY_PACK, "queries")
    held, n_held, dim_held, norm_held = packs(rows, vectors.ROW_PACK, "rows")
    bound, dim = norm_asked * norm_held, max(dim_asked, dim_held)
    if bound >= vectors.WHOLE:
        raise ValueError("scores may not fit in 64 bits")
    names = ["query", "query_id", "shard"]

    def work(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if len(asked) and len(held):
            rows, shard = vectors.Rows(held, dim), held["shard"][0].as_py()
            for i in range(len(asked)):
                ids = asked["vec_id"][i].values
                scores = vectors.products(vectors.matrix(asked, i, dim), rows.matrix, bound)
                allowed = rows.others(ids)
                for j, top in enumerate(vectors.best(scores, k, allowed)):
                    out.append(((asked["pack"][i].as_py() << vectors.PACK_BITS) + j, ids[j].as_py(), shard,
                                vectors.listed(scores[j], top, rows)))
        return vectors.lists_table(out, names)

    found, shards = vectors.tiles(asked, held, n_asked, n_held, names, work)
    merged = vectors.merged(found, ["query", "query_id"], shards, k)
    ranked = merged.select("query_id", F.posexplode("top").alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "hit.vec_id",
                         (-F.col("hit.cost")).alias("score"))
