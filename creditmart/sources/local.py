"""Short driver-made tables (seeds, offsets, log rows) as local relations: using one runs no job."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
          "timestamp": pa.timestamp("us", tz="UTC")}


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few rows; ``schema`` as in ``"id long, name string"``."""
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table(
        {name: pa.array(values, _TYPES[kind]) for (name, kind), values in zip(fields, columns)}))
