"""Table storage: scratch tables for one build, and published layers with an atomic switch.

Everything is Parquet under one root. ``Scratch`` holds the intermediate tables of a build;
they cut lineage, survive the loss of executors, and carry the size that later joins use to
decide whether a side may be broadcast. ``TableStore`` holds the layers readers see: each
run writes to its own ``run_id=`` folder, and what is appended to the publication log last makes
all its layers current at once, so no reader meets a half-written load.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
import tempfile
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditmart.sources.local import local_frame


ROW_OVERHEAD = 64        # bytes a row takes in a hash table besides its key
COMPRESSION = "zstd"     # of stored tables

# While a table is written: shuffle files go when it is stored, and rows dealt by some columns of a
# join's key stay where they are.
_STORING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.requireAllClusterKeysForCoPartition": "false"}
_LOCK, _HELD = Lock(), {}


@contextmanager
def storing(spark: SparkSession) -> Iterator[None]:
    """Hold ``_STORING`` in the session; the first writer sets it, the last one puts back what was there."""
    name = spark._jsparkSession.hashCode()
    with _LOCK:
        writers, before = _HELD.get(name) or (0, {k: spark.conf.get(k, None) for k in _STORING})
        _HELD[name] = (writers + 1, before)
        if not writers:
            for k, v in _STORING.items():
                spark.conf.set(k, v)
    try:
        yield
    finally:
        with _LOCK:
            writers, before = _HELD.pop(name)
            if writers > 1:
                _HELD[name] = (writers - 1, before)
            else:
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass(frozen=True)
class Stored:
    """A written table, its row count, and the total bytes of its lookup key."""

    df: DataFrame
    rows: int
    path: str
    key_bytes: int = 0

    @property
    def lookup_bytes(self) -> int:
        """Memory its keys would take as the broadcast side of a lookup, with short payloads."""
        return self.key_bytes + self.rows * ROW_OVERHEAD


def write_counted(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None, compression: str | None = None,
                  **metrics) -> dict[str, int]:
    """Write Parquet and return row count and further metrics, observed during the write."""
    seen = Observation()
    with storing(df.sparkSession):
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                             *[m.alias(k) for k, m in metrics.items()])
        writer = watched.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if compression:
            writer = writer.option("compression", compression)
        writer.parquet(path)
    return seen.get


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a temporary folder per application; never on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="creditmart-")
    return _LOCAL_ROOTS[context.applicationId]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it lives on."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a bare scan out when it has fewer splits than there are cores.

    Large inputs have more splits than cores and are left as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *keys) if scan.rdd.getNumPartitions() < cores else scan


class Scratch:
    """Intermediate tables of one build, each under a name used once."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or scratch_root(spark)}/build-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, key: str | None = None,
             partition_by: list[str] | None = None) -> Stored:
        path = f"{self.path}/{name}"
        schema = df.schema
        size = F.coalesce(F.sum(F.octet_length(key)), F.lit(0)) if key else F.lit(0)
        seen = write_counted(df, path, partition_by=partition_by, compression=COMPRESSION, key_bytes=size)
        return Stored(self.spark.read.schema(schema).parquet(path), seen["rows"], path,
                      seen["key_bytes"])

    def discard(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            delete_folder(self.spark, f"{self.path}/{name}")

    def drop(self) -> None:
        """Delete all tables of the build. Frames that read them no longer work."""
        delete_folder(self.spark, self.path)


@dataclass(frozen=True)
class Snapshot:
    """What one entry of the publication log says: run and version of every layer; and which runs
    tables with history had then."""

    store: "TableStore"
    layers: dict[str, tuple[str, str]]
    runs: dict[str, list[tuple[str, str]]]

    def load(self, layer: str) -> tuple[str, str]:
        if layer not in self.layers:
            raise ValueError(f"layer {layer} has not been published")
        return self.layers[layer]

    def read(self, layer: str, table: str) -> DataFrame:
        return self.store.read(layer, table, self.load(layer))

    def history(self, layer: str, table: str, schema: str) -> DataFrame:
        """The runs of an append table that were listed when the snapshot was taken."""
        listed = self.runs.get(f"{layer}/{table}", [])
        return self.store.read_runs(layer, table, schema, listed)


class TableStore:
    """Published layers under ``root``: raw, stg, dq, dwh, bi.

    Tables are written to folders of a run and version that nobody reads yet. One entry of the
    publication log names the folders of all layers, so that layers switch together; each entry
    repeats what it does not replace, and the latest one is all that a reader needs. Tables that keep history
    list the version of each run in the same way: a rerun lists a new one, and the folder before it
    stays as it is. Loads are published by one process at a time.
    """

    LOG_SCHEMA = "publicado_en timestamp, capa string, run_id string, version string"
    RUN_SCHEMA = "tabla string, run_id string, version string, agregado_en timestamp"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.version = uuid.uuid4().hex      # a rerun of a run never touches its earlier tables

    def _read(self, path: str, schema: str | None = None) -> DataFrame | None:
        try:
            reader = self.spark.read
            return (reader.schema(schema) if schema else reader).parquet(path)
        except AnalysisException as err:
            if err.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def table_path(self, layer: str, run_id: str, table: str, version: str | None = None) -> str:
        return f"{self.root}/{layer}/run_id={run_id}/{version or self.version}/{table}"

    def write(self, layer: str, run_id: str, table: str, df: DataFrame,
              partition_by: list[str] | None = None, **metrics) -> dict[str, int]:
        """Stage one table of a layer. It stays invisible until ``publish``."""
        return write_counted(df, self.table_path(layer, run_id, table), "overwrite", partition_by, COMPRESSION, **metrics)

    def publish(self, run_id: str, *layers: str) -> None:
        """Switch readers of all ``layers`` to this run at once, written after all tables."""
        moment = datetime.now(timezone.utc)
        now = {**self._layers(), **{layer: (run_id, self.version) for layer in layers}}
        rows = [(moment, layer, *load) for layer, load in sorted(now.items())]
        (local_frame(self.spark, rows, self.LOG_SCHEMA).coalesce(1)       # one file, seen whole or not
         .write.mode("append").parquet(f"{self.root}/_publicaciones"))

    def _log(self) -> DataFrame | None:
        return self._read(f"{self.root}/_publicaciones", self.LOG_SCHEMA)

    def _layers(self) -> dict[str, tuple[str, str]]:
        log = self._log()
        if log is None:
            return {}
        last = log.groupBy("publicado_en").agg(F.collect_list(F.struct("capa", "run_id", "version")).alias("capas"))
        rows = last.agg(F.max_by("capas", "publicado_en")).first()[0] or []     # a row per layer
        return {r.capa: (r.run_id, r.version) for r in rows}

    def _runs(self) -> dict[str, list[tuple[str, str]]]:
        """Of each table that keeps history, the version listed last for each run."""
        listed = self._read(f"{self.root}/_historial", self.RUN_SCHEMA)
        if listed is None:
            return {}
        last = listed.groupBy("tabla", "run_id").agg(F.max_by("version", "agregado_en").alias("version"))
        found: dict[str, list[tuple[str, str]]] = {}
        for r in last.collect():                                 # one short row per run
            found.setdefault(r.tabla, []).append((r.run_id, r.version))
        return found

    def snapshot(self) -> Snapshot:
        """All layers as they are published now; what it reads never changes."""
        return Snapshot(self, self._layers(), self._runs())

    def load(self, layer: str) -> tuple[str, str]:
        """Run and version of the load that is current now; reads may be pinned to it."""
        return Snapshot(self, self._layers(), {}).load(layer)

    def current_run(self, layer: str) -> str | None:
        return self._layers().get(layer, (None,))[0]

    def read(self, layer: str, table: str, load: tuple[str, str] | None = None) -> DataFrame:
        """A table of ``load``, or of the current one."""
        run_id, version = load or self.load(layer)
        return self.spark.read.parquet(self.table_path(layer, run_id, table, version))

    def drop_superseded(self, layer: str) -> list[str]:
        """Delete every published load of a layer but the current one; returns their run ids.

        Call when no reader is left on the old tables.
        """
        log, current = self._log(), self._layers().get(layer)
        loads = [] if log is None else (log.where(F.col("capa") == layer).select("run_id", "version")
                                        .distinct().collect())
        old = sorted(tuple(r) for r in loads if tuple(r) != current)      # one short row per load
        for run_id, version in old:
            delete_folder(self.spark, f"{self.root}/{layer}/run_id={run_id}/{version}")
        return [run_id for run_id, _ in old]

    def append_run(self, layer: str, table: str, run_id: str, df: DataFrame) -> int:
        """Add one run's rows to a table that keeps history; a rerun of the same run replaces them.

        They are listed when they are all there. Readers of the rows they replace keep those.
        """
        version = uuid.uuid4().hex
        path = f"{self.root}/{layer}/{table}/run_id={run_id}/version={version}"
        rows = write_counted(df.drop("run_id"), path, compression=COMPRESSION)["rows"]
        entry = [(f"{layer}/{table}", run_id, version, datetime.now(timezone.utc))]
        (local_frame(self.spark, entry, self.RUN_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/_historial"))
        return rows

    def read_runs(self, layer: str, table: str, schema: str, listed: list[tuple[str, str]]) -> DataFrame:
        """The rows of the ``listed`` runs and versions; folders of others are not read."""
        full = f"{schema}, run_id string, version string"
        found = self._read(f"{self.root}/{layer}/{table}", full) if listed else None
        if found is None:
            return self.spark.createDataFrame([], f"{schema}, run_id string")
        folder = F.concat_ws("/", "run_id", "version")
        return found.where(folder.isin(["/".join(r) for r in listed])).drop("version")

    def history(self, layer: str, table: str, schema: str) -> DataFrame:
        """All runs of an append table; an empty frame with ``schema`` before the first run."""
        return self.snapshot().history(layer, table, schema)

    def events(self, layer: str, table: str, schema: str) -> DataFrame:
        """All rows appended to a table by ``run_id``; an empty frame before the first one."""
        full = f"{schema}, run_id string"
        found = self._read(f"{self.root}/{layer}/{table}", full)
        return self.spark.createDataFrame([], full) if found is None else found
