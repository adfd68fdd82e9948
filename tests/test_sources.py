import random
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import BASE, entity_rows
from creditmart.model import CLIENTES, CREDITOS, ENTITIES
from creditmart.sources import csv_source
from creditmart.sources.csv_source import (CorruptRows, MissingColumns, check_columns, extract,
                                           land, read_csv)
from creditmart.sources.tables import Scratch, TableStore, scratch_root


def write(path, text: str, bom: bool = False):
    path.parent.mkdir(exist_ok=True)
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return str(path)


def csv_text(entity: str, rows: list[dict]) -> str:
    names = ENTITIES[entity].columns
    return "\n".join([",".join(names), *[",".join(r[n] for n in names) for r in rows]]) + "\n"


def test_required_columns_are_enough():
    check_columns(CLIENTES, CLIENTES.required, "clientes.csv")
    assert "fecha_nacimiento" not in CLIENTES.required


def test_extra_columns_are_fine():
    check_columns(CLIENTES, [*CLIENTES.required, "columna_extra"], "clientes.csv")


def test_renamed_column_fails_naming_it():
    names = ["id_cliente", *[c for c in CLIENTES.required if c != "cliente_id"]]
    with pytest.raises(MissingColumns, match="cliente_id"):
        check_columns(CLIENTES, names, "clientes.csv")


def test_message_lists_file_and_present_columns():
    with pytest.raises(MissingColumns) as err:
        check_columns(CREDITOS, ["credito_id", "otra"], "/data/creditos.csv")
    assert "creditos.csv" in str(err.value) and "otra" in str(err.value)
    assert "tasa_interes_mensual" in str(err.value)


@pytest.mark.parametrize("bom", [True, False])
def test_byte_order_mark_does_not_reach_the_header(spark, tmp_path, bom):
    df = read_csv(spark, write(tmp_path / "c.csv", "cliente_id,nombre\nC001,José\nC002,\n", bom))
    rows = df.select("cliente_id", "nombre", "_source_file").collect()
    assert [tuple(r) for r in rows] == [("C001", "José", "c.csv"), ("C002", "", "c.csv")]


def test_everything_is_text_and_quotes_are_honoured(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "q.csv", 'a,b\n007,"x, ""y"""\n1.50, z \n'))
    assert [tuple(r) for r in df.select("a", "b").collect()] == [("007", 'x, "y"'), ("1.50", " z ")]
    assert dict(df.dtypes)["a"] == "string"


@pytest.mark.parametrize("line", ["1,2,3", "1"])
def test_ragged_rows_fail_the_load(spark, tmp_path, line):
    df = read_csv(spark, write(tmp_path / "r.csv", f"a,b\nx,y\n{line}\n"))
    with pytest.raises(CorruptRows):
        land(df, str(tmp_path / "raw"), Scratch(spark))


def test_files_with_another_header_order_fail(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write(folder / "a.csv", "a,b\n1,2\n")
    write(folder / "b.csv", "b,a\n2,1\n")
    with pytest.raises(Exception):
        read_csv(spark, str(folder)).collect()


def test_raw_id_is_gap_free_and_follows_file_order(spark, tmp_path):
    """Many files and many splits: the number is the line's place in path and line order."""
    folder = tmp_path / "split"
    folder.mkdir()
    expected = []
    for f in range(3):
        lines = [f"{f}-{i},{'x' * (i % 50)}" for i in range(3000)]
        write(folder / f"part-{f}.csv", "k,v\n" + "\n".join(lines) + "\n")
        expected += [line.split(",")[0] for line in lines]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scratch = Scratch(spark)
        raw = read_csv(spark, str(folder))
        assert raw.rdd.getNumPartitions() > 6
        landed = land(raw, str(tmp_path / "raw"), scratch)
        rows = landed.df.orderBy("_raw_id").select("_raw_id", "k", "_orden").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert landed.rows == 9000
    assert set(spark.read.parquet(str(tmp_path / "raw")).columns) == {
        "_raw_id", "k", "v", "_ingested_at", "_source_file"}
    assert [r._raw_id for r in rows] == list(range(1, 9001))
    assert [r.k for r in rows] == expected
    assert all(r._orden == r._raw_id for r in rows)


def test_quoted_line_breaks_are_read_on_request(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n1,"x\ny"\n2,z\n')
    with pytest.raises(CorruptRows):
        land(read_csv(spark, path), str(tmp_path / "raw"), Scratch(spark))
    landed = land(read_csv(spark, path, multi_line=True), str(tmp_path / "lines"), Scratch(spark))
    assert [tuple(r) for r in landed.df.orderBy("_raw_id").select("_raw_id", "a", "b").collect()] == [
        (1, "1", "x\ny"), (2, "2", "z")]


def quoted_rows(seed, n):
    rng = random.Random(seed)
    parts = ["x", "y z", '"', "\n", "\n\n", ",", " ", "é", "\n\"\n", '""', "long " * 9]
    field = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(4)))
    return [(str(i), field(), "line\n" * 120 if i == n // 2 else field()) for i in range(n)]


@pytest.mark.parametrize("split", [64, 333, 1 << 20])
def test_quoted_line_breaks_over_many_splits(spark, tmp_path, split):
    say = lambda v: v if v.isalnum() else '"' + v.replace('"', '""') + '"'
    rows = []
    for name in ("a", "b"):
        own = quoted_rows(name, 60)
        text = "id,p,q\n" + "".join(",".join(map(say, r)) + "\n" + "\n" * (int(r[0]) % 7 == 3) for r in own)
        write(tmp_path / "in" / f"{name}.csv", text, bom=name == "b")
        rows += own
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "in"))
    old = {k: spark.conf.get(f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(f"spark.sql.files.{k}", split if k == "maxPartitionBytes" else 0)
        raw = read_csv(spark, str(tmp_path / "in"), multi_line=True)
        landed = land(raw, str(tmp_path / "raw"), Scratch(spark)).df
        assert split > 333 or raw.select("_bloque").distinct().count() > 5
    finally:
        for k, v in old.items():
            spark.conf.set(f"spark.sql.files.{k}", v)
    got = [tuple(r) for r in landed.orderBy("_raw_id").select("_raw_id", "id", "p", "q").collect()]
    assert got == [(i, *r) for i, r in enumerate(rows, 1)]
    blank = lambda v: v or ""
    assert sorted(r[1:] for r in got) == sorted((r.id, blank(r.p), blank(r.q)) for r in whole.collect())
    assert {r._source_file for r in landed.collect()} == {"a.csv", "b.csv"}


def test_quoted_files_with_other_headers_or_widths_fail(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", 'id,p\n1,"x\ny"\n')
    write(tmp_path / "in" / "b.csv", 'id,r\n1,"x\ny"\n')
    with pytest.raises(CorruptRows, match="1 rows"):
        land(read_csv(spark, str(tmp_path / "in"), multi_line=True), str(tmp_path / "raw"), Scratch(spark))
    path = write(tmp_path / "c.csv", 'id,p\n1,"x\ny",3\n2\n3,z\n')
    with pytest.raises(CorruptRows, match="2 rows"):
        land(read_csv(spark, path, multi_line=True), str(tmp_path / "rows"), Scratch(spark))
    empty = write(tmp_path / "d.csv", "id,p\n")
    assert land(read_csv(spark, empty, multi_line=True), str(tmp_path / "none"), Scratch(spark)).rows == 0


def test_quoted_lines_are_shuffled_once_whole(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n1,"x\ny"\n2,z\n')
    plan = csv_source.quoted_records(spark, path)._jdf.queryExecution().executedPlan().toString()
    wide = {line for line in re.findall(r"Exchange hashpartitioning\([^\n]*", plan)}
    assert "Python" not in plan and all("_archivo" in line for line in wide)


def test_extract_checks_all_files_first(spark, tmp_path):
    paths = {n: write(tmp_path / f"{n}.csv", csv_text(n, entity_rows(n, {}))) for n in BASE}
    assert set(extract(spark, paths)) == set(BASE)
    with pytest.raises(FileNotFoundError, match="nada.csv"):
        extract(spark, {**paths, "pagos": str(tmp_path / "nada.csv")})
    write(tmp_path / "pagos.csv", "pago_id\n1\n")
    with pytest.raises(MissingColumns, match="credito_id"):
        extract(spark, paths)


def test_store_shows_only_published_runs(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "layers"))
    with pytest.raises(ValueError):
        store.read("dwh", "t")
    assert store.write("dwh", "r1", "t", spark.range(3))["rows"] == 3
    with pytest.raises(ValueError):
        store.read("dwh", "t")
    store.publish("r1", "dwh")
    store.write("dwh", "r2", "t", spark.range(5))
    assert store.read("dwh", "t").count() == 3
    store.publish("r2", "dwh")
    assert store.read("dwh", "t").count() == 5
    assert store.drop_superseded("dwh") == ["r1"]
    assert store.read("dwh", "t").count() == 5


def test_history_accumulates_and_a_rerun_replaces_its_own_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "layers"))
    assert store.history("dq", "e", "x long").count() == 0
    rows = spark.range(2).select(F.lit("r").alias("run_id"), F.col("id").alias("x"))
    assert store.append_run("dq", "e", "r1", rows) == 2
    store.append_run("dq", "e", "r2", rows)
    store.append_run("dq", "e", "r2", rows)
    counts = lambda df: {r.run_id: r["count"] for r in df.groupBy("run_id").count().collect()}
    assert counts(store.history("dq", "e", "x long")) == {"r1": 2, "r2": 2}
    before = store.snapshot()
    store.append_run("dq", "e", "r2", rows.limit(1))
    store.append_run("dq", "e", "r3", rows)
    assert counts(before.history("dq", "e", "x long")) == {"r1": 2, "r2": 2}
    assert counts(store.history("dq", "e", "x long")) == {"r1": 2, "r2": 1, "r3": 2}


def test_a_rerun_that_is_not_listed_yet_is_not_read(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "layers"))
    store.append_run("dq", "e", "r1", spark.range(2).withColumnRenamed("id", "x"))
    spark.range(9).withColumnRenamed("id", "x").write.parquet(f"{store.root}/dq/e/run_id=r1/version=half")
    history = store.history("dq", "e", "x long")
    assert history.count() == 2 and history.columns == ["x", "run_id"]
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*run_id.*version", plan)


def test_all_layers_switch_at_once(spark, tmp_path):
    first = TableStore(spark, str(tmp_path / "layers"))
    for layer in ("dwh", "bi"):
        first.write(layer, "r1", "t", spark.range(3))
    first.publish("r1", "dwh", "bi")
    seen = first.snapshot()
    second = TableStore(spark, first.root)
    second.write("dwh", "r2", "t", spark.range(5))
    second.write("bi", "r2", "t", spark.range(6))
    second.publish("r2", "dwh", "bi")
    assert [seen.read(layer, "t").count() for layer in ("dwh", "bi")] == [3, 3]
    assert [first.snapshot().read(layer, "t").count() for layer in ("dwh", "bi")] == [5, 6]
    third = TableStore(spark, first.root)
    third.write("bi", "r2", "t", spark.range(7))
    third.publish("r2", "bi")                       # what it does not replace stays
    now = first.snapshot()
    assert [now.read(layer, "t").count() for layer in ("dwh", "bi")] == [5, 7]
    with pytest.raises(ValueError, match="raw"):
        now.read("raw", "t")


def test_scratch_measures_keys(spark):
    stored = Scratch(spark).save(spark.createDataFrame([("abc",), ("é",)], "k string"), "t", "k")
    assert (stored.rows, stored.key_bytes) == (2, 5)
    assert stored.lookup_bytes == 5 + 2 * 64


def test_split_offsets_read_one_row_per_split(spark):
    splits = spark.createDataFrame(
        [("f1", 0, 10, 0), ("f1", 100, 5, 10), ("f2", 0, 7, 3)],
        "_archivo string, _bloque long, _veces long, _desde long")
    got = {(r._archivo, r._bloque): r._base for r in csv_source.split_offsets(splits).collect()}
    assert got == {("f1", 0): 0, ("f1", 100): 10, ("f2", 0): 15}


def fake_session(master: str, setting: str | None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default),
                           sparkContext=context)


def test_scratch_folder_comes_from_the_session():
    assert scratch_root(fake_session("yarn", "hdfs://x/ck/")) == "hdfs://x/ck"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(fake_session("yarn", None))
    local = fake_session("local[2]", None)
    assert scratch_root(local) == scratch_root(local)


def test_rerun_of_a_published_run_leaves_its_tables_until_published(spark, tmp_path):
    root = str(tmp_path / "layers")
    first, second = TableStore(spark, root), TableStore(spark, root)
    first.write("dwh", "r1", "t", spark.range(3))
    first.publish("r1", "dwh")
    second.write("dwh", "r1", "t", spark.range(9))
    assert second.read("dwh", "t").count() == 3
    second.publish("r1", "dwh")
    assert first.read("dwh", "t").count() == 9
