"""What keeps the disk that a load takes in proportion: rows move once, and hold each value once."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA, raw_frames
from creditmart.model import CLIENTES, ORDER, PAGOS
from creditmart.operators import quality
from creditmart.operators.lookup import JoinLimits, attach_marked, frequent_keys, hot_keys
from creditmart.plans.warehouse import Warehouse
from creditmart.sources import fixtures, tables
from creditmart.sources.csv_source import land, read_csv
from creditmart.sources.tables import Scratch, write_counted

SHUFFLED = JoinLimits(broadcast_bytes=-1, rows_per_piece=20)
PAYMENTS = [dict(pago_id="P0" if i % 3 == 0 else f"P{i % 40}", credito_id="CR1" if i % 2 else f"CR{i % 30}",
                 referencia_transaccion=f"R{i % 45}", monto_pago="x" if i % 11 == 0 else f"{i}") for i in range(200)]


@pytest.fixture()
def raw(spark):
    return raw_frames(spark, [dict(cliente_id=f"C{i % 6}") for i in range(8)],
                      [dict(credito_id=f"CR{i % 15}", cliente_id=f"C{i % 7}") for i in range(20)], PAYMENTS)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limits", [JoinLimits(), SHUFFLED])
def test_later_rows_are_all_rows_of_a_key_but_the_first(spark, raw, limits):
    scratch = Scratch(spark)
    later = quality.later_rows(PAGOS, raw["pagos"], "credito_id", scratch, limits)
    seen, expected = set(), []
    for place, row in enumerate(PAYMENTS):
        if row["pago_id"] in seen:
            expected.append((row["credito_id"], row["pago_id"], place, True))
        seen.add(row["pago_id"])
    assert sorted(map(tuple, later.df.select("credito_id", "pago_id", ORDER, quality.LATER).collect())) == sorted(expected)
    assert scratch.spark.read.parquet(f"{scratch.path}/pagos-hot").count() == (limits is SHUFFLED)     # P0


def test_rows_of_equal_key_and_place_are_all_first(spark, raw):
    twice = raw["clientes"].unionByName(raw["clientes"])
    later = quality.later_rows(CLIENTES, twice, None, Scratch(spark))
    marked = quality.mark_later(CLIENTES, twice, later)
    assert marked.count() == 16
    assert sorted(r[0] for r in marked.where(quality.LATER).select(ORDER).collect()) == [6, 6, 7, 7]


def test_payments_move_once_for_loan_and_mark(spark):
    left = spark.range(600).select(F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 50).cast("string"))
                                   .alias("fk"), (F.col("id") % 90).alias("k"), F.struct("id").alias("o"), F.lit("x").alias("wide"))
    right = left.select("fk").distinct().where("fk <> '7'").withColumn("p", F.length("fk"))
    marks = left.where("k % 5 = 0").select("fk", "k", "o", F.lit(True).alias("m")).distinct()
    whole = left.join(right, "fk", "left").join(marks, ["fk", "k", "o"], "left")
    expected = sorted(map(str, whole.select("fk", "k", "o", "wide", "p", "m").collect()))
    counts = frequent_keys(left, ["fk"], 20)
    for right_bytes, marks_bytes in ((9, 9), (0, 9), (9, 0), (0, 0)):
        joined = attach_marked(left, right, ["fk"], marks, ["fk", "k", "o"], right_bytes=right_bytes,
                               marks_bytes=marks_bytes, counts=counts, salt_by=["o"], limits=JoinLimits(5, 20))
        assert sorted(map(str, joined.select("fk", "k", "o", "wide", "p", "m").collect())) == expected
    with tables.storing(spark):
        text = plan(joined.select("*"))
    assert "hashpartitioning(fk" in text and not re.search(r"hashpartitioning\([^)]*o#\d+, _pieza", text)


def test_frequent_keys_are_counted_whole(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "a").otherwise(F.col("id").cast("string")).alias("k"))
    found = frequent_keys(df, ["k"], 100)
    assert {tuple(r) for r in found.where("_veces > 100").collect()} == {("a", 400)}
    assert [tuple(r) for r in hot_keys(found, ["k"], 100).collect()] == [("a", 4)]
    assert frequent_keys(df, ["k"], 400).where("_veces > 400").count() == 0


def test_stored_rows_hold_no_payload_and_facts_take_their_columns(spark, raw):
    dw = Warehouse(spark, raw).build()
    judged = spark.read.parquet(f"{dw.scratch.path}/pagos-judged").columns
    assert not {quality.PAYLOAD, quality.LATER, quality.FIRST} & set(judged) and "_texto_monto_pago" in judged
    for name in ("creditos", "pagos"):
        entering = spark.read.parquet(f"{dw.scratch.path}/{name}").columns
        assert not [c for c in entering if c.startswith(("_texto", "_motivos", ORDER))]
    bodies = dw.errors().where("regla_id = 'DQ-1'").select("payload_original").collect()
    assert bodies and all('"_texto_original":{' in r[0] and "flag_referencia" not in r[0] for r in bodies)


def test_moved_rows_without_hot_keys_give_the_same_warehouse(spark, raw):
    def outcome(dw):
        return [sorted(map(str, df.collect())) for df in (
            dw.errors(), dw.fact_pago, dw.fact_credito, dw.valid("pagos").select(*PAGOS.columns, *PAGOS.flags))]
    assert outcome(Warehouse(spark, raw, limits=JoinLimits(-1, 1 << 20))) == outcome(Warehouse(spark, raw))


def test_shuffle_files_go_when_a_table_is_stored(spark, tmp_path):
    # Spark's own bookkeeping of shuffle files; none is left of the ones this write made.
    def maps():
        return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    before = maps()
    write_counted(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count(), str(tmp_path / "t"))
    assert maps() <= before
    assert spark.read.parquet(str(Path(tmp_path) / "t")).count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true" and not tables._HELD


def test_tables_that_nothing_reads_any_more_are_deleted(spark, raw, tmp_path):
    dw = Warehouse(spark, raw).build()
    kept = {p.name for p in Path(dw.scratch.path).iterdir()}
    assert not kept & {"clientes-judged", "clientes-later", "creditos-later", "pagos-later"}
    assert {"clientes", "creditos-judged", "pagos-judged", "creditos", "pagos"} <= kept
    scratch, source = Scratch(spark), str(tmp_path / "in")
    spark.createDataFrame([("a",), ("b",)], "k string").write.option("header", True).csv(source)
    landed = land(read_csv(spark, source), str(tmp_path / "raw_x"), scratch)
    assert not [p for p in Path(scratch.path).iterdir()] and landed.df.count() == 2


def test_payments_are_put_in_order_as_numbers(spark, tmp_path):
    """Texts are made of the sorted rows: numbers take less room on the way."""
    spark.createDataFrame([(5, 1, 1, 9, 2.0, "A", "F", "1996-01-02"), (4, 1, 2, 9, 1.0, "N", "O", "1996-01-02"),
                           (6, None, 1, 7, 1.0, "R", "F", "1996-01-01"), (7, 0, 1, 7, 1.0, "R", "F", None)],
                          "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_extendedprice double, "
                          "l_returnflag string, l_linestatus string, l_shipdate string"
                          ).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("customer", "nation", "orders"):
        spark.read.parquet(str(TESTDATA / "sf0.001" / f"{name}.parquet")).write.parquet(str(tmp_path / f"{name}.parquet"))
    paid = fixtures.raw_entities(spark, str(tmp_path), in_order=True)["pagos"]
    assert [r.pago_id for r in paid.collect()] == ["P6-1", "P7-1", "P4-2", "P5-1"]
    text = paid._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("concat(") < text.index("RepartitionByExpression [l_partkey")
    plain = fixtures.raw_entities(spark, str(tmp_path))["pagos"]
    assert sorted(map(str, paid.collect())) == sorted(map(str, plain.collect()))
