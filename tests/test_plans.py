"""Plans must hold at scale: no Python in the data path, no single-task windows, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from conftest import TESTDATA, raw_frames
from creditmart.operators.lookup import JoinLimits
from creditmart.operators import quality
from creditmart.plans import marts, measures, queries
from creditmart.plans.warehouse import Warehouse
from creditmart.sources.tables import Scratch

SF = TESTDATA / "sf0.001"
needs_tables = pytest.mark.skipif(not SF.exists(), reason="test tables are not mounted")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


WRITES_FIRST = {"raw_roundtrip", "pipeline_run", "mart_refresh", "pass_through_views"}
OF_MARTS = sorted(set(entry_module.queries()) - WRITES_FIRST - set(entry_module.LLM_QUERIES))


@needs_tables
@pytest.mark.parametrize("name", OF_MARTS)
def test_plan_is_distributed(spark, name):
    text = plan(entry_module.queries()[name](spark, str(SF)))
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert node not in text, f"{node} in the plan of {name}"
    assert "SinglePartition" not in text or "HashAggregate" in text or "Limit" in text


@needs_tables
def test_scans_are_pruned_and_filtered(spark):
    dw = entry_module.warehouse(spark, str(SF))
    text = plan(dw.fact_pago.groupBy("estado_pago").agg(F.sum("monto_pago")))
    (scan,) = [line for line in text.splitlines() if "FileScan" in line]
    read = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert set(re.findall(r"(\w+):", read)) == {"monto_pago", "estado_pago"}
    (scan,) = [line for line in plan(dw.discards()).splitlines()
               if "FileScan" in line and "credito_id" in line and "pago_id" not in line]
    assert "IsNotNull(_descarte)" in scan


@needs_tables
@pytest.mark.parametrize("build, column", [
    (lambda dw: queries.desembolsos_mensuales(dw, (1996, 1997)), "_mes_desembolso"),
    (lambda dw: marts.pagos_diarios(dw).where("anio = 1996"), "_mes_pago"),
    (lambda dw: marts.cosecha_morosidad(dw).where("anio_cosecha = 1996 and mes_cosecha = 2"), "_mes_desembolso"),
    (lambda dw: measures.measures(dw, ["recaudo_total"], where=F.col("mes") == 3, where_columns=["mes"]), "_mes_pago"),
    (lambda dw: measures.measures(dw, ["tasa_mora_pct"], ["producto"], F.col("anio") == 1996, ["anio"]),
     "_anio_solicitud")])
def test_dated_questions_read_their_periods_only(spark, build, column):
    dw = entry_module.warehouse(spark, str(SF))
    df = build(dw)
    # Spark cuts the filters of a scan off after 100 characters.
    assert re.search(rf"dynamicpruningexpression\({column}#\d+ IN ", plan(df))
    pruned = sorted(map(str, df.collect()))
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.enabled", "false")
    try:
        assert sorted(map(str, build(dw).collect())) == pruned
    finally:
        spark.conf.unset("spark.sql.optimizer.dynamicPartitionPruning.enabled")


@needs_tables
def test_seeds_are_broadcast_by_hint_but_customers_are_not(spark):
    dw = entry_module.warehouse(spark, str(SF))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.cartera_vigente(dw))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert re.findall(r"SortMergeJoin \[(\w+)#", text) == ["cliente_sk"]
    assert {"producto_sk", "estado_credito_sk"} <= set(
        re.findall(r"BroadcastHashJoin \[(\w+)#", text))


def test_large_lookup_is_hashed_by_key_and_piece(spark):
    raw = raw_frames(spark)
    dw = Warehouse(spark, raw, limits=JoinLimits(broadcast_bytes=-1, rows_per_piece=10))
    joined = quality.mark_parent(dw.cleaned("creditos"), "cliente_id", dw._customer_keys, 1,
                                 dw.cleaned("creditos").select("cliente_id"), dw.limits)
    text = plan(joined)
    assert re.search(r"hashpartitioning\(cliente_id#\d+, _pieza#\d+", text)


def test_small_lookup_moves_no_rows(spark):
    raw = raw_frames(spark)
    dw = Warehouse(spark, raw)
    joined = quality.mark_parent(dw.cleaned("creditos"), "cliente_id", dw._customer_keys, 1,
                                 dw.cleaned("creditos").select("cliente_id"), dw.limits)
    assert "hashpartitioning" not in plan(joined)


def test_stages_stay_small_enough_to_be_compiled(spark, monkeypatch):
    """The JVM interprets methods over 8000 bytes, which is many times slower."""
    sizes = {}
    save = Scratch.save
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")

    def measured(self, df, name, key=None, **settings):
        code = debug.codegenString(df._jdf.queryExecution().executedPlan())
        sizes[name] = max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code))
        return save(self, df, name, key, **settings)

    dw = Warehouse(spark, raw_frames(spark))
    dw._find_repeated("clientes", "creditos", "pagos")
    monkeypatch.setattr(Scratch, "save", measured)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dw.build()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert {"clientes-judged", "creditos", "pagos-judged", "pagos"} <= sizes.keys()
    assert max(sizes.values()) < 8000, sizes
