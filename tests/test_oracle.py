"""Every registered query against its SQL on DuckDB, and the golden funnel counts."""

import math
from datetime import date
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import TESTDATA

SF = TESTDATA / "sf0.001"
TABLES = "customer nation orders lineitem".split()

pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not mounted")
QUERIES, ORACLE = ({k: v for k, v in found.items() if k not in entry_module.LLM_QUERIES}
                   for found in (entry_module.queries(), entry_module.oracle_sql()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    checked = duck.execute(ORACLE[name])
    names = [d[0] for d in checked.description]
    expected = checked.fetchall()
    assert expected, "the check itself returns rows"
    assert table(df.columns, df.collect()) == table(names, expected)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


# Golden counts at the smallest scale: table, rule, error rows.
ERRORS = [("DQ-1", "creditos", 6), ("DQ-1", "pagos", 1401), ("DQ-2", "creditos", 35),
          ("DQ-2", "pagos", 139), ("DQ-3", "clientes", 2), ("DQ-3", "creditos", 58),
          ("DQ-3", "pagos", 69), ("DQ-4", "creditos", 42), ("DQ-4", "pagos", 102),
          ("DQ-5", "creditos", 53), ("DQ-5", "pagos", 76), ("DQ-6", "clientes", 2),
          ("DQ-6", "creditos", 16), ("DQ-7", "clientes", 21), ("DQ-7", "pagos", 884)]


def test_golden_funnel(spark):
    dw = entry_module.warehouse(spark, str(SF))
    got = {(r.regla_id, r.tabla_origen): r["count"] for r in
           dw.errors().groupBy("regla_id", "tabla_origen").count().collect()}
    assert got == {(rule, f"raw_{t}"): n for rule, t, n in ERRORS}
    assert sum(got.values()) == 2906
    assert [dw.valid(n).count() for n in ("clientes", "creditos", "pagos")] == [143, 1296, 4213]
    assert dw.cutoff == date(2002, 7, 23)
    drops = {(r.tabla, r.motivo): r["count"] for r in
             dw.discards().groupBy("tabla", "motivo").count().collect()}
    assert sorted(drops.values()) == [32, 104, 540, 773]
    loans = dw.fact_credito
    assert (loans.count(), dw.fact_pago.count()) == (1160, 2900)
    assert loans.where("tiempo_desembolso_sk is null").count() == 101
    assert loans.where("tiempo_vencimiento_sk is null").count() == 96
    assert loans.groupBy().sum("dias_mora").first()[0] == 542146
