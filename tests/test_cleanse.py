import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import entity_rows, raw_frame
from creditmart.functions.parsing import fits, float_text, parse_date, parse_double, truncated
from creditmart.functions.text import WHITESPACE, catalog_value, is_blank, strip
from creditmart.model import (CLIENTES, CREDITOS, ESTADOS_CLIENTE, ESTADOS_CREDITO, ESTADOS_PAGO,
                              PAGOS)
from creditmart.operators.cleanse import cleanse, to_staging


def apply(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", build(strip(F.col("x"))).alias("y")).orderBy("i").collect()]


def test_strip_removes_all_whitespace(spark):
    samples = ["  a b \t", " 　x \n", "", " ", WHITESPACE, "\x1ca\x1f", "é ", "a"]
    assert apply(spark, samples, lambda c: c) == [s.strip() for s in samples]


def test_is_blank(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t　",), ("x",)], "x string")
    assert [r.b for r in df.select(is_blank(strip(F.col("x"))).alias("b")).collect()] == [
        True, True, True, False]


@pytest.mark.parametrize("catalog, text, expected", [
    (ESTADOS_CLIENTE, "activo", "Activo"),
    (ESTADOS_CREDITO, "MORA", "Mora"),
    (ESTADOS_CLIENTE, "EN REVISION", "EnRevision"),
    (ESTADOS_PAGO, "success", "Exitoso"),
    (ESTADOS_PAGO, "EXITOSO", "Exitoso"),
    (ESTADOS_CREDITO, "Aprobado", None),
    (ESTADOS_CLIENTE, "  activo  ", "Activo"),
])
def test_catalog(spark, catalog, text, expected):
    assert apply(spark, [text], lambda c: catalog_value(c, catalog)) == [expected]


def test_dates(spark):
    cases = {
        "2024-05-21": date(2024, 5, 21), "2024/03/20": date(2024, 3, 20), "": None,
        "2024-13-01": None, "2024-02-29": date(2024, 2, 29), "2023-02-29": None,
        "5-3-2024": date(2024, 3, 5), "31/12/2024": date(2024, 12, 31), "2024-1-2": date(2024, 1, 2),
        "2024-01-01x": None, "24-01-01": None, "12024-01-01": None, "2024": None,
        "2024-01-01 00:00:00": None, " 2024-05-21 ": date(2024, 5, 21), "0000-01-01": None,
        "01-01-0000": None, "2024-01- 5": date(2024, 1, 5), "2024- 1-05": None, "2024/03-20": date(2024, 3, 20), "32-01-2024": None,
    }
    assert apply(spark, list(cases), parse_date) == list(cases.values())


def fitting(text):
    return F.when(fits(parse_double(text), "decimal(18,2)"), parse_double(text))


def test_numbers(spark):
    cases = {
        "2799828": 2799828.0, "1.77": 1.77, "-700000": -700000.0, "": None, "N/A": None,
        " 12 ": 12.0, "+5": 5.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "1_000": 1000.0,
        "1__000": None, "_1": None, "inf": None, "nan": None, "1.0d": None, "1e999": None,
        "0x10": None, "1,000": None, "99999999999999999999": None,
    }
    read = apply(spark, list(cases), fitting)
    assert read == list(cases.values())


def test_integers(spark):
    cases = {"12": 12, "12.0": 12, "-12.9": -12, "12.9": 12, "": None, "x": None, "inf": None,
             "1e12": 10**12, "-3e9": -3 * 10**9, "1e20": None}
    assert apply(spark, list(cases), lambda c: truncated(parse_double(c))) == list(cases.values())


def python_date(text):
    for fmt in ("%Y-%m-%d", "%d-%m-%Y"):
        try:
            return datetime.strptime(text.strip().replace("/", "-"), fmt).date()
        except ValueError:
            pass
    return None


def python_number(text):
    try:
        value = float(text)
    except ValueError:
        return None
    return value if abs(value) < 1e16 - 0.005 else None


def test_number_texts(spark):
    rng = random.Random(5)
    values = [0.0, -0.001, 1e-4, 9.9e-5, 50000.0, 1e15, 1e16, 1e20, -2.5e-7, 12345678.9, 1e7, 0.1 + 0.2, 1e100,
              float("inf"), -float("inf"), 5e-324, *[rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20) for _ in range(500)]]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [float(r[0]) for r in df.select(float_text(F.col("v"))).collect()] == values
    exact = values[:15]
    assert [r[0] for r in df.limit(15).select(float_text(F.col("v"))).collect()] == [repr(v) for v in exact]


def test_dates_agree_with_the_standard_library(spark):
    rng = random.Random(7)
    parts = ["2024", "1999", "0001", "12", "1", "02", "29", "30", "31", "13", "00", "7", " 7", "", "24"]
    texts = ["".join((rng.choice(parts), rng.choice("-/ "), rng.choice(parts), rng.choice("-/"),
                      rng.choice(parts))) for _ in range(3000)]
    texts += ["".join(rng.choice("0123456789-/ ") for _ in range(rng.randint(6, 11)))
              for _ in range(2000)]
    expected = [python_date(t) for t in texts]
    assert sum(d is not None for d in expected) > 100
    assert apply(spark, texts, parse_date) == expected


def test_numbers_agree_with_the_standard_library(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("0123456789" * 2 + "..eE+-__ ") for _ in range(rng.randint(1, 7)))
             for _ in range(6000)]
    expected = [python_number(t) for t in texts]
    assert sum(n is not None for n in expected) > 1000
    assert apply(spark, texts, fitting) == expected


def cleansed(spark, entity, **overrides):
    return cleanse(entity, raw_frame(spark, entity.name, entity_rows(entity.name, overrides))).first()


def test_clientes(spark):
    row = cleansed(spark, CLIENTES, estado_cliente="activo", tipo_documento=" nit ",
                   fecha_registro="2024/03/20", ingresos_mensuales="-2500000")
    assert (row.estado_cliente, row._estado_cliente_valido) == ("Activo", True)
    assert (row.tipo_documento, row._tipo_doc_valido) == ("NIT", True)
    assert row.fecha_registro == date(2024, 3, 20)
    assert row.ingresos_mensuales == -2500000.0


def test_unknown_catalogue_value_is_kept(spark):
    row = cleansed(spark, CLIENTES, estado_cliente=" Desconocido ", tipo_documento="PAS")
    assert (row.estado_cliente, row._estado_cliente_valido) == ("Desconocido", False)
    assert (row.tipo_documento, row._tipo_doc_valido) == ("PAS", False)


def test_creditos(spark):
    row = cleansed(spark, CREDITOS, estado_credito="MORA", tasa_interes_mensual="",
                   monto_aprobado="-700000", plazo_meses="24.0")
    assert (row.estado_credito, row._estado_credito_valido) == ("Mora", True)
    assert row.tasa_interes_mensual is None
    assert (row.monto_aprobado, row.plazo_meses) == (-700000.0, 24)


def test_pagos_keep_the_text_behind_a_bad_date(spark):
    row = cleansed(spark, PAGOS, estado_pago="success", fecha_pago="2024-13-01")
    assert row.estado_pago == "Exitoso"
    assert row.fecha_pago is None
    assert row._texto_fecha_pago == "2024-13-01"


def test_null_text_reads_as_blank(spark):
    row = cleansed(spark, PAGOS, metodo_pago=None)
    assert row.metodo_pago == ""


def test_optional_columns_may_be_absent(spark):
    raw = raw_frame(spark, "clientes", entity_rows("clientes", {})).drop(
        "fecha_nacimiento", "ingresos_mensuales")
    row = cleanse(CLIENTES, raw).first()
    assert row.fecha_nacimiento is None and row.ingresos_mensuales is None


def test_staging_types_and_rounding(spark):
    raw = raw_frame(spark, "creditos", entity_rows(
        "creditos", dict(monto_aprobado="10.005", tasa_interes_mensual="1.23455")))
    staged = to_staging(CREDITOS, cleanse(CREDITOS, raw))
    assert dict(staged.dtypes)["monto_aprobado"] == "decimal(18,2)"
    assert dict(staged.dtypes)["tasa_interes_mensual"] == "decimal(8,4)"
    row = staged.first()
    assert (str(row.monto_aprobado), str(row.tasa_interes_mensual)) == ("10.01", "1.2346")
    assert staged.columns[:11] == CREDITOS.columns


def test_staging_flags_default_to_false(spark):
    staged = to_staging(CLIENTES, cleanse(CLIENTES, raw_frame(spark, "clientes",
                                                              entity_rows("clientes", {}))))
    row = staged.first()
    assert row.flag_email_duplicado is False and row.flag_doc_duplicado is False
