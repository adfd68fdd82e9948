from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import raw_frames
from creditmart.functions import masking
from creditmart.functions.numeric import half_up_ratio, percentage, rounded_mean
from creditmart.plans import marts, measures, queries
from creditmart.plans.warehouse import Warehouse


def one(spark, columns: dict, build):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in columns.items()])
    return row.select(build(*[F.col(k) for k in columns])).first()[0]


@pytest.mark.parametrize("value, expected", [
    ("12345678", "****5678"), ("12345", "*2345"), ("1234", "1234"), ("", ""), (None, None)])
def test_document(spark, value, expected):
    assert one(spark, {"x": value}, masking.mask_document) == expected


@pytest.mark.parametrize("value, expected", [
    ("3001234567", "******4567"), ("1234", "1234"), ("123", "123"), ("", ""), (None, None)])
def test_phone(spark, value, expected):
    assert one(spark, {"x": value}, masking.mask_phone) == expected


@pytest.mark.parametrize("value, expected", [
    ("juan@dominio.com", "j***@dominio.com"), ("ab@x", "a*@x"),
    ("a@x", "a@x"), ("@x", "@@x"), ("sin-arroba", "sin-arroba"), ("", ""), (None, None),
    ("a@b@c", "a@b@c")])
def test_email(spark, value, expected):
    assert one(spark, {"x": value}, masking.mask_email) == expected


@pytest.mark.parametrize("names, surnames, expected", [
    ("Jorge Luis", "Luna", "Jorge L."), ("Comercial Andina SAS", "", "Comercial"),
    ("Ana", None, "Ana"), ("", "Luna", " L."), (None, "Luna", None)])
def test_display_name(spark, names, surnames, expected):
    assert one(spark, {"n": names, "s": surnames}, masking.display_name) == expected


@pytest.mark.parametrize("income, band", [
    (None, "Sin dato"), ("-2500000", "< 5M"), ("4999999.99", "< 5M"), ("5000000", "5M - 10M"),
    ("10000000", "10M - 20M"), ("19999999.99", "10M - 20M"), ("20000000", "> 20M")])
def test_income_band(spark, income, band):
    assert one(spark, {"x": income}, lambda c: masking.income_band(c.cast("decimal(18,2)"))) == band


@pytest.mark.parametrize("num, den, digits, expected", [
    (1, 8, 2, "0.13"), (1, 3, 2, "0.33"), (2, 3, 2, "0.67"), (5, 2, 0, "3"), (0, 5, 2, "0.00"),
    (1, 0, 2, None)])
def test_half_up(spark, num, den, digits, expected):
    got = spark.range(1).select(half_up_ratio(F.lit(num), F.lit(den), digits)).first()[0]
    assert (None if got is None else str(got)) == expected


def test_percentage_and_rounded_mean(spark):
    row = spark.range(1).select(
        percentage(F.lit(1), F.lit(800)).alias("p"),
        rounded_mean(F.lit("10.05").cast("decimal(28,2)"), F.lit(10), 2, 2).alias("m"),
        rounded_mean(F.lit("5.00").cast("decimal(28,2)"), F.lit(2), 2, 0).alias("r")).first()
    assert (str(row.p), str(row.m), str(row.r)) == ("0.13", "1.01", "3")


@pytest.fixture(scope="module")
def dw(spark):
    return Warehouse(spark, raw_frames(
        spark,
        [dict(cliente_id="C1", numero_documento="1", segmento="Pyme"),
         dict(cliente_id="C2", numero_documento="2", segmento="Retail", apellidos="")],
        [dict(credito_id="A", cliente_id="C1", monto_aprobado="100.5"),
         dict(credito_id="B", cliente_id="C1", monto_aprobado="200", estado_credito="Mora"),
         dict(credito_id="C", cliente_id="C1", monto_aprobado="50", estado_credito="Rechazado"),
         dict(credito_id="D", cliente_id="C2", monto_aprobado="70", fecha_desembolso="",
              estado_credito="Vencido", producto="Microcredito")],
        [dict(pago_id="1", credito_id="A", monto_pago="10"),
         dict(pago_id="2", credito_id="A", monto_pago="30", estado_pago="Fallido"),
         dict(pago_id="3", credito_id="B", monto_pago="5", estado_pago="Reversado")]))


@pytest.fixture(scope="module")
def empty(spark):
    return Warehouse(spark, raw_frames(spark, [], [], []))


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_cartera_vigente(dw):
    (row,) = rows(marts.cartera_vigente(dw))
    assert (row["segmento"], row["producto"], row["num_creditos"]) == ("Pyme", "Consumo", 1)
    assert float(row["monto_total"]) == 100.5 and row["tasa_promedio"] == 1.5


def test_morosidad(dw):
    got = {r["producto"]: r for r in rows(marts.morosidad_por_producto(dw))}
    assert (got["Consumo"]["total_creditos"], got["Consumo"]["creditos_mora"]) == (3, 1)
    assert str(got["Consumo"]["tasa_mora_pct"]) == "33.33"
    assert got["Microcredito"]["creditos_vencidos"] == 1
    assert got["Microcredito"]["dias_mora_promedio"] is None


def test_vintage_leaves_out_loans_without_disbursement(dw):
    got = rows(marts.cosecha_morosidad(dw))
    assert [(r["producto"], r["total_creditos"], r["creditos_deteriorados"]) for r in got] == [
        ("Consumo", 3, 1)]


def test_kpis(dw):
    (row,) = rows(marts.kpi_resumen(dw))
    assert row["cartera_activa_count"] == 1 and float(row["recaudo_total"]) == 10.0
    assert str(row["tasa_fallo_pago_pct"]) == "33.33" and str(row["tasa_aprobacion_pct"]) == "75.00"
    assert str(row["ticket_promedio"]) == "124"          # 370.5 / 3 = 123.5, half up


def test_kpis_of_nothing(empty):
    (row,) = rows(marts.kpi_resumen(empty))
    assert row["cartera_activa_count"] == 0 and float(row["cartera_vigente_monto"]) == 0
    assert row["tasa_mora_pct"] is None and row["ticket_promedio"] is None


def test_top_clientes_limit_and_ties(dw):
    got = rows(queries.top_clientes(dw, 1))
    assert [(r["cliente_id"], r["num_creditos"]) for r in got] == [("C1", 2)]
    assert rows(queries.top_clientes(dw))[1]["nombre_cliente"] == "Test "


def test_only_customers_with_several_open_loans(dw):
    (row,) = rows(queries.clientes_multiples_creditos(dw))
    assert (row["cliente_id"], row["total_creditos_vigentes"]) == ("C1", 2)
    assert (float(row["exposicion_total"]), float(row["monto_en_mora"])) == (300.5, 200.0)


def test_measures_slice_filter_and_blank_rules(dw, empty):
    (row,) = rows(measures.measures(dw, list(measures.MEASURES)))
    assert float(row["cartera_vigente"]) == 100.5 and row["tasa_aprobacion_pct"] == 75.0
    got = {r["segmento"]: r for r in
           rows(measures.measures(dw, ["tasa_mora_pct", "recaudo_total", "tasa_fallo_pago_pct"],
                                  by=["segmento"]))}
    assert got["Retail"]["recaudo_total"] is None and got["Retail"]["tasa_fallo_pago_pct"] == 0
    (filtered,) = rows(measures.measure(dw, "num_creditos_activos",
                                        where=F.col("segmento") == "Pyme",
                                        where_columns=["segmento"]))
    assert filtered["num_creditos_activos"] == 1
    (none,) = rows(measures.measures(empty, list(measures.MEASURES)))
    assert none["tasa_mora_pct"] == 0 and none["ticket_promedio"] is None


def test_measures_refuse_slices_without_a_relation(dw):
    with pytest.raises(measures.IllegalSlice, match="canal"):
        measures.measures(dw, ["recaudo_total"], by=["canal"])


def test_drill_down_levels(dw):
    got = rows(measures.drill_down(dw, ["tasa_mora_pct", "recaudo_total"]))
    assert {r["nivel"] for r in got} == {0, 1, 2, 3, 4}
    (total,) = [r for r in got if r["nivel"] == 4]
    assert total["tasa_mora_pct"] == 25.0 and float(total["recaudo_total"]) == 10.0


def test_marts_take_any_star(dw):
    star = SimpleNamespace(**dw.star())
    assert rows(marts.kpi_resumen(star)) == rows(marts.kpi_resumen(dw))


def test_a_measure_drops_the_filter_on_its_own_column(dw):
    """Against the plain reading of each measure: its own filter instead of the one on that column."""
    loans = [r.asDict() for r in marts.with_state(dw, dw.fact_credito).collect()]
    wanted = {"estado_credito": lambda r: r["estado"] != "Activo", "es_activo": lambda r: not r["es_activo"]}
    got, = rows(measures.measures(
        dw, ["num_creditos_activos", "ticket_promedio", "tasa_mora_pct", "tasa_aprobacion_pct"],
        filters={"estado_credito": F.col("estado_credito") != "Activo", "es_activo": ~F.col("es_activo")}))
    def among(own, column=None):
        return [r for r in loans if own(r) and all(f(r) for c, f in wanted.items() if c != column)]
    active = among(lambda r: r["es_activo"], "es_activo")
    approved = among(lambda r: r["estado"] != "Rechazado", "estado_credito")
    late, every = among(lambda r: r["es_mora"], "es_mora"), among(lambda r: True)
    assert every and approved and got == {
        "num_creditos_activos": len(active) or None,
        "ticket_promedio": pytest.approx(float(sum(r["monto_aprobado"] for r in approved)) / len(approved)),
        "tasa_mora_pct": pytest.approx(100 * len(late) / len(every)),
        "tasa_aprobacion_pct": pytest.approx(100 * len(approved) / len(every))}


def test_a_filter_on_a_sliced_column_limits_the_rows(dw):
    got = rows(measures.measures(dw, ["ticket_promedio", "tasa_mora_pct"], by=["estado_credito"],
                                 filters={"estado_credito": F.col("estado_credito") == "Mora"}))
    whole = rows(measures.measures(dw, ["ticket_promedio"]))
    assert [r["estado_credito"] for r in got] == ["Mora"]
    assert got[0]["ticket_promedio"] == whole[0]["ticket_promedio"]
