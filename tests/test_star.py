from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import raw_frames
from creditmart.functions.dates import date_key, easter_sunday, monday_on_or_after
from creditmart.operators.calendar import dim_tiempo, holidays
from creditmart.operators.lookup import JoinLimits, attach, key_counts
from creditmart.operators.sequence import arrange, number
from creditmart.operators.star import NO_KEY, OUT_OF_CALENDAR, days_in_arrears
from creditmart.plans.concurrent import together
from creditmart.plans.warehouse import Warehouse
from creditmart.sources.tables import Scratch

EASTER = {1961: "04-02", 1981: "04-19", 1995: "04-16", 2000: "04-23", 2008: "03-23", 2011: "04-24",
          2019: "04-21", 2023: "04-09", 2024: "03-31", 2025: "04-20", 2026: "04-05",
          2027: "03-28", 2028: "04-16", 2029: "04-01", 2030: "04-21", 2038: "04-25",
          2049: "04-18", 2076: "04-19", 2100: "03-28"}


def test_easter(spark):
    years = spark.createDataFrame([(y,) for y in EASTER], "y int")
    got = {r.y: r.d.strftime("%m-%d") for r in
           years.select("y", easter_sunday(F.col("y")).alias("d")).collect()}
    assert got == EASTER


def test_easter_is_always_a_sunday_in_range(spark):
    years = spark.range(1900, 2200).select(easter_sunday(F.col("id").cast("int")).alias("d"))
    for r in years.collect():
        assert r.d.weekday() == 6
        assert date(r.d.year, 3, 22) <= r.d <= date(r.d.year, 4, 25)


def test_monday_on_or_after(spark):
    days = [date(2024, 1, 1) + timedelta(n) for n in range(14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", monday_on_or_after(F.col("d")).alias("m"), date_key(F.col("d")).alias("k")).collect():
        assert r.m.weekday() == 0 and 0 <= (r.m - r.d).days < 7
        assert r.k == int(r.d.strftime("%Y%m%d"))


def test_holidays_of_2024(spark):
    got = sorted(r.fecha.strftime("%m-%d") for r in holidays(spark, 2024, 2024).collect())
    assert got == ["01-01", "01-08", "03-25", "03-28", "03-29", "05-01", "05-13", "06-03", "06-10",
                   "07-01", "07-20", "08-07", "08-19", "10-14", "11-04", "11-11", "12-08", "12-25"]


def test_default_calendar(spark):
    days = {r.fecha: r for r in dim_tiempo(spark).collect()}
    assert len(days) == 2922
    assert min(days) == date(2023, 1, 1) and max(days) == date(2030, 12, 31)
    for d, r in days.items():
        assert (r.tiempo_sk, r.anio, r.mes, r.dia) == (int(d.strftime("%Y%m%d")), d.year, d.month, d.day)
        assert r.semana_anio == d.isocalendar()[1]
        assert r.trimestre == (d.month + 2) // 3
        assert r.es_fin_semana == (d.weekday() >= 5)
    first = days[date(2023, 1, 1)]
    assert (first.nombre_mes, first.nombre_dia, first.es_festivo_co) == ("Enero", "Domingo", True)
    assert days[date(2024, 5, 15)].nombre_dia == "Miercoles"
    assert days[date(2024, 5, 18)].nombre_dia == "Sabado"
    assert days[date(2024, 5, 15)].es_festivo_co is False


@pytest.mark.parametrize("state, due, expected", [
    ("Mora", date(2025, 1, 1), 59), ("Activo", date(2024, 1, 1), 0), ("Mora", date(2026, 1, 1), 0),
    ("Vencido", date(2025, 1, 1), 59), ("Mora", None, 0)])
def test_days_in_arrears(spark, state, due, expected):
    df = spark.createDataFrame([(state, due)], "s string, d date")
    days = days_in_arrears(F.col("s"), F.col("d"), F.lit(date(2025, 3, 1)))
    assert df.select(days).first()[0] == expected


def test_numbering_is_gap_free_and_ordered(spark):
    df = spark.range(5000, numPartitions=7).select(
        ((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 3 == 0).alias("in_"))
    kept = F.col("in_")
    stored = Scratch(spark).save(arrange(df, kept, ["k"]), "ordered").df
    rows = number(stored, kept, "sk").orderBy("k").select("sk").collect()
    assert [r.sk for r in rows] == list(range(1, len(rows) + 1))


def test_hot_key_is_spread_over_tasks(spark):
    left = spark.range(20000, numPartitions=4).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = left.select("k").distinct().withColumn("v", F.length("k"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(left, right, ["k"], right_bytes=1 << 40, salt_by=["id"],
                        counts=key_counts(left, ["k"]), limits=JoinLimits(0, 500))
        where = (joined.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
                 .collect())
        assert len(where) == 4
        assert max(r["count"] for r in where) < 0.5 * sum(r["count"] for r in where)
        assert joined.count() == 20000 and joined.where("v is null").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.fixture(scope="module")
def dw(spark):
    return Warehouse(spark, raw_frames(
        spark,
        [dict(cliente_id="C0001", numero_documento="1"),
         dict(cliente_id="C0002", numero_documento="2", estado_cliente="Otro"),
         dict(cliente_id="C0003", numero_documento="3")],
        [dict(credito_id="A", estado_credito="Mora", fecha_vencimiento="2025-01-10"),
         dict(credito_id="B", fecha_desembolso="", estado_credito="Vencido", fecha_vencimiento=""),
         dict(credito_id="C", fecha_solicitud="2022-12-31", fecha_desembolso="2023-01-01"),
         dict(credito_id="D", cliente_id="C0002"),
         dict(credito_id="E", fecha_vencimiento="2031-01-01", producto="CAPITAL TRABAJO",
              canal="app", cliente_id="C0003"),
         dict(credito_id="F", monto_aprobado="0")],
        [dict(pago_id="1", credito_id="A", metodo_pago="efecty"),
         dict(pago_id="2", credito_id="C"),
         dict(pago_id="3", credito_id="D"),
         dict(pago_id="4", credito_id="E", fecha_pago="2032-01-01"),
         dict(pago_id="5", credito_id="E"),
         dict(pago_id="6", credito_id="F")]))


def test_cutoff_is_the_latest_valid_date_even_in_the_future(dw):
    assert dw.cutoff == date(2032, 1, 1)


def test_explicit_cutoff(spark):
    dw = Warehouse(spark, raw_frames(spark, creditos=[dict(estado_credito="Mora")]),
                   cutoff_date=date(2025, 1, 20))
    assert dw.fact_credito.first().dias_mora == 10


def test_cutoff_without_dates_is_today(spark):
    assert Warehouse(spark, raw_frames(spark, [], [], [])).cutoff.year >= 2025


def test_dim_cliente(dw):
    rows = {r.cliente_id: r.cliente_sk for r in dw.dim_cliente.collect()}
    assert rows == {"C0001": 1, "C0003": 2}


def test_fact_credito(dw):
    rows = {r.credito_id: r for r in dw.fact_credito.collect()}
    assert set(rows) == {"A", "B", "E"}
    assert sorted(r.fact_credito_sk for r in rows.values()) == [1, 2, 3]
    a, b, e = rows["A"], rows["B"], rows["E"]
    assert (a.cliente_sk, a.producto_sk, a.canal_sk, a.estado_credito_sk) == (1, 4, 2, 2)
    assert (a.tiempo_solicitud_sk, a.tiempo_desembolso_sk) == (20240110, 20240112)
    assert a.dias_mora == (date(2032, 1, 1) - date(2025, 1, 10)).days
    assert b.tiempo_desembolso_sk is None and b.dias_mora == 0
    assert (e.producto_sk, e.canal_sk, e.tiempo_vencimiento_sk) == (3, 3, None)


def test_fact_pago(dw):
    rows = {r.pago_id: r for r in dw.fact_pago.collect()}
    assert set(rows) == {"1", "5"}
    assert (rows["1"].metodo_pago_sk, rows["1"].cliente_sk, rows["5"].cliente_sk) == (2, 1, 2)


def test_discards_name_every_valid_row_left_out(dw):
    got = {(r.tabla, r.clave): r.motivo for r in dw.discards().collect()}
    assert got == {("fact_credito", "C"): OUT_OF_CALENDAR, ("fact_credito", "D"): NO_KEY,
                   ("fact_pago", "2"): NO_KEY, ("fact_pago", "3"): NO_KEY,
                   ("fact_pago", "4"): OUT_OF_CALENDAR, ("fact_pago", "6"): NO_KEY}


def test_seeds(dw):
    assert [r.nombre for r in dw.dim_producto.orderBy("producto_sk").collect()] == [
        "Microcredito", "Libre inversion", "Capital trabajo", "Consumo"]
    states = {r.estado_id: (r.es_activo, r.es_mora, r.es_terminado)
              for r in dw.dim_estado_credito.collect()}
    assert states["VENCIDO"] == (False, False, False) and states["MORA"] == (False, True, False)


def test_jobs_run_together_and_the_first_failure_is_raised():
    assert together({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
    done = []

    def fail():
        raise KeyError("x")

    with pytest.raises(KeyError):
        together({"bad": fail, "good": lambda: done.append(1)})
    assert done == [1]
