"""Star schema: seed dimensions, fact columns and the reasons rows are left out of a fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.functions.dates import date_key, month_of, year_of
from creditmart.model import CANALES, ESTADOS_CREDITO_DIM, METODOS_PAGO, PRODUCTOS
from creditmart.sources.local import local_frame

DISCARD = "_descarte"

# Periods that facts are stored by: the column, the date key it follows from, and how.
PERIODS = {
    "fact_credito": {"_anio_solicitud": ("tiempo_solicitud_sk", year_of),
                     "_mes_desembolso": ("tiempo_desembolso_sk", month_of)},
    "fact_pago": {"_mes_pago": ("tiempo_pago_sk", month_of)},
}
# What facts take from judged rows.
OF_LOANS = ("credito_id", "cliente_sk", "producto_sk", "canal_sk", "estado_credito_sk", "fecha_solicitud",
            "fecha_desembolso", "fecha_vencimiento", "monto_aprobado", "plazo_meses", "tasa_interes_mensual",
            "estado_credito")
OF_PAYMENTS = ("pago_id", "credito_id", "cliente_sk", "metodo_pago_sk", "fecha_pago", "monto_pago",
               "estado_pago", "referencia_transaccion", "flag_referencia_duplicada")
OUT_OF_CALENDAR, NO_KEY = "fecha fuera de calendario", "llave subrogada nula"


def _seed(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    return local_frame(spark, [(i, *r) for i, r in enumerate(rows, 1)], columns)


def dim_producto(spark: SparkSession) -> DataFrame:
    return _seed(spark, PRODUCTOS, "producto_sk long, producto_id string, nombre string")


def dim_canal(spark: SparkSession) -> DataFrame:
    return _seed(spark, CANALES, "canal_sk long, canal_id string, nombre string")


def dim_estado_credito(spark: SparkSession) -> DataFrame:
    return _seed(spark, ESTADOS_CREDITO_DIM,
                 "estado_credito_sk long, estado_id string, nombre string, "
                 "es_activo boolean, es_mora boolean, es_terminado boolean")


def dim_metodo_pago(spark: SparkSession) -> DataFrame:
    return _seed(spark, METODOS_PAGO,
                 "metodo_pago_sk long, metodo_id string, nombre string, tipo string")


def with_seed_key(df: DataFrame, seed: DataFrame, key: str, label: str) -> DataFrame:
    """Key of the seed row whose label matches ``label`` in any case; null where none does."""
    lookup = seed.select(F.lower("nombre").alias("_etiqueta"), key)
    return (df.join(F.broadcast(lookup), F.lower(F.col(label)) == F.col("_etiqueta"), "left")
            .drop("_etiqueta"))                                 # seeds have 3 to 6 rows


def in_calendar(day: Column, start: str, end: str) -> Column:
    return day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def calendar_key(day: Column, start: str, end: str) -> Column:
    """Date key, or null when the day lies outside the calendar."""
    return F.when(in_calendar(day, start, end), date_key(day))


def loan_discard(start: str, end: str) -> Column:
    """Why a valid loan stays out of ``fact_credito``; null when it enters."""
    keys = ("cliente_sk", "producto_sk", "canal_sk", "estado_credito_sk")
    return (F.when(~in_calendar(F.col("fecha_solicitud"), start, end), OUT_OF_CALENDAR)
            .when(F.greatest(*[F.col(k).isNull() for k in keys]), NO_KEY))


def payment_discard(start: str, end: str) -> Column:
    keys = ("cliente_sk", "metodo_pago_sk")
    return (F.when(~in_calendar(F.col("fecha_pago"), start, end), OUT_OF_CALENDAR)
            .when(F.greatest(*[F.col(k).isNull() for k in keys]), NO_KEY))


def days_in_arrears(state: Column, due: Column, cutoff: Column) -> Column:
    """Days from due date to cutoff for loans in arrears or overdue, never below 0."""
    late = state.isin("Mora", "Vencido") & due.isNotNull()
    return F.when(late, F.greatest(F.datediff(cutoff, due), F.lit(0))).otherwise(0)


def latest_date(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """One row with the latest date in the valid loans and payments, null when there is none.

    One partial maximum per task; rows are not shuffled.
    """
    loan_dates = ("fecha_desembolso", "fecha_vencimiento", "fecha_solicitud")
    of_loans = loans.agg(F.greatest(*[F.max(c) for c in loan_dates]).alias("d"))
    of_payments = payments.agg(F.max("fecha_pago").alias("d"))
    return of_loans.unionByName(of_payments).agg(F.max("d").alias("fecha_corte"))


def fact_credito(loans: DataFrame, cutoff: date, start: str, end: str) -> DataFrame:
    """Loan fact from loans that already carry their keys."""
    return loans.select(
        "fact_credito_sk", "credito_id", "cliente_sk", "producto_sk", "canal_sk",
        "estado_credito_sk",
        date_key(F.col("fecha_solicitud")).alias("tiempo_solicitud_sk"),
        calendar_key(F.col("fecha_desembolso"), start, end).alias("tiempo_desembolso_sk"),
        calendar_key(F.col("fecha_vencimiento"), start, end).alias("tiempo_vencimiento_sk"),
        F.col("monto_aprobado").cast("decimal(18,2)").alias("monto_aprobado"),
        F.col("plazo_meses").cast("int").alias("plazo_meses"),
        F.col("tasa_interes_mensual").cast("decimal(8,4)").alias("tasa_interes_mensual"),
        days_in_arrears(F.col("estado_credito"), F.col("fecha_vencimiento"),
                        F.lit(cutoff)).alias("dias_mora"))


def fact_pago(payments: DataFrame) -> DataFrame:
    return payments.select(
        "fact_pago_sk", "pago_id", "credito_id", "cliente_sk", "metodo_pago_sk",
        date_key(F.col("fecha_pago")).alias("tiempo_pago_sk"),
        F.col("monto_pago").cast("decimal(18,2)").alias("monto_pago"),
        "estado_pago", "referencia_transaccion", "flag_referencia_duplicada")


def by_period(name: str, facts: DataFrame) -> DataFrame:
    """A fact with the periods it is stored by as last columns, its rows dealt by them.

    Rows are dealt when their sizes are known: periods with many rows to several tasks, small ones
    together.
    """
    periods = {p: of(F.col(key)) for p, (key, of) in PERIODS[name].items()}
    return facts.withColumns(periods).hint("rebalance", *periods)


def date_periods(key: str, columns: list[str]) -> dict[str, Column]:
    """Periods among a fact's ``columns`` that follow from its date key, as columns of the calendar."""
    return {p: of(F.col("tiempo_sk")) for fact in PERIODS.values()
            for p, (of_key, of) in fact.items() if of_key == key and p in columns}
