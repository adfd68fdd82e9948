"""BI marts over a star.

``dw`` is anything with the star tables as attributes: a ``Warehouse`` being built, or a
published star. Facts are first reduced to one row per combination of keys, where partial
aggregation absorbs any hot key; only that is joined with a dimension. Seeds and the calendar
have a fixed number of rows and are broadcast; the customer dimension never is by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.functions import masking
from creditmart.functions.numeric import count_when, mean, percentage, rounded_mean, sum_when
from creditmart.operators.star import date_periods

AMOUNT = "monto_aprobado"


def active() -> Column:
    return F.col("es_activo")


def arrears() -> Column:
    return F.col("es_mora")


def approved() -> Column:
    return F.col("estado") != "Rechazado"


def overdue() -> Column:
    return F.col("estado") == "Vencido"


def total_when(condition: Column, amount: str) -> Column:
    """Sum over the rows that meet the condition, 0 when there are none."""
    return F.coalesce(sum_when(condition, F.col(amount)), F.lit(0).cast("decimal(18,2)"))


def with_state(dw, facts: DataFrame) -> DataFrame:
    states = dw.dim_estado_credito.select("estado_credito_sk", F.col("nombre").alias("estado"),
                                          "es_activo", "es_mora", "es_terminado")
    return facts.join(F.broadcast(states), "estado_credito_sk")


def with_product(dw, facts: DataFrame) -> DataFrame:
    return facts.join(F.broadcast(dw.dim_producto.select(
        "producto_sk", F.col("nombre").alias("producto"))), "producto_sk")


def with_channel(dw, facts: DataFrame) -> DataFrame:
    return facts.join(F.broadcast(dw.dim_canal.select(
        "canal_sk", F.col("nombre").alias("canal"))), "canal_sk")


def with_method(dw, facts: DataFrame) -> DataFrame:
    return facts.join(F.broadcast(dw.dim_metodo_pago.select(
        "metodo_pago_sk", F.col("nombre").alias("metodo_pago"), "tipo")), "metodo_pago_sk")


def with_calendar(dw, facts: DataFrame, key: str, *columns: str) -> DataFrame:
    """Facts with columns of the day under ``key``.

    The periods that a fact is stored by are joined too, so that a filter on the calendar reaches
    its folders.
    """
    periods = date_periods(key, facts.columns)
    days = dw.dim_tiempo.select(F.col("tiempo_sk").alias(key), *columns,
                                *[value.alias(p) for p, value in periods.items()])
    return facts.join(F.broadcast(days), [key, *periods])  # one row per day of the calendar


def by_segment_and_product(dw, loans: DataFrame) -> DataFrame:
    """Counts and sums per segment and product, summed per customer before the customer join."""
    per_customer = loans.groupBy("cliente_sk", "producto_sk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("monto_aprobado").alias("monto"),
        F.sum("tasa_interes_mensual").alias("tasa"), F.count("tasa_interes_mensual").alias("n_tasa"),
        F.sum("plazo_meses").alias("plazo"))
    segments = dw.dim_cliente.select("cliente_sk", "segmento")
    return (with_product(dw, per_customer.join(segments, "cliente_sk"))
            .groupBy("segmento", "producto")
            .agg(*[F.sum(c).alias(c) for c in ("n", "monto", "tasa", "n_tasa", "plazo")]))


def cartera_vigente(dw) -> DataFrame:
    """Active portfolio by segment and product."""
    return by_segment_and_product(dw, with_state(dw, dw.fact_credito).where(active())).select(
        "segmento", "producto", F.col("n").alias("num_creditos"), F.col("monto").alias("monto_total"),
        mean(F.col("tasa"), F.col("n_tasa")).alias("tasa_promedio"),
        mean(F.col("plazo"), F.col("n")).alias("plazo_promedio_meses"))


def morosidad_por_producto(dw) -> DataFrame:
    """Arrears by product."""
    n, late = F.count(F.lit(1)), count_when(arrears())
    return (with_product(dw, with_state(dw, dw.fact_credito)).groupBy("producto")
            .agg(n.alias("total_creditos"), late.alias("creditos_mora"),
                 count_when(overdue()).alias("creditos_vencidos"),
                 percentage(late, n).alias("tasa_mora_pct"),
                 mean(sum_when(arrears(), F.col("dias_mora")), late).alias("dias_mora_promedio")))


def efectividad_canal(dw) -> DataFrame:
    """Approval by channel."""
    n, accepted = F.count(F.lit(1)), count_when(approved())
    return (with_channel(dw, with_state(dw, dw.fact_credito)).groupBy("canal")
            .agg(n.alias("total_solicitudes"), accepted.alias("aprobados"),
                 percentage(accepted, n).alias("tasa_aprobacion_pct"),
                 mean(sum_when(approved(), F.col(AMOUNT)), accepted).alias("ticket_promedio_aprobado")))


def pagos_diarios(dw) -> DataFrame:
    """Collections by month. The average covers payments in every state."""
    state = F.col("estado_pago")
    n, failed = F.count(F.lit(1)), count_when(state == "Fallido")
    return (with_calendar(dw, dw.fact_pago, "tiempo_pago_sk", "anio", "mes", "nombre_mes")
            .groupBy("anio", "mes", "nombre_mes")
            .agg(n.alias("total_transacciones"),
                 total_when(state == "Exitoso", "monto_pago").alias("monto_recaudado"),
                 failed.alias("pagos_fallidos"),
                 count_when(state == "Reversado").alias("pagos_reversados"),
                 percentage(failed, n).alias("tasa_fallo_pct"),
                 mean(F.sum("monto_pago"), n).alias("monto_promedio_transaccion"))
            .orderBy("anio", "mes"))


def cosecha_morosidad(dw) -> DataFrame:
    """Vintages: loans by month of disbursement and product. Loans without one are left out."""
    n, worse = F.count(F.lit(1)), count_when(arrears() | overdue())
    facts = with_calendar(dw, with_state(dw, dw.fact_credito), "tiempo_desembolso_sk", "anio", "mes")
    return (with_product(dw, facts)
            .groupBy(F.col("anio").alias("anio_cosecha"), F.col("mes").alias("mes_cosecha"),
                     "producto")
            .agg(n.alias("total_creditos"), worse.alias("creditos_deteriorados"),
                 percentage(worse, n).alias("tasa_deterioro_pct"),
                 mean(F.sum(AMOUNT), n).alias("monto_promedio"))
            .orderBy("anio_cosecha", "mes_cosecha", "producto"))


def kpi_resumen(dw) -> DataFrame:
    """One row with the seven headline figures, from one pass over each fact."""
    n, accepted = F.count(F.lit(1)), count_when(approved())
    loans = with_state(dw, dw.fact_credito).agg(
        count_when(active()).alias("cartera_activa_count"),
        total_when(active(), AMOUNT).alias("cartera_vigente_monto"),
        percentage(count_when(arrears()), n).alias("tasa_mora_pct"),
        rounded_mean(sum_when(approved(), F.col(AMOUNT)), accepted, 2, 0).alias("ticket_promedio"),
        percentage(accepted, n).alias("tasa_aprobacion_pct"))
    state = F.col("estado_pago")
    payments = dw.fact_pago.agg(
        total_when(state == "Exitoso", "monto_pago").alias("recaudo_total"),
        percentage(count_when(state == "Fallido"), n).alias("tasa_fallo_pago_pct"))
    both = loans.unionByName(payments, allowMissingColumns=True)       # two rows into one
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(F.lit(1).alias("id"), "*")


def cliente_safe(dw) -> DataFrame:
    """Customers with personal data masked, no birth date, and income as a band."""
    text: dict[str, Column] = {c: F.col(c) for c in dw.dim_cliente.columns}
    return dw.dim_cliente.select(
        "cliente_sk", "cliente_id", "tipo_documento",
        masking.mask_document(text["numero_documento"]).alias("numero_documento"),
        masking.display_name(text["nombres"], text["apellidos"]).alias("nombre_display"),
        masking.mask_email(text["email"]).alias("email"),
        masking.mask_phone(text["telefono"]).alias("telefono"),
        "fecha_registro", "estado_cliente", "ciudad", "segmento",
        masking.income_band(text["ingresos_mensuales"]).alias("rango_ingresos"),
        "flag_email_duplicado", "flag_doc_duplicado")


MARTS = {
    "vw_cartera_vigente": cartera_vigente,
    "vw_morosidad_por_producto": morosidad_por_producto,
    "vw_efectividad_canal": efectividad_canal,
    "vw_pagos_diarios": pagos_diarios,
    "vw_cosecha_morosidad": cosecha_morosidad,
    "vw_kpi_resumen": kpi_resumen,
    "vw_cliente_safe": cliente_safe,
}
MATERIALIZED = ("vw_cosecha_morosidad", "vw_kpi_resumen")
PASS_THROUGH = {"vw_kpi_resumen_pbi": "vw_kpi_resumen",
                "vw_cosecha_morosidad_pbi": "vw_cosecha_morosidad"}
