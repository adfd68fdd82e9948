"""Reference queries over a star. Ranked output ends in a business key, so it is repeatable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions.numeric import (count_when, percentage, rounded_mean, sum_when)
from creditmart.plans import marts
from creditmart.plans.marts import (AMOUNT, approved, arrears, overdue, total_when, with_calendar,
                                    with_channel, with_method, with_product, with_state)

CLOSED = ("Rechazado", "Cancelado", "Pagado")


def _full_name():
    return F.concat(F.col("nombres"), F.lit(" "), F.coalesce(F.col("apellidos"), F.lit("")))


def cartera_segmento_producto(dw) -> DataFrame:
    """Q1: portfolio by segment and product, rejected loans left out."""
    loans = with_state(dw, dw.fact_credito).where(approved())
    n = F.col("n")
    return (marts.by_segment_and_product(dw, loans)
            .select("segmento", "producto", n.alias("num_creditos"),
                    F.col("monto").alias("monto_total"),
                    rounded_mean(F.col("tasa"), F.col("n_tasa"), 4, 2).alias("tasa_promedio"),
                    rounded_mean(F.col("plazo"), n, 0, 1).alias("plazo_promedio"))
            .orderBy(F.desc("monto_total"), "segmento", "producto"))


def top_clientes(dw, limit: int = 10) -> DataFrame:
    """Q2: customers with the largest total. Ranked on keys; only the winners meet the dimension."""
    sums = (with_state(dw, dw.fact_credito).where(approved()).groupBy("cliente_sk")
            .agg(F.count(F.lit(1)).alias("num_creditos"),
                 F.sum(AMOUNT).alias("monto_total_desembolsado"),
                 rounded_mean(F.sum("tasa_interes_mensual"), F.count("tasa_interes_mensual"), 4, 2)
                 .alias("tasa_promedio")))
    largest = sums.orderBy(F.desc("monto_total_desembolsado")).limit(limit).select(
        "monto_total_desembolsado").distinct()
    best = sums.join(F.broadcast(largest), "monto_total_desembolsado")   # ``limit`` rows; ties stay in
    return (dw.dim_cliente.join(best, "cliente_sk")
            .orderBy(F.desc("monto_total_desembolsado"), "cliente_id").limit(limit)
            .select("cliente_id", _full_name().alias("nombre_cliente"), "ciudad", "segmento",
                    "num_creditos", "monto_total_desembolsado", "tasa_promedio"))


def desembolsos_mensuales(dw, years: tuple[int, ...] = (2024, 2025)) -> DataFrame:
    """Q3: disbursements by month of the given years."""
    loans = with_state(dw, dw.fact_credito).where(approved())
    n = F.count(F.lit(1))
    return (with_calendar(dw, loans, "tiempo_desembolso_sk", "anio", "mes", "nombre_mes")
            .where(F.col("anio").isin(*years))
            .groupBy("anio", "mes", "nombre_mes")
            .agg(n.alias("creditos_desembolsados"), F.sum(AMOUNT).alias("monto_total"),
                 rounded_mean(F.sum(AMOUNT), n, 2, 0).alias("ticket_promedio"))
            .orderBy("anio", "mes"))


def deterioro_producto_canal(dw) -> DataFrame:
    """Q4: arrears by product and channel."""
    n, late = F.count(F.lit(1)), count_when(arrears())
    days = rounded_mean(sum_when(arrears(), F.col("dias_mora")), late, 0, 0)
    return (with_channel(dw, with_product(dw, with_state(dw, dw.fact_credito)))
            .groupBy("producto", "canal")
            .agg(n.alias("total_creditos"), late.alias("en_mora"),
                 count_when(overdue()).alias("vencidos"),
                 percentage(count_when(arrears() | overdue()), n).alias("tasa_deterioro_pct"),
                 F.coalesce(days, F.lit(0).cast("decimal(20,0)")).alias("dias_mora_promedio"))
            .orderBy(F.desc("tasa_deterioro_pct"), "producto", "canal"))


def recaudo_por_metodo(dw) -> DataFrame:
    """Q5: collections by payment method."""
    state = F.col("estado_pago")

    def total(label: str):
        return total_when(state == label, "monto_pago")

    n = F.count(F.lit(1))
    return (with_method(dw, dw.fact_pago).groupBy("metodo_pago", "tipo")
            .agg(n.alias("total_transacciones"), total("Exitoso").alias("monto_exitoso"),
                 total("Fallido").alias("monto_fallido"),
                 total("Reversado").alias("monto_reversado"),
                 percentage(count_when(state == "Exitoso"), n).alias("tasa_exito_pct"))
            .orderBy(F.desc("monto_exitoso"), "metodo_pago"))


def clientes_multiples_creditos(dw) -> DataFrame:
    """Q6: customers with more than one open loan, by exposure."""
    exposed = (with_state(dw, dw.fact_credito).where(~F.col("estado").isin(*CLOSED))
               .groupBy("cliente_sk")
               .agg(F.count(F.lit(1)).alias("total_creditos_vigentes"),
                    F.sum(AMOUNT).alias("exposicion_total"),
                    total_when(arrears(), AMOUNT).alias("monto_en_mora"),
                    F.max("dias_mora").alias("max_dias_mora"))
               .where(F.col("total_creditos_vigentes") > 1))
    return (exposed.join(dw.dim_cliente, "cliente_sk")
            .orderBy(F.desc("exposicion_total"), "cliente_id")
            .select("cliente_id", _full_name().alias("nombre_cliente"), "segmento", "ciudad",
                    "total_creditos_vigentes", "exposicion_total", "monto_en_mora",
                    "max_dias_mora"))


def cosecha(mart: DataFrame) -> DataFrame:
    """Q7: listing of the vintage mart."""
    return (mart.withColumn("monto_promedio", F.round("monto_promedio", 0))
            .orderBy("anio_cosecha", "mes_cosecha", F.desc("tasa_deterioro_pct"), "producto")
            .select("anio_cosecha", "mes_cosecha", "producto", "total_creditos",
                    "creditos_deteriorados", "tasa_deterioro_pct", "monto_promedio"))
