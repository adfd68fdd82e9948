"""Calendar dimension with Colombian holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.functions.dates import date_key, easter_sunday, monday_on_or_after
from creditmart.model import CALENDARIO_DESDE, CALENDARIO_HASTA, DIAS, MESES

# Fixed values: (month, day) of holidays kept on their date, and of those moved to a Monday;
# then days after Easter kept, and moved to a Monday.
FIXED = [(1, 1), (5, 1), (7, 20), (8, 7), (12, 8), (12, 25)]
MOVED = [(1, 6), (3, 19), (6, 29), (8, 15), (10, 12), (11, 1), (11, 11)]
EASTER_FIXED = [-3, -2]
EASTER_MOVED = [39, 60, 68]


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per holiday date (``anio``, ``fecha``)."""
    year = F.col("anio")

    def on(month: int, day: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day))

    easter = F.col("_pascua")
    days = ([on(m, d) for m, d in FIXED]
            + [monday_on_or_after(on(m, d)) for m, d in MOVED]
            + [F.date_add(easter, n) for n in EASTER_FIXED]
            + [monday_on_or_after(F.date_add(easter, n)) for n in EASTER_MOVED])
    return (spark.range(first_year, last_year + 1, numPartitions=1)
            .select(F.col("id").cast("int").alias("anio"))
            .withColumn("_pascua", easter_sunday(year))
            .select("anio", F.explode(F.array(*days)).alias("fecha"))
            .distinct())


def dim_tiempo(spark: SparkSession, start: str = CALENDARIO_DESDE,
               end: str = CALENDARIO_HASTA) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    day = F.col("fecha")
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    days = (spark.range(1, numPartitions=1).select(F.explode(span).alias("fecha")))
    free = (holidays(spark, int(start[:4]), int(end[:4]))
            .select("fecha", F.lit(True).alias("_festivo")))
    names = F.array(*[F.lit(m) for m in MESES])
    weekdays = F.array(*[F.lit(d) for d in DIAS])
    return (days.join(F.broadcast(free), "fecha", "left")       # 18 rows per year
            .select(
                date_key(day).alias("tiempo_sk"), "fecha",
                F.year(day).cast("smallint").alias("anio"),
                F.month(day).cast("smallint").alias("mes"),
                F.dayofmonth(day).cast("smallint").alias("dia"),
                F.quarter(day).cast("smallint").alias("trimestre"),
                F.weekofyear(day).cast("smallint").alias("semana_anio"),
                F.element_at(names, F.month(day)).alias("nombre_mes"),
                F.element_at(weekdays, F.weekday(day) + 1).alias("nombre_dia"),
                (F.weekday(day) >= 5).alias("es_fin_semana"),
                F.coalesce("_festivo", F.lit(False)).alias("es_festivo_co")))
