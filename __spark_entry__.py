"""Entry points: the flagship query, every registered query, and the SQL each is checked against."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from creditmart.model import CLIENTES, CREDITOS, ENTITIES, PAGOS
from creditmart.operators import calendar, constraints, quality, star
from creditmart.operators.cleanse import cleanse
from creditmart.plans import audit, marts, measures, pipeline
from creditmart.plans import queries as reference
from creditmart.plans.warehouse import Warehouse
from creditmart.sources import csv_source, fixtures
from creditmart.sources.tables import Scratch, TableStore, scratch_root, storing

try:        # the library is whole without the training-data operators
    import corpus_pipeline
    from creditmart.llm import queries as llm
except ImportError:
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    LLM_SQL = {**llm.ORACLE_SQL,
               **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}

_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over ``sf_dir``, kept for the life of the Spark application.

    Queries read stored layers, as they would after a load; a layer is built when first needed.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(spark, fixtures.Landed(spark, sf_dir),
                                     start=fixtures.START, end=fixtures.END)
    return _WAREHOUSES[key]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as double, so results compare across engines."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])


# --- Queries that need more than one call -------------------------------------------------

def write_sources(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The raw entities as CSV folders whose file order is the load order; files of one range each, compressed."""
    folder = f"{scratch_root(spark)}/csv-{uuid.uuid4().hex}"
    paths = {}
    for name, df in fixtures.raw_entities(spark, sf_dir, in_order=True).items():
        paths[name] = f"{folder}/{name}"
        with storing(spark):
            (df.select(*ENTITIES[name].columns)
             .write.option("header", True).option("escape", '"').option("compression", "gzip")
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .csv(paths[name]))
    return paths


def _raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    frames = []
    for name, df in csv_source.extract(spark, write_sources(spark, sf_dir)).items():
        landed = csv_source.land(df, f"{scratch.path}/raw_{name}", scratch).df
        frames.append(landed.select(
            F.lit(name).alias("entidad"), F.col("_raw_id").alias("fila"),
            F.md5(F.concat_ws("|", *ENTITIES[name].columns)).alias("huella")))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _run(spark: SparkSession, sf_dir: str) -> tuple[TableStore, pipeline.RunResult]:
    store = TableStore(spark, f"{scratch_root(spark)}/layers-{uuid.uuid4().hex}")
    result = pipeline.run(spark, write_sources(spark, sf_dir), store.root,
                          start=fixtures.START, end=fixtures.END)
    return store, result


def _pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _run(spark, sf_dir)
    return audit.Ledger(store).runs().select("status", *audit.COUNTS)


def _stored_marts(spark: SparkSession, sf_dir: str) -> TableStore:
    """The star of the warehouse published to a fresh root, with its marts refreshed."""
    store = TableStore(spark, f"{scratch_root(spark)}/layers-{uuid.uuid4().hex}")
    dw = warehouse(spark, sf_dir)
    pipeline.load_star(store, dw)
    store.publish(dw.run_id, "dwh", "dq")
    pipeline.refresh_marts(store)
    return store


def _mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_marts(spark, sf_dir).read("bi", "vw_cosecha_morosidad")


def _pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline.create_views(_stored_marts(spark, sf_dir))
    return spark.table("vw_kpi_resumen_pbi")


def _errors(rule: str) -> Callable[[Warehouse], DataFrame]:
    return lambda dw: dw.errors_with_key().where(F.col("regla_id") == rule).select(
        "tabla_origen", "severidad", "motivo", F.col("_clave").alias("clave"))


def _flags(dw: Warehouse) -> DataFrame:
    frames = [dw.valid(n).select(F.col(e.key).alias("clave"), F.lit(flag).alias("bandera"),
                                 F.col(flag).alias("valor"))
              for n, e in ENTITIES.items() for flag in e.flags]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _cleansed(name: str) -> Callable[[Warehouse], DataFrame]:
    entity = ENTITIES[name]
    return lambda dw: dw.cleaned(name).select(*entity.columns, *entity.catalog_flags)


def _staged(name: str) -> Callable[[Warehouse], DataFrame]:
    entity = ENTITIES[name]
    return lambda dw: dw.staging(name).select(*entity.columns, *entity.flags)


def _calendar_use(dw: Warehouse) -> DataFrame:
    """The calendar with the loans asked for on each day."""
    asked = (dw.fact_credito.groupBy(F.col("tiempo_solicitud_sk").alias("tiempo_sk"))
             .agg(F.count(F.lit(1)).alias("num_creditos")))
    return dw.dim_tiempo.join(asked, "tiempo_sk", "left").fillna(0, ["num_creditos"])


def _holiday_use(dw: Warehouse) -> DataFrame:
    """Holidays with the payments made on each."""
    from creditmart.functions.dates import date_key
    days = calendar.holidays(dw.spark, int(dw.start[:4]), int(dw.end[:4])).withColumn(
        "tiempo_pago_sk", date_key(F.col("fecha")))
    paid = dw.fact_pago.groupBy("tiempo_pago_sk").agg(F.count(F.lit(1)).alias("num_pagos"))
    return (days.join(paid, "tiempo_pago_sk", "left").fillna(0, ["num_pagos"])
            .select("anio", "fecha", "num_pagos"))


def _seed_use(dw: Warehouse) -> DataFrame:
    """Seed rows with the facts that use each."""
    def use(name: str, dim: DataFrame, fact: DataFrame, key: str, detail) -> DataFrame:
        used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("num_hechos"))
        return dim.join(used, key, "left").select(
            F.lit(name).alias("dimension"), F.col(key).alias("sk"),
            F.col(dim.columns[1]).alias("id"), "nombre", detail.alias("detalle"),
            F.coalesce("num_hechos", F.lit(0)).alias("num_hechos"))

    none = F.lit("")
    state = F.concat_ws("/", *[F.col(c).cast("string") for c in ("es_activo", "es_mora",
                                                                 "es_terminado")])
    return (use("producto", dw.dim_producto, dw.fact_credito, "producto_sk", none)
            .unionByName(use("canal", dw.dim_canal, dw.fact_credito, "canal_sk", none))
            .unionByName(use("estado_credito", dw.dim_estado_credito, dw.fact_credito,
                             "estado_credito_sk", state))
            .unionByName(use("metodo_pago", dw.dim_metodo_pago, dw.fact_pago, "metodo_pago_sk",
                             F.col("tipo"))))


def _fact_credito(dw: Warehouse) -> DataFrame:
    facts = marts.with_state(dw, marts.with_channel(dw, marts.with_product(dw, dw.fact_credito)))
    return facts.select("credito_id", "cliente_sk", "producto", "canal", "estado",
                        "tiempo_solicitud_sk", "tiempo_desembolso_sk", "tiempo_vencimiento_sk",
                        "monto_aprobado", "plazo_meses", "tasa_interes_mensual", "dias_mora")


def _fact_pago(dw: Warehouse) -> DataFrame:
    return marts.with_method(dw, dw.fact_pago).drop(
        "fact_pago_sk", "metodo_pago_sk", "tipo", *star.PERIODS["fact_pago"])


def _key_sequences(dw: Warehouse) -> DataFrame:
    """Surrogate keys run from 1 to the row count without gaps."""
    def span(table: str, key: str) -> DataFrame:
        return getattr(dw, table).agg(
            F.count(F.lit(1)).alias("filas"), F.min(key).alias("primera"),
            F.max(key).alias("ultima"), F.count_distinct(key).alias("distintas"),
        ).select(F.lit(table).alias("tabla"), "*")

    return (span("fact_credito", "fact_credito_sk").unionByName(span("fact_pago", "fact_pago_sk"))
            .unionByName(span("dim_cliente", "cliente_sk")))


def _key_order(dw: Warehouse) -> DataFrame:
    """Every fact with its key, which counts rows in load order."""
    return (dw.fact_credito.select(F.lit("fact_credito").alias("tabla"), F.col("credito_id").alias("clave"),
                                   F.col("fact_credito_sk").alias("sk"))
            .unionByName(dw.fact_pago.select(F.lit("fact_pago").alias("tabla"),
                                             F.col("pago_id").alias("clave"),
                                             F.col("fact_pago_sk").alias("sk"))))


def _extreme_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-4 on the mapped loans and payments with amounts, terms and rates far out."""
    raw = fixtures.raw_entities(spark, sf_dir)
    loans = raw["creditos"].withColumns({"monto_aprobado": F.expr(fixtures.EXTREME_AMOUNT.format("credito_id", 3)),
                                         "plazo_meses": F.expr(fixtures.EXTREME_TERM.format("credito_id", 3)),
                                         "tasa_interes_mensual": F.expr(fixtures.EXTREME_RATE.format("credito_id", 3))})
    paid = raw["pagos"].withColumn("monto_pago", F.expr(fixtures.EXTREME_AMOUNT.format("credito_id", 3)))
    # A filter on the rule would be pushed below the verdict, and work out every value again for each
    # of its uses. Rows of other rules give an empty place here instead.
    motives = F.when(F.col(quality.RULE) == "DQ-4", F.col(quality.MOTIVES))
    frames = [quality.judge(cleanse(e, df), quality.row_checks(e)).select(
        F.col(e.key).alias("clave"), F.explode_outer(motives).alias("motivo")).where(F.col("motivo").isNotNull())
        for e, df in ((CREDITOS, loans), (PAGOS, paid))]
    return frames[0].unionByName(frames[1])


PAYLOAD_FIELDS = {"clientes": ("cliente_id", "fecha_registro", "estado_cliente"),
                  "creditos": ("credito_id", "fecha_desembolso", "estado_credito"),
                  "pagos": ("pago_id", "fecha_pago", "estado_pago")}


def _payloads(dw: Warehouse) -> DataFrame:
    """Fields of the logged rows, as typed and as the source had them; null where JSON has null."""
    def of(name: str, key: str, day: str, state: str) -> DataFrame:
        errors = dw.errors_with_key().where(F.col("tabla_origen") == ENTITIES[name].raw_table)
        body = F.from_json("payload_original", f"{key} string, {day} string, {state} string, "
                                               f"_texto_original struct<{day}: string, {state}: string>")
        read = errors.select("regla_id", "tabla_origen", "motivo", body.alias("_p"))     # each body is read once
        return read.select(
            "regla_id", "tabla_origen", "motivo", F.col(f"_p.{key}").alias("clave"),
            F.col(f"_p.{day}").alias("fecha"), F.col(f"_p._texto_original.{day}").alias("fecha_original"),
            F.col(f"_p.{state}").alias("estado"), F.col(f"_p._texto_original.{state}").alias("estado_original"))

    frames = [of(name, *fields) for name, fields in PAYLOAD_FIELDS.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


_PUBLISHED: dict[tuple[str, str], TableStore] = {}


def _published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables with declared constraints, as a load leaves them."""
    key, dw = (spark.sparkContext.applicationId, sf_dir), warehouse(spark, sf_dir)
    if key not in _PUBLISHED:
        store, now = TableStore(spark, f"{scratch_root(spark)}/layers-{uuid.uuid4().hex}"), datetime.now(timezone.utc)
        ledger = audit.Ledger(store)
        ledger.start(dw.run_id, now)
        counts = pipeline.load_errors(store, dw) | pipeline.load_staging(store, dw) | pipeline.load_star(store, dw)
        store.publish(dw.run_id, "stg", "dwh", "dq")
        ledger.succeed(dw.run_id, now, now, counts)
        _PUBLISHED[key] = store
    store = _PUBLISHED[key]
    star_tables = pipeline.PublishedStar(store)
    return {**{e.staging_table: store.read("stg", e.staging_table) for e in ENTITIES.values()},
            **{name: getattr(star_tables, name) for name in Warehouse.STAR},
            "dq_errors": store.history("dq", "dq_errors", pipeline.ERROR_LOG_SCHEMA),
            "etl_runs": audit.Ledger(store).runs()}


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.audit(_published(spark, sf_dir))


def _audited_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same audit over rows no rule has filtered, and loans of customers that do not exist."""
    dw, tables = warehouse(spark, sf_dir), _published(spark, sf_dir)
    flags = {"clientes": CLIENTES.flags, "creditos": [], "pagos": PAGOS.flags}
    dirty = {ENTITIES[n].staging_table: dw.cleaned(n).withColumns({f: F.lit(False) for f in flags[n]})
             for n in ENTITIES}
    loans = tables["fact_credito"].withColumn("cliente_sk", F.col("cliente_sk") * 2)
    return constraints.audit({**dirty, **{n: tables[n] for n in Warehouse.STAR if n.startswith("dim")},
                              "fact_credito": loans}).where(
        F.col("tabla").isin(*dirty, "fact_credito"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.current_state(fixtures.ledger_events(spark, sf_dir))


def _run_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error history of two loads, of which the report covers the latest only."""
    start = F.lit("2025-01-01 00:00:00").cast("timestamp")
    loads = F.array(*[F.struct(F.lit(run_id).alias("run_id"), F.lit(later).alias("espera"))
                      for run_id, later in (("R12", 0), ("R13", 3600))])
    history = (warehouse(spark, sf_dir).errors().drop("run_id")
               .select("*", F.inline(loads))
               .withColumn("created_at", F.timestamp_add(
                   "SECOND", F.length("motivo") + F.col("espera"), start)))
    return audit.errors_of_latest_run(history, _runs(spark, sf_dir))


ALL_MEASURES = list(measures.MEASURES)
LOAN_MEASURES = [n for n, m in measures.MEASURES.items() if m.fact == measures.LOANS]


def _city_measures(dw: Warehouse) -> DataFrame:
    return measures.measures(dw, ["ticket_promedio", "tasa_aprobacion_pct"],
                             by=["ciudad", "producto"], where=F.col("canal") == "Web",
                             where_columns=["canal"])


ON_WAREHOUSE: dict[str, Callable[[Warehouse], DataFrame]] = {
    "cleanse_clientes": _cleansed("clientes"),
    "cleanse_creditos": _cleansed("creditos"),
    "cleanse_pagos": _cleansed("pagos"),
    "dq1_duplicates": _errors("DQ-1"),
    "dq2_orphans": _errors("DQ-2"),
    "dq3_catalog": _errors("DQ-3"),
    "dq4_domain": _errors("DQ-4"),
    "dq5_dates": _errors("DQ-5"),
    "dq6_not_null": _errors("DQ-6"),
    "dq7_flags": _flags,
    "dq_errors_detail": lambda dw: dw.errors_with_key().select(
        "regla_id", "tabla_origen", "severidad", "motivo", F.col("_clave").alias("clave")),
    "dq_error_summary": lambda dw: audit.error_summary(dw.errors()),
    "valid_clientes": _staged("clientes"),
    "valid_creditos": _staged("creditos"),
    "valid_pagos": _staged("pagos"),
    "dim_tiempo": _calendar_use,
    "holidays": _holiday_use,
    "dim_seeds": _seed_use,
    "dim_cliente": lambda dw: dw.dim_cliente,
    "fact_credito": _fact_credito,
    "fact_pago": _fact_pago,
    "fact_key_sequences": _key_sequences,
    "fact_key_order": _key_order,
    "dq_error_payload": _payloads,
    "star_discards": lambda dw: dw.discards(),
    "cutoff_date": lambda dw: star.latest_date(dw.valid("creditos"), dw.valid("pagos")),
    "cartera_vigente": marts.cartera_vigente,
    "morosidad_producto": marts.morosidad_por_producto,
    "efectividad_canal": marts.efectividad_canal,
    "pagos_mensuales": marts.pagos_diarios,
    "cosecha_morosidad": marts.cosecha_morosidad,
    "kpi_resumen": marts.kpi_resumen,
    "cliente_safe": marts.cliente_safe,
    "q1_cartera_segmento_producto": reference.cartera_segmento_producto,
    "q2_top_clientes": reference.top_clientes,
    "q3_desembolsos_mensuales": lambda dw: reference.desembolsos_mensuales(dw, (1996, 1997)),
    "q4_deterioro_producto_canal": reference.deterioro_producto_canal,
    "q5_recaudo_metodo": reference.recaudo_por_metodo,
    "q6_clientes_multiples": reference.clientes_multiples_creditos,
    "q7_cosecha": lambda dw: reference.cosecha(marts.cosecha_morosidad(dw)),
    "measures_total": lambda dw: measures.measures(dw, ALL_MEASURES),
    "measures_by_segment": lambda dw: measures.measures(dw, ALL_MEASURES, by=["segmento"]),
    "measures_by_city_active": _city_measures,
    "measures_by_income_band": lambda dw: measures.measures(dw, ALL_MEASURES, by=["rango_ingresos"]),
    "measures_by_state": lambda dw: measures.measures(dw, LOAN_MEASURES, by=["estado_credito"]),
    "measures_by_payment_state": lambda dw: measures.measures(
        dw, ["recaudo_total", "tasa_fallo_pago_pct"], by=["estado_pago"]),
    "measures_filtered_state": lambda dw: measures.measures(
        dw, LOAN_MEASURES, by=["producto"], filters={
            "estado_credito": F.col("estado_credito").isin("Mora", "Vencido", "Rechazado"),
            "es_mora": ~F.col("es_mora"), "canal": F.col("canal") != "App"}),
    "measures_time_rollup": lambda dw: measures.drill_down(dw, ALL_MEASURES),
}

ON_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_roundtrip": _raw_roundtrip,
    "constraint_audit": _audited,
    "constraint_audit_dirty": _audited_dirty,
    "run_health": lambda spark, sf: audit.run_health(_runs(spark, sf)),
    "ledger_rerun": lambda spark, sf: audit.current_state(fixtures.rerun_events(spark, sf)).select(
        "run_id", "started_at", "status", "filas_raw_creditos", "error_message"),
    "dq4_extreme": _extreme_domain,
    "latest_run": lambda spark, sf: audit.latest_run(_runs(spark, sf)),
    "run_errors": _run_errors,
    "pipeline_run": _pipeline_run,
    "mart_refresh": _mart_refresh,
    "pass_through_views": _pass_through,
}


def _registered(build: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(build(warehouse(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Active portfolio by segment and product on the smallest tables."""
    return queries()["cartera_vigente"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    tables = {name: (lambda spark, sf, build=build: _plain(build(spark, sf)))
              for name, build in ON_TABLES.items()}
    return {**{name: _registered(build) for name, build in ON_WAREHOUSE.items()}, **tables,
            **LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**oracle.SQL, **LLM_SQL}
