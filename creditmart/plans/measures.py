"""Semantic model: measures that can be asked for by any legal slice and filter.

Every measure is a ratio or sum of additive parts. ``measures`` computes the parts once per
fact at the grain of keys, joins only the dimensions the slice needs, and adds them up.

A measure's own filter replaces a slice on the column it filters: approved loans by loan state are
all approved loans in every row, as there is one filter on that column at a time. The same goes for
``filters``, which name the column each of them is on: a part of a measure drops the one on the column
that it filters itself. Filters on other columns of the same dimension, and ``where``, stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.operators.star import date_periods
from creditmart.plans.marts import cliente_safe

LOANS, PAYMENTS = "fact_credito", "fact_pago"
HIERARCHY = ("anio", "trimestre", "mes", "dia")


@dataclass(frozen=True)
class Relation:
    """Many-to-one relation from a fact to a dimension."""

    dimension: str
    fact_key: str
    dim_key: str
    small: bool                       # fixed row count, so broadcast is safe
    columns: dict[str, str]           # name in a slice -> dimension column


_CALENDAR = {c: c for c in (*HIERARCHY, "fecha", "semana_anio", "nombre_mes", "nombre_dia",
                            "es_fin_semana", "es_festivo_co")}
# Customers as the masked view shows them.
_CUSTOMER = {c: c for c in ("cliente_id", "tipo_documento", "numero_documento", "nombre_display", "email",
                            "telefono", "fecha_registro", "estado_cliente", "ciudad", "segmento",
                            "rango_ingresos", "flag_email_duplicado", "flag_doc_duplicado")}
_STATE = {"estado_id": "estado_id", "estado_credito": "nombre", "es_activo": "es_activo", "es_mora": "es_mora",
          "es_terminado": "es_terminado"}

RELATIONS = {
    LOANS: (
        Relation("dim_cliente", "cliente_sk", "cliente_sk", False, _CUSTOMER),
        Relation("dim_producto", "producto_sk", "producto_sk", True,
                 {"producto_id": "producto_id", "producto": "nombre"}),
        Relation("dim_canal", "canal_sk", "canal_sk", True,
                 {"canal_id": "canal_id", "canal": "nombre"}),
        Relation("dim_estado_credito", "estado_credito_sk", "estado_credito_sk", True, _STATE),
        Relation("dim_tiempo", "tiempo_solicitud_sk", "tiempo_sk", True, _CALENDAR),
    ),
    PAYMENTS: (
        Relation("dim_cliente", "cliente_sk", "cliente_sk", False, _CUSTOMER),
        Relation("dim_metodo_pago", "metodo_pago_sk", "metodo_pago_sk", True,
                 {"metodo_id": "metodo_id", "metodo_pago": "nombre", "tipo": "tipo"}),
        Relation("dim_tiempo", "tiempo_pago_sk", "tiempo_sk", True, _CALENDAR),
    ),
}

# Columns of the facts themselves that a slice may use.
FACT_COLUMNS = {
    LOANS: {"credito_id", "monto_aprobado", "plazo_meses", "tasa_interes_mensual", "dias_mora"},
    PAYMENTS: {"pago_id", "credito_id", "monto_pago", "estado_pago", "referencia_transaccion",
               "flag_referencia_duplicada"},
}

# The slice that a part's own filter replaces.
REPLACES = {"_n_activo": "es_activo", "_monto_activo": "es_activo", "_n_mora": "es_mora",
            "_dias_mora": "es_mora", "_n_aprobado": "estado_credito",
            "_monto_aprobado": "estado_credito", "_n_fallido": "estado_pago",
            "_monto_exitoso": "estado_pago"}

# Additive parts, as SQL over one fact row.
PARTS = {
    LOANS: {
        "_n": "1L",
        "_n_activo": "cast(_activo as long)",
        "_n_mora": "cast(_mora as long)",
        "_n_aprobado": "cast(_estado <> 'Rechazado' as long)",
        "_monto_activo": "case when _activo then monto_aprobado end",
        "_monto_aprobado": "case when _estado <> 'Rechazado' then monto_aprobado end",
        "_dias_mora": "case when _mora then cast(dias_mora as long) end",
    },
    PAYMENTS: {
        "_n_pago": "1L",
        "_n_fallido": "cast(estado_pago = 'Fallido' as long)",
        "_monto_exitoso": "case when estado_pago = 'Exitoso' then monto_pago end",
    },
}


@dataclass(frozen=True)
class Measure:
    fact: str
    parts: tuple[str, ...]
    value: str                # SQL over the summed parts


def _sum(fact: str, part: str) -> Measure:
    return Measure(fact, (part,), part)


def _mean(fact: str, total: str, count: str) -> Measure:
    return Measure(fact, (total, count), f"cast({total} as double) / nullif({count}, 0)")


def _rate(fact: str, part: str, whole: str) -> Measure:
    """Percentage that is 0, not null, when there is nothing to divide."""
    return Measure(fact, (part, whole), f"coalesce({part} * 100.0D / nullif({whole}, 0), 0.0D)")


MEASURES = {
    "cartera_vigente": _sum(LOANS, "_monto_activo"),
    "num_creditos_activos": Measure(LOANS, ("_n_activo",), "nullif(_n_activo, 0)"),
    "ticket_promedio": _mean(LOANS, "_monto_aprobado", "_n_aprobado"),
    "tasa_mora_pct": _rate(LOANS, "_n_mora", "_n"),
    "dias_mora_promedio": _mean(LOANS, "_dias_mora", "_n_mora"),
    "recaudo_total": _sum(PAYMENTS, "_monto_exitoso"),
    "tasa_fallo_pago_pct": _rate(PAYMENTS, "_n_fallido", "_n_pago"),
    "tasa_aprobacion_pct": _rate(LOANS, "_n_aprobado", "_n"),
}


class IllegalSlice(ValueError):
    """The fact has no active relation to a requested column."""


def _needed(fact: str, columns: set[str]) -> list[Relation]:
    reachable = {c for r in RELATIONS[fact] for c in r.columns} | FACT_COLUMNS[fact]
    missing = sorted(columns - reachable)
    if missing:
        raise IllegalSlice(f"{fact} cannot be sliced by {missing}")
    return [r for r in RELATIONS[fact] if columns & r.columns.keys()]


def _attributes(dw, relation: Relation, columns: set[str],
                periods: dict[str, Column] | None = None) -> DataFrame:
    picked = [F.col(src).alias(name) for name, src in relation.columns.items() if name in columns]
    table = cliente_safe(dw) if relation.dimension == "dim_cliente" else getattr(dw, relation.dimension)
    dim = table.select(
        F.col(relation.dim_key).alias(relation.fact_key), *picked,
        *[value.alias(p) for p, value in (periods or {}).items()])
    return F.broadcast(dim) if relation.small else dim


def _within(filters: dict[str, Column], but: str | None = None) -> Column | None:
    """All ``filters`` together, save the one on the column ``but``; None where no other is left."""
    left = [f for c, f in filters.items() if c != but]
    return reduce(Column.__and__, left) if left else None


def _additive(dw, fact: str, parts: set[str], columns: set[str], where: Column | None,
              filters: dict[str, Column]) -> DataFrame:
    """Parts per combination of the fact's keys and small-dimension columns, then customers."""
    rows = getattr(dw, fact)
    if fact == LOANS:
        states = dw.dim_estado_credito.select(
            "estado_credito_sk", F.col("nombre").alias("_estado"), F.col("es_activo").alias("_activo"),
            F.col("es_mora").alias("_mora"))
        rows = rows.join(F.broadcast(states), "estado_credito_sk")
    relations = _needed(fact, columns)
    for relation in (r for r in relations if r.small):
        periods = date_periods(relation.fact_key, rows.columns)
        rows = rows.join(_attributes(dw, relation, columns, periods), [relation.fact_key, *periods])
    # Filters on columns that a part filters itself hold for the other parts only.
    replaced = {REPLACES.get(p) for p in parts}
    shared = {c: f for c, f in filters.items() if c not in replaced}
    own = {c: f for c, f in filters.items() if c in replaced}
    kept = {p: _within(own, REPLACES.get(p)) for p in parts}
    if own and all(k is not None for k in kept.values()):
        rows = rows.where(reduce(Column.__or__, kept.values()))
    values = {p: F.expr(PARTS[fact][p]) for p in parts}
    rows = rows.withColumns({p: v if kept[p] is None else F.when(kept[p], v) for p, v in values.items()})
    large = [r for r in relations if not r.small]
    keys = [c for r in relations if r.small for c in r.columns if c in columns]
    keys += sorted(columns & FACT_COLUMNS[fact])
    keys += [r.fact_key for r in large]
    if large:
        rows = rows.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in sorted(parts)])
    for relation in large:
        rows = rows.join(_attributes(dw, relation, columns), relation.fact_key)
    for condition in (where, _within(shared)):
        rows = rows if condition is None else rows.where(condition)
    return rows


def _by_fact(names: list[str]) -> dict[str, list[str]]:
    facts: dict[str, list[str]] = {}
    for name in names:
        facts.setdefault(MEASURES[name].fact, []).append(name)
    return facts


def measures(dw, names: list[str], by: list[str] = (), where: Column | None = None,
             where_columns: list[str] = (), drill: bool = False,
             filters: dict[str, Column] | None = None) -> DataFrame:
    """The named measures per combination of ``by``; filtered by ``where`` over slice columns.

    ``filters`` maps slice columns to predicates, of which a measure drops the one on its own column.
    A fact that cannot be sliced by such a column refuses it.

    ``drill=True`` adds the totals of each prefix of ``by``, with ``nivel`` telling how many
    trailing columns are rolled up. Measures of both facts may be mixed when both can be sliced
    that way; a slice present in one fact only still appears.
    """
    by = list(by)
    filters, level = dict(filters or {}), ["nivel"] if drill else []
    results = []
    for fact, wanted in _by_fact(list(names)).items():
        parts = {p for n in wanted for p in MEASURES[n].parts}
        rows = _additive(dw, fact, parts, set(by) | set(where_columns) | set(filters), where, filters)
        totals = [F.sum(p).alias(p) for p in sorted(parts)]
        finest = rows.groupBy(*by).agg(*totals)
        for part in sorted(p for p in parts if REPLACES.get(p) in by):
            if drill:
                raise ValueError(f"totals by {REPLACES[part]} would count {part} more than once")
            others = [c for c in by if c != REPLACES[part]]
            rest = [c for c in finest.columns if c not in others and c != part]
            # A row per value of the replaced column: states are few.
            finest = finest.groupBy(*others).agg(
                F.sum(part).alias(part), F.collect_list(F.struct(*rest)).alias("_filas")
            ).select(*others, part, F.inline("_filas"))
        shown = _within({c: f for c, f in filters.items() if c in by})
        if shown is not None:
            finest = finest.where(shown)
        if drill:       # roll up the finest level, not the rows: each level would copy them
            depth = F.bit_count(F.grouping_id()).cast("int").alias("nivel")
            finest = finest.rollup(*by).agg(depth, *totals)
        results.append(finest)
    keys = by + level
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    parts = [c for c in stacked.columns if c not in keys]
    merged = stacked.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in parts])
    return merged.select(*keys, *[F.expr(MEASURES[n].value).alias(n) for n in names])


def measure(dw, name: str, by: list[str] = (), where: Column | None = None,
            where_columns: list[str] = ()) -> DataFrame:
    return measures(dw, [name], by, where, where_columns)


def drill_down(dw, names: list[str]) -> DataFrame:
    """Measures along year, quarter, month and day, with all totals."""
    return measures(dw, names, HIERARCHY, drill=True)
