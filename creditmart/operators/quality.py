"""Data-quality rules.

Rules run in sequence and a row leaves at the first one it fails, so each row has at most one
failing rule. That makes the verdict a property of the row: ``RULE`` (null when it passes),
``SEVERITY`` and ``MOTIVES``, the messages to log. Rules that need other rows contribute a
marker column first (first place of its key, parent found, value shared); all the rest are
plain predicates. Valid rows are a filter on the verdict and errors are an explode of it.

Rule ids, severities and the texts of motives are output, and so fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.functions.parsing import fits, float_text
from creditmart.functions.text import is_blank
from creditmart.model import (CANALES, CLIENTES, CREDITOS, ENTITIES, LINEAGE, METODOS_PAGO, ORDER,
                              PAGOS, PRODUCTOS, Entity)
from creditmart.operators.cleanse import SOURCE_TEXT, read_fields
from creditmart.operators.lookup import (DEFAULT_LIMITS, TIMES, JoinLimits, attach, attach_marked,
                                         frequent_keys, hot_keys, repeated_keys)
from creditmart.sources.tables import Scratch, Stored

RULE, SEVERITY, MOTIVES, PAYLOAD = "_regla", "_severidad", "_motivos", "_payload"
FIRST, LATER, PARENT = "_primero", "_posterior", "_padre"
ERROR_SCHEMA = ("run_id string, regla_id string, tabla_origen string, severidad string, "
                "motivo string, payload_original string")
ERROR_COLUMNS = [c.split()[0] for c in ERROR_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Check:
    """A predicate that isolates a row. Each motive is (applies, text); all that apply are logged.

    A predicate may be null, which counts as not failing wherever it stands in a ``when``.
    """

    rule: str
    severity: str
    motives: tuple[tuple[Column, Column], ...]

    @property
    def fails(self) -> Column:
        return reduce(lambda a, b: a | b, [c for c, _ in self.motives])


def _says(prefix: str, value: str, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.coalesce(F.col(value).cast("string"), F.lit("None")),
                    F.lit(suffix))


def _one(rule: str, severity: str, condition: Column, message: Column) -> Check:
    return Check(rule, severity, ((condition, message),))


def _unknown_state(column: str, flag: str, severity: str) -> Check:
    return _one("DQ-3", severity, ~F.col(flag), _says(f"{column} no reconocido: '", column, "'"))


def _outside(column: str, seeds: list[tuple]) -> Check:
    labels = [row[1].lower() for row in seeds]
    return _one("DQ-3", "ERROR", ~F.lower(F.col(column)).isin(labels),
                _says(f"{column} no reconocido: '", column, "'"))


def _blank(*columns: str) -> tuple[tuple[Column, Column], ...]:
    return tuple((is_blank(F.col(c)), F.lit(f"{c} nulo o vacío")) for c in columns)


def _amount_text(column: str) -> Column:
    return F.coalesce(float_text(F.col(column)), F.lit("nan"))


def _joined(rule: str, prefix: str, parts: list[tuple[Column, Column]]) -> Check:
    """Several conditions that share a single log line."""
    any_fails = reduce(lambda a, b: a | b, [c for c, _ in parts])
    text = F.concat(F.lit(prefix), F.concat_ws("; ", *[F.when(c, t) for c, t in parts]))
    return _one(rule, "ERROR", any_fails, text)


MOST_INT = (1 << 31) - 1        # what staging holds in a whole number


def _not_positive(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) <= 0)


def _no_amount(column: str) -> Column:
    """Not positive, or more than its staging type can hold."""
    return _not_positive(column) | ~fits(F.col(column), "decimal(18,2)")


def row_checks(entity: Entity) -> list[Check]:
    """DQ-3 to DQ-6 in the order they apply."""
    if entity is CLIENTES:
        return [
            _unknown_state("estado_cliente", "_estado_cliente_valido", "WARNING"),
            Check("DQ-6", "ERROR", _blank("cliente_id", "tipo_documento", "nombres")),
        ]
    if entity is PAGOS:
        return [
            _unknown_state("estado_pago", "_estado_pago_valido", "WARNING"),
            _outside("metodo_pago", METODOS_PAGO),
            _one("DQ-4", "ERROR", _no_amount("monto_pago"),
                 F.concat(F.lit("monto_pago fuera de dominio: "), _amount_text("monto_pago"))),
            _one("DQ-5", "ERROR", F.col("fecha_pago").isNull(),
                 _says("fecha_pago inválida: '", "fecha_pago", "'")),
            Check("DQ-6", "ERROR", _blank("credito_id", "metodo_pago")),
        ]
    rate = F.col("tasa_interes_mensual")
    asked, paid_out, due = (F.col(c) for c in
                            ("fecha_solicitud", "fecha_desembolso", "fecha_vencimiento"))
    return [
        _unknown_state("estado_credito", "_estado_credito_valido", "ERROR"),
        _outside("producto", PRODUCTOS),
        _outside("canal", CANALES),
        _joined("DQ-4", "Valor fuera de dominio: ", [
            (_no_amount("monto_aprobado"),
             F.concat(F.lit("monto_aprobado="), _amount_text("monto_aprobado"))),
            (_not_positive("plazo_meses") | (F.col("plazo_meses") > MOST_INT), _says("plazo_meses=", "plazo_meses")),
            (~rate.between(0, 10), F.concat(F.lit("tasa="), float_text(rate))),
        ]),
        _joined("DQ-5", "", [
            (asked.isNull(), F.lit("fecha_solicitud inválida o nula")),
            (paid_out < asked,
             F.concat(_says("fecha_desembolso (", "fecha_desembolso", ") < "),
                      _says("fecha_solicitud (", "fecha_solicitud", ")"))),
            (due < paid_out,
             F.concat(_says("fecha_vencimiento (", "fecha_vencimiento", ") < "),
                      _says("fecha_desembolso (", "fecha_desembolso", ")"))),
        ]),
        Check("DQ-6", "ERROR", ((rate.isNull(), F.lit("tasa_interes_mensual nula")),
                                *_blank("producto", "canal"))),
    ]


def duplicate_check(entity: Entity) -> Check:
    """DQ-1: any row of a key but the first. Needs ``LATER``, set only for such rows."""
    return _one("DQ-1", "ERROR", F.col(LATER),
                _says(f"{entity.key} duplicado: ", entity.key))


def orphan_check(foreign_key: str) -> Check:
    """DQ-2: no parent. Needs ``PARENT``, true where the parent exists."""
    return _one("DQ-2", "ERROR", F.col(PARENT).isNull(),
                _says(f"{foreign_key} huérfano: ", foreign_key))


def judge(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Add the verdict of the first failing check.

    The predicates are evaluated once, into the number of that check; messages are built for
    failing rows only.
    """
    first = F.coalesce(*[F.when(c.fails, F.lit(i)) for i, c in enumerate(checks)])
    failed = F.col("_control")

    def pick(parts: list[Column]) -> Column:
        return F.coalesce(*[F.when(failed == i, part) for i, part in enumerate(parts)])

    messages = [F.array_compact(F.array(*[F.when(cond, text) for cond, text in c.motives]))
                for c in checks]
    return (df.withColumn("_control", first)
            .withColumns({RULE: pick([F.lit(c.rule) for c in checks]),
                          SEVERITY: pick([F.lit(c.severity) for c in checks]),
                          MOTIVES: pick(messages)})
            .drop("_control"))


def payload(entity: Entity, columns: list[str]) -> Column:
    """The row as JSON: typed values with nulls spelled out, flags, lineage, source text."""
    names = [*entity.columns, *LINEAGE, *entity.catalog_flags, *entity.flags]
    parts = [F.col(c) for c in names if c in columns]
    texts = [F.col(SOURCE_TEXT + n).alias(n) for n in read_fields(entity)
             if SOURCE_TEXT + n in columns]
    if texts:
        parts.append(F.struct(*texts).alias("_texto_original"))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def row_payload(entity: Entity, columns: list[str]) -> Column:
    """``payload`` of an isolated row, whose values are not looked up, or of a flagged one.

    It is written out when errors are read: stored and dealt rows hold each value once.
    """
    isolated = payload(entity, [c for c in columns if c not in entity.flags])
    if not entity.flags:
        return isolated
    return F.when(F.col(RULE).isNotNull(), isolated).otherwise(payload(entity, columns))


# --- Markers that need other rows ---------------------------------------------------------

def identity(entity: Entity, foreign_key: str | None) -> list[str]:
    """What tells rows apart that are one another's duplicates, and where they will be dealt."""
    return [*([foreign_key] if foreign_key else []), entity.key, ORDER]


def later_rows(entity: Entity, df: DataFrame, foreign_key: str | None, scratch: Scratch,
               limits: JoinLimits = DEFAULT_LIMITS) -> Stored:
    """The identity of every row of a key but its first, with ``LATER``.

    Keys and orders move once, without the rest of the rows. The few keys with more rows than one
    task should hold do not move: their first rows are combined before the shuffle, and told to all.
    """
    key, names = entity.key, identity(entity, foreign_key)
    rows = df.select(*names)
    counts = frequent_keys(df.select(key), [key], limits.rows_per_piece)
    hot = scratch.save(hot_keys(counts, [key], limits.rows_per_piece).select(key), f"{entity.name}-hot")
    rest = rows.join(F.broadcast(hot.df), key, "left_anti") if hot.rows else rows
    frames = [rest.withColumn(FIRST, F.min(ORDER).over(Window.partitionBy(key)))]
    if hot.rows:
        crowd = rows.join(F.broadcast(hot.df), key, "left_semi")
        firsts = crowd.groupBy(key).agg(F.min(ORDER).alias(FIRST))
        frames.append(crowd.join(F.broadcast(firsts), key))      # a row per hot key
    later = [df.where(F.col(ORDER) > F.col(FIRST)).select(*names).distinct() for df in frames]
    return scratch.save(reduce(DataFrame.unionByName, later).withColumn(LATER, F.lit(True)),
                        f"{entity.name}-later", key)


def mark_later(entity: Entity, df: DataFrame, later: Stored, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Mark the rows that follow the first one of their key, in an entity without parents."""
    return attach(df, later.df, identity(entity, None), right_bytes=later.lookup_bytes, salt_by=[ORDER],
                  counts=frequent_keys(df, identity(entity, None), limits.rows_per_piece), limits=limits)


def mark_parent(df: DataFrame, foreign_key: str, parents: DataFrame, parent_bytes: int,
                counted: DataFrame, limits: JoinLimits = DEFAULT_LIMITS,
                entity: Entity | None = None, later: Stored | None = None) -> DataFrame:
    """Bring the parent's columns, and ``PARENT`` where there is one; and ``LATER``, if given.

    ``parents`` has unique keys. ``counted`` is a frame to count foreign keys in: any that holds
    every row of ``df``, so the cheapest to read.
    """
    found = parents.withColumn(PARENT, F.lit(True))
    settings = dict(right_bytes=parent_bytes, salt_by=[ORDER], limits=limits,
                    counts=frequent_keys(counted, [foreign_key], limits.rows_per_piece))
    if later is None:
        return attach(df, found, [foreign_key], **settings)
    return attach_marked(df, found, [foreign_key], later.df, identity(entity, foreign_key),
                         marks_bytes=later.lookup_bytes, **settings)


def flag_shared(entity: Entity, judged: Stored, scratch: Scratch,
                limits: JoinLimits = DEFAULT_LIMITS) -> tuple[DataFrame, bool]:
    """DQ-7: flag every valid row whose value is shared; blanks never count as shared.

    Also tells whether rows move for that, so that the result had better be stored.
    """
    df, moves = judged.df, False
    valid = F.col(RULE).isNull()
    for column, flag, _ in entity.duplicate_flags:
        candidates = judged.df.where(valid & ~is_blank(F.col(column))).select(column)
        shared = scratch.save(repeated_keys(candidates, [column]), f"{entity.name}-{flag}", column)
        df = attach(df, shared.df.drop(TIMES).withColumn(flag, F.lit(True)), [column],
                    right_bytes=shared.lookup_bytes, salt_by=[ORDER], limits=limits,
                    counts=frequent_keys(judged.df, [column], limits.rows_per_piece))
        df = df.withColumn(flag, valid & F.coalesce(F.col(flag), F.lit(False)))
        moves = moves or shared.lookup_bytes > limits.broadcast_bytes
    return df, moves


# --- Errors and survivors -----------------------------------------------------------------

def valid_rows(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(RULE).isNull())


def entity_errors(entity: Entity, judged: DataFrame, run_id: str) -> DataFrame:
    """One error per motive of a failing row, and one per shared value of a valid row."""
    lines = F.transform(F.coalesce(F.col(MOTIVES), F.array().cast("array<string>")),
                        lambda m: F.struct(F.col(RULE).alias("regla_id"),
                                           F.col(SEVERITY).alias("severidad"), m.alias("motivo")))
    shared = [F.when(F.col(flag), F.struct(
        F.lit("DQ-7").alias("regla_id"), F.lit("WARNING").alias("severidad"),
        F.concat(F.lit(label), F.col(column)).alias("motivo")))
        for column, flag, label in entity.duplicate_flags]
    failing = F.col(RULE).isNotNull()
    for flag in entity.flags:
        failing = failing | F.col(flag)
    every = F.concat(lines, F.array_compact(F.array(*shared))) if shared else lines
    return (judged.where(failing)
            .select(entity.key, row_payload(entity, judged.columns).alias(PAYLOAD), F.explode(every).alias("_e"))
            .select(F.lit(run_id).alias("run_id"), "_e.regla_id",
                    F.lit(entity.raw_table).alias("tabla_origen"), "_e.severidad", "_e.motivo",
                    F.col(PAYLOAD).alias("payload_original"),
                    F.col(entity.key).alias("_clave")))


def error_table(errors: DataFrame) -> DataFrame:
    return errors.select(*ERROR_COLUMNS)
