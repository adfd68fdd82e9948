"""Cleansing: from raw text to typed, canonical columns, in narrow projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.functions.parsing import date_of, parse_double, truncated, year_first
from creditmart.functions.text import catalog_value, strip
from creditmart.model import CLIENTES, CREDITOS, ENTITIES, LINEAGE, ORDER, PAGOS, Entity, Field

SOURCE_TEXT = "_texto_"        # prefix of the columns that keep the text behind a typed one


def _stripped(field: Field, columns: list[str]) -> Column:
    text = F.col(field.name) if field.name in columns else F.lit("")
    return strip(F.coalesce(text, F.lit(""))).alias(field.name)


def _read(field: Field) -> list[Column]:
    """First reading of stripped text: dates year first, numbers as double, catalogues looked up."""
    text = F.col(field.name)
    if field.kind == "catalog":
        return [text.alias(field.name), catalog_value(text, field.catalog).alias(field.flag)]
    if field.kind == "date":
        return [year_first(text).alias(field.name)]
    if field.kind in ("number", "integer"):
        return [parse_double(text).alias(field.name)]
    return [text]


def _finish(field: Field) -> list[Column]:
    value = F.col(field.name)
    if field.kind == "catalog":
        found = F.col(field.flag)
        return [F.coalesce(found, value).alias(field.name), found.isNotNull().alias(field.flag)]
    if field.kind == "date":
        return [date_of(value).alias(field.name)]
    if field.kind == "integer":
        return [truncated(value).alias(field.name)]
    return [value]


def read_fields(entity: Entity) -> list[str]:
    """Fields whose text is read into another type or spelling, which may lose it."""
    return [f.name for f in entity.fields if f.kind != "text"]


def stripped(entity: Entity, raw: DataFrame) -> DataFrame:
    """The texts of all fields without blanks at their ends, lineage and order.

    Keys are texts, so rows can be dealt by them before the rest is read, while they are small.
    """
    kept = [F.col(c) for c in (*LINEAGE, ORDER) if c in raw.columns]
    return raw.select(*[_stripped(f, raw.columns) for f in entity.fields], *kept)


def typed(entity: Entity, texts: DataFrame) -> DataFrame:
    """Stripped texts read: typed columns, catalogue flags, other columns, and the texts read.

    Dates and numbers that cannot be read become null here, and catalogue values are respelled, so
    their text is kept for the audit trail. Numbers stay as read, also those that staging could
    not hold. The steps are separate projections so that each text is matched and cast once per
    row: Catalyst keeps them apart because later ones use a result repeatedly.
    """
    kept = [F.col(c) for c in texts.columns if c not in entity.columns]
    source = {f"{SOURCE_TEXT}{name}": F.col(name) for name in read_fields(entity)}
    values = texts.select(*[c for f in entity.fields for c in _read(f)], *kept,
                          *[text.alias(name) for name, text in source.items()])
    return values.select(*[c for f in entity.fields for c in _finish(f)], *kept, *source)


def cleanse(entity: Entity, raw: DataFrame) -> DataFrame:
    """Typed columns, catalogue flags, lineage and order; plus the text behind what was read."""
    return typed(entity, stripped(entity, raw))


def cleanse_clientes(raw: DataFrame) -> DataFrame:
    return cleanse(CLIENTES, raw)


def cleanse_creditos(raw: DataFrame) -> DataFrame:
    return cleanse(CREDITOS, raw)


def cleanse_pagos(raw: DataFrame) -> DataFrame:
    return cleanse(PAGOS, raw)


def cleanse_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: cleanse(ENTITIES[name], df) for name, df in raw.items()}


def overflows(entity: Entity) -> dict[str, Column]:
    """By number column, whether a value does not fit its staging type."""
    return {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.sql_type).isNull()
            for f in entity.fields if f.kind in ("number", "integer")}


def staged_fields(entity: Entity, counted: bool = False) -> list[Column]:
    """The fields under their staging types.

    A value that does not fit fails its row, whatever the session makes of such casts; or becomes
    null where the caller has them ``counted``.
    """
    def typed(field: Field) -> Column:
        value = F.col(field.name).try_cast(field.sql_type)
        if counted or field.name not in lost:
            return value.alias(field.name)
        error = F.raise_error(F.lit(f"NUMERIC_VALUE_OUT_OF_RANGE: {field.name}")).cast(field.sql_type)
        return F.when(lost[field.name], error).otherwise(value).alias(field.name)

    lost = overflows(entity)
    return [typed(f) for f in entity.fields]


def to_staging(entity: Entity, df: DataFrame, counted: bool = False) -> DataFrame:
    """Declared staging columns in declared order and type; absent flags default to false."""
    flags = [(F.coalesce(F.col(f), F.lit(False)) if f in df.columns else F.lit(False)).alias(f)
             for f in entity.flags]
    return df.select(*staged_fields(entity, counted), *flags, *[c for c in LINEAGE if c in df.columns])
