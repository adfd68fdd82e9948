"""Warehouse: the layers built from three raw entities.

Each entity is judged once and stored once. Staging, error log and discards are then filters and
projections of those three tables, with no further shuffle:

* customers: mark later rows of a key, judge, store; flag shared e-mails and documents; arrange, store
* loans: attach the customer (existence and key) and the mark of later rows in one move, read the
  texts, judge, store
* payments: attach the loan (existence, customer key) and the mark of later rows in one move, read
  the texts, judge, store; flag shared references, as rows are read where few values are shared

Loans and payments that enter a fact are arranged in load order, with the columns of the fact only.

A table is built when first asked for.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.model import (CALENDARIO_DESDE, CALENDARIO_HASTA, CLIENTES, CREDITOS, ENTITIES,
                              ORDER, PAGOS)
from creditmart.operators import calendar, quality, star
from creditmart.operators.cleanse import cleanse, staged_fields, stripped, to_staging, typed
from creditmart.operators.lookup import DEFAULT_LIMITS, JoinLimits
from creditmart.operators.sequence import arrange, number
from creditmart.operators.star import DISCARD, OUT_OF_CALENDAR
from creditmart.plans.concurrent import together
from creditmart.sources.tables import Scratch, Stored

RUN_ID = "00000000-0000-0000-0000-000000000000"
_UPSTREAM = ("DQ-1", "DQ-2")       # rules that take a row out before it can be a parent
_PARENT = {"creditos": "cliente_id", "pagos": "credito_id"}


@dataclass
class Warehouse:
    """``raw`` holds clientes, creditos and pagos as text columns plus ``_orden``.

    ``cutoff`` is the date arrears are counted to; None takes the latest date in the data.
    """

    spark: SparkSession
    raw: Mapping[str, DataFrame]
    run_id: str = RUN_ID
    start: str = CALENDARIO_DESDE
    end: str = CALENDARIO_HASTA
    cutoff_date: date | None = None
    limits: JoinLimits = DEFAULT_LIMITS
    scratch: Scratch = field(default=None)

    def __post_init__(self):
        self.scratch = self.scratch or Scratch(self.spark)
        self._clean: dict[str, DataFrame] = {}
        self._text: dict[str, DataFrame] = {}
        self._later: dict[str, Stored] = {}

    def cleaned(self, name: str) -> DataFrame:
        """One entity typed and canonical, before any rule."""
        if name not in self._clean:
            self._clean[name] = cleanse(ENTITIES[name], self.raw[name])
        return self._clean[name]

    def _texts(self, name: str) -> DataFrame:
        """One entity as stripped texts: what is moved, as it is smaller than what is read from it."""
        if name not in self._text:
            self._text[name] = stripped(ENTITIES[name], self.raw[name])
        return self._text[name]

    def _find_repeated(self, *names: str) -> None:
        """Look for rows of repeated keys in several entities at once: no entity depends on another."""
        missing = [n for n in names if n not in self._later]
        self._later |= together({
            n: lambda n=n: quality.later_rows(ENTITIES[n], self._texts(n), _PARENT.get(n), self.scratch, self.limits)
            for n in missing})

    def _owned(self, name: str, parents: DataFrame, parent_bytes: int) -> DataFrame:
        """One entity typed, with its parent's columns and the marks of later rows."""
        self._find_repeated(name)
        texts, key = self._texts(name), _PARENT[name]
        return typed(ENTITIES[name], quality.mark_parent(
            texts, key, parents, parent_bytes, texts.select(key), self.limits, ENTITIES[name], self._later[name]))

    # --- Judged entities ------------------------------------------------------------------

    @cached_property
    def judged_clientes(self) -> Stored:
        self._find_repeated("clientes")
        marked = typed(CLIENTES, quality.mark_later(CLIENTES, self._texts("clientes"), self._later["clientes"],
                                                    self.limits))
        checks = [quality.duplicate_check(CLIENTES), *quality.row_checks(CLIENTES)]
        stored = self.scratch.save(quality.judge(marked, checks).drop(quality.LATER), "clientes-judged")
        flagged, _ = quality.flag_shared(CLIENTES, stored, self.scratch, self.limits)
        arranged = self.scratch.save(
            arrange(flagged, F.col(quality.RULE).isNull(), [ORDER, CLIENTES.key]), "clientes",
            CLIENTES.key)
        self.scratch.discard("clientes-judged", "clientes-later")
        return arranged

    @cached_property
    def _customer_keys(self) -> DataFrame:
        """Every distinct customer id with its key; the key is null for isolated customers."""
        known = self.judged_clientes.df.where(
            F.col(quality.RULE).isNull() | (F.col(quality.RULE) != "DQ-1"))
        valid = F.col(quality.RULE).isNull()
        keyed = number(known, valid, "cliente_sk").select("cliente_id", "cliente_sk")
        isolated = known.where(~valid).select("cliente_id",
                                              F.lit(None).cast("long").alias("cliente_sk"))
        return keyed.unionByName(isolated)

    @cached_property
    def judged_creditos(self) -> Stored:
        self._find_repeated("clientes", "creditos")
        owned = self._owned("creditos", self._customer_keys, self.judged_clientes.lookup_bytes)
        checks = [quality.duplicate_check(CREDITOS), quality.orphan_check("cliente_id"),
                  *quality.row_checks(CREDITOS)]
        judged = quality.judge(owned, checks).drop(quality.LATER, quality.PARENT)
        keyed = star.with_seed_key(judged, star.dim_producto(self.spark), "producto_sk", "producto")
        keyed = star.with_seed_key(keyed, star.dim_canal(self.spark), "canal_sk", "canal")
        keyed = star.with_seed_key(keyed, star.dim_estado_credito(self.spark),
                                   "estado_credito_sk", "estado_credito")
        valid = F.col(quality.RULE).isNull()
        final = keyed.withColumn(DISCARD, F.when(valid, star.loan_discard(self.start, self.end)))
        stored = self.scratch.save(final, "creditos-judged", CREDITOS.key)
        self.scratch.discard("creditos-later")
        return stored

    @cached_property
    def _loan_keys(self) -> DataFrame:
        """Loans a payment may refer to, with the customer key it would take from them.

        Loans isolated by later rules still count as parents, but lend no customer key; nor do
        loans asked for outside the calendar.
        """
        lends = F.col(quality.RULE).isNull() & (
            F.coalesce(F.col(DISCARD), F.lit("")) != OUT_OF_CALENDAR)
        return (self.judged_creditos.df
                .where(F.col(quality.RULE).isNull() | ~F.col(quality.RULE).isin(*_UPSTREAM))
                .select("credito_id", F.when(lends, F.col("cliente_sk")).alias("cliente_sk")))

    @cached_property
    def judged_pagos(self) -> DataFrame:
        self._find_repeated(*ENTITIES)
        owned = self._owned("pagos", self._loan_keys, self.judged_creditos.lookup_bytes)
        checks = [quality.duplicate_check(PAGOS), quality.orphan_check("credito_id"),
                  *quality.row_checks(PAGOS)]
        judged = quality.judge(owned, checks).drop(quality.LATER, quality.PARENT)
        keyed = star.with_seed_key(judged, star.dim_metodo_pago(self.spark),
                                   "metodo_pago_sk", "metodo_pago")
        valid = F.col(quality.RULE).isNull()
        final = keyed.withColumn(DISCARD, F.when(valid, star.payment_discard(self.start, self.end)))
        stored = self.scratch.save(final, "pagos-judged")
        self.scratch.discard("pagos-later")
        flagged, moves = quality.flag_shared(PAGOS, stored, self.scratch, self.limits)
        if not moves:
            return flagged
        flagged = self.scratch.save(flagged, "pagos-flagged").df
        self.scratch.discard("pagos-judged")
        return flagged

    def build(self) -> Warehouse:
        """Build all stored tables now rather than on demand."""
        self.judged_pagos
        self._entering_creditos
        self._entering_pagos
        self.dim_tiempo
        return self

    def judged(self, name: str) -> DataFrame:
        return {"clientes": lambda: self.judged_clientes.df, "creditos": lambda: self.judged_creditos.df,
                "pagos": lambda: self.judged_pagos}[name]()

    # --- Staging and quality log ----------------------------------------------------------

    def valid(self, name: str) -> DataFrame:
        """Rows that passed every rule, typed, before staging casts."""
        return quality.valid_rows(self.judged(name))

    def staging(self, name: str) -> DataFrame:
        return to_staging(ENTITIES[name], self.valid(name))

    def errors_with_key(self) -> DataFrame:
        frames = [quality.entity_errors(e, self.judged(n), self.run_id)
                  for n, e in ENTITIES.items()]
        return reduce(DataFrame.unionByName, frames)

    def errors(self) -> DataFrame:
        return quality.error_table(self.errors_with_key())

    def discards(self) -> DataFrame:
        """Valid rows left out of a fact, with the reason."""
        frames = [self.judged(n).where(F.col(DISCARD).isNotNull())
                  .select(F.lit(table).alias("tabla"), F.col(ENTITIES[n].key).alias("clave"),
                          F.col(DISCARD).alias("motivo"))
                  for n, table in (("creditos", "fact_credito"), ("pagos", "fact_pago"))]
        return frames[0].unionByName(frames[1])

    # --- Star -----------------------------------------------------------------------------

    @cached_property
    def dim_tiempo(self) -> DataFrame:
        days = calendar.dim_tiempo(self.spark, self.start, self.end)
        return self.scratch.save(days.coalesce(1), "dim_tiempo").df

    @cached_property
    def dim_producto(self) -> DataFrame:
        return star.dim_producto(self.spark)

    @cached_property
    def dim_canal(self) -> DataFrame:
        return star.dim_canal(self.spark)

    @cached_property
    def dim_estado_credito(self) -> DataFrame:
        return star.dim_estado_credito(self.spark)

    @cached_property
    def dim_metodo_pago(self) -> DataFrame:
        return star.dim_metodo_pago(self.spark)

    @cached_property
    def dim_cliente(self) -> DataFrame:
        rows = number(self.judged_clientes.df, F.col(quality.RULE).isNull(), "cliente_sk")
        return rows.select("cliente_sk", *staged_fields(CLIENTES), *CLIENTES.flags)

    @cached_property
    def cutoff(self) -> date:
        if self.cutoff_date:
            return self.cutoff_date
        latest = star.latest_date(self.valid("creditos"), self.valid("pagos")).first()
        return latest.fecha_corte or datetime.now(timezone.utc).date()

    def _arranged(self, name: str, columns: tuple[str, ...]) -> DataFrame:
        """What a fact takes from the rows that enter it, stored in load order."""
        key = ENTITIES[name].key
        entering = self.judged(name).where(F.col(quality.RULE).isNull() & F.col(DISCARD).isNull())
        rows = arrange(entering.select(*columns, ORDER), F.lit(True), [ORDER, key])
        return self.scratch.save(rows.drop(ORDER), name).df

    @cached_property
    def _entering_creditos(self) -> DataFrame:
        return self._arranged("creditos", star.OF_LOANS)

    @cached_property
    def _entering_pagos(self) -> DataFrame:
        return self._arranged("pagos", star.OF_PAYMENTS)

    def fact(self, name: str) -> DataFrame:
        """A fact from the judged rows, dealt by the periods it is to be stored by."""
        if name == "fact_pago":
            rows = star.fact_pago(number(self._entering_pagos, F.lit(True), "fact_pago_sk"))
        else:
            rows = star.fact_credito(number(self._entering_creditos, F.lit(True), "fact_credito_sk"),
                                     self.cutoff, self.start, self.end)
        return star.by_period(name, rows)

    def _stored_fact(self, name: str) -> DataFrame:
        return self.scratch.save(self.fact(name), name, partition_by=list(star.PERIODS[name])).df

    @cached_property
    def fact_credito(self) -> DataFrame:
        return self._stored_fact("fact_credito")

    @cached_property
    def fact_pago(self) -> DataFrame:
        return self._stored_fact("fact_pago")

    STAR = ("dim_tiempo", "dim_producto", "dim_canal", "dim_estado_credito", "dim_metodo_pago",
            "dim_cliente", "fact_credito", "fact_pago")

    def star(self) -> dict[str, DataFrame]:
        """The tables to be published; facts are stored by whoever publishes them."""
        return {name: self.fact(name) if name in star.PERIODS else getattr(self, name)
                for name in self.STAR}
