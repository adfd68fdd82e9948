"""Declared data model: entities, typed fields, catalogues and seed dimensions.

Every list, label and limit below is a fixed value of the data contract.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Catalogues (fixed values): accepted spelling, lower case -> canonical label ----------

ESTADOS_CLIENTE = {
    "activo": "Activo",
    "inactivo": "Inactivo",
    "bloqueado": "Bloqueado",
    "suspendido": "Suspendido",
    "pendiente": "Pendiente",
    "en revision": "EnRevision",
    "enrevision": "EnRevision",
}
ESTADOS_CREDITO = {
    "activo": "Activo",
    "mora": "Mora",
    "vencido": "Vencido",
    "pagado": "Pagado",
    "cancelado": "Cancelado",
    "rechazado": "Rechazado",
}
ESTADOS_PAGO = {
    "exitoso": "Exitoso",
    "success": "Exitoso",
    "pendiente": "Pendiente",
    "fallido": "Fallido",
    "reversado": "Reversado",
}
TIPOS_DOCUMENTO = {"cc": "CC", "ce": "CE", "nit": "NIT"}

# --- Seed dimensions (fixed values), in surrogate-key order -------------------------------

PRODUCTOS = [
    ("MICRO", "Microcredito"),
    ("LIBRE_INV", "Libre inversion"),
    ("CAP_TRABAJO", "Capital trabajo"),
    ("CONSUMO", "Consumo"),
]
CANALES = [("ALIADO", "Aliado"), ("WEB", "Web"), ("APP", "App")]
# estado_id, nombre, es_activo, es_mora, es_terminado
ESTADOS_CREDITO_DIM = [
    ("ACTIVO", "Activo", True, False, False),
    ("MORA", "Mora", False, True, False),
    ("VENCIDO", "Vencido", False, False, False),
    ("PAGADO", "Pagado", False, False, True),
    ("CANCELADO", "Cancelado", False, False, True),
    ("RECHAZADO", "Rechazado", False, False, True),
]
# metodo_id, nombre, tipo
METODOS_PAGO = [
    ("PSE", "PSE", "digital"),
    ("EFECTY", "Efecty", "efectivo"),
    ("TRANSFERENCIA", "Transferencia", "bancario"),
    ("TARJETA", "Tarjeta", "digital"),
]

MESES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
         "Septiembre", "Octubre", "Noviembre", "Diciembre"]
DIAS = ["Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo"]

CALENDARIO_DESDE = "2023-01-01"
CALENDARIO_HASTA = "2030-12-31"

SEVERIDADES = ("ERROR", "WARNING")
ESTADOS_CORRIDA = ("RUNNING", "SUCCESS", "FAILED")


# --- Entities -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """One business column: how its text is read and how staging declares it."""

    name: str
    kind: str                      # text | catalog | date | number | integer
    sql_type: str                  # staging type
    not_null: bool = False
    max_len: int | None = None
    catalog: dict | None = None
    flag: str | None = None        # column that records whether the catalogue matched
    optional: bool = False         # may be absent from the source header


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    fields: tuple[Field, ...]
    duplicate_flags: tuple[tuple[str, str, str], ...] = ()   # (column, flag, motive label)

    @property
    def raw_table(self) -> str:
        return f"raw_{self.name}"

    @property
    def staging_table(self) -> str:
        return f"stg_{self.name}"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if not f.optional]

    @property
    def catalog_flags(self) -> list[str]:
        return [f.flag for f in self.fields if f.flag]

    @property
    def flags(self) -> list[str]:
        return [flag for _, flag, _ in self.duplicate_flags]


def _text(name: str, size: int, not_null: bool = False) -> Field:
    return Field(name, "text", "string", not_null, size)


def _catalog(name: str, size: int, catalog: dict, flag: str) -> Field:
    return Field(name, "catalog", "string", True, size, catalog, flag)


def _date(name: str, not_null: bool = False, optional: bool = False) -> Field:
    return Field(name, "date", "date", not_null, optional=optional)


CLIENTES = Entity(
    "clientes", "cliente_id",
    (
        _text("cliente_id", 20, True),
        _catalog("tipo_documento", 10, TIPOS_DOCUMENTO, "_tipo_doc_valido"),
        _text("numero_documento", 50),
        _text("nombres", 200, True),
        _text("apellidos", 200),
        _text("email", 200),
        _text("telefono", 30),
        _date("fecha_registro"),
        _catalog("estado_cliente", 20, ESTADOS_CLIENTE, "_estado_cliente_valido"),
        _text("ciudad", 100),
        _text("segmento", 50),
        _date("fecha_nacimiento", optional=True),
        Field("ingresos_mensuales", "number", "decimal(18,2)", optional=True),
    ),
    (
        ("email", "flag_email_duplicado", "email duplicado: "),
        ("numero_documento", "flag_doc_duplicado", "numero_documento duplicado: "),
    ),
)

CREDITOS = Entity(
    "creditos", "credito_id",
    (
        _text("credito_id", 20, True),
        _text("cliente_id", 20, True),
        _date("fecha_solicitud", True),
        _date("fecha_desembolso"),
        Field("monto_aprobado", "number", "decimal(18,2)", True),
        Field("plazo_meses", "integer", "int", True),
        Field("tasa_interes_mensual", "number", "decimal(8,4)"),
        _catalog("estado_credito", 30, ESTADOS_CREDITO, "_estado_credito_valido"),
        _text("producto", 100, True),
        _date("fecha_vencimiento"),
        _text("canal", 50, True),
    ),
)

PAGOS = Entity(
    "pagos", "pago_id",
    (
        _text("pago_id", 20, True),
        _text("credito_id", 20, True),
        _date("fecha_pago", True),
        Field("monto_pago", "number", "decimal(18,2)", True),
        _text("metodo_pago", 50, True),
        _catalog("estado_pago", 30, ESTADOS_PAGO, "_estado_pago_valido"),
        _text("referencia_transaccion", 100),
    ),
    (("referencia_transaccion", "flag_referencia_duplicada",
      "referencia_transaccion duplicada: "),),
)

ENTITIES = {e.name: e for e in (CLIENTES, CREDITOS, PAGOS)}
LINEAGE = ("_ingested_at", "_source_file")
ORDER = "_orden"   # per-row position in the source; unique, and comparable within an entity
