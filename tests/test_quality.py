"""Each rule on one-violation rows, then order, audit trail, and hot keys."""

import json

import pytest

from conftest import raw_frames
from creditmart.operators.lookup import JoinLimits
from creditmart.operators.quality import ERROR_COLUMNS
from creditmart.plans.warehouse import Warehouse

OK = {"C0001": "C0001"}

CLIENTES = [
    dict(cliente_id="C0001", numero_documento="1"),
    dict(cliente_id="C0002", numero_documento="2", estado_cliente="Desconocido"),
    dict(cliente_id="C0003", numero_documento="3", tipo_documento="", nombres="  "),
    dict(cliente_id="C0004", numero_documento="4", email="mismo@email.com"),
    dict(cliente_id="C0005", numero_documento="4", email="mismo@email.com"),
    dict(cliente_id="C0006", numero_documento="6", email="Mismo@email.com"),
    dict(cliente_id="C0007", numero_documento="", email=""),
    dict(cliente_id="C0008", numero_documento="", email=" "),
    dict(cliente_id="C0001", numero_documento="9", nombres="Second"),
]
CREDITOS = [
    dict(credito_id="CR1"),
    dict(credito_id="CR1", monto_aprobado="-1"),
    dict(credito_id="CR2", cliente_id="C9999"),
    dict(credito_id="CR3", estado_credito="Aprobado", producto="Hipotecario"),
    dict(credito_id="CR4", producto="Hipotecario", canal="Presencial"),
    dict(credito_id="CR5", canal="Presencial"),
    dict(credito_id="CR6", producto="CONSUMO"),
    dict(credito_id="CR7", monto_aprobado="-700000"),
    dict(credito_id="CR8", plazo_meses="0"),
    dict(credito_id="CR9", monto_aprobado="", plazo_meses="x", tasa_interes_mensual="12.5"),
    dict(credito_id="CR10", fecha_solicitud="2024-11-16", fecha_desembolso="2024-11-14"),
    dict(credito_id="CR11", fecha_solicitud="2024-13-01"),
    dict(credito_id="CR12", fecha_desembolso="", fecha_vencimiento=""),
    dict(credito_id="CR13", fecha_solicitud="2024-11-16", fecha_desembolso="2024-11-14",
         fecha_vencimiento="2024-11-01"),
    dict(credito_id="CR14", tasa_interes_mensual=""),
    dict(credito_id="CR15", tasa_interes_mensual="10"),
    dict(credito_id="CR16", cliente_id="C0002"),
    dict(credito_id="CR17", tasa_interes_mensual="10.00004"),
    dict(credito_id="CR18", monto_aprobado="nan"),
    dict(credito_id=""),
]
PAGOS = [
    dict(pago_id="P1"),
    dict(pago_id="P1", credito_id="CR99999"),
    dict(pago_id="P2", credito_id="CR99999"),
    dict(pago_id="P3", credito_id="CR2"),
    dict(pago_id="P4", credito_id="CR7"),
    dict(pago_id="P5", metodo_pago="Cheque"),
    dict(pago_id="P6", estado_pago="Anulado", metodo_pago="Cheque"),
    dict(pago_id="P7", monto_pago="-150000"),
    dict(pago_id="P8", monto_pago="0.0"),
    dict(pago_id="P9", fecha_pago="2024-13-01"),
    dict(pago_id="P10", credito_id=""),
    dict(pago_id="P11", referencia_transaccion="REF001"),
    dict(pago_id="P12", referencia_transaccion="REF001"),
    dict(pago_id="P13", referencia_transaccion="REF001", monto_pago="-1"),
    dict(pago_id="P14", referencia_transaccion="REF002"),
    dict(pago_id="P15", referencia_transaccion="REF002", monto_pago="-1"),
]
for rows, key in ((CREDITOS, "cliente_id"), (PAGOS, "credito_id")):
    for r in rows:
        r.setdefault(key, "C0001" if key == "cliente_id" else "CR1")


@pytest.fixture(scope="module")
def built(spark):
    return Warehouse(spark, raw_frames(spark, CLIENTES, CREDITOS, PAGOS), run_id="corrida")


@pytest.fixture(scope="module")
def errors(built):
    return built.errors_with_key().collect()


def of(errors, rule, table):
    return sorted((e._clave, e.severidad, e.motivo) for e in errors
                  if e.regla_id == rule and e.tabla_origen == f"raw_{table}")


def ids(built, entity, key):
    return {r[0] for r in built.valid(entity).select(key).collect()}


def test_dq1_keeps_the_first_row(built, errors):
    assert of(errors, "DQ-1", "clientes") == [("C0001", "ERROR", "cliente_id duplicado: C0001")]
    assert of(errors, "DQ-1", "creditos") == [("CR1", "ERROR", "credito_id duplicado: CR1")]
    assert of(errors, "DQ-1", "pagos") == [("P1", "ERROR", "pago_id duplicado: P1")]
    kept = built.valid("clientes").where("cliente_id = 'C0001'").collect()
    assert [r.numero_documento for r in kept] == ["1"]
    assert [r.credito_id for r in built.valid("pagos").where("pago_id = 'P1'").collect()] == ["CR1"]


def test_dq2_orphans_cascade(errors):
    assert of(errors, "DQ-2", "creditos") == [("CR2", "ERROR", "cliente_id huérfano: C9999")]
    assert of(errors, "DQ-2", "pagos") == [
        ("P2", "ERROR", "credito_id huérfano: CR99999"), ("P3", "ERROR", "credito_id huérfano: CR2")]


def test_dq2_later_isolation_of_a_parent_does_not_orphan(built):
    assert "CR16" in ids(built, "creditos", "credito_id")     # customer isolated by DQ-3
    assert "P4" in ids(built, "pagos", "pago_id")             # loan isolated by DQ-4


def test_dq3_one_error_each_state_before_product_before_channel(errors):
    assert of(errors, "DQ-3", "clientes") == [
        ("C0002", "WARNING", "estado_cliente no reconocido: 'Desconocido'")]
    assert of(errors, "DQ-3", "creditos") == [
        ("CR3", "ERROR", "estado_credito no reconocido: 'Aprobado'"),
        ("CR4", "ERROR", "producto no reconocido: 'Hipotecario'"),
        ("CR5", "ERROR", "canal no reconocido: 'Presencial'")]
    assert of(errors, "DQ-3", "pagos") == [
        ("P5", "ERROR", "metodo_pago no reconocido: 'Cheque'"),
        ("P6", "WARNING", "estado_pago no reconocido: 'Anulado'")]


def test_dq3_isolates_warnings_and_ignores_case(built):
    assert "C0002" not in ids(built, "clientes", "cliente_id")
    assert "P6" not in ids(built, "pagos", "pago_id")
    assert "CR6" in ids(built, "creditos", "credito_id")


def test_dq4_domain(errors):
    assert of(errors, "DQ-4", "creditos") == [
        ("CR17", "ERROR", "Valor fuera de dominio: tasa=10.00004"),
        ("CR18", "ERROR", "Valor fuera de dominio: monto_aprobado=nan"),
        ("CR7", "ERROR", "Valor fuera de dominio: monto_aprobado=-700000.0"),
        ("CR8", "ERROR", "Valor fuera de dominio: plazo_meses=0"),
        ("CR9", "ERROR", "Valor fuera de dominio: monto_aprobado=nan; plazo_meses=None; tasa=12.5")]
    assert [e[0] for e in of(errors, "DQ-4", "pagos")] == ["P13", "P15", "P7", "P8"]


def test_dq5_dates(built, errors):
    assert of(errors, "DQ-5", "creditos") == [
        ("CR10", "ERROR", "fecha_desembolso (2024-11-14) < fecha_solicitud (2024-11-16)"),
        ("CR11", "ERROR", "fecha_solicitud inválida o nula"),
        ("CR13", "ERROR", "fecha_desembolso (2024-11-14) < fecha_solicitud (2024-11-16); "
                          "fecha_vencimiento (2024-11-01) < fecha_desembolso (2024-11-14)")]
    assert of(errors, "DQ-5", "pagos") == [("P9", "ERROR", "fecha_pago inválida: 'None'")]
    assert "CR12" in ids(built, "creditos", "credito_id")


def test_dq6_one_error_per_blank_column(built, errors):
    assert of(errors, "DQ-6", "clientes") == [
        ("C0003", "ERROR", "nombres nulo o vacío"),
        ("C0003", "ERROR", "tipo_documento nulo o vacío")]
    assert of(errors, "DQ-6", "creditos") == [("CR14", "ERROR", "tasa_interes_mensual nula")]
    assert of(errors, "DQ-6", "pagos") == [("P10", "ERROR", "credito_id nulo o vacío")]
    assert "CR15" in ids(built, "creditos", "credito_id")


def test_dq7_flags_every_member_and_keeps_it(built, errors):
    assert of(errors, "DQ-7", "clientes") == [
        ("C0004", "WARNING", "email duplicado: mismo@email.com"),
        ("C0004", "WARNING", "numero_documento duplicado: 4"),
        ("C0005", "WARNING", "email duplicado: mismo@email.com"),
        ("C0005", "WARNING", "numero_documento duplicado: 4")]
    assert [e[0] for e in of(errors, "DQ-7", "pagos")] == ["P11", "P12"]
    flags = {r.cliente_id: (r.flag_email_duplicado, r.flag_doc_duplicado)
             for r in built.valid("clientes").collect()}
    assert flags["C0004"] == flags["C0005"] == (True, True)
    assert flags["C0006"] == flags["C0007"] == flags["C0008"] == (False, False)


def test_dq7_counts_survivors_only(built):
    flags = {r.pago_id: r.flag_referencia_duplicada for r in built.valid("pagos").collect()}
    assert flags["P11"] and flags["P12"] and not flags["P14"]


def test_every_row_is_valid_or_has_an_error(built, errors):
    isolating = {(e.tabla_origen, e._clave) for e in errors if e.regla_id != "DQ-7"}
    for entity, rows in (("clientes", CLIENTES), ("creditos", CREDITOS), ("pagos", PAGOS)):
        judged = built.judged(entity)
        assert judged.count() == len(rows)
        isolated = judged.where("_regla is not null").count()
        assert isolated + built.valid(entity).count() == len(rows)
        assert len([1 for t, _ in isolating if t == f"raw_{entity}"]) <= isolated


def test_error_table_and_payload(built):
    table = built.errors()
    assert table.columns == ERROR_COLUMNS
    rows = {(r.regla_id, r.motivo): r for r in table.collect()}
    row = rows["DQ-5", "fecha_pago inválida: 'None'"]
    body = json.loads(row.payload_original)
    assert row.run_id == "corrida"
    assert body["pago_id"] == "P9" and body["fecha_pago"] is None
    assert body["_estado_pago_valido"] is True
    assert body["_texto_original"]["fecha_pago"] == "2024-13-01"
    assert json.loads(rows["DQ-4", "Valor fuera de dominio: plazo_meses=0"].payload_original)[
        "fecha_solicitud"] == "2024-01-10"
    flagged = json.loads(rows["DQ-7", "numero_documento duplicado: 4"].payload_original)
    assert flagged["flag_doc_duplicado"] is True


def test_clean_rows_pass_and_errors_keep_their_columns(spark):
    dw = Warehouse(spark, raw_frames(spark))
    assert dw.errors().columns == ERROR_COLUMNS
    assert dw.errors().count() == 0
    assert [dw.valid(n).count() for n in ("clientes", "creditos", "pagos")] == [1, 1, 1]


def test_empty_inputs(spark):
    dw = Warehouse(spark, raw_frames(spark, [], [], []))
    assert dw.errors().count() == 0
    assert dw.fact_credito.count() == dw.fact_pago.count() == 0


@pytest.fixture(scope="module")
def hot_rows():
    """A third or more of all rows share one key: customer, loan, payment id and reference."""
    clientes = [dict(cliente_id=f"C{i}", numero_documento=str(i % 40), email=f"e{i % 30}@x")
                for i in range(60)]
    creditos = [dict(credito_id=f"CR{i}", cliente_id="C1" if i % 2 else f"C{i % 70}")
                for i in range(200)]
    pagos = [dict(pago_id="P0" if i % 3 == 0 else f"P{i}",
                  credito_id="CR1" if i % 2 else f"CR{i % 230}",
                  referencia_transaccion="R" if i % 3 == 1 else f"R{i % 50}")
             for i in range(900)]
    return clientes, creditos, pagos


def outcome(dw):
    errors = sorted(tuple(r) for r in dw.errors().drop("payload_original").collect())
    facts = sorted(tuple(r) for r in dw.fact_pago.collect())
    loans = sorted(tuple(r) for r in dw.fact_credito.collect())
    flags = sorted((r.pago_id, r.flag_referencia_duplicada) for r in dw.valid("pagos").collect())
    return errors, facts, loans, flags


def test_shuffled_lookup_with_hot_keys_gives_the_same_result(spark, hot_rows):
    raw = raw_frames(spark, *hot_rows)
    plain = outcome(Warehouse(spark, raw))
    salted = outcome(Warehouse(spark, raw, limits=JoinLimits(broadcast_bytes=-1, rows_per_piece=20)))
    assert len(plain[0]) > 500 and len(plain[1]) > 300
    assert salted == plain
