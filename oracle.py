"""Check SQL for DuckDB: an independent statement of what each registered query must return.

``CHAIN`` restates the whole flow, one rule per common table expression, from the same test
mapping the Spark side reads. Each query adds its own last step.
"""

from __future__ import annotations

from creditmart.plans.audit import COUNTS
from creditmart.sources import fixtures
from creditmart.sources.fixtures import END, START

_NAMES = {n: n for n in ("customer", "nation", "orders", "lineitem")}


def _date(column: str) -> str:
    text = f"replace(trim({column}), '/', '-')"
    return (f"cast(coalesce(try_strptime({text}, '%Y-%m-%d'), try_strptime({text}, '%d-%m-%Y'))"
            f" as date) as {column}")


def _amount(column: str) -> str:
    return f"cast({column} as varchar)"


def _pct(part: str, whole: str) -> str:
    """Percentage half up to two decimals, on integers."""
    return (f"cast((20000 * cast({part} as hugeint) + {whole}) // nullif(2 * ({whole}), 0)"
            f" as double) / 100")


def _mean_round(total: str, count: str, scale: int, digits: int) -> str:
    """Mean half up to ``digits``, on integers; ``total`` has ``scale`` decimals."""
    units = f"cast(({total}) * {10 ** scale} as hugeint) * {10 ** digits}"
    den = f"(({count}) * {10 ** scale})"
    return f"cast((2 * {units} + {den}) // nullif(2 * {den}, 0) as double) / {10 ** digits}"


def _mean(total: str, count: str) -> str:
    return f"cast({total} as double) / nullif({count}, 0)"


def _state(column: str, pairs: str) -> str:
    return f"""coalesce(map {{{pairs}}}[lower(trim({column}))], trim({column})) as {column},
  map {{{pairs}}}[lower(trim({column}))] is not null"""


_CLIENT = ("'activo': 'Activo', 'inactivo': 'Inactivo', 'bloqueado': 'Bloqueado', "
           "'suspendido': 'Suspendido', 'pendiente': 'Pendiente', 'en revision': 'EnRevision', "
           "'enrevision': 'EnRevision'")
_LOAN = ("'activo': 'Activo', 'mora': 'Mora', 'vencido': 'Vencido', 'pagado': 'Pagado', "
         "'cancelado': 'Cancelado', 'rechazado': 'Rechazado'")
_PAY = ("'exitoso': 'Exitoso', 'success': 'Exitoso', 'pendiente': 'Pendiente', "
        "'fallido': 'Fallido', 'reversado': 'Reversado'")
_DOC = "'cc': 'CC', 'ce': 'CE', 'nit': 'NIT'"

CHAIN = f"""
raw_clientes as ({fixtures.CLIENTES_SQL.format(**_NAMES)}),
raw_creditos as ({fixtures.CREDITOS_SQL.format(**_NAMES)}),
raw_pagos as ({fixtures.PAGOS_SQL.format(**_NAMES)}),
t_clientes as (select trim(cliente_id) as cliente_id,
  {_state('tipo_documento', _DOC)} as _tipo_doc_valido,
  trim(numero_documento) as numero_documento, trim(nombres) as nombres,
  trim(apellidos) as apellidos, trim(email) as email, trim(telefono) as telefono,
  {_date('fecha_registro')},
  {_state('estado_cliente', _CLIENT)} as _estado_cliente_valido,
  trim(ciudad) as ciudad, trim(segmento) as segmento, {_date('fecha_nacimiento')},
  try_cast(trim(ingresos_mensuales) as double) as ingresos_mensuales,
  cast(substr(cliente_id, 2) as bigint) as _ord from raw_clientes),
t_creditos as (select trim(credito_id) as credito_id, trim(cliente_id) as cliente_id,
  {_date('fecha_solicitud')}, {_date('fecha_desembolso')},
  try_cast(trim(monto_aprobado) as double) as monto_aprobado,
  cast(trunc(try_cast(trim(plazo_meses) as double)) as bigint) as plazo_meses,
  try_cast(trim(tasa_interes_mensual) as double) as tasa_interes_mensual,
  {_state('estado_credito', _LOAN)} as _estado_credito_valido,
  trim(producto) as producto, {_date('fecha_vencimiento')}, trim(canal) as canal,
  _raw_id as _ord from raw_creditos),
t_pagos as (select trim(pago_id) as pago_id, trim(credito_id) as credito_id,
  {_date('fecha_pago')}, try_cast(trim(monto_pago) as double) as monto_pago,
  trim(metodo_pago) as metodo_pago, {_state('estado_pago', _PAY)} as _estado_pago_valido,
  trim(referencia_transaccion) as referencia_transaccion, _o1, _o2, _o3, _o4 from raw_pagos),
r_clientes as (select *, row_number() over (partition by cliente_id order by _ord) as _n from t_clientes),
r_creditos as (select *, row_number() over (partition by credito_id order by _ord) as _n from t_creditos),
r_pagos as (select *, row_number() over (partition by pago_id order by _o1, _o2, _o3, _o4) as _n from t_pagos),
c1_clientes as (select * from r_clientes where _n = 1),
c1_creditos as (select * from r_creditos where _n = 1),
c1_pagos as (select * from r_pagos where _n = 1),
c2_creditos as (select * from c1_creditos c where exists (select 1 from c1_clientes p where p.cliente_id = c.cliente_id)),
c2_pagos as (select * from c1_pagos c where exists (select 1 from c2_creditos p where p.credito_id = c.credito_id)),
x_creditos as (select *, lower(producto) in ('microcredito', 'libre inversion', 'capital trabajo', 'consumo') as _prod,
  lower(canal) in ('aliado', 'web', 'app') as _canal from c2_creditos),
x_pagos as (select *, lower(metodo_pago) in ('pse', 'efecty', 'transferencia', 'tarjeta') as _metodo from c2_pagos),
c3_clientes as (select * from c1_clientes where _estado_cliente_valido),
c3_creditos as (select * from x_creditos where _estado_credito_valido and _prod and _canal),
c3_pagos as (select * from x_pagos where _estado_pago_valido and _metodo),
d_creditos as (select *, coalesce(monto_aprobado <= 0 or monto_aprobado >= 1e16, true) as _m, coalesce(plazo_meses <= 0 or plazo_meses > 2147483647, true) as _p,
  coalesce(tasa_interes_mensual < 0 or tasa_interes_mensual > 10, false) as _t from c3_creditos),
c4_creditos as (select * from d_creditos where not (_m or _p or _t)),
c4_pagos as (select * from c3_pagos where monto_pago > 0 and monto_pago < 1e16),
f_creditos as (select *, fecha_solicitud is null as _f1, coalesce(fecha_desembolso < fecha_solicitud, false) as _f2,
  coalesce(fecha_vencimiento < fecha_desembolso, false) as _f3 from c4_creditos),
c5_creditos as (select * from f_creditos where not (_f1 or _f2 or _f3)),
c5_pagos as (select * from c4_pagos where fecha_pago is not null),
c6_clientes as (select * from c3_clientes where cliente_id <> '' and tipo_documento <> '' and nombres <> ''),
c6_creditos as (select * from c5_creditos where tasa_interes_mensual is not null and producto <> '' and canal <> ''),
c6_pagos as (select * from c5_pagos where credito_id <> '' and metodo_pago <> ''),
v_clientes as (select *, email <> '' and count(*) over (partition by email) > 1 as flag_email_duplicado,
  numero_documento <> '' and count(*) over (partition by numero_documento) > 1 as flag_doc_duplicado,
  row_number() over (order by _ord) as cliente_sk from c6_clientes),
v_creditos as (select * from c6_creditos),
v_pagos as (select *, referencia_transaccion <> '' and
  count(*) over (partition by referencia_transaccion) > 1 as flag_referencia_duplicada from c6_pagos),
errores as (
 select 'DQ-1' as regla_id, 'raw_clientes' as tabla_origen, 'ERROR' as severidad, 'cliente_id duplicado: ' || cliente_id as motivo, cliente_id as clave from r_clientes where _n > 1
 union all select 'DQ-1', 'raw_creditos', 'ERROR', 'credito_id duplicado: ' || credito_id, credito_id from r_creditos where _n > 1
 union all select 'DQ-1', 'raw_pagos', 'ERROR', 'pago_id duplicado: ' || pago_id, pago_id from r_pagos where _n > 1
 union all select 'DQ-2', 'raw_creditos', 'ERROR', 'cliente_id huérfano: ' || cliente_id, credito_id from c1_creditos where credito_id not in (select credito_id from c2_creditos)
 union all select 'DQ-2', 'raw_pagos', 'ERROR', 'credito_id huérfano: ' || credito_id, pago_id from c1_pagos where pago_id not in (select pago_id from c2_pagos)
 union all select 'DQ-3', 'raw_clientes', 'WARNING', 'estado_cliente no reconocido: ''' || estado_cliente || '''', cliente_id from c1_clientes where not _estado_cliente_valido
 union all select 'DQ-3', 'raw_creditos', 'ERROR', case when not _estado_credito_valido then 'estado_credito no reconocido: ''' || estado_credito || ''''
   when not _prod then 'producto no reconocido: ''' || producto || '''' else 'canal no reconocido: ''' || canal || '''' end, credito_id
   from x_creditos where not (_estado_credito_valido and _prod and _canal)
 union all select 'DQ-3', 'raw_pagos', case when _estado_pago_valido then 'ERROR' else 'WARNING' end,
   case when not _estado_pago_valido then 'estado_pago no reconocido: ''' || estado_pago || '''' else 'metodo_pago no reconocido: ''' || metodo_pago || '''' end, pago_id
   from x_pagos where not (_estado_pago_valido and _metodo)
 union all select 'DQ-4', 'raw_creditos', 'ERROR', 'Valor fuera de dominio: ' || concat_ws('; ',
   case when _m then 'monto_aprobado=' || coalesce({_amount('monto_aprobado')}, 'nan') end,
   case when _p then 'plazo_meses=' || coalesce(cast(plazo_meses as varchar), 'None') end,
   case when _t then 'tasa=' || cast(tasa_interes_mensual as varchar) end), credito_id from d_creditos where _m or _p or _t
 union all select 'DQ-4', 'raw_pagos', 'ERROR', 'monto_pago fuera de dominio: ' || coalesce({_amount('monto_pago')}, 'nan'), pago_id
   from c3_pagos where coalesce(monto_pago <= 0 or monto_pago >= 1e16, true)
 union all select 'DQ-5', 'raw_creditos', 'ERROR', concat_ws('; ', case when _f1 then 'fecha_solicitud inválida o nula' end,
   case when _f2 then 'fecha_desembolso (' || cast(fecha_desembolso as varchar) || ') < fecha_solicitud (' || cast(fecha_solicitud as varchar) || ')' end,
   case when _f3 then 'fecha_vencimiento (' || cast(fecha_vencimiento as varchar) || ') < fecha_desembolso (' || cast(fecha_desembolso as varchar) || ')' end),
   credito_id from f_creditos where _f1 or _f2 or _f3
 union all select 'DQ-5', 'raw_pagos', 'ERROR', 'fecha_pago inválida: ''None''', pago_id from c4_pagos where fecha_pago is null
 union all select 'DQ-6', 'raw_clientes', 'ERROR', 'cliente_id nulo o vacío', cliente_id from c3_clientes where cliente_id = ''
 union all select 'DQ-6', 'raw_clientes', 'ERROR', 'tipo_documento nulo o vacío', cliente_id from c3_clientes where tipo_documento = ''
 union all select 'DQ-6', 'raw_clientes', 'ERROR', 'nombres nulo o vacío', cliente_id from c3_clientes where nombres = ''
 union all select 'DQ-6', 'raw_creditos', 'ERROR', 'tasa_interes_mensual nula', credito_id from c5_creditos where tasa_interes_mensual is null
 union all select 'DQ-6', 'raw_pagos', 'ERROR', 'credito_id nulo o vacío', pago_id from c5_pagos where credito_id = ''
 union all select 'DQ-7', 'raw_clientes', 'WARNING', 'email duplicado: ' || email, cliente_id from v_clientes where flag_email_duplicado
 union all select 'DQ-7', 'raw_clientes', 'WARNING', 'numero_documento duplicado: ' || numero_documento, cliente_id from v_clientes where flag_doc_duplicado
 union all select 'DQ-7', 'raw_pagos', 'WARNING', 'referencia_transaccion duplicada: ' || referencia_transaccion, pago_id from v_pagos where flag_referencia_duplicada),
corte as (select max(d) as fecha from (select unnest([fecha_solicitud, fecha_desembolso, fecha_vencimiento]) as d from v_creditos
  union all select fecha_pago from v_pagos)),
m_creditos as (select cr.*, cl.cliente_id as _cl, cl.cliente_sk, cl.segmento from v_creditos cr
  left join v_clientes cl on cr.cliente_id = cl.cliente_id
  where fecha_solicitud between date '{START}' and date '{END}'),
f_credito as (select credito_id, cliente_id, cliente_sk, segmento,
  upper(producto[1]) || lower(producto[2:]) as producto, upper(canal[1]) || lower(canal[2:]) as canal,
  estado_credito as estado, fecha_solicitud,
  case when fecha_desembolso between date '{START}' and date '{END}' then fecha_desembolso end as fecha_desembolso,
  case when fecha_vencimiento between date '{START}' and date '{END}' then fecha_vencimiento end as fecha_vencimiento,
  cast(monto_aprobado as decimal(18,2)) as monto, cast(plazo_meses as integer) as plazo,
  cast(tasa_interes_mensual as decimal(8,4)) as tasa,
  case when estado_credito in ('Mora', 'Vencido') then cast(greatest(coalesce(corte.fecha - m.fecha_vencimiento, 0), 0) as integer) else 0 end as dias_mora,
  estado_credito = 'Activo' as es_activo, estado_credito = 'Mora' as es_mora
  from m_creditos m, corte where _cl is not null),
n_pagos as (select pg.*, m.cliente_sk, m.cliente_id, m.segmento from v_pagos pg
  left join m_creditos m on pg.credito_id = m.credito_id
  where fecha_pago between date '{START}' and date '{END}'),
f_pago as (select pago_id, credito_id, cliente_id, cliente_sk, segmento,
  case lower(metodo_pago) when 'pse' then 'PSE' when 'efecty' then 'Efecty' when 'transferencia' then 'Transferencia' else 'Tarjeta' end as metodo,
  case lower(metodo_pago) when 'efecty' then 'efectivo' when 'transferencia' then 'bancario' else 'digital' end as tipo,
  fecha_pago, cast(monto_pago as decimal(18,2)) as monto, estado_pago as estado, referencia_transaccion,
  flag_referencia_duplicada from n_pagos where cliente_sk is not null),
pascua(anio, dia) as (values (1995, date '1995-04-16'), (1996, date '1996-04-07'), (1997, date '1997-03-30'),
  (1998, date '1998-04-12'), (1999, date '1999-04-04'), (2000, date '2000-04-23')),
festivos as (select anio, dia from (
  select anio, unnest([make_date(anio, 1, 1), make_date(anio, 5, 1), make_date(anio, 7, 20), make_date(anio, 8, 7),
    make_date(anio, 12, 8), make_date(anio, 12, 25), dia - 3, dia - 2]) as dia from pascua
  union select anio, d + cast((8 - isodow(d)) % 7 as integer) as dia from (
    select anio, unnest([make_date(anio, 1, 6), make_date(anio, 3, 19), make_date(anio, 6, 29), make_date(anio, 8, 15),
      make_date(anio, 10, 12), make_date(anio, 11, 1), make_date(anio, 11, 11), dia + 39, dia + 60, dia + 68]) as d from pascua))),
calendario as (select cast(strftime(dia, '%Y%m%d') as integer) as tiempo_sk, dia as fecha, cast(year(dia) as smallint) as anio, cast(month(dia) as smallint) as mes,
  cast(day(dia) as smallint) as dia, cast(quarter(dia) as smallint) as trimestre, cast(week(dia) as smallint) as semana_anio,
  ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre', 'Noviembre', 'Diciembre'][month(dia)] as nombre_mes,
  ['Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado', 'Domingo'][isodow(dia)] as nombre_dia,
  isodow(dia) >= 6 as es_fin_semana, dia in (select festivos.dia from festivos) as es_festivo_co
  from (select cast(unnest(generate_series(date '{START}', date '{END}', interval 1 day)) as date) as dia)),
runs as ({fixtures.LEDGER_SQL.format(**_NAMES)})
"""


def _on_chain(last: str) -> str:
    return f"with {CHAIN}\n{last}"


def _errors(rule: str) -> str:
    return (f"select tabla_origen, severidad, motivo, clave from errores "
            f"where regla_id = '{rule}'")


_KEY = "cast(strftime({0}, '%Y%m%d') as integer)"
_APPROVED = "estado <> 'Rechazado'"
_WORSE = "es_mora or estado = 'Vencido'"


def _sum(column: str, where: str | None = None) -> str:
    clause = f" filter (where {where})" if where else ""
    return f"cast(coalesce(sum({column}){clause}, 0) as double)"


def _n(where: str) -> str:
    return f"count(*) filter (where {where})"


_LOAN_MEASURES = f"""
 cast(sum(monto) filter (where es_activo) as double) as cartera_vigente,
 nullif({_n('es_activo')}, 0) as num_creditos_activos,
 {_mean(f"sum(monto) filter (where {_APPROVED})", _n(_APPROVED))} as ticket_promedio,
 cast({_n('es_mora')} as double) * cast(100 as double) / count(*) as tasa_mora_pct,
 {_mean("sum(dias_mora) filter (where es_mora)", _n('es_mora'))} as dias_mora_promedio,
 cast({_n(_APPROVED)} as double) * cast(100 as double) / count(*) as tasa_aprobacion_pct"""
_PAY_MEASURES = f"""
 cast(sum(monto) filter (where estado = 'Exitoso') as double) as recaudo_total,
 cast({_n("estado = 'Fallido'")} as double) * cast(100 as double) / count(*) as tasa_fallo_pago_pct"""
_MEASURE_COLUMNS = """l.cartera_vigente, l.num_creditos_activos, l.ticket_promedio,
 coalesce(l.tasa_mora_pct, 0) as tasa_mora_pct, l.dias_mora_promedio, p.recaudo_total,
 coalesce(p.tasa_fallo_pago_pct, 0) as tasa_fallo_pago_pct,
 coalesce(l.tasa_aprobacion_pct, 0) as tasa_aprobacion_pct"""


def _measures_by(keys: list[str], loans: str, payments: str, grouping: str, extra: str = "") -> str:
    names = ", ".join(keys)
    names += ", nivel" if extra else ""
    both = ", ".join(f"coalesce(l.{k}, p.{k}) as {k}" for k in names.split(", "))
    same = " and ".join(f"l.{k} is not distinct from p.{k}" for k in names.split(", "))
    return _on_chain(f""", l as (select {', '.join(keys)}{extra},{_LOAN_MEASURES} from {loans} group by {grouping}),
 p as (select {', '.join(keys)}{extra},{_PAY_MEASURES} from {payments} group by {grouping})
 select {both}, {_MEASURE_COLUMNS} from l full join p on {same}""")


def _with_band(fact: str) -> str:
    return f"""(select f.*, case when ingresos_mensuales is null then 'Sin dato' when ingresos_mensuales < 5000000 then '< 5M'
 when ingresos_mensuales < 10000000 then '5M - 10M' when ingresos_mensuales < 20000000 then '10M - 20M' else '> 20M' end
 as rango_ingresos from {fact} f join v_clientes c on f.cliente_sk = c.cliente_sk)"""


# Declared constraints, written out from the data contract (fixed values): keys, columns that are
# never null, lengths, listed values, references.
_CLIENT_LENGTHS = """cliente_id 20, tipo_documento 10, numero_documento 50, nombres 200, apellidos 200, email 200,
 telefono 30, estado_cliente 20, ciudad 100, segmento 50"""
_DECLARED = {
    "stg_clientes": ("cliente_id", """cliente_id, tipo_documento, nombres, estado_cliente, flag_email_duplicado,
 flag_doc_duplicado, _ingested_at, _source_file""", _CLIENT_LENGTHS, {}, {}),
    "stg_creditos": ("credito_id", """credito_id, cliente_id, fecha_solicitud, monto_aprobado, plazo_meses,
 estado_credito, producto, canal, _ingested_at, _source_file""",
                     "credito_id 20, cliente_id 20, estado_credito 30, producto 100, canal 50", {}, {}),
    "stg_pagos": ("pago_id", """pago_id, credito_id, fecha_pago, monto_pago, metodo_pago, estado_pago,
 flag_referencia_duplicada, _ingested_at, _source_file""",
                  "pago_id 20, credito_id 20, metodo_pago 50, estado_pago 30, referencia_transaccion 100", {}, {}),
    "dim_tiempo": ("tiempo_sk, fecha", """fecha, anio, mes, dia, trimestre, semana_anio, nombre_mes, nombre_dia,
 es_fin_semana, es_festivo_co, _loaded_at""", "nombre_mes 20, nombre_dia 20", {}, {}),
    "dim_cliente": ("cliente_sk, cliente_id", """cliente_id, tipo_documento, nombres, estado_cliente,
 flag_email_duplicado, flag_doc_duplicado, _loaded_at""", _CLIENT_LENGTHS, {}, {}),
    "dim_producto": ("producto_sk, producto_id", "nombre, _loaded_at", "producto_id 30, nombre 100", {}, {}),
    "dim_canal": ("canal_sk, canal_id", "nombre, _loaded_at", "canal_id 20, nombre 50", {}, {}),
    "dim_estado_credito": ("estado_credito_sk, estado_id", "nombre, es_activo, es_mora, es_terminado, _loaded_at",
                           "estado_id 20, nombre 50", {}, {}),
    "dim_metodo_pago": ("metodo_pago_sk, metodo_id", "nombre, _loaded_at", "metodo_id 20, nombre 50, tipo 30", {}, {}),
    "fact_credito": ("fact_credito_sk, credito_id", """credito_id, cliente_sk, producto_sk, canal_sk,
 estado_credito_sk, tiempo_solicitud_sk, monto_aprobado, plazo_meses, dias_mora, _loaded_at""", "credito_id 20", {},
                     {"cliente_sk": "dim_cliente.cliente_sk", "producto_sk": "dim_producto.producto_sk",
                      "canal_sk": "dim_canal.canal_sk", "estado_credito_sk": "dim_estado_credito.estado_credito_sk",
                      "tiempo_solicitud_sk": "dim_tiempo.tiempo_sk", "tiempo_desembolso_sk": "dim_tiempo.tiempo_sk",
                      "tiempo_vencimiento_sk": "dim_tiempo.tiempo_sk"}),
    "fact_pago": ("fact_pago_sk, pago_id", """pago_id, credito_id, cliente_sk, metodo_pago_sk, tiempo_pago_sk,
 monto_pago, estado_pago, flag_referencia_duplicada, _loaded_at""",
                  "pago_id 20, credito_id 20, estado_pago 30, referencia_transaccion 100", {},
                  {"cliente_sk": "dim_cliente.cliente_sk", "metodo_pago_sk": "dim_metodo_pago.metodo_pago_sk",
                   "tiempo_pago_sk": "dim_tiempo.tiempo_sk"}),
    "dq_errors": ("", "run_id, regla_id, tabla_origen, severidad, motivo, payload_original, created_at",
                  "regla_id 10, tabla_origen 50, severidad 10", {"severidad": "'ERROR', 'WARNING'"}, {}),
    "etl_runs": ("run_id", "started_at, status", "status 10", {"status": "'RUNNING', 'SUCCESS', 'FAILED'"}, {}),
}


def _constraint_rows(tables: dict[str, str], only: tuple[str, ...] = ()) -> str:
    parts = []
    split = lambda text: [x.strip() for x in text.split(",") if x.strip()]
    for table in only or tables:
        keys, required, lengths, listed, references = _DECLARED[table]
        found = {}
        for k in split(keys):
            found[f"unique not null {k}"] = f"count(*) filter ({k} is null)"
            found[f"unique {k}"] = f"count({k}) - count(distinct {k})"
        for k in split(required):
            found[f"not null {k}"] = f"count(*) filter ({k} is null)"
        for k, size in (x.split() for x in split(lengths)):
            found[f"length {k} <= {size}"] = f"count(*) filter (length({k}) > {size})"
        for k, values in listed.items():
            found[f"check {k}"] = f"count(*) filter ({k} not in ({values}))"
        for k, (target, column) in ((k, r.split(".")) for k, r in references.items()):
            found[f"{k} -> {target}"] = f"count(*) filter ({k} not in (select {column} from {tables[target]}))"
        parts += [f"select '{table}' as tabla, '{name}' as restriccion, cast({count} as bigint) as violaciones"
                  f" from {tables[table]}" for name, count in found.items()]
    return _on_chain("\n union all ".join(parts))


def _stamped(source: str) -> str:
    return f"(select *, 1 as _ingested_at, 1 as _source_file, 1 as _loaded_at from {source})"


def _place(labels: str, column: str) -> str:
    return f"list_position([{', '.join(repr(x) for x in labels.split('/'))}], {column})"


def _seeds(key: str, id_: str, ids: str, names: str, rest: str = "") -> str:
    rows = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(zip(ids.split("/"), names.split("/")), 1))
    return f"(select *{rest}, 1 as _loaded_at from (values {rows}) t({key}, {id_}, nombre))"


_PRODUCTS, _CHANNELS = "Microcredito/Libre inversion/Capital trabajo/Consumo", "Aliado/Web/App"
_STATES, _METHODS = "Activo/Mora/Vencido/Pagado/Cancelado/Rechazado", "PSE/Efecty/Transferencia/Tarjeta"
_DAY = "cast(strftime({0}, '%Y%m%d') as integer)"
_AUDITED = {
    "stg_clientes": _stamped("v_clientes"), "stg_creditos": _stamped("v_creditos"), "stg_pagos": _stamped("v_pagos"),
    "dim_tiempo": _stamped("calendario"), "dim_cliente": _stamped("v_clientes"),
    "dim_producto": _seeds("producto_sk", "producto_id", "MICRO/LIBRE_INV/CAP_TRABAJO/CONSUMO", _PRODUCTS),
    "dim_canal": _seeds("canal_sk", "canal_id", "ALIADO/WEB/APP", _CHANNELS),
    "dim_estado_credito": _seeds("estado_credito_sk", "estado_id", _STATES.upper(), _STATES,
                                 ", nombre = 'Activo' as es_activo, nombre = 'Mora' as es_mora, false as es_terminado"),
    "dim_metodo_pago": _seeds("metodo_pago_sk", "metodo_id", _METHODS.upper(), _METHODS, ", 'digital' as tipo"),
    "fact_credito": _stamped(f"""(select row_number() over () as fact_credito_sk, credito_id, cliente_sk,
 {_place(_PRODUCTS, 'producto')} as producto_sk, {_place(_CHANNELS, 'canal')} as canal_sk,
 {_place(_STATES, 'estado')} as estado_credito_sk, {_DAY.format('fecha_solicitud')} as tiempo_solicitud_sk,
 {_DAY.format('fecha_desembolso')} as tiempo_desembolso_sk, {_DAY.format('fecha_vencimiento')} as tiempo_vencimiento_sk,
 monto as monto_aprobado, plazo as plazo_meses, dias_mora from f_credito)"""),
    "fact_pago": _stamped(f"""(select row_number() over () as fact_pago_sk, pago_id, credito_id, cliente_sk,
 {_place(_METHODS, 'metodo')} as metodo_pago_sk, {_DAY.format('fecha_pago')} as tiempo_pago_sk, monto as monto_pago,
 estado as estado_pago, referencia_transaccion, flag_referencia_duplicada from f_pago)"""),
    "dq_errors": "(select *, 1 as run_id, motivo as payload_original, 1 as created_at from errores)",
    "etl_runs": "(select 1 as run_id, 1 as started_at, 'SUCCESS' as status)",
}
_DIRTY = {**_AUDITED,
          "stg_clientes": "(select *, false as flag_email_duplicado, false as flag_doc_duplicado from "
                          + _stamped("t_clientes") + ")",
          "stg_creditos": _stamped("t_creditos"),
          "stg_pagos": "(select *, false as flag_referencia_duplicada from " + _stamped("t_pagos") + ")",
          "fact_credito": f"(select * replace (cliente_sk * 2 as cliente_sk) from {_AUDITED['fact_credito']})"}

_COLS_CLIENTES = """cliente_id, tipo_documento, numero_documento, nombres, apellidos, email, telefono,
 fecha_registro, estado_cliente, ciudad, segmento, fecha_nacimiento, ingresos_mensuales"""
_COLS_CREDITOS = """credito_id, cliente_id, fecha_solicitud, fecha_desembolso, monto_aprobado, plazo_meses,
 tasa_interes_mensual, estado_credito, producto, fecha_vencimiento, canal"""
_COLS_PAGOS = """pago_id, credito_id, fecha_pago, monto_pago, metodo_pago, estado_pago, referencia_transaccion"""

_RAW_CLIENTES = _COLS_CLIENTES
_SEGMENT_PRODUCT = "from f_credito where {0} group by segmento, producto"

_EXTREME_LOAN = fixtures.EXTREME_AMOUNT.format("credito_id", 3)
_EXTREME_TERM = fixtures.EXTREME_TERM.format("credito_id", 3)
_EXTREME_RATE = fixtures.EXTREME_RATE.format("credito_id", 3)

SQL: dict[str, str] = {
    "raw_roundtrip": _on_chain(f"""select 'clientes' as entidad,
  row_number() over (order by cast(substr(cliente_id, 2) as bigint)) as fila, md5(concat_ws('|', {_RAW_CLIENTES})) as huella from raw_clientes
 union all select 'creditos', row_number() over (order by _raw_id), md5(concat_ws('|', {_COLS_CREDITOS})) from raw_creditos
 union all select 'pagos', row_number() over (order by _o1, _o2, _o3, _o4), md5(concat_ws('|', {_COLS_PAGOS})) from raw_pagos"""),
    "cleanse_clientes": _on_chain(f"select {_COLS_CLIENTES}, _tipo_doc_valido, _estado_cliente_valido from t_clientes"),
    "cleanse_creditos": _on_chain(f"select {_COLS_CREDITOS}, _estado_credito_valido from t_creditos"),
    "cleanse_pagos": _on_chain(f"select {_COLS_PAGOS}, _estado_pago_valido from t_pagos"),
    "dq1_duplicates": _on_chain(_errors("DQ-1")),
    "dq2_orphans": _on_chain(_errors("DQ-2")),
    "dq3_catalog": _on_chain(_errors("DQ-3")),
    "dq4_domain": _on_chain(_errors("DQ-4")),
    "dq5_dates": _on_chain(_errors("DQ-5")),
    "dq6_not_null": _on_chain(_errors("DQ-6")),
    "dq7_flags": _on_chain("""select cliente_id as clave, 'flag_email_duplicado' as bandera, flag_email_duplicado as valor from v_clientes
 union all select cliente_id, 'flag_doc_duplicado', flag_doc_duplicado from v_clientes
 union all select pago_id, 'flag_referencia_duplicada', flag_referencia_duplicada from v_pagos"""),
    "dq_errors_detail": _on_chain("select regla_id, tabla_origen, severidad, motivo, clave from errores"),
    "dq_error_summary": _on_chain("""select regla_id, tabla_origen, severidad, count(*) as num_errores from errores
 group by regla_id, tabla_origen, severidad"""),
    "valid_clientes": _on_chain(f"select {_COLS_CLIENTES}, flag_email_duplicado, flag_doc_duplicado from v_clientes"),
    "valid_creditos": _on_chain(f"select * replace (cast(plazo_meses as integer) as plazo_meses) from (select {_COLS_CREDITOS} from v_creditos)"),
    "valid_pagos": _on_chain(f"select {_COLS_PAGOS}, flag_referencia_duplicada from v_pagos"),
    "dim_tiempo": _on_chain("""select c.tiempo_sk, c.fecha, c.anio, c.mes, c.dia, c.trimestre, c.semana_anio, c.nombre_mes, c.nombre_dia,
 c.es_fin_semana, c.es_festivo_co, count(f.credito_id) as num_creditos from calendario c
 left join f_credito f on f.fecha_solicitud = c.fecha group by all"""),
    "holidays": _on_chain("""select h.anio, h.dia as fecha, count(f.pago_id) as num_pagos from festivos h
 left join f_pago f on f.fecha_pago = h.dia group by h.anio, h.dia"""),
    "dim_seeds": _on_chain("""select d.dimension, cast(d.sk as bigint) as sk, d.id, d.nombre, d.detalle, count(f.nombre) as num_hechos from (values
 ('producto', 1, 'MICRO', 'Microcredito', ''), ('producto', 2, 'LIBRE_INV', 'Libre inversion', ''),
 ('producto', 3, 'CAP_TRABAJO', 'Capital trabajo', ''), ('producto', 4, 'CONSUMO', 'Consumo', ''),
 ('canal', 1, 'ALIADO', 'Aliado', ''), ('canal', 2, 'WEB', 'Web', ''), ('canal', 3, 'APP', 'App', ''),
 ('estado_credito', 1, 'ACTIVO', 'Activo', 'true/false/false'), ('estado_credito', 2, 'MORA', 'Mora', 'false/true/false'),
 ('estado_credito', 3, 'VENCIDO', 'Vencido', 'false/false/false'), ('estado_credito', 4, 'PAGADO', 'Pagado', 'false/false/true'),
 ('estado_credito', 5, 'CANCELADO', 'Cancelado', 'false/false/true'), ('estado_credito', 6, 'RECHAZADO', 'Rechazado', 'false/false/true'),
 ('metodo_pago', 1, 'PSE', 'PSE', 'digital'), ('metodo_pago', 2, 'EFECTY', 'Efecty', 'efectivo'),
 ('metodo_pago', 3, 'TRANSFERENCIA', 'Transferencia', 'bancario'), ('metodo_pago', 4, 'TARJETA', 'Tarjeta', 'digital'))
 d(dimension, sk, id, nombre, detalle)
 left join (select 'producto' as dimension, producto as nombre from f_credito union all select 'canal', canal from f_credito
  union all select 'estado_credito', estado from f_credito union all select 'metodo_pago', metodo from f_pago) f
 on d.dimension = f.dimension and d.nombre = f.nombre group by all"""),
    "dim_cliente": _on_chain(f"select cliente_sk, {_COLS_CLIENTES}, flag_email_duplicado, flag_doc_duplicado from v_clientes"),
    "fact_credito": _on_chain(f"""select credito_id, cliente_sk, producto, canal, estado, {_KEY.format('fecha_solicitud')} as tiempo_solicitud_sk,
 {_KEY.format('fecha_desembolso')} as tiempo_desembolso_sk, {_KEY.format('fecha_vencimiento')} as tiempo_vencimiento_sk,
 cast(monto as double) as monto_aprobado, plazo as plazo_meses, cast(tasa as double) as tasa_interes_mensual, dias_mora from f_credito"""),
    "fact_pago": _on_chain(f"""select pago_id, credito_id, cliente_sk, metodo as metodo_pago, {_KEY.format('fecha_pago')} as tiempo_pago_sk,
 cast(monto as double) as monto_pago, estado as estado_pago, referencia_transaccion, flag_referencia_duplicada from f_pago"""),
    "fact_key_sequences": _on_chain("""select 'fact_credito' as tabla, count(*) as filas, cast(1 as bigint) as primera, count(*) as ultima, count(*) as distintas from f_credito
 union all select 'fact_pago', count(*), 1, count(*), count(*) from f_pago
 union all select 'dim_cliente', count(*), 1, count(*), count(*) from v_clientes"""),
    "fact_key_order": _on_chain("""select 'fact_credito' as tabla, credito_id as clave,
 row_number() over (order by cast(substr(credito_id, 3) as bigint)) as sk from f_credito
 union all select 'fact_pago', f.pago_id, row_number() over (order by _o1, _o2, _o3, _o4)
 from f_pago f join v_pagos v on f.pago_id = v.pago_id"""),
    "dq4_extreme": _on_chain(f""", e_creditos as (select credito_id, cast(trunc(try_cast({_EXTREME_TERM} as double)) as bigint) as p,
  try_cast({_EXTREME_LOAN} as double) as m, try_cast({_EXTREME_RATE} as double) as t from t_creditos
  where _estado_credito_valido and lower(producto) in ('microcredito', 'libre inversion', 'capital trabajo', 'consumo')
  and lower(canal) in ('aliado', 'web', 'app')),
 e_pagos as (select pago_id, try_cast({_EXTREME_LOAN} as double) as m from t_pagos
  where _estado_pago_valido and lower(metodo_pago) in ('pse', 'efecty', 'transferencia', 'tarjeta'))
 select credito_id as clave, 'Valor fuera de dominio: ' || concat_ws('; ',
  case when m <= 0 or m >= 1e16 then 'monto_aprobado=' || cast(m as varchar) end,
  case when p <= 0 or p > 2147483647 then 'plazo_meses=' || cast(p as varchar) end,
  case when t < 0 or t > 10 then 'tasa=' || cast(t as varchar) end) as motivo from e_creditos
 where m <= 0 or m >= 1e16 or p <= 0 or p > 2147483647 or t < 0 or t > 10
 union all select pago_id, 'monto_pago fuera de dominio: ' || cast(m as varchar) from e_pagos where m <= 0 or m >= 1e16"""),
    "dq_error_payload": _on_chain(""", c as (
  select 'raw_clientes' as tabla, 'cliente_id' as campo, t.cliente_id as clave, _n, cast(t.fecha_registro as varchar) as fecha,
   trim(r.fecha_registro) as fecha_original, t.estado_cliente as estado, trim(r.estado_cliente) as estado_original
   from r_clientes t join raw_clientes r using (cliente_id)
  union all select 'raw_creditos', 'credito_id', t.credito_id, _n, cast(t.fecha_desembolso as varchar), trim(r.fecha_desembolso),
   t.estado_credito, trim(r.estado_credito) from r_creditos t join raw_creditos r on t._ord = r._raw_id
  union all select 'raw_pagos', 'pago_id', t.pago_id, _n, cast(t.fecha_pago as varchar), trim(r.fecha_pago), t.estado_pago,
   trim(r.estado_pago) from r_pagos t join raw_pagos r on t.pago_id = r.pago_id and t._o1 = r._o1 and t._o2 = r._o2
   and t._o3 = r._o3 and t._o4 = r._o4)
 select 'DQ-1' as regla_id, tabla as tabla_origen, campo || ' duplicado: ' || clave as motivo, clave, fecha, fecha_original,
  estado, estado_original from c where _n > 1
 union all select e.regla_id, e.tabla_origen, e.motivo, c.clave, c.fecha, c.fecha_original, c.estado, c.estado_original
 from errores e join c on e.tabla_origen = c.tabla and e.clave = c.clave and c._n = 1 where e.regla_id <> 'DQ-1'"""),
    "ledger_rerun": _on_chain("""select run_id, started_at + interval 365 days as started_at,
 case when cast(substr(run_id, 2) as int) % 2 = 1 then 'FAILED' else 'RUNNING' end as status,
 cast(null as bigint) as filas_raw_creditos,
 case when cast(substr(run_id, 2) as int) % 2 = 1 then 'otra falla' end as error_message from runs"""),
    "star_discards": _on_chain(f"""select 'fact_credito' as tabla, credito_id as clave, 'fecha fuera de calendario' as motivo from v_creditos
  where fecha_solicitud not between date '{START}' and date '{END}'
 union all select 'fact_credito', credito_id, 'llave subrogada nula' from m_creditos where _cl is null
 union all select 'fact_pago', pago_id, 'fecha fuera de calendario' from v_pagos where fecha_pago not between date '{START}' and date '{END}'
 union all select 'fact_pago', pago_id, 'llave subrogada nula' from n_pagos where cliente_sk is null"""),
    "cutoff_date": _on_chain("select fecha as fecha_corte from corte"),
    "cartera_vigente": _on_chain(f"""select segmento, producto, count(*) as num_creditos, {_sum('monto')} as monto_total,
 {_mean('sum(tasa)', 'count(tasa)')} as tasa_promedio, {_mean('sum(plazo)', 'count(*)')} as plazo_promedio_meses
 {_SEGMENT_PRODUCT.format('es_activo')}"""),
    "morosidad_producto": _on_chain(f"""select producto, count(*) as total_creditos, {_n('es_mora')} as creditos_mora,
 {_n("estado = 'Vencido'")} as creditos_vencidos, {_pct(_n('es_mora'), 'count(*)')} as tasa_mora_pct,
 {_mean('sum(dias_mora) filter (where es_mora)', _n('es_mora'))} as dias_mora_promedio from f_credito group by producto"""),
    "efectividad_canal": _on_chain(f"""select canal, count(*) as total_solicitudes, {_n(_APPROVED)} as aprobados,
 {_pct(_n(_APPROVED), 'count(*)')} as tasa_aprobacion_pct,
 {_mean(f'sum(monto) filter (where {_APPROVED})', _n(_APPROVED))} as ticket_promedio_aprobado from f_credito group by canal"""),
    "pagos_mensuales": _on_chain(f"""select c.anio, c.mes, c.nombre_mes, count(*) as total_transacciones,
 {_sum('monto', "estado = 'Exitoso'")} as monto_recaudado, {_n("estado = 'Fallido'")} as pagos_fallidos,
 {_n("estado = 'Reversado'")} as pagos_reversados, {_pct(_n("estado = 'Fallido'"), 'count(*)')} as tasa_fallo_pct,
 {_mean('sum(monto)', 'count(*)')} as monto_promedio_transaccion
 from f_pago join calendario c on fecha_pago = c.fecha group by c.anio, c.mes, c.nombre_mes"""),
    "cosecha_morosidad": _on_chain(f"""select cast(year(fecha_desembolso) as smallint) as anio_cosecha, cast(month(fecha_desembolso) as smallint) as mes_cosecha, producto,
 count(*) as total_creditos, {_n(_WORSE)} as creditos_deteriorados, {_pct(_n(_WORSE), 'count(*)')} as tasa_deterioro_pct,
 {_mean('sum(monto)', 'count(*)')} as monto_promedio from f_credito where fecha_desembolso is not null group by 1, 2, 3"""),
    "kpi_resumen": _on_chain(f"""select 1 as id, l.*, p.* from (select {_n('es_activo')} as cartera_activa_count,
 {_sum('monto', 'es_activo')} as cartera_vigente_monto, {_pct(_n('es_mora'), 'count(*)')} as tasa_mora_pct,
 {_mean_round(f"sum(monto) filter (where {_APPROVED})", _n(_APPROVED), 2, 0)} as ticket_promedio,
 {_pct(_n(_APPROVED), 'count(*)')} as tasa_aprobacion_pct from f_credito) l,
 (select {_sum('monto', "estado = 'Exitoso'")} as recaudo_total, {_pct(_n("estado = 'Fallido'"), 'count(*)')} as tasa_fallo_pago_pct from f_pago) p"""),
    "cliente_safe": _on_chain("""select cliente_sk, cliente_id, tipo_documento,
 case when length(numero_documento) > 4 then repeat('*', length(numero_documento) - 4) || right(numero_documento, 4) else numero_documento end as numero_documento,
 split_part(nombres, ' ', 1) || case when apellidos <> '' then ' ' || left(apellidos, 1) || '.' else '' end as nombre_display,
 case when email like '%@%' then left(email, 1) || repeat('*', greatest(strpos(email, '@') - 2, 0)) || substr(email, strpos(email, '@')) else email end as email,
 case when length(telefono) >= 4 then repeat('*', length(telefono) - 4) || right(telefono, 4) else telefono end as telefono,
 fecha_registro, estado_cliente, ciudad, segmento,
 case when ingresos_mensuales is null then 'Sin dato' when ingresos_mensuales < 5000000 then '< 5M'
  when ingresos_mensuales < 10000000 then '5M - 10M' when ingresos_mensuales < 20000000 then '10M - 20M' else '> 20M' end as rango_ingresos,
 flag_email_duplicado, flag_doc_duplicado from v_clientes"""),
    "q1_cartera_segmento_producto": _on_chain(f"""select segmento, producto, count(*) as num_creditos, {_sum('monto')} as monto_total,
 {_mean_round('sum(tasa)', 'count(tasa)', 4, 2)} as tasa_promedio, {_mean_round('sum(plazo)', 'count(*)', 0, 1)} as plazo_promedio
 {_SEGMENT_PRODUCT.format(_APPROVED)}"""),
    "q2_top_clientes": _on_chain(f"""select c.cliente_id, c.nombres || ' ' || coalesce(c.apellidos, '') as nombre_cliente, c.ciudad, c.segmento,
 count(*) as num_creditos, {_sum('monto')} as monto_total_desembolsado, {_mean_round('sum(tasa)', 'count(tasa)', 4, 2)} as tasa_promedio
 from f_credito f join v_clientes c on f.cliente_sk = c.cliente_sk where {_APPROVED}
 group by c.cliente_id, c.nombres, c.apellidos, c.ciudad, c.segmento, c.cliente_sk order by sum(monto) desc, c.cliente_id limit 10"""),
    "q3_desembolsos_mensuales": _on_chain(f"""select c.anio, c.mes, c.nombre_mes, count(*) as creditos_desembolsados, {_sum('monto')} as monto_total,
 {_mean_round('sum(monto)', 'count(*)', 2, 0)} as ticket_promedio from f_credito join calendario c on fecha_desembolso = c.fecha
 where {_APPROVED} and c.anio in (1996, 1997) group by c.anio, c.mes, c.nombre_mes"""),
    "q4_deterioro_producto_canal": _on_chain(f"""select producto, canal, count(*) as total_creditos, {_n('es_mora')} as en_mora,
 {_n("estado = 'Vencido'")} as vencidos, {_pct(_n(_WORSE), 'count(*)')} as tasa_deterioro_pct,
 coalesce({_mean_round('sum(dias_mora) filter (where es_mora)', _n('es_mora'), 0, 0)}, 0) as dias_mora_promedio
 from f_credito group by producto, canal"""),
    "q5_recaudo_metodo": _on_chain(f"""select metodo as metodo_pago, tipo, count(*) as total_transacciones,
 {_sum('monto', "estado = 'Exitoso'")} as monto_exitoso, {_sum('monto', "estado = 'Fallido'")} as monto_fallido,
 {_sum('monto', "estado = 'Reversado'")} as monto_reversado, {_pct(_n("estado = 'Exitoso'"), 'count(*)')} as tasa_exito_pct
 from f_pago group by metodo, tipo"""),
    "q6_clientes_multiples": _on_chain(f"""select c.cliente_id, c.nombres || ' ' || coalesce(c.apellidos, '') as nombre_cliente, c.segmento, c.ciudad,
 count(*) as total_creditos_vigentes, {_sum('monto')} as exposicion_total, {_sum('monto', 'es_mora')} as monto_en_mora,
 max(dias_mora) as max_dias_mora from f_credito f join v_clientes c on f.cliente_sk = c.cliente_sk
 where estado not in ('Rechazado', 'Cancelado', 'Pagado')
 group by c.cliente_id, c.nombres, c.apellidos, c.segmento, c.ciudad having count(*) > 1"""),
    "q7_cosecha": _on_chain(f"""select cast(year(fecha_desembolso) as smallint) as anio_cosecha, cast(month(fecha_desembolso) as smallint) as mes_cosecha, producto,
 count(*) as total_creditos, {_n(_WORSE)} as creditos_deteriorados, {_pct(_n(_WORSE), 'count(*)')} as tasa_deterioro_pct,
 {_mean_round('sum(monto)', 'count(*)', 2, 0)} as monto_promedio from f_credito where fecha_desembolso is not null group by 1, 2, 3"""),
    "run_health": _on_chain("""select run_id, started_at, finished_at, status,
 cast(round((epoch_us(finished_at) - epoch_us(started_at)) / 1000000) as bigint) as duracion_seg,
 filas_raw_clientes, filas_raw_creditos, filas_raw_pagos, filas_dq_errors, filas_fact_credito, filas_fact_pago, error_message
 from runs order by started_at desc, run_id limit 10"""),
    "latest_run": _on_chain(f"select run_id, status, {', '.join(COUNTS)} from runs order by started_at desc, run_id limit 1"),
    "run_errors": _on_chain("""select regla_id, tabla_origen, severidad, count(*) as num_errores,
 timestamp '2025-01-01 00:00:00' + to_seconds(min(length(motivo) + espera)) as primer_error,
 timestamp '2025-01-01 00:00:00' + to_seconds(max(length(motivo) + espera)) as ultimo_error
 from errores cross join (values ('R12', 0), ('R13', 3600)) h(run_id, espera)
 where run_id = (select run_id from runs order by started_at desc, run_id limit 1)
 group by regla_id, tabla_origen, severidad"""),
    "measures_total": _on_chain(f""", l as (select {_LOAN_MEASURES} from f_credito), p as (select {_PAY_MEASURES} from f_pago)
 select {_MEASURE_COLUMNS} from l, p"""),
    "measures_by_segment": _measures_by(["segmento"], "f_credito", "f_pago", "segmento"),
    "measures_by_city_active": _on_chain(f""", l as (select c.ciudad, f.producto, {_LOAN_MEASURES} from f_credito f
  join v_clientes c on f.cliente_sk = c.cliente_sk where canal = 'Web' group by c.ciudad, f.producto)
 select ciudad, producto, ticket_promedio, tasa_aprobacion_pct from l"""),
    "measures_by_income_band": _measures_by(
        ["rango_ingresos"], _with_band("f_credito"), _with_band("f_pago"), "rango_ingresos"),
    "measures_by_state": _on_chain(f"""select estado as estado_credito, cast(sum(monto) filter (where es_activo) as double) as cartera_vigente,
 nullif({_n('es_activo')}, 0) as num_creditos_activos,
 (select {_mean('sum(monto)', 'count(*)')} from f_credito where {_APPROVED}) as ticket_promedio,
 cast({_n('es_mora')} as double) * cast(100 as double) / count(*) as tasa_mora_pct,
 {_mean("sum(dias_mora) filter (where es_mora)", _n('es_mora'))} as dias_mora_promedio,
 cast((select count(*) from f_credito where {_APPROVED}) as double) * cast(100 as double) / count(*) as tasa_aprobacion_pct
 from f_credito group by estado"""),
    "measures_by_payment_state": _on_chain("""select estado as estado_pago,
 (select cast(sum(monto) as double) from f_pago where estado = 'Exitoso') as recaudo_total,
 cast((select count(*) from f_pago where estado = 'Fallido') as double) * cast(100 as double) / count(*) as tasa_fallo_pago_pct
 from f_pago group by estado"""),
    # A measure's own filter takes the place of a filter on its column; all others hold.
    "measures_filtered_state": _on_chain(f"""select producto,
 cast(sum(monto) filter (where es_activo and _state and not es_mora) as double) as cartera_vigente,
 nullif({_n('es_activo and _state and not es_mora')}, 0) as num_creditos_activos,
 {_mean(f"sum(monto) filter (where {_APPROVED} and not es_mora)", _n(f'{_APPROVED} and not es_mora'))} as ticket_promedio,
 coalesce(cast({_n('es_mora and _state')} as double) * cast(100 as double) / nullif({_n('_state and not es_mora')}, 0), 0) as tasa_mora_pct,
 {_mean("sum(dias_mora) filter (where es_mora and _state)", _n('es_mora and _state'))} as dias_mora_promedio,
 coalesce(cast({_n(f'{_APPROVED} and not es_mora')} as double) * cast(100 as double) / nullif({_n('_state and not es_mora')}, 0), 0) as tasa_aprobacion_pct
 from (select *, estado in ('Mora', 'Vencido', 'Rechazado') as _state from f_credito where canal <> 'App') group by producto"""),
    "measures_time_rollup": _measures_by(
        ["anio", "trimestre", "mes", "dia"],
        "(select f.*, c.anio, c.trimestre, c.mes, c.dia from f_credito f join calendario c on f.fecha_solicitud = c.fecha)",
        "(select f.*, c.anio, c.trimestre, c.mes, c.dia from f_pago f join calendario c on f.fecha_pago = c.fecha)",
        "rollup (anio, trimestre, mes, dia)",
        ", cast(bit_count(grouping(anio, trimestre, mes, dia)) as integer) as nivel"),
    "constraint_audit": _constraint_rows(_AUDITED),
    "constraint_audit_dirty": _constraint_rows(
        _DIRTY, ("stg_clientes", "stg_creditos", "stg_pagos", "fact_credito")),
    "pipeline_run": _on_chain("""select 'SUCCESS' as status, (select count(*) from raw_clientes) as filas_raw_clientes,
 (select count(*) from raw_creditos) as filas_raw_creditos, (select count(*) from raw_pagos) as filas_raw_pagos,
 (select count(*) from v_clientes) as filas_stg_clientes, (select count(*) from v_creditos) as filas_stg_creditos,
 (select count(*) from v_pagos) as filas_stg_pagos, (select count(*) from errores) as filas_dq_errors,
 (select count(*) from v_clientes) as filas_dim_cliente, (select count(*) from f_credito) as filas_fact_credito,
 (select count(*) from f_pago) as filas_fact_pago"""),
}
# Published tables hold what the warehouse holds, so they are checked by the same statements.
SQL["mart_refresh"] = SQL["cosecha_morosidad"]
SQL["pass_through_views"] = SQL["kpi_resumen"]
