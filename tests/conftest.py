import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent.parent))

from creditmart.model import ENTITIES, ORDER  # noqa: E402

TESTDATA = Path("/root/testdata")

BASE = {
    "clientes": dict(
        cliente_id="C0001", tipo_documento="CC", numero_documento="12345678", nombres="Test",
        apellidos="User", email="", telefono="3001234567", fecha_registro="2024-01-01",
        estado_cliente="Activo", ciudad="Bogota", segmento="Pyme", fecha_nacimiento="1990-01-01",
        ingresos_mensuales="5000000"),
    "creditos": dict(
        credito_id="CR00001", cliente_id="C0001", fecha_solicitud="2024-01-10",
        fecha_desembolso="2024-01-12", monto_aprobado="5000000", plazo_meses="12",
        tasa_interes_mensual="1.5", estado_credito="Activo", producto="Consumo",
        fecha_vencimiento="2025-01-10", canal="Web"),
    "pagos": dict(
        pago_id="P000001", credito_id="CR00001", fecha_pago="2024-03-01", monto_pago="500000",
        metodo_pago="PSE", estado_pago="Exitoso", referencia_transaccion=""),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("creditmart-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def entity_rows(entity: str, *overrides: dict) -> list[dict]:
    return [{**BASE[entity], **o} for o in overrides]


def raw_frame(spark, entity: str, rows: list[dict]):
    """Raw text rows in the given order."""
    names = ENTITIES[entity].columns
    data = [(*[r[n] for n in names], i) for i, r in enumerate(rows)]
    schema = ", ".join(f"{n} string" for n in names) + f", {ORDER} long"
    return (spark.createDataFrame(data, schema)
            .withColumns({"_ingested_at": F.lit("2025-01-01 00:00:00").cast("timestamp"),
                          "_source_file": F.lit(f"{entity}.csv")}))


def raw_frames(spark, clientes=({},), creditos=({},), pagos=({},)):
    return {name: raw_frame(spark, name, entity_rows(name, *rows))
            for name, rows in (("clientes", clientes), ("creditos", creditos), ("pagos", pagos))}
