"""What keeps work and memory in proportion to the rows."""

import re
from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__ as registry
from conftest import TESTDATA
from creditmart.functions import parsing, text
from creditmart.llm import packing, tables
from creditmart.model import CLIENTES
from creditmart.operators import constraints
from creditmart.operators.lookup import JoinLimits
from creditmart.plans.warehouse import Warehouse
from creditmart.sources import fixtures
from creditmart.sources.csv_source import extract, land
from creditmart.sources.tables import Scratch


def test_extreme_domain_works_out_each_verdict_once(spark):
    """Readings serve many checks; a filter on the verdict below them would repeat them for each."""
    plan = registry.queries()["dq4_extreme"](spark, str(TESTDATA / "sf0.001"))._jdf.queryExecution().optimizedPlan()
    filters = [line for line in plan.toString().splitlines() if "Filter " in line]
    assert filters and all(len(line) < 200 for line in filters)


def test_sources_and_landed_rows_are_written_compressed(spark, tmp_path):
    paths = registry.write_sources(spark, str(TESTDATA / "sf0.001"))
    scratch = Scratch(spark)
    for name, df in extract(spark, paths).items():
        files = [f for f in Path(paths[name]).iterdir() if f.name.startswith("part-")]
        assert files and all(f.suffix == ".gz" for f in files)
        stored = land(df, str(tmp_path / name), scratch)
        assert all(".zstd." in f.name for f in (tmp_path / name).iterdir() if f.name.startswith("part-"))
        ids = [r[0] for r in stored.df.select("_raw_id").collect()]
        assert sorted(ids) == list(range(1, stored.rows + 1))


def test_packing_drops_the_vocabulary_before_the_index(spark, monkeypatch):
    """A worker that fills windows has no use for the words it knew when it made tokens."""
    named = []
    monkeypatch.setattr(packing, "frugal", lambda name, work: named.append(name) or tables.frugal(name, work))
    docs = spark.createDataFrame([(1, "one two three"), (2, "two three"), (3, None)], "doc_id long, text string")
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.pack_documents(docs, path).count() == 3
    packing.words(path)
    list(tables.frugal(named[0], iter)(iter(())))
    assert packing.words.cache_info().currsize == 1
    for index in named[1:]:
        packing.words(path)
        list(tables.frugal(index, iter)(iter(())))
        assert packing.words.cache_info().currsize == 0


def test_packing_remembers_words_and_pieces_in_one_place():
    import public_tokenizers
    from creditmart.llm.packing import Words
    words, text = Words(public_tokenizers.path("word_bpe_49k.json")), "Harbour harbour. harbour, 'll \"harbour's\" I'll -'s x1 1"
    ids = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert [list(memoryview(words.encode(text)).cast("H")) for _ in range(2)] == [ids, ids]
    assert {"harbour", ".", "'s", "1"} <= words.keys() and not hasattr(words, "pieces")
    for piece in list(words):
        assert words[piece] == words._word(piece)


def test_stored_tables_are_compressed(spark, tmp_path):
    from creditmart.sources.tables import Scratch, TableStore
    df = spark.range(10)
    Scratch(spark, str(tmp_path / "scratch")).save(df, "numbers")
    store = TableStore(spark, str(tmp_path / "store"))
    store.write("dwh", "R1", "numbers", df)
    store.append_run("dq", "errors", "R1", df)
    files = [f.name for f in tmp_path.rglob("part-*.parquet") if "_historial" not in str(f)]
    assert len(files) >= 3 and all(name.endswith(".zstd.parquet") for name in files)


def test_each_error_body_is_read_once(spark):
    plan = registry.queries()["dq_error_payload"](spark, str(TESTDATA / "sf0.001"))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert "get_json_object" not in text and text.count("from_json(") == 3      # one for each entity


def test_whole_numbered_keys_meet_as_numbers(spark):
    loans = spark.createDataFrame([(1, "a", 7), (1, "a", 8), (2, None, 9)], "fact_credito_sk long, credito_id string, "
                                  "cliente_sk int").withColumns({c: F.lit(1) for c in (
                                      "producto_sk", "canal_sk", "estado_credito_sk", "tiempo_solicitud_sk",
                                      "tiempo_desembolso_sk", "tiempo_vencimiento_sk", "monto_aprobado",
                                      "plazo_meses", "dias_mora", "_loaded_at")})
    def customers(kind):
        fields = {c: F.lit("x") for c in (*CLIENTES.columns, *CLIENTES.flags, "_loaded_at")}
        return spark.createDataFrame([(7,), (8,)], "cliente_sk long").withColumns(
            {**fields, "cliente_id": F.col("cliente_sk").cast("string"), "cliente_sk": F.col("cliente_sk").cast(kind)})

    for kind in ("long", "string"):         # a reference to texts meets them as text
        report = constraints.audit({"fact_credito": loans, "dim_cliente": customers(kind)})
        assert re.search(r"hashpartitioning\(c#\d+, num#\d+L, key#\d+", report._jdf.queryExecution().executedPlan().toString())
        assert {(r.tabla, r.restriccion): r.violaciones for r in report.collect() if r.violaciones} == {
            ("fact_credito", "unique fact_credito_sk"): 1, ("fact_credito", "unique credito_id"): 1,
            ("fact_credito", "unique not null credito_id"): 1, ("fact_credito", "not null credito_id"): 1,
            ("fact_credito", "cliente_sk -> dim_cliente"): 1}


def test_text_without_blanks_at_its_ends_is_not_trimmed(spark):
    """Trimming goes through a text sign by sign; most texts have nothing to drop."""
    texts = ["", " ", "a", " a", "a ", "a b", "a\n", "\na", "a\nb", "ab\r\n", "\x85", "a ", "\xa0a", "é", "é ", "\x1fa", "!", "~", "\x7f", "a\x00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    stripped = df.select("t", text.strip(F.col("t")).alias("s"), parsing.year_first(F.col("t")))
    plan = stripped._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN RLIKE" in plan and "translate(" not in plan
    assert [(r.t, r.s) for r in stripped.collect()] == [(t, t and t.strip(text.WHITESPACE)) for t in texts]


def test_cleansing_with_shuffled_lookups_can_be_compiled(spark, monkeypatch):
    """The largest stage, where loans are also dealt by hash, stays below the 8000 bytes that the JVM compiles."""
    sizes, save = {}, Scratch.save
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")

    def measured(self, df, name, key=None, **settings):
        code = debug.codegenString(df._jdf.queryExecution().executedPlan())
        sizes[name] = max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code)), default=0)
        return save(self, df, name, key, **settings)

    monkeypatch.setattr(Scratch, "save", measured)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        Warehouse(spark, fixtures.Landed(spark, str(TESTDATA / "sf0.001")), start=fixtures.START, end=fixtures.END,
                  limits=JoinLimits(broadcast_bytes=-1)).build()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {"creditos", "pagos"} <= sizes.keys() and max(sizes.values()) < 8000, sizes
