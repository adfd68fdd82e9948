"""Every registered query of the subpackage over whole tables: against SQL, or a plain version."""

import hashlib
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute
from creditmart.llm import queries

SF = Path("/root/testdata/sf0.001")
TABLES = ["documents", "pages", "labels", "conversations", "embeddings", "benchmark"]
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("select doc_id, coalesce(text, '') from documents order by doc_id").fetchall())


def rows_of(spark, name):
    return queries.QUERIES[name](spark, str(SF)).collect()


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, str(SF))
    checked = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in checked.description]
    expected = sorted(tuple(str(r[names.index(c)]) for c in df.columns) for r in checked.fetchall())
    assert expected and sorted(tuple(map(str, r)) for r in df.collect()) == expected


def test_bpe(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in rows_of(spark, "op1_bpe")}
    assert got.keys() == texts.keys()
    for (i, text), e in zip(texts.items(), tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)):
        decoded = tokenizer.decode(e.ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(e.ids), sha(np.array(e.ids, "<u4").tobytes()), sha(decoded.encode()))


def test_fingerprints(spark, texts):
    hashed = {r.w: r.h % 2**64 for r in spark.createDataFrame(
        [(w,) for t in texts.values() for w in {x[i:i + 16] for x in brute.words(t) for i in range(0, len(x), 16)}],
        "w string").distinct().selectExpr("w", "xxhash64(w) as h").collect()}
    chosen = lambda t: brute.winnow([hashed.get(x[i:i + 16], 0) for x in brute.words(t)
                                     for i in range(0, len(x), 16)])
    got = {r.doc_id: r for r in rows_of(spark, "op4_fingerprints")}
    ids = list(texts)
    for place, i in enumerate(ids):
        text, following = texts[i], texts[ids[(place + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), sha(edited.encode()))
        if len(brute.words(text)) >= 4:
            assert got[i].fingerprint == ",".join(f"{h:x}:{p}" for h, p in chosen(text))
        if len(brute.words(text)) >= 4 and len(brute.words(following)) >= 4:
            own, other = ({h for h, _ in chosen(t)} for t in (text, following))
            assert got[i].near_next == pytest.approx(len(own & other) / len(own | other))


def test_suffix_dedup(spark, texts):
    got = {r.doc_id: r for r in rows_of(spark, "op6_suffix_dedup")}
    for (i, text), (kept, removed, spans) in zip(texts.items(), brute.repeats(texts.values())):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (
            len(text.encode()), removed, spans, sha(kept))


def check_pieces(rows, texts):
    """Each id in exactly one piece, sequences gapless and at most 2048; returns their lengths."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == texts.keys()
    for (i, text), e in zip(texts.items(), tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)):
        ids, at = np.array([*e.ids, 1], "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start:at].tobytes())
        assert at == len(ids)
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        lengths.append(at)
    assert max(lengths) <= 2048
    return lengths


def test_packing(spark, texts):
    lengths = check_pieces(rows_of(spark, "op9_packing"), texts)
    assert sum(n < 2048 for n in lengths) <= 1


def test_quality(spark):
    larger = SF.parent / "sf0.01"           # the smallest has eleven bad documents
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op10_quality"](spark, str(larger)).collect()}
    assert len(got) == spark.read.parquet(f"{larger}/documents.parquet").count()
    bad = [got[i].kept for i, (q, _) in labels.items() if q == 0]
    good = [got[i].kept for i, (q, t) in labels.items() if q == 1 and t == 0]
    assert sum(bad) <= 0.2 * len(bad) and sum(good) >= 0.95 * len(good)


def test_quality_rejects_bad_text(spark):
    """Nearly all bad text goes, and of clean text no more than the quantile says, with some room."""
    larger = SF.parent / "sf0.01"
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in queries.QUERIES["op10_quality"](spark, str(larger)).collect()}
    bad = [kept[i] for i, (q, _) in labels.items() if q == 0]
    good = [kept[i] for i, (q, t) in labels.items() if q == 1 and t == 0]
    assert sum(bad) <= 0.02 * len(bad) and sum(good) >= 0.98 * len(good)


def test_pipeline(spark, duck):
    """Stage by stage against plain versions, each on the rows the stage was given."""
    import corpus_pipeline

    docs, given = spark.read.parquet(f"{SF}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, str(SF))
        rows = result.collect()
        before = given if given is not None else {r.doc_id: r.text for r in docs.collect()}
        if name == "packing":
            check_pieces(rows, before)
            break
        assert result.columns == docs.columns
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows) and all(r.n_chars == len(r.text) for r in rows)
        ids = sorted(before)
        if name == "quality":
            kept = {r.doc_id for r in rows_of(spark, "op10_quality") if r.kept}
            assert after == {i: before[i] for i in kept} and len(kept) > 0.7 * len(before)
        elif name == "lines":
            cleaned = brute.clean_lines(before)
            assert after == {i: t for i, t in cleaned.items() if t == before[i] or t.strip(" ")}
        elif name == "similar":
            found, sizes = brute.components([before[i] for i in ids])
            assert after == {i: before[i] for place, i in enumerate(ids)
                             if found[place] == place or not sizes[place]}
        elif name == "repeats":
            assert after == {i: kept.decode("utf-8", "ignore") for i, (kept, _, _) in
                             zip(ids, brute.repeats(before[i] for i in ids))}
        docs, given = spark.createDataFrame([tuple(r) for r in rows], result.schema), after
