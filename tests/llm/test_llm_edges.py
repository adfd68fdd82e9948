"""Nulls, empty and very long texts, ties, repeated rows, empty tables, columns with clashing names."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from creditmart.llm import bpe, chat_format, fingerprints, packing, quality, suffix_dedup, warc
from creditmart.llm.exact_dedup import exact_dedup
from creditmart.llm.jaccard_join import jaccard_components
from creditmart.llm.line_dedup import line_dedup
from creditmart.llm.tables import Scratch
from creditmart.operators.lookup import JoinLimits
from test_llm_queries import check_pieces

CLASHES = ["_hash", "_id", "_h", "_row", "_text", "_doc", "_lines", "_drop", "_key", "kept", "n", "cls",
           "gram", "anchor", "seg", "spans", "ids", "term", "leaf", "form", "pos", "drop", "size", "first",
           "n_lines", "n_dropped", "held", "fits", "next", "own", "_shared", "a b", "x.y"]
random.seed(7)
WORD = ["".join(random.choice("abcdefg") for _ in range(random.randint(2, 9))) for _ in range(300)]
PROSE = " ".join(random.choice(WORD) for _ in range(120))


def varied(text, n):
    words = text.split(" ")
    for i in range(n):
        words[i * len(words) // max(n, 1)] = f"other{i}"
    return " ".join(words)


MESSY = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "o n e"), (7, PROSE), (8, PROSE),
    (8, PROSE), (9, varied(PROSE, 1)), (10, varied(PROSE, 2)), (11, varied(PROSE, 30)), (None, PROSE),
    (None, "nobody"), (12, PROSE.upper() + " "), (13, "x" * 5000), (14, "é" * 700 + "ü"), (15, "ü" + "é" * 700),
    (16, "ab" * 900), (17, "\x00 \u2028 \U0001F600 <|endoftext|>"), (18, PROSE * 40),
    (19, "Page 1 of 9\nsome own text here"), (20, "Page 2 of 9\nanother own text there"),
    (21, "Page 3 of 9\n\nPage 4 of 9\r\nthird own text"), (22, "a b c d\na b c e\na b c d"),
    (23, "a b c d"), (24, "a b c d\n" + "word " * 3), (8, "other text under a known id"),
]


def frame(spark, rows=MESSY, clashes=True):
    df = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if clashes else df


def texts():
    return [t or "" for _, t in MESSY]


OPERATORS = {
    "exact": exact_dedup, "lines": line_dedup, "jaccard": jaccard_components,
    "repeats": suffix_dedup.remove_repeats, "fingerprints": fingerprints.edited_fingerprints,
    "prints": fingerprints.fingerprints,
    "bpe": lambda d: bpe.decode(bpe.encode(d, public_tokenizers.path("byte_bpe_50k.json")),
                                public_tokenizers.path("byte_bpe_50k.json")),
    "packing": lambda d: packing.pack_documents(d, public_tokenizers.path("word_bpe_49k.json")),
    "quality": lambda d: quality.classify(d, d.sparkSession.createDataFrame(
        [], "doc_id long, quality int, toxic int")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](frame(spark, [])).collect() == []


def test_exact(spark):
    got = sorted((r.doc_id or 99, r.keep_id or 99, r.group_size, r.kept)
                 for r in exact_dedup(frame(spark)).collect())
    plain = ["".join(brute.words(t)) for t in texts()]
    expected = []
    for (i, _), p in zip(MESSY, plain):
        group = [(-len(t), j is None, j) for (j, _), t, q in zip(MESSY, texts(), plain) if p == q]
        first = min(group, key=lambda g: (g[0], g[1], g[2] or 0))[2]
        expected.append((i or 99, first or 99, len(group), i == first))
    assert got == sorted(expected)


def test_exact_is_alike_at_every_size(spark, monkeypatch):
    from creditmart.llm import exact_dedup as module
    docs = frame(spark, [*MESSY, *[(900 + i, "a group of copies") for i in range(50)]])
    answers = lambda **k: sorted(map(str, exact_dedup(docs, **k).collect()))
    small, digests = answers(), answers(all_digests=True)
    assert any("text_sha256=None" in r for r in small) and not any("text_sha256=None" in r for r in digests)
    monkeypatch.setattr(module, "fits", lambda *_: False)
    assert answers() == small and answers(all_digests=True) == digests


def test_jaccard(spark):
    got = sorted((r.doc_id or 99, r.n_shingles, r.component_id or 99) for r in jaccard_components(frame(spark)).collect())
    order = sorted(range(len(MESSY)), key=lambda k: (MESSY[k][0] is None, MESSY[k][0] or 0))
    found, sizes = brute.components([texts()[k] for k in order])
    ids = [MESSY[k][0] or 99 for k in order]
    assert got == sorted((i, n, ids[root] if n else i) for i, n, root in zip(ids, sizes, found))


def test_jaccard_of_a_large_group_with_no_centre(spark):
    """Copies with edits at different places: some pairs link and some do not."""
    rng = random.Random(3)
    base, rows = PROSE.split(" "), []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randint(0, 6)):
            words[at] = rng.choice(WORD)
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(rng.choice(WORD) for _ in range(60)) + " " + " ".join(base[:40]))
             for i in range(40)]
    found, _ = brute.components([t for _, t in rows])
    got = {r.doc_id: r.component_id for r in jaccard_components(frame(spark, rows)).collect()}
    assert got == {i: rows[root][0] for (i, _), root in zip(rows, found)}


@pytest.mark.parametrize("crowded", [20_000, 1])
def test_repeats(spark, crowded):
    """Also with every anchor split by content."""
    got = suffix_dedup.remove_repeats(frame(spark), crowded=crowded, block_bytes=4096)
    assert set(CLASHES) - {"kept"} <= set(got.columns)
    got = sorted((r.doc_id or 99, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect())
    assert got == sorted((i or 99, len(t.encode()), gone, spans, kept) for (i, _), t, (kept, gone, spans) in
                         zip(MESSY, texts(), brute.repeats(texts())))


def test_a_text_longer_than_a_part(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 300)
    long = " ".join(random.choice(WORD) for _ in range(500))
    given = [long.encode(), (long[700:1200] + "!").encode(), long[:100].encode()]
    found = {}
    for held in suffix_dedup._chunks(given, 200):
        data = b"".join(part for _, _, part in held)
        ends = np.cumsum([len(part) for _, _, part in held])
        for a, b, h in zip(*suffix_dedup.segments(data, np.r_[0, ends])):
            for at in range(a, b - 199):
                assert found.setdefault(data[at:at + 200], h) == h     # equal strings, equal anchors
    assert found.keys() == {g[i:i + 200] for g in given for i in range(len(g) - 199)}


def test_lines(spark):
    unique = [r for k, r in enumerate(MESSY) if r[0] is not None and r not in MESSY[:k] and "under a known" not in (r[1] or "")]
    rows = line_dedup(frame(spark, unique))
    assert rows.columns == [c for c in frame(spark).columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    cleaned = brute.clean_lines(dict(unique))
    got = {r.doc_id: r.text for r in rows.collect()}
    assert {i: t or "" for i, t in got.items()} == cleaned and got[1] is None
    assert cleaned[20] == "another own text there"
    assert len(line_dedup(frame(spark)).collect()) == len(MESSY)


FAMILIES = ["Share this article with your friends on Facebook", "Share this article written by P{} Doe today",
            "Share this article if you like Q{} much", "Share this article because K{} told me so", "Share",
            "Share this article when all of V{} sleeps", "Share this article since no one else W{}",
            "Share this article before A{} takes it down", "Share this article or B{} will be sad"]


def test_lines_of_a_leaf_with_many_templates(spark, monkeypatch):
    from creditmart.llm import line_dedup as module
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i))  # noqa: E731  a digit is a field of itself
    docs = {i * 10 + k: f"own {name(i * 10 + k)} text\n" + line.format(name(i)) for k, line in enumerate(FAMILIES)
            for i in range(7 + (k == 0))}
    docs[1000] = "Share this article with nobody at all please"      # like no other
    frame_ = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for size in (module.BROADCAST_BYTES, 0):                    # broadcast, then shuffled
        monkeypatch.setattr(module, "BROADCAST_BYTES", size)
        rows = line_dedup(frame_).collect()
        assert {r.doc_id: r.text for r in rows} == brute.clean_lines(docs)
        dropped = {k: sum(r.n_dropped for r in rows if r.doc_id % 10 == k and r.doc_id < 1000) for k in range(len(FAMILIES))}
        assert all(n >= 6 for n in dropped.values()) and docs[1000] in [r.text for r in rows]


def test_lines_meet_every_template_of_a_leaf(spark, monkeypatch):
    """Forms that come after many templates and part early still belong together, where most positions agree."""
    from creditmart.llm import line_dedup as module
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))  # noqa: E731  a digit is a field of itself
    common = [" ".join(["We all know", *[f"{word(k)}{p}" for p in "uvwxyzt"]]) for k in range(10, 22)]
    late = ["We all know {} is on sale here today".format(w) for w in ("bread", "cheese", "butter")]
    docs = {100 * k + i: f"own {word(100 * k + i)} text\n{line}" for k, line in enumerate(common) for i in range(3)}
    docs |= {5000 + i: f"own {word(5000 + i)} text\n{line}" for i, line in enumerate(late)}
    for batch in (module.BATCH, 2):
        monkeypatch.setattr(module, "BATCH", batch)
        monkeypatch.setattr(module, "MOST", batch)
        rows = line_dedup(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
        assert {r.doc_id: r.text for r in rows} == brute.clean_lines(docs)
        assert {r.doc_id for r in rows if r.n_dropped and r.doc_id >= 5000} == {5001, 5002}


def test_bpe_and_decode(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = bpe.decode(bpe.encode(frame(spark), path), path).collect()
    ids = lambda t: np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert sorted((r.doc_id or 99, bytes(r.ids), r.text) for r in got) == sorted(
        (i or 99, ids(t), t) for (i, _), t in zip(MESSY, texts()))


def test_bpe_on_odd_strings():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, pairs, rng = Tokenizer.from_file(path), bpe.BytePairs(path), random.Random(1)
    odd = [chr(c) for c in (*range(0x180), 0x558, 0x2009, 0x2028, 0x3000, 0x4E2D, 0x661, 0x1F600, 0x3FC3C)]
    for k in range(3000):
        text = "".join(rng.choice(odd if rng.random() < 0.5 else "  abthe'sre'll\n\t12") for _ in range(rng.randint(0, 30)))
        text += "<|endoftext|>x" if k % 7 == 0 else "a" * 60 if k % 11 == 0 else ""
        encoded = tokenizer.encode(text, add_special_tokens=False)
        assert pairs.encode(text) == np.array(encoded.ids, "<u4").tobytes()
        assert pairs.decode(pairs.encode(text)) == text
    assert pairs.decode(np.array([pairs.whole["\xc3"]], "<u4").tobytes()) == "\ufffd"


def test_packing(spark):
    rows = list({i: (i, t) for i, t in MESSY}.values())
    got = packing.pack_documents(frame(spark, rows), public_tokenizers.path("word_bpe_49k.json")).collect()
    check_pieces(got, {i: t or "" for i, t in rows})
    everything = packing.pack_documents(frame(spark), public_tokenizers.path("word_bpe_49k.json"))
    assert sum(r.start == 0 for r in everything.collect()) == len(MESSY)


def test_packing_remembers_pieces_of_plain_texts():
    """Words that differ in case or signs are worked out once; all texts get the library's ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    known, tokenizer = packing.Words(path), packing.Words(path).tokenizer
    plain = ["The the THE, the.", "it's 'S x'll ''s\nÉtait--été (ÉTÉ)!? 12a3", "  a \n\n b_c~ ", ""]
    mixed = ["the \u0130 \u03a3\u03a3 \u212a", "a\tb <|endoftext|>The <| x", "naïve 日本語's the\r\n", "<|ENDOFTEXT|>"]
    ids = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in plain + mixed]
    for _ in range(2):
        assert known.encode_all(plain + mixed, b"x") == [i + b"x" for i in ids]
    for few in ([], [""], ["", " \n"], mixed[:1], ["<|endoftext|>", ""], plain[:1] * 3):
        assert known.encode_all(few) == [known.encode(t) for t in few]
    known = packing.Words(path)
    known.encode_all(plain[:1])
    assert set(known) == {"", "the", ",", "."}


def test_packing_brings_neighbours_together():
    topics = [np.arange(40, dtype="<u2") + 100 * k for k in range(5)]
    rng = np.random.default_rng(0)
    ids = [rng.permutation(topics[k % 5]) for k in range(50)]
    idf = np.full(packing.TERMS, 1.0)
    out = packing.Sequences(0, 400)
    packing._fill(packing.Block(ids, idf, 40.0), ids, list(range(50)), out)
    order = [piece[0] for piece in out.pieces]
    assert sorted(order) == list(range(50))
    assert sum(a % 5 != b % 5 for a, b in zip(order, order[1:])) == 4


def test_packing_ranks_a_window_by_its_seed():
    """The third document shares most with the second, but nothing with the seed."""
    seed, near = [*range(10, 20)] * 2, [*range(10, 16), *range(100, 114)]
    drift, other = [*range(100, 114), *range(300, 306)], [*range(10, 14), *range(200, 216)]
    ids = [np.array(d, "<u2") for d in (seed, near, drift, other)]
    out = packing.Sequences(0, 100)
    packing._fill(packing.Block(ids, np.full(packing.TERMS, 1.0), 20.0), ids, ["seed", "near", "drift", "other"], out)
    assert [p[0] for p in out.pieces] == ["seed", "near", "other", "drift"]


def test_fingerprints(spark):
    rows = fingerprints.edited_fingerprints(frame(spark)).collect()
    assert len(rows) == len(MESSY)
    order = sorted(MESSY, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    expected = []
    for (i, t), (_, following) in zip(order, [*order[1:], order[0]]):
        t, following = t or "", following or ""
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        expected.append((i or 99, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r.doc_id or 99, r.n_chars, r.edited_sha256) for r in rows) == sorted(expected)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    prints = {r.doc_id: r for r in rows}
    assert prints[7].fingerprint == prints[9].fingerprint.split("!")[0] or prints[9].near_next > 0.5
    assert prints[1].fingerprint == prints[2].fingerprint == prints[3].fingerprint == ""
    assert fingerprints.edited_fingerprints(frame(spark, [(5, PROSE)])).first().near_next == 1.0


def test_model_by_definition(spark):
    given = [(b"the cat sat on the mat", True), (b"the cats sat", True), (b"zzz the dog", False), (b"", True),
             ("é the".encode(), False)]
    docs = spark.createDataFrame([(t.decode(), f) for t, f in given], "text string, fits boolean")
    scratch = Scratch(spark)
    counts = scratch.save(quality.count_grams(docs, 4), "counts").df
    got = {r.gram: r.bits for r in quality.gram_scores(counts, scratch, 4).collect()}
    model = brute.KneserNey([t for t, f in given if f], 4)
    seen = {(bytes(3) + t)[i:i + 4] for t, _ in given for i in range(len(t))}
    assert got.keys() == {int.from_bytes(g, "big") for g in seen}
    for gram in seen:
        assert 2 ** -got[int.from_bytes(gram, "big")] == pytest.approx(model.p(gram))
    for context in (b"the", b"zzz", b"\0\0\0"):
        assert sum(model.p(context + bytes([c])) for c in range(256)) == pytest.approx(1)


def test_model_in_shards(spark, monkeypatch):
    monkeypatch.setattr(quality, "CHUNK_BYTES", quality.CHUNK_BYTES)
    docs = spark.createDataFrame([(i, t or "", True) for i, t in MESSY if i], "doc_id long, text string, fits boolean")
    scratch = Scratch(spark)
    counts = scratch.save(quality.count_grams(docs), "counts")
    scores = scratch.save(quality.gram_scores(counts.df, scratch), "scores").df
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1))       # rows that repeat
    whole = quality.score(docs, scores, counts.rows, Scratch(spark))
    monkeypatch.setattr(quality, "SHARD_ROWS", 300)
    first, second = ([g for chunk in quality._chunks([b"", PROSE.encode() * 9, b"a"], 5) for g in chunk[0]]
                     for quality.CHUNK_BYTES in (1 << 20, 100))
    assert first == second and len(first) == 9 * len(PROSE) + 1
    parts = quality.score(docs, scores, counts.rows, Scratch(spark))
    bits = lambda df: sorted((r.doc_id, r.n_bytes, round(r.bits, 6)) for r in df.collect())
    assert bits(parts) == bits(whole) and len(bits(parts)) == docs.count()


def test_quality(spark):
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, None), (9, 0, 0), (10, 1, 1), (None, 1, 0), (11, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.classify(frame(spark), labels).collect()
    assert len(rows) == len(MESSY) and all(r.kept for r in rows if not r.perplexity)


def test_warc(spark, monkeypatch):
    pages = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "http://c/\r\nX: y", ""),
             (5, "http://d/", "WARC/1.1\r\n\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n"),
             (5, "http://d/", "WARC/1.1\r\n\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n"),
             (6, "http://e/", "é\r\n\r\n" * 9), (7, "http://f/", "y" * 200_000), (None, "http://g/", "alone"),
             (None, "http://h/", "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns(
        {c: F.lit("clash") for c in ("digest", "uid", "n", "first", "page")})
    folder = f"{Scratch(spark).path}/archives"
    warc.write_archives(df, folder)
    captures = warc.assemble(warc.read_records(spark, folder)).collect()
    assert len(captures) == len(pages) == len({c.response.record_id for c in captures})
    by_url = {c.response.target_uri: c for c in captures}
    assert bytes(by_url["http://e/"].response.payload) == ("é\r\n\r\n" * 9).encode()
    assert by_url["http://a/"].response.kind == by_url["http://h/"].response.kind == "revisit"
    assert by_url["http://a/"].response.refers_to == by_url["http://b/"].response.record_id
    assert by_url["http://c/%0D%0AX: y"].response.payload_bytes == 0 and None in by_url
    assert all(c.request and len(c.metadata) == 1 for c in captures)
    records = Scratch(spark).save(warc.read_records(spark, folder, with_payload=False), "records").df
    read = warc.page_table(warc.assemble(records)).collect()
    shuffled = warc.page_table(warc.assemble(records), JoinLimits(broadcast_bytes=-1, rows_per_piece=1))
    assert sorted(map(str, read)) == sorted(map(str, shuffled.collect())) and len(read) == len(pages)
    table = {r.page_id: r for r in read if r.page_id is not None}
    assert table[3].record_type == "revisit" and table[3].refers_to == 4 and table[3].payload_bytes == 0
    assert table[1].payload_digest == table[2].payload_digest and table[1].payload_bytes == 4
    assert table[7].payload_bytes == 200_000
    with pytest.raises(ValueError, match="cut short"):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(warc, "COPIES", 3)
    repeated = spark.createDataFrame([(1, "u", "z")] * 10 + [(2, "u", "z"), (3, None, "w" * 30_000)], df.columns[:3])
    warc.write_archives(repeated, many := f"{Scratch(spark).path}/many")
    records = Scratch(spark).save(warc.read_records(spark, many), "records").df
    rows = warc.page_table(warc.assemble(records)).groupBy("page_id", "record_type", "refers_to").count().collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "revisit", 2, 10), (2, "response", None, 1), (3, "response", None, 1)]
    empty = f"{Scratch(spark).path}/none"
    warc.write_archives(df.limit(0), empty)
    assert warc.assemble(warc.read_records(spark, empty)).count() == 0


def test_chat(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", "x" * 9000),
            (1, 3, "user", "\\l <|turn|> [INST]\\"), (1, 4, "assistant", "\\b</s><|end|>\n"), (1, 4, "assistant", ""),
            (2, 0, None, "hi"), (2, 0, None, "hi"), (2, None, "odd\nrole<", "last"), (None, 1, "assistant", "nobody"),
            (3, 1, "user", "q"), (3, 2, "system", "late"), (3, 3, "assistant", "é😀")]
    rows += [(4, i, ("user", "assistant")[i % 2], f"turn {i} " * 20) for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("clash") for c in ("window_id", "_start", "_at", "formatted", "_turns")})
    windows = chat_format.format_conversations(df)
    got = {}
    for r in sorted(chat_format.read_back(windows).collect(), key=lambda r: (r.conv_id or 0, r.window_id)):
        turns, targets = got.setdefault(r.conv_id, ([], []))
        turns += [(t.role, t.text) for t in r.turns]
        targets += r.targets
    for conv in (1, 2, None, 3, 4):
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is None, r[0], r[1] or "", r[2] or ""))
        assert got[conv][0] == [(role or "", text or "") for _, role, text in own]
        assert got[conv][1] == [text or "" for _, role, text in own if role == "assistant"]
    sizes = [(r.n_tokens, r.n_turns, r.formatted) for r in windows.where("conv_id = 4").collect()]
    assert all(n <= chat_format.BUDGET - chat_format.HISTORY or turns == 1 for n, turns, _ in sizes)
    assert sum("<|seen|>" in text for *_, text in sizes) == len(sizes) - 1
    assert chat_format.format_conversations(df.limit(0)).collect() == []


def test_similar_stage_keeps_unlike_texts_of_one_id(spark):
    from creditmart.llm import stages
    w, v = PROSE, "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, w), (1, v), (2, w), (3, v + " thirteen"), (3, v + " thirteen"), (None, w), (4, ""), (4, None), (4, ""),
            (None, "a b c d e f g h"), (5, "x y z u v w"), (5, "x y z u v w")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "more") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, _group string")
    kept = stages.similar_filter(spark, docs, "")
    assert kept.columns == stages.COLUMNS
    got = sorted((r.doc_id or 99, r.text or "") for r in kept.collect())
    linked = [(3, v + " thirteen")] if len(v.split()) < 8 else []
    assert got == sorted([(1, w), (1, v), (4, ""), (4, ""), (4, ""), (99, "a b c d e f g h"),
                          (5, "x y z u v w")] + linked)
    assert stages.similar_filter(spark, docs.limit(0), "").collect() == []


def test_line_stage_drops_what_only_holds_white_space(spark):
    from creditmart.llm import stages
    line = "all rights of this page are reserved"
    rows = [(i, f"\t{i}\n{line}\n" if i < 2 else f"\t\n{line}\n ") for i in range(5)] + [(9, None), (9, ""), (10, " \t")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id, r.text or "") for r in stages.line_filter(spark, docs, "").collect())
    assert [i for i, _ in got] == [0, 1, 9, 9, 10] and line in got[0][1] and line not in got[1][1]
    assert stages.line_filter(spark, docs.limit(0), "").collect() == []
