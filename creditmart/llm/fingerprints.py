"""Document fingerprints by winnowing: the smallest gram hash of every window, with its position.

A text is a sequence of words, a long word a sequence of 16-character pieces. Every run of GRAM
words is hashed, rolling from runs of half its length; of every WINDOW neighbouring grams the
smallest hash is chosen, the rightmost of equal ones. Two texts that share GRAM + WINDOW - 1 words
in a row therefore share a chosen gram, wherever the run stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.tables import text_of

WORD = r"[^\x20\x09-\x0D]{1,16}"
GRAM, WINDOW = 4, 8                 # powers of two, as both roll by doubling
POSITION_BITS = 24
POSITIONS = (1 << POSITION_BITS) - 1
HASH_BITS = (1 << (63 - POSITION_BITS)) - 1
BUCKET_BYTES = 64 << 20


def _rotated(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _rolled(df: DataFrame, column: str, length: int, joined) -> DataFrame:
    """``column`` with each element joined with those that follow, over ``length`` of them."""
    def once(step: int) -> Column:
        return F.transform(column, lambda x, i: joined(x, F.get(F.col(column), i + step), step))

    step = 1
    while step < length:
        df = df.withColumn(column, once(step))      # a projection each: arrays are computed once
        step *= 2
    return df


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the chosen grams in order, hash in the upper bits and position below.

    A text of fewer than GRAM words is one gram; one of no words has an empty fingerprint. A gram's
    position is the index of its first word, counted down in the lower 24 bits so that the
    rightmost of equal hashes is smallest; beyond 16 million words positions start over.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    df = df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_words", F.size(out))
    # Past the end a gram is joined with nothing; such grams count only in very short texts.
    df = _rolled(df, out, GRAM, lambda x, y, step: F.coalesce(
        _rotated(x, 7 * step).bitwiseXOR(y), x))
    grams = F.greatest(F.col("_words") - (GRAM - 1), F.least(F.col("_words"), F.lit(1)))
    df = df.withColumn(out, F.transform(F.slice(out, 1, grams), lambda x, i: F.shiftleft(
        x.bitwiseAND(HASH_BITS), POSITION_BITS).bitwiseOR(
            F.lit(POSITIONS) - i.cast("long").bitwiseAND(POSITIONS))))
    df = df.withColumn("_words", F.size(out))
    df = _rolled(df, out, WINDOW, lambda x, y, step: F.least(x, y))
    windows = F.greatest(F.col("_words") - (WINDOW - 1), F.least(F.col("_words"), F.lit(1)))
    return df.withColumn(out, F.array_distinct(F.slice(out, 1, windows))).drop("_words")


def hashes(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda x: F.shiftright(x, POSITION_BITS))


def positions(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda x: F.lit(POSITIONS) - x.bitwiseAND(POSITIONS))


def printed(fingerprint: Column) -> Column:
    """As text: hash in hex, colon and position, with commas between."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, POSITION_BITS))), F.lit(":"),
        (F.lit(POSITIONS) - x.bitwiseAND(POSITIONS)).cast("string"))), ",")


def likeness(a: str, b: str) -> Column:
    """Share of the distinct hashes of either that both have; 1 for two empty fingerprints."""
    both = F.size(F.array_intersect(hashes(F.col(a)), hashes(F.col(b))))
    either = F.size(F.array_union(hashes(F.col(a)), hashes(F.col(b))))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, hashes, positions`` of every row; a null text counts as empty, and rows that repeat
    an id are fingerprinted each. Other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    return with_fingerprint(rows, "_text", "_grams").select(
        "doc_id", hashes(F.col("_grams")).alias("hashes"),
        positions(F.col("_grams")).alias("positions"))


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``next``: the given columns of the row that follows by doc_id, then text.

    After the last row comes the first; rows with a null id come last. Rows are dealt into ranges
    of ids, and the first of each range is also sent to the range before it, so each range finds
    its followers alone.
    """
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5],
                                        max(10_000, 10 * n))).first()[0] or []
    cuts = F.lit(sorted(set(cuts))).cast("array<long>") if cuts else F.array().cast("array<long>")
    steps = F.lit([1 << s for s in range(n.bit_length(), -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        F.get(cuts, low + step - 1) <= F.col("doc_id"), low + step).otherwise(low))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(n + 1)).otherwise(found)
    firsts = sorted(rows.select("doc_id", bucket.alias("b")).groupBy("b")
                    .agg(F.min("doc_id")).collect())       # a row per range
    if not firsts:
        return rows.withColumn("next", F.struct(*columns))
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    ids = [f for f in before if f is not None]
    goes_back = F.get(F.lit([before[f] for f in ids] or [0]),
                      F.array_position(F.lit(ids or [0]).cast("array<long>"),
                                       F.col("doc_id")).cast("int") - 1)
    goes_back = F.when(F.col("doc_id").isNull(), F.lit(before.get(None))).when(
        F.array_contains(F.lit(ids or [0]).cast("array<long>"), F.col("doc_id")), goes_back)
    places = F.filter(F.array(F.struct(bucket.alias("b"), F.lit(0).alias("copy")),
                              F.struct(goes_back.alias("b"), F.lit(1).alias("copy"))),
                      lambda p: p["b"].isNotNull())
    dealt = rows.withColumn("_place", F.explode(places))
    order = Window.partitionBy("_place.b").orderBy(
        F.col("_place.copy"), F.col("doc_id").asc_nulls_last(), "text")
    return (dealt.withColumn("next", F.lead(F.struct(*columns)).over(order))
            .where("_place.copy = 0").drop("_place"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document with the fingerprints of itself and of its text with a new second half.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The last half of the code points, rounded down, gives way to as many from the start of the next
    document, or all it has.
    """
    rows = with_fingerprint(docs.select("doc_id", text_of("text").alias("text")), "text", "own")
    rows = with_next(rows, ["text", "own"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.char_length("text") - half),
                      F.substr("next.text", F.lit(1), half))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "own",
                       F.col("next.own").alias("following"), edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_fingerprint(rows, "edited", "changed")
    return rows.select("doc_id", "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"),
                       printed(F.col("changed")).alias("edited_fingerprint"),
                       likeness("own", "changed").alias("near_edited"),
                       likeness("own", "following").alias("near_next"))
