"""Line deduplication by log templates, parsed with a tree of fixed depth.

A line descends by its number of tokens and its leading tokens to a leaf, with every token that
holds a digit taken as a variable field. A leaf has a list of templates. The commonest form is the
first; forms that agree with it in most positions belong to it and differ in its variable fields. Of
the rest the commonest is the next, and so on, until every form of the leaf belongs to the first
template that it agrees with. Lists have no limit: they are drawn up by batches of the commonest forms
left, of bounded size, and all other forms of a leaf meet each batch as rows of their own. A template
that recurs in several documents is boilerplate: its first line stays and all others are dropped.

Only keys and hashes of lines are grouped and joined. Texts of forms are fetched only for leaves
that recur in documents and hold several forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.tables import BROADCAST_BYTES, Scratch, text_of, with_size

DEPTH = 3               # leading tokens on the way to a leaf
BATCH, MOST = 32, 512   # forms of a leaf that its list is drawn up from at a time: at first, and later on
BATCH_TOKENS = 1 << 16  # and their tokens
TOKEN_TIMES = 4         # memory of a text as an array of tokens
MIN_DOCS = 3            # documents in which a recurring template is found
MIN_TOKENS = 1          # blank lines are left alone
AGREE = 0.7             # share of positions in which a form agrees with its template
FIELD = "<*>"
SPACE = r"[\x20\x09\x0B\x0C\x0D]"
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def _lines(docs: DataFrame) -> DataFrame:
    """The lines with their masked form; ``docs`` has doc_id, _hash, text."""
    lines = docs.select("doc_id", "_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", VARIABLE, F.lit(FIELD))).otherwise(F.col("line"))
    tokens = F.filter(F.split(masked, SPACE + "+", -1), lambda t: t != "")
    return lines.select("doc_id", "_hash", "pos", tokens.alias("tokens"))


def _keyed(lines: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    size = F.size("tokens")
    return lines.where(size >= min_tokens).select(
        "doc_id", "_hash", "pos", "tokens",
        F.xxhash64(size, F.slice("tokens", 1, depth)).alias("leaf"),
        F.xxhash64("tokens").alias("form"))


def _agrees(tokens: Column, seed: Column, agree: float) -> Column:
    """Whether two forms of one leaf have the same token in enough positions."""
    same = F.size(F.filter(F.zip_with(tokens, seed, lambda a, b: a == b), lambda same: same))
    return same >= agree * F.size(tokens)


def _seeds(left: DataFrame, batch: int, agree: float) -> DataFrame:
    """``leaf, seeds``: the templates among the ``batch`` commonest forms left of each leaf, in order."""
    rank = F.row_number().over(Window.partitionBy("leaf").orderBy(F.col("n").desc(), "tokens", "form"))
    few = F.greatest(F.lit(1), F.floor(F.lit(BATCH_TOKENS) / F.greatest(F.size("tokens"), F.lit(1))))
    tops = left.withColumn("rank", rank).where(F.col("rank") <= batch).where(F.col("rank") <= few)
    forms = tops.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("rank", "tokens", "form"))).alias("forms"))
    listed = F.reduce("forms", F.slice("forms", 1, 1), lambda seeds, x: F.when(
        F.exists(seeds, lambda s: _agrees(x["tokens"], s["tokens"], agree)), seeds).otherwise(
        F.concat(seeds, F.array(x))))
    return forms.select("leaf", listed.alias("seeds")).withColumn(
        "_text", F.array_join(F.flatten(F.col("seeds.tokens")), " "))      # to tell its size


def _templates(texts: DataFrame, agree: float, scratch: Scratch) -> DataFrame:
    """``leaf, form, template`` of forms that share a leaf; ``texts`` has leaf, form, tokens, n.

    Every step settles the commonest forms left of a leaf and all that agree with a template among
    them, so the steps end, and a form gets the first template that it agrees with.
    """
    left, taken, step, batch = texts, None, 1, BATCH
    while True:
        seeds = scratch.save(_seeds(left, batch, agree), f"seeds{step}", key="_text")
        if not seeds.rows:
            break
        known = seeds.df.drop("_text")
        known = F.broadcast(known) if TOKEN_TIMES * seeds.lookup_bytes <= BROADCAST_BYTES else known
        first = F.filter("seeds", lambda s: _agrees(F.col("tokens"), s["tokens"], agree))
        judged = scratch.save(left.join(known, "leaf").select(
            "leaf", "form", "tokens", "n", F.get(first, F.lit(0))["form"].alias("template")), f"judged{step}").df
        part = judged.where("template is not null").select("leaf", "form", "template")
        taken = part if taken is None else taken.unionByName(part)
        left = judged.where("template is null").select("leaf", "form", "tokens", "n")
        step, batch = step + 1, min(2 * batch, MOST)
    return texts.select("leaf", "form", F.col("form").alias("template")).limit(0) if taken is None else taken


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS,
                    min_tokens: int = MIN_TOKENS, agree: float = AGREE) -> DataFrame:
    """``doc_id, _hash, drop``: the positions of lines to drop, per document that has any."""
    scratch = Scratch(docs.sparkSession)
    where = ["leaf", "form"]
    lines = scratch.save(_keyed(_lines(docs), depth, min_tokens).drop("tokens"), "lines").df
    in_docs = lambda df, *key: (  # noqa: E731  documents are counted once per key, before any key meets
        df.groupBy(*key, "doc_id", "_hash").agg(F.min("pos").alias("pos")).groupBy(*key).agg(
            F.count(F.lit(1)).alias("docs"), F.min(F.struct(
                F.col("doc_id").isNull().alias("none"), "doc_id", "_hash", "pos")).alias("first")))
    leaves = scratch.save(in_docs(lines, "leaf").where(F.col("docs") >= min_docs).select("leaf"),
                          "leaves")
    lines = scratch.save(lines.join(with_size(leaves), "leaf"), "recurring").df
    forms = (lines.groupBy(*where).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "_hash", "pos")).alias("at")))
    forms = scratch.save(forms, "forms").df
    mixed = forms.groupBy("leaf").agg(F.count(F.lit(1)).alias("forms")).where("forms > 1")
    wanted = scratch.save(forms.join(mixed.select("leaf"), "leaf"), "mixed")
    # Texts of one line of each form, from the documents that hold those lines.
    holders = scratch.save(wanted.df.select(F.col("at.doc_id").alias("_id"),
                                            F.col("at._hash").alias("_h")).distinct(), "holders")
    held = docs.join(with_size(holders), F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.col("_hash") == F.col("_h")), "left_semi")
    texts = (_keyed(_lines(held), depth, min_tokens).join(with_size(wanted), where)
             .groupBy(*where).agg(F.first("tokens").alias("tokens"), F.first("n").alias("n")))
    texts = scratch.save(texts, "texts").df
    templates = scratch.save(_templates(texts, agree, scratch), "templates")
    lines = lines.join(with_size(templates), where, "left").withColumn(
        "template", F.coalesce("template", "form"))
    common = scratch.save(in_docs(lines, "leaf", "template").where(F.col("docs") >= min_docs)
                          .drop("docs"), "common")
    dropped = lines.join(with_size(common), ["leaf", "template"]).where(~(
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_hash") == F.col("first._hash"))
        & (F.col("pos") == F.col("first.pos"))))
    return dropped.groupBy("doc_id", "_hash").agg(F.collect_set("pos").alias("drop"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **settings) -> DataFrame:
    """``docs`` with ``text_col`` cleaned, and ``n_lines`` and ``n_dropped``; one row per row.

    Lines end at a line feed and are compared token by token, tokens ending at white space. The
    first line of a recurring template, by id (null last), then position, stays. A null text counts
    as empty and comes back as null; blank lines are left alone. Rows that repeat an id and
    its text are one document and get the same answer. Extra columns are carried along, except
    ``n_lines`` and ``n_dropped``, which are replaced. An empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession)
    text = text_of(text_col)
    short = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_hash"),
                        text.alias("text"))
    drops = scratch.save(recurring_lines(short, **settings).select(
        F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), F.col("drop").alias("_drop")),
        "drops")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(id_col).alias("_doc"), text.alias("_text"))
    rows = rows.withColumn("_lines", F.split("_text", "\n", -1))
    rows = rows.join(with_size(drops, row_bytes=256), F.col("_doc").eqNullSafe(F.col("_id"))
                     & (F.xxhash64("_text") == F.col("_h")), "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    kept = F.array_join(F.transform(places, lambda i: F.get(F.col("_lines"), i)), "\n")
    column = lambda c: F.col("_row").getField(c)
    cleaned = F.when(F.col("_drop").isNull(), column(text_col)).otherwise(kept)
    made = {"n_lines": F.size("_lines").cast("long"),
            "n_dropped": F.coalesce(F.size("_drop"), F.lit(0)).cast("long")}
    return rows.select(*[cleaned.alias(c) if c == text_col else column(c).alias(c)
                         for c in docs.columns if c not in made],
                       *[value.alias(c) for c, value in made.items()])
