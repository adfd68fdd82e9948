r"""Conversations as training windows under a token budget, cut between turns.

Prefix sums of turn tokens place the turns on a line that is cut into cells of one window's fresh
budget. Turns that lie inside a cell share a window; a turn across a cell's edge has a window of
its own. No window's fresh part exceeds its budget, except where one turn alone does: turns are
never cut. A later window first repeats the system turn and the last turns that fit the history
budget; repeated turns carry another mark and no loss. So each turn is fresh exactly once.

Template, for a fresh and a repeated turn (control strings are fixed values)::

    <|turn|>role\ntext<|end|>        <|seen|>role\ntext<|end|>

Inside roles and texts ``\`` ``<`` ``[`` become ``\b`` ``\l`` ``\o`` (and a line break in a role
``\n``), so that no control string of this or another chat template survives in a text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.tables import text_of

FRESH, SEEN, END = "<|turn|>", "<|seen|>", "<|end|>"
ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("[", "\\o")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "\\n")]
BUDGET, HISTORY, LEAST_FRESH = 2048, 512, 256


def _replaced(text: Column, pairs) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escaped(text: Column, pairs=ESCAPES) -> Column:
    return _replaced(text, pairs)


def unescaped(text: Column, pairs=ESCAPES) -> Column:
    # The backslash comes back last: before that, each one starts a pair.
    return _replaced(text, [(code, plain) for plain, code in reversed(pairs)])


def turn_tokens(text: Column) -> Column:
    """Tokens of a turn: a quarter of its bytes, and four for its marks."""
    return F.ceil(F.octet_length(text) / 4).cast("long") + 4


def _piece(mark: str, role: Column, text: Column) -> Column:
    return F.concat(F.lit(mark), role, F.lit("\n"), text, F.lit(END))


def format_conversations(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                         tokens=turn_tokens, target_role: str = "assistant") -> DataFrame:
    """Windows ``conv_id, window_id, formatted, loss_spans, n_turns, n_tokens``.

    Takes ``conv_id, turn, role, text``; other columns are ignored. Turns are ordered by turn (null
    last), then role, then text; repeated rows are turns of their own. Null texts and roles are
    empty, and rows with a null conversation are one conversation. Only a system turn at the start
    of a conversation is retained; elsewhere it is an ordinary turn. ``loss_spans`` are start and
    length in code points of ``formatted``, of each fresh target's escaped text (also an empty
    one). The fresh budget is what system turn and history leave, 256 tokens at least.
    ``n_tokens`` counts the fresh turns. An empty table gives no windows.
    """
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_last(), "role", "text")
    sums = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = rows.select("conv_id", "turn", text_of("role").alias("role"),
                        text_of("text").alias("text"))
    turns = turns.withColumns({"_tokens": F.greatest(F.lit(1), tokens(F.col("text"))),
                               "_role": escaped(F.col("role"), ROLE_ESCAPES),
                               "_text": escaped(F.col("text"))})
    turns = turns.withColumn("_length", F.char_length(_piece(FRESH, F.col("_role"), F.col("_text"))))
    system = F.col("role") == "system"
    turns = turns.select(
        "conv_id", "role", "_role", "_text", "_tokens",
        (F.sum("_length").over(sums) - F.col("_length")).alias("_at"),
        ((F.row_number().over(order) == 1) & system).alias("_system"),
        F.coalesce(F.first(F.when(system, F.col("_tokens"))).over(sums), F.lit(0)).alias("_head"),
        F.first(F.when(system, F.col("_text"))).over(sums).alias("_head_text"),
        F.sum("_tokens").over(sums).alias("_end"))
    fresh = F.greatest(F.lit(budget - history) - F.col("_head"), F.lit(LEAST_FRESH))
    start = F.col("_end") - F.col("_tokens") - F.col("_head")
    cell = F.floor(start / fresh)
    across = F.floor((F.col("_end") - F.col("_head") - 1) / fresh) != cell
    turns = turns.withColumns({"_start": start, "window_id": F.when(
        F.col("_system"), F.lit(0)).otherwise(2 * cell + across.cast("int")).cast("long")})
    by_start = Window.partitionBy("conv_id").orderBy("_start")
    seen = F.when(~F.col("_system"), _piece(SEEN, F.col("_role"), F.col("_text")))
    opens = ~F.lag("window_id").over(by_start).eqNullSafe(F.col("window_id"))
    repeated = F.collect_list(seen).over(by_start.rangeBetween(-history, -1))
    header = F.concat(
        F.coalesce(F.when(F.col("_system"), F.lit(""))
                   .otherwise(_piece(SEEN, F.lit("system"), F.col("_head_text"))), F.lit("")),
        F.array_join(repeated, ""))
    turns = turns.select(
        "conv_id", "window_id", F.when(opens, header).alias("_header"), "_tokens",
        F.struct(F.col("_start").alias("start"), F.col("_at").alias("at"),
                 _piece(FRESH, F.col("_role"), F.col("_text")).alias("piece"),
                 (F.col("role") == target_role).alias("target"),
                 (F.char_length("_role") + len(FRESH) + 1).alias("skip"),
                 F.char_length("_text").alias("length")).alias("_turn"))
    windows = turns.groupBy("conv_id", "window_id").agg(
        F.sort_array(F.collect_list("_turn")).alias("_turns"), F.max("_header").alias("_header"),
        F.sum("_tokens").alias("n_tokens"))
    shift = F.char_length("_header") - F.col("_turns")[0]["at"]
    return windows.select(
        "conv_id", "window_id",
        F.concat(F.col("_header"), F.array_join(F.col("_turns.piece"), "")).alias("formatted"),
        F.transform(F.filter("_turns", lambda t: t["target"]), lambda t: F.struct(
            (t["at"] + t["skip"] + shift).alias("start"),
            t["length"].cast("long").alias("length"))).alias("loss_spans"),
        F.size("_turns").cast("long").alias("n_turns"), "n_tokens")


def read_back(windows: DataFrame) -> DataFrame:
    """Per window, its fresh turns (``turns``: role and text) and ``targets``, the texts under loss."""
    body = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda _, i: i > 0)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        skip = F.char_length(role) + 1
        text = F.substr(piece, skip + 1, F.char_length(piece) - skip - len(END))
        return F.struct(unescaped(role, ROLE_ESCAPES).alias("role"), unescaped(text).alias("text"))

    target = lambda s: unescaped(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return windows.select("conv_id", "window_id", "formatted",
                          F.transform(body, turn).alias("turns"),
                          F.transform("loss_spans", target).alias("targets"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows in order."""
    parts = read_back(windows).select("conv_id", F.struct(
        "window_id",
        F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("loss"), F.size("turns").alias("n"),
        F.char_length("formatted").alias("chars")).alias("part"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("p"))
    loss = F.array_join("p.loss", "")
    total = lambda field: F.aggregate(field, F.lit(0).cast("long"), lambda a, x: a + x)
    return whole.select("conv_id", total("p.n").alias("n_turns"),
                        F.sha2(F.array_join("p.turns", ""), 256).alias("turns_sha256"),
                        F.char_length(loss).cast("long").alias("loss_chars"),
                        F.sha2(loss, 256).alias("loss_sha256"),
                        total("p.chars").alias("formatted_chars"))
