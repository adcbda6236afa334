"""Chat formatting into budgeted windows, in DataFrame operations.

The turns of a conversation, in order of (turn, role, text), are laid out by prefix sums of
their tokens and cut into spans of whole turns, each formatted as one window: the system turn
(the first turn, if its role is system), turns before the span of at most ``history`` tokens,
then the span. The loss mask covers the assistant texts of the span only, so every target
counts once and repeated ones are masked.

A span takes the turns that start within one stride of tokens, a stride being half of what the
budget leaves beside history and system turn; a turn longer than a stride ends its span, and
stands in a span of its own. So a window keeps to the budget unless a single turn, or the system
turn, does not fit; it is then ``over_budget`` and whole all the same.

Texts are escaped so that they hold no control string: ``~`` becomes ``~0``, ``<`` ``~1`` and
``[`` ``~2``; a line break in a role becomes ``~3``. A turn reads <s>role, line break, text, </s>
and a line break.

At scale: prefix sums go over blocks of 256 turn numbers and then over the blocks' sums, and
history is found by equality of strides, so a conversation with a third of all turns is spread.

Defined results: null text or role is empty; null turns come first; ties are ordered by role and
text, equal rows are two turns; a null conv_id is a conversation; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlake.llm.common import stage

ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "~3"))
OPEN, CLOSE = "<s>", "</s>\n"
#: Turn numbers of a block.
BLOCK = 256
#: Tokens a turn has beside its text.
TURN_TOKENS = 4


def escape(x: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda y, p: F.replace(y, F.lit(p[0]), F.lit(p[1])), pairs, x)


def unescape(x: Column) -> Column:
    return reduce(lambda y, p: F.replace(y, F.lit(p[1]), F.lit(p[0])), reversed(ROLE_ESCAPES), x)


def count_tokens(text: Column) -> Column:
    """Words and marks."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]"))


def _placed(conversations: DataFrame, tokens) -> DataFrame:
    """Turns with their number (idx) and the tokens before them (p), by two-level prefix sums."""
    turns = conversations.select(
        "conv_id",
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("c"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumn("tokens", tokens(F.col("text")).cast("long") + TURN_TOKENS).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    sums = turns.groupBy("c", "block").agg(F.sum("tokens").alias("block_tokens"), F.count(F.lit(1)).alias("block_turns"))
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "c", "block", F.coalesce(F.sum("block_tokens").over(earlier), F.lit(0)).alias("p0"), F.coalesce(F.sum("block_turns").over(earlier), F.lit(0)).alias("i0")
    )
    ordered = Window.partitionBy("c", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    running = F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = turns.withColumns({"within": running - F.col("tokens"), "number": F.row_number().over(ordered) - 1})
    return own.join(before, ["c", "block"]).select("conv_id", "c", "role", "text", "tokens", (F.col("i0") + F.col("number")).alias("idx"), (F.col("p0") + F.col("within")).alias("p"))


def windows(conversations: DataFrame, budget: int = 1024, history: int = 256, tokens=count_tokens) -> DataFrame:
    """(conv_id, c, first_turn, n_repeated, n_tokens, over_budget, formatted, loss_spans): one row
    per window. The first ``n_repeated`` turns of a window stand in earlier windows too;
    ``loss_spans`` are (start, stop) in code points of ``formatted``."""
    placed = stage(_placed(conversations, tokens))
    heads = placed.groupBy("c").agg(F.count(F.lit(1)).alias("turns"), F.max(F.when((F.col("idx") == 0) & (F.col("role") == "system"), F.col("tokens"))).alias("system"))
    heads = heads.select("c", F.when(F.col("turns") > 1, F.coalesce("system", F.lit(0))).otherwise(F.lit(0)).alias("system"))
    sized = heads.withColumn("stride", F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.col("system")) / 2)))
    turns = placed.join(sized, "c").withColumn("is_system", (F.col("system") > 0) & (F.col("idx") == 0))
    spoken = turns.where("not is_system").withColumns({"bucket": F.floor((F.col("p") - F.col("system")) / F.col("stride")), "long": F.col("tokens") > F.col("stride")})
    spans = spoken.groupBy("c", "bucket", "long").agg(F.min("idx").alias("first_turn"), F.min("p").alias("start"))
    turn = F.struct("idx", F.lit(False).alias("repeated"), "role", "text", "tokens")
    again = F.struct("idx", F.lit(True).alias("repeated"), "role", "text", "tokens")
    new = spoken.join(spans, ["c", "bucket", "long"]).select("conv_id", "c", "first_turn", turn.alias("turn"))
    reach = F.floor((F.col("p") - F.col("system") + history) / F.col("stride"))
    earlier = (
        spoken.withColumn("bucket", F.explode(F.sequence("bucket", reach)))
        .select("conv_id", "c", "bucket", "p", "idx", "role", "text", "tokens")
        .join(spans, ["c", "bucket"])
        .where(f"idx < first_turn and start - p <= {history}")
        .select("conv_id", "c", "first_turn", again.alias("turn"))
    )
    # In the first window the system turn stands for the first time.
    system = turns.where("is_system").join(spans.select("c", "first_turn"), "c")
    system = system.select(
        "conv_id", "c", "first_turn", F.struct("idx", (F.col("first_turn") > 1).alias("repeated"), "role", "text", "tokens").alias("turn")
    )
    held = new.union(earlier).union(system).groupBy("c", "first_turn").agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list("turn")).alias("turns"))
    piece = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escape(t["role"], ROLE_ESCAPES), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
            ((t["role"] == "assistant") & ~t["repeated"]).alias("target"),
        ),
    )
    cut = held.withColumn("pieces", piece)
    length = F.transform("pieces", lambda x: F.length(x["head"]) + F.length(x["body"]) + len(CLOSE))
    begin = F.transform(
        F.sequence(F.lit(0), F.size("lengths") - 1), lambda i: F.aggregate(F.slice("lengths", F.lit(1), i), F.lit(0), lambda a, b: a + b)
    )
    spans_of = F.transform(
        F.filter(F.arrays_zip("pieces", "begins"), lambda x: x["pieces"]["target"]),
        lambda x: F.struct(
            (x["begins"] + F.length(x["pieces"]["head"])).alias("start"),
            (x["begins"] + F.length(x["pieces"]["head"]) + F.length(x["pieces"]["body"])).alias("stop"),
        ),
    )
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
    return (
        cut.withColumn("lengths", length)
        .withColumn("begins", begin)
        .select(
            "conv_id",
            "c",
            "first_turn",
            F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"),
            total.alias("n_tokens"),
            (total > budget).alias("over_budget"),
            F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "").alias("formatted"),
            spans_of.alias("loss_spans"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns, loss, formatted_chars): per conversation what its windows say,
    read from ``formatted`` and ``loss_spans`` alone: each turn once, as role, line break, text,
    line break; and all text under the loss mask."""
    parts = F.filter(F.split("formatted", CLOSE), lambda x: x != "")
    fresh = F.slice("parts", F.col("n_repeated") + 1, F.greatest(F.lit(1), F.size("parts")))
    said = F.transform(
        fresh,
        lambda x: F.concat(unescape(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), "\n", 1)), F.lit("\n"), unescape(F.substr(x, F.locate("\n", x) + 1)), F.lit("\n")),
    )
    masked = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["stop"] - s["start"])))
    each = formatted.withColumn("parts", parts).select(
        "conv_id", "c", F.struct("first_turn", F.size(fresh).alias("n"), F.array_join(said, "").alias("said"), F.array_join(masked, "").alias("loss"), F.length("formatted").alias("chars")).alias("w")
    )
    whole = each.groupBy("c").agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list("w")).alias("w"))
    return whole.select(
        "conv_id",
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_turns"),
        F.array_join(F.col("w.said"), "").alias("turns"),
        F.array_join(F.col("w.loss"), "").alias("loss"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x["chars"]).alias("formatted_chars"),
    )
