"""Chat formatting: conversations as budgeted windows of whole turns.

A turn is written as ``<turn>role<text>body</turn>``. Inside roles and bodies the
characters that open a mark are escaped, so no text can imitate one, and reading back
undoes it exactly. Everything is a DataFrame expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.work import Scratch
from trackmill.operators.ordered import number_rows, plain, running_sum

TURN, TEXT, END = "<turn>", "<text>", "</turn>"
#: Escapes, in the order in which they are written; undone from the last to the first.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))


@dataclass(frozen=True)
class Settings:
    """Tokens of a window, tokens of earlier turns repeated in it, letters per token, tokens that
    a turn's marks take, and rows of a conversation above which it is cut into pieces."""

    budget: int = 1024
    history: int = 128
    chars_per_token: int = 4
    marks: int = 4
    max_rows: int = 1_000_000


def escaped(text: Column) -> Column:
    for plain_text, code in ESCAPES:
        text = F.replace(text, F.lit(plain_text), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain_text, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain_text))
    return text


def tokens(settings: Settings) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length("body") / settings.chars_per_token) + settings.marks).cast("long")


def windows(turns: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Rows (conv_id, window_start, formatted, n_repeated, loss), one per window.

    Turns are ordered by (turn, role, text), nulls first; null roles and texts are empty.
    Prefix sums of tokens choose the spans: a window goes on to the last turn with which it
    keeps its budget, beside the system turn and the history, and the next window starts
    behind it. No turn is cut. Only a window of one turn that itself exceeds what the system turn
    leaves is over the budget. window_start is the prefix sum before the window's first turn.

    A first turn of the role system is retained in front of every window. The last turns before
    a window are repeated in it, as many as `history` tokens hold; if its first turn leaves less
    than that, as many as there is room for. n_repeated counts the turns that an earlier window
    has already. loss holds the spans (first, last) in code points, end exclusive, of the
    assistant bodies that are there for the first time; repeated ones are masked. Rows of a null
    conv_id form one conversation; repeated rows are turns of their own; other columns are not
    read; no turns give no windows.
    """
    settings = settings or Settings()
    rows = turns.select(
        "conv_id",
        "turn",
        escaped(F.coalesce("role", F.lit(""))).alias("role"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"),
    )
    rows = number_rows(rows, "conv_id", ["turn", "role", "body"], max_rows=settings.max_rows)
    is_system = (F.col("id") == 0) & (F.col("role") == "system")
    rows = rows.withColumns({"is_system": is_system, "tokens": tokens(settings)})
    rows = plain(running_sum(rows, "so_far", F.when(is_system, 0).otherwise(F.col("tokens")), "conv_id", "id"))
    rows = rows.select(F.struct("conv_id").alias("conv"), "id", "role", "body", "is_system", "tokens", "so_far")
    rows = Scratch(turns.sparkSession, "chat").settle(rows, "turns")

    # Places are worked out on numbers alone; the texts join them once.
    numbers = rows.drop("role", "body")
    whole = numbers.groupBy("conv").agg(
        F.max("so_far").alias("total"), F.max(F.when(F.col("is_system"), F.col("tokens"))).alias("system_tokens")
    )
    scratch = Scratch(turns.sparkSession, "chat")
    reach = settings.budget + settings.history
    placed = numbers.filter(~F.col("is_system")).join(whole, "conv")
    before = F.col("so_far") - F.col("tokens")
    system = F.coalesce("system_tokens", F.lit(0))
    placed = placed.select("conv", "id", "tokens", "so_far", "total", system.alias("system"), before.alias("before"), F.floor(before / reach).alias("cell"))
    placed = scratch.settle(_with_next(placed, settings), "next")
    starts = scratch.settle(_starts(placed, scratch), "starts")

    # Each turn goes to the last start that isn't behind it, and again to those whose history takes it in.
    near_starts = _near(starts.select("conv", "cell", F.struct("before", "history").alias("s")), "s")
    placed = placed.join(near_starts, ["conv", "cell"])
    reached = F.filter("near", lambda s: s.before <= F.col("before"))
    own_start = F.array_max(F.transform(reached, lambda s: s.before))
    again_starts = F.filter("near", lambda s: (s.before > F.col("before")) & (s.before - F.col("before") <= s.history))

    def member(at: Column, part: int, fresh: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(part).alias("part"), fresh.alias("fresh"))

    own = F.array(member(own_start, 1, F.lit(True)))
    again = F.transform(again_starts, lambda s: member(s.before, 0, F.lit(False)))
    members = placed.select("conv", "id", F.explode(F.concat(own, again)).alias("m"))
    members = members.select("conv", "id", "m.*")
    opened = whole.filter("system_tokens IS NOT NULL").join(starts.select("conv", F.col("before").alias("start")), "conv", "left")
    at = F.coalesce("start", F.lit(0).cast("long"))
    systems = opened.select("conv", F.lit(0).cast("long").alias("id"), member(at, -1, at == 0).alias("m")).select("conv", "id", "m.*")
    members = members.unionByName(systems).join(rows.select("conv", "id", "role", "body"), ["conv", "id"])
    turn = F.struct("part", "id", "role", "body", "fresh")
    windowed = members.groupBy("conv", "at").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return windowed.select(
        F.col("conv.conv_id").alias("conv_id"),
        F.col("at").alias("window_start"),
        F.array_join(F.transform("turns", lambda t: F.concat(F.lit(TURN), t.role, F.lit(TEXT), t.body, F.lit(END))), "").alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t.fresh)).alias("n_repeated"),
        _loss("turns").alias("loss"),
    )


def _near(rows: DataFrame, value: str) -> DataFrame:
    """Rows (conv, cell, near): the values of a cell and of those beside it.

    A turn has tokens, so a cell holds a bounded number of turns, and a long conversation is many cells.
    """
    spread = rows.select("conv", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"), value)
    return spread.groupBy("conv", "cell").agg(F.array_sort(F.collect_list(value)).alias("near"))


def _with_next(placed: DataFrame, settings: Settings) -> DataFrame:
    """Adds what follows if a window starts at the turn: `history`, the tokens it may repeat, and `next`, the
    first turn of the window behind it (null if none)."""
    near = _near(placed.select("conv", "cell", F.struct("before", "so_far", "id").alias("s")), "s")
    df = placed.join(near, ["conv", "cell"])
    room = F.lit(settings.budget) - F.col("system")
    history = F.least(F.lit(settings.history), F.greatest(F.lit(0), room - F.col("tokens")))
    df = df.withColumn("history", history.cast("long"))
    taken = F.filter("near", lambda s: (s.before <= F.col("before")) & (s.before >= F.col("before") - F.col("history")))
    repeated = F.col("before") - F.array_min(F.transform(taken, lambda s: s.before))
    df = df.withColumn("limit", F.col("before") + F.greatest(F.col("tokens"), room - repeated))
    behind = F.array_min(F.transform(F.filter("near", lambda s: (s.so_far > F.col("limit")) & (s.id > F.col("id"))), lambda s: s.id))
    # a turn longer than the budget ends beyond the cells looked at
    following = F.when(F.col("limit") >= F.col("total"), None).when(F.col("limit") == F.col("so_far"), F.col("id") + 1).otherwise(behind)
    return df.withColumn("next", following).drop("near", "limit")


def _starts(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """The turns at which windows start: those reached from a conversation's first turn by `next`.

    Pointers are doubled: after k rounds the starts of the first 2**k windows are known, so a
    conversation of many windows takes few rounds. Every round is a join on (conv, id) over numbers.
    """
    steps = scratch.settle(placed.filter("next IS NOT NULL").select("conv", "id", "next"), "steps")
    found = placed.filter("before = 0").select("conv", "id")
    while not steps.isEmpty():
        ahead = found.join(steps, ["conv", "id"]).select("conv", F.col("next").alias("id"))
        found = scratch.settle(found.unionByName(ahead).distinct(), "found")
        after = steps.select("conv", F.col("id").alias("next"), F.col("next").alias("far"))
        steps = scratch.settle(steps.join(after, ["conv", "next"]).select("conv", "id", F.col("far").alias("next")), "steps")
    return placed.join(found, ["conv", "id"], "left_semi").select("conv", "cell", "before", "history")


def _loss(turns: str) -> Column:
    """Spans of fresh assistant bodies; a window holds few turns, so the list may be rebuilt at each."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("spans"))

    def step(state, t):
        first = state.at + len(TURN) + F.length(t.role) + len(TEXT)
        last = first + F.length(t.body)
        span = F.array(F.struct(first.alias("first"), last.alias("last")))
        target = t.fresh & (t.role == "assistant")
        spans = F.when(target, F.concat(state.spans, span)).otherwise(state.spans)
        return F.struct((last + len(END)).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step).spans


def read_back(formatted: DataFrame) -> DataFrame:
    """Rows (conv_id, window_start, turns, losses, n_chars) from windows: the turns (role, text) that
    come for the first time, and the texts under the loss mask, unescaped."""
    pieces = F.slice(F.split("formatted", TURN), 2, 1 << 30)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substring_index(p, TEXT, 1)).alias("role"),
            unescaped(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text"),
        ),
    )
    losses = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s.first + 1, s.last - s.first)))
    return formatted.select(
        "conv_id",
        "window_start",
        # the system turn is the first; where it is repeated it counts among n_repeated
        F.slice(turns, F.col("n_repeated") + 1, 1 << 30).alias("turns"),
        losses.alias("losses"),
        F.length("formatted").cast("long").alias("n_chars"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows: n_turns, turns_sha256, loss_chars,
    loss_sha256 and formatted_chars."""
    read = read_back(formatted)
    in_order = F.array_sort(F.collect_list(F.struct("window_start", "turns", "losses")))
    whole = read.groupBy("conv_id").agg(in_order.alias("w"), F.sum("n_chars").alias("formatted_chars"))
    turns = F.flatten(F.transform("w", lambda w: w.turns))
    text = F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join(F.flatten(F.transform("w", lambda w: w.losses)), "")
    return whole.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
