"""Conversation structure repair: cheapest edits by the auction shortest-path algorithm.

The rows of a conversation and the states of the wanted order of roles span a lattice. Its
nodes are (rows passed, state), its arcs the edits, with whole-number costs. The auction
algorithm keeps a price on every node and one path: the path is extended along the arc of
least cost plus price where the end's price allows it, and else contracted, the end's price
going up to that least sum. Prices stay a feasible dual, so at the end the arcs of every
cheapest path are tight (cost = difference of prices), and tracing tight arcs in order of
their letters gives the cheapest edits whose letters come first.

Long conversations are cut into pieces of rows, solved from the last to the first: the prices
at a piece's start are the exact costs to go, which the piece before takes as its ends'.
Work thus grows with the rows, not with their square.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.work import Scratch, arrow_schema, map_groups
from trackmill.operators.ordered import is_cut, number_rows, plain

#: States of the order `(s?(ua)+)?`: nothing yet, after the system, after a user, after an assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The role that is expected in a state, and the state after it.
NEXT = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
ROLES = "sua"
LEGAL_PAIRS = ("su", "ua", "au")


@dataclass(frozen=True)
class Settings:
    """`rerole`, `delete`, `insert`, `truncated`: costs of the edits, and of keeping a truncated row; `piece`:
    rows solved at a time; `max_rows`: of a conversation that is numbered in one task."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5
    piece: int = 128
    max_rows: int = 1_000_000


def row_arcs(settings: Settings, initial: str, fault: int, state: int) -> list[tuple[int, str, int]]:
    """The edits (cost, letter, state after it) that take a row away or over, from a state."""
    arcs = [(settings.delete, "D", state)]
    if fault in (BLANK, DUPLICATE):
        return arcs
    more = settings.truncated if fault == TRUNCATED else 0
    role, after = NEXT[state]
    if initial == role[0]:
        arcs.append((more, "K", after))
    elif initial == "s" and state == NOTHING:
        arcs.append((more, "K", SYSTEM))
    arcs.append((settings.rerole + more, "R", after))
    return arcs


class Lattice:
    """The cheapest edits of one conversation, given as initials of roles and faults."""

    def __init__(self, initials: str, faults: list[int], settings: Settings):
        self.settings = settings
        table = {}
        kinds = list(zip((c if c in ROLES else "?" for c in initials), faults, strict=True))
        for kind in set(kinds):
            table[kind] = [row_arcs(settings, *kind, state) for state in range(4)]
        self.rows = [table[kind] for kind in kinds]
        self.least = [min(cost for arcs in row for cost, _, _ in arcs) for row in self.rows]
        insert = settings.insert
        #: Costs to go behind the last row: nothing, two, one or no insertions.
        togo, self.pieces = [0, 2 * insert, insert, 0], []
        starts = list(range(0, len(self.rows), settings.piece)) or [0]
        for number, first in reversed(list(enumerate(starts))):
            rows = self.rows[first : first + settings.piece]
            prices = self._solve(rows, self.least[first : first + settings.piece], togo, [NOTHING] if number == 0 else range(4))
            self.pieces.append((rows, prices))
            togo = prices[0:4]
        self.pieces.reverse()
        self.cost = togo[NOTHING]

    def _arcs(self, rows: list, place: int, state: int) -> list[tuple[int, str, int]]:
        """(cost, letter, node) from a node before a row."""
        after = 4 * place + 4
        arcs = [(cost, letter, after + to) for cost, letter, to in rows[place][state]]
        return [*arcs, (self.settings.insert, "I", 4 * place + NEXT[state][1])]

    def _solve(self, rows: list, least: list[int], togo: list[int], origins) -> list[int]:
        """Prices of the nodes 4 * place + state, exact at the origins' places and on all cheapest paths."""
        ends = 4 * len(rows)
        # feasible to begin with: what every row costs at least from here on
        prices, ahead = [0] * ends + list(togo), min(togo)
        for place in reversed(range(len(rows))):
            ahead += least[place]
            prices[4 * place : 4 * place + 4] = [ahead] * 4
        for origin in origins if rows else ():
            path = [origin]
            while path[-1] < ends:
                node = path[-1]
                bid, to = min((cost + prices[to], to) for cost, _, to in self._arcs(rows, node // 4, node % 4))
                if prices[node] < bid:
                    prices[node] = bid
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(to)
        return prices

    def _leading(self, rows: list, prices: list[int]) -> list[bool]:
        """Which nodes have a tight path to an end; ends have."""
        good = [False] * (4 * len(rows)) + [True] * 4
        for place in reversed(range(len(rows))):
            for _ in range(3):  # insertions lead to nodes of the same place, two at most in a row
                for state in range(4):
                    node = 4 * place + state
                    good[node] = good[node] or any(good[to] and prices[node] == cost + prices[to] for cost, _, to in self._arcs(rows, place, state))
        return good

    def audit(self) -> str:
        """The letters of the cheapest edits, the first in order of those that cost the same."""
        letters, state = [], NOTHING
        for rows, prices in self.pieces:
            good, node = self._leading(rows, prices), state
            while node < 4 * len(rows):
                tight = [(letter, to) for cost, letter, to in self._arcs(rows, node // 4, node % 4) if good[to] and prices[node] == cost + prices[to]]
                letter, node = min(tight)
                letters.append(letter)
            state = node % 4
        return "".join(letters) + "I" * {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with the faults that crc32(`conv_id:turn`) % 20 puts in: 0 drops, 1 empties, 2 takes
    sentence ends out, 3 repeats, 4 makes it the user's. Nulls are one space there and in texts and roles."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name) % 20).alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1)))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    return rows.filter("hit != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("again")).drop("again")


def with_faults(rows: DataFrame, settings: Settings) -> DataFrame:
    """The rows numbered by turn (nulls first; equal turns by role and text), with `fault`, the first that holds."""
    found = number_rows(rows, "conv_id", ["turn", "role", "text"], max_rows=settings.max_rows)
    found = (plain(found) if is_cut(found) else found).drop("is_last")
    same = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    found = found.withColumn("_same", same)
    seen = F.row_number().over(Window.partitionBy("conv_id", "_same").orderBy("id")) > 1
    words = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    fault = F.when(words == "", BLANK).when(seen, DUPLICATE)
    fault = fault.when(~F.right(words, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    return found.select("conv_id", "id", "turn", "role", "text", fault.alias("fault"))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _judged(turns: list, initials: str, faults: list[int], settings: Settings) -> tuple:
    """The counts and the audit of one conversation in order."""
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    pairs = (a + b for a, b in zip(initials, initials[1:], strict=False))
    illegal = sum(pair not in LEGAL_PAIRS for pair in pairs)
    lattice = Lattice(initials, faults, settings)
    return (gaps, *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, lattice.cost, lattice.audit())


def _schema(conv: T.DataType, *more: str) -> T.StructType:
    texts = [T.StructField(c, T.StringType()) for c in ("audit", *more)]
    return T.StructType([T.StructField("conv_id", conv), *[T.StructField(c, T.LongType()) for c in _COUNTS], *texts])


def _heads(rows: DataFrame, conv: T.DataType, settings: Settings) -> DataFrame:
    """A row per conversation: its counts and audit. Texts aren't read; a conversation without rows has one of no id."""
    schema = _schema(conv)
    types = arrow_schema(schema).types

    def make():
        def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            convs, ids, turns, initials, faults = (table.column(c).to_pylist() for c in ("conv_id", "id", "turn", "initial", "fault"))
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                order = sorted((i for i in range(lo, hi) if ids[i] is not None), key=ids.__getitem__)
                out.append((convs[lo], *_judged([turns[i] for i in order], "".join(initials[i] for i in order), [faults[i] for i in order], settings)))
            return _columns(out, types, schema.names)

        return work

    return map_groups(rows, ["_none", "_conv"], make, schema)


class Writer:
    """The hash of a repaired conversation, row by row; no text is held."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.any = audit, 0, NOTHING, hashlib.sha256(), False

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) * self.any}{role}:{text}".encode())
        self.any = True

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = NEXT[self.state]
            self._line(role, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return
        expected, after = NEXT[self.state]
        if letter == "K" and role[:1] != expected[0]:
            after = SYSTEM
        self._line(role if letter == "K" else expected, text)
        self.state = after

    def end(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def repairs(turns: DataFrame, settings: Settings | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row per conversation.

    Nulls in role and text are one space; null turns come first and leave no gap,
    and a null conv_id is a conversation of its own. Roles count by their first letter; other
    than s, u and a they can only be changed or deleted. Equal turns are ordered by role and
    text. Texts pass through sorted, one at a time: a task holds the letters of a conversation, not its texts.
    """
    return _repaired(turns, turns.select("conv_id").distinct(), settings or Settings())


def repaired(conversations: DataFrame, settings: Settings | None = None) -> DataFrame:
    """`repairs` of the damaged rows, with a row also for a conversation that lost all of its rows: zeros, an
    empty audit and the hash of an empty text. Other columns are not read."""
    turns = conversations.select("conv_id", "turn", "role", "text")
    return _repaired(damaged(turns), turns.select("conv_id").distinct(), settings or Settings())


def _keyed(df: DataFrame) -> DataFrame:
    kind = df.schema["conv_id"].dataType
    none = F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)
    return df.withColumns({"_none": F.col("conv_id").isNull(), "_conv": F.coalesce("conv_id", none)})


def _repaired(turns: DataFrame, convs: DataFrame, settings: Settings) -> DataFrame:
    space = F.lit(" ")
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    scratch = Scratch(turns.sparkSession, "repair")
    conv = turns.schema["conv_id"].dataType
    rows = scratch.settle(with_faults(turns, settings), "rows")
    light = rows.select("conv_id", "id", "turn", F.rpad(F.left("role", F.lit(1)), 1, "?").alias("initial"), "fault")
    heads = _heads(_keyed(light.unionByName(convs, allowMissingColumns=True)), conv, settings)

    schema = _schema(conv, "repaired_sha256")
    types, head = arrow_schema(schema).types, schema.names[:-1]

    def write(batches):
        current, writer = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["id"] is None:
                    if writer:
                        out.append((*current, writer.end()))
                    current, writer = tuple(row[c] for c in head), Writer(row["audit"])
                else:
                    writer.row(row["role"], row["text"])
            yield _columns(out, types, schema.names)
        if writer:
            yield _columns([(*current, writer.end())], types, schema.names)

    both = _keyed(heads.unionByName(rows.select("conv_id", "id", "role", "text"), allowMissingColumns=True))
    both = both.repartition("_none", "_conv").sortWithinPartitions("_none", "_conv", F.col("id").asc_nulls_first())
    return both.mapInArrow(write, schema)


def _columns(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
