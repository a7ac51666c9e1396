"""Ordered computations per key, for keys of any size.

A window over a key runs in one task. That is the best plan while the key is small.
The rows of a key too large for that are cut into pieces instead:

* they are range-partitioned on (key, order) and written once, which settles the
  piece of every row; pieces have about equal size whatever the keys are;
* windows then group by piece. The neighbours of a piece are copied into it as halo
  rows, so ``lag`` and ``lead`` see them;
* running totals add what the earlier pieces of the key came to, taken from one
  summary row per piece.

All other rows keep one piece per key and are shuffled once, as in a plain window.
What is broadcast is bounded by rows / ``max_rows``: there are fewer large keys than
that, and as many ranges, each of which can add one piece to the number of keys.

Operators use ``grouping`` and ``order_window`` and so work on both layouts.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from trackmill.session import checkpointed

# Piece of a row, its settled place among the rows of large keys, and whether it is a copy.
PIECE, SPOT, HALO = "_piece", "_spot", "_halo"
_FIRST, _ROWS, _BASE, _SHIFT = "_first_spot", "_piece_rows", "_base", "_shift"
MAX_ROWS_PER_TASK = 10_000_000


def is_cut(df: DataFrame) -> bool:
    return PIECE in df.columns


def grouping(df: DataFrame, key: str) -> str:
    """The column that windows group by."""
    return PIECE if is_cut(df) else key


def order_window(df: DataFrame, key: str, order: Sequence[str], descending: bool = False) -> WindowSpec:
    # The settled place makes the order of large keys total, whatever ``order`` leaves open.
    names = [*order, SPOT] if is_cut(df) else order
    columns = [F.col(c).desc() if descending else F.col(c).asc() for c in names]
    return Window.partitionBy(grouping(df, key)).orderBy(*columns)


def number_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    before: int = 0,
    after: int = 1,
    max_rows: int | None = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add ``id`` (from 0, per key) and ``is_last``.

    ``order`` should be total; ties are else numbered in any order. When a key has
    more than ``max_rows`` rows the frame comes back in pieces with ``before`` and
    ``after`` halo rows; ``own_rows`` and ``plain`` take these out again. With
    ``max_rows=None`` keys are taken to be small and are not counted first.
    """
    shift = F.lit(0)
    if max_rows is not None:
        large = df.groupBy(key).count().filter(F.col("count") > max_rows)
        large_rows = large.agg(F.sum("count")).first()[0]
        if large_rows:
            df = _in_pieces(df, large, key, order, before, max(after, 1), ceil(large_rows / max_rows))
            shift = F.col(_SHIFT)
    in_order = order_window(df, key, order)
    # The last row has no next one; counting the key would be a second window.
    return df.withColumns(
        {
            "id": F.row_number().over(in_order).cast("bigint") - 1 + shift,
            "is_last": F.lead(F.lit(1)).over(in_order).isNull(),
        }
    ).drop(_SHIFT)


def _in_pieces(df, large, key, order, before, after, n_pieces):
    """Rows with their piece, halo rows, and ``_shift`` from place in piece to place in key."""
    # Keys are compared inside a struct, where null is an ordinary value.
    large = F.broadcast(checkpointed(large.select(F.struct(key).alias("_large"))))
    is_large = F.struct(key) == F.col("_large")
    spread = (
        df.join(large, is_large, "left_semi")
        .repartitionByRange(n_pieces, key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn(PIECE, _piece(key, F.spark_partition_id()))
        .withColumn(SPOT, F.monotonically_increasing_id())
    )
    spread = checkpointed(spread)
    earlier = Window.partitionBy(f"{PIECE}.key").orderBy(f"{PIECE}.no").rowsBetween(Window.unboundedPreceding, -1)
    pieces = checkpointed(
        spread.groupBy(PIECE)
        .agg(F.min(SPOT).alias(_FIRST), F.count("*").alias(_ROWS))
        .withColumn(_BASE, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)))
        .withColumn(_SHIFT, F.col(_BASE) - F.least(F.col(_BASE), F.lit(before)))
    )
    of_large = spread.join(F.broadcast(pieces.select(PIECE, _SHIFT)), PIECE).withColumn(HALO, F.lit(False))
    zero = F.lit(0).cast("bigint")
    others = df.join(large, is_large, "left_anti").withColumns(
        {PIECE: _piece(key, F.lit(-1)), SPOT: zero, HALO: F.lit(False), _SHIFT: zero}
    )
    halo = _halo_rows(spread, pieces, before, after)
    return others.unionByName(of_large).unionByName(halo.select(others.columns))


def _piece(key, number):
    return F.struct(number.alias("no"), F.col(key).alias("key"))


def _halo_rows(spread, pieces, before, after):
    """Rows at the ends of pieces, once for every piece they are close enough to."""

    def place(side, offset):
        return F.struct(F.lit(side).alias("side"), F.col(f"{PIECE}.key"), offset.alias("id"))

    starts = pieces.select(place("start", F.col(_BASE)).alias("_at"), F.col(PIECE).alias("_into"), _SHIFT)
    ends = pieces.select(
        place("end", F.col(_BASE) + F.col(_ROWS) - 1).alias("_at"), F.col(PIECE).alias("_into"), _SHIFT
    )
    spot = F.col(SPOT) - F.col(_FIRST)
    near = spread.join(F.broadcast(pieces.select(PIECE, _FIRST, _ROWS, _BASE)), PIECE)
    near = near.filter((spot < after) | (spot >= F.col(_ROWS) - before)).withColumn("_id", F.col(_BASE) + spot)
    reached = [place("start", F.col("_id") + d) for d in range(1, before + 1)]
    reached += [place("end", F.col("_id") - d) for d in range(1, after + 1)]
    copies = near.withColumn("_at", F.explode(F.array(*reached))).join(starts.unionByName(ends), "_at")
    return copies.withColumns({PIECE: F.col("_into"), HALO: F.lit(True)})


def own_rows(df: DataFrame) -> DataFrame:
    """The frame without halo rows, still in pieces."""
    return df.filter(~F.col(HALO)).drop(HALO) if HALO in df.columns else df


def plain(df: DataFrame) -> DataFrame:
    """The frame without halo rows and piece columns."""
    return own_rows(df).drop(PIECE, SPOT)


def _by_piece(df: DataFrame, **totals: Column) -> DataFrame:
    """Summaries of the pieces of large keys.

    The filter is on the column that windows group by, so Spark moves it below them
    and the rows of other keys are not even read.
    """
    large = df.filter(F.col(f"{PIECE}.no") >= 0)
    return large.groupBy(PIECE).agg(*[total.alias(name) for name, total in totals.items()])


def beyond_piece(
    df: DataFrame,
    earlier: dict[str, tuple[Column, object]] | None = None,
    later: dict[str, tuple[Column, object]] | None = None,
) -> tuple[DataFrame, dict[str, Column]]:
    """The frame, and what the earlier or later pieces of the key come to; null where there are none.

    Every entry gives an aggregate over one piece, a whole number, with the function
    that combines the pieces. ``F.last`` picks the nearest piece. Halo rows are left out.
    """
    df = own_rows(df)
    earlier, later = earlier or {}, later or {}
    both = earlier | later
    if not is_cut(df):
        return df, {name: F.lit(None).cast("bigint") for name in both}
    pieces = _by_piece(df, **{name: total for name, (total, _) in both.items()})
    of_key = Window.partitionBy(f"{PIECE}.key")
    forward = of_key.orderBy(F.col(f"{PIECE}.no").asc()).rowsBetween(Window.unboundedPreceding, -1)
    backward = of_key.orderBy(F.col(f"{PIECE}.no").desc()).rowsBetween(Window.unboundedPreceding, -1)
    combined = [combine(name).over(forward).alias(name) for name, (_, combine) in earlier.items()]
    combined += [combine(name).over(backward).alias(name) for name, (_, combine) in later.items()]
    # Settled, so that the frame is in the plan once; the join is on the windows' own partitions.
    pieces = checkpointed(pieces.select(PIECE, *combined))
    return df.join(pieces, PIECE, "left"), {name: F.col(name) for name in both}


def running_sum(df: DataFrame, name: str, value: Column, key: str, by: str) -> DataFrame:
    """Running sum per key up to and with all rows of equal ``by`` (a RANGE frame).

    The rows carry ``id``; halo rows are left out. In pieces, rows of equal ``by`` may lie in several; a
    piece then also adds the rows at the head of the next ones that tie with its end.
    """
    up_to_ties = Window.partitionBy(grouping(df, key)).orderBy(by).rangeBetween(Window.unboundedPreceding, 0)
    df = own_rows(df).withColumn("_value", value)
    if not is_cut(df):
        return df.withColumn(name, F.sum("_value").over(up_to_ties)).drop("_value")
    df = df.withColumn("_here", F.sum("_value").over(up_to_ties))
    in_order = Window.partitionBy(f"{PIECE}.key").orderBy(f"{PIECE}.no")
    same_end = Window.partitionBy(f"{PIECE}.key", "_end").orderBy(F.col(f"{PIECE}.no").desc())
    next_ties = F.lead("_begin").over(in_order).eqNullSafe(F.col("_end"))
    pieces = (
        _by_piece(
            df,
            _total=F.sum("_value"),
            _head=F.min_by("_here", "id"),
            _begin=F.min(by),
            _end=F.max(by),
        )
        .withColumn("_next_head", F.when(next_ties, F.lead("_head").over(in_order)))
        .select(
            PIECE,
            "_end",
            F.sum("_total").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("_past"),
            F.sum("_next_head").over(same_end.rowsBetween(Window.unboundedPreceding, 0)).alias("_ties"),
        )
    )
    ties = F.when(F.col(by) == F.col("_end"), F.coalesce("_ties", F.lit(0))).otherwise(0)
    total = F.col("_here") + F.coalesce("_past", F.lit(0)) + ties
    joined = df.join(checkpointed(pieces), PIECE, "left").withColumn(name, total)
    return joined.drop("_value", "_here", "_end", "_past", "_ties")
