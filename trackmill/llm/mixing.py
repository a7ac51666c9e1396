"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size takes every document floor(r) times, and once more
with probability r - floor(r). Which ones, the cube method decides: the vector of inclusion
probabilities moves through the null space of the constraints (words and documents of the
source keep their expected totals) until a probability is 0 or 1, again and again. Three open
documents are enough for a move, so blocks of a source fly by themselves, at most two
documents of each stay open, and these fly again together. What is left at the end, a few
documents per source, is the landing problem: the document total is given up, then rounded,
and the words that rounding misses are made good by exchanges.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.spans import SPACED, chunks
from trackmill.llm.work import Scratch, map_batches, utf8
from trackmill.operators.ordered import number_rows, plain


@dataclass(frozen=True)
class Settings:
    """`weights`, repeated over the sources in order; `most`: times a document may be taken;
    `block`: documents that fly together at most (in expectation); `seed` of the moves."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    block: int = 5000
    seed: int = 7


def word_counts(texts: list[bytes]) -> np.ndarray:
    """Words `[^\\x20\\x09-\\x0D]+` of each text."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = SPACED[joined]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    sums = np.concatenate(([0], np.cumsum(begins)))
    return np.diff(sums[edges])


def sized(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns to keep and `size`."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("size", T.LongType())])

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [word_counts(part) for part in chunks(utf8(batch.column("text")))]
            sizes = np.concatenate(counts) if counts else np.empty(0, np.int64)
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(sizes, pa.int64())], names=schema.names)

        return work

    return map_batches(docs, make, schema)


def targets(sizes: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """Rows (source, source_size, n_docs, target), one per source, a null source too.

    Sources in order of code points, null last, have the weights in turn and share the sum of
    all sizes by weight; a target above `most` times its source's size stops there, and the
    excess is shared by weight among the others, until none is above.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ordered = sources.withColumns({"all": F.lit(0), "last": F.col("source").isNull()})
    ordered = plain(number_rows(ordered, "all", ["last", "source"], max_rows=1_000_000))
    weight = F.element_at(F.array(*[F.lit(w) for w in settings.weights]), (F.col("id") % len(settings.weights) + 1).cast("int"))
    sources = scratch.settle(ordered.select("source", "source_size", "n_docs", weight.alias("weight")), "sources")
    cap = F.col("source_size") * settings.most
    level = 0.0
    while True:
        # sources whose share at the level so far is beyond their cap stay there
        open_ = F.col("weight") * F.lit(level) < cap
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(open_, F.lit(0)).otherwise(cap)).alias("capped"),
            F.sum(F.when(open_, F.col("weight")).otherwise(0)).alias("weights"),
        ).first()
        if not row.weights:
            break
        next_level = (row.total - row.capped) / row.weights
        if next_level <= level:
            break
        level = next_level
    share = F.col("weight") * F.lit(level)
    return sources.select("source", "source_size", "n_docs", F.least(share, cap.cast("double")).alias("target"))


def flight(sizes: list[float], chances: list[float], rng: random.Random, balance_count: bool = True) -> list[float]:
    """Chances after the flight: at most two (one without the count) lie between 0 and 1.

    Every move keeps the sum of chance * size and, if asked, the sum of the chances.
    """
    chances = list(chances)
    need = 3 if balance_count else 2
    active: list[int] = []
    for unit in range(len(sizes)):
        if not 0 < chances[unit] < 1:
            continue
        active.append(unit)
        while (direction := _direction([sizes[k] for k in active], balance_count, len(active) >= need)) is not None:
            up = min(((1 - chances[k]) if d > 0 else chances[k]) / abs(d) for k, d in zip(active, direction, strict=True) if d)
            down = min((chances[k] if d > 0 else (1 - chances[k])) / abs(d) for k, d in zip(active, direction, strict=True) if d)
            step = up if rng.random() * (up + down) < down else -down
            for k, d in zip(active, direction, strict=True):
                value = chances[k] + step * d
                chances[k] = 0.0 if value < 1e-9 else 1.0 if value > 1 - 1e-9 else value
            active = [k for k in active if 0 < chances[k] < 1]
    return chances


def _direction(sizes: list[float], balance_count: bool, enough: bool) -> list[float] | None:
    """A vector of the null space over the active units, or None if there is none."""
    if not balance_count:
        if 0 in sizes:
            return [float(i == sizes.index(0)) for i in range(len(sizes))]
        return [sizes[1], -sizes[0]] if enough else None
    for i in range(len(sizes)):
        for j in range(i):
            if sizes[i] == sizes[j]:
                return [1.0 if k == i else -1.0 if k == j else 0.0 for k in range(len(sizes))]
    if not enough:
        return None
    a, b, c = sizes
    scale = max(abs(b - c), abs(c - a), abs(a - b))
    return [(b - c) / scale, (c - a) / scale, (a - b) / scale]


def landing(sizes: list[float], before: list[float], chances: list[float], rng: random.Random) -> list[float]:
    """Chances of 0 and 1 only: the count is given up, then the one open unit is rounded.

    What the rounding misses of the words expected before the flight is made good as far as
    it goes by exchanges among its units: a unit for nothing, nothing for a unit, or one unit
    for another, the best of all each time.
    """
    wanted = sum(c * s for c, s in zip(before, sizes, strict=True))
    size = np.array(sizes)
    chosen = np.array([c >= 0.5 for c in flight(sizes, chances, rng, balance_count=False)])
    free = np.array([0 < c < 1 for c in before])
    for _ in range(4):
        missing = wanted - size[chosen].sum()
        # leaving nothing out, or putting nothing in, is a place of size 0 in front
        out = np.concatenate(([-1], np.flatnonzero(chosen & free)))
        into = np.concatenate(([-1], np.flatnonzero(~chosen & free)))
        out_size, into_size = (np.where(x < 0, 0, size[x]) for x in (out, into))
        order = np.argsort(into_size, kind="stable")
        near = np.searchsorted(into_size[order], out_size + missing)
        best = (abs(missing) - 1e-9, -1, -1)
        for shift in (-1, 0):
            place = order[np.clip(near + shift, 0, len(order) - 1)]
            left = np.abs(missing + out_size - into_size[place])
            k = int(np.argmin(left))
            best = min(best, (float(left[k]), int(out[k]), int(into[place[k]])))
        if best[1:] == (-1, -1):
            break
        if best[1] >= 0:
            chosen[best[1]] = False
        if best[2] >= 0:
            chosen[best[2]] = True
    return chosen.astype(float).tolist()


def _flown(units: DataFrame, settings: Settings, last: bool) -> DataFrame:
    """The units after a flight of each (source, block); after the landing too if it is the last."""

    def fly(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "deal", "row_no"], ascending=[False, True, True], kind="stable")
        rng = random.Random(f"{settings.seed} {frame['deal'].iloc[0]} {len(frame)}")
        sizes, before = frame["size"].astype(float).tolist(), frame["chance"].tolist()
        chances = flight(sizes, before, rng)
        if last:
            chances = landing(sizes, before, chances, rng)
        return frame.assign(chance=chances)

    return units.groupBy("source", "block").applyInPandas(fly, units.schema)


def mixed(sizes: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """The rows (doc_id, source, size, row_no) with source_size, target and copies."""
    of_source = targets(sizes, scratch, settings)
    of_source = of_source.select(F.col("source").alias("_source"), "source_size", "n_docs", "target")
    # Rows of one id that are more than a block are numbered and dealt out by number.
    many = sizes.groupBy("doc_id").count().filter(F.col("count") > settings.block).select(F.col("doc_id").alias("_many"))
    units = sizes.withColumn("ordinal", F.lit(None).cast("bigint"))
    if not many.isEmpty():
        is_many = F.col("doc_id").eqNullSafe(F.col("_many"))
        numbered = plain(number_rows(sizes.join(many, is_many, "left_semi"), "doc_id", ["size", "source", "row_no"], max_rows=1_000_000))
        numbered = numbered.withColumnRenamed("id", "ordinal").select(units.columns)
        units = units.join(many, is_many, "left_anti").unionByName(numbered)
    units = units.join(of_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12)
    deal = F.xxhash64(F.lit(settings.seed), "doc_id", "size", "ordinal")
    units = units.withColumns({"whole": whole, "chance": F.greatest(F.lit(0.0), ratio - whole), "deal": deal}).drop("ordinal")
    units = units.withColumn("chance", F.when(F.col("chance") < 1e-9, 0.0).otherwise(F.col("chance")))
    flat = units.schema.names

    settled, left, size = [], units, F.col("n_docs")
    while True:
        n_blocks = F.ceil(size / settings.block)
        blocks = left.withColumn("block", F.pmod("deal", n_blocks).cast("int"))
        most = left.agg(F.max(n_blocks)).first()[0] if settled else of_source.agg(F.max(n_blocks)).first()[0]
        last = most is None or most <= 1
        flown = scratch.settle(_flown(blocks, settings, last), "flown")
        settled.append(flown.filter("chance = 0 OR chance = 1").select(flat))
        if last:
            break
        left = flown.filter("chance > 0 AND chance < 1").select(flat)
        counts = left.groupBy("source").agg(F.count("*").alias("n_docs"))
        left = left.drop("n_docs").join(counts.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        left = left.drop("_source").select(flat)
    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    copies: Column = (F.col("whole") + F.col("chance")).cast("int")
    return done.select("doc_id", "source", "size", "row_no", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies, one row per row of docs.

    Words are `[^\\x20\\x09-\\x0D]+`; null and empty texts have size 0. taken is size * copies. A
    null source is a source. All sizes 0: all targets are 0 and nothing is taken. Repeated
    rows are documents of their own; other columns are not read. The same rows give the
    same mix, whatever their order; of rows alike in id and size any may be the one taken.
    """
    settings = settings or Settings()
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = sized(docs.select("doc_id", "source", "text"), ["doc_id", "source"])
    sizes = scratch.settle(sizes.withColumn("row_no", F.monotonically_increasing_id()), "sizes")
    taken = (F.col("size") * F.col("copies")).cast("long")
    return mixed(sizes, scratch, settings).select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies")


def mixture(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents of the mix, with all their columns, as often as it takes them."""
    settings = settings or Settings()
    scratch = Scratch(docs.sparkSession, "mixture")
    whole = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text")
    rows = sized(whole, ["row", "doc_id", "source"]).withColumn("row_no", F.monotonically_increasing_id())
    rows = scratch.settle(rows, "rows")
    copies = mixed(rows.drop("row"), scratch, settings).filter("copies > 0").select("row_no", "copies")
    repeated = rows.select("row_no", "row").join(copies, "row_no")
    return repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
