"""Benchmark decontamination: winnowed fingerprints of both sides, joined and extended.

Of every `gram` consecutive words a hash is taken; of every run of such hashes as long as
fits a benchmark window, the smallest is kept (the rightmost of equal ones). Two texts that
share a window see the same hashes in it and keep the same one, so every shared window has
a common fingerprint. Each meeting of fingerprints is extended to both sides, word by word,
and counts if the shared run is as long as a window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.spans import BASE, LETTERS, Words, chunks, mix
from trackmill.llm.work import Scratch, map_batches, utf8


@dataclass(frozen=True)
class Settings:
    """`window` words that must be shared (a shorter item is one window), `gram` words per
    hash, and `slots` bits of the filter that spares most training fingerprints the join."""

    window: int = 10
    gram: int = 5
    slots: int = 1 << 24

    def level(self, length: int) -> tuple[int, int]:
        """Words per hash and hashes per run, for windows of this length."""
        gram = min(self.gram, length)
        return gram, length - gram + 1

    @property
    def reach(self) -> int:
        """Words that a window may stick out of a fingerprint in it."""
        return self.window - min(self.gram, self.window)


def winnow(words: Words, length: int, gram: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints, and their first words' numbers among all words."""
    padded = np.concatenate((words.hash, np.zeros(gram, np.uint64)))
    hashes = np.full(len(words), length, np.uint64)
    for j in range(gram):
        hashes = hashes * BASE + padded[j : j + len(words)]
    hashes = mix(hashes)
    n_windows = np.maximum(np.diff(words.bounds) - length + 1, 0)
    first = np.repeat(words.bounds[:-1] - np.concatenate(([0], np.cumsum(n_windows)[:-1])), n_windows)
    first = first + np.arange(len(first))
    least, at = hashes[first], first.copy()
    for j in range(1, run):
        other = hashes[first + j]
        lower = other <= least
        least[lower], at[lower] = other[lower], first[lower] + j
    at = np.unique(at)
    return hashes[at], at


def _surroundings(words: Words, at: np.ndarray, owner: np.ndarray, settings: Settings, none: int) -> np.ndarray:
    """Word hashes around each fingerprint, from `reach` words before it; `none` beyond the text."""
    width = settings.gram + 2 * settings.reach
    places = at[:, None] + np.arange(width) - settings.reach
    within = (places >= words.bounds[owner][:, None]) & (places < words.bounds[owner + 1][:, None])
    padded = np.concatenate((words.hash, np.zeros(1, np.uint64)))
    return np.where(within, padded[np.clip(places, 0, len(words))], np.uint64(none))


def item_prints(items: DataFrame, settings: Settings) -> DataFrame:
    """Rows (print, item_id, length, around): length is that of the item's windows."""
    schema = T.StructType(
        [
            T.StructField("print", T.LongType()),
            items.schema["item_id"],
            T.StructField("length", T.IntegerType()),
            T.StructField("around", T.BinaryType()),
        ]
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = Words(utf8(batch.column("text")), LETTERS)
            counts = np.minimum(np.diff(words.bounds), settings.window)
            made = []
            for length in np.unique(counts[counts > 0]).tolist():
                prints, at = winnow(words, length, *settings.level(length))
                owner = np.searchsorted(words.bounds, at, "right") - 1
                own = counts[owner] == length
                made.append((prints[own], owner[own], np.full(own.sum(), length), _surroundings(words, at[own], owner[own], settings, 1)))
            if not made:
                return pa.RecordBatch.from_pylist([], schema=_arrow(schema))
            prints, owner, length, around = (np.concatenate(x) for x in zip(*made, strict=True))
            columns = [
                pa.array(prints.view(np.int64)),
                batch.column("item_id").take(pa.array(owner)),
                pa.array(length.astype(np.int32)),
                pa.array([row.tobytes() for row in around], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        return work

    return map_batches(items.select("item_id", "text"), make, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from trackmill.llm.work import arrow_schema

    return arrow_schema(schema)


def bit_filter(prints: DataFrame, settings: Settings) -> np.ndarray:
    """Bits of the slots that the fingerprints fall into; of a fixed size, however many there are."""
    per_part = min(settings.slots, 1 << 16)
    slot = F.pmod(F.col("print"), F.lit(settings.slots))
    parts = prints.select((slot / per_part).cast("int").alias("part"), (slot % per_part).cast("int").alias("slot")).distinct()
    bits = np.zeros(settings.slots, bool)
    for part, slots in parts.groupBy("part").agg(F.collect_list("slot")).toLocalIterator():
        bits[part * per_part + np.array(slots)] = True
    return np.packbits(bits, bitorder="little")


def _marked(docs: DataFrame, keep: list[str], lengths: list[int], bits, settings: Settings) -> DataFrame:
    """The columns to keep, n_words, and `found`: fingerprints that pass the filter, with surroundings."""
    found_type = T.StructType(
        [T.StructField("print", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("around", T.BinaryType())]
    )
    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField("n_words", T.LongType()), T.StructField("found", T.ArrayType(found_type))]
    )

    def make():
        mask, field = np.uint64(settings.slots - 1), bits.value
        arrow_found = _arrow(schema).field("found").type

        def part_of(texts: list[bytes]):
            words = Words(texts, LETTERS)
            kept = []
            for length in lengths:
                prints, at = winnow(words, length, *settings.level(length))
                slot = prints & mask
                near = (field[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                kept.append((prints[near], at[near]))
            prints, at = (np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (words.hash[:0], words.first[:0])
            order = np.argsort(at, kind="stable")
            prints, at = prints[order], at[order]
            owner = np.searchsorted(words.bounds, at, "right") - 1
            around = _surroundings(words, at, owner, settings, 0)
            return np.diff(words.bounds), np.bincount(owner, minlength=len(texts)), prints, at - words.bounds[owner], around

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = [part_of(p) for p in chunks(utf8(batch.column("text")))]
            if parts:
                n_words, n_found, prints, at, around = (np.concatenate(x) for x in zip(*parts, strict=True))
            else:
                n_words = n_found = prints = at = np.empty(0, np.int64)
                around = np.empty((0, 1), np.uint64)
            struct = pa.StructArray.from_arrays(
                [pa.array(prints.view(np.int64)), pa.array(at.astype(np.int32)), pa.array([r.tobytes() for r in around], pa.binary())],
                names=["print", "at", "around"],
            )
            offsets = pa.array(np.concatenate(([0], np.cumsum(n_found))).astype(np.int32))
            found = pa.ListArray.from_arrays(offsets, struct).cast(arrow_found)
            kept = [batch.column(c) for c in keep]
            return pa.RecordBatch.from_arrays([*kept, pa.array(n_words.astype(np.int64)), found], names=schema.names)

        return work

    return map_batches(docs, make, schema)


def _extended(met: DataFrame, settings: Settings) -> DataFrame:
    """Rows (row_no, owners, first, last) of shared runs that are as long as the item's windows."""
    schema = T.StructType(
        [T.StructField("row_no", T.LongType()), met.schema["owners"], T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            width = settings.gram + 2 * settings.reach
            here, there = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, width) for c in ("around", "item_around")
            )
            length, at = batch.column("length").to_numpy(), batch.column("at").to_numpy()
            same = here == there
            gram = np.minimum(settings.gram, length)
            start = settings.reach
            whole = np.ones(len(same), bool)
            for j in range(settings.gram):
                whole &= same[:, start + j] | (j >= gram)
            before, after = np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
            going = whole.copy()
            for j in range(1, settings.reach + 1):
                going &= same[:, start - j]
                before += going
            going, rows = whole.copy(), np.arange(len(same))
            for j in range(settings.reach):
                going &= same[rows, start + gram + j]
                after += going
            hit = pa.array(whole & (before + gram + after >= length))
            columns = [
                batch.column("row_no"),
                batch.column("owners"),
                pa.array((at - before).astype(np.int32)),
                pa.array((at + gram + after).astype(np.int32)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names).filter(hit)

        return work

    return map_batches(met, make, schema)


def _union_size(spans: str) -> Column:
    """Words in the union of spans (first, last)."""
    return F.expr(
        f"aggregate(array_sort({spans}), named_struct('reach', 0, 'n', 0L), (a, x) -> named_struct('reach', greatest(a.reach, x.last),"
        " 'n', a.n + greatest(0, x.last - greatest(a.reach, x.first)))).n"
    )


def _grouped(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fingerprints with equal surroundings once, and the items of each set of owners.

    Rows (print, length, around, owners) and (owners, item_id): items that share a passage, such as
    a fixed instruction, have one row for each place inside it, whose `owners` digests their ids; at
    its ends, the words around a place differ, and items have rows of their own. No set is
    gathered in a row; null ids belong to no set.
    """
    place, key = ["print", "length", "around"], F.col("item_id").cast("string")
    owned = prints.select(*place, key.alias("item_id")).distinct()
    digests = (F.bit_xor(F.xxhash64(F.lit(n), "item_id")) for n in range(2))
    windows = owned.filter("item_id IS NOT NULL").groupBy(*place).agg(F.concat_ws(":", F.count("item_id"), *digests).alias("owners"))
    places = prints.select(*place).distinct().join(windows, place, "left")
    return places, owned.join(windows, place).select("owners", "item_id").distinct()


def _hits(docs: DataFrame, keep: list[str], items: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row_no, keep, n_words) of every row, (row_no, owners, first, last) of the hits, and (owners, item_id)."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "decontaminate")
    prints = scratch.settle(item_prints(items, settings), "prints")
    lengths = sorted(r.length for r in prints.select("length").distinct().collect())  # at most `window` numbers
    bits = spark.sparkContext.broadcast(bit_filter(prints, settings))
    marked = _marked(docs, keep, lengths, bits, settings)
    marked = scratch.settle(marked.withColumn("row_no", F.monotonically_increasing_id()), "marked")
    found = marked.filter(F.size("found") > 0).select("row_no", F.explode("found").alias("f")).select("row_no", "f.*")
    windows, sets = _grouped(prints)
    met = found.join(windows.withColumnRenamed("around", "item_around"), "print")
    met = met.select("row_no", "at", "around", "owners", "length", "item_around")
    return marked.drop("found"), _extended(met, settings), sets


def contamination(docs: DataFrame, items: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, one row per row of docs.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A window is `window`
    consecutive words of an item; an item of fewer words, but not none, is one window. n_hit
    counts the document's words in any occurrence of a window, n_items the items with an
    occurring window, items_sha256 digests their ids (as text, sorted, comma-joined; none:
    the digest of no text). Null texts have no words. Items of one id count as one, items
    without id mark words but aren't counted. Without items nothing is hit. Other columns
    are not read.
    """
    rows, hits, sets = _hits(docs.select("doc_id", "text"), ["doc_id"], items, settings or Settings())
    hits = Scratch(docs.sparkSession, "hits").settle(hits, "hits")
    spans = hits.groupBy("row_no").agg(F.collect_set(F.struct("first", "last")).alias("spans")).select("row_no", _union_size("spans").alias("n_hit"))
    found = hits.select("row_no", "owners").distinct().join(sets, "owners").groupBy("row_no").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(spans, "row_no", "left").join(found, "row_no", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents without any benchmark window, with all their columns, whatever these are called."""
    whole = docs.select(F.struct("*").alias("row"), "text")
    rows, hits, _ = _hits(whole, ["row"], items, settings or Settings())
    return rows.join(hits.select("row_no"), "row_no", "left_anti").select("row.*")
