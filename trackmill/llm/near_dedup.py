"""Near-duplicate groups: MinHash signatures joined by a multi-index Hamming join.

Every distinct shingle set gets a signature of `positions` MinHash values of `bits` bits.
Two signatures are near if at most `distance` positions differ. The signature is cut into
`chunks`; by the pigeonhole principle near signatures have a chunk with at most
``distance // chunks`` differing positions. The allowed errors are enumerated: a chunk
yields a key for every way of leaving out so many positions, so all near pairs share a key,
without exception. The members of a key are compared by signature, what is near falls into
one cluster, and the links inside a cluster are confirmed on full shingle sets.

With the default 64 positions, a pair of similarity 0.8 has more than 27 differing ones with
probability 1.4e-5 (binomial, 0.2 each), so that is the share of such links that may be lost.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.components import components, follow
from trackmill.llm.spans import BASE, SPACED, Words, chunks, distinct, mix
from trackmill.llm.work import Scratch, binary, map_batches, map_groups, utf8


@dataclass(frozen=True)
class Settings:
    """`words` per shingle, `percent` of the union that linked sets share, the signature, and
    the members or bytes of text above which a group is compared block by block."""

    words: int = 5
    percent: int = 80
    positions: int = 64
    bits: int = 16
    distance: int = 27
    chunks: int = 14
    seed: int = 20240607
    block: int = 1000
    block_bytes: int = 16 << 20

    def factors(self) -> np.ndarray:
        drawn = np.random.default_rng(self.seed).integers(0, 2**63, self.positions, dtype=np.uint64)
        return drawn * np.uint64(2) + np.uint64(1)

    def left_out(self) -> list[tuple[int, ...]]:
        """For every key, the positions that it covers."""
        errors = self.distance // self.chunks
        keys = []
        for chunk in np.array_split(np.arange(self.positions), self.chunks):
            if len(chunk) <= errors:
                raise ValueError("chunks are too short for the errors allowed in them")
            keys += [tuple(p for p in chunk.tolist() if p not in gone) for gone in combinations(chunk.tolist(), errors)]
        return keys


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text and their bounds."""
    return distinct(*Words(texts, SPACED).runs(words))


def features(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, text_key, and for texts with words digest (of the set) and signature."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("text_key", T.BinaryType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("signature", T.BinaryType()),
        ]
    )

    def make():
        factors, unit = settings.factors(), np.dtype(f"<u{settings.bits // 8}")

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, digests, signatures = [], [], []
            for part in chunks(utf8(batch.column("text"))):
                values, bounds = shingle_sets(part, settings.words)
                counts = np.diff(bounds)
                full = np.flatnonzero(counts)
                sizes.append(counts)
                found: list[bytes | None] = [None] * len(part)
                signed: list[bytes | None] = [None] * len(part)
                if len(full):
                    starts = bounds[:-1][full]
                    made = np.empty((len(full), settings.positions), unit)
                    for p, factor in enumerate(factors):
                        made[:, p] = mix(np.minimum.reduceat(values * factor, starts)).astype(unit)
                    for i, row in zip(full.tolist(), made, strict=True):
                        held = values[bounds[i] : bounds[i + 1]]
                        found[i] = hashlib.blake2b(held.tobytes(), digest_size=16).digest()
                        signed[i] = row.tobytes()
                digests += found
                signatures += signed
            counts = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), binary(digests), binary(signatures)]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        return work

    return map_batches(docs.select("doc_id", _text_key().alias("text_key"), "text"), make, schema)


def _text_key() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def chunk_keys(classes: DataFrame, settings: Settings) -> DataFrame:
    """Rows (key, cls): for every chunk and way of leaving out its allowed errors one key."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("cls", T.LongType())])

    def make():
        kept, unit = settings.left_out(), f"<u{settings.bits // 8}"

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), unit)
            signs = signs.reshape(-1, settings.positions).astype(np.uint64)
            keys = np.empty((len(kept), len(signs)), np.uint64)
            for i, positions in enumerate(kept):
                key = np.full(len(signs), i + 1, np.uint64)
                for p in positions:
                    key = mix(key * BASE + signs[:, p])
                keys[i] = key
            names = np.tile(batch.column("cls").to_numpy(), len(kept))
            return pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(names)], names=["key", "cls"])

        return work

    return map_batches(classes.select("cls", "signature"), make, schema)


#: Rows of a group that each of its blocks is compared with first.
PIVOTS = 3
_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


_FIXED = ("grp", "total", "size", "cls")


def _links(rows: DataFrame, make) -> DataFrame:
    return map_groups(rows, ["grp", "i", "j"], make, _LINK).distinct()


def connected(scratch: Scratch, rows: DataFrame, full: int, make) -> tuple[DataFrame, list[DataFrame]]:
    """Links (a, b) that connect, within each group, all that the links of its pairs connect, and the
    tables (node, up) that lead to the components of all groups together.

    `rows` are (grp, total, size, cls) and what `make` compares: sizes of rows, and their total
    for the group. Groups beyond `full` are dealt to blocks. First each block is compared in
    itself, together with PIVOTS rows of the group that every block gets; this mostly connects
    a group of similar rows, in work that grows with the group. Then the components are known,
    and pairs inside one need no comparing: of every group, the rows outside its largest
    component are compared with all its rows, by pairs of blocks. So every pair of a group has
    been compared or is connected, no task holds more than two blocks, and no pairs are emitted.
    """
    compared = [c for c in rows.columns if c not in _FIXED]
    rows = rows.withColumn("n_blocks", F.ceil(F.col("total") / full).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), "n_blocks").cast("int"))
    large = rows.filter("n_blocks > 1")
    split = not large.isEmpty()
    dealt = rows.withColumn("i", F.col("own"))
    if split:
        drawn = F.array_distinct(F.array(*[F.min_by("cls", F.xxhash64("cls", F.lit(p))) for p in range(PIVOTS)]))
        pivots = large.groupBy("grp").agg(drawn.alias("drawn")).select("grp", F.explode("drawn").alias("cls"))
        everywhere = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("i")
        dealt = dealt.unionByName(large.join(pivots, ["grp", "cls"]).select("*", everywhere).filter("i != own"))
    first = dealt.select("grp", "i", F.col("i").alias("j"), F.lit(0).alias("block"), "cls", F.col("cls").alias("comp"), *compared)
    links = scratch.settle(_links(first, make), "linked")
    steps = components(scratch, links)
    if not split:
        return links, steps

    labels = large.select("cls").distinct().withColumn("comp", F.col("cls"))
    for step in steps:
        labels = follow(labels, step, "comp")
    labels = scratch.settle(labels, "labels")
    parts = large.select("grp", "cls", "size").join(labels, "cls").groupBy("grp", "comp").agg(F.sum("size").alias("part"))
    mains = parts.groupBy("grp").agg(F.max(F.struct("part", "comp")).alias("main"), F.sum("part").alias("whole"))
    mains = mains.select("grp", F.col("main.comp").alias("main"), F.col("main.part").alias("most"), (F.col("whole") - F.col("main.part")).alias("rest"))
    mains = scratch.settle(mains.filter("rest > 0"), "mains")
    if mains.isEmpty():
        return links, steps

    blocks = lambda size: F.ceil(F.col(size) / full).cast("int")
    second = large.join(mains, "grp").join(labels, "cls").withColumns({"n_rest": blocks("rest"), "n_main": blocks("most"), "hash": F.xxhash64("cls")})
    inside = F.col("comp") == F.col("main")
    block = F.when(inside, F.col("n_rest") + F.pmod("hash", "n_main")).otherwise(F.pmod("hash", "n_rest")).cast("int")
    others = F.sequence(F.lit(0), F.when(inside, F.col("n_rest")).otherwise(F.col("n_rest") + F.col("n_main")) - 1)
    second = second.withColumn("block", block).select("*", F.explode(others).alias("other"))
    second = second.select("grp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls", "comp", *compared)
    more = scratch.settle(_links(second, make), "linked")
    between = more
    for step in steps:
        between = follow(follow(between, step, "a"), step, "b")
    return links.unionByName(more), steps + components(scratch, between)


class _Forest:
    """Union-find over the rows of one group, from the components that they are in."""

    def __init__(self, comp: np.ndarray):
        self.root = np.unique(comp, return_inverse=True)[1]

    def join(self, a: int, b: int) -> None:
        low, high = sorted((self.root[a], self.root[b]))
        self.root[self.root == high] = low


def near_signatures(settings: Settings):
    """Of groups of rows with signatures: links of near ones that connect all that near ones connect."""

    def make():
        unit = f"<u{settings.bits // 8}"

        def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), unit).reshape(-1, settings.positions)
            names, block, comp = (table.column(c).to_numpy() for c in ("cls", "block", "comp"))
            sizes = np.diff(edges)
            pairs = edges[:-1][sizes == 2]
            near = pairs[(signs[pairs] != signs[pairs + 1]).sum(axis=1) <= settings.distance]
            left, right = [names[near]], [names[near + 1]]
            for start, size in zip(edges[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                rows = slice(start, start + size)
                for a, b in _spanning(signs[rows], block[rows], comp[rows], settings.distance):
                    left.append(names[start + a : start + a + 1])
                    right.append(names[start + b : start + b + 1])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

        return work

    return make


def _spanning(signs: np.ndarray, block: np.ndarray, comp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A forest over the rows whose signatures are near, between the two blocks if there are two."""
    forest, found, two = _Forest(comp), [], block.min() != block.max()
    for a in range(len(signs) - 1):
        later = np.flatnonzero(forest.root[a + 1 :] != forest.root[a]) + a + 1
        if two:
            later = later[block[later] != block[a]]
        if len(later):
            near = later[(signs[later] != signs[a]).sum(axis=1) <= distance]
            for b in near.tolist():
                if forest.root[a] != forest.root[b]:
                    forest.join(a, b)
                    found.append((a, b))
    return found


def linked_texts(settings: Settings):
    """Of groups of rows with texts: links of sets that share enough, which connect all that such links connect.

    Every pair is compared on full sets, unless links found before connect it already.
    """

    def make():
        def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            texts = utf8(table.column("text"))
            names, block, comp = (table.column(c).to_numpy() for c in ("cls", "block", "comp"))
            links = []
            for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if stop - start > 1:
                    for a, b in _linked(texts[start:stop], block[start:stop], comp[start:stop], settings):
                        links.append((names[start + a], names[start + b]))
            left, right = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

        return work

    return make


def _linked(texts: list[bytes], block: np.ndarray, comp: np.ndarray, settings: Settings) -> list[tuple[int, int]]:
    parts = [shingle_sets(part, settings.words) for part in chunks(texts)]
    values = np.concatenate([v for v, _ in parts])
    sizes = np.concatenate([np.diff(b) for _, b in parts])
    kinds, place = np.unique(values, return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    marked = np.zeros(len(kinds), np.int64)
    forest, found, two = _Forest(comp), [], block.min() != block.max()
    for a in range(len(texts) - 1):
        open_ = (forest.root[a + 1 :] != forest.root[a]) & (100 * np.minimum(sizes[a], sizes[a + 1 :]) >= settings.percent * np.maximum(sizes[a], sizes[a + 1 :]))
        if two:
            open_ &= block[a + 1 :] != block[a]
        if not open_.any():
            continue
        own = place[starts[a] : starts[a + 1]]
        marked[own] = 1
        shared = np.add.reduceat(marked[place[starts[a + 1] :]], starts[a + 1 : -1] - starts[a + 1])
        marked[own] = 0
        enough = open_ & (100 * shared >= settings.percent * (sizes[a] + sizes[a + 1 :] - shared))
        for b in (np.flatnonzero(enough) + a + 1).tolist():
            if forest.root[a] != forest.root[b]:
                forest.join(a, b)
                found.append((a, b))
    return found


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, kept.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. A document's set holds its
    distinct shingles of consecutive words; a text with fewer words has one, of all its
    words; a text without words (or null) has none, is linked with nothing and is its own
    component. Documents are linked if they share `percent` of the union of their sets.
    component_id is the smallest doc_id reachable by links, kept is whether it is the row's.

    Rows of one doc_id are separate documents that are told apart by text. A null doc_id is
    larger than all others; a component of null ids only has a null component_id, and keeps
    its rows. Other columns are not read. No documents give no rows.

    Documents of equal sets form one class, and all that follows is done on classes. No step
    emits the pairs of a group: keys and clusters give a forest each. Groups too large for a
    task are compared block by block, and only what pivots don't connect as pairs of blocks.
    """
    settings = settings or Settings()
    scratch = Scratch(docs.sparkSession, "near")
    found = scratch.settle(features(docs, settings), "features")
    classes = (
        found.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"),
            F.count("*").alias("n_docs"),
            F.min("signature").alias("signature"),
        )
        .select("digest", "n_docs", "signature", "first.doc_id", "first.text_key")
    )
    classes = scratch.settle(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    firsts = classes.withColumn("comp", F.col("cls"))
    for step in _groups(docs, classes, scratch, settings):
        firsts = follow(firsts, step, "comp")
    firsts = scratch.settle(firsts.select("digest", "comp", "doc_id"), "firsts")
    least = firsts.groupBy("comp").agg(F.min("doc_id").alias("least"))
    firsts = firsts.join(least, "comp").select("digest", "least")
    named = found.join(firsts, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    result = named.select(
        "doc_id",
        "text_key",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
    result = scratch.settle(result, "result")
    scratch.drop_all_but(result)
    return result


def _groups(docs: DataFrame, classes: DataFrame, scratch: Scratch, settings: Settings) -> list[DataFrame]:
    """Tables (node, up) that lead from each class to its component."""
    keys = chunk_keys(classes, settings)
    shared = keys.groupBy("key").agg(F.count("*").alias("total")).filter("total > 1")
    members = scratch.settle(keys.join(shared, "key"), "members")
    members = members.select(F.col("key").alias("grp"), "total", F.lit(1).alias("size"), "cls")
    near, steps = connected(scratch, members.join(classes.select("cls", "signature"), "cls"), settings.block, near_signatures(settings))

    nodes = near.select(F.explode(F.array("a", "b")).alias("cls")).distinct().withColumn("cluster", F.col("cls"))
    for step in steps:
        nodes = follow(nodes, step, "cluster")
    wanted = nodes.join(classes.select("cls", "doc_id", "text_key"), "cls")
    texts = scratch.settle(_texts(docs, wanted), "texts")
    size = F.greatest(F.octet_length("text"), F.lit(settings.block_bytes // settings.block)).cast("long")
    texts = texts.select(F.col("cluster").alias("grp"), "cls", size.alias("size"), "text")
    totals = texts.groupBy("grp").agg(F.sum("size").alias("total"))
    return connected(scratch, texts.join(totals, "grp"), settings.block_bytes, linked_texts(settings))[1]


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text (cluster, cls, text) for every class wanted."""
    wanted = wanted.select("cluster", "cls", F.col("doc_id").alias("want_id"), F.col("text_key").alias("want_key"))
    held = docs.select("doc_id", _text_key().alias("text_key"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("text_key") == F.col("want_key"))
    return held.join(wanted, same).select("cluster", "cls", "text").dropDuplicates(["cls"])


def first_of_groups(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents, with all their columns, of which each group has one left: that of the smallest doc_id.

    Documents without words stay. Rows of equal doc_id and equal text count as one document.
    Of a group without any id one document stays for each of its texts. No other column is
    read, so extra columns may have any name.
    """
    stay = near_duplicates(docs, settings).filter("kept")
    # One key for the join and for what follows, so that the texts are dealt out once.
    stay = stay.select(F.struct("doc_id", "text_key").alias("key")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.struct("doc_id", _text_key().alias("text_key")).alias("key"))
    return rows.join(stay, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
