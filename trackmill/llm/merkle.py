"""Merkle manifest of a dataset: subroots per source, one root, and a proof for every row.

A tree has runs of three: every three consecutive nodes of a level become the hash of their
hex digests. The leaves of a source are cut into blocks of whole subtrees, so that the nodes
inside a block come from its own leaves. A part, some consecutive blocks, is what one task
holds. It asks for a multiproof as an octopus does: level by level the nodes known so far give
the least set of coordinates that are missing, parents are derived from what is known, and are
never asked for. All coordinates of a part are fetched in one join; the proofs of its single
leaves are then expanded inside the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.work import Scratch, arrow_schema, map_groups
from trackmill.operators.ordered import is_cut, number_rows, plain

RUN = 3
#: The tree over the subroots; trees of sources are named '=' and the source, or '' for null.
TOP = "/"


@dataclass(frozen=True)
class Settings:
    """`levels`: of a block's subtree; `blocks`: consecutive ones of a part; `max_rows`: of a source that is
    numbered in one task (larger ones are numbered in pieces)."""

    levels: int = 7
    blocks: int = 5
    max_rows: int = 1_000_000


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def sizes(n: int) -> list[int]:
    """Nodes of each level, from the leaves to the root."""
    found = [n]
    while found[-1] > 1:
        found.append(-(-found[-1] // RUN))
    return found


def run_of(index: int, size: int) -> range:
    first = index // RUN * RUN
    return range(first, min(first + RUN, size))


def missing(known: Iterable[int], first: int, counts: list[int]) -> list[tuple[int, int]]:
    """The least (level, index) that, with the known nodes of level `first`, give the root of a tree
    with `counts` nodes a level."""
    out, known = [], set(known)
    for level in range(first, len(counts) - 1):
        runs = {i // RUN for i in known}
        out += [(level, i) for r in sorted(runs) for i in run_of(r * RUN, counts[level]) if i not in known]
        known = runs
    return out


def derive(nodes: dict[tuple[int, int], str], known: Iterable[int], first: int, counts: list[int]) -> str:
    """Adds all nodes above the known ones, and returns the root."""
    known = set(known)
    for level in range(first, len(counts) - 1):
        known = {i // RUN for i in known}
        for r in known:
            nodes[level + 1, r] = digest("".join(nodes[level, i] for i in run_of(r * RUN, counts[level])))
    return nodes[len(counts) - 1, 0]


def _coded(column: Column | str) -> Column:
    """A value as it goes into the leaf."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | str = "text") -> Column:
    return F.sha2(F.concat(*[_coded(c) for c in ("doc_id", "source", "lang", "n_chars", text)]), 256)


def tampered(docs: DataFrame) -> Column:
    """The leaf after tampering, null where the text stays as it is."""
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return F.when(hit, leaf(F.translate("text", "\n", "")))


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    arrays = [pa.array(c, t) for c, t in zip(columns, arrow_schema(schema).types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _fold(nodes: DataFrame, settings: Settings, level: int, inner: bool) -> DataFrame:
    """From nodes (tree, idx) of a level: the tops of blocks, and if asked for all nodes below them but the leaves.

    The first block of a tree ends at its single node; others are only there if the first
    is full, and end as many levels above.
    """
    width = RUN**settings.levels
    schema = _schema(tree=T.StringType(), level=T.IntegerType(), idx=T.LongType(), hash=T.StringType(), top=T.BooleanType())
    depth = settings.levels

    def make():
        def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            trees, index, hashes = (table.column(c).to_pylist() for c in ("tree", "idx", "hash"))
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                found = sorted(zip(index[lo:hi], hashes[lo:hi], strict=True))
                at, first = 0, found[0][0]
                row, block = [h for _, h in found], first // width
                while (block == 0 and len(row) > 1) or (block > 0 and at < depth):
                    if inner and level + at > 0:
                        out += [(trees[lo], level + at, first + i, h, False) for i, h in enumerate(row)]
                    row = [digest("".join(row[i : i + RUN])) for i in range(0, len(row), RUN)]
                    first, at = first // RUN, at + 1
                out.append((trees[lo], level + depth, block, row[0], True))
            return _batch(out, schema)

        return work

    dealt = nodes.select("tree", F.floor(F.col("idx") / width).alias("block"), "idx", "hash")
    return map_groups(dealt, ["tree", "block"], make, schema)


def _forest(scratch: Scratch, leaves: DataFrame, settings: Settings, inner: bool) -> tuple[DataFrame, DataFrame]:
    """Nodes (tree, level, idx, hash), and the trees (tree, n, hash of the root).

    Nodes are those from the tops of the first blocks on, and the inner ones of these blocks if
    asked for. Each pass folds blocks to one node, so that few passes are made over ever fewer rows.
    """
    trees = scratch.settle(leaves.groupBy("tree").agg(F.count("*").alias("n")), "sizes")
    largest = trees.agg(F.max("n")).first()[0] or 0
    level, width = 0, RUN**settings.levels
    current, nodes, roots = leaves, None, None
    while True:
        made = scratch.settle(_fold(current, settings, level, inner or level > 0), "nodes")
        below, tops = made.filter("NOT top").drop("top"), made.filter("top").join(trees, "tree")
        ended = tops.filter(F.col("n") <= width).select("tree", "n", "hash")
        roots = ended if roots is None else roots.unionByName(ended)
        nodes = below if nodes is None else nodes.unionByName(below)
        if largest <= width:
            return nodes, roots
        current = tops.filter(F.col("n") > width).select("tree", "idx", "hash")
        level, width = level + settings.levels, width * RUN**settings.levels


def _numbered(df: DataFrame, key: str, order: list[str], settings: Settings) -> DataFrame:
    found = number_rows(df, key, order, max_rows=settings.max_rows)
    return (plain(found) if is_cut(found) else found).drop("is_last").withColumnRenamed("id", "idx")


def _parts(trees: DataFrame, settings: Settings) -> DataFrame:
    """A row per tree and part."""
    rows = RUN**settings.levels * settings.blocks
    return trees.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / rows))))


def _asked(parts: DataFrame, settings: Settings) -> DataFrame:
    """Rows (tree, part, c_tree, level, idx): the coordinates that each part lacks."""
    blocks = settings.blocks
    depth = settings.levels
    schema = _schema(tree=T.StringType(), part=T.LongType(), c_tree=T.StringType(), level=T.IntegerType(), idx=T.LongType())

    def ask(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                counts, first = sizes(row["n"]), row["part"] * blocks
                if len(counts) > depth:
                    known = range(first, min(first + blocks, counts[depth]))
                    out += [(row["tree"], row["part"], row["tree"], *c) for c in missing(known, depth, counts)]
                out += [(row["tree"], row["part"], TOP, *c) for c in missing([row["spot"]], 0, sizes(row["n_trees"]))]
            yield _batch(out, schema)

    return parts.select("tree", "part", "n", "spot", "n_trees").mapInArrow(ask, schema)


def _expand(rows: list[dict], fetched: list[dict]) -> list[tuple]:
    """The proofs of the leaves of a part, sorted by place, from its multiproof."""
    counts, top_counts = sizes(rows[0]["n"]), sizes(rows[0]["n_trees"])
    nodes = {(f["level"], f["idx"]): f["hash"] for f in fetched if f["c_tree"] != TOP}
    top = {(f["level"], f["idx"]): f["hash"] for f in fetched if f["c_tree"] == TOP}
    places = [r["idx"] for r in rows]
    nodes |= {(0, r["idx"]): r["hash"] for r in rows}
    subroot = derive(nodes, places, 0, counts)
    spot = rows[0]["spot"]
    top[0, spot] = subroot
    root = derive(top, [spot], 0, top_counts)

    def above(held: dict, sized: list[int], level: int, index: int, kept: dict) -> list[tuple[str, str]]:
        """Siblings left and right, level by level from a node on; one list for all leaves below it."""
        if level == len(sized) - 1:
            return []
        if (level, index) not in kept:
            run = run_of(index, sized[level])
            sides = "".join(held[level, i] for i in run if i < index), "".join(held[level, i] for i in run if i > index)
            rest = above(held, sized, level + 1, index // RUN, kept)
            if level == 0:
                return [sides, *rest]
            kept[level, index] = [sides, *rest]
        return kept[level, index]

    last, kept, out = above(top, top_counts, 0, spot, {}), {}, []
    for row in rows:
        steps = above(nodes, counts, 0, row["idx"], kept) + last
        folded = row["tampered"] or row["hash"]
        for left, right in steps:
            folded = digest(left + folded + right)
        proof = digest("".join(left + right for left, right in steps))
        out.append((row["doc_id"], row["hash"], subroot, root, proof, folded, folded == root))
    return out


def manifest(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, one row per row of docs.

    A null is coded apart from an empty text; a null source is a source, before all others. A
    null doc_id comes first in its source and is never tampered with. Rows of equal doc_id
    are ordered by their leaves; repeated rows are leaves of their own. Texts of any length are
    hashed inside Spark. An empty table gives no rows. Other columns are not read.
    """
    settings = settings or Settings()
    scratch = Scratch(docs.sparkSession, "merkle")
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    hashed = docs.select("doc_id", tree.alias("tree"), leaf().alias("hash"), tampered(docs).alias("tampered"))
    leaves = scratch.settle(_numbered(scratch.settle(hashed, "hashed"), "tree", ["doc_id", "hash", "tampered"], settings), "leaves")
    nodes, roots = _forest(scratch, leaves.select("tree", "idx", "hash"), settings, False)
    subroots = roots.withColumn("all", F.lit(TOP))
    subroots = scratch.settle(_numbered(subroots, "all", ["tree"], settings).withColumnRenamed("idx", "spot"), "subroots")
    top_nodes, _ = _forest(scratch, subroots.select(F.col("all").alias("tree"), F.col("spot").alias("idx"), "hash"), settings, True)
    n_trees = subroots.count()
    trees = subroots.select("tree", "n", "spot", F.lit(n_trees).cast("long").alias("n_trees"))
    parts = _parts(trees, settings)

    top_leaves = subroots.select(F.col("all").alias("tree"), F.lit(0).alias("level"), F.col("spot").alias("idx"), "hash")
    found = nodes.unionByName(top_nodes).unionByName(top_leaves).withColumnRenamed("tree", "c_tree")
    fetched = _asked(parts, settings).join(found, ["c_tree", "level", "idx"])
    fetched = fetched.groupBy("tree", "part").agg(F.collect_list(F.struct("c_tree", "level", "idx", "hash")).alias("fetched"))
    heads = parts.join(fetched, ["tree", "part"], "left")

    part = F.floor(F.col("idx") / (RUN**settings.levels * settings.blocks)).alias("part")
    dealt = heads.unionByName(leaves.select("doc_id", "tree", "hash", "tampered", "idx", part), allowMissingColumns=True)
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = _schema(doc_id=docs.schema["doc_id"].dataType, **dict.fromkeys(names, T.StringType()), verified=T.BooleanType())

    def make():
        def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                found = table.slice(lo, hi - lo).to_pylist()
                head = next(r for r in found if r["idx"] is None)
                about = {k: head[k] for k in ("n", "spot", "n_trees")}
                rows = sorted((r | about for r in found if r["idx"] is not None), key=lambda r: r["idx"])
                out += _expand(rows, head["fetched"] or [])
            return _batch(out, schema)

        return work

    return map_groups(dealt, ["tree", "part"], make, schema)

