"""Secret scan: parts of credentials, and weak candidates that complementary parts confirm.

Strong parts are reported as they are. A weak part alone is everyday text; it is reported
with the parts that complete it in its scope and don't overlap it: an opaque token beside an identifier or an
endpoint, a user name or an endpoint beside a secret. These are found by an interval join,
and come as links. Everything is a DataFrame expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.llm.work import Scratch

# The patterns of the parts, in the order in which kinds are listed.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "user": r"""\b(?i:user|username|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
    "opaque": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}",
    "endpoint": r"""(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\s"'<>]+|\b[a-z0-9.-]+\.amazonaws\.com\b""",
}
STRONG = ("assign", "access", "hex")
IDENTIFIERS, SECRETS = ("access", "user"), ("assign", "hex", "opaque")
#: For a weak kind, the kinds of which one must lie in its scope.
COMPLEMENTS = {"user": SECRETS, "opaque": (*IDENTIFIERS, "endpoint"), "endpoint": SECRETS}


@dataclass(frozen=True)
class Settings:
    """Code points to either side of a weak part's start that are its scope, and the least
    length of an assigned value."""

    scope: int = 400
    least_value: int = 8


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, and for each kind the lengths of the matches, of the texts between them, and of values.

    Matches are leftmost and don't overlap; texts between and matches alternate, so their
    lengths give every position. A pattern for ends of long runs of its own characters finds
    the same matches as one for whole runs whose short ones are dropped.
    """
    text = F.coalesce("text", F.lit(""))

    def scan(kind: str, wanted: Column | None = None) -> Column:
        pattern = PATTERNS[kind]
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else hits
        found = F.struct(
            F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
            F.transform(hits, F.length).alias("hits"),
            F.transform(values, F.length).alias("values"),
        )
        has = text.contains("AKIA") if kind == "access" else text.rlike(pattern)
        return F.when(has if wanted is None else wanted & has, found).alias(kind)

    first = docs.select("doc_id", "text", *[scan(kind) for kind in (*STRONG, "user", "endpoint")])
    helped = F.col("access").isNotNull() | F.col("user").isNotNull() | F.col("endpoint").isNotNull()
    return first.select("doc_id", *STRONG, "user", scan("opaque", helped), "endpoint")


def spans(found: DataFrame, settings: Settings) -> DataFrame:
    """Rows (row_no, rank, kind, start, stop) of strong spans and of weak candidates; rank is the place of the kind in the list."""
    kinds = list(PATTERNS)
    each = F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(k).alias("kind"), F.col(k).alias("m")) for i, k in enumerate(kinds)]), lambda s: s.m.isNotNull()))
    rows = found.select("row_no", each.alias("s")).select("row_no", "s.rank", "s.kind", F.posexplode(F.arrays_zip("s.m.hits", "s.m.gaps", "s.m.values")).alias("i", "z"))
    rows = rows.select("row_no", "rank", "kind", "i", F.col("z.hits").alias("hit"), F.col("z.gaps").alias("gap"), F.col("z.values").alias("value"))
    rows = rows.filter("hit IS NOT NULL")  # the last text between has no match after it
    in_order = Window.partitionBy("row_no", "kind").orderBy("i")
    stop = F.sum(F.col("gap") + F.col("hit")).over(in_order)
    rows = rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("hit"))
    rows = rows.filter((F.col("kind") != "assign") | (F.col("value") >= settings.least_value)).select("row_no", "rank", "kind", "start", "stop")

    strong = F.col("kind").isin(*STRONG)
    by_start = Window.partitionBy("row_no").orderBy("start")
    before = F.max(F.when(strong, F.col("stop"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(strong, F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    covered = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("stop"), F.lit(False))
    # An endpoint may hold a strong part and still link others; a covered token or name is the strong part itself.
    return rows.withColumn("covered", covered).filter(strong | (F.col("kind") == "endpoint") | ~F.col("covered")).drop("covered")


def links(found: DataFrame, settings: Settings) -> DataFrame:
    """Rows (row_no, rank, kind, start, stop, parts): weak spans with the parts that complete them, nearest first.

    An interval join: a part lies in a weak span's scope if their starts are at most `scope`
    apart, and completes it if its kind does and the two don't overlap. Both sides are dealt out
    by text and cell of the scope's width, a weak span to three cells, so a text with very many spans is split.
    """
    wanted = F.create_map(*[x for k, v in COMPLEMENTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    cell = F.floor(F.col("start") / settings.scope)
    weak = found.filter(~F.col("kind").isin(*STRONG))
    weak = weak.select("*", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"), wanted[F.col("kind")].alias("wanted"))
    others = found.select(F.col("row_no").alias("o_row"), cell.alias("o_cell"), F.struct(*[F.col(c) for c in ("rank", "kind", "start", "stop")]).alias("o"))
    near = F.abs(F.col("o.start") - F.col("start")) <= settings.scope
    apart = (F.col("o.stop") <= F.col("start")) | (F.col("o.start") >= F.col("stop"))
    met = (F.col("row_no") == F.col("o_row")) & (F.col("cell") == F.col("o_cell"))
    joined = weak.join(others, met).filter(near & apart & F.array_contains("wanted", F.col("o.kind")))
    part = F.struct(F.abs(F.col("o.start") - F.col("start")).alias("far"), *[F.col(f"o.{c}").alias(c) for c in ("start", "rank", "kind", "stop")])
    return joined.groupBy("row_no", "rank", "kind", "start", "stop").agg(F.array_sort(F.collect_list(part)).alias("parts"))


def scan(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_weak and links, one row per row of docs.

    Positions are code points, ends exclusive. base_sha256 digests the strong spans as
    kind:start:end, by start and kind in the order listed, comma-joined; spans has all
    reported ones in the same form. A token or name that overlaps a strong span is part of it and
    not reported; an endpoint that holds one is, if another part completes it. links has each
    weak span with the nearest part that completes it, as span>span in order of the weak spans. Null and empty texts have no spans. Repeated rows are scanned one by one;
    other columns are not read.
    """
    settings = settings or Settings()
    scratch = Scratch(docs.sparkSession, "secrets")
    found = parts(docs.select("doc_id", "text"))
    found = scratch.settle(found.withColumn("row_no", F.monotonically_increasing_id()), "parts")
    candidates = scratch.settle(spans(found, settings), "spans")
    nearest = F.col("parts")[0]
    linked = links(candidates, settings).withColumn("to", F.concat_ws(":", nearest.kind, nearest.start, nearest.stop))
    reported = candidates.filter(F.col("kind").isin(*STRONG)).withColumn("to", F.lit(None).cast("string")).unionByName(linked.drop("parts"))
    lists = reported.groupBy("row_no").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "stop", "to"))).alias("all"))
    rows = found.select("row_no", "doc_id").join(lists, "row_no", "left")
    everything = F.coalesce("all", F.array().cast("array<struct<start:bigint,rank:int,kind:string,stop:bigint,to:string>>"))
    rows = rows.withColumn("all", everything)

    def of(kind: str) -> Column:
        return F.size(F.filter("all", lambda s: s.kind == kind)).cast("long")

    def written(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ",")

    base = F.filter("all", lambda s: s["rank"] < len(STRONG))
    weak = F.filter("all", lambda s: s["rank"] >= len(STRONG))
    pairs = F.transform(weak, lambda s: F.concat(F.concat_ws(":", s.kind, s.start, s.stop), F.lit(">"), s["to"]))
    return rows.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in STRONG],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("all")).alias("spans"),
        F.size(weak).cast("long").alias("n_weak"),
        F.array_join(pairs, ",").alias("links"),
    )
