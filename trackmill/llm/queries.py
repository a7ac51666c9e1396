"""One query per operator, over its whole table, with equal SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackmill.llm import chat, decontaminate, html_blocks, merkle, mixing, near_dedup, outliers, pii, quality_qda, repair, secrets, suffix_dedup, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Lower-cases A-Z alone.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w ELSE
         list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words
), items AS (
  SELECT doc_id, unnest(s) AS item FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)
), reach(node, other) AS (
  SELECT doc_id, doc_id FROM sets UNION
  SELECT reach.node, p.b FROM reach JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) p ON reach.other = p.a
), least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON node = doc_id""")
def op1_near_duplicates(spark, folder):
    found = near_dedup.near_duplicates(table(spark, folder, "documents"), near_dedup.Settings(words=2))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query(r"""
WITH payloads AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), bits AS (
  SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(1, 41), lambda i:
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', h[i])]), '') AS b
  FROM payloads
), firsts AS (
  SELECT h, min(page_id) AS first FROM payloads GROUP BY h
)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * CAST(substr(b, i * 5 + 1, 1) AS INT) + 8 * CAST(substr(b, i * 5 + 2, 1) AS INT) + 4 * CAST(substr(b, i * 5 + 3, 1) AS INT)
    + 2 * CAST(substr(b, i * 5 + 4, 1) AS INT) + CAST(substr(b, i * 5 + 5, 1) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits JOIN firsts USING (h)""")
def op2_warc_archives(spark, folder):
    return warc.archived(table(spark, folder, "pages"))


@query(r"""
WITH articles AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS a FROM pages
), pieces AS (
  SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(a, '</?(?:p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), chr(1)) AS p
  FROM articles
), decoded AS (
  SELECT page_id, url, list_transform(p, lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(x, '&quot;', '"'), '&#x27;', ''''),
         '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS p FROM pieces
), texts AS (
  SELECT page_id, url, array_to_string(list_filter(p, lambda x: x <> ''), chr(10)) AS text FROM decoded
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts""")
def op3_main_text(spark, folder):
    return html_blocks.main_text(table(spark, folder, "pages"))


@query()
def op4_source_mix(spark, folder):
    return mixing.mix(table(spark, folder, "documents")).drop("copies")


_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query(rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM benchmark
), lengths AS (
  SELECT DISTINCT least(10, len(w)) AS n FROM items WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM items WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, lengths)
), hits AS (
  SELECT doc_id, n, p, item_id FROM doc_windows JOIN item_windows USING (n, win)
), words AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS spot FROM hits) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)""")
def op5_contamination(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_CONTROL = "</s>[INST] ok [/INST]"


@query(rf"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_CONTROL}'), (-7, 1, 'assistant', '{_CONTROL}')
), sized AS (
  SELECT *, length(replace(replace(replace(text, '\', '\s'), '<', '\l'), '[', '\b')) AS body,
         length(replace(replace(replace(role, '\', '\s'), '<', '\l'), '[', '\b')) AS head,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS no FROM turns
), counted AS (
  SELECT *, CAST(ceil(body / 4) + 4 AS BIGINT) AS tokens, no = 1 AND role = 'system' AS is_system, 19 + head + body AS chars FROM sized
), summed AS (
  SELECT *, sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY no) AS so_far,
         sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id) AS total,
         coalesce(sum(CASE WHEN is_system THEN tokens END) OVER (PARTITION BY conv_id), 0) AS system_tokens,
         coalesce(sum(CASE WHEN is_system THEN chars END) OVER (PARTITION BY conv_id), 0) AS system_chars FROM counted
), roomy AS (
  SELECT *, so_far - tokens AS before, least(128, greatest(0, 1024 - system_tokens - tokens)) AS history FROM summed WHERE NOT is_system
), limited AS (
  SELECT t.conv_id, t.no, t.before, t.so_far, t.history, t.chars, t.system_chars,
         t.before + greatest(t.tokens, 1024 - t.system_tokens - (t.before - (SELECT min(e.before) FROM roomy e WHERE e.conv_id = t.conv_id AND e.before <= t.before AND e.before >= t.before - t.history))) AS lim
  FROM roomy t
), walk(conv_id, no, start, lim) AS (
  SELECT conv_id, no, before, lim FROM limited WHERE before = 0
  UNION ALL
  SELECT l.conv_id, l.no, CASE WHEN l.so_far <= w.lim THEN w.start ELSE l.before END, CASE WHEN l.so_far <= w.lim THEN w.lim ELSE l.lim END
  FROM walk w JOIN limited l ON l.conv_id = w.conv_id AND l.no = w.no + 1
), opened AS (
  SELECT DISTINCT l.conv_id, l.before, l.history, l.system_chars FROM walk w JOIN limited l ON l.conv_id = w.conv_id AND l.before = w.start
), written AS (
  SELECT conv_id, sum(chars) AS chars FROM (
    SELECT conv_id, chars FROM limited
    UNION ALL SELECT conv_id, system_chars FROM opened
    UNION ALL SELECT o.conv_id, l.chars FROM opened o JOIN limited l ON l.conv_id = o.conv_id AND l.before < o.before AND l.before >= o.before - o.history
  ) GROUP BY conv_id
  UNION ALL SELECT conv_id, sum(system_chars) FROM summed GROUP BY conv_id HAVING count(*) = 1 AND bool_and(is_system)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(any_value(chars) AS BIGINT) AS formatted_chars
FROM turns JOIN written USING (conv_id) GROUP BY conv_id""")
def op6_chat_windows(spark, folder):
    control = spark.sql(
        f"SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{_CONTROL}' AS text "
        "FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.windows(turns.unionByName(control)))


def _scan_sql(rank: int, kind: str, pattern: str) -> str:
    """Matches of one kind: texts between them, and they themselves."""
    pattern = pattern.replace("'", "''")
    value = 2 if kind == "assign" else 0
    return (
        f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits, "
        f"regexp_extract_all(t, '{pattern}', {value}) AS vals FROM texts WHERE regexp_matches(t, '{pattern}')"
    )


#: SQL's patterns look neither ahead nor behind; whole runs are taken, and filtered afterwards.
_PATTERNS = secrets.PATTERNS | {"opaque": "[A-Za-z0-9+/_=-]{20,}"}
_NEAR = " OR ".join(
    f"(w.kind = '{weak}' AND o.kind IN ({', '.join(repr(k) for k in kinds)}))" for weak, kinds in secrets.COMPLEMENTS.items()
)


@query(f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
scans AS ({' UNION ALL '.join(_scan_sql(i, k, p) for i, (k, p) in enumerate(_PATTERNS.items()))}),
placed AS (
  SELECT doc_id, rank, kind, hits[i] AS hit, vals[i] AS val,
         CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM scans)
), spans AS (
  SELECT doc_id, rank, kind, start, start + length(hit) AS stop, rank < 3 AS strong FROM placed
  WHERE (kind <> 'assign' OR length(val) >= 8)
    AND (kind <> 'opaque' OR (regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]')))
), bare AS (
  SELECT * FROM spans w WHERE strong OR kind = 'endpoint' OR NOT EXISTS (
    SELECT 1 FROM spans s WHERE s.strong AND s.doc_id = w.doc_id AND ((s.start <= w.start AND s.stop > w.start) OR (s.start >= w.start AND s.start < w.stop)))
), pairs AS (
  SELECT w.doc_id, w.rank, w.start, first(o.kind || ':' || o.start || ':' || o.stop ORDER BY abs(o.start - w.start), o.start, o.rank) AS part
  FROM bare w JOIN bare o ON o.doc_id = w.doc_id AND abs(o.start - w.start) <= 400 AND ({_NEAR}) AND (o.stop <= w.start OR o.start >= w.stop)
  WHERE NOT w.strong GROUP BY ALL
), reported AS (
  SELECT bare.*, part FROM bare LEFT JOIN pairs USING (doc_id, rank, start) WHERE strong OR part IS NOT NULL
), lists AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         count(*) FILTER (NOT strong) AS n_weak, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (strong) AS base,
         string_agg(kind || ':' || start || ':' || stop || '>' || part, ',' ORDER BY start, rank) FILTER (NOT strong) AS links
  FROM reported GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, CAST(coalesce(n_weak, 0) AS BIGINT) AS n_weak, coalesce(links, '') AS links
FROM texts LEFT JOIN lists USING (doc_id)""")
def op7_secret_scan(spark, folder):
    return secrets.scan(table(spark, folder, "documents"))


@query()
def op8_quality_scores(spark, folder):
    return quality_qda.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op9_surrogates(spark, folder):
    return pii.with_surrogates(table(spark, folder, "documents"))


@query()
def op10_quality_rules(spark, folder):
    return outliers.verdicts(table(spark, folder, "documents"))


@query("""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS rid, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), strings AS (
  SELECT doc_id, rid, base + p AS p, substr(part, 2 * p + 1, 100) AS s FROM (
    SELECT doc_id, rid, base, part, unnest(range(length(part) // 2 - 49)) AS p FROM (
      SELECT doc_id, rid, base, substr(h, 2 * base + 1, 698) AS part FROM (SELECT doc_id, rid, h, unnest(range(0, length(h) // 2, 300)) AS base FROM texts)))
), least AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s
), starts AS (
  SELECT rid, p, p - lag(p) OVER (PARTITION BY rid ORDER BY p) AS step FROM strings JOIN least USING (s) WHERE first < doc_id
), numbered AS (
  SELECT rid, p, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY p) AS no FROM starts
), spans AS (
  SELECT rid, no, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY rid, no
), pieces AS (
  SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS since FROM spans
), kept AS (
  SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS k
  FROM pieces JOIN texts USING (rid) GROUP BY rid
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (rid)""")
def op11_suffix_dedup(spark, folder):
    return suffix_dedup.cleaned(table(spark, folder, "documents"))


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    byte = f"list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {byte}), 4294967295)"


def _cost(value: str, more: object, letter: str) -> str:
    """Of costs with audits behind them, as texts that sort by cost and then by audit."""
    return f"lpad(CAST(CAST(left({value}, 9) AS BIGINT) + {more} AS VARCHAR), 9, '0') || substr({value}, 10) || '{letter}'"


def _takes(state: str, initial: str) -> str:
    """Keeping or changing a row into the expected role, where it may stay."""
    keep = f"CASE WHEN initial = '{initial}' THEN {_cost(state, 'extra', 'K')} END"
    return f"CASE WHEN fault NOT IN (1, 2) THEN least({keep}, {_cost(state, '1 + extra', 'R')}) END"


_U = f"least(v2, {_cost('v0', 5, 'I')}, {_cost('v1', 5, 'I')}, {_cost('v3', 5, 'I')})"
_A = f"least(v3, {_cost('u', 5, 'I')})"
_LATTICE_STEP = f"""
  SELECT conv, no + 1, {_cost('v0', 2, 'D')},
         least({_cost('v1', 2, 'D')}, CASE WHEN fault NOT IN (1, 2) AND initial = 's' THEN {_cost('v0', 'extra', 'K')} END),
         least({_cost('u', 2, 'D')}, {_takes('v0', 'u')}, {_takes('v1', 'u')}, {_takes('a', 'u')}), least({_cost('a', 2, 'D')}, {_takes('u', 'a')})"""


@query(rf"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS hit FROM conversations
), damaged AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), '-') AS conv, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM marked
), numbered AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS no FROM damaged
), faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY no) > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 3 ELSE 0 END AS fault,
         lag(initial) OVER (PARTITION BY conv ORDER BY no) || initial AS pair FROM numbered
), rows AS (SELECT *, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS extra FROM faulty
), convs AS (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '-') AS conv FROM conversations
), counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows GROUP BY conv
), lattice(conv, no, v0, v1, v2, v3) AS (
  SELECT conv, 0::BIGINT, '000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM convs
  UNION ALL
  {_LATTICE_STEP} FROM (SELECT *, {_A} AS a FROM (SELECT *, {_U} AS u FROM lattice)) JOIN (SELECT conv AS c, no AS r, initial, fault, extra FROM rows) ON c = conv AND r = no + 1
), best AS (
  SELECT conv, least(v0, {_A}) AS best FROM (SELECT *, {_U} AS u FROM lattice) JOIN (SELECT conv, coalesce(n, 0) AS n FROM convs LEFT JOIN counts USING (conv)) USING (conv) WHERE no = n
), walk(conv, audit, k, no, last, out) AS (
  SELECT conv, substr(best, 10), 1::BIGINT, 1::BIGINT, '', CAST([] AS VARCHAR[]) FROM best
  UNION ALL
  SELECT w.conv, audit, k + 1, CASE WHEN letter = 'I' THEN w.no ELSE w.no + 1 END,
         CASE letter WHEN 'D' THEN last WHEN 'K' THEN initial ELSE left(expected, 1) END,
         CASE letter WHEN 'D' THEN out WHEN 'K' THEN list_append(out, role || ':' || text)
                     WHEN 'R' THEN list_append(out, expected || ':' || text) ELSE list_append(out, expected || ':') END
  FROM (SELECT *, substr(audit, k, 1) AS letter, CASE WHEN last = 'u' THEN 'assistant' ELSE 'user' END AS expected FROM walk WHERE k <= length(audit)) w
  LEFT JOIN rows r ON r.conv = w.conv AND r.no = w.no
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit, sha256(array_to_string(out, chr(10))) AS repaired_sha256
FROM convs LEFT JOIN counts USING (conv) JOIN best USING (conv) JOIN walk USING (conv) WHERE k = length(audit) + 1""")
def op12_conversation_repair(spark, folder):
    return repair.repaired(table(spark, folder, "conversations"))


def _coded(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


_HEAD = " || ".join(_coded(c) for c in ("doc_id", "source", "lang", "n_chars"))


@query(f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({_HEAD} || {_coded("text")}) AS leaf,
         sha256({_HEAD} || CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_coded("replace(text, chr(10), '')")} ELSE {_coded("text")} END) AS changed
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, row_number() OVER () AS rid FROM hashed
), inner_nodes(tree, lvl, idx, h, n) AS (
  SELECT tree, 0, idx, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM inner_nodes WHERE n > 1 GROUP BY tree, lvl, idx // 3
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS spot FROM inner_nodes WHERE n = 1
), top_nodes(lvl, idx, h, n) AS (
  SELECT 0, spot, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM top_nodes WHERE n > 1 GROUP BY lvl, idx // 3
), inside(rid, tree, lvl, idx, folded, proof, n) AS (
  SELECT rid, tree, 0, idx, changed, '', count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL
  SELECT p.rid, p.tree, p.lvl + 1, p.idx // 3, sha256(string_agg(CASE WHEN s.idx = p.idx THEN p.folded ELSE s.h END, '' ORDER BY s.idx)),
         any_value(p.proof) || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx <> p.idx), ''), (any_value(p.n) + 2) // 3
  FROM inside p JOIN inner_nodes s ON s.tree = p.tree AND s.lvl = p.lvl AND s.idx // 3 = p.idx // 3 WHERE p.n > 1 GROUP BY p.rid, p.tree, p.lvl, p.idx
), above(rid, lvl, idx, folded, proof, n) AS (
  SELECT rid, 0, spot, folded, proof, (SELECT count(*) FROM subroots) FROM inside JOIN subroots USING (tree) WHERE n = 1
  UNION ALL
  SELECT p.rid, p.lvl + 1, p.idx // 3, sha256(string_agg(CASE WHEN s.idx = p.idx THEN p.folded ELSE s.h END, '' ORDER BY s.idx)),
         any_value(p.proof) || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx <> p.idx), ''), (any_value(p.n) + 2) // 3
  FROM above p JOIN top_nodes s ON s.lvl = p.lvl AND s.idx // 3 = p.idx // 3 WHERE p.n > 1 GROUP BY p.rid, p.lvl, p.idx
)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.h AS verified
FROM leaves JOIN subroots USING (tree) JOIN (SELECT * FROM above WHERE n = 1) USING (rid), (SELECT h FROM top_nodes WHERE n = 1) t""")
def op13_merkle_manifest(spark, folder):
    return merkle.manifest(table(spark, folder, "documents"))
