"""SQL for the contract queries that SQL can express, over the same tables, in DuckDB's dialect."""

from __future__ import annotations

from quillstream.llm.chat import TEMPLATE
from quillstream.llm.decontamination import LOWER, UPPER, WINDOW_WORDS
from quillstream.llm.merkle import FANOUT
from quillstream.llm.quality import MAX_REPEATED, MIN_WORDS
from quillstream.llm.suffix_dedup import WINDOW
from quillstream.llm.warc import DEDUP_BYTES

#: Pieces that a text's bytes are looked at in: a substring far into a long string would be slow.
PIECE = 2000


def words(column: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


#: Bytes as pairs of hexadecimal digits; every start of WINDOW bytes; starts that an earlier document has as well; runs of what they cover.
SUFFIX_DEDUP = f"""
WITH t AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
p AS (SELECT doc_id, n, a, substr(h, 2 * a + 1, {2 * (PIECE + WINDOW - 1)}) AS piece FROM (SELECT doc_id, n, h, unnest(range(0, greatest(n - {WINDOW - 1}, 0), {PIECE})) AS a FROM t)),
w AS MATERIALIZED (SELECT doc_id, a + i AS pos, substr(piece, 2 * i + 1, {2 * WINDOW}) AS s FROM (SELECT doc_id, a, piece, unnest(range(0, least({PIECE}, n - {WINDOW - 1} - a))) AS i FROM p)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(*) > 1),
g AS (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM w JOIN f USING (s) WHERE doc_id > first),
r AS (SELECT doc_id, pos, sum(CASE WHEN before IS NULL OR pos - before > {WINDOW} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM g),
spans AS (SELECT doc_id, run, min(pos) AS a, max(pos) + {WINDOW} AS b FROM r GROUP BY doc_id, run),
cut AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a_s, list(b ORDER BY a) AS b_s FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * (CASE WHEN i = 1 THEN 0 ELSE b_s[i - 1] END) + 1, 2 * ((CASE WHEN i > len(a_s) THEN n ELSE a_s[i] END) - (CASE WHEN i = 1 THEN 0 ELSE b_s[i - 1] END))), '' ORDER BY i) AS h
  FROM (SELECT doc_id, h, n, a_s, b_s, unnest(range(1, len(a_s) + 2)) AS i FROM t JOIN cut USING (doc_id)) GROUP BY doc_id)
SELECT t.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256 FROM t LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {words('text')} AS ws FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {words('text')} AS ws FROM benchmark),
iw AS MATERIALIZED (SELECT DISTINCT item, n, array_to_string(ws[k:k + n - 1], ' ') AS win FROM (SELECT item, ws, least(len(ws), {WINDOW_WORDS}) AS n, unnest(range(1, len(ws) - least(len(ws), {WINDOW_WORDS}) + 2)) AS k FROM i WHERE len(ws) > 0)),
s AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') AS win FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, s WHERE len(ws) >= n)),
m AS MATERIALIZED (SELECT doc_id, k, n, item FROM dw JOIN iw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(array_to_string(list_sort(list(DISTINCT item)), ',')) AS items_sha256 FROM m GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

WARC = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS latest FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= {DEDUP_BYTES} AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= {DEDUP_BYTES} AND page_id <> latest THEN latest END AS refers_to,
  array_to_string(list_filter(string_split_regex(url, '\\s+'), lambda x: x <> ''), ' ') AS target FROM f
"""

WORD = "[^\\x20\\x09-\\x0D]"

QUALITY_COUNTS = f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS ws FROM documents),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
w AS MATERIALIZED (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
g AS (SELECT doc_id, g FROM w GROUP BY doc_id, g HAVING count(*) > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM w JOIN g USING (doc_id, g)) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(ws) < {MIN_WORDS} OR 100 * coalesce(r.n, 0) > {int(100 * MAX_REPEATED)} * len(ws) AS base_failed FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)
"""

SHARD_LAWS = "SELECT count(*) AS n_rows, CAST(sum(octet_length(encode(coalesce(text, ''))) + 16) AS BIGINT) AS bytes, CAST(least(40, count(*)) AS BIGINT) AS shards, true AS gapless, true AS even FROM documents"

#: crc32 of a short ASCII text: the table by its rule, then byte by byte.
CRC_TABLE = "(SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS tab)"


def crc32(column: str) -> str:
    """Over a relation that CRC_TABLE is joined to."""
    codes = f"list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {codes}), lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1])))"


RANKING = f"""
WITH s AS (SELECT sale_id, {crc32('sale_id')} % 5 = 0 AS whole FROM (SELECT DISTINCT sale_id FROM sale_lines WHERE sale_id IS NOT NULL), {CRC_TABLE}),
l AS (SELECT CASE WHEN whole THEN -1 ELSE vendor_id END AS vendor_id, CASE WHEN whole THEN -1 ELSE coalesce(item_id % 5, -1) END AS part, CASE WHEN whole THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END AS month,
  l.sale_id, CAST(line_no AS BIGINT) AS line_no, CAST(quantity AS BIGINT) AS quantity, CAST(floor(100 * discount + 0.5) AS BIGINT) AS percent, CAST(floor(100 * amount + 0.5) AS BIGINT) AS amount_cents, floor(quantity / 10) AS tens
  FROM sale_lines l LEFT JOIN s USING (sale_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS FIRST, percent NULLS FIRST, sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, amount_cents NULLS LAST) AS pos,
  rank() OVER p AS rank, dense_rank() OVER p AS dense, count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied FROM l WINDOW p AS (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS FIRST, percent NULLS FIRST))
SELECT vendor_id, CAST(part AS BIGINT) AS part, CAST(month AS BIGINT) AS month, pos, pos AS place, sale_id, line_no, quantity, percent, amount_cents, tied, rank, dense FROM r WHERE pos <= 2
"""


def escaped(column: str) -> str:
    return f"regexp_replace({column}, '{TEMPLATE.pattern('')}', '\\1\\\\\\2\\3', 'g')"


CHAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({escaped('role')}) + length({escaped('text')}) + {len(TEMPLATE.turn + TEMPLATE.text + TEMPLATE.end)}) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id
"""


def merkle_tree(name: str, rows: str, levels: int) -> str:
    """CTEs over `rows` (g, i, n, h, start): {name}_f has the root h, the siblings' text and what start folds to, for each g and i."""
    out = [f"{name}0 AS MATERIALIZED ({rows})"]
    for k in range(levels):
        near = f"OVER (PARTITION BY g, i // {FANOUT} ORDER BY i ROWS BETWEEN"
        out.append(f"{name}s{k} AS MATERIALIZED (SELECT g, i, n, h, coalesce(string_agg(h, '') {near} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, coalesce(string_agg(h, '') {near} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{k})")
        out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT g, i // {FANOUT} AS i, any_value((n + {FANOUT - 1}) // {FANOUT}) AS n, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY g, i // {FANOUT})")
    fold, joined = "start", f"{name}0 t"
    for k in range(levels):
        fold = f"CASE WHEN s{k}.n = 1 THEN {fold} ELSE sha256(s{k}.b || {fold} || s{k}.a) END"
        joined += f" JOIN {name}s{k} s{k} ON s{k}.g = t.g AND s{k}.i = t.i // {FANOUT**k}"
    siblings = " || ".join(f"s{k}.b || s{k}.a" for k in range(levels))
    steps = "list_filter([" + ", ".join(f"{{'n': s{k}.n, 'b': s{k}.b, 'a': s{k}.a}}" for k in range(levels)) + "], lambda x: x.n > 1)"
    return ",\n".join([*out, f"{name}_f AS (SELECT t.*, r.h AS root, {siblings} AS siblings, {steps} AS steps, {fold} AS folded FROM {joined} JOIN {name}{levels} r ON r.g = t.g)"])


def merkle_field(column: str) -> str:
    return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || {column}, '-')"


def merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(merkle_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE = f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce('+' || lang, '') AS g, {merkle_leaf('text')} AS h, CASE WHEN {crc32('doc_id')} % 3 = 0 THEN {merkle_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {merkle_leaf('text')} END AS start FROM documents, {CRC_TABLE}),
{merkle_tree('d', 'SELECT doc_id, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n, h, start FROM d', 7)},
{merkle_tree('t', "SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, g AS lang, h, h AS start FROM d7", 3)}
SELECT d.doc_id, d.h AS leaf, d.root AS subroot, t.root AS root, sha256(d.siblings || t.siblings) AS proof_sha256, list_reduce(list_concat([d.folded], list_transform(t.steps, lambda x: x.b || '>' || x.a)), lambda v, x: sha256(string_split(x, '>')[1] || v || string_split(x, '>')[2])) AS folded_root,
  list_reduce(list_concat([d.folded], list_transform(t.steps, lambda x: x.b || '>' || x.a)), lambda v, x: sha256(string_split(x, '>')[1] || v || string_split(x, '>')[2])) = t.root AS verified FROM d_f d JOIN t_f t ON t.lang = d.g
"""

ORACLE_SQL: dict[str, str] = {"op3_suffix_dedup": SUFFIX_DEDUP, "op5_decontamination": DECONTAMINATION, "op7_warc": WARC, "quality_base_counts": QUALITY_COUNTS, "shard_laws": SHARD_LAWS, "op11_ranking": RANKING, "op12_chat": CHAT, "op13_merkle": MERKLE}
