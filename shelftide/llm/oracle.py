"""SQL for the queries that SQL can express."""

from __future__ import annotations

from . import line_dedup, quality

_SPACE = "[\\x20\\x09-\\x0D]"

_RATES = {
    "symbols": "1000 * n_symbols // greatest(n_words, 1)", "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words // greatest(n_words, 1)", "capitals": "1000 * n_capitals // greatest(word_chars, 1)",
}


def _quality() -> str:
    signals = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS signal, {v} AS v FROM counts" for k, v in _RATES.items())
    slack = " ".join(f"WHEN '{k}' THEN {v}" for k, v in quality.SLACK.items())
    over = " OR ".join(f"{v} > u.lim['{k}']" for k, v in _RATES.items())
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_SPACE}'), lambda x: x <> '') AS ws,
        string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT doc_id, unnest(generate_series(1, len(ws))) AS i, unnest(ws) AS x FROM w),
f AS (SELECT doc_id, i, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS five,
    lead(x, 4) OVER o AS last FROM g WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM f WHERE last IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM h, unnest([0, 1, 2, 3, 4]) AS u(k) WHERE n > 1 GROUP BY doc_id),
counts AS (SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(ls, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
       - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
s AS ({signals}),
fine AS (SELECT lang, source, signal, (v >> greatest(length(bin(v)) - {quality.SKETCH_BITS}, 0)) << greatest(length(bin(v)) - {quality.SKETCH_BITS}, 0) AS bucket,
    count(*) AS n FROM s GROUP BY ALL),
lev AS (SELECT 0 AS level, lang, source, signal, bucket, n FROM fine
  UNION ALL SELECT 1, lang, NULL, signal, bucket, sum(n) FROM fine GROUP BY lang, signal, bucket
  UNION ALL SELECT 2, NULL, NULL, signal, bucket, sum(n) FROM fine GROUP BY signal, bucket),
cum AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, signal ORDER BY bucket) AS up,
    sum(n) OVER (PARTITION BY level, lang, source, signal) AS total FROM lev),
q AS (SELECT level, lang, source, signal, max(total) AS total, min(bucket) FILTER (up * 100 >= total * 25) AS q25,
    min(bucket) FILTER (up * 100 >= total * 75) AS q75 FROM cum GROUP BY ALL),
lims AS (SELECT level, lang, source, max(total) AS docs,
    map_from_entries(list((signal, q75 + {quality.FENCE} * (q75 - q25) + CASE signal {slack} END))) AS lim FROM q GROUP BY ALL),
u AS (SELECT a.lang, a.source, CASE WHEN a.docs >= {quality.MIN_GROUP} THEN a.lim WHEN b.docs >= {quality.MIN_GROUP} THEN b.lim ELSE c.lim END AS lim
  FROM lims a JOIN lims b ON b.level = 1 AND b.lang IS NOT DISTINCT FROM a.lang JOIN lims c ON c.level = 2 WHERE a.level = 0),
v AS (SELECT counts.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {over} AS over_limit
  FROM counts JOIN u ON u.lang IS NOT DISTINCT FROM counts.lang AND u.source IS NOT DISTINCT FROM counts.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT over_limit AS kept FROM v"""


def _lines() -> str:
    return f"""
WITH d AS (SELECT doc_id, text, coalesce(source, '') AS site, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, site, unnest(generate_series(1, len(ls))) AS pos, unnest(ls) AS raw FROM d WHERE text IS NOT NULL),
t AS (SELECT doc_id, site, pos, raw, regexp_replace(regexp_replace(raw, '^{_SPACE}+', ''), '{_SPACE}+$', '') AS line FROM l),
b AS (SELECT line, min((doc_id, pos)) AS first FROM t WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}),
k AS (SELECT t.doc_id, count(*) AS n_lines, count(*) FILTER (b.line IS NOT NULL AND (t.doc_id, t.pos) <> b.first) AS n_removed,
    coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (b.line IS NULL OR (t.doc_id, t.pos) = b.first), '') AS kept
  FROM t LEFT JOIN b ON b.line = t.line GROUP BY t.doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(length(coalesce(kept, '')) AS BIGINT) AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""


def _crc32(text: str) -> str:
    """CRC-32 (polynomial 0xEDB88320, bits reversed) of ASCII text, bit by bit."""
    bits = "list_reduce(range(8), lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END, xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: {bits}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _leaf(n_chars: str) -> str:
    texts = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in texts) + ")"


def _merkle() -> str:
    """The trees level by level, then every leaf's siblings by its rank at each level."""
    hashed = "sha256(string_agg(h, '' ORDER BY i))"
    tree = """{t}(k, lvl, i, h, n) AS (SELECT k, 0, i, h, n FROM {base}
  UNION ALL SELECT k, lvl + 1, i // 2, """ + hashed + """, max((n + 1) // 2) FROM {t} WHERE n > 1 GROUP BY k, lvl, i // 2)"""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('.' || lang, '') AS k, {_leaf('n_chars')} AS h,
    CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS now FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM d),
{tree.format(t='low', base='l')},
sub AS (SELECT k AS g, h, row_number() OVER (ORDER BY encode(k)) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
subs AS (SELECT '' AS k, * FROM sub),
{tree.format(t='high', base='subs')},
steps AS (SELECT l.doc_id, l.h AS leaf, l.k, l.i AS rk, low.lvl AS lvl, s.h AS sib, (l.i >> low.lvl) % 2 AS bit
    FROM l JOIN low ON low.k = l.k AND low.i = l.i >> low.lvl AND low.n > 1
    LEFT JOIN low s ON s.k = l.k AND s.lvl = low.lvl AND s.i = xor(low.i, 1)
  UNION ALL SELECT l.doc_id, l.h, l.k, l.i, 1000 + high.lvl, s.h, (sub.i >> high.lvl) % 2
    FROM l JOIN sub ON sub.g = l.k JOIN high ON high.i = sub.i >> high.lvl AND high.n > 1
    LEFT JOIN high s ON s.lvl = high.lvl AND s.i = xor(high.i, 1)),
p AS (SELECT k, rk, list({{'sib': sib, 'bit': bit}} ORDER BY lvl) AS path FROM steps GROUP BY ALL),
f AS (SELECT l.*, coalesce(path, []) AS path, array_to_string(list_transform(list_filter(coalesce(path, []), lambda x: x.sib IS NOT NULL), lambda x: x.sib), '') AS said
  FROM l LEFT JOIN p ON p.k = l.k AND p.rk = l.i),
up(k, i, path, h, j) AS (SELECT k, i, path, now, 1 FROM f
  UNION ALL SELECT k, i, path, sha256(CASE WHEN path[j].sib IS NULL THEN h WHEN path[j].bit = 1 THEN path[j].sib || h ELSE h || path[j].sib END), j + 1
  FROM up WHERE j <= len(path)),
folded AS (SELECT k, i, h AS folded_root FROM up WHERE j = len(path) + 1),
root AS (SELECT h AS root FROM high WHERE n = 1)
SELECT f.doc_id, f.h AS leaf, sub.h AS subroot, root, sha256(said) AS proof_sha256, folded_root, CAST(len(path) AS BIGINT) AS n_levels, folded_root = root AS verified
FROM f JOIN sub ON sub.g = f.k JOIN folded ON folded.k = f.k AND folded.i = f.i CROSS JOIN root"""


def _trie() -> str:
    return f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, {_crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h, conv_id - conv_id % 100 AS base FROM t),
r AS (SELECT c.conv_id, 0 AS part, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d FROM r),
k AS (SELECT conv_id, d, length(text) AS chars, sha256(CAST(to_json(list([role, text]) OVER w) AS VARCHAR)) AS key
  FROM o WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
m AS (SELECT conv_id, 0 AS d, 0 AS chars, '' AS key FROM c UNION ALL SELECT conv_id, d, chars, key FROM k),
p AS (SELECT *, lag(key) OVER w AS parent, lead(d) OVER w IS NULL AS ends FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
n AS (SELECT d, key, parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids FROM p GROUP BY d, key, parent),
kids AS (SELECT d - 1 AS d, parent AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
below AS (SELECT DISTINCT u.d AS top_d, u.key AS top, n.d, n.key, (n.n_convs - 1) * n.chars AS saved, n_children IS NULL AS leaf
  FROM n JOIN p l ON l.conv_id = n.conv_id AND l.d = n.d JOIN p u ON u.conv_id = l.conv_id AND u.d <= n.d
  LEFT JOIN kids ON kids.d = n.d AND kids.key = n.key),
sums AS (SELECT top_d, top, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves FROM below GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(kids.n_children, 0) AS BIGINT) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ids) AS ends_sha256
FROM n JOIN sums ON top_d = n.d AND top = n.key LEFT JOIN kids ON kids.d = n.d AND kids.key = n.key
LEFT JOIN n u ON u.d = n.d - 1 AND u.key = n.parent"""


ORACLE = {"op6_quality_rules": _quality(), "op8_line_dedup": _lines(), "op11_merkle_manifest": _merkle(), "op13_conversation_trie": _trie()}
