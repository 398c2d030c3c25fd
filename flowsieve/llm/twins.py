"""SQL twins of the runs, repairs and shards. DuckDB has no CRC-32, so it is folded byte by byte."""

from __future__ import annotations

_WORD = "[^\\x20\\x09-\\x0D]+"


def _crc(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, unsigned."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    rounds = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: {rounds}), 4294967295)"


RUNS = f"""WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS raw, {_crc("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
t AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(raw) > 0 THEN (h // 10) % len(raw) END AS a FROM d),
p AS (SELECT *, 1 + (len(raw) - a) // (3 + (h // 10) % 8) AS p FROM t),
k AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN raw
    ELSE list_transform(range(len(raw)), lambda i: raw[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS words FROM p),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM k),
g AS (
  SELECT doc_id, i, hash(array_to_string(words[i + 1 : i + 8], ' ')) AS eight, array_to_string(words[i + 1 : i + 8], ' ') AS said, len(words) AS n
  FROM (SELECT doc_id, words, unnest(range(len(words) - 7)) AS i FROM k WHERE len(words) >= 24)),
e AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.eight = y.eight AND x.said = y.said
  WHERE y.i > x.i AND 3 * (y.i - x.i) <= x.n),
s AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
c AS (SELECT doc_id, q, min(i) AS start, count(*) + 7 + q AS length FROM s GROUP BY doc_id, q, island),
m AS (SELECT * FROM c WHERE length >= greatest(24, 3 * q)),
r AS (
  SELECT * FROM m WHERE NOT EXISTS (FROM m AS o WHERE o.doc_id = m.doc_id AND o.q < m.q AND o.start <= m.start
    AND o.start + o.length >= m.start + m.length)),
b AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) AS nth FROM r),
f AS (
  SELECT doc_id, count(*) AS n_runs, max(start) FILTER (nth = 1) AS start, max(length) FILTER (nth = 1) AS length,
    max(q) FILTER (nth = 1) AS period, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS told
  FROM b GROUP BY doc_id),
l AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS said FROM w
  WHERE NOT EXISTS (FROM r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.q AND w.i < r.start + r.length) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
  CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(said, '')) AS collapsed_sha256
FROM d LEFT JOIN f USING (doc_id) LEFT JOIN l USING (doc_id)"""


def _then(state: str, cost: str, edit: str) -> str:
    """A state is its cost in six digits and its edits, so that the least text is the best one."""
    return f"lpad(CAST(CAST(substr({state}, 1, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0') || substr({state}, 7) || '{edit}'"


_FROM = "least(n, s, a)"
REPAIR = f"""WITH RECURSIVE slots AS (
  SELECT *, {_crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS slot
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN slot = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN slot = 1 THEN '' WHEN slot = 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE slot WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM slots),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) || substr(role, 1, 1) AS two
  FROM damaged),
twice AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM numbered),
marked AS (
  SELECT *, NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut FROM twice),
counts AS (
  SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
search AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000' AS n, CAST(NULL AS VARCHAR) AS s, '000002I' AS u, '000004II' AS a
  FROM conversations
  UNION ALL
  SELECT conv_id, i, n, s, u, least(a, {_then("u", "2", "I")}) FROM (
    SELECT conv_id, i, n, s, least(u, {_then(_FROM, "2", "I")}) AS u, a FROM (
      SELECT search.conv_id, m.i, {_then("n", "3", "D")} AS n,
        least({_then("s", "3", "D")}, CASE WHEN stays AND m.role LIKE 's%' THEN {_then("n", "extra", "K")} END) AS s,
        least({_then("u", "3", "D")}, CASE WHEN stays THEN {_then(_FROM, "2 + extra", "R")} END,
          CASE WHEN stays AND m.role LIKE 'u%' THEN {_then(_FROM, "extra", "K")} END) AS u,
        least({_then("a", "3", "D")}, CASE WHEN stays THEN {_then("u", "2 + extra", "R")} END,
          CASE WHEN stays AND m.role LIKE 'a%' THEN {_then("u", "extra", "K")} END) AS a
      FROM search JOIN (SELECT *, NOT blank AND NOT again AS stays, CAST(cut AS INTEGER) AS extra FROM marked) m
        ON search.conv_id = m.conv_id AND m.i = search.i + 1))),
ends AS (
  SELECT search.conv_id, least(n, a) AS best FROM search LEFT JOIN counts USING (conv_id) WHERE i = coalesce(n_rows, 0)),
edits AS (
  SELECT conv_id, edit, k, count(*) FILTER (edit <> 'I') OVER o AS i, count(*) FILTER (edit <> 'D') OVER o AS place,
    count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) AS total
  FROM (SELECT conv_id, unnest(string_split(substr(best, 7), '')) AS edit,
      generate_subscripts(string_split(substr(best, 7), ''), 1) AS k FROM ends WHERE length(best) > 6)
  WINDOW o AS (PARTITION BY conv_id ORDER BY k)),
said AS (
  SELECT e.conv_id, string_agg(CASE WHEN edit = 'K' THEN role
      ELSE CASE WHEN (place + total) % 2 = 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS told
  FROM edits e LEFT JOIN marked m ON e.conv_id = m.conv_id AND e.i = m.i AND edit <> 'I' WHERE edit <> 'D' GROUP BY e.conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(substr(best, 1, 6) AS BIGINT) AS cost,
  substr(best, 7) AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM ends LEFT JOIN counts USING (conv_id) LEFT JOIN said USING (conv_id)"""

SHARDS = f"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc("coalesce(text, '')")} AS text_crc32
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5(concat_ws(':', 13, coalesce(doc_id, -1), text_crc32, size)), doc_id, text_crc32, size)
      - 1 AS rank, count(*) OVER (PARTITION BY source) AS n,
    CAST('0x' || substr(md5('13:' || source), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE) AS start FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (rank + start) / n, source, rank) - 1 AS position, count(*) OVER () AS total FROM r),
s AS (SELECT *, position * 8 // total AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
  position - (shard * total + 7) // 8 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""
