"""The operators' queries in SQL, where SQL can say them."""

from __future__ import annotations

OP1 = """
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM items WHERE len(words) > 0)),
runs AS (
  SELECT row_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS run
  FROM (SELECT row_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)),
found AS (SELECT row_id, i, n, item FROM runs JOIN windows USING (n, run)),
hit AS (
  SELECT row_id, count(DISTINCT place) AS n_hit FROM (SELECT row_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY row_id),
named AS (
  SELECT row_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT row_id, item FROM found) GROUP BY row_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CASE WHEN len(words) > 0 THEN coalesce(n_hit, 0) / len(words) ELSE 0 END AS coverage
FROM docs LEFT JOIN hit USING (row_id) LEFT JOIN named USING (row_id)
"""



def _matches(kind: str, pattern: str, check: str, text: str = "t") -> str:
    """A query for all matches in table ``texts``: row_id, kind, start, end, value; places from the pieces between."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT row_id, '{kind}' AS kind, start, start + length(value) AS stop, value FROM (
    SELECT row_id, value, i,
           CAST(sum(length(gap) + length(value)) OVER (PARTITION BY row_id ORDER BY i) - length(value) AS BIGINT) AS start
    FROM (SELECT row_id, unnest(range(1, len(vals) + 1)) AS i, unnest(vals) AS value, unnest(gaps[1:len(vals)]) AS gap
          FROM (SELECT row_id, regexp_extract_all({text}, '{quoted}') AS vals,
                       regexp_split_to_array({text}, '{quoted}') AS gaps FROM texts)))
  WHERE {check}"""


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_GROUP = _ASSIGN.replace("'", "''")
OP3 = f"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({_matches("assign", _ASSIGN, f"length(regexp_extract(value, '{_GROUP}', 2)) >= 6")}
  UNION ALL {_matches("access", "AKIA[A-Z0-9]+", "length(value) >= 20")}
  UNION ALL {_matches("hex", "[0-9a-f]+", "length(value) >= 24")}),
summed AS (
  SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, list_position(['assign', 'access', 'hex'], kind))
           AS spans
  FROM spans GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN summed USING (row_id)
"""

OP6 = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '') || ':1') AS shuffle
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight FROM sources),
filling AS (
  SELECT *, 3 * source_size / weight AS full_at,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
due AS (
  SELECT source, source_size, weight,
         least(CAST(3 * source_size AS DOUBLE),
               coalesce((SELECT level FROM filling WHERE full_at >= level ORDER BY full_at, source NULLS LAST LIMIT 1),
                        (SELECT max(full_at) FROM filling)) * weight) AS target
  FROM filling),
queued AS (
  SELECT s.doc_id, s.source, s.shuffle, s.size, d.source_size, d.target, d.weight,
         row_number() OVER () AS id,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle, s.doc_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN due d ON s.source IS NOT DISTINCT FROM d.source),
merged AS (
  SELECT id, size, sum(size) OVER (ORDER BY (epoch * source_size + upto) / weight, source, epoch, shuffle, doc_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS position
  FROM queued, range(3) AS e(epoch)),
taken AS (
  SELECT id, CAST(sum(size) AS BIGINT) AS taken FROM merged
  WHERE position <= (SELECT sum(size) FROM sized) GROUP BY id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM queued LEFT JOIN taken USING (id)
"""


OP8 = """
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, text, md5(text) AS digest, string_split(text, chr(10)) AS lines
  FROM documents),
numbered AS (SELECT row_id, doc_id, digest, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs WHERE text IS NOT NULL),
worded AS (
  SELECT *, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS following FROM numbered
  WHERE regexp_matches(lines[i], '[^\x20\x09-\x0D]')),
pairs AS (
  SELECT row_id, doc_id, digest, i AS first, following AS last, array_to_string(lines[i:following], chr(10)) AS body
  FROM worded WHERE following IS NOT NULL),
gone AS (
  SELECT row_id, first, last FROM (
    SELECT *, dense_rank() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, digest, first) AS place FROM pairs)
  WHERE place > 1),
flagged AS (
  SELECT n.row_id, n.i, n.lines[n.i] AS line,
         EXISTS (SELECT 1 FROM gone g WHERE g.row_id = n.row_id AND n.i BETWEEN g.first AND g.last) AS is_gone
  FROM numbered n),
begun AS (
  SELECT *, is_gone AND NOT coalesce(lag(is_gone) OVER (PARTITION BY row_id ORDER BY i), FALSE) AS begins FROM flagged),
summed AS (
  SELECT row_id, string_agg(line, chr(10) ORDER BY i) FILTER (NOT is_gone) AS text, count(*) AS n_lines,
         count(*) FILTER (begins) AS n_chunks, count(*) FILTER (is_gone) AS n_gone
  FROM begun GROUP BY row_id)
SELECT doc_id, CASE WHEN n_chunks > 0 THEN coalesce(s.text, '') ELSE d.text END AS text, coalesce(n_lines, 0) AS n_lines,
       coalesce(n_chunks, 0) AS n_removed_chunks, coalesce(n_gone, 0) AS n_removed_lines
FROM docs d LEFT JOIN summed s USING (row_id)
"""


def _jumps(shards: int, name: str) -> str:
    """The generator's steps, one level of SQL each; a key makes at most ``shards`` jumps."""
    steps = [f"{name}0 AS (SELECT row_id, key, CAST(0 AS BIGINT) AS ahead, CAST(0 AS BIGINT) AS shard FROM keys)"]
    for step in range(1, shards + 1):
        steps.append(
            f"""{name}{step}a AS (
  SELECT row_id, CASE WHEN ahead < {shards} THEN ahead ELSE shard END AS shard, ahead,
         (key * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS key FROM {name}{step - 1}),
{name}{step} AS (
  SELECT row_id, key, shard, CASE WHEN ahead < {shards}
         THEN CAST(floor((shard + 1) * (2147483648.0::DOUBLE / ((key // 8589934592)::DOUBLE + 1.0::DOUBLE))) AS BIGINT)
         ELSE ahead END AS ahead FROM {name}{step}a)"""
        )
    return ",\n".join(steps)


OP10 = f"""
WITH RECURSIVE bits AS (
  SELECT i AS entry, CAST(i AS BIGINT) AS crc, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT entry, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, step + 1 FROM bits WHERE step < 8),
crcs AS (SELECT list(crc ORDER BY entry) AS crc_of FROM bits WHERE step = 8),
digits AS (
  SELECT row_number() OVER () AS row_id, doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS digits,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::HUGEINT AS key
  FROM documents),
bytes AS (
  SELECT row_id, list_transform(range(n), lambda i:
           (instr('0123456789ABCDEF', digits[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', digits[2 * i + 2]) - 1) AS bytes
  FROM digits),
summed AS (
  SELECT row_id, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, byte:
           xor(crc >> 8, crc_of[xor(crc & 255, byte) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM bytes, crcs),
keys AS (SELECT row_id, key FROM digits),
{_jumps(8, "now")},
{_jumps(9, "grown")}
SELECT d.doc_id, d.n + 1 AS size, c.text_crc32, 'key' AS law, CAST(a.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY d.doc_id NULLS FIRST, c.text_crc32, d.n) - 1 AS slot,
       CAST(b.shard AS INTEGER) AS grown_shard
FROM digits d JOIN summed c USING (row_id) JOIN now8 a USING (row_id) JOIN grown9 b USING (row_id)
"""

# The main text of the given pages, which all have one article of known markup.
OP12 = """
WITH articles AS (
  SELECT row_number() OVER () AS row_id, page_id, url, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS article FROM pages),
blocks AS (
  SELECT row_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS part
  FROM (SELECT row_id, regexp_split_to_array(article, '</?(?:p|h[1-6]|div|ul|li)\\b[^>]*>') AS parts FROM articles)),
plain AS (
  SELECT row_id, i, trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(part, '<br[^>]*>', ' ', 'g'), '</?[a-zA-Z][^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '&amp', '&'),
    '\\s+', ' ', 'g')) AS line
  FROM blocks),
joined AS (SELECT row_id, string_agg(line, chr(10) ORDER BY i) AS text FROM plain WHERE line <> '' GROUP BY row_id)
SELECT page_id, url, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars
FROM articles LEFT JOIN joined USING (row_id)
"""

OP13 = """
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents WHERE text IS NOT NULL)),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded WHERE len(words) > 0),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
runs AS (
  SELECT lang, size, words[i:i + size - 1] AS run FROM placed, range(1, 6) AS s(size) WHERE i + size - 1 <= len(words)),
counts AS (SELECT lang, size, run, count(*) AS f FROM runs GROUP BY lang, size, run HAVING count(*) >= 100),
candidates AS (SELECT lang, size, run, f AS a FROM counts WHERE size > 1),
longer AS (
  SELECT DISTINCT lang, part, f FROM (
    SELECT lang, f, unnest([run[1:size - 1], run[2:size]]) AS part FROM counts WHERE size > 2)),
own AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM longer o WHERE o.lang = c.lang AND o.part = c.run AND o.f = c.a)),
cuts AS (
  SELECT o.lang, o.run, o.a, k, p.f AS l, q.f AS r, n,
         (1000::HUGEINT * o.a * n) // (p.f::HUGEINT * q.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM own) o JOIN totals t ON t.lang = o.lang
  JOIN counts p ON p.lang = o.lang AND p.run = o.run[1:k]
  JOIN counts q ON q.lang = o.lang AND q.run = o.run[k + 1:o.size]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, run ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM (SELECT *, array_to_string(run, ' ') AS phrase FROM lowest))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

ORACLES = {"op1_automaton_decontamination": OP1, "op3_blob_ledger_secrets": OP3, "op6_fair_mixing": OP6, "op8_line_chunk_dedup": OP8, "op10_jump_sharding": OP10, "op12_wrapper_extraction": OP12, "op13_automaton_phrases": OP13}
