"""DuckDB SQL for the queries of the document operators that SQL can express."""

from __future__ import annotations

from wharf.llm.licences import HOLDER, KNOWN, LONG, SPELLINGS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""

LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (
  SELECT doc_id, pos, line,
         regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS key FROM l),
common AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common USING (key) GROUP BY doc_id
"""

MIXING = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5('20240201:' || doc_id), 1, 10))::BIGINT AS place FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
              row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
s AS (SELECT *, CAST(rank % 3 AS INT) AS kind, [5.0, 2.0, 1.0][CAST(rank % 3 AS INT) + 1]::DOUBLE AS weight,
             2.0::DOUBLE * source_size AS most FROM s0),
rounds AS (
  SELECT 0 AS round, rank, kind, weight, most, false AS full_,
         (SELECT 1.5::DOUBLE * sum(source_size) FROM s) / (SELECT sum(weight) FROM s) AS level FROM s
  UNION ALL
  SELECT round + 1, rank, kind, weight, most, full_ OR level * weight > most,
         ((SELECT 1.5::DOUBLE * sum(source_size) FROM s)
           - coalesce(sum(most) FILTER (WHERE full_ OR level * weight > most) OVER (), 0.0))
           / nullif(sum(weight) FILTER (WHERE NOT (full_ OR level * weight > most)) OVER (), 0.0)
  FROM rounds WHERE round < (SELECT count(*) FROM s)),
final AS (SELECT rank, CASE WHEN full_ THEN most ELSE level * weight END AS target FROM rounds
          WHERE round = (SELECT max(round) FROM rounds)),
p AS (
  SELECT d.*, s.source_size, s.kind, f.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2.0::DOUBLE AS middle
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source JOIN final f USING (rank)),
q AS (SELECT *, CASE WHEN size > 0 AND middle < target THEN 1 ELSE 0 END
                + CASE WHEN size > 0 AND source_size + middle < target THEN 1 ELSE 0 END AS times,
             middle / target AS part FROM p)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * times)::BIGINT AS taken,
       CASE WHEN times = 0 THEN NULL
            WHEN kind = 0 THEN 2.0 * part / (0.5 + sqrt(0.25 + 2.0 * part))
            WHEN kind = 1 THEN 2.0 * part / (1.0 + 1.0)
            WHEN part >= 0.625 THEN 0.5 + 2.0 * (part - 0.625) / (1.0 + sqrt(1.0 + -2.0 * (part - 0.625)))
            ELSE 2.0 * part / (1.5 + sqrt(2.25 + -2.0 * part)) END AS first_position
FROM q
"""

DECONTAMINATION = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
ix AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS span, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS words
  FROM iw, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS r(i) WHERE len(w) > 0),
spans AS (SELECT DISTINCT span FROM ix),
dx AS (
  SELECT doc_id, span, i, array_to_string(w[i:i + span - 1], ' ') AS words
  FROM dw, spans, unnest(range(1, greatest(len(w) - span, -1) + 2)) AS r(i)),
hit AS (SELECT DISTINCT doc_id, dx.span, i, words FROM dx SEMI JOIN ix ON dx.words = ix.words AND dx.span = ix.span),
n AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(span)) AS r(j) GROUP BY doc_id),
it AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items
  FROM (SELECT DISTINCT doc_id, span, words FROM hit) h JOIN ix USING (span, words) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""

NEAR_DEDUP = f"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
  FROM dw, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
  FROM sh a JOIN sh b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT u, v FROM both_ JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v
  WHERE 100 * common >= 85 * (nu.n + nv.n - common)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT DISTINCT u AS doc_id, u AS other FROM edges
  UNION SELECT r.doc_id, e.v FROM reach r JOIN edges e ON e.u = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM dw d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

TOOL_CALLS = """
WITH RECURSIVE u AS (
  SELECT conv_id, turn, length(text) AS n, to_json(text)::VARCHAR AS quoted, 'call_' || conv_id || '_' || turn AS call_id
  FROM conversations WHERE role = 'user'),
c AS (
  SELECT conv_id, turn, call_id, n,
         CASE WHEN n % 29 = 0 THEN 'paint' WHEN n % 3 = 0 THEN 'search' WHEN n % 3 = 1 THEN 'fetch' ELSE 'note' END AS tool,
         n % 3 = 2 AND n % 13 = 0 AS broken,
         CASE WHEN n % 3 = 0 THEN '{"limit":' || CASE WHEN n % 7 = 0 THEN '"' || n || '"' ELSE n::VARCHAR END
                || ',"query":' || quoted || '}'
              WHEN n % 3 = 1 THEN CASE WHEN n % 5 = 0 THEN '{' ELSE '{"depth":' || n || ',' END || '"url":' || quoted || '}'
              WHEN n % 2 = 0 THEN '{"colour":1,"text":' || quoted || '}'
              ELSE '{"pinned":true,"text":' || quoted || '}' END AS canonical,
         CASE WHEN turn % 3 <> 0 THEN 'call_' || conv_id || '_' || (turn - 2) END AS a,
         CASE WHEN turn % 5 = 4 THEN 'call_' || conv_id || '_' || (turn + 2) END AS b FROM u),
e AS (
  SELECT d.call_id, d.dep FROM (SELECT call_id, a AS dep FROM c UNION SELECT call_id, b FROM c) d
  JOIN c ON c.call_id = d.dep),
walk AS (
  SELECT call_id, 0 AS level FROM c
  UNION SELECT e.call_id, level + 1 FROM walk JOIN e ON e.dep = walk.call_id WHERE level < 64),
lv AS (SELECT call_id, CASE WHEN max(level) < 64 THEN max(level) END AS level FROM walk GROUP BY call_id),
placed AS (
  SELECT c.*, level, CASE WHEN level IS NOT NULL THEN row_number() OVER (
           PARTITION BY conv_id, level IS NULL ORDER BY level, turn // 256, turn, call_id) - 1 END AS place
  FROM c JOIN lv USING (call_id)),
r AS (SELECT 'call_' || conv_id || '_' || (turn - 1) AS of_, text AS content FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, coalesce(call_id, of_) AS call_id, tool, level, place,
       CASE WHEN call_id IS NULL THEN 'orphan' WHEN level IS NULL THEN 'cycle' WHEN of_ IS NOT NULL THEN 'linked'
            ELSE 'unanswered' END AS status,
       CASE WHEN call_id IS NULL THEN NULL WHEN tool = 'paint' THEN ['unknown tool'] WHEN broken THEN ['not JSON']
            WHEN tool = 'search' AND n % 7 = 0 THEN ['limit: not integer']
            WHEN tool = 'fetch' AND n % 5 = 0 THEN ['depth: missing']
            WHEN tool = 'note' AND n % 2 = 0 THEN ['colour: unknown'] ELSE [] END AS problems,
       CASE WHEN call_id IS NOT NULL THEN '{"arguments":' || CASE WHEN broken THEN 'null' ELSE canonical END
         || ',"id":"' || call_id || '","name":"' || tool || '","result":' || coalesce(to_json(content)::VARCHAR, 'null')
         || '}' END AS message
FROM placed FULL JOIN r ON call_id = of_
"""


def _same_spelling(padded: str) -> str:
    for other, usual in SPELLINGS.items():
        padded = f"replace({padded}, ' {other} ', ' {usual} ')"
    return padded


def _canonical(rows: str) -> str:
    """SQL for (id, lines) of the (id, text) rows: canonical lines without those of copyright holders."""
    one = _same_spelling("' ' || trim(x) || ' '")
    return f"""(SELECT id, list_transform(list_filter(string_split(regexp_replace(lower(coalesce(text, '')),
               '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), chr(10)), lambda x: NOT regexp_matches(trim(x), '{HOLDER}')),
               lambda x: trim({one})) AS lines FROM {rows})"""


_KNOWN_ROWS = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in KNOWN)
_LONG_ROWS = ", ".join(f"('{name}', '{whole}', '{first}', {n}, '{run}')" for name, whole, first, n, run in LONG)


def _parted(text: str) -> str:
    """SQL for a text with the spellings of several words made one."""
    padded = f"' ' || {text} || ' '"
    for other, usual in SPELLINGS.items():
        if " " in other:
            padded = f"replace({padded}, ' {other} ', ' {usual} ')"
    return f"trim({padded})"


_BLOCKS = f"""list_transform(list_filter(list_transform(
    regexp_split_to_array(array_to_string(lines, chr(10)), '\n\n+'), lambda x: trim(replace(x, chr(10), ' '))),
    lambda x: x <> ''), lambda x: md5({_parted("x")}))"""
_WHOLE = _parted("trim(array_to_string(list_filter(lines, lambda x: x <> ''), ' '))")
LICENCE_SCAN = f"""
WITH texts AS (
  SELECT id AS licence, md5({_WHOLE}) AS digest, {_BLOCKS} AS blocks
  FROM {_canonical(f"(SELECT * FROM (VALUES {_KNOWN_ROWS}) AS v(id, text))")}),
long AS (SELECT * FROM (VALUES {_LONG_ROWS}) AS v(licence, digest, first_, n, run)),
known AS (
  SELECT digest, min(licence) AS licence
  FROM (SELECT licence, digest FROM texts UNION ALL SELECT licence, digest FROM long) GROUP BY 1),
runs AS (
  SELECT first_, n, run, min(licence) AS licence FROM (
    SELECT licence, blocks[1] AS first_, len(blocks) AS n, md5(array_to_string(blocks, '')) AS run FROM texts
    UNION ALL SELECT licence, first_, n, run FROM long) WHERE n > 1 GROUP BY 1, 2, 3),
d AS (SELECT id, lines FROM {_canonical("(SELECT doc_id AS id, text FROM documents)")}),
b AS (SELECT id, {_BLOCKS} AS blocks FROM d),
units AS (
  SELECT id, 'whole' AS unit, md5({_WHOLE}) AS digest FROM d WHERE {_WHOLE} <> ''
  UNION ALL SELECT id, 'block', unnest(blocks) FROM b
  UNION ALL SELECT id, 'line', unnest(list_transform(list_filter(lines, lambda x: x <> ''), lambda x: md5(x))) FROM d),
found AS (
  SELECT id, unit, licence FROM units JOIN known USING (digest)
  UNION ALL
  SELECT id, 'run', licence FROM (SELECT id, blocks, unnest(range(1, len(blocks) + 1)) AS pos FROM b)
  JOIN runs ON blocks[pos] = first_ AND md5(array_to_string(blocks[pos:pos + n - 1], '')) = run),
m AS (
  SELECT id, max(licence) FILTER (WHERE unit = 'whole') AS whole, list_sort(list(DISTINCT licence)) AS licences,
         count(*) AS n FROM found GROUP BY id),
n AS (SELECT id, count(*) AS n_units FROM units GROUP BY id)
SELECT d.id AS doc_id, whole, coalesce(array_to_string(licences, ','), '') AS licences, coalesce(m.n, 0) AS n_matches,
       coalesce(n_units, 0) AS n_units
FROM d LEFT JOIN m USING (id) LEFT JOIN n USING (id)
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_HURT = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "(n_chars + 1)", "text"))
#: DuckDB has no crc32: eight table-free rounds a byte of the decimal id.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
         lambda c: ascii(c)::BIGINT)), lambda r, b: list_reduce(list_prepend(xor(r, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""

MANIFEST = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, lang, sha256({_LEAF}) AS leaf,
         CASE WHEN xor({_CRC}, 4294967295) % 7 = 0 AND n_chars IS NOT NULL THEN sha256({_HURT}) END AS hurt
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n FROM l),
nodes AS (
  SELECT lang, 0 AS level, idx, n, leaf AS hash FROM p
  UNION ALL
  SELECT lang, level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 2),
subs AS (
  SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, idx, n, hash FROM subs
  UNION ALL
  SELECT level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY level, idx // 2),
steps AS (
  SELECT p.lang, p.idx, k.level, CAST(floor(p.idx / power(2, k.level)) AS BIGINT) % 2 = 1 AS is_left, b.hash
  FROM p JOIN (SELECT DISTINCT lang, level FROM nodes WHERE n > 1) k ON k.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN nodes b ON b.lang IS NOT DISTINCT FROM p.lang AND b.level = k.level
                   AND b.idx = xor(CAST(floor(p.idx / power(2, k.level)) AS BIGINT), 1)
  UNION ALL
  SELECT p.lang, p.idx, 1000 + k.level, CAST(floor(s.idx / power(2, k.level)) AS BIGINT) % 2 = 1, b.hash
  FROM p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang, (SELECT DISTINCT level FROM tops WHERE n > 1) k
  LEFT JOIN tops b ON b.level = k.level AND b.idx = xor(CAST(floor(s.idx / power(2, k.level)) AS BIGINT), 1)),
ways AS (
  SELECT lang, idx, list(CASE WHEN hash IS NULL THEN '' WHEN is_left THEN 'L' || hash ELSE 'R' || hash END
                         ORDER BY level) AS way,
         coalesce(string_agg(hash, '' ORDER BY level), '') AS proof
  FROM steps GROUP BY lang, idx),
f AS (
  SELECT p.doc_id, p.leaf, s.hash AS subroot, (SELECT hash FROM tops WHERE n = 1) AS root,
         sha256(coalesce(w.proof, '')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(p.hurt, p.leaf), coalesce(w.way, [])), lambda x, y: CASE
           WHEN y[1] = 'L' THEN sha256(y[2:] || x) WHEN y[1] = 'R' THEN sha256(x || y[2:]) ELSE sha256(x) END) AS folded_root
  FROM p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM p.lang AND w.idx = p.idx)
SELECT *, folded_root = root AS verified FROM f
"""
