"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .secrets import RULES

#: Base32 of a SHA-1, five hexadecimal digits (20 bits) at a time.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(s, {5 * g + 1}, 5))::int >> {15 - 5 * p}) % 32 + 1, 1)"
    for g in range(8)
    for p in range(4)
)

OP9 = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS s FROM pages
), named AS (
  SELECT page_id, payload_bytes, {_BASE32} AS payload_digest FROM hashed
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM named
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM firsts
"""


#: CRC-32 of UTF-8 bytes: a table of the 256 values by eight shifts, then a byte at a time.
_SHIFT = "CASE WHEN {0} % 2 = 1 THEN xor({0} >> 1, 3988292384::BIGINT) ELSE {0} >> 1 END"
_CRC_STEPS = "".join(
    f",\nc{i + 1} AS (SELECT n, {_SHIFT.format('v')} AS v FROM c{i})" for i in range(8)
)

_CRC = f"""c0 AS (SELECT i::BIGINT AS n, i::BIGINT AS v FROM range(256) t(i)){_CRC_STEPS},
crc AS (SELECT list(v ORDER BY n) AS codes FROM c8)"""

OP8 = f"""
WITH {_CRC},
docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text, md5('17|' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), summed AS (
  SELECT doc_id, source, h, strlen(text) + 1 AS size,
    xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda c, b: xor(c >> 8, codes[xor(c, b) % 256 + 1])), 4294967295::BIGINT) AS text_crc32
  FROM docs, crc
), ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY h) - 1) / (2 * count(*) OVER (PARTITION BY source)) AS fraction
  FROM summed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, h) - 1 AS place, count(*) OVER () AS n FROM ranked
), dealt AS (
  SELECT *, (place * 8 // n)::INTEGER AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, place - (shard::BIGINT * n + 7) // 8 AS slot, NULL::INTEGER AS grown_shard
FROM dealt
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(size: int, percent: int, kept: str = "") -> str:
    """Components of documents by the similarity of their sets of ``size``-word shingles."""
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < {size} THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - {size - 2}), lambda i: array_to_string(list_slice(words, i, i + {size - 1}), ' ')) END) AS shingle
  FROM split WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING {100 + percent} * count(*) >= {percent} * (x.n + y.n)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM split UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, coalesce(n, 0) AS n_shingles, c.component_id{kept}
FROM split s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
LEFT JOIN sizes z ON z.doc_id = s.doc_id
"""


OP7 = _components(4, 80, ", s.doc_id = c.component_id AS kept")
OP13 = _components(3, 90)


def _op5() -> str:
    """What lies between the matches of a rule, and the matches, in turn, give the places."""
    parts = []
    for place, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least,
  string_split_regex(text, '{pattern}') AS between, regexp_extract_all(text, '{pattern}', 0) AS found,
  regexp_extract_all(text, '{pattern}', {rule.group}) AS groups
FROM documents WHERE regexp_matches(text, '{pattern}')"""
        )
    return f"""
WITH cut AS (
{" UNION ALL ".join(parts)}
), each AS (
  SELECT doc_id, place, kind, least, i, length(between[i]) AS skip, length(found[i]) AS n, length(groups[i]) AS size
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM cut)
), spans AS (
  SELECT doc_id, place, kind, size >= least AS good,
    sum(skip + n) OVER (PARTITION BY doc_id, place ORDER BY i) AS stop, n
  FROM each
), listed AS (
  SELECT doc_id, place, stop - n AS start, kind || ':' || (stop - n)::BIGINT || ':' || stop::BIGINT AS span FROM spans WHERE good
), per AS (
  SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
    count(*) FILTER (place = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base, string_agg(span, ',' ORDER BY start, place) AS spans
  FROM listed GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per p ON p.doc_id = d.doc_id
"""


OP11 = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS one, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS other,
    ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4
  FROM texts
), formed AS (
  SELECT *, least(one, other) AS a, greatest(one, other) AS b,
    CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 >= 90 THEN 'plain'
      WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT *, substr(x, 1, a) AS p, substr(x, a + 1, b - a) AS m, substr(x, b + 1) AS s FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(x) AS restored_sha256
FROM cut
"""

#: The digest of a turn, and the number of turns lent, from the low bits of a CRC-32.
OP12 = f"""
WITH RECURSIVE {_CRC},
turns AS (
  SELECT conv_id AS c, turn, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS t,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT c, md5(t) AS t, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(t)) AS i FROM turns
), ids AS (
  SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(hex(encode(c::VARCHAR)), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda c, b: xor(c >> 8, codes[xor(c, b) % 256 + 1])), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT c FROM placed), crc
), rebuilt AS (
  SELECT ids.c, i, t, words FROM ids JOIN placed p ON p.c = ids.c - ids.c % 20 AND p.i <= h
  UNION ALL SELECT ids.c, i + 4, t, words FROM ids JOIN placed p ON p.c = ids.c AND p.i > h
), members AS (
  SELECT c, string_agg(t, '' ORDER BY i) OVER w AS node, row_number() OVER w AS depth, words
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT c, '', 0, 0 FROM ids
), nodes AS (
  SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words FROM members GROUP BY node, depth
), children AS (
  SELECT left(node, 32 * (depth - 1)::INT) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), own AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * words AS cost,
    CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes n LEFT JOIN children k ON k.node = n.node
), below AS (
  SELECT m.node, sum(leaf) AS n_leaves, sum(cost) AS saved_tokens
  FROM own u JOIN members m ON m.c = u.conv_id AND m.depth <= u.depth GROUP BY m.node
), ends AS (
  SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS listed
  FROM (SELECT c, arg_max(node, depth) AS node FROM members GROUP BY c) GROUP BY node
)
SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs::BIGINT AS n_convs,
  o.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(listed, '')) AS ends_sha256
FROM own o JOIN below b ON b.node = o.node
LEFT JOIN ends e ON e.node = o.node
LEFT JOIN nodes p ON o.depth > 0 AND p.node = left(o.node, 32 * (o.depth - 1)::INT)
"""

SQL = {"op5_secrets": _op5(), "op7_minhash": OP7, "op8_sharding": OP8, "op9_warc": OP9, "op11_fill_in_middle": OP11, "op12_prefix_trie": OP12, "op13_jaccard_join": OP13}
