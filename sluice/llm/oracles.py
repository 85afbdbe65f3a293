"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from sluice.llm.secrets import BASE, KINDS, PARTNERS, SCOPE


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def secret_links() -> str:
    """Operator 4: matches and gaps as lists, positions by their lengths, and
    plain pair conditions where the Spark query joins on buckets."""
    n = len(BASE)
    cuts = " UNION ALL ".join(
        f"SELECT doc_id, '{k}' AS kind, {i} AS rank, {least} AS least, string_split_regex(t, {_text(p)}) AS gaps, "
        f"regexp_extract_all(t, {_text(p)}) AS found, regexp_extract_all(t, {_text(p)}, 1) AS vals FROM d"
        for i, (k, (p, least)) in enumerate(KINDS.items())
    )
    pairs = " OR ".join(f"w.kind = '{k}' AND p.kind IN ({', '.join(map(_text, v))})" for k, v in PARTNERS.items())
    show = "string_agg(concat_ws(':', kind, CAST(s AS BIGINT), CAST(e AS BIGINT)), ',' ORDER BY s, rank)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
c AS ({cuts}),
i AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM c WHERE len(found) > 0),
s AS (SELECT doc_id, kind, rank, found[i] AS match, length(vals[i]) AS n, least, length(found[i]) AS size,
  list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0) AS s FROM i),
l AS (SELECT doc_id, kind, rank, match, s, s + size AS e FROM s WHERE n >= least),
f AS (SELECT * FROM l WHERE rank < {n} OR (kind <> 'opaque' OR regexp_matches(match, '[0-9]') AND
  regexp_matches(match, '[A-Za-z]')) AND NOT EXISTS (SELECT 1 FROM l b WHERE b.doc_id = l.doc_id AND b.rank < {n}
  AND b.s <= l.s AND b.e >= l.e)),
r AS (SELECT * FROM f WHERE rank < {n} UNION ALL SELECT * FROM f w WHERE rank >= {n} AND EXISTS (SELECT 1 FROM f p
  WHERE p.doc_id = w.doc_id AND ({pairs}) AND (p.s >= w.e AND p.s <= w.e + {SCOPE} OR
  w.s >= p.e AND w.s <= p.e + {SCOPE} OR p.rank < {n} AND p.s < w.e AND w.s < p.e))),
g AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
  coalesce({show} FILTER (rank < {n}), '') AS base, {show} AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""


def hard_negatives() -> str:
    """Operator 11: every anchor against every row, ranked."""
    return """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND
  len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
r AS (SELECT row_number() OVER (ORDER BY vec_id) AS i, * FROM v),
s AS (SELECT a.i AS a, a.vec_id AS anchor_id, b.i AS b, b.vec_id AS vec_id, a.label = b.label AS same,
  CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score FROM r a JOIN r b ON a.i <> b.i AND len(a.x) = len(b.x)
  WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
  s.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id, s.b) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5"""


def prefix_trie() -> str:
    """Operator 13: the rebuilt turns as lists, nodes as equal lists, subtrees
    by comparing every two nodes; CRC-32 bit by bit."""
    bit = "CASE WHEN {0} % 2 = 1 THEN xor({0} // 2, 3988292384) ELSE {0} // 2 END"
    return f"""
WITH RECURSIVE c AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT conv_id, 0 AS i, 4294967295::BIGINT AS v FROM c UNION ALL
  SELECT conv_id, i + 1, {bit.format("x")} FROM (SELECT conv_id, i,
  CASE WHEN i % 8 = 0 THEN xor(v, ascii(CAST(conv_id AS VARCHAR)[i // 8 + 1])::BIGINT) ELSE v END AS x
  FROM r WHERE i < 8 * length(CAST(conv_id AS VARCHAR)))),
h AS (SELECT conv_id, xor(v, 4294967295) % 9 AS h FROM r WHERE i = 8 * length(CAST(conv_id AS VARCHAR))),
o AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}}
  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t FROM conversations GROUP BY conv_id),
b AS (SELECT o.conv_id, list_concat(coalesce(list_slice(a.t, 1, h), []), list_slice(o.t, h + 1, len(o.t))) AS t
  FROM o JOIN h USING (conv_id) LEFT JOIN o a ON a.conv_id = o.conv_id - o.conv_id % 5),
p AS (SELECT conv_id, d, list_slice(t, 1, d) AS p, d = len(t) AS ends FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM b)),
n AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends FROM p GROUP BY p, d),
k AS (SELECT n.*, a.conv_id AS parent_conv_id, coalesce((n.n_convs - 1) * strlen(list_extract(n.p, n.d).x), 0) AS saved,
  (SELECT count(*) FROM n m WHERE m.d = n.d + 1 AND list_slice(m.p, 1, n.d) = n.p) AS n_children
  FROM n LEFT JOIN n a ON a.d = n.d - 1 AND a.p = list_slice(n.p, 1, n.d - 1) AND n.d > 0)
SELECT k.conv_id, k.d AS depth, k.parent_conv_id, k.n_convs, k.n_children,
  CAST(count(*) FILTER (m.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(m.saved) AS BIGINT) AS saved_tokens,
  sha256(k.ends) AS ends_sha256
FROM k JOIN k m ON m.d >= k.d AND list_slice(m.p, 1, k.d) = k.p
GROUP BY k.conv_id, k.d, k.parent_conv_id, k.n_convs, k.n_children, k.ends"""
