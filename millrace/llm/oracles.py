"""ANSI SQL for the queries that SQL can express, over ``documents`` and ``embeddings``."""

from __future__ import annotations

from . import secrets


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: As secrets.ASSIGN, with the letters in either case spelled out: engines whose
#: patterns ignore case for all of Unicode would take more.
_ASSIGN = "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_PATTERNS = (_ASSIGN, secrets.ACCESS, secrets.HEX, secrets.RUN)


def _hits(rank: int) -> str:
    p = _PATTERNS[rank]
    value = f"regexp_extract(h[i], '{p}', 2)" if rank == 0 else "h[i]"
    return f"""SELECT row, {rank} AS rank, {value} AS v, length(h[i]) AS n,
   list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:(i - 1)], lambda x: length(x))), 0) AS start
   FROM (SELECT row, g, h, unnest(range(1, len(h) + 1)) AS i FROM (SELECT row, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}', 0) AS h FROM d))"""


OP1 = f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, source AS owner, lang AS repository FROM documents),
 raw AS (SELECT *, start + n AS stop, regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND NOT regexp_matches(v, '{secrets.PLACEHOLDER}') AND len(list_distinct(string_split(v, ''))) >= 9 AS live
   FROM ({" UNION ALL ".join(map(_hits, range(4)))})),
 base AS (SELECT * FROM raw WHERE rank IN (1, 2) OR rank = 0 AND length(v) >= {secrets.ASSIGN_LEAST}),
 occ AS (SELECT * FROM base UNION ALL SELECT * FROM raw r WHERE rank = 3 AND live AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row = r.row AND b.start < r.stop AND r.start < b.stop)),
 held AS (SELECT v, count(DISTINCT coalesce(owner, chr(1))) AS owners, count(DISTINCT coalesce(owner, chr(1)) || chr(2) || coalesce(repository, chr(1))) AS repositories, bool_or(rank < 3) AS base FROM occ JOIN d USING (row) GROUP BY v),
 span AS (SELECT row, start, stop, CASE WHEN rank < 3 THEN rank WHEN base THEN 3 WHEN owners = 1 THEN 4 END AS rank, CASE WHEN owners >= 3 THEN 'copied' WHEN owners = 1 AND live THEN CASE WHEN repositories = 1 THEN 'live' ELSE 'template' END ELSE 'shared' END AS verdict FROM occ JOIN held USING (v)),
 named AS (SELECT *, ['assign', 'access', 'hex', 'leak', 'owned'][rank + 1] || ':' || start || ':' || stop AS s FROM span WHERE rank IS NOT NULL)
SELECT d.doc_id, count(*) FILTER (WHERE rank = 0)::BIGINT AS n_assign, count(*) FILTER (WHERE rank = 1)::BIGINT AS n_access, count(*) FILTER (WHERE rank = 2)::BIGINT AS n_hex,
 sha256(coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (WHERE rank < 3), '')) AS base_sha256, coalesce(string_agg(s, ',' ORDER BY start, rank), '') AS spans,
 count(*) FILTER (WHERE verdict = 'live')::BIGINT AS n_live, count(*) FILTER (WHERE verdict = 'template')::BIGINT AS n_template, count(*) FILTER (WHERE verdict = 'copied')::BIGINT AS n_copied
FROM d LEFT JOIN named USING (row) GROUP BY d.row, d.doc_id"""

OP7 = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
 good AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS m FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
   WHERE list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])) / (a.m * b.m) >= 0.98),
 reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
 least AS (SELECT a, min(b) AS c FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least.c AS component_id, vec_id = least.c AS kept FROM v JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id"""
