"""DuckDB SQL of the registered queries that SQL can express.

The others are tested against plain-Python versions in ``tests/llm``.
"""

#: Words of a text: maximal runs without space, \\t, \\n, \\v, \\f, \\r.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {
    "op2_substring_dedup": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS i, w FROM d WHERE len(w) >= 13),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS first FROM k GROUP BY h),
c AS (SELECT DISTINCT doc_id, i + o AS i FROM k JOIN f USING (h), range(0, 13) r(o) WHERE doc_id > first),
x AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS i FROM d),
g AS (SELECT doc_id, count(*) AS n_removed FROM c GROUP BY doc_id),
s AS (SELECT x.doc_id, string_agg(x.x, ' ' ORDER BY x.i) AS t FROM x ANTI JOIN c ON x.doc_id = c.doc_id AND x.i = c.i
      GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(g.n_removed, 0) AS n_removed,
       sha256(coalesce(s.t, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN s USING (doc_id)""",

    "op10_line_windows": r"""WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
         unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, i, regexp_replace(x, '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS x FROM l),
o AS (SELECT doc_id, i, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM n WHERE x <> ''),
w AS (SELECT doc_id, p, x || chr(10) || lead(x, 1) OVER b || chr(10) || lead(x, 2) OVER b AS k
      FROM o WINDOW b AS (PARTITION BY doc_id ORDER BY p)),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS rk FROM w WHERE k IS NOT NULL),
c AS (SELECT DISTINCT doc_id, p + o AS p FROM r, range(0, 3) z(o) WHERE rk > 1),
g AS (SELECT o.doc_id, o.i FROM o JOIN c ON o.doc_id = c.doc_id AND o.p = c.p),
t AS (SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.i) AS t FROM l ANTI JOIN g ON l.doc_id = g.doc_id AND l.i = g.i
      GROUP BY l.doc_id),
a AS (SELECT doc_id, count(*) AS n FROM o GROUP BY doc_id),
b AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.n, 0) AS n_lines, coalesce(b.n, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(t.t, '') END AS text
FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN t USING (doc_id)""",

    "op13_filter_audit": f"""WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e, coalesce(good, false) AS good,
             coalesce(toxic, false) AS toxic FROM t LEFT JOIN l USING (doc_id)),
m AS (SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
             || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS failed, good, toxic, count(*) AS n
      FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
      WHERE p.x <> q.x AND r.x NOT IN (p.x, q.x) AND s.x NOT IN (p.x, q.x, r.x) AND t.x NOT IN (p.x, q.x, r.x, s.x)),
s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, substr(filter_order, CAST(i AS INTEGER), 1) AS filter,
             substr(filter_order, 1, CAST(i - 1 AS INTEGER)) AS before FROM o, range(1, 6) r(i)),
j AS (SELECT part, filter_order, step, filter, n, good, toxic, failed = filter AS sole, contains(failed, filter) AS fails,
             before <> '' AND regexp_matches(failed, '[' || before || '_]') AS early FROM m, s),
g AS (SELECT part, filter_order, step, any_value(filter) AS filter, coalesce(sum(n) FILTER (NOT fails AND NOT early), 0) AS kept,
             coalesce(sum(n) FILTER (fails AND NOT early), 0) AS removed, coalesce(sum(n) FILTER (fails AND early), 0) AS redundant,
             coalesce(sum(n) FILTER (sole), 0) AS unique_fails, coalesce(sum(n) FILTER (fails AND NOT early AND good), 0) AS good_lost,
             coalesce(sum(n) FILTER (fails AND NOT early AND toxic), 0) AS toxic_lost FROM j GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM g""",
}
