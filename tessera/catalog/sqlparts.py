"""Shared SQL fragments for the DuckDB twins."""

# The web log rendered from events, computed straight from the table: what a
# line says (the _text columns) and what is read from it.
LOGS_CTE = r"""
WITH raw AS (
  SELECT *, '/' || event_type || '/' || regexp_extract(props, '(\d+)', 1) AS url,
         CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 200 WHEN 'signup' THEN 302
              WHEN 'purchase' THEN 304 WHEN 'error' THEN 404 ELSE 500 END AS code FROM events),
logs AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) || '.example.com' AS host,
         CASE WHEN event_id % 101 = 0 THEN '' ELSE url END AS path,
         CAST(CASE WHEN event_id % 107 = 0 THEN NULL ELSE code END AS INTEGER) AS status,
         event_type <> 'error' AND event_id % 103 <> 0 AS size_ok,
         CAST(CASE WHEN event_type = 'error' OR event_id % 103 = 0 THEN 0 ELSE floor(value) END AS INTEGER) AS content_size,
         date_trunc('second', ts) AS time,
         CASE WHEN event_id % 101 = 0 THEN 'GET HTTP/1.0' ELSE 'GET ' || url || ' HTTP/1.0' END AS request_text,
         CASE WHEN event_id % 107 = 0 THEN substr(code::VARCHAR, 1, 1) || 'x' || substr(code::VARCHAR, 3, 1)
              ELSE code::VARCHAR END AS status_text,
         CASE WHEN event_id % 103 = 0 THEN 'x' ELSE '' END
           || CASE WHEN event_type = 'error' THEN '-' ELSE CAST(floor(value)::BIGINT AS VARCHAR) END AS size_text
  FROM raw)
"""

# Linkage tokens: lower-cased \W+ split, empties and stop words removed.
STOPWORDS_SQL = ("['a','an','and','are','as','at','be','but','by','for','if','in','into','is','it',"
                 "'no','not','of','on','or','such','that','the','their','then','there','these','they',"
                 "'this','to','was','will','with']")


def tokens_expr(col: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower({col}), '\\W+'), "
            f"lambda t: t <> '' AND NOT list_contains({STOPWORDS_SQL}, t))")


LINK_CTE = r"""
WITH ra AS (SELECT item_id AS rec_id, {ta} AS tokens FROM benchmark),
     rb AS (SELECT doc_id AS rec_id, {tb} AS tokens FROM documents),
     corpus AS (SELECT 'A' AS source, rec_id, tokens FROM ra UNION ALL SELECT 'B', rec_id, tokens FROM rb),
     ncorp AS (SELECT count(*)::DOUBLE AS n FROM corpus),
     idf AS (SELECT token, (SELECT n FROM ncorp) / count(*) AS idf
             FROM (SELECT DISTINCT source, rec_id, unnest(tokens) AS token FROM corpus) GROUP BY token),
     tfa AS (SELECT rec_id, token, count(*) / max(n) AS tf
             FROM (SELECT rec_id, len(tokens) AS n, unnest(tokens) AS token FROM ra) GROUP BY rec_id, token),
     tfb AS (SELECT rec_id, token, count(*) / max(n) AS tf
             FROM (SELECT rec_id, len(tokens) AS n, unnest(tokens) AS token FROM rb) GROUP BY rec_id, token),
     wa AS (SELECT rec_id, token, tf * idf AS w FROM tfa JOIN idf USING (token)),
     wb AS (SELECT rec_id, token, tf * idf AS w FROM tfb JOIN idf USING (token)),
     na AS (SELECT rec_id, sqrt(sum(w * w)) AS norm FROM wa GROUP BY rec_id),
     nb AS (SELECT rec_id, sqrt(sum(w * w)) AS norm FROM wb GROUP BY rec_id),
     ua AS (SELECT rec_id, token, w / norm AS u FROM wa JOIN na USING (rec_id)),
     ub AS (SELECT rec_id, token, w / norm AS u FROM wb JOIN nb USING (rec_id)),
     sims AS (SELECT a.rec_id AS id_a, b.rec_id AS id_b, sum(a.u * b.u) AS sim
              FROM ua a JOIN ub b USING (token) GROUP BY a.rec_id, b.rec_id),
     gold AS (SELECT b.item_id AS id_a, d.doc_id AS id_b FROM benchmark b JOIN documents d
              ON length(b.text) > 0 AND contains(d.text, b.text))
""".replace("{ta}", tokens_expr("text")).replace("{tb}", tokens_expr("text"))


def jacobi_cte(dims: int, sweeps: int = 10, cov: str = "cov") -> str:
    """CTEs ``eig`` (rank, value) and ``vec`` (rank, pos, x): the eigenpairs of the
    symmetric matrix ``cov`` (i, j, v) of even size, values falling, vectors with their
    entry of largest magnitude positive.  Every step rotates dims / 2 disjoint pairs of
    rows at once, paired as in a round-robin tournament; part 0 is the matrix, part 1
    the product of the rotations."""
    last = dims - 1
    return f"""
turn AS (SELECT s, i, CASE WHEN i = {last} THEN s WHEN i = s THEN {last} ELSE (2 * s - i + 2 * {last}) % {last} END AS j
         FROM range({last}) a(s), range({dims}) b(i)),
jac AS (
  SELECT 0 AS step, 0 AS part, i, j, v FROM {cov}
  UNION ALL SELECT 0, 1, a.k, b.k, CASE WHEN a.k = b.k THEN 1.0 ELSE 0.0 END FROM range({dims}) a(k), range({dims}) b(k)
  UNION ALL
  (WITH now AS (SELECT * FROM jac WHERE step < {sweeps * last}),
   m AS (SELECT i, j, v FROM now WHERE part = 0),
   pairs AS (SELECT t.i AS p, t.j AS q, pp.v AS pp, qq.v AS qq, pq.v AS pq
             FROM turn t JOIN m pp ON pp.i = t.i AND pp.j = t.i JOIN m qq ON qq.i = t.j AND qq.j = t.j
                  JOIN m pq ON pq.i = t.i AND pq.j = t.j
             WHERE t.i < t.j AND t.s = (SELECT max(step) FROM now) % {last}),
   angle AS (SELECT p, q, CASE WHEN abs(pq) < 1e-300 THEN 0.0 ELSE
                    (CASE WHEN qq >= pp THEN 1 ELSE -1 END) / (abs((qq - pp) / (2 * pq)) + sqrt(1 + ((qq - pp) / (2 * pq)) ^ 2))
                    * (CASE WHEN pq >= 0 THEN 1 ELSE -1 END) END AS t FROM pairs),
   g AS (SELECT p AS a, p AS b, 1 / sqrt(1 + t * t) AS c FROM angle UNION ALL SELECT q, q, 1 / sqrt(1 + t * t) FROM angle
         UNION ALL SELECT p, q, t / sqrt(1 + t * t) FROM angle UNION ALL SELECT q, p, -t / sqrt(1 + t * t) FROM angle),
   cols AS (SELECT part, step, n.i, g.b AS j, sum(n.v * g.c) AS v FROM now n JOIN g ON n.j = g.a GROUP BY ALL),
   both_ AS (SELECT part, step, g.b AS i, n.j, sum(n.v * g.c) AS v FROM cols n JOIN g ON n.i = g.a WHERE part = 0 GROUP BY ALL
             UNION ALL SELECT part, step, i, j, v FROM cols WHERE part = 1)
   SELECT step + 1, part, i, j, v FROM both_)),
done AS MATERIALIZED (SELECT * FROM jac WHERE step = {sweeps * last}),
diag AS (SELECT i, v FROM done WHERE part = 0 AND i = j),
ranked AS (SELECT a.i, a.v AS value, count(b.i) AS rank
           FROM diag a LEFT JOIN diag b ON b.v > a.v OR (b.v = a.v AND b.i < a.i) GROUP BY a.i, a.v),
eig AS (SELECT rank, value FROM ranked),
vec AS (SELECT rank, d.i AS pos, d.v * sign(arg_max(d.v, abs(d.v)) OVER (PARTITION BY rank)) AS x
        FROM done d JOIN ranked ON d.j = ranked.i WHERE part = 1)"""
