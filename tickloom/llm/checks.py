"""DuckDB twins of the registered queries, where SQL can express them."""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"

SQL: dict[str, str] = {}

SQL["op2_host_quality"] = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i + 7] AS win FROM d, unnest(range(1, len(w) - 6)) AS r(i)),
twice AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS o(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words,
         coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
         (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(l.n, 0)::BIGINT AS n_lines, coalesce(l.dup, 0)::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
f AS (
  SELECT *, n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2,
         10 * n_symbols > n_words AS f3, 10 * n_dup_lines > 3 * n_lines AS f4,
         word_chars < 3 * n_words OR word_chars > 12 * n_words AS f5
  FROM m),
long AS (
  SELECT source, r, CASE r WHEN 1 THEN f1 WHEN 2 THEN f2 WHEN 3 THEN f3 WHEN 4 THEN f4 ELSE f5 END AS bad
  FROM f, range(1, 6) AS rules(r) WHERE source IS NOT NULL),
host AS (
  SELECT source, r, count(*)::DOUBLE AS n, sum(bad::INT)::DOUBLE AS k FROM long GROUP BY source, r),
total AS (
  SELECT r, sum(n) AS nn, count(*)::DOUBLE AS h, sum(n * n) AS sq, sum(k) / sum(n) AS p, sum(k * k / n) AS kk
  FROM host GROUP BY r),
moments AS (
  SELECT r, p, kk - nn * p * p - (h - 1) * p * (1 - p) AS between_hosts,
         p * (1 - p) * (nn - sq / nn - (h - 1)) AS room
  FROM total),
prior AS (
  SELECT r, p, CASE WHEN room > 0 AND between_hosts > 0
    THEN least(greatest((1 - least(between_hosts / room, 1)) / least(between_hosts / room, 1), 2), 1e6)
    ELSE 1e6 END AS strength
  FROM moments),
verdict AS (
  SELECT source, max((k + p * strength) / (n + strength)) > 0.5 AS bad
  FROM host JOIN prior USING (r) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f1 OR f2 AS base_failed, coalesce(v.bad, false) AS host_rejected,
       NOT (f1 OR f2) AND NOT coalesce(v.bad, false) AS kept
FROM f LEFT JOIN verdict v USING (source)
"""

SQL["op4_pivot_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_sum([x * x FOR x IN embedding]) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(id, seen) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.id, l.b FROM reach r JOIN link l ON r.seen = l.a)
SELECT e.vec_id,
       (SELECT count(*) FROM link WHERE a = e.vec_id)::BIGINT AS n_links,
       coalesce(m.least, e.vec_id) AS component_id,
       coalesce(m.least, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN (SELECT id, min(seen) AS least FROM reach GROUP BY id) m ON m.id = e.vec_id
"""

SQL["op5_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (
  SELECT *,
    length(text) + (length(text) - length(replace(text, '\', '')))
    + (length(text) - length(replace(text, '[INST]', ''))) / 6
    + (length(text) - length(replace(text, '[/INST]', ''))) / 7
    + (length(text) - length(replace(text, '</s>', ''))) / 4
    + (length(text) - length(replace(text, '<s>', ''))) / 3
    + length(role) + 6 + 7 + 4 AS chars
  FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM esc GROUP BY conv_id
"""

SQL["op10_bbit_minhash"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(id, seen) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.id, l.b FROM reach r JOIN link l ON r.seen = l.a),
m AS (SELECT id, min(seen) AS least FROM reach GROUP BY id)
SELECT m.id AS doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.least AS component_id, m.least = m.id AS kept
FROM m LEFT JOIN n ON n.doc_id = m.id
"""

SQL["op12_infill"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
p AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT *, least(a, b) AS low, greatest(a, b) AS high, substr(t, 1, least(a, b)) AS x,
         substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS y, substr(t, greatest(a, b) + 1) AS z
  FROM p)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
              ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""


def _cluster_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds on integers, one after the other."""
    apart = "list_sum(list_transform(list_zip(p.q, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [
        f"""
p AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, q AS v
  FROM p ORDER BY 1 LIMIT {clusters})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""
a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := {apart}, c := c.c)) AS m FROM p, c{i} c GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""
s{i} AS (
  SELECT m.c AS c, i, sum(q[i])::BIGINT AS s, count(*) AS n
  FROM a{i} JOIN p USING (r), range(1, 65) AS w(i) GROUP BY 1, 2),
n{i} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.v, o.v) AS v FROM c{i} o LEFT JOIN n{i} n ON n.c = o.c)"""
            )
    return f"""
WITH {",".join(steps)}
SELECT p.vec_id, m.c::INTEGER AS cluster, m.d AS distance,
       sum(m.d) OVER (PARTITION BY m.c)::BIGINT AS cluster_inertia, sum(m.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN p USING (r) JOIN c{rounds} f ON f.c = m.c
"""


SQL["op13_shallot_clusters"] = _cluster_sql()
