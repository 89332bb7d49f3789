"""DuckDB texts for the queries of this package that SQL can express, written without its constants."""

OP3 = r"""
WITH parts AS (
  SELECT page_id,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS raw_host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
judged AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM judged)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP4 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, host, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k FROM w, unnest(range(1, len(ws) - 6)) AS u(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + j) AS n FROM rep, range(0, 8) AS g(j) GROUP BY r),
base AS (
  SELECT doc_id, host, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
hosts AS (SELECT host, count(*) AS n, sum(base_failed::INT)::DOUBLE AS f FROM judged GROUP BY host),
tot AS (SELECT sum(n)::DOUBLE AS n, sum(f) / sum(n) AS m, count(*)::DOUBLE AS h, sum(f * f / n) / sum(n) AS sq FROM hosts),
spread AS (SELECT m, sq - m * m - m * (1 - m) * h / n AS v FROM tot),
prior AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) ELSE 1e6 END AS s FROM spread),
bad AS (SELECT host, (f + m * s) / (n + s) > 0.8 AS failed FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT failed AS kept
FROM judged JOIN bad USING (host)
"""

OP7 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
         string_agg('<s>[INST]' || replace(replace(replace(role, '~', '~0'), '<', '~1'), '[', '~2') || '[/INST]'
                    || replace(replace(replace(text, '~', '~0'), '<', '~1'), '[', '~2') || '</s>', '') AS formatted,
         string_agg(role, ',' ORDER BY turn NULLS FIRST, role, text) AS roles
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       length(formatted) AS formatted_chars, regexp_full_match(roles, '(system,)?user,assistant(,user,assistant)*') AS valid
FROM g
"""

OP1 = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM d, unnest(range(1, len(ws) - 11)) AS u(i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS w FROM rep, range(0, 13) AS g(j)),
words AS (SELECT doc_id, w, ws[w] AS word FROM d, unnest(range(1, len(ws) + 1)) AS u(w)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY w) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, w) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP2 = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 'i', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT kind, id, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM lowered),
s AS (SELECT DISTINCT kind, id, array_to_string(ws[i:i + 4], ' ') AS k FROM w, unnest(range(1, len(ws) - 3)) AS u(i)),
n AS (SELECT id AS item_id, count(*) AS n_item FROM s WHERE kind = 'i' GROUP BY id),
p AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM s d JOIN s i USING (k) WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared FROM p JOIN n USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""


def _components(percent: int) -> str:
    """Components of documents whose sets of distinct five-word shingles reach the similarity."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (SELECT DISTINCT r, doc_id, array_to_string(ws[i:i + 4], ' ') AS k FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS u(i) WHERE len(ws) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS ra, b.r AS rb, a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.r <> b.r GROUP BY ALL),
links AS (SELECT DISTINCT a, b FROM p JOIN n x ON x.r = ra JOIN n y ON y.r = rb WHERE 100 * c >= {percent} * (x.n + y.n - c)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id{', doc_id = component_id AS kept' if percent == 75 else ''}
FROM w LEFT JOIN n USING (r) JOIN lowest USING (doc_id)
"""


def _codes() -> str:
    """Four rounds over four codebooks of 256 integer entries, with every distance computed."""
    start = """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT r, (i - 1) // (len(v) // 4) AS part, (i - 1) % (len(v) // 4) AS slot, v[i] AS x FROM kept, unnest(range(1, len(v) + 1)) AS u(i)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, slot, x AS m FROM cells WHERE r <= 256)"""
    assign = """,
a{t} AS MATERIALIZED (
  SELECT r, part, min(d * 256 + entry) % 256 AS entry, min(d) AS d
  FROM (SELECT r, part, entry, sum((x - m) * (x - m)) AS d FROM cells JOIN b{t} USING (part, slot) GROUP BY ALL) GROUP BY ALL)"""
    move = """,
b{u} AS MATERIALIZED (
  SELECT part, entry, slot, coalesce((s - ((s % n) + n) % n) // n, m) AS m
  FROM b{t} LEFT JOIN (SELECT part, entry, slot, sum(x) AS s, count(*) AS n FROM a{t} JOIN cells USING (r, part) GROUP BY ALL) USING (part, entry, slot))"""
    rounds = "".join(assign.format(t=t) + move.format(t=t, u=t + 1) for t in range(4)) + assign.format(t=4)
    return start + rounds + """,
coded AS (SELECT r, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY r),
labelled AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN coded USING (r) GROUP BY label),
books AS (SELECT sha256(string_agg(CAST(m AS BIGINT), ',' ORDER BY part, entry, slot)) AS codebooks_sha256 FROM b4)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM kept JOIN coded USING (r) JOIN labelled ON labelled.label IS NOT DISTINCT FROM kept.label, books
"""


def _clusters() -> str:
    """Three rounds over sixteen integer centroids, with every distance computed."""
    start = """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, embedding) - 1 AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (SELECT r, i AS slot, v[i] AS x FROM kept, unnest(range(1, 65)) AS u(i)),
b0 AS MATERIALIZED (SELECT r AS cluster, slot, x AS m FROM cells WHERE r < 16)"""
    assign = """,
a{t} AS MATERIALIZED (
  SELECT r, min(d * 16 + cluster) % 16 AS cluster, min(d) AS d
  FROM (SELECT r, cluster, sum((x - m) * (x - m)) AS d FROM cells JOIN b{t} USING (slot) GROUP BY ALL) GROUP BY ALL)"""
    move = """,
b{u} AS MATERIALIZED (
  SELECT cluster, slot, coalesce((s - ((s % n) + n) % n) // n, m) AS m
  FROM b{t} LEFT JOIN (SELECT cluster, slot, sum(x) AS s, count(*) AS n FROM a{t} JOIN cells USING (r) GROUP BY ALL) USING (cluster, slot))"""
    rounds = "".join(assign.format(t=t) + move.format(t=t, u=t + 1) for t in range(3)) + assign.format(t=3)
    return start + rounds + """,
sums AS (SELECT cluster, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a3 GROUP BY cluster),
centroids AS (SELECT cluster, sha256(string_agg(CAST(m AS BIGINT), ',' ORDER BY slot)) AS centroid_sha256 FROM b3 GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, cluster_inertia,
       (SELECT CAST(sum(d) AS BIGINT) FROM a3) AS inertia, centroid_sha256
FROM kept JOIN a3 USING (r) JOIN sums USING (cluster) JOIN centroids USING (cluster)
"""


ORACLE = {
    "op1_substring_dedup": OP1, "op2_decontamination": OP2, "op3_url_filter": OP3, "op4_quality_rules": OP4,
    "op6_minhash_dedup": _components(75), "op7_chat_format": OP7, "op11_jaccard_join": _components(80),
    "op12_vector_codes": _codes(), "op13_centroid_clusters": _clusters(),
}
