"""DuckDB SQL for the operators that SQL can express."""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7 = rf"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS r,
                   coalesce(regexp_extract_all({LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents),
bw AS (SELECT item_id, coalesce(regexp_extract_all({LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
       FROM benchmark),
bn AS (SELECT item_id, w, least(len(w), 10) AS n FROM bw WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, n, list_slice(w, p, p + n - 1) AS g
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM bn)),
lengths AS (SELECT DISTINCT n FROM bg),
dg AS (SELECT r, n, p, list_slice(w, p, p + n - 1) AS g
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, lengths WHERE len(w) >= n)),
hits AS (SELECT r, dg.p, dg.n, item_id FROM dg JOIN bg ON dg.n = bg.n AND dg.g = bg.g),
pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
items AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN items USING (r)
"""

_URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"

OP3 = rf"""
WITH v AS (SELECT page_id, url, md5(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS size,
                  unnest(range(0, coalesce(page_id % 5, 0) + 1)) AS visit FROM pages),
m AS (SELECT *, (page_id + visit) % 11 AS mark, regexp_replace(trim(url), '#.*$', '') AS bare FROM v),
c AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '{_URL}([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
                || regexp_replace(regexp_extract(bare, '{_URL}[^/?]*([^?]*)', 1), '/+$', '') AS place,
             array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&'),
                                                   lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS q FROM m),
r AS (SELECT page_id * 8 + visit AS rid, place || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS curl,
             page_id % 1000 * 10 + visit * 3600 AS ts, CASE WHEN visit = 0 THEN page_id % 7 <> 0 ELSE mark = 3 END AS is_full,
             CASE WHEN mark <> 7 THEN substr(digest, 1, 12) || CASE WHEN mark = 5 THEN '-changed' ELSE '' END END AS tag,
             CASE WHEN mark <> 8 THEN 'day ' || (page_id % 365) END AS lm, size, visit FROM c),
f AS (SELECT * FROM r WHERE is_full AND curl IS NOT NULL AND ts IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY curl, ts ORDER BY rid DESC) = 1),
j AS (SELECT r.*, f.rid AS frid, f.ts AS fts, f.size AS fsize,
             CASE WHEN f.rid IS NULL THEN 'no_original' WHEN r.tag IS NULL AND r.lm IS NULL THEN 'unverified'
                  WHEN CASE WHEN r.tag IS NOT NULL THEN r.tag IS NOT DISTINCT FROM f.tag
                            ELSE r.lm IS NOT DISTINCT FROM f.lm END THEN 'resolved' ELSE 'mismatch' END AS state
      FROM (SELECT * FROM r WHERE NOT is_full) r ASOF LEFT JOIN f ON r.curl = f.curl AND r.ts > f.ts)
SELECT rid::BIGINT AS record_id, curl AS canonical, ts::BIGINT AS ts, state,
       CASE WHEN state IN ('resolved', 'unverified') THEN frid END::BIGINT AS original_id,
       CASE WHEN state IN ('resolved', 'unverified') THEN fts END::BIGINT AS original_ts,
       CASE WHEN state IN ('resolved', 'unverified') THEN 'cache-control: max-age=' || (visit * 60) || chr(10) ||
            'content-length: ' || fsize || chr(10) || 'content-type: text/html' || chr(10) || 'date: visit ' || visit ||
            chr(10) || 'x-cache: hit' END AS headers
FROM j
"""

OP6 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce({LOWER.format('text')}, ''), '[\x20\x09-\x0D]+'),
                                                lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, p, p + 4) AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * same >= 85 * (x.n + y.n - same)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN links ON other = a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""

ORACLES = {"op3_warc_revisits": OP3, "op6_minhash": OP6, "op7_decontaminate": OP7}


def _op11(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Plain k-means: every part against every entry of its codebook in every round."""
    ctes = [f"""kept AS MATERIALIZED (
SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label,
       list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
            f"""pts AS MATERIALIZED (SELECT r, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x
FROM kept, (SELECT unnest(range({parts})) AS p))""",
            f"book0 AS MATERIALIZED (SELECT p, r AS e, x AS c FROM pts WHERE r < {entries})"]
    for n in range(rounds + 1):
        ctes.append(f"""near{n} AS MATERIALIZED (
SELECT r, p, CAST(k AS BIGINT) % {entries} AS e, CAST(k AS BIGINT) // {entries} AS d
FROM (SELECT r, pts.p, min({entries} * (list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c)) + e) AS k
      FROM pts JOIN book{n} b ON b.p = pts.p GROUP BY r, pts.p))""")
        if n < rounds:
            ctes.append(f"""mean{n} AS MATERIALIZED (
SELECT p, e, list(m ORDER BY i) AS c FROM (
  SELECT p, e, i, floor(sum(y) / count(*)) AS m
  FROM (SELECT near{n}.p, near{n}.e, unnest(x) AS y, unnest(range(len(x))) AS i FROM near{n} JOIN pts USING (r, p)) GROUP BY p, e, i)
GROUP BY p, e)""")
            ctes.append(f"""book{n + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m USING (p, e))""")
    return "WITH " + ",\n".join(ctes) + f""",
said AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) AS h
         FROM book{rounds}),
coded AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), said
"""


ORACLES["op11_vector_codes"] = _op11()
