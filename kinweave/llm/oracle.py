"""The results of the queries as DuckDB SQL, where SQL can express them. All lists are stated here, not imported."""

from __future__ import annotations

_OP1 = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
     w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
     win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
             FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
     twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
     rep AS (SELECT doc_id, count(DISTINCT word) AS n_repeat_words
             FROM (SELECT doc_id, unnest(range(i, i + 5)) AS word FROM twice) GROUP BY doc_id),
     c AS (SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words,
                  length(array_to_string(ws, ''))::BIGINT AS word_chars,
                  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
                  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
           FROM w LEFT JOIN rep USING (doc_id)),
     m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                  CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS word_length,
                  CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols,
                  CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
                  CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat_words FROM c),
     v AS (UNPIVOT (SELECT lang, source, word_length, symbols, dup_lines, repeat_words FROM m WHERE NOT base_failed)
           ON word_length, symbols, dup_lines, repeat_words INTO NAME measure VALUE value),
     b AS (SELECT lang, source, measure, CASE WHEN value < 64 THEN value
                  ELSE (value // (2 ** floor(log2(value) - 5))::BIGINT) * (2 ** floor(log2(value) - 5))::BIGINT
                  END AS bin FROM v),
     lv AS (SELECT grouping(lang, source) AS level, lang, source, measure, bin, count(*) AS n
            FROM b GROUP BY GROUPING SETS ((lang, source, measure, bin), (lang, measure, bin), (measure, bin))),
     q AS (SELECT level, lang, source, measure, max(total) AS total, min(bin) FILTER (4 * upto >= total) AS q1,
                  min(bin) FILTER (4 * upto >= 3 * total) AS q3
           FROM (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure) AS total,
                        sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bin) AS upto FROM lv)
           GROUP BY ALL),
     spread(measure, least) AS (VALUES ('word_length', 1000), ('symbols', 30), ('dup_lines', 150), ('repeat_words', 60)),
     f AS (SELECT g.lang, g.source, measure, arg_min(q3 + 3 * greatest(q3 - q1, least), level) AS high,
                  arg_min(q1 - 3 * greatest(q3 - q1, least), level) AS low
           FROM (SELECT DISTINCT lang, source FROM m) g
           JOIN (SELECT * FROM q JOIN spread USING (measure)) q
             ON (level = 3 OR total >= 200)
            AND (level = 3 OR g.lang IS NOT DISTINCT FROM q.lang AND (level = 1 OR g.source IS NOT DISTINCT FROM q.source))
           GROUP BY g.lang, g.source, measure),
     p AS (SELECT lang, source, max(high) FILTER (measure = 'word_length') AS wl_high,
                  max(low) FILTER (measure = 'word_length') AS wl_low, max(high) FILTER (measure = 'symbols') AS s_high,
                  max(high) FILTER (measure = 'dup_lines') AS d_high,
                  max(high) FILTER (measure = 'repeat_words') AS r_high FROM f GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(word_length BETWEEN wl_low AND wl_high AND symbols <= s_high
                                    AND dup_lines <= d_high AND repeat_words <= r_high, false) AS kept
FROM m LEFT JOIN p ON m.lang IS NOT DISTINCT FROM p.lang AND m.source IS NOT DISTINCT FROM p.source
"""

_OP5 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
     d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h,
                  max(page_id) OVER (PARTITION BY sha256(b)) AS owner FROM p),
     r AS (SELECT *, coalesce(n >= 1000 AND page_id < owner, false) AS again FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN owner END AS refers_to
FROM r
"""

_STRICT = "casino cialis escort porn viagra xxx".split()
_SOFT = "adult bet bonus cheap dating discount farm free loan pills poker replica sex spam win".split()


def _hits(terms: list[str]) -> str:
    edge = r"[^0-9a-z\x{80}-\x{10FFFF}]"
    return " + ".join(f"CAST(regexp_matches(low, '(^|{edge}){t}({edge}|$)') AS INTEGER)" for t in terms)


_OP6 = f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url,
                  translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
           FROM pages),
     s AS (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
                  CASE WHEN contains(url, '://') THEN substr(low, strpos(url, '://') + 3) ELSE '' END AS low_rest FROM u),
     h AS (SELECT *, regexp_extract(low_rest, '^[^/?#]*') AS host,
                  regexp_replace(regexp_extract(rest, '^[^?#]*'), '^[^/]*', '') AS path,
                  {_hits(_STRICT)} AS n_strict, {_hits(_SOFT)} AS n_soft FROM s),
     rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                             ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
     m AS (SELECT h.*, list(r.rhost || r.rpath ORDER BY length(r.rhost || r.rpath) DESC)
                         FILTER (r.rhost IS NOT NULL) AS fits,
                  list(r.verdict ORDER BY length(r.rhost || r.rpath) DESC) FILTER (r.rhost IS NOT NULL) AS says
           FROM h LEFT JOIN rules r ON ('.' || h.host) LIKE ('%.' || r.rhost) AND starts_with(h.path, r.rpath)
           GROUP BY ALL)
SELECT page_id, host, path, fits[1] AS rule,
       coalesce(says[1], CASE WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft
FROM m
"""

_OP9 = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
     bw AS (SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
     grams AS (SELECT DISTINCT item_id, least(13, len(w)) AS k,
                      array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS g
               FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM bw WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT k FROM grams),
     places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k),
     found AS (SELECT p.doc_id, p.i, p.k, g.item_id
               FROM (SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM places) p
               JOIN grams g USING (k, g)),
     hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + k)) AS word FROM found) GROUP BY doc_id),
     items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
               FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP13 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda c: floor(c::DOUBLE * 256)) AS x
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: isfinite(c))) = len(embedding)),
     s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_inner_product(a.x, v.x)::BIGINT AS score
           FROM v a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": _OP1,
    "op5_warc": _OP5,
    "op6_url_filter": _OP6,
    "op9_decontaminate": _OP9,
    "op13_hard_negatives": _OP13,
}
