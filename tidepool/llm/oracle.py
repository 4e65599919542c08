"""DuckDB SQL for the registered queries that SQL can express.

None for the classifier, the packing, the HTML extraction, the robust verdict
of the quality rules, best-fit-decreasing sharding and the pipeline: these are
tested against brute-force versions, round trips and held-out accuracy.
"""

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM d WHERE len(w) >= 13),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS k FROM win),
hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS first FROM g) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM hit),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t, count(*) AS n
         FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP4 = rf"""
WITH s AS (SELECT doc_id, source, len({_WORDS.format('text')})::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size,
               [3, 1, 2][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::BIGINT AS w
        FROM s GROUP BY source),
tot AS (SELECT 3 * sum(source_size)::BIGINT AS wanted, sum(w)::BIGINT AS ws FROM per),
ord AS (SELECT source, w, 2 * source_size AS cap, row_number() OVER o AS k,
               coalesce(sum(2 * source_size) OVER b, 0)::BIGINT AS caps, coalesce(sum(w) OVER b, 0)::BIGINT AS cw
        FROM per WINDOW o AS (ORDER BY 2.0 * source_size / w, source NULLS LAST),
             b AS (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT min_by(wanted - 2 * caps, k) AS rest, min_by(ws - cw, k) AS rw
        FROM ord, tot WHERE w * (wanted - 2 * caps) <= cap * 2 * (ws - cw)),
tgt AS (SELECT source, source_size, CASE WHEN w * rest > 2 * source_size * 2 * rw THEN (2 * source_size)::DOUBLE
               ELSE (w * rest::DOUBLE) / (2 * rw)::DOUBLE END AS target FROM per, cut),
need AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM tgt),
run AS (SELECT s.doc_id, s.size, n.source_size, n.target, n.whole,
               floor(n.target + 0.5)::BIGINT - n.whole * n.source_size
               - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('17:' || s.doc_id::VARCHAR), s.doc_id, s.size
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
        FROM s JOIN need n ON s.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, room)))::BIGINT AS taken FROM run
"""

_QUINTETS = " || ".join(
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {0}, 5))::INT >> {1}) & 31), 1)".format(
        1 + 5 * i, shift) for i in range(8) for shift in (15, 10, 5, 0))

OP8 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM p)
SELECT page_id, strlen(x)::BIGINT AS payload_bytes, {_QUINTETS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""

OP9 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x)::BIGINT AS score
      FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

OP10 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
                     FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS k
      FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(len(w) - 2, 2)) END) AS p FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.k = b.k AND a.doc_id <> b.doc_id
           GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d
          UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = d.doc_id
"""

OP11 = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS s FROM documents),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM piece),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM w),
g AS (SELECT lang, w[p:p + k - 1] AS g, k FROM spot, range(1, 6) r(k) WHERE p + k - 1 <= len(w)),
f AS (SELECT lang, g, any_value(k) AS k, count(*) AS f FROM g GROUP BY lang, g HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE k >= 2),
cut AS (SELECT c.lang, c.g, c.f AS a, l.f AS l, r.f AS r, n.n, j,
               (1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f) AS score
        FROM c JOIN range(1, 5) t(j) ON j < c.k JOIN n ON n.lang = c.lang
        JOIN f l ON l.lang = c.lang AND l.g = c.g[1:j] JOIN f r ON r.lang = c.lang AND r.g = c.g[j + 1:c.k]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inside AS (SELECT c.lang, c.g[s:s + m - 1] AS g, max(c.f) AS longer
           FROM c JOIN range(2, 5) a(m) ON m < c.k JOIN range(1, 5) b(s) ON s + m - 1 <= c.k GROUP BY ALL),
alone AS (SELECT best.*, array_to_string(best.g, ' ') AS phrase FROM best LEFT JOIN inside i ON i.lang = best.lang AND i.g = best.g
          WHERE i.longer IS NULL OR 100 * i.longer < 100 * best.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       score::BIGINT AS score
FROM alone QUALIFY rank <= 2000
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT i, lang, source, unnest(w) AS t FROM d),
kept AS (SELECT lang, t FROM o GROUP BY lang, t HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT o.lang, o.source, o.t, count(*) AS c FROM o JOIN kept USING (lang, t) GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
cell AS (SELECT g.lang, g.source, k.t, coalesce(c.c, 0) AS c, coalesce(n.n, 0) AS n, v.v
         FROM g JOIN kept k ON g.lang = k.lang JOIN v ON v.lang = g.lang
         LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
p AS (SELECT *, 1 + (1000000000::HUGEINT * (c + 5)) // (n + 5 * v) AS p FROM cell),
q AS (SELECT lang, t, 1 + (1000000000::HUGEINT * (sum(c) + 5)) // (any_value(m) + 5 * any_value(v)) AS q
      FROM (SELECT *, sum(c) OVER (PARTITION BY lang) AS m FROM cell) GROUP BY lang, t),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
         LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.t = x.t GROUP BY ALL),
term AS (SELECT p.lang, p.source, p.t AS item, (p.p - q.q)::BIGINT AS value
         FROM p JOIN q ON q.lang = p.lang AND q.t = p.t WHERE p.c > 0 AND p.p > q.q),
part AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
         UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM part QUALIFY part = 'pair' OR rank <= 50
"""

OP13 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
f AS (SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM f
"""

ORACLE = {"op1_substring_dedup": OP1, "op4_source_mix": OP4, "op8_warc_archive": OP8, "op9_topk_search": OP9,
          "op10_ngram_jaccard": OP10, "op11_collocations": OP11,
          "op12_source_audit": OP12, "op13_exact_dedup": OP13}
