"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
win AS (
    SELECT doc_id, n, pos, word,
           string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos
                                       ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS k
    FROM u),
late AS (
    SELECT doc_id, pos, word,
           CASE WHEN pos <= n - 19
                 AND row_number() OVER (PARTITION BY pos <= n - 19, k ORDER BY doc_id, pos) > 1
                THEN 1 ELSE 0 END AS late
    FROM win),
gone AS (
    SELECT doc_id, pos, word,
           max(late) OVER (PARTITION BY doc_id ORDER BY pos
                           ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM late),
kept AS (
    SELECT doc_id, sum(gone)::BIGINT AS n_removed,
           string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS text
    FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(kept.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLE["op8_decontaminate"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
u AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
runs AS (
    SELECT doc_id, pos,
           string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos
                                       ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS k
    FROM u QUALIFY pos <= n - 12),
starts AS (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS s FROM b WHERE len(w) >= 13),
long_win AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 12], ' ') AS k FROM starts),
short_win AS (SELECT DISTINCT item_id, w FROM b WHERE len(w) BETWEEN 1 AND 12),
hits AS (
    SELECT doc_id, pos, 13 AS n, item_id FROM runs JOIN long_win USING (k)
    UNION ALL
    SELECT u.doc_id, u.pos, len(s.w), s.item_id
    FROM u JOIN short_win s ON u.word = s.w[1] JOIN d USING (doc_id)
    WHERE d.w[u.pos:u.pos + len(s.w) - 1] = s.w),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM hits),
n_hit AS (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY doc_id),
ids AS (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, 'null') AS id FROM hits),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM ids GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op10_warc"] = r"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""

# one row for each (conv_id, turn), as the table has; duplicate ids are tested against brute force.
# each call has one reference at most, so its level is the length of the walk along references
ORACLE["op3_tool_calls"] = r"""
WITH RECURSIVE u AS (
    SELECT conv_id, turn, text, conv_id % 7 AS k, conv_id || ':' || turn AS call_id,
           CASE WHEN conv_id % 7 = 3 THEN NULL
                WHEN (conv_id % 7 = 1 AND turn % 8 < 6) OR (conv_id % 7 = 2 AND turn = 0) THEN turn + 2
                WHEN conv_id % 7 = 1 THEN NULL
                WHEN turn >= 2 THEN turn - 2 END AS ref_turn
    FROM conversations WHERE role = 'user'),
v AS (SELECT *, conv_id || ':' || ref_turn AS ref FROM u),
r0 AS (
    SELECT conv_id, turn, text, conv_id || ':' || (turn - 1) || CASE WHEN conv_id % 7 = 5 THEN 'x' ELSE '' END AS call_id
    FROM conversations WHERE role = 'assistant'),
walk AS (
    SELECT call_id, ref, 0 AS steps FROM v
    UNION ALL
    SELECT w.call_id, v.ref, w.steps + 1 FROM walk w JOIN v ON w.ref = v.call_id WHERE w.steps <= 200),
odd AS (SELECT DISTINCT v.conv_id FROM v JOIN v p ON v.ref = p.call_id WHERE p.turn >= v.turn),
ordered AS (
    SELECT v.*, CASE WHEN v.conv_id NOT IN (SELECT conv_id FROM odd) THEN 0 WHEN w.steps > 200 THEN NULL ELSE w.steps END AS level,
           CASE WHEN v.ref IS NOT NULL AND v.ref NOT IN (SELECT call_id FROM v) THEN 'missing_ref'
                WHEN v.conv_id IN (SELECT conv_id FROM odd) AND w.steps > 200 THEN 'cycle' END AS link_error
    FROM v JOIN (SELECT call_id, max(steps) AS steps FROM walk GROUP BY 1) w USING (call_id)),
c AS (
    SELECT *, CASE WHEN k = 3 AND turn % 6 NOT IN (0, 2) THEN '"{reply"'
                   WHEN k = 3 AND turn % 6 = 0 THEN '{"prompt":' || turn || '}'
                   WHEN k = 3 THEN '{"extra":1' || coalesce(',"prompt":' || to_json(text)::VARCHAR, '') || '}'
                   ELSE '{' || concat_ws(',', '"history":{"$ref":' || to_json(ref)::VARCHAR || '}',
                                         '"prompt":' || to_json(text)::VARCHAR) || '}' END AS arguments,
           CASE WHEN k = 3 AND turn % 6 NOT IN (0, 2) THEN 'bad_json'
                WHEN k = 3 AND turn % 6 = 0 THEN 'type:/prompt'
                WHEN text IS NULL THEN 'required:/prompt'
                WHEN k = 3 THEN 'unknown:/extra'
                WHEN text = '' THEN 'length:/prompt' END AS schema_error
    FROM ordered),
calls AS (
    SELECT c.conv_id, c.call_id, c.turn + again AS turn, r.turn AS result_turn, c.level,
           CASE WHEN again = 1 THEN 'duplicate_call' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
           coalesce(CASE WHEN again = 1 THEN 'unknown_tool:reply2' ELSE c.schema_error END, c.link_error) AS error,
           '{"arguments":' || c.arguments || ',"id":' || to_json(c.call_id)::VARCHAR
           || CASE WHEN again = 1 THEN ',"name":"reply2","result":' ELSE ',"name":"reply","result":' END
           || CASE WHEN r.call_id IS NULL THEN 'null' ELSE '{"content":' || coalesce(to_json(r.text)::VARCHAR, 'null')
                   || ',"turn":' || r.turn || '}' END
           || ',"turn":' || (c.turn + again) || '}' AS json
    FROM c JOIN (VALUES (0), (1)) a(again) ON again = 0 OR c.k = 4
    LEFT JOIN r0 r ON r.call_id = c.call_id AND again = 0),
lone AS (
    SELECT r.conv_id, r.call_id, NULL::BIGINT AS turn, r.turn + late AS result_turn, 0 AS level,
           CASE WHEN c.call_id IS NULL THEN 'no_call' ELSE 'duplicate_result' END AS status, NULL::VARCHAR AS error,
           '{"id":' || to_json(r.call_id)::VARCHAR || ',"result":{"content":' || coalesce(to_json(r.text)::VARCHAR, 'null')
           || ',"turn":' || (r.turn + late) || '}}' AS json
    FROM r0 r JOIN (VALUES (0), (1)) l(late) ON late = 0 OR r.conv_id % 7 = 4 LEFT JOIN c ON r.call_id = c.call_id
    WHERE c.call_id IS NULL OR late = 1)
SELECT conv_id, call_id, turn, result_turn, level::INTEGER AS level, status, error, json FROM calls UNION ALL SELECT * FROM lone
"""

# quotients and blocks are listed one by one here; the operator settles them in closed form
ORACLE["op2_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(concat_ws('|', '20240607', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS h
    FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM d GROUP BY source),
w AS (
    SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
               WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight,
           2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total
    FROM s),
full_at AS (  -- what all sources take at the level where this one reaches its cap
    SELECT a.source, sum(least(b.cap, a.cap / a.weight * b.weight)) AS taken FROM w a, w b GROUP BY a.source),
c AS (SELECT w.*, f.taken <= w.total AS capped FROM w JOIN full_at f ON w.source IS NOT DISTINCT FROM f.source),
goal AS (
    SELECT *, CASE WHEN capped THEN cap ELSE
               (total - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0))
               / sum(weight) FILTER (WHERE NOT capped) OVER () * weight END AS target
    FROM c),
quotient AS (
    SELECT source, unnest(range(1, (target / 8)::BIGINT + 20)) AS k, target FROM goal WHERE target > 0),
won AS (
    SELECT source FROM quotient
    QUALIFY row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS FIRST, k)
            <= (SELECT round(sum(target) / 8) FROM goal)),
quota AS (
    SELECT g.source, g.source_size, g.target, ceil(g.source_size / 500000 + g.n_docs / 20000)::BIGINT AS n_shards,
           (SELECT count(*) FROM won WHERE won.source IS NOT DISTINCT FROM g.source) AS seats
    FROM goal g),
dealt AS (
    SELECT d.*, q.source_size, q.target, q.seats, ('0x' || substr(h, 25, 8))::BIGINT % q.n_shards AS shard
    FROM d JOIN quota q ON d.source IS NOT DISTINCT FROM q.source),
shard AS (SELECT source, shard, sum(size)::BIGINT AS words, any_value(seats) AS seats FROM dealt GROUP BY source, shard),
shard_won AS (
    SELECT source, shard FROM (SELECT *, unnest(range(1, seats + 1)) AS k FROM shard WHERE words > 0)
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY words / (2 * k - 1) DESC, shard, k) <= seats),
plan AS (
    SELECT x.source, x.shard, greatest(ceil(x.words / 8)::BIGINT, 1) AS n,
           (SELECT count(*) FROM shard_won y WHERE y.source IS NOT DISTINCT FROM x.source AND y.shard = x.shard) AS seats,
           ('0x' || substr(md5(concat_ws('|', '20240607', coalesce(x.source, ''), x.shard::VARCHAR)), 1, 8))::BIGINT AS start
    FROM shard x),
placed AS (
    SELECT dealt.*, p.n, least(p.seats, 2 * p.n) // p.n AS passes, least(p.seats, 2 * p.n) % p.n AS r, p.start % p.n AS st,
           coalesce(sum(size) OVER (PARTITION BY dealt.source, dealt.shard ORDER BY h, doc_id, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o
    FROM dealt JOIN plan p ON dealt.source IS NOT DISTINCT FROM p.source AND dealt.shard = p.shard),
block AS (SELECT *, unnest(range(o // 8, (o + size - 1) // 8 + 1)) AS j FROM placed WHERE size > 0),
part AS (
    SELECT doc_id, h, sum(CASE WHEN ((j + 1) * r + st) // n > (j * r + st) // n
                               THEN least(o + size, (j + 1) * 8) - greatest(o, j * 8) ELSE 0 END) AS words
    FROM block GROUP BY doc_id, h)
SELECT p.doc_id, p.size, p.source_size, p.target,
       (p.passes * p.size + coalesce(part.words, 0))::BIGINT AS taken
FROM placed p LEFT JOIN part ON p.h = part.h
"""

ORACLE["op11_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM (
    SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM pos p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
     AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
WHERE rank <= 10
"""


def _codes_sql() -> str:
    """Two rounds and the last assignment, each as its own pair of steps."""
    step = """
a{r} AS (
    SELECT v.vec_id, v.part, min({{'d': (v.x1 - c.x1) ** 2 + (v.x2 - c.x2) ** 2 + (v.x3 - c.x3) ** 2 + (v.x4 - c.x4) ** 2,
                                  'e': c.entry}}) AS best
    FROM v JOIN c{r} c USING (part) GROUP BY v.vec_id, v.part)"""
    update = """
c{n} AS (
    SELECT c.part, c.entry, coalesce(m.x1, c.x1) AS x1, coalesce(m.x2, c.x2) AS x2,
           coalesce(m.x3, c.x3) AS x3, coalesce(m.x4, c.x4) AS x4
    FROM c{r} c LEFT JOIN (
        SELECT v.part, a.best.e AS entry, floor(sum(v.x1) / count(*)) AS x1, floor(sum(v.x2) / count(*)) AS x2,
               floor(sum(v.x3) / count(*)) AS x3, floor(sum(v.x4) / count(*)) AS x4
        FROM v JOIN a{r} a USING (vec_id, part) GROUP BY v.part, a.best.e) m USING (part, entry))"""
    steps = [step.format(r=0), update.format(r=0, n=1), step.format(r=1), update.format(r=1, n=2), step.format(r=2)]
    return """
WITH q AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (
    SELECT vec_id, part, q[4 * part + 1] AS x1, q[4 * part + 2] AS x2, q[4 * part + 3] AS x3, q[4 * part + 4] AS x4
    FROM q, range(16) AS p(part)),
c0 AS (
    SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, x1, x2, x3, x4
    FROM v WHERE vec_id IN (SELECT vec_id FROM q ORDER BY vec_id LIMIT 64)),
""" + ",".join(steps) + """,
coded AS (
    SELECT vec_id, string_agg(format('{:02x}', best.e::BIGINT), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
    FROM a2 GROUP BY vec_id)
SELECT coded.vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(concat_ws(',', x1::BIGINT, x2::BIGINT, x3::BIGINT, x4::BIGINT), ',' ORDER BY part, entry))
        FROM c2) AS codebooks_sha256
FROM coded JOIN q ON coded.vec_id = q.vec_id
"""


#: For vectors of 64 components, cut into parts of four.
ORACLE["op12_vector_codes"] = _codes_sql()
