"""Registered queries of the training-data operators, with production parameters."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from hirelens.llm import binary_out, hard_negatives, langid, merkle, minhash, mixing, packing, pii, substring, token_count, topk, vector_dedup, warc
from hirelens.llm.common import table

QUERIES = {}
ORACLE = {}

# Text pieces of the oracle SQL. Fixed value: the separators of words.
SQL_WORD = r"'[^\x20\x09-\x0D]+'"


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


@query("""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest, coalesce(html, '') AS body FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND coalesce(page_id < last, last IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND coalesce(page_id < last, last IS NOT NULL) THEN last END AS refers_to
FROM m""")
def op1_warc_archives(spark, sf_dir):
    out = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, out, with_payload=False).drop("url")


@query("""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(node, reached) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON e.vec_id = c.node LEFT JOIN n ON e.vec_id = n.a""")
def op2_vector_dedup(spark, sf_dir):
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query(f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {SQL_WORD}) AS w FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM s) WHERE k > 1),
t AS (SELECT doc_id, w[i] AS w, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
m AS (SELECT t.*, max(r.i) OVER (PARTITION BY t.doc_id ORDER BY t.i) AS last
      FROM t LEFT JOIN r ON t.doc_id = r.doc_id AND t.i = r.i),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE last > i - 20) AS n_removed,
             string_agg(w, ' ' ORDER BY i) FILTER (WHERE last IS NULL OR last <= i - 20) AS kept
      FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""")
def op3_repeated_passages(spark, sf_dir):
    out = substring.without_repeats(table(spark, sf_dir, "documents"), window=20, with_text=False)
    return out.drop("removed")


@query(f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {SQL_WORD})) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15)
              AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER k, 0) AS room,
         sum(w) OVER () - coalesce(sum(w) OVER k, 0) AS ws,
         row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS r
  FROM s WINDOW k AS (ORDER BY 3 * source_size / w, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(room, r) AS room, arg_min(ws, r) AS ws FROM o WHERE room * w <= 3 * source_size * ws),
t AS (
  SELECT o.source, source_size,
         CASE WHEN source_size = 0 THEN 0.0
              WHEN o.room * w > 3 * source_size * o.ws OR f.room IS NULL THEN 3 * source_size
              ELSE least(f.room * w / f.ws, 3 * source_size) END AS target
  FROM o CROSS JOIN f),
u AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(floor(target / source_size), 3) END AS reps FROM t),
b AS (
  SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
c AS (
  SELECT b.source, b.h, b.words, u.target - u.reps * u.source_size AS rest,
         sum(b.words) OVER (PARTITION BY b.source ORDER BY b.h) AS upto
  FROM b JOIN u ON b.source IS NOT DISTINCT FROM u.source)
SELECT d.doc_id, d.size, CAST(u.source_size AS BIGINT) AS source_size, CAST(u.target AS DOUBLE) AS target,
       CAST(d.size * (u.reps + CASE WHEN c.rest <= 0 THEN 0 WHEN c.upto < c.rest THEN 1
                               WHEN c.upto - c.words < c.rest AND c.rest - (c.upto - c.words) > c.upto - c.rest THEN 1
                               ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h""")
def op4_mix_sources(spark, sf_dir):
    out = mixing.mix_report(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op5_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query(f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    {SQL_WORD}) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c ON d.doc_id = c.node LEFT JOIN n ON d.doc_id = n.doc_id""")
def op6_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query()
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query()
def op8_personal_data(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query()
def op9_token_records(spark, sf_dir):
    out = binary_out.write_records(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return binary_out.read_records(spark, out, with_ids=False)


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""")
def op10_exact_topk(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    return topk.top_k(v.where(F.col("vec_id") % 100 == 0), v, k=10)


@query("""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM s WHERE same) WHERE r <= 5),
n AS (
  SELECT p.a, p.b AS pos, p.score AS ps, s.b AS neg, s.score AS ns,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS k
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT a AS anchor_id, pos AS positive_id, CAST(k AS INTEGER) AS rank, neg AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE k <= 5""")
def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(v, F.col("vec_id") % 100 == 0)


@query()
def op12_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_count.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def _sql_counted(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR) END"


def _sql_leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(f'({_sql_counted(c)})' for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# CRC-32 of the decimal doc_id: each byte is xored in (a value >= 0), then eight shifts (-1)
_SQL_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_concat([CAST(ascii(c) AS BIGINT)], list_transform(range(8), lambda i: -1))))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""


@query(f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_sql_leaf('n_chars')} AS leaf, {_sql_leaf('n_chars + 1')} AS other,
         n_chars IS NOT NULL AND doc_id IS NOT NULL AND {_SQL_CRC} % 7 = 0 AS hit
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY lang) AS n FROM d),
t(lang, lvl, pos, h, n) AS (
  SELECT lang, 0, pos, leaf, n FROM l
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1
  GROUP BY lang, lvl, n, pos // 2),
s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lvl, pos, h, n) AS (
  SELECT 0, pos, h, n FROM s
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1
  GROUP BY lvl, n, pos // 2),
p(doc_id, leaf, lang, lvl, pos, n, fold, proof) AS (
  SELECT doc_id, leaf, lang, 0, pos, n, CASE WHEN hit THEN other ELSE leaf END, '' FROM l
  UNION ALL
  SELECT p.doc_id, p.leaf, p.lang, p.lvl + 1, p.pos // 2, (p.n + 1) // 2,
         sha256(CASE WHEN p.pos % 2 = 0 THEN p.fold || coalesce(x.h, '') ELSE x.h || p.fold END), p.proof || coalesce(x.h, '')
  FROM p LEFT JOIN t x ON x.lang IS NOT DISTINCT FROM p.lang AND x.lvl = p.lvl AND x.pos = xor(p.pos, 1) WHERE p.n > 1),
q(doc_id, leaf, subroot, lvl, pos, n, fold, proof) AS (
  SELECT p.doc_id, p.leaf, s.h, 0, s.pos, s.n, p.fold, p.proof FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang WHERE p.n = 1
  UNION ALL
  SELECT q.doc_id, q.leaf, q.subroot, q.lvl + 1, q.pos // 2, (q.n + 1) // 2,
         sha256(CASE WHEN q.pos % 2 = 0 THEN q.fold || coalesce(x.h, '') ELSE x.h || q.fold END), q.proof || coalesce(x.h, '')
  FROM q LEFT JOIN u x ON x.lvl = q.lvl AND x.pos = xor(q.pos, 1) WHERE q.n > 1)
SELECT q.doc_id, q.leaf, q.subroot, u.h AS root, sha256(q.proof) AS proof_sha256, q.fold AS folded_root, q.fold = u.h AS verified
FROM q JOIN u ON q.n = 1 AND u.n = 1""")
def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))
