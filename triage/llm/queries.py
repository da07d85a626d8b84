"""The registered ``opN_*`` queries: each applies its operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from triage.llm import (conversation_trie, decontaminate, jaccard_join, langid, mixing, packing, pii, planes, quality_fm, rule_forest, token_orc,
                        toxicity, warc_zstd)
from triage.llm.common import fold, scratch_path, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    s = F.col("fm_score")
    return quality_fm.score(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), s.alias("score"),
                                                F.when(s >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(docs))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(pii.n_of(k).alias(f"n_{k}") for k in pii.KINDS),
                        F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op4_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_orc.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_orc.with_crc32(token_orc.read_tokens(spark, path))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    s = F.col("toxic_score")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), s.alias("score"),
                         F.when(s >= 0.5, 1).otherwise(0).alias("predicted"))


def op7_rule_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rule_forest.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rule_forest.COUNTS, "base_failed", "kept", F.col("anomaly"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("decon_n_words").alias("n_words"), decontaminate.n_hit().alias("n_hit"),
                        F.size("decon_items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("decon_items", ","), 256).alias("items_sha256"),
                        decontaminate.contaminated().alias("contaminated"))


def op9_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc_zstd.write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc_zstd.read_archives(spark, path, payloads=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.take(mixing.schedule(table(spark, sf_dir, "documents")))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    digest = token_orc.with_crc32(pieces.withColumnRenamed("id", "doc_id"))
    # written, so that a second reading finds the same sequences
    return written(digest.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "score"), "packing-pieces")


def op12_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.cluster(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversation_trie.trie(conversation_trie.rebuilt(table(spark, sf_dir, "conversations")))
    return found.drop("enter_at", "exit_at")


QUERIES = {f.__name__: f for f in (
    op1_quality_fm, op2_langid, op3_pii, op4_token_orc, op5_jaccard_join, op6_toxicity, op7_rule_forest,
    op8_decontaminate, op9_warc_zstd, op10_mixing, op11_packing, op12_bit_planes, op13_conversation_trie)} | {"pipeline": corpus_pipeline.run}

def _clusters_sql(k: int = 8, rounds: int = 10) -> str:
    """Lloyd's rounds, unrolled; divisions are floored (DuckDB's // truncates)."""
    floor_div = "((s - ((s % n) + n) % n) // n)"
    parts = ["""
WITH kept AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) AS r, v
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN isfinite(x::DOUBLE) THEN floor(1024 * x::DOUBLE)::BIGINT END) AS v
        FROM embeddings WHERE len(embedding) = 64)
  WHERE len(list_filter(v, lambda x: x IS NOT NULL)) = 64),
x AS MATERIALIZED (SELECT vec_id, r, unnest(v) AS x, unnest(range(64)) AS j FROM kept),
c0 AS MATERIALIZED (SELECT r - 1 AS c, j, x AS y FROM x WHERE r <= %d)""" % k]
    for i in range(rounds + 1):
        parts.append(f"""
d{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT r, c, sum((x - y) * (x - y))::BIGINT AS d FROM x JOIN c{i} USING (j) GROUP BY r, c) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, c{i}.j, coalesce(z, y) AS y
  FROM c{i} LEFT JOIN (SELECT c, j, {floor_div}::BIGINT AS z
                       FROM (SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n FROM x JOIN d{i} USING (r) GROUP BY c, j)) m
  ON m.c = c{i}.c AND m.j = c{i}.j)""")
    return ",".join(parts) + f"""
SELECT kept.vec_id, d.c::INTEGER AS cluster, d.d AS distance, (sum(d.d) OVER (PARTITION BY d.c))::BIGINT AS cluster_inertia,
       (sum(d.d) OVER ())::BIGINT AS inertia, h.centroid_sha256
FROM kept JOIN d{rounds} d USING (r)
JOIN (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h ON h.c = d.c"""


#: DuckDB SQL for the operators that have one; the others are tested against brute force
ORACLE_SQL = {
    "op8_decontaminate": r"""
WITH i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item, least(len(ws), 13) AS n, array_to_string(ws[k:k + 12], ' ') AS pattern
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS k FROM i WHERE len(ws) > 0)),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
w AS (
  SELECT rid, n, k, array_to_string(ws[k:k + n - 1], ' ') AS pattern
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS k
        FROM d, (SELECT DISTINCT n FROM p) WHERE len(ws) >= n)),
f AS (SELECT w.rid, w.n, w.k, p.item FROM w JOIN p ON w.n = p.n AND w.pattern = p.pattern),
h AS (
  SELECT rid, count(DISTINCT pos) AS n_hit
  FROM (SELECT rid, unnest(range(k, k + n)) AS pos FROM (SELECT DISTINCT rid, k, n FROM f)) GROUP BY rid),
x AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item FROM f) GROUP BY rid)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN h ON d.rid = h.rid LEFT JOIN x ON d.rid = x.rid
""",
    "op9_warc_zstd": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
""",
    "op10_mixing": r"""
WITH z AS (
  SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM z GROUP BY source),
w AS (SELECT *, [3, 1, 2][rank % 3 + 1] AS weight, 2 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / weight, rank) AS place FROM w),
l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM o),
c AS (SELECT level AS final FROM l WHERE cap >= level * weight ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, rank, least(cap::DOUBLE, coalesce((SELECT final FROM c) * weight, cap::DOUBLE)) AS target FROM l),
q AS (
  SELECT z.*, source_size, target, rank,
         sum(size) OVER (PARTITION BY z.source ORDER BY key, doc_id, size, rid ROWS UNBOUNDED PRECEDING) AS cum
  FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT *, (cum + source_size * turn)::DOUBLE / target AS vft FROM q, (SELECT unnest([0, 1]) AS turn) WHERE target > 0),
r AS (
  SELECT rid, greatest(0, least(size, (SELECT floor(sum(size)::DOUBLE * 1.5::DOUBLE) FROM z)::BIGINT
         - coalesce(sum(size) OVER (ORDER BY vft, rank, key, doc_id, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS got
  FROM e),
g AS (SELECT rid, sum(got)::BIGINT AS taken FROM r GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN g ON q.rid = g.rid
""",
    "op12_bit_planes": _clusters_sql(),
    "op13_conversation_trie": r"""
WITH t AS (
  SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS i
  FROM (SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
        FROM conversations WHERE conv_id IS NOT NULL)),
-- the 256 entries of crc32's table, one row
crc AS (
  SELECT list(v ORDER BY i) AS tab
  FROM (SELECT i, list_reduce(list_concat([i], list_transform(range(8), lambda x: 0::BIGINT)),
                              lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) AS v FROM range(256) g(i))),
l AS (SELECT conv_id AS c, list({'g': digest, 'w': words} ORDER BY i) AS own FROM t GROUP BY conv_id),
h AS (
  SELECT l.c, own, coalesce(b.base, []) AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(l.c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                         lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) % 4 AS h
  FROM l CROSS JOIN crc LEFT JOIN (SELECT c, own AS base FROM l) b ON b.c = l.c - l.c % 20),
r AS MATERIALIZED (SELECT c, base[:h] || own[h + 1:] AS ts FROM h),
p AS MATERIALIZED (
  SELECT c, unnest(range(0, len(ts) + 1)) AS d, ts FROM r),
k AS MATERIALIZED (
  SELECT c, d, md5(array_to_string(list_transform(ts[:d], lambda x: x.g), ',')) AS key,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(ts[:d - 1], lambda x: x.g), ',')) END AS up,
         CASE WHEN d > 0 THEN ts[d].w ELSE 0 END AS w, d = len(ts) AS ends
  FROM p),
n AS MATERIALIZED (
  SELECT d, key, min(c) AS c, any_value(up) AS up, count(*) AS n, any_value(w) AS w,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS ends FROM k GROUP BY d, key),
m AS MATERIALIZED (
  SELECT n.*, coalesce(f.children, 0) AS children
  FROM n LEFT JOIN (SELECT d - 1 AS d, up AS key, count(*) AS children FROM n WHERE d > 0 GROUP BY 1, 2) f USING (d, key)),
-- a node adds to each prefix of its smallest member's turns up to its depth
s AS (
  SELECT a.d, a.key, count(*) FILTER (WHERE m.children = 0) AS leaves, sum((m.n - 1) * m.w) AS saved
  FROM m JOIN k a ON a.c = m.c AND a.d <= m.d GROUP BY a.d, a.key)
SELECT m.c AS conv_id, m.d AS depth, u.c AS parent_conv_id, m.n AS n_convs, m.children AS n_children, s.leaves AS n_leaves,
       s.saved::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s USING (d, key) LEFT JOIN n u ON u.d = m.d - 1 AND u.key = m.up
""",
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
