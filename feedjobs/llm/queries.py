"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedjobs.llm import language, licenses, quality, trie, url_filter
from feedjobs.llm.alignment import align
from feedjobs.llm.ann import nearest
from feedjobs.llm.mixing import mix
from feedjobs.llm.near_dup import near_duplicates
from feedjobs.llm.packing import pack
from feedjobs.llm.sharding import shard_documents
from feedjobs.llm.simhash import simhash_components
from feedjobs.llm.topk import top_products

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 100 = 0"), k=10)


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), 8)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.predict(docs, language.learn(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return top_products(rows, rows.where("vec_id % 100 = 0"), k=10, scale=1024)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.train(url_filter.seed_urls(spark)), URL_RULES)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.learn(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), tokenizer_path(), window=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"), words=4, radius=4)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = trie.prefix_trie(trie.rebuilt(trie.conversations(_table(spark, sf_dir, "conversations"))))
    found = nodes.join(trie.ends_digest(ends), ["conv_id", "depth"], "left")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


# The same rows by plain SQL: all pairs of the searches, the published loop of jump hashing, and windows over whole sources.

_TOPK = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(max(list_inner_product(q.e, c.e)) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e) GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score FROM s)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 10"""

_MIXING = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|0'), 1, 16) AS key FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
    SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight,
        2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM t),
l AS (
    SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (
    SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, cap / weight) FROM l WHERE level <= cap / weight), cap / weight) * weight) AS target FROM l),
p AS (
    SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
e AS (
    SELECT p.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN floor(floor(target) / g.source_size) ELSE 0 END AS epochs
    FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, source,
    CAST(epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - before)) AS BIGINT) AS taken FROM e"""


_TRIE = r"""
WITH RECURSIVE crc(i, k, c) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
byte AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS d,
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS step, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: xor(a >> 8, byte.t[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM own), byte),
turns AS (
    SELECT c.conv_id, o.d, o.step, o.words FROM convs c JOIN own o ON o.conv_id = c.base AND o.d <= c.h
    UNION ALL SELECT c.conv_id, o.d + c.h, o.step, o.words FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.d > c.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY d) AS d, step, words FROM turns),
prefixes AS (
    SELECT conv_id, d, words, string_agg(step, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM placed
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lasts AS (SELECT conv_id, max_by(path, d) AS path FROM prefixes GROUP BY 1),
ended AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM lasts GROUP BY 1),
nodes AS (SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM prefixes GROUP BY 1, 2),
kids AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (path)),
above AS (SELECT left(path, 32 * d.range) AS path, n_children, (n_convs - 1) * words AS saved FROM full_nodes, range(100000) d WHERE d.range <= depth),
sums AS (SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM full_nodes n JOIN sums s USING (path) LEFT JOIN ended e USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing": _MIXING, "op7_exact_topk": _TOPK, "op12_prefix_trie": _TRIE}
