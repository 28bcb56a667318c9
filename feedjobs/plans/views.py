"""Feed-shaped views over the driver's tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLATFORMS = ["x", "reddit", "hn", "rss", "rsshub", "github_trending", "product_hunt", "wewe_rss"]
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_N = "CAST(substr(source, 4, 5) AS INT)"
_NAMES = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PLATFORMS))
#: Expressions that both engines read alike.
_SOURCE = f"CASE CASE WHEN {_N} = 13 THEN 7 ELSE {_N} % 8 END {_NAMES} END"
#: Titles are whole texts, but for X, whose normalizer cuts them.
_ITEM = f"""
  doc_id AS seq, text,
  CASE WHEN {_SOURCE} = 'x' AND length(text) > 120 THEN concat(substr(text, 1, 120), '…') ELSE text END AS title,
  concat('https://', source, '.Example.com/d/', CAST(doc_id - CASE WHEN doc_id % 5 = 4 THEN 1 ELSE 0 END AS STRING), '?utm_source=feed&b=2&a=1#x') AS url,
  concat('https://', source, '.example.com/d/', CAST(doc_id - CASE WHEN doc_id % 5 = 4 THEN 1 ELSE 0 END AS STRING), '?a=1&b=2') AS link,
  {_SOURCE} AS source,
  CASE WHEN {_N} = 3 THEN 'openai_blog' ELSE source END AS source_handle,
  CASE WHEN {_N} % 2 = 0 THEN 1 ELSE 2 END AS source_tier,
  CASE WHEN {_N} = 5 THEN 'zh-TW' WHEN {_N} IN (7, 13) THEN 'zh-CN' ELSE lang END AS language,
  substr(text, 1, 200) AS excerpt,
  concat('user', CAST(doc_id % 37 AS STRING)) AS author,
  CAST(n_chars % 1000 AS BIGINT) AS likes, CAST(doc_id % 50 AS BIGINT) AS comments
"""  # noqa: S608


def v_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(table(spark, sf_dir, "documents"))


def items_of(docs: DataFrame) -> DataFrame:
    """Items from documents. The SQL form builds ``link`` directly; here canonical_url makes it from url."""
    from feedjobs.functions.text import item_id, title_hash
    from feedjobs.functions.urls import canonical_url

    docs = docs.where("doc_id is not null and text is not null and source is not null")
    minutes = "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast({} as int), 0)"
    times = f"{minutes.format('doc_id')} AS fetched_at, {minutes.format('doc_id - n_chars % 3000')} AS posted_at"
    rows = docs.sparkSession.sql(f"SELECT {_ITEM}, {times} FROM {{docs}}", docs=docs).drop("link")  # noqa: S608
    rows = rows.withColumn("canonical_url", canonical_url(F.col("url"))).withColumn("id", item_id(F.col("canonical_url"))).withColumn("title_hash", title_hash(F.col("title")))
    return rows.withColumn("engagement", F.create_map(F.lit("likes"), "likes", F.lit("comments"), "comments"))


STORED = "hour(posted_at) < 12"


def v_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored: items posted before noon."""
    return v_items(spark, sf_dir).where(STORED)


def v_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery of all items, those that are stored too."""
    return v_items(spark, sf_dir)


_RUN = """
  event_id AS id, concat('src_', CAST(user_id AS STRING)) AS source, ts AS started_at,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
  CAST(floor(value) AS INT) AS items_fetched,
  CASE WHEN event_type <> 'error' THEN NULL WHEN event_id % 4 = 3 THEN 'ReadTimeout: https://api.test/v?token=abc&x=1'
       ELSE concat('HTTPStatusError: ', CAST(CASE event_id % 4 WHEN 0 THEN 401 WHEN 1 THEN 404 ELSE 500 END AS STRING), ' for https://api.test/v?token=abc&x=1') END AS error
"""


def v_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedjobs.operators.runs import error_class

    rows = spark.sql(f"SELECT {_RUN} FROM {{events}}", events=table(spark, sf_dir, "events"))  # noqa: S608
    rows = rows.withColumn("error_class", F.when(F.col("status") != "ok", error_class(F.col("error"))))
    return rows.withColumn("attempts", F.when(F.col("error_class") == "transient", 4).otherwise(1))


def v_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr("conv_id AS story", "turn AS pos", "role AS author", "text", "role = 'system' AS deleted")


#: CTEs for the oracle.
ITEMS_SQL = f"""
raw_items AS (SELECT {_ITEM.replace('STRING', 'VARCHAR')}, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS BIGINT)) AS fetched_at,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id - n_chars % 3000 AS BIGINT)) AS posted_at
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL AND source IS NOT NULL),
v_items AS (SELECT * EXCLUDE (link), link AS canonical_url, sha1(link) AS id,
  sha1(trim(regexp_replace(regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))) AS title_hash, likes + comments AS total,
  CAST(fetched_at + INTERVAL 8 HOUR AS DATE) AS day,
  CASE WHEN language LIKE 'zh-TW%' THEN 'zh_tw' WHEN language LIKE 'zh-CN%' THEN CASE WHEN source = 'wewe_rss' THEN 'wechat' ELSE 'zh_cn' END
       WHEN source = 'rss' THEN CASE WHEN regexp_matches(source_handle, 'anthropic|openai|google|mistral|xai') THEN 'rss_lab' ELSE 'rss_media' END ELSE source END AS section
  FROM raw_items),
v_store AS (SELECT * FROM v_items WHERE {STORED}),
v_batch AS (SELECT * FROM v_items)"""  # noqa: S608
RUNS_SQL = f"""
raw_runs AS (SELECT {_RUN.replace('STRING', 'VARCHAR')} FROM events),
classed AS (SELECT *, CASE WHEN status = 'ok' THEN NULL WHEN error LIKE 'ReadTimeout%' OR error LIKE 'HTTPStatusError: 5%' THEN 'transient' WHEN error LIKE 'HTTPStatusError: 401%' OR error LIKE 'HTTPStatusError: 403%' THEN 'user_action_required' ELSE 'persistent_error' END AS error_class FROM raw_runs),
v_runs AS (SELECT *, CASE WHEN error_class = 'transient' THEN 4 ELSE 1 END AS attempts FROM classed)"""  # noqa: S608
