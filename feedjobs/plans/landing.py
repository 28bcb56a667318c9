"""Payloads landed from the driver's documents, one query a platform: written as the platform's JSON, read and normalized again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedjobs.operators.lineage import scratch
from feedjobs.plans.views import table
from feedjobs.functions.text import parse_count
from feedjobs.sources import html, normalize

NOW = "2024-01-31 00:00:00"
KEYWORDS = ["the", "ich"]
_DOCS = "doc_id IS NOT NULL AND text IS NOT NULL AND source IS NOT NULL"
_LINK = "concat('https://e.test/', source, '/', CAST(doc_id AS STRING))"
_TIME = "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id as int), 0)"
_EPOCH = "1704067200 + 60 * CAST(doc_id AS BIGINT)"
_NAME = "concat('u', CAST(doc_id AS STRING))"
_ISO = f"date_format({_TIME}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"

#: platform: the payload's record as Spark SQL over documents. A field that is left out, null or empty makes the normalizer fall back.
PAYLOADS = {
    "hn": f"named_struct('objectID', CAST(doc_id AS STRING), 'title', text, 'url', CASE WHEN n_chars % 2 = 0 THEN {_LINK} END, 'author', source, 'created_at', CASE WHEN lang = 'fr' THEN 'never' ELSE {_ISO} END, 'points', n_chars, 'num_comments', length(source))",
    "reddit": f"named_struct('data', named_struct('title', text, 'url', {_LINK}, 'permalink', concat('/r/', source), 'selftext', concat(' ', text, ' '), 'author', source, 'post_hint', CASE WHEN lang = 'de' THEN 'image' ELSE 'link' END, 'is_self', lang = 'fr', 'created_utc', CAST({_EPOCH} AS DOUBLE), 'score', n_chars, 'num_comments', length(source)))",
    "product_hunt": f"named_struct('node', named_struct('name', source, 'tagline', CASE WHEN lang <> 'fr' THEN text END, 'url', {_LINK}, 'createdAt', {_ISO}, 'votesCount', n_chars, 'commentsCount', length(source), 'user', named_struct('name', {_NAME})))",
    "huggingface": f"named_struct('id', CASE WHEN lang <> 'fr' THEN concat(source, '/', {_NAME}) END, 'modelId', {_NAME}, 'pipeline_tag', lang, 'likes', n_chars, 'downloads', length(source), 'lastModified', CASE WHEN lang <> 'de' THEN {_ISO} END)",
    "x": f"named_struct('type', CASE WHEN lang = 'es' THEN 'mock_tweet' ELSE 'tweet' END, 'url', {_LINK}, 'text', text, 'createdAt', date_format({_TIME}, \"EEE MMM dd HH:mm:ss '+0000' yyyy\"), 'likeCount', n_chars, 'replyCount', length(source), 'retweetCount', 1, 'author', named_struct('userName', source, 'name', CASE WHEN lang = 'fr' THEN '' ELSE {_NAME} END))",
    "threads": f"named_struct('id', CAST(doc_id AS STRING), 'text', text, 'permalink', CASE WHEN lang <> 'fr' THEN {_LINK} END, 'username', source, 'timestamp', date_format({_TIME}, \"yyyy-MM-dd'T'HH:mm:ss'+0000'\"), 'like_count', n_chars, 'replies_count', length(source))",
    "threads_apify": f"named_struct('text', text, 'url', {_LINK}, 'author', source, 'author_name', CASE WHEN lang = 'fr' THEN '' ELSE {_NAME} END, 'lang', CASE WHEN lang <> 'de' THEN lang END, 'created_at', CASE WHEN lang <> 'es' THEN {_EPOCH} ELSE 0 END, 'like_count', n_chars, 'reply_count', length(source), 'repost_count', 1)",
}


#: Where the list of records stands in a payload.
NESTING = {"hn": ["hits"], "reddit": ["data", "children"], "product_hunt": ["data", "posts", "edges"], "threads": ["data"]}


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where(_DOCS)


def payloads(spark: SparkSession, sf: str, platform: str) -> DataFrame:
    """The documents as landed payloads of a platform, read back from JSON: one payload a line."""
    inside = normalize.SCHEMAS[platform][1]
    record = F.expr(PAYLOADS[platform])
    rows = documents(spark, sf)
    if inside is None:
        rows = rows.select(record.alias("r")).select("r.*")
    else:
        made, outer = F.array(record), NESTING[platform]
        for name in reversed(outer[1:]):
            made = F.struct(made.alias(name))
        rows = rows.select(made.alias(outer[0]))
    path = f"{scratch(spark)}/{platform}"
    rows.write.json(path)
    return normalize.landed(spark, path, platform, lines=True)


def shown(items: DataFrame) -> DataFrame:
    """What the SQL is held against."""
    return items.select("title", "url", "canonical_url", "source_handle", "author", "excerpt", "language", "posted_at", F.to_json("engagement").alias("engagement"))


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


def pages(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """page_id, html: a page a document, as a repository list or as a streamed page with script chunks."""
    docs = documents(spark, sf)
    escape = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    if kind == "list":
        stars = F.when(F.col("lang") == "fr", F.concat(F.format_number("n_chars", 0))).otherwise(F.concat(F.col("n_chars").cast("string"), F.lit("k")))
        made = F.concat(F.lit('<html><article class="Box-row x"><h2><a href="/'), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit('">n</a></h2><p> '), escape(F.col("text")), F.lit(' </p><a href="/a/stargazers"> '), stars, F.lit(" </a></article></html>"))
    else:
        record = F.to_json(F.struct(F.col("doc_id").alias("rank"), (F.col("n_chars") + 0.5).alias("score"), F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("full_name"), F.col("text").alias("description")))
        quoted = F.replace(F.replace(record, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        made = F.concat(F.lit('<script>self.__next_f.push([0,"1:[{"])</script><script>self.__next_f.push([1,"x\\q"])</script><script>self.__next_f.push([27,"a:'), quoted, F.lit('"])</script>'))
    return docs.select(F.col("doc_id").alias("page_id"), made.alias("html"))


def hacker_news(spark, sf):
    return shown(normalize.hacker_news(payloads(spark, sf, "hn"), _now(), KEYWORDS))


def reddit(spark, sf):
    return shown(normalize.reddit(payloads(spark, sf, "reddit"), _now(), "sub"))


def github(spark, sf):
    rows = html.repo_lists(pages(spark, sf, "list"))
    return shown(normalize.github_trending(rows.withColumn("stars", parse_count(F.col("stars"))), _now(), "", []))


def trendshift(spark, sf):
    return shown(normalize.trendshift(html.ranked_repos(pages(spark, sf, "chunks")), _now(), 25, []))


def product_hunt(spark, sf):
    return shown(normalize.product_hunt(payloads(spark, sf, "product_hunt"), _now()))


def hugging_face(spark, sf):
    return shown(normalize.hugging_face(payloads(spark, sf, "huggingface"), _now(), "models"))


def x(spark, sf):
    return shown(normalize.x(payloads(spark, sf, "x"), _now()))


def threads(spark, sf):
    return shown(normalize.threads(payloads(spark, sf, "threads"), _now(), "keyword", "ai"))


def threads_apify(spark, sf):
    return shown(normalize.threads_apify(payloads(spark, sf, "threads_apify"), _now()))


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as feed entries, a feed a source, landed in order of doc_id (then lang, null first) and read back from XML."""
    time, iso = F.expr(f"date_format({_TIME}, \"EEE, dd MMM yyyy HH:mm:ss '+0000'\")"), F.expr(_ISO)
    fields = [F.concat(F.lit(" "), "source", F.lit(" "), F.col("doc_id").cast("string"), F.lit(" ")).alias("title"), F.expr(_LINK).alias("link"), F.concat(F.lit("<p>"), "lang", F.lit("</p>  x")).alias("description")]
    fields += [F.when(F.col("lang") == "fr", F.col("source")).alias("summary"), F.when(F.col("lang") != "de", time).alias("pubDate"), iso.alias("updated"), F.col("lang").alias("author"), F.col("source").alias("feed")]
    path = f"{scratch(spark)}/feed"
    docs = documents(spark, sf).select("doc_id", "lang", "source").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "lang")
    docs.select(*fields).write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    return normalize.feed(spark, path, extra=("feed string",))


def _feed(source: str) -> Callable[[SparkSession, str], DataFrame]:
    """Each feed's first 30 entries as landed: by their numbers, and entries of one number by language."""

    def run(spark, sf):
        return shown(normalize.rss(entries(spark, sf), _now(), "", source=source, limit=30, handle="feed"))

    return run


rss, rsshub, wewe_rss = _feed("rss"), _feed("rsshub"), _feed("wewe_rss")


#: Two sources that tell the same stories: links stand for up to three documents each, so titles and links tie documents together.
STORIES = {
    "hn": "named_struct('objectID', CAST(doc_id AS STRING), 'title', text, 'url', concat('https://e.test/', CAST(doc_id - doc_id % 3 AS STRING)), 'author', source, 'points', n_chars)",
    "product_hunt": "named_struct('node', named_struct('name', text, 'url', concat('https://e.test/', CAST(doc_id - (doc_id + 1) % 3 AS STRING)), 'votesCount', n_chars))",
}


def stories(spark: SparkSession, docs: DataFrame, platform: str) -> DataFrame:
    """The documents' stories as landed: files for each of their sources, which follow each other by name, in them a payload a line, in this a few records in order of doc_id.

    Texts are shuffled once: what is sorted into ranges of files and lines is grouped there.
    """
    record, outer = F.expr(STORIES[platform]), NESTING[platform]
    rows = docs.select(F.col("source").alias("file"), F.expr("doc_id div 3").alias("line"), "doc_id", record.alias("r")).repartitionByRange("file", "line")
    rows = rows.groupBy("file", "line").agg(F.array_sort(F.collect_list(F.struct("doc_id", "r"))).alias("rs"))
    made = F.transform("rs", lambda x: x["r"])
    for name in reversed(outer[1:]):
        made = F.struct(made.alias(name))
    path = f"{scratch(spark)}/{platform}"
    rows.select("file", "line", made.alias(outer[0])).sortWithinPartitions("file", "line").drop("line").write.partitionBy("file").json(path, compression="gzip")
    return normalize.landed(spark, path, platform, lines=True)


def delivery(spark: SparkSession, docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All items of both sources with their arrival numbers; with ``columns`` of them these only."""
    parts = [normalize.hacker_news(stories(spark, docs, "hn"), _now(), []), normalize.product_hunt(stories(spark, docs, "product_hunt"), _now(), tier=1)]
    return normalize.arrival(parts, columns)


_HASH = "sha1(trim(regexp_replace(regexp_replace(lower(text), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')))"


def delivery_sql(where: str) -> str:
    """seq, id, title_hash, tier, source, doc_id of a delivery of these documents."""
    hn = f"SELECT 0 AS part, 'hn' AS source, 2 AS tier, doc_id, source AS file, sha1('https://e.test/' || (doc_id - doc_id % 3)) AS id, {_HASH} AS title_hash FROM documents WHERE {_DOCS} AND text <> '' AND {where}"
    ph = f"SELECT 1, 'product_hunt', 1, doc_id, source, sha1('https://e.test/' || (doc_id - (doc_id + 1) % 3)), {_HASH} FROM documents WHERE {_DOCS} AND {where}"
    return f"SELECT row_number() OVER (ORDER BY part, file, doc_id) - 1 AS seq, id, title_hash, tier, source, doc_id FROM ({hn} UNION ALL {ph}) d"  # noqa: S608


#: The row-by-row merge: one row a step, with the ids that were accepted and the holder of each title; then one over a store.
MERGE_SQL = """first AS ({first}), whole AS ({whole}),
m1(n, seen, held) AS (
    SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST(MAP {{}} AS MAP(VARCHAR, STRUCT(tier INTEGER, seq BIGINT)))
    UNION ALL SELECT n + 1, CASE WHEN take THEN list_append(seen, id) ELSE seen END, CASE WHEN take THEN map_concat(held, MAP {{title_hash: {{'tier': tier, 'seq': seq}}}}) ELSE held END
    FROM (SELECT *, NOT list_contains(seen, id) AND coalesce(tier < held[title_hash].tier, TRUE) AS take FROM m1 JOIN first ON first.seq = m1.n) s),
stored AS (SELECT f.* FROM first f JOIN (SELECT unnest(map_values(held)).seq AS seq FROM m1 WHERE n = (SELECT count(*) FROM first)) h USING (seq)),
fresh AS (SELECT row_number() OVER (ORDER BY w.seq) - 1 AS n, w.*, s.tier AS bar FROM whole w LEFT JOIN stored s USING (title_hash) WHERE w.id NOT IN (SELECT id FROM stored)),
m2(step, seen, held, won) AS (
    SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST(MAP {{}} AS MAP(VARCHAR, STRUCT(tier INTEGER, seq BIGINT))), CAST([] AS BIGINT[])
    UNION ALL SELECT step + 1, CASE WHEN take THEN list_append(seen, id) ELSE seen END, CASE WHEN take AND bar IS NULL THEN map_concat(held, MAP {{title_hash: {{'tier': tier, 'seq': seq}}}}) ELSE held END,
        CASE WHEN take AND bar IS NOT NULL THEN list_append(won, seq) ELSE won END
    FROM (SELECT *, NOT list_contains(seen, id) AND CASE WHEN bar IS NOT NULL THEN tier < bar ELSE coalesce(tier < held[title_hash].tier, TRUE) END AS take FROM m2 JOIN fresh ON fresh.n = m2.step) s),
kept AS (SELECT unnest(list_concat(won, list_transform(map_values(held), lambda h: h.seq))) AS seq FROM m2 WHERE step = (SELECT count(*) FROM fresh))"""


# The expected items by SQL.
_S = r"'^\s+|\s+$'"
_CUT = "CASE WHEN length({0}) > 120 THEN substr({0}, 1, 120) || '…' ELSE {0} END"
_D = f"(SELECT *, 'https://e.test/' || source || '/' || doc_id AS link, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS BIGINT)) AS ts, regexp_replace(text, {_S}, '', 'g') AS bare FROM documents WHERE {_DOCS}) d"


def _sql(title: str, url: str, handle: str, author: str, excerpt: str, language: str, posted: str, counts: str, where: str = "TRUE", canonical: str | None = None, rows: str = _D) -> str:
    return f"SELECT {title} AS title, {url} AS url, {canonical or url} AS canonical_url, {handle} AS source_handle, {author} AS author, {excerpt} AS excerpt, {language} AS language, {posted} AS posted_at, {counts} AS engagement FROM {rows} WHERE {where}"  # noqa: S608


def _json(**counts: str) -> str:
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in counts.items()) + " || '}'"


_LATER = f"TIMESTAMP '{NOW}'"
_FEED_ROWS = f"(SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, lang NULLS FIRST) AS place FROM {_D}) f"
_HN = "CASE WHEN n_chars % 2 = 0 THEN link ELSE 'https://news.ycombinator.com/item?id=' || doc_id END"
_REDDIT = "CASE WHEN lang IN ('de', 'fr') THEN 'https://www.reddit.com/r/' || source ELSE link END"
_TREND = f"(SELECT *, source || '/' || doc_id AS full_name FROM {_D}) r"


def _feed_sql(posted: str, excerpt: str) -> str:
    return _sql("source || ' ' || doc_id", "link", "source", "coalesce(lang, '')", excerpt, "'en'", posted, "'{}'", "place <= 30", rows=_FEED_ROWS)


_DATED = f"CASE WHEN lang <> 'de' THEN ts ELSE {_LATER} END"
_SUMMARY = "CASE WHEN lang = 'fr' THEN source ELSE {} END"
SQL = {
    "n1_hacker_news": _sql("text", _HN, "'front_page'", "source", "''", "'en'", f"CASE WHEN lang = 'fr' THEN {_LATER} ELSE ts END", _json(score="n_chars", comments="length(source)"), "text <> '' AND (contains(lower(text), 'the') OR contains(lower(text), 'ich'))"),
    "n2_reddit": _sql("text", _REDDIT, "'r/sub'", "source", "substr(bare, 1, 200)", "'en'", "ts", _json(score="n_chars", comments="length(source)"), "text <> ''"),
    "n3_github_trending": _sql("source || '/' || doc_id", "'https://github.com/' || source || '/' || doc_id", "'trending:all'", "source", "substr(bare, 1, 200)", "'en'", _LATER, _json(stars="CASE WHEN lang = 'fr' THEN n_chars ELSE n_chars * 1000 END")),
    "n4_trendshift": _sql("full_name", "'https://github.com/' || full_name", "'rising:rank-' || doc_id", "source", "substr(text, 1, 200)", "'en'", _LATER, _json(rank="doc_id", score="n_chars"), rows=_TREND),
    "n5_product_hunt": _sql("regexp_replace(CASE WHEN lang <> 'fr' THEN source || ' — ' || text ELSE source END, '^[ —]+|[ —]+$', '', 'g')", "link", "'daily_top_ai'", "'u' || doc_id", "CASE WHEN lang <> 'fr' THEN substr(text, 1, 200) ELSE '' END", "'en'", "ts", _json(votes="n_chars", comments="length(source)")),
    "n6_hugging_face": _sql("name", "'https://huggingface.co/' || name", "'trending:models'", "CASE WHEN lang <> 'fr' THEN source ELSE '' END", "lang", "'en'", _DATED, _json(likes="n_chars", downloads="length(source)"), rows=f"(SELECT *, CASE WHEN lang <> 'fr' THEN source || '/u' || doc_id ELSE 'u' || doc_id END AS name FROM {_D}) m"),
    "n7_rss": _feed_sql("ts", _SUMMARY.format("coalesce(lang || ' x', '')")),
    "n8_rsshub": _feed_sql(_DATED, _SUMMARY.format("coalesce(lang || ' x', '')")),
    "n9_wewe_rss": _feed_sql(_DATED, _SUMMARY.format("''")),
    "n10_x": _sql(_CUT.format("bare"), "link", "'@' || source", "CASE WHEN lang = 'fr' THEN source ELSE 'u' || doc_id END", "substr(bare, 1, 200)", "'en'", "ts", _json(likes="n_chars", comments="length(source)", retweets="1"), "lang <> 'es' AND bare <> ''"),
    "n11_threads": _sql(_CUT.format("bare"), "CASE WHEN lang <> 'fr' THEN link ELSE 'https://www.threads.net/post/' || doc_id END", "'keyword:ai'", "source", "substr(bare, 1, 200)", "'en'", "ts", _json(likes="n_chars", comments="length(source)")),
    "n12_threads_apify": _sql(_CUT.format("bare"), "link", "'@' || source", "CASE WHEN lang = 'fr' THEN source ELSE 'u' || doc_id END", "substr(bare, 1, 200)", "CASE WHEN lang <> 'de' THEN lang ELSE 'en' END", f"CASE WHEN lang <> 'es' THEN ts ELSE {_LATER} END", _json(likes="n_chars", comments="length(source)", reposts="1"), "bare <> ''"),
}
RUNS = {"n1_hacker_news": hacker_news, "n2_reddit": reddit, "n3_github_trending": github, "n4_trendshift": trendshift, "n5_product_hunt": product_hunt, "n6_hugging_face": hugging_face, "n7_rss": rss, "n8_rsshub": rsshub, "n9_wewe_rss": wewe_rss, "n10_x": x, "n11_threads": threads, "n12_threads_apify": threads_apify}
