"""The daily digest: sections, ranks, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedjobs.functions.times import business_day
from feedjobs.operators.ordered import running

# The sections' keys and labels in the order in which they are printed, and the names that mark a lab's feed.
SECTIONS = [
    ("x", "X / Twitter"),
    ("threads", "Threads"),
    ("reddit", "Reddit"),
    ("hn", "Hacker News"),
    ("github_trending", "GitHub Trending"),
    ("trendshift", "GitHub Rising (Trendshift)"),
    ("product_hunt", "Product Hunt"),
    ("huggingface", "HuggingFace"),
    ("rss_lab", "Lab Blogs & Releases"),
    ("rss_media", "English Tech Media"),
    ("zh_cn", "中文 / 中國"),
    ("wechat", "中文 / 微信公眾號"),
    ("zh_tw", "中文 / 台灣"),
]
LABS = "anthropic|openai|google|mistral|xai"


def section(source: Column, handle: Column, language: Column) -> Column:
    return (
        F.when(language.startswith("zh-TW"), F.lit("zh_tw"))
        .when(language.startswith("zh-CN"), F.when(source == "wewe_rss", F.lit("wechat")).otherwise(F.lit("zh_cn")))
        .when(source == "rss", F.when(F.coalesce(handle, F.lit("")).rlike(LABS), F.lit("rss_lab")).otherwise(F.lit("rss_media")))
        .otherwise(source)
    )


def sections(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("section_order"), F.lit(k).alias("section"), F.lit(v).alias("label")) for i, (k, v) in enumerate(SECTIONS)])
    return spark.range(1).select(F.inline(rows))


def engagement(counts: Column) -> Column:
    """The sum of all numbers, whatever they count."""
    return F.coalesce(F.aggregate(F.map_values(counts), F.lit(0).cast("long"), lambda a, v: a + F.coalesce(v, F.lit(0).cast("long"))), F.lit(0).cast("long"))


def placed(items: DataFrame) -> DataFrame:
    """Adds day, section and total (engagement)."""
    return items.withColumn("day", business_day(F.col("fetched_at"))).withColumn("section", section(F.col("source"), F.col("source_handle"), F.col("language"))).withColumn("total", engagement(F.col("engagement")))


def printed_order() -> Column:
    """A text that sorts as a section is printed: better tier, more engagement, newer, id. Over the columns of ``placed``."""
    down = lambda c: F.lpad((F.lit(1 << 62) - c).cast("string"), 20, "0")
    newest = F.unix_micros(F.coalesce("posted_at", F.lit("1970-01-01").cast("timestamp_ntz")).cast("timestamp"))
    return F.concat_ws(" ", F.lpad((F.coalesce("source_tier", F.lit(2)) + 1_000_000).cast("string"), 10, "0"), down(F.col("total")), down(newest), "id")


def ranked(items: DataFrame, top: int | None = None) -> DataFrame:
    """Adds rank in (day, section): better tier, more engagement, newer, id. With ``top`` Spark cuts groups before the shuffle.

    Without ``top`` all are ranked by running counts over ranges, as one section may hold most of a day; only their order and ``seq`` (``id``, if they have none), which must tell
    items apart, are sorted and written for that.
    """
    rows = placed(items)
    if top is None:
        key = "seq" if "seq" in items.columns else "id"
        narrow = rows.select("day", "section", printed_order().alias("_order"), F.col(key).alias("_key"))
        counted = running(narrow, ["day", "section"], ["_order"], F.lit(1).cast("long"), "rank").select("_key", F.col("rank").cast("int").alias("rank"))
        return rows.join(counted, F.col(key) == F.col("_key")).drop("_key")
    order = Window.partitionBy("day", "section").orderBy(F.coalesce("source_tier", F.lit(2)), F.desc("total"), F.desc("posted_at"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def preview(items: DataFrame, n: int) -> DataFrame:
    """The first ``n`` items in order of arrival."""
    return items.orderBy("seq").limit(n)


def summary(items: DataFrame, failed: DataFrame) -> DataFrame:
    """items, sources_active, failed: one row."""
    counts = items.agg(F.count(F.lit(1)).alias("items"), F.count_distinct(F.struct(F.coalesce("source", F.lit("")), F.coalesce("source_handle", F.lit("")))).alias("sources_active"))
    return counts.join(F.broadcast(failed.agg(F.count(F.lit(1)).alias("failed"))), F.lit(True))


#: Bits of a sketch's buckets: 2**13 give counts within about 1 %.
SKETCH_BITS = 13


def source_sketches(items: DataFrame) -> DataFrame:
    """day, sources (a sketch), items: what a day keeps so that distinct (source, handle) pairs of any range of days are counted without the items."""
    pair = F.concat_ws("\x1f", F.coalesce("source", F.lit("")), F.coalesce("source_handle", F.lit("")))
    return items.groupBy(business_day(F.col("fetched_at")).alias("day")).agg(F.hll_sketch_agg(pair, F.lit(SKETCH_BITS)).alias("sources"), F.count(F.lit(1)).alias("items"))


def sources_in(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """items, sources_active of the days from ``first`` to ``last``, from the days' sketches: short rows, merged; within about 2 % of the exact count (see summary)."""
    rows = sketches.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return rows.agg(F.coalesce(F.sum("items"), F.lit(0)).alias("items"), F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sources")), F.lit(0)).alias("sources_active"))


def section_counts(items: DataFrame) -> DataFrame:
    """Items a section, and the grand total under a null section."""
    return placed(items).rollup("section").agg(F.count(F.lit(1)).alias("items"))


def statistics(items: DataFrame) -> DataFrame:
    """Counts by section, by hour of posting, by language and of all, from one shuffle of three narrow columns."""
    rows = placed(items).select("section", F.hour("posted_at").alias("hour"), "language")
    grouped = rows.groupingSets([[F.col("section")], [F.col("hour")], [F.col("language")], []], F.col("section"), F.col("hour"), F.col("language"))
    return grouped.agg(F.count(F.lit(1)).alias("items"), F.grouping_id().alias("g")).select(F.element_at(F.map_from_arrays(F.array(*map(F.lit, (3, 5, 6, 7))), F.array(*map(F.lit, ("section", "hour", "language", "all")))), F.col("g").cast("int")).alias("kind"), F.coalesce("section", F.col("hour").cast("string"), "language", F.lit("all")).alias("key"), "items")


def top_authors(items: DataFrame, k: int = 12) -> DataFrame:
    likes = F.coalesce(F.try_element_at("engagement", F.lit("likes")), F.lit(0).cast("long"))
    rows = items.groupBy("source_handle", "source").agg(F.sum(likes).alias("likes"), F.count(F.lit(1)).alias("posts"))
    return rows.orderBy(F.desc("likes"), "source_handle", "source").limit(k)


def top_posts(items: DataFrame, source: str, k: int = 10) -> DataFrame:
    return placed(items.where(F.col("source") == source)).orderBy(F.desc("total"), "id").limit(k)


def top_per(items: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return items.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("n") <= n)


def hours(items: DataFrame) -> DataFrame:
    """Posts by hour of day; hours without any are 0."""
    spine = items.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    counted = items.groupBy(F.hour("posted_at").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counted, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("posts"))
