"""From landed payloads to items, one function a platform.

Payloads are read by Spark's JSON and XML sources with a given schema (SCHEMAS); ``landed`` explodes
the list in them. Rows without title or url are dropped unless said otherwise. ``fetched_at``,
the tier and the language come from the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedjobs.functions.text import excerpt, item_id, matches_any, shorten, strip, title_hash
from feedjobs.functions.times import from_epoch, parse_time
from feedjobs.functions.urls import canonical_url
from feedjobs.operators.lineage import cut
from feedjobs.operators.ordered import numbered

_TWEET = "type string, url string, text string, createdAt string, likeCount long, replyCount long, retweetCount long, author struct<userName:string,name:string>"
_THREAD = "text string, url string, author string, author_name string, lang string, created_at long, like_count long, reply_count long, repost_count long"
#: platform: (schema of a landed file's row, path of the list in it or None for an array of rows)
SCHEMAS = {
    "hn": ("hits array<struct<objectID:string,title:string,url:string,author:string,created_at:string,points:long,num_comments:long>>", "hits"),
    "reddit": ("data struct<children:array<struct<data:struct<title:string,url:string,permalink:string,selftext:string,author:string,post_hint:string,is_self:boolean,created_utc:double,score:long,num_comments:long>>>>", "data.children.data"),
    "product_hunt": ("data struct<posts:struct<edges:array<struct<node:struct<name:string,tagline:string,url:string,createdAt:string,votesCount:long,commentsCount:long,user:struct<name:string>>>>>>", "data.posts.edges.node"),
    "huggingface": ("id string, modelId string, pipeline_tag string, likes long, downloads long, lastModified string", None),
    "x": (_TWEET, None),
    "threads": ("data array<struct<id:string,text:string,permalink:string,username:string,timestamp:string,like_count:long,replies_count:long>>", "data"),
    "threads_apify": (_THREAD, None),
}


def landed(spark: SparkSession, path: str, platform: str, *, lines: bool = False) -> DataFrame:
    """The payloads' records with place, where their payload was landed, and pos, their own place in it. A payload is a file or, with ``lines``, a line.

    What can't be read is left out (see damaged); a field that is not of its type is null.
    """
    schema, inside = SCHEMAS[platform]
    rows = _read_json(spark, path, schema, lines).where(~_lost(schema)).drop(CORRUPT)
    if inside is None:
        return rows.withColumn("pos", F.lit(0).cast("long"))
    return rows.select(F.posexplode(inside).alias("pos", "r"), "place").select("r.*", F.col("pos").cast("long").alias("pos"), "place")


#: Where Spark's readers put the text of what they can't read.
CORRUPT = "_corrupt_record"


def _lost(schema: str) -> Column:
    """Nothing of the row could be read."""
    names = T.StructType.fromDDL(schema).names
    return F.col(CORRUPT).isNotNull() & F.concat_ws("", *[F.when(F.col(n).isNotNull(), F.lit("x")) for n in names]).eqNullSafe("")


def _read_json(spark: SparkSession, path: str, schema: str, lines: bool) -> DataFrame:
    rows = spark.read.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT).json(path, multiLine=not lines)
    return rows.withColumn("place", landing_place())


def landing_place() -> Column:
    """file, block, row: sorts as the files' names do, and inside a file as its rows stand.

    A file's blocks start one after another, and Spark reads the rows of a block in one task and in order. So the order of these triples is the same however
    files are split and blocks dealt, though their last number is not.
    """
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def damaged(spark: SparkSession, path: str, platform: str, *, lines: bool = False) -> DataFrame:
    """file, reason, text (at most 200 characters) of landed payloads or records that are no JSON or not of the platform's form: the quarantine of ``landed``."""
    schema, _ = SCHEMAS[platform]
    rows = _read_json(spark, path, schema, lines).where(_lost(schema))
    return rows.select(F.col("place.file").alias("file"), F.lit(f"not a {platform} payload").alias("reason"), F.substring(CORRUPT, 1, 200).alias("text"))


_FEED = "title string, link string, description string, summary string, pubDate string, published string, updated string, author string"


def _read_xml(spark: SparkSession, path: str, atom: bool, extra: tuple[str, ...]) -> DataFrame:
    schema = ", ".join([_FEED, *extra, f"{CORRUPT} string"])
    rows = spark.read.format("xml").option("rowTag", "entry" if atom else "item").option("columnNameOfCorruptRecord", CORRUPT).schema(schema).load(path)
    rows = rows.withColumn("place", landing_place())
    return rows if any(e.split(" ")[0] == "feed" for e in extra) else rows.withColumn("feed", F.col("place.file"))


def feed(spark: SparkSession, path: str, *, atom: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """RSS items or Atom entries, one row each, with place as in ``landed``. ``extra``: more fields, as ``name type``; ``feed`` is the file's path if it is not one of them.

    Entries that can't be read are left out (see damaged_feed).
    """
    return _read_xml(spark, path, atom, extra).where(~_lost(_FEED)).drop(CORRUPT).withColumn("pos", F.lit(0).cast("long"))


def damaged_feed(spark: SparkSession, path: str, *, atom: bool = False) -> DataFrame:
    """file, reason, text of feed entries that are no XML or not of a feed's form."""
    rows = _read_xml(spark, path, atom, ()).where(_lost(_FEED))
    return rows.select(F.col("place.file").alias("file"), F.lit("not a feed entry").alias("reason"), F.substring(CORRUPT, 1, 200).alias("text"))


def _n(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("bigint"), F.lit(0).cast("long"))


def _items(rows: DataFrame, *, source: str, title: Column, url: Column, posted: Column, fetched: Column, counts: dict[str, Column], handle: Column | None = None, author: Column | None = None, text: Column | None = None, language: Column | None = None, tier: int = 2, drop_empty: bool = True) -> DataFrame:
    empty = F.lit("")
    engagement = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), v)]) if counts else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    made = rows.select(
        F.lit(source).alias("source"), F.coalesce(handle, empty).alias("source_handle") if handle is not None else empty.alias("source_handle"), F.lit(tier).alias("source_tier"),
        F.coalesce(title, empty).alias("title"), F.coalesce(url, empty).alias("url"), posted.alias("posted_at"), fetched.alias("fetched_at"),
        (F.coalesce(author, empty) if author is not None else empty).alias("author"), (F.coalesce(text, empty) if text is not None else empty).alias("excerpt"),
        (language if language is not None else F.lit("en")).alias("language"), engagement.alias("engagement"), *[c for c in ("place", "pos") if c in rows.columns],
    )
    if drop_empty:
        made = made.where((F.col("title") != "") & (F.col("url") != ""))
    made = made.withColumn("canonical_url", canonical_url(F.col("url")))
    return made.withColumn("id", item_id(F.col("canonical_url"))).withColumn("title_hash", title_hash(F.col("title")))


def hacker_news(rows: DataFrame, fetched: Column, keywords: list[str], *, tier: int = 2) -> DataFrame:
    url = F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit("https://news.ycombinator.com/item?id="), "objectID"))
    rows = rows.where(matches_any(F.coalesce("title", F.lit("")), keywords))
    return _items(rows, source="hn", title=F.col("title"), url=url, posted=parse_time(F.col("created_at"), fetched), fetched=fetched, counts={"score": _n("points"), "comments": _n("num_comments")}, handle=F.lit("front_page"), author=F.col("author"), tier=tier)


def reddit(rows: DataFrame, fetched: Column, subreddit: str, *, tier: int = 2) -> DataFrame:
    """A post on the site itself or an image links to its discussion. A payload without a time is 1970, one with null is now; a landed column cannot tell them apart, so both are now."""
    page = F.concat(F.lit("https://www.reddit.com"), F.coalesce("permalink", F.lit("")))
    url = F.when(F.coalesce("is_self", F.lit(False)) | (F.coalesce("post_hint", F.lit("")) == "image"), page).otherwise(F.coalesce(F.nullif("url", F.lit("")), page))
    return _items(rows, source="reddit", title=F.col("title"), url=url, posted=F.coalesce(from_epoch(F.col("created_utc")), fetched), fetched=fetched, counts={"score": _n("score"), "comments": _n("num_comments")}, handle=F.lit(f"r/{subreddit}"), author=F.col("author"), text=F.substring(strip(F.coalesce("selftext", F.lit(""))), 1, 200), tier=tier)


def github_trending(rows: DataFrame, fetched: Column, language: str, keywords: list[str], *, tier: int = 2) -> DataFrame:
    """rows: slug, description, stars (see html.repo_lists)."""
    rows = rows.where(matches_any(F.concat_ws(" ", "slug", "description"), keywords)).withColumn("place", page_place(rows))
    return _items(rows, source="github_trending", title=F.col("slug"), url=F.concat(F.lit("https://github.com/"), "slug"), posted=fetched, fetched=fetched, counts={"stars": _n("stars")}, handle=F.lit(f"trending:{language or 'all'}"), author=F.substring_index("slug", "/", 1), text=F.substring("description", 1, 200), tier=tier)


def trendshift(rows: DataFrame, fetched: Column, limit: int, keywords: list[str], *, tier: int = 2) -> DataFrame:
    """rows: rank, score, full_name, description, and page_id and pos of the record (see html.ranked_repos).

    Of records with one rank and name on a page the first one counts, and of those with one rank the first ones come first. The limit holds for each page and comes before the keywords.
    """
    page = [c for c in ("page_id",) if c in rows.columns]
    stands = [c for c in ("pos",) if c in rows.columns] or ["full_name"]
    again = F.row_number().over(Window.partitionBy(*page, "rank", "full_name").orderBy(*stands))
    place = F.row_number().over(Window.partitionBy(*page).orderBy("rank", *stands))
    rows = rows.withColumn("_again", again).where("_again = 1").withColumn("_place", place).where(F.col("_place") <= limit).where(matches_any(F.col("full_name"), keywords))
    rows = rows.withColumns({"place": page_place(rows), "pos": F.col("_place").cast("long")})
    return _items(rows, source="trendshift", title=F.col("full_name"), url=F.concat(F.lit("https://github.com/"), "full_name"), posted=fetched, fetched=fetched, counts={"rank": _n("rank"), "score": F.col("score").cast("long")}, handle=F.concat(F.lit("rising:rank-"), F.col("rank").cast("string")), author=F.substring_index("full_name", "/", 1), text=F.substring("description", 1, 200) if "description" in rows.columns else None, tier=tier)


def page_place(rows: DataFrame) -> Column:
    """As landing_place, for records of pages that have numbers."""
    page = F.col("page_id") if "page_id" in rows.columns else F.lit(None)
    return F.struct(F.lit(None).cast("string").alias("file"), page.cast("long").alias("block"), F.lit(0).cast("long").alias("row"))


def product_hunt(rows: DataFrame, fetched: Column, *, tier: int = 2) -> DataFrame:
    title = F.regexp_replace(F.concat_ws(" — ", F.coalesce("name", F.lit("")), F.coalesce("tagline", F.lit(""))), "^[ —]+|[ —]+$", "")
    return _items(rows, source="product_hunt", title=title, url=F.col("url"), posted=parse_time(F.col("createdAt"), fetched), fetched=fetched, counts={"votes": _n("votesCount"), "comments": _n("commentsCount")}, handle=F.lit("daily_top_ai"), author=F.col("user.name"), text=F.substring("tagline", 1, 200), tier=tier, drop_empty=False)


def hugging_face(rows: DataFrame, fetched: Column, category: str, *, tier: int = 2) -> DataFrame:
    name = F.coalesce(F.nullif("id", F.lit("")), "modelId")
    author = F.when(F.contains(name, F.lit("/")), F.substring_index(name, "/", 1))
    return _items(rows, source="huggingface", title=name, url=F.concat(F.lit("https://huggingface.co/"), name), posted=parse_time(F.col("lastModified"), fetched), fetched=fetched, counts={"likes": _n("likes"), "downloads": _n("downloads")}, handle=F.lit(f"trending:{category}"), author=author, text=F.col("pipeline_tag"), tier=tier)


def rss(rows: DataFrame, fetched: Column, source_id: str, *, limit: int = 30, source: str = "rss", language: str = "en", tier: int = 2, handle: str | None = None) -> DataFrame:
    """source: ``rss``, ``rsshub`` (no fallback to the update time) or ``wewe_rss`` (also: summaries only).

    The limit holds for each feed, by the column ``feed`` if there is one. ``handle``: a column that names each row's source in place of ``source_id``.
    """
    place = F.row_number().over(Window.partitionBy(*[c for c in ["feed"] if c in rows.columns]).orderBy(*[c for c in ("place", "pos") if c in rows.columns]))
    rows = rows.withColumn("_place", place).where(F.col("_place") <= limit)
    text = F.col("summary") if source == "wewe_rss" else F.coalesce(F.nullif("summary", F.lit("")), "description")
    times = [F.coalesce("pubDate", "published"), *([F.col("updated")] if source == "rss" else [])]
    return _items(rows, source=source, title=strip(F.col("title")), url=strip(F.col("link")), posted=parse_time(F.coalesce(*times), fetched), fetched=fetched, counts={}, handle=F.lit(source_id) if handle is None else F.col(handle), author=F.col("author"), text=excerpt(F.coalesce(text, F.lit(""))), language=F.lit(language), tier=tier)


def x(rows: DataFrame, fetched: Column, *, tier: int = 2, language: str = "en") -> DataFrame:
    rows = rows.where("type = 'tweet'").withColumn("text", strip(F.col("text")))
    user = F.coalesce("author.userName", F.lit(""))
    return _items(rows, source="x", title=shorten(F.col("text"), 120), url=F.col("url"), posted=parse_time(F.col("createdAt"), fetched), fetched=fetched, counts={"likes": _n("likeCount"), "comments": _n("replyCount"), "retweets": _n("retweetCount")}, handle=F.when(user != "", F.concat(F.lit("@"), user)), author=F.coalesce(F.nullif("author.name", F.lit("")), user), text=F.substring("text", 1, 200), language=F.lit(language), tier=tier)


def threads(rows: DataFrame, fetched: Column, mode: str, query: str, *, language: str = "en", tier: int = 2) -> DataFrame:
    """Texts may be empty here. The mode ``user`` has no results."""
    rows = rows.where(F.lit(mode != "user")).withColumn("text", strip(F.col("text")))
    url = F.coalesce(F.nullif("permalink", F.lit("")), F.concat(F.lit("https://www.threads.net/post/"), "id"))
    return _items(rows, source="threads", title=shorten(F.coalesce("text", F.lit("")), 120), url=url, posted=parse_time(F.col("timestamp"), fetched), fetched=fetched, counts={"likes": _n("like_count"), "comments": _n("replies_count")}, handle=F.lit(f"{mode}:{query}"), author=F.col("username"), text=F.substring("text", 1, 200), language=F.lit(language), tier=tier, drop_empty=False)


def threads_apify(rows: DataFrame, fetched: Column, *, language: str = "en", tier: int = 2) -> DataFrame:
    rows = rows.withColumn("text", strip(F.col("text"))).withColumn("author", F.nullif("author", F.lit("")))
    return _items(rows, source="threads", title=shorten(F.col("text"), 120), url=F.col("url"), posted=F.coalesce(from_epoch(F.nullif("created_at", F.lit(0).cast("long"))), fetched), fetched=fetched, counts={"likes": _n("like_count"), "comments": _n("reply_count"), "reposts": _n("repost_count")}, handle=F.concat(F.lit("@"), "author"), author=F.coalesce(F.nullif("author_name", F.lit("")), "author"), text=F.substring("text", 1, 200), language=F.coalesce(F.nullif("lang", F.lit("")), F.lit(language)), tier=tier)


def arrival(parts: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    """All sources' items with seq: 0, 1, 2, ... by the source's place in the list, the payload's file and place in it, and the item's place in its payload.

    The same items have the same numbers however files are split and dealt to tasks. Parts that were not landed as files order by ``pos`` alone, which must then
    tell their items apart. With ``columns`` the items have these only, which are written before they are sorted: what is landed is read once and texts go no further.
    """
    none = F.lit(None).cast("struct<file:string,block:bigint,row:bigint>")
    made = [(p if "place" in p.columns else p.withColumn("place", none)).withColumn("source_pos", F.lit(i)) for i, p in enumerate(parts)]
    out = made[0]
    for p in made[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    order = ["source_pos", "place", "pos"]
    return numbered(out if columns is None else cut(out.select(*columns, *[c for c in order if c not in columns])), order)
