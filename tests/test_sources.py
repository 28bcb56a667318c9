import json

import pytest
from pyspark.sql import functions as F

from feedjobs.operators import watch
from feedjobs.operators.dedup import dedup
from feedjobs.sources import commits, html, normalize, store

NOW = "2026-05-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def test_hacker_news(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"hits": [{"objectID": "1", "title": "AI said so", "url": None, "author": "a", "created_at": "2026-04-25T22:28:19Z", "points": 5, "num_comments": 2}, {"objectID": "2", "title": "Other", "url": "https://e.com", "author": "b"}, {"objectID": "3", "title": "", "url": "https://e.com"}]}))
    rows = normalize.hacker_news(normalize.landed(spark, str(tmp_path / "a.json"), "hn"), now(), ["ai"]).collect()
    assert [(r.url, r.engagement["score"], str(r.posted_at)) for r in rows] == [("https://news.ycombinator.com/item?id=1", 5, "2026-04-25 22:28:19")]


def test_tweets(spark, tmp_path):
    rows = [{"type": "tweet", "url": "https://x.com/a/1", "text": "t" * 130, "createdAt": "Sat Apr 25 22:28:19 +0000 2026", "likeCount": 7, "replyCount": 3, "retweetCount": 1, "author": {"userName": "a", "name": "A"}}, {"type": "mock_tweet", "url": "u", "text": "no"}]
    (tmp_path / "t.json").write_text(json.dumps(rows))
    got = normalize.x(normalize.landed(spark, str(tmp_path / "t.json"), "x"), now()).collect()
    assert len(got) == 1 and got[0].title == "t" * 120 + "…" and got[0].source_handle == "@a" and got[0].engagement == {"likes": 7, "comments": 3, "retweets": 1}


def test_rss(spark, tmp_path):
    (tmp_path / "f.xml").write_text('<rss version="2.0"><channel><item><title> One </title><link>https://e.com/1/</link><description>&lt;p&gt;text  here&lt;/p&gt;</description><pubDate>Sat, 25 Apr 2026 22:28:19 +0000</pubDate></item><item><title>Two</title><link></link></item></channel></rss>')
    got = normalize.rss(normalize.feed(spark, str(tmp_path / "f.xml")), now(), "feed1").collect()
    assert [(r.title, r.canonical_url, r.excerpt, str(r.posted_at)) for r in got] == [("One", "https://e.com/1", "text here", "2026-04-25 22:28:19")]


def test_html_readers(spark):
    page = '<article class="Box-row"><h2><a href="/o/r">o / r</a></h2><p>Does  things</p><a href="/o/r/stargazers"> 1,234 </a></article>'
    chunk = 'self.__next_f.push([1,"x:{\\"list\\":[{\\"rank\\":1,\\"score\\":9.5,\\"full_name\\":\\"o/r\\"}]}"])'
    pages = spark.createDataFrame([(1, page), (2, chunk), (3, None)], "page_id long, html string")
    assert [(r.slug, r.description, r.stars) for r in html.repo_lists(pages).collect()] == [("o/r", "Does  things", "1,234")]
    assert [(r["rank"], r.score, r.full_name) for r in html.ranked_repos(pages).collect()] == [(1, 9.5, "o/r")]


def test_pages_with_nested_tags_and_damaged_chunks(spark):
    page = '<article class="Box-row"><h2><a href="/o/r">o</a><a href="/x">x</a></h2><p> Has <a href="/y">a link</a> inside &amp; more </p><p>second</p><a href="/o/r/stargazers">1.2k</a><a href="/q/stargazers">9</a></article><p>outside</p><article class="Box-row"><h2></h2></article>'
    push = "self.__next_f.push([{},\"{}\"])"
    record = json.dumps({"rank": 2, "score": 9.9, "full_name": "o/r", "description": 'say &quot;é {x}"'})
    chunks = "".join([push.format(0, "1:{\\\"half"), push.format(1, "bad \\q"), push.format(27, json.dumps("[" + record)[1:-1]), push.format(3, json.dumps('{"rank": "no", "score": 1, "full_name": "a/b"}')[1:-1])])
    pages = spark.createDataFrame([(1, page), (2, chunks)], "page_id long, html string")
    assert [(r.slug, r.description, r.stars) for r in html.repo_lists(pages).collect()] == [("o/r", "Has a link inside & more", "1.2k")]
    assert [(r["rank"], r.score, r.full_name, r.description) for r in html.ranked_repos(pages).collect()] == [(2, 9.9, "o/r", 'say &quot;é {x}"')]


def test_damaged_records_keep_the_others(spark):
    """Numbers that are none or too large, deep nesting: the other records and pages stay, and the quarantine says why."""
    push = lambda body: 'self.__next_f.push([1,' + json.dumps(body) + '])'
    good = '{"rank": 3000000000, "score": 1.5, "full_name": "o/r"}'
    name = '"full_name": "a/b"'
    bodies = [
        '{"rank": Infinity, "score": 1, ' + name + "} " + good, '{"rank": 1e999, "score": 1, ' + name + "} " + good, '{"rank": 1, "score": NaN, ' + name + "}" + good, '{"rank": null, "score": 1, ' + name + "}" + good,
        '{"rank": 1, "score": 1, ' + name + ', "x": ' + "[" * 200_000 + "]" * 200_000 + "} " + good, ('{"rank": 1, "score": 1, ' + name + ', "y": ') * 3000 + "1" + "}" * 3000 + good, "} } { " + good + ' {"unclosed ' + good, good + ' {"full_name": 1',
    ]
    pages = spark.createDataFrame([(i, push(b)) for i, b in enumerate(bodies)] + [(100, None), (101, "")], "page_id long, html string")
    rows = html.ranked_repos(pages).collect()
    assert {(r.page_id, r["rank"]) for r in rows if r["rank"] != 1} == {(i, 3_000_000_000) for i in range(8)}
    bad = {(r.page_id, r.reason) for r in html.damaged_records(pages).collect()}
    assert {i for i, _ in bad} == {0, 1, 2, 3, 4, 5, 7} and (0, "rank or score is no number") in bad and (2, "rank or score is out of range") in bad
    html.register(spark)
    assert spark.sql("SELECT count(*) FROM {p} p, LATERAL ranked_records(p.html) r WHERE r.reason IS NULL", p=pages).first()[0] == len(rows)


def test_first_record_of_a_rank_and_name_counts(spark):
    rows = [(1, 0, 5, 1.0, "o/a", "first"), (1, 1, 5, 9.0, "o/a", "second"), (1, 2, 5, 2.0, "n/z", "tie, later"), (1, 3, 2, 1.0, "n/b", "top"), (2, 0, 5, 3.0, "o/a", "other page")]
    repos = spark.createDataFrame(rows, "page_id long, pos long, rank long, score double, full_name string, description string").repartition(3)
    got = normalize.trendshift(repos, now(), 2, []).orderBy("excerpt").collect()
    assert [(r.title, r.excerpt, r.engagement["score"]) for r in got] == [("o/a", "first", 1), ("o/a", "other page", 3), ("n/b", "top", 1)]


def test_damaged_payloads_are_set_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"hits": [{"objectID": "1", "title": "fine", "url": "https://e.com/1"}]}))
    (tmp_path / "b.json").write_text('{"hits": [{"objectID": "2", "title": ')
    (tmp_path / "c.json").write_text(json.dumps({"hits": [{"objectID": "3", "title": "odd points", "url": "https://e.com/3", "points": "many"}]}))
    rows = normalize.hacker_news(normalize.landed(spark, str(tmp_path), "hn"), now(), []).collect()
    assert {r.title for r in rows} == {"fine", "odd points"}
    assert [(r.file.rsplit("/", 1)[1], r.reason) for r in normalize.damaged(spark, str(tmp_path), "hn").collect()] == [("b.json", "not a hn payload")]
    (tmp_path / "x.xml").write_text("<rss><item><title>ok</title><link>https://e.com/</link></item><item><title>bad</link></item></rss>")
    assert [r.title for r in normalize.feed(spark, str(tmp_path / "x.xml")).collect()] == ["ok"]
    assert [r.reason for r in normalize.damaged_feed(spark, str(tmp_path / "x.xml")).collect()] == ["not a feed entry"]


def test_limits_hold_for_each_feed(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.xml").write_text("<rss>" + "".join(f"<item><title>{n}{i}</title><link>https://e.com/{n}{i}</link></item>" for i in range(3)) + "</rss>")
    got = normalize.rss(normalize.feed(spark, str(tmp_path)), now(), "f", limit=2).collect()
    assert sorted(r.title for r in got) == ["a0", "a1", "b0", "b1"]
    repos = spark.createDataFrame([(p, k, 1.0, f"o/{p}{k}", "d" * 300) for p in (1, 2) for k in (2, 1, 3)], "page_id long, rank int, score double, full_name string, description string")
    rows = normalize.trendshift(repos, now(), 2, []).collect()
    assert sorted(r.title for r in rows) == ["o/11", "o/12", "o/21", "o/22"] and {len(r.excerpt) for r in rows} == {200}


@pytest.mark.parametrize("bytes_", ["128m", "1k"])
def test_arrival_numbers_do_not_depend_on_the_layout(spark, tmp_path, bytes_):
    """Two sources of 200 files: one number for each item, the same however files are split and dealt."""
    parts, before = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    for platform in "ab":
        (tmp_path / platform).mkdir()
        for f in range(200):
            payloads = [{"hits": [{"objectID": f"{platform}{f:03d}-{line}-{i}", "title": "t", "points": i} for i in range(2)]} for line in range(3)]
            (tmp_path / platform / f"{f:03d}.json").write_text("\n".join(map(json.dumps, payloads)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
    spark.conf.set("spark.sql.files.openCostInBytes", "1" if bytes_ == "1k" else "4m")
    try:
        parts = [normalize.hacker_news(normalize.landed(spark, str(tmp_path / p), "hn", lines=True), now(), []) for p in "ab"]
        got = [r.url.rsplit("=", 1)[1] for r in normalize.arrival(parts).orderBy("seq").collect()]
        numbers = [r.seq for r in normalize.arrival(parts).orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [f"{p}{f:03d}-{line}-{i}" for p in "ab" for f in range(200) for line in range(3) for i in range(2)] and numbers == list(range(2400))


def test_three_files_with_repeated_links(spark, tmp_path):
    for f, links in enumerate([[1, 2], [1], [3, 1]]):
        (tmp_path / f"{f}.json").write_text(json.dumps({"hits": [{"objectID": str(i), "title": f"story {i}", "url": f"https://e.com/{i}"} for i in links]}))
    items = normalize.arrival([normalize.hacker_news(normalize.landed(spark, str(tmp_path), "hn"), now(), [])])
    new, _ = dedup(items, items.limit(0))
    assert sorted((r.url, r.seq) for r in new.collect()) == [("https://e.com/1", 0), ("https://e.com/2", 1), ("https://e.com/3", 3)]


def test_a_broken_append_is_never_read(spark, tmp_path):
    path, rows = str(tmp_path / "items"), spark.createDataFrame([(f"i{n}", n, NOW) for n in range(4)], "id string, seq long, t string").withColumn("fetched_at", F.col("t").cast("timestamp_ntz"))
    assert store.append_items(rows.where("seq < 2"), None, path, "day-1")
    rows.where("seq = 3").withColumn("fetch_day", F.lit("2026-05-01")).write.partitionBy("fetch_day").parquet(f"{path}/commit=day-2")  # as if it ended before its commit
    assert sorted(r.id for r in store.read_items(spark, path).collect()) == ["i0", "i1"]
    assert not store.append_items(rows, None, path, "day-1")  # repeated
    assert store.append_items(rows, store.read_items(spark, path), path, "day-2")
    assert sorted(r.id for r in store.read_items(spark, path).collect()) == ["i0", "i1", "i2", "i3"]
    commits.compact(spark, path, ("fetch_day",), ["id"])
    assert sorted(r.id for r in store.read_items(spark, path).collect()) == ["i0", "i1", "i2", "i3"] and not store.append_items(rows, None, path, "day-2")


def test_config_rows(spark):
    rows = spark.createDataFrame([("a", "rss", None, None, None, {"u": "1"}), ("b", "x", False, 1, "fr", None)], "id string, type string, enabled boolean, tier int, language string, params map<string,string>")
    assert [(r.id, r.enabled, r.tier, r.language) for r in store.with_config_defaults(rows).orderBy("id").collect()] == [("a", True, 2, "en"), ("b", False, 1, "fr")]
    with pytest.raises(Exception, match="needs id and type"):
        store.with_config_defaults(rows.withColumn("type", F.lit(""))).collect()


def test_store_round_trip(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = spark.createDataFrame([("a", 1, None, '{"likes": 3}'), ("a", 2, "x", None), ("b", 3, "x", None)], "id string, seq long, author string, engagement_json string").withColumn("fetched_at", now())
    store.append_items(rows, None, path)
    store.append_items(rows, store.read_items(spark, path), path)
    got = sorted((r.id, r.seq, r.author, r.engagement) for r in store.read_items(spark, path).collect())
    assert got == [("a", 1, "", {"likes": 3}), ("b", 3, "x", {})]


def test_config(spark):
    with pytest.raises(ValueError):
        store.source_config(spark, [{"id": "a"}])
    row = store.source_config(spark, [{"id": "a", "type": "rss", "url": "u"}]).collect()[0]
    assert (row.enabled, row.tier, row.language, row.params) == (True, 2, "en", {"url": "u"})


def test_report(spark, tmp_path):
    lines = spark.createDataFrame([("2026-05-01", 0, 1, "b"), ("2026-05-01", -1, 0, "a")], "day string, section_order int, position int, line string")
    for _ in range(2):
        store.write_report(lines, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out" / "day=2026-05-01").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "a\nb\n"


def test_reddit(spark, tmp_path):
    posts = [
        {"title": "Link", "url": "https://e.com/a", "permalink": "/r/s/1", "selftext": " \n body\t", "author": "a", "is_self": False, "created_utc": 1777156099.0, "score": 5, "num_comments": 2},
        {"title": "Self", "url": "https://e.com/b", "permalink": "/r/s/2", "is_self": True, "created_utc": 1777156099.0},
        {"title": "Image", "url": "https://i.e.com/c", "permalink": "/r/s/3", "post_hint": "image"},
        {"title": "No link", "url": None, "permalink": "/r/s/4"},
        {"title": "", "url": "https://e.com/e", "permalink": "/r/s/5"},
    ]
    (tmp_path / "r.json").write_text(json.dumps({"data": {"children": [{"data": p} for p in posts]}}))
    got = {r.title: r for r in normalize.reddit(normalize.landed(spark, str(tmp_path / "r.json"), "reddit"), now(), "s", tier=1).collect()}
    assert {t: r.url.removeprefix("https://www.reddit.com") for t, r in got.items()} == {"Link": "https://e.com/a", "Self": "/r/s/2", "Image": "/r/s/3", "No link": "/r/s/4"}
    first = got["Link"]
    assert (first.excerpt, first.source_handle, first.source_tier, first.engagement, str(first.posted_at)) == ("body", "r/s", 1, {"score": 5, "comments": 2}, "2026-04-25 22:28:19")
    assert str(got["Image"].posted_at) == NOW


def test_product_hunt(spark, tmp_path):
    nodes = [{"name": "Tool", "tagline": "Does it", "url": "https://p.com/t?ref=x", "createdAt": "2026-04-25T22:28:19Z", "votesCount": 234, "commentsCount": 3, "user": {"name": "U"}}, {"name": "Bare", "url": "https://p.com/b"}]
    (tmp_path / "p.json").write_text(json.dumps({"data": {"posts": {"edges": [{"node": n} for n in nodes]}}}))
    got = normalize.product_hunt(normalize.landed(spark, str(tmp_path / "p.json"), "product_hunt"), now()).orderBy("pos").collect()
    assert [(r.title, r.canonical_url, r.source_handle, r.author, r.excerpt) for r in got] == [("Tool — Does it", "https://p.com/t", "daily_top_ai", "U", "Does it"), ("Bare", "https://p.com/b", "daily_top_ai", "", "")]
    assert got[0].engagement == {"votes": 234, "comments": 3} and str(got[0].posted_at) == "2026-04-25 22:28:19" and str(got[1].posted_at) == NOW


def test_hugging_face(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([{"id": "org/model", "pipeline_tag": "text", "likes": 3, "downloads": 9, "lastModified": "2026-04-25T22:28:19.000Z"}, {"modelId": "bare"}, {"likes": 1}]))
    got = normalize.hugging_face(normalize.landed(spark, str(tmp_path / "m.json"), "huggingface"), now(), "models").orderBy("title").collect()
    assert [(r.title, r.url, r.author, r.excerpt, r.engagement, str(r.posted_at)) for r in got] == [
        ("bare", "https://huggingface.co/bare", "", "", {"likes": 0, "downloads": 0}, NOW),
        ("org/model", "https://huggingface.co/org/model", "org", "text", {"likes": 3, "downloads": 9}, "2026-04-25 22:28:19"),
    ]


def test_threads(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"data": [{"id": "7", "text": " \n" + "a" * 121 + " ", "username": "u", "timestamp": "2026-04-25T22:28:19+0000", "like_count": 88}, {"id": "8", "text": "", "permalink": "https://t.net/8"}]}))
    rows = normalize.landed(spark, str(tmp_path / "t.json"), "threads")
    got = normalize.threads(rows, now(), "keyword", "ai", language="zh-TW").orderBy("pos").collect()
    assert [(r.title, r.url, r.author, r.language) for r in got] == [("a" * 120 + "…", "https://www.threads.net/post/7", "u", "zh-TW"), ("", "https://t.net/8", "", "zh-TW")]
    assert got[0].engagement == {"likes": 88, "comments": 0} and got[0].source_handle == "keyword:ai" and str(got[0].posted_at) == "2026-04-25 22:28:19"
    assert normalize.threads(rows, now(), "user", "ai").count() == 0


def test_threads_apify(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"text": " hi ", "url": "https://t.net/1", "author": "u", "author_name": "U", "lang": "fr", "created_at": 1777156099, "like_count": 1, "reply_count": 2, "repost_count": 3}, {"text": "x", "url": "https://t.net/2", "author": "", "created_at": 0}, {"text": "\t", "url": "https://t.net/3"}, {"text": "y", "url": ""}]))
    got = normalize.threads_apify(normalize.landed(spark, str(tmp_path / "a.json"), "threads_apify"), now(), language="zh-CN").orderBy("url").collect()
    assert [(r.title, r.source_handle, r.author, r.language, str(r.posted_at)) for r in got] == [("hi", "@u", "U", "fr", "2026-04-25 22:28:19"), ("x", "", "", "zh-CN", NOW)]
    assert got[0].engagement == {"likes": 1, "comments": 2, "reposts": 3}


def test_repos(spark):
    trending = spark.createDataFrame([("o/r", "An AI tool", 1234, 0), ("o/s", None, None, 1)], "slug string, description string, stars long, pos long")
    got = normalize.github_trending(trending, now(), "", ["ai"]).collect()
    assert [(r.title, r.url, r.author, r.source_handle, r.engagement) for r in got] == [("o/r", "https://github.com/o/r", "o", "trending:all", {"stars": 1234})]
    ranked = spark.createDataFrame([(2, 7.9, "o/ai"), (1, 9.5, "o/x"), (1, 9.5, "o/x"), (3, 1.0, "o/ai3")], "rank int, score double, full_name string")
    got = normalize.trendshift(ranked, now(), 2, ["ai"]).collect()
    assert [(r.title, r.source_handle, r.engagement) for r in got] == [("o/ai", "rising:rank-2", {"rank": 2, "score": 7})]


def test_feeds(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<feed><entry><title>\n One\n</title><link>https://e.com/1</link><summary>s</summary><updated>2026-04-25T22:28:19Z</updated></entry></feed>')
    (tmp_path / "w.xml").write_text("<rss><channel><item><title>W</title><link>https://e.com/w</link><description>only this</description><pubDate>Sat, 25 Apr 2026 22:28:19 GMT</pubDate></item></channel></rss>")
    atom, item = normalize.feed(spark, str(tmp_path / "a.xml"), atom=True), normalize.feed(spark, str(tmp_path / "w.xml"))
    assert [(r.title, r.excerpt, str(r.posted_at)) for r in normalize.rss(atom, now(), "f").collect()] == [("One", "s", "2026-04-25 22:28:19")]
    assert [str(r.posted_at) for r in normalize.rss(atom, now(), "f", source="rsshub").collect()] == [NOW]
    got = normalize.rss(item, now(), "acc", source="wewe_rss", language="zh-CN").collect()
    assert [(r.excerpt, r.language, r.source, r.source_handle, str(r.posted_at)) for r in got] == [("", "zh-CN", "wewe_rss", "acc", "2026-04-25 22:28:19")]


def test_arrival_and_repo_documents(spark):
    parts = [spark.createDataFrame([(n, i) for i in range(2)], "n string, pos long") for n in "ab"]
    assert [r.n + str(r.pos) for r in normalize.arrival(parts).orderBy("seq").collect()] == ["a0", "a1", "b0", "b1"]
    items = spark.createDataFrame([("https://github.com/o/r",), ("https://github.com/o/r/issues",), ("https://github.com/o/s",)], "canonical_url string")
    repos = spark.createDataFrame([("https://github.com/o/r", "x" * 2000, 5)], "url string, readme string, stars long")
    docs = spark.createDataFrame([("https://github.com/o/r", n, n * 300) for n in ("B.md", "A.md", "C.md")], "url string, name string, body string")
    got = {r.canonical_url[-1]: r for r in watch.enrich_repos(items, repos, docs, ["A.md", "B.md"]).collect()}
    assert set(got) == {"r", "s"} and len(got["r"].readme) == 1500 and got["r"].positioning == ("A.md" * 300)[:500] and got["s"].readme is None
