import random

from pyspark.sql import functions as F

from feedjobs.operators import digest, watch
from feedjobs.operators.ordered import running
from feedjobs.plans import render

ITEM = "id string, title string, url string, source string, source_handle string, source_tier int, posted_at timestamp_ntz, fetched_at timestamp_ntz, author string, excerpt string, language string, engagement map<string,bigint>"
FULL = ITEM + ", comments array<struct<author:string,text:string>>, also_appeared_in array<struct<source:string,source_handle:string,url:string>>"


def at(text):
    import datetime

    return datetime.datetime.fromisoformat(text)


def item(i, source, handle, **more):
    row = {"title": f"T{i}", "url": f"https://e.com/{i}", "tier": 1, "posted": "2026-04-26 03:00:00", "author": "", "excerpt": "", "language": "en", "engagement": {}} | more
    base = (i, row["title"], row["url"], source, handle, row["tier"], at(row["posted"]), at("2026-04-26 04:00:00"), row["author"], row["excerpt"], row["language"], row["engagement"])
    return (*base, row.get("comments"), row.get("seen"))


def test_item(spark):
    full = item("a", "x", "@me", author="me", excerpt=" two\nlines ", engagement={"likes": 5, "comments": 2, "score": 9}, comments=[("u", "a\nb"), (None, "z" * 301)], seen=[("hn", "front_page", "u"), ("rss", None, "v")])
    bare = item("b", "reddit", "r/s", author="someone", tier=None, engagement={"score": 9, "likes": 0})
    got = [r[0] for r in spark.createDataFrame([full, bare], FULL).orderBy("id").select(render.item(FULL)).collect()]
    assert got[0] == (
        "### [Ta](https://e.com/a)\n\n`x:@me` · T1 · 2026-04-26 03:00 UTC · en · ♥ 5 · 💬 2\n\n> two lines\n\n"
        f"> 💬 Top comments:\n> - **@u**: a b\n> - **@?**: {'z' * 300}…\n\n_also seen at: hn:front_page; rss:_\n\n---\n"
    )
    assert got[1] == "### [Tb](https://e.com/b)\n\n`reddit:r/s` · T2 · 2026-04-26 03:00 UTC · en · by someone · ▲ 9\n\n---\n"


def test_day(spark):
    rows = [item("a", "hn", "front_page", tier=2, engagement={"score": 9}), item("b", "x", "@u", tier=2), item("c", "x", "@u", tier=1), item("d", "x", "@v", tier=2, engagement={"likes": 3}), item("e", "rsshub", "f"), item("f", "rss", "openai_blog"), item("g", "rss", "OpenAI")]
    items = spark.createDataFrame(rows, FULL).drop("comments", "also_appeared_in")
    failed = spark.createDataFrame([("2026-04-26", "s2", "boom"), ("2026-04-26", "s1", "bang"), ("2026-04-27", "s3", "no")], "day string, source string, error string").withColumn("day", F.col("day").cast("date"))
    lines = [r.line for r in render.day(items, digest.sections(spark), failed, "2026-04-26T12:00:00+08:00").orderBy("day", "section_order", "position", "line").collect()]
    text = "\n".join(lines)
    assert text.startswith("# AI Daily Digest — 2026-04-26\n\n> generated_at: 2026-04-26T12:00:00+08:00 (Asia/Taipei)\n> total_items: 7  |  sources_active: 6  |  sources_failed: 2\n> failures:\n>   - s1: bang\n>   - s2: boom\n\n---\n\n## X / Twitter (3 items)\n\n### [Tc]")
    titles = [x for x in text.split("\n") if x.startswith("#")][1:]
    assert [t.split("]")[0] for t in titles] == ["## X / Twitter (3 items)", "### [Tc", "### [Td", "### [Tb", "## Hacker News (1 items)", "### [Ta", "## Lab Blogs & Releases (1 items)", "### [Tf", "## English Tech Media (1 items)", "### [Tg"]


def test_issues(spark):
    kind = "source string, last_error string, last_error_class string, last_attempts int, last_ok_at timestamp_ntz, consecutive long, hint string"
    rows = [("b", "", "", 4, None, 1, ""), ("a", "x", "transient", 4, at("2026-04-26 20:00:00"), 7, "wait"), ("c", "401", "user_action_required", 1, None, 2, "log in")]
    text = "\n".join(r.line for r in render.issues(spark.createDataFrame(rows, kind), "2026-04-27 08:00").orderBy("section_order", "position").collect())
    assert text.endswith(
        "## 🚨 User action required (1)\n\n- **c** (user_action_required) — 401\n  - last ok: （無紀錄） · consecutive fails: 2 · last attempts: 1\n  - → log in\n\n"
        "## 🪦 Stable failures (≥7 連續失敗) (1)\n\n- **a** (transient) — x\n  - last ok: 2026-04-27 04:00 CST · consecutive fails: 7 · last attempts: 4\n  - → wait\n\n"
        "## ⏳ Transient — retry 用完仍失敗、下次 run 會再試 (1)\n\n- **b** (transient) — (no error message)\n  - last ok: （無紀錄） · consecutive fails: 1 · last attempts: 4\n  - → \n"
    )
    assert text.startswith("# Known Issues — auto-updated by social_info pipeline\n\n> Last updated: 2026-04-27 08:00 (Asia/Taipei)\n")
    none = render.issues(spark.createDataFrame([], kind), "2026-04-27 08:00").collect()
    assert len(none) == 1 and none[0].line.endswith("\n\n✅ 所有 source 上次 fetch 都成功，沒有需要處理的 issue。")


def test_comments_lose_their_entities(spark):
    said = [(1, 0, "a", "it&#x27;s &gt; 3 &amp; <b>x</b>", False), (1, 1, "b", "<p></p> ", False), (1, 2, "", "no author", False), (1, 3, "c", "gone", True), (1, 4, "d", "&quot;" * 301, None), (1, 5, "e", "sixth", False)]
    comments = spark.createDataFrame(said, "story long, pos int, author string, text string, deleted boolean")
    got = {r.story: [tuple(c) for c in r.comments] for r in watch.with_comments(spark.createDataFrame([(1,), (2,)], "story long"), comments).collect()}
    assert got == {1: [("a", "it's > 3 & x"), ("d", '"' * 300 + "…")], 2: []}


def test_running(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(100)) for i in range(500)] + [("hot", i, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t int, v long").repartition(7)
    got = {(r.k, r.t): r.s for r in running(df, ["k"], ["t"], F.col("v"), "s").collect()}
    least = {(r.k, r.t): r.m for r in running(df, ["k"], ["t"], F.col("v"), "m", kind="min", inclusive=False).collect()}
    for key in ("a", "b", None, "hot"):
        own = sorted((t, v) for k, t, v in rows if k == key)
        for n, (t, _) in enumerate(own):
            assert got[key, t] == sum(v for _, v in own[: n + 1]) and least[key, t] == min((v for _, v in own[:n]), default=None)
