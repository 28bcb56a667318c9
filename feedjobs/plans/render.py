"""Markdown lines as rows with an ordering key; a sink writes them a day at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedjobs.functions.text import one_line, shorten, shows_author
from feedjobs.functions.times import show_local, show_utc
from feedjobs.operators.digest import placed, printed_order
from feedjobs.operators.runs import issue_bucket

# The words of the printed reports.
COUNTS = [("likes", "♥"), ("comments", "💬"), ("score", "▲")]
ISSUES_HEAD = (
    "# Known Issues — auto-updated by social_info pipeline\n\n> Last updated: {} (Asia/Taipei)\n"
    "> 來源 source 上次 fetch 失敗的最終狀態。pipeline 已自動 retry transient errors，出現在這裡的代表 retry 配額耗盡或屬於需要人介入的類別。\n"
)
NO_ISSUES = "✅ 所有 source 上次 fetch 都成功，沒有需要處理的 issue。"
BUCKETS = [
    ("user_action", "🚨 User action required"),
    ("persistent", "🛠 Persistent error — fetcher 需要更新"),
    ("stable", "🪦 Stable failures (≥7 連續失敗)"),
    ("transient", "⏳ Transient — retry 用完仍失敗、下次 run 會再試"),
]
NEVER_OK = "（無紀錄）"


def item(columns: list[str]) -> Column:
    """An item's block: link, meta line, excerpt, comments, other places, rule, with a blank line between. Parts that are missing are left out.

    ``columns``: those of the frame; comments (author, text) and also_appeared_in (source, source_handle) are optional.
    """

    def count(key: str, mark: str) -> Column:
        n = F.coalesce(F.try_element_at("engagement", F.lit(key)), F.lit(0).cast("long"))
        shown = (n != 0) & (F.col("source") != "x") if key == "score" else n != 0
        return F.when(shown, F.concat(F.lit(f"{mark} "), n.cast("string")))

    handle, author = F.coalesce("source_handle", F.lit("")), F.col("author")
    meta = [F.concat(F.lit("`"), "source", F.lit(":"), handle, F.lit("`")), F.concat(F.lit("T"), F.coalesce("source_tier", F.lit(2)).cast("string")), show_utc(F.col("posted_at")), F.col("language")]
    meta += [F.when(shows_author(author, handle), F.concat(F.lit("by "), author)), *[count(k, m) for k, m in COUNTS]]
    blocks = [
        F.concat(F.lit("### ["), "title", F.lit("]("), "url", F.lit(")\n")),
        F.concat(F.concat_ws(" · ", *meta), F.lit("\n")),
        F.when(F.coalesce("excerpt", F.lit("")) != "", F.concat(F.lit("> "), one_line(F.col("excerpt")), F.lit("\n"))),
    ]
    if "comments" in columns:
        said = F.transform("comments", lambda c: F.concat(F.lit("> - **@"), F.coalesce(c["author"], F.lit("?")), F.lit("**: "), shorten(one_line(F.coalesce(c["text"], F.lit(""))), 300)))
        blocks.append(F.when(F.size("comments") > 0, F.concat(F.lit("> 💬 Top comments:\n"), F.array_join(said, "\n"), F.lit("\n"))))
    if "also_appeared_in" in columns:
        seen = F.transform("also_appeared_in", lambda s: F.concat(s["source"], F.lit(":"), F.coalesce(s["source_handle"], F.lit(""))))
        blocks.append(F.when(F.size("also_appeared_in") > 0, F.concat(F.lit("_also seen at: "), F.array_join(seen, "; "), F.lit("_\n"))))
    return F.concat_ws("\n", *blocks, F.lit("---\n"))


def day(items: DataFrame, sections: DataFrame, failed: DataFrame, generated: str) -> DataFrame:
    """day, section_order, position, line: the head, the failed sources, one heading a section, its items.

    Rows are in order of (day, section_order, position, line); ``position`` is a key that sorts as the section does, so no section is ever ranked
    in one task or gathered in a row. Sections that are not in the list count in the head but are not printed. ``failed``: day, source, error.
    """
    rows = placed(items)
    bad = failed.groupBy("day").agg(F.count(F.lit(1)).alias("_bad"))
    totals = rows.groupBy("day").agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("source", F.coalesce("source_handle", F.lit(""))).alias("_sources"))
    days = totals.join(bad, "day", "left").select("day", "_n", "_sources", F.coalesce("_bad", F.lit(0)).alias("_failed"))
    place = lambda order, line: [F.col("day"), F.lit(order).alias("section_order"), F.lit("").alias("position"), line.alias("line")]
    head = F.concat(
        F.lit("# AI Daily Digest — "), F.col("day").cast("string"), F.lit(f"\n\n> generated_at: {generated} (Asia/Taipei)\n> total_items: "), F.col("_n").cast("string"),
        F.lit("  |  sources_active: "), F.col("_sources").cast("string"), F.lit("  |  sources_failed: "), F.col("_failed").cast("string"), F.when(F.col("_failed") > 0, F.lit("\n> failures:")).otherwise(F.lit("")),
    )
    failures = failed.join(days.select("day"), "day", "left_semi")
    out = days.select(*place(-3, head)).union(failures.select(*place(-2, F.concat(F.lit(">   - "), "source", F.lit(": "), F.coalesce("error", F.lit(""))))))
    out = out.union(days.select(*place(-1, F.lit("\n---\n"))))
    printed = rows.join(F.broadcast(sections), "section")
    titles = printed.groupBy("day", "section_order", "label").agg(F.count(F.lit(1)).alias("_n"))
    out = out.union(titles.select("day", "section_order", F.lit("").alias("position"), F.concat(F.lit("## "), "label", F.lit(" ("), F.col("_n").cast("string"), F.lit(" items)\n")).alias("line")))
    return out.union(printed.select("day", "section_order", printed_order().alias("position"), item(printed.columns).alias("line")))


def issues(known: DataFrame, generated: str) -> DataFrame:
    """section_order, position, line: the head, a heading with a count for each bucket, then one entry an issue in order of its source.

    ``known`` has hint beside the columns of runs.known_issues. Without issues the head is followed by one line that says so.
    """
    kind = F.coalesce(F.nullif("last_error_class", F.lit("")), F.lit("transient"))
    error = F.coalesce(F.nullif("last_error", F.lit("")), F.lit("(no error message)"))
    order = F.create_map(*[F.lit(x) for i, (k, _) in enumerate(BUCKETS) for x in (k, i)])
    label = F.create_map(*[F.lit(x) for kv in BUCKETS for x in kv])
    rows = known.withColumn("_bucket", issue_bucket(F.col("consecutive"), kind)).withColumn("section_order", F.element_at(order, F.col("_bucket")))
    counts = rows.groupBy("_bucket", "section_order").agg(F.count(F.lit(1)).alias("_n"))
    heads = counts.select("section_order", F.lit("").alias("position"), F.concat(F.lit("## "), F.element_at(label, F.col("_bucket")), F.lit(" ("), F.col("_n").cast("string"), F.lit(")\n")).alias("line"))
    ends = counts.select("section_order", F.lit("\U0010ffff").alias("position"), F.lit("").alias("line"))
    entry = F.concat(
        F.lit("- **"), "source", F.lit("** ("), kind, F.lit(") — "), error, F.lit("\n  - last ok: "), show_local(F.col("last_ok_at"), NEVER_OK), F.lit(" · consecutive fails: "), F.col("consecutive").cast("string"),
        F.lit(" · last attempts: "), F.col("last_attempts").cast("string"), F.lit("\n  - → "), "hint",
    )
    none = rows.agg(F.count(F.lit(1)).alias("_n"))
    top = none.select(F.lit(-1).alias("section_order"), F.lit("").alias("position"), F.concat(F.lit(ISSUES_HEAD.format(generated)), F.when(F.col("_n") == 0, F.lit(f"\n{NO_ISSUES}")).otherwise(F.lit(""))).alias("line"))
    return top.union(heads).union(rows.select("section_order", F.col("source").alias("position"), entry.alias("line"))).union(ends)
