"""One query an operator over the driver's tables, with its SQL where it has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedjobs.functions import text as X
from feedjobs.functions import times as T
from feedjobs.functions.urls import canonical_url, is_repo_root
from feedjobs.operators import dedup as D
from feedjobs.operators import digest as G
from feedjobs.operators import runs as R
from feedjobs.operators import watch as W
from feedjobs.operators.lineage import scratch
from feedjobs.plans import landing, render
from feedjobs.plans.views import AS_OF, ITEMS_SQL, RUNS_SQL, STORED, items_of, table, v_batch, v_comments, v_items, v_runs, v_store
from feedjobs.sources import html, normalize, store
from feedjobs.streaming import jobs as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WATCH = [("research", "(?i)the", "tion"), ("numbers", "[0-9]", "[0-9]{3}"), ("french", "(?i) le | la ", "eau")]
KEYWORDS = ["AI", "tion", "ich"]
_EARLIER = "lang = 'en'"
NOISE = "^(The|Der|Le) "
ISSUE_HINTS = [("src_1", "renew the key"), ("src_2", "site moved")]
CLASS_HINTS = [("user_action_required", "log in again"), ("transient", "wait")]


def query(name: str, sql: str | None = None, views: str = ""):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = (f"WITH {views} " if views else "") + sql
        return f

    return add


_WS = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_CANON = r"""SELECT page_id, lower(regexp_extract(url, '^([^:]+)://([^/?#]*)([^?#]*)', 1)) || '://' || lower(regexp_extract(url, '^([^:]+)://([^/?#]*)([^?#]*)', 2))
 || CASE WHEN regexp_extract(url, '^([^:]+)://([^/?#]*)([^?#]*)', 3) = '/' THEN '/' ELSE regexp_replace(regexp_extract(url, '^([^:]+)://([^/?#]*)([^?#]*)', 3), '/+$', '') END
 || CASE WHEN q = '' THEN '' ELSE '?' || q END AS canonical_url
FROM (SELECT page_id, url, array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_') AND split_part(p, '=', 1) NOT IN ('fbclid','gclid','msclkid','yclid','ref','ref_src','ref_url','source','mc_cid','mc_eid','_hsenc','_hsmi'))), '&') AS q FROM pages) t"""


@query("s1_canonical_url", _CANON)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", canonical_url(F.col("url")).alias("canonical_url"))


@query("s1_untidy_urls", _CANON)
def _(spark, sf):
    """Links as people paste them: blanks before them, line ends and tabs within; the SQL takes the tidy ones."""
    pasted = F.concat(F.lit(" \x00\n "), F.substring("url", 1, 4), F.lit("\t"), F.expr("substr(url, 5, 9)"), F.lit("\r\n"), F.expr("substr(url, 14)"), F.lit("\n"))
    return table(spark, sf, "pages").select("page_id", canonical_url(pasted).alias("canonical_url"))


@query("s2_normalize_title", "SELECT seq, title_hash FROM v_items", ITEMS_SQL)
def _(spark, sf):
    return v_items(spark, sf).select("seq", X.title_hash(F.col("title")).alias("title_hash"))


@query("s3_item_id", "SELECT seq, id FROM v_items", ITEMS_SQL)
def _(spark, sf):
    return v_items(spark, sf).select("seq", "id")


@query("s4_clean_comment", rf"SELECT conv_id, turn, CASE WHEN length(t) > 300 THEN substr(t, 1, 300) || '…' ELSE t END AS comment FROM (SELECT conv_id, turn, {_WS.format("regexp_replace(text, '<[^>]+>', '', 'g')")} AS t FROM conversations) q")
def _(spark, sf):
    landed = F.col("text")  # as a site lands it: with entities
    for mark, entity in (("&", "&amp;"), ("'", "&#x27;"), ('"', "&quot;")):
        landed = F.replace(landed, F.lit(mark), F.lit(entity))
    return table(spark, sf, "conversations").select("conv_id", "turn", X.clean_comment(landed).alias("comment"))


@query("s5_html_excerpt", rf"SELECT page_id, substr({_WS.format("regexp_replace(html, '<[^>]+>', '', 'g')")}, 1, 200) AS excerpt FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.excerpt(F.col("html")).alias("excerpt"))


@query("s6_shorten", "SELECT doc_id, CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '…' ELSE text END AS title FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.shorten(F.col("text"), 120).alias("title"))


@query("s7_redact", "SELECT id, regexp_replace(error, '(?i)([?&](token|apikey|api_key|access_token|auth|key)=)[^&\\s''\"]+', '\\1***', 'g') AS error FROM v_runs WHERE status <> 'ok'", RUNS_SQL)
def _(spark, sf):
    return v_runs(spark, sf).where("status <> 'ok'").select("id", X.redact(F.col("error")).alias("error"))


@query("s8_one_line", r"SELECT doc_id, trim(replace(text, chr(10), ' ')) AS line FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.one_line(F.col("text")).alias("line"))


@query("s9_parse_count", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_id WHEN 1 THEN CAST(trunc(CAST(event_id % 100 AS DECIMAL(18,1)) * 1000 / 10) AS BIGINT) ELSE 0 END AS n FROM events")
def _(spark, sf):
    shown = F.expr("CASE event_id % 3 WHEN 0 THEN format_number(event_id, 0) WHEN 1 THEN concat(cast(cast(event_id % 100 as decimal(18,1)) / 10 as decimal(18,1)), 'k') ELSE 'many' END")
    return table(spark, sf, "events").select("event_id", X.parse_count(shown).alias("n"))


@query("s10_author", "SELECT seq, author <> '' AND author <> source_handle AS shown FROM v_items", ITEMS_SQL)
def _(spark, sf):
    return v_items(spark, sf).select("seq", X.shows_author(F.col("author"), F.concat(F.lit("@"), "source_handle")).alias("shown"))


@query("s11_error_parts", "SELECT id, regexp_extract(error, '^([A-Za-z_][A-Za-z0-9_.]*):', 1) AS name, TRY_CAST(NULLIF(regexp_extract(error, '\\b([1-5][0-9][0-9])\\b', 1), '') AS INT) AS status FROM v_runs WHERE error IS NOT NULL", RUNS_SQL)
def _(spark, sf):
    return v_runs(spark, sf).where("error is not null").select("id", X.error_name(F.col("error")).alias("name"), X.error_status(F.col("error")).alias("status"))


@query("t1_from_epoch", "SELECT event_id, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(event_id * 1000 AS BIGINT)) AS ts FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", T.from_epoch(F.col("event_id") * 1000).alias("ts"))


@query("t2_parse_time", "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def _(spark, sf):
    forms = [F.date_format("ts", f) for f in ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+0000'", "EEE MMM dd HH:mm:ss '+0000' yyyy", "EEE, dd MMM yyyy HH:mm:ss '+0000'")]
    shown = F.element_at(F.array(*forms), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", T.parse_time(shown, F.lit(AS_OF).cast("timestamp_ntz")).alias("ts"))


@query("t3_business_day", "SELECT CAST(ts + INTERVAL 8 HOUR AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-09 16:00:00' AND ts < TIMESTAMP '2024-01-10 16:00:00') AS inside FROM events GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "events").groupBy(T.business_day(F.col("ts")).alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_if(T.in_business_day(F.col("ts"), "2024-01-10")).alias("inside"))


@query("t4_look_back", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 36 HOUR")
def _(spark, sf):
    return table(spark, sf, "events").where(T.within(F.col("ts"), AS_OF, 36)).select("event_id")


@query("t5_show_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M UTC') AS utc, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M CST') AS local FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", T.show_utc(F.col("ts")).alias("utc"), T.show_local(F.col("ts")).alias("local"))


@query("t6_hours", "SELECT CAST(h.range AS INT) AS hour, count(v.seq) AS posts FROM range(24) h LEFT JOIN v_items v ON hour(v.posted_at) = h.range GROUP BY 1", ITEMS_SQL)
def _(spark, sf):
    return G.hours(v_items(spark, sf))


@query("f1_keywords", "SELECT seq FROM v_items WHERE contains(lower(title), 'ai') OR contains(lower(title), 'tion') OR contains(lower(title), 'ich')", ITEMS_SQL)
def _(spark, sf):
    return v_items(spark, sf).where(X.matches_any(F.col("title"), KEYWORDS)).select("seq")


@query("f2_enabled_sources", "SELECT id FROM v_runs WHERE CAST(substr(source, 5) AS INT) % 3 <> 0", RUNS_SQL)
def _(spark, sf):
    runs = v_runs(spark, sf)
    enabled = runs.select("source").distinct().where("cast(substr(source, 5) as int) % 3 <> 0")
    return runs.join(enabled, "source", "left_semi").select("id")


@query("f3_ok_runs", "SELECT id, items_fetched FROM v_runs WHERE status = 'ok'", RUNS_SQL)
def _(spark, sf):
    return v_runs(spark, sf).where("status = 'ok'").select("id", "items_fetched")


@query("f4_valid_records", "SELECT conv_id, turn FROM conversations WHERE role <> 'system' AND text <> ''")
def _(spark, sf):
    return table(spark, sf, "conversations").where("role <> 'system' and text <> ''").select("conv_id", "turn")


@query("f5_repo_root", "SELECT page_id, regexp_matches(u, '^https://github\\.com/[^/?]+/[^/?]+$') AS repo FROM (SELECT page_id, 'https://github.com/' || regexp_extract(url, '://[^/]+/([^?#]*)', 1) AS u FROM pages) t")
def _(spark, sf):
    made = F.concat(F.lit("https://github.com/"), F.regexp_extract("url", "://[^/]+/([^?#]*)", 1))
    return table(spark, sf, "pages").select("page_id", is_repo_root(made).alias("repo"))


@query("f6_first_message", f"SELECT conv_id, substr(arg_min(text, turn), 1, 500) AS message FROM conversations WHERE role = 'user' AND NOT regexp_matches(text, '{NOISE}') GROUP BY 1")
def _(spark, sf):
    return W.first_messages(table(spark, sf, "conversations"), NOISE)


@query("j1_unseen", "SELECT seq FROM v_batch WHERE id NOT IN (SELECT id FROM v_store)", ITEMS_SQL)
def _(spark, sf):
    return D.unseen(v_batch(spark, sf), v_store(spark, sf)).select("seq")


@query("j2_first_per_id", "SELECT id, min(seq) AS seq FROM v_items GROUP BY 1", ITEMS_SQL)
def _(spark, sf):
    return D.first_per_id(v_items(spark, sf)).select("id", "seq")


@query("j3_oldest_stored", "SELECT title_hash, min(seq) AS seq, arg_min(id, seq) AS id FROM v_items GROUP BY 1", ITEMS_SQL)
def _(spark, sf):
    return D.oldest_stored(v_items(spark, sf)).select("title_hash", "stored.seq", "stored.id")


@query("j5_source_config", "SELECT seq, CASE WHEN source IN ('x', 'hn') THEN 1 ELSE 2 END AS tier FROM v_items", ITEMS_SQL)
def _(spark, sf):
    config = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(1).alias("tier")) for s in ("x", "hn")])))
    return v_items(spark, sf).select("seq", "source").join(F.broadcast(config), "source", "left").select("seq", F.coalesce("tier", F.lit(2)).alias("tier"))


_LATEST = "latest AS (SELECT * FROM v_runs QUALIFY row_number() OVER (PARTITION BY source ORDER BY id DESC) = 1), lastok AS (SELECT source, max(started_at) FILTER (WHERE status = 'ok') AS last_ok_at FROM v_runs GROUP BY 1), issues AS (SELECT l.source, l.error AS last_error, l.error_class AS last_error_class, l.attempts AS last_attempts, l.started_at AS last_failed_at, k.last_ok_at, (SELECT count(*) FROM v_runs r WHERE r.source = l.source AND r.status <> 'ok' AND (k.last_ok_at IS NULL OR r.started_at > k.last_ok_at)) AS consecutive FROM latest l JOIN lastok k USING (source) WHERE l.status <> 'ok')"
_ISSUES = f"{RUNS_SQL}, {_LATEST}"


@query("j6_retry_targets", "SELECT source FROM latest WHERE status <> 'ok' AND CAST(substr(source, 5) AS INT) % 3 <> 0", _ISSUES)
def _(spark, sf):
    runs = v_runs(spark, sf)
    enabled = runs.select("source").distinct().where("cast(substr(source, 5) as int) % 3 <> 0")
    return R.latest_failed(runs).join(enabled, "source", "left_semi").select("source")


def _with_hints(spark: SparkSession, issues: DataFrame) -> DataFrame:
    own = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(a).alias("source"), F.lit(b).alias("hint")) for a, b in ISSUE_HINTS])))
    kind = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(a).alias("last_error_class"), F.lit(b).alias("hint")) for a, b in CLASS_HINTS])))
    return R.with_hints(issues, F.broadcast(own), F.broadcast(kind))


@query("j7_hints", "SELECT source, CASE WHEN source = 'src_1' THEN 'renew the key' WHEN source = 'src_2' THEN 'site moved' WHEN last_error_class = 'user_action_required' THEN 'log in again' WHEN last_error_class = 'transient' THEN 'wait' ELSE '' END AS hint FROM issues", _ISSUES)
def _(spark, sf):
    return _with_hints(spark, R.known_issues(v_runs(spark, sf))).select("source", "hint")


@query("n13_comments", rf"SELECT s.story, COALESCE(string_agg(c.author || ': ' || c.t, ' / ' ORDER BY c.pos), '') AS comments FROM (SELECT DISTINCT conv_id AS story FROM conversations) s LEFT JOIN (SELECT conv_id, turn AS pos, role AS author, CASE WHEN length(t) > 300 THEN substr(t, 1, 300) || '…' ELSE t END AS t FROM (SELECT *, {_WS.format("regexp_replace(text, '<[^>]+>', '', 'g')")} AS t FROM conversations) q WHERE turn < 5 AND role <> 'system' AND t <> '') c ON c.conv_id = s.story GROUP BY 1")
def _(spark, sf):
    rows = v_comments(spark, sf)
    return W.with_comments(rows.select("story").distinct(), rows).select("story", F.array_join(F.transform("comments", lambda c: F.concat(c["author"], F.lit(": "), c["text"])), " / ").alias("comments"))


_RULES = "(VALUES ('research', '(?i)the', 'tion'), ('numbers', '[0-9]', '[0-9]{3}'), ('french', '(?i) le | la ', 'eau')) r(rule, scope, words)"


@query("j9_watch_hits", f"SELECT seq, rule FROM v_items, {_RULES} WHERE regexp_matches(text, scope) AND regexp_matches(text, words)", ITEMS_SQL)
def _(spark, sf):
    return W.hits(v_items(spark, sf), WATCH, F.col("text")).select("seq", "rule")


#: A list of rules by rule: three letters and a t, with two of them anywhere.
MANY_RULES = [(f"r{a}{b}{c}", f"(?i){b}{c}", f"{a}{b}{c}t[a-z]*") for a in "abcdefghij" for b in "aeiou" for c in "dhlnrst"]


@query("j9_many_rules", "SELECT seq, rule FROM v_items JOIN (SELECT 'r' || a || b || c AS rule, '(?i)' || b || c AS scope, a || b || c || 't[a-z]*' AS words FROM (SELECT unnest(string_split('abcdefghij', '')) AS a), (SELECT unnest(string_split('aeiou', '')) AS b), (SELECT unnest(string_split('dhlnrst', '')) AS c)) r ON regexp_matches(text, scope) AND regexp_matches(text, words)", ITEMS_SQL)
def _(spark, sf):
    """350 rules in one pass, by the texts they require."""
    return W.hits(v_items(spark, sf), MANY_RULES, F.col("text")).select("seq", "rule")


@query("j9_watch_context", "SELECT conv_id, turn FROM (SELECT *, max(CASE WHEN contains(text, 'tion') AND turn % 4 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 5 PRECEDING AND 2 FOLLOWING) AS near FROM conversations) t WHERE near = 1")
def _(spark, sf):
    return W.context(table(spark, sf, "conversations"), ["conv_id"], "turn", F.contains("text", F.lit("tion")) & (F.col("turn") % 4 == 0)).select("conv_id", "turn")


@query("j11_new_since", "SELECT event_id FROM events WHERE user_id % 2 = 1 OR ts > TIMESTAMP '2024-01-20 00:00:00'")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    baseline = events.select("user_id").distinct().where("user_id % 2 = 0").withColumn("last_seen", F.lit("2024-01-20").cast("timestamp_ntz"))
    return W.new_since(events, baseline, "user_id", "ts").select("event_id")


_WIN = """firsts AS (SELECT * FROM fresh QUALIFY row_number() OVER (PARTITION BY title_hash ORDER BY seq) = 1),
better AS (SELECT f.* FROM fresh f JOIN firsts k USING (title_hash) WHERE f.source_tier < k.source_tier AND f.id <> k.id QUALIFY row_number() OVER (PARTITION BY title_hash ORDER BY f.source_tier, f.seq) = 1),
winners AS (SELECT k.title_hash, COALESCE(b.seq, k.seq) AS seq, COALESCE(b.id, k.id) AS id, k.seq AS first_seq, k.id AS first_id FROM firsts k LEFT JOIN better b USING (title_hash))"""
_A1 = f"{ITEMS_SQL}, fresh AS (SELECT * FROM v_items), {_WIN}"
_OLD = "old AS (SELECT * FROM v_store QUALIFY row_number() OVER (PARTITION BY title_hash ORDER BY seq) = 1), unseen AS (SELECT * FROM v_batch WHERE id NOT IN (SELECT id FROM v_store))"
_A4 = f"{ITEMS_SQL}, {_OLD}, fresh AS (SELECT * FROM unseen WHERE title_hash NOT IN (SELECT title_hash FROM old)), {_WIN}"
_STORED = "won AS (SELECT u.*, o.source AS os, o.source_handle AS oh, o.url AS ou FROM unseen u JOIN old o USING (title_hash) WHERE u.source_tier < o.source_tier), lost AS (SELECT u.*, o.id AS oid FROM unseen u JOIN old o USING (title_hash) WHERE u.source_tier >= o.source_tier)"


@query("a1_l2_winner", "SELECT title_hash, seq, first_seq FROM winners", _A1)
def _(spark, sf):
    return D.title_winners(v_items(spark, sf)).select("title_hash", "winner.seq", F.col("first.seq").alias("first_seq"))


@query("a2_sightings_reference", "SELECT w.id AS winner_id, f.seq FROM fresh f JOIN winners w USING (title_hash) WHERE f.id <> w.id AND ((f.seq = w.first_seq AND w.seq <> w.first_seq) OR (f.seq > w.seq AND f.id <> w.first_id))", _A1)
def _(spark, sf):
    items = v_items(spark, sf)
    return D.batch_sightings(items, D.title_winners(items), lossless=False).select("winner_id", "seq")


@query("a3_sightings", "SELECT w.id AS winner_id, f.seq FROM fresh f JOIN winners w USING (title_hash) WHERE f.id <> w.id", _A1)
def _(spark, sf):
    items = v_items(spark, sf)
    return D.batch_sightings(items, D.title_winners(items)).select("winner_id", "seq")


@query("a4_new_items", f"SELECT id, min(seq) AS seq FROM (SELECT id, seq FROM winners UNION ALL SELECT id, seq FROM won) t GROUP BY 1", f"{_A4}, {_STORED}")
def _(spark, sf):
    return D.dedup(v_batch(spark, sf), v_store(spark, sf))[0].select("id", "seq")


@query("a4_sightings", "SELECT winner_id, source, source_handle, url, min(seq) AS seq FROM (SELECT id AS winner_id, seq, os AS source, oh AS source_handle, ou AS url FROM won UNION ALL SELECT oid, seq, source, source_handle, url FROM lost UNION ALL SELECT w.id, f.seq, f.source, f.source_handle, f.url FROM fresh f JOIN winners w USING (title_hash) WHERE f.id <> w.id) t GROUP BY 1, 2, 3, 4", f"{_A4}, {_STORED}")
def _(spark, sf):
    return D.dedup(v_batch(spark, sf), v_store(spark, sf))[1]


@query("a4_exact_new_items", ORACLE["a4_new_items"])
def _(spark, sf):
    return D.dedup(v_batch(spark, sf), v_store(spark, sf), exact=True)[0].select("id", "seq")


@query("a4_exact_sightings", ORACLE["a4_sightings"])
def _(spark, sf):
    return D.dedup(v_batch(spark, sf), v_store(spark, sf), exact=True)[1]


_MERGED = "RECURSIVE " + landing.MERGE_SQL.format(first=landing.delivery_sql(_EARLIER), whole=landing.delivery_sql("TRUE"))


def _two_deliveries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """What is new in a delivery of all stories, after those in English were stored, and what it notes."""
    docs, columns = landing.documents(spark, sf), ["id", "title_hash", "source_tier", *D.SIGHTING]
    earlier = landing.delivery(spark, docs.where(_EARLIER), columns)
    stored = D.dedup(earlier, earlier.limit(0))[0]
    return D.dedup(landing.delivery(spark, docs, columns), stored)


@query("a4_stories_in_order", "SELECT w.seq, w.id, w.title_hash, w.source FROM whole w JOIN kept USING (seq)", _MERGED)
def _(spark, sf):
    """Landed files through arrival and dedup, twice. Links come under several titles, so a rule that takes each title alone gives other rows."""
    return _two_deliveries(spark, sf)[0].select("seq", "id", "title_hash", "source")


@query("w3_displaced")
def _(spark, sf):
    return D.displaced_by(v_items(spark, sf)).select("seq", "best_seq", F.coalesce("displaces", F.lit(False)).alias("displaces"))


ORACLE["w3_displaced"] = f"WITH {ITEMS_SQL} SELECT i.seq, b.bseq AS best_seq, COALESCE(i.source_tier < b.btier, FALSE) AS displaces FROM v_items i LEFT JOIN (SELECT x.seq, arg_min(y.seq, y.source_tier * 1000000000 + y.seq) AS bseq, min(y.source_tier) AS btier FROM v_items x JOIN v_items y ON x.title_hash = y.title_hash AND y.seq < x.seq GROUP BY 1) b ON i.seq = b.seq"


@query("a5_latest_failed", "SELECT source, id, error_class FROM latest WHERE status <> 'ok'", _ISSUES)
def _(spark, sf):
    return R.latest_failed(v_runs(spark, sf)).select("source", "id", "error_class")


@query("a7_known_issues", "SELECT * FROM issues", _ISSUES)
def _(spark, sf):
    return R.known_issues(v_runs(spark, sf))


@query("j4_w4_streak", "SELECT k.source, count(r.id) AS streak FROM lastok k LEFT JOIN v_runs r ON r.source = k.source AND r.status <> 'ok' AND (k.last_ok_at IS NULL OR r.started_at > k.last_ok_at) GROUP BY 1", _ISSUES)
def _(spark, sf):
    return R.streaks(v_runs(spark, sf))


@query("w4_streak_history", "SELECT source, island, count(*) AS failures FROM (SELECT *, sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY started_at, id) AS island FROM v_runs) t WHERE status <> 'ok' GROUP BY 1, 2", RUNS_SQL)
def _(spark, sf):
    return R.streak_history(v_runs(spark, sf))


@query("a8_health", "SELECT source, count(*) AS runs, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status <> 'ok') AS fail, round(100.0 * count(*) FILTER (WHERE status = 'ok') / count(*), 1) AS rate, substr(COALESCE(arg_max(error, started_at) FILTER (WHERE status <> 'ok'), ''), 1, 60) AS last_error FROM v_runs WHERE started_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY GROUP BY 1", RUNS_SQL)
def _(spark, sf):
    return R.health(v_runs(spark, sf), AS_OF)


@query("a9_summary", "SELECT (SELECT count(*) FROM v_items) AS items, (SELECT count(*) FROM (SELECT DISTINCT source, source_handle FROM v_items)) AS sources_active, (SELECT count(*) FROM latest WHERE status <> 'ok') AS failed", f"{ITEMS_SQL}, {_ISSUES}")
def _(spark, sf):
    return G.summary(v_items(spark, sf), R.latest_failed(v_runs(spark, sf)))


@query("a9_sketched_sources", "SELECT CAST(count(*) AS BIGINT) AS items, count(DISTINCT source || ' ' || source_handle) AS sources_active FROM v_items WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'", ITEMS_SQL)
def _(spark, sf):
    """Days' sketches, written and merged over a range. The table's pairs are few, so that the estimate is exact."""
    path = scratch(spark)
    G.source_sketches(v_items(spark, sf)).write.parquet(path)
    return G.sources_in(spark.read.parquet(path), "2024-01-01", "2024-01-31")


@query("a10_section_counts", "SELECT section, count(*) AS items FROM v_items GROUP BY ROLLUP (section)", ITEMS_SQL)
def _(spark, sf):
    return G.section_counts(v_items(spark, sf))


@query("a11_statistics", "SELECT 'section' AS kind, section AS key, count(*) AS items FROM v_items GROUP BY 2 UNION ALL SELECT 'hour', CAST(hour(posted_at) AS VARCHAR), count(*) FROM v_items GROUP BY 2 UNION ALL SELECT 'language', language, count(*) FROM v_items GROUP BY 2 UNION ALL SELECT 'all', 'all', count(*) FROM v_items", ITEMS_SQL)
def _(spark, sf):
    return G.statistics(v_items(spark, sf))


@query("a12_engagement", "SELECT seq, total FROM v_items", ITEMS_SQL)
def _(spark, sf):
    return G.placed(v_items(spark, sf)).select("seq", "total")


@query("a13_top_authors", "SELECT source_handle, source, CAST(sum(likes) AS BIGINT) AS likes, count(*) AS posts FROM v_items GROUP BY 1, 2 ORDER BY likes DESC, 1, 2 LIMIT 12", ITEMS_SQL)
def _(spark, sf):
    return G.top_authors(v_items(spark, sf))


@query("a14_themes", f"SELECT COALESCE(rule, 'other') AS theme, count(*) AS items FROM v_items v LEFT JOIN {_RULES} ON regexp_matches(text, scope) AND regexp_matches(text, words) GROUP BY 1", ITEMS_SQL)
def _(spark, sf):
    return W.themes(v_items(spark, sf), WATCH, F.col("text"))


@query("a15_run_totals", "SELECT CAST(started_at AS DATE) AS day, count(*) AS runs, CAST(sum(items_fetched) AS BIGINT) AS items, count(*) FILTER (WHERE status <> 'ok') AS failures FROM v_runs GROUP BY 1", RUNS_SQL)
def _(spark, sf):
    return v_runs(spark, sf).groupBy(F.to_date("started_at").alias("day")).agg(F.count(F.lit(1)).alias("runs"), F.sum("items_fetched").alias("items"), F.count_if(F.col("status") != "ok").alias("failures"))


@query("w1_section_rank", "SELECT day, section, id, seq, rank FROM (SELECT *, row_number() OVER (PARTITION BY day, section ORDER BY source_tier, total DESC, posted_at DESC, id) AS rank FROM (SELECT * FROM v_items QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1) u) t WHERE rank <= 10", ITEMS_SQL)
def _(spark, sf):
    return G.ranked(D.first_per_id(v_items(spark, sf)), 10).select("day", "section", "id", "seq", "rank")


@query("digest_flagship", "SELECT day, section, id, rank FROM (SELECT *, row_number() OVER (PARTITION BY day, section ORDER BY source_tier, total DESC, posted_at DESC, id) AS rank FROM (SELECT v.* FROM v_items v JOIN winners w ON v.seq = w.seq QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY v.seq) = 1) u) t WHERE rank <= 10", _A1)
def _(spark, sf):
    return G.ranked(D.winners_in_order(v_items(spark, sf)), 10).select("day", "section", "id", "rank")


@query("w2_top_per_source", "SELECT source_handle, seq, n FROM (SELECT *, row_number() OVER (PARTITION BY source_handle ORDER BY posted_at DESC, seq) AS n FROM v_items) t WHERE n <= 5", ITEMS_SQL)
def _(spark, sf):
    return G.top_per(v_items(spark, sf), ["source_handle"], [F.desc("posted_at"), F.col("seq")], 5).select("source_handle", "seq", "n")


@query("w5_top_posts", "SELECT seq, total FROM v_items WHERE source = 'hn' ORDER BY total DESC, id LIMIT 10", ITEMS_SQL)
def _(spark, sf):
    return G.top_posts(v_items(spark, sf), "hn").select("seq", "total")


@query("o1_day_listing", "SELECT seq, posted_at FROM v_items WHERE day = DATE '2024-01-01' ORDER BY posted_at DESC", ITEMS_SQL)
def _(spark, sf):
    return v_items(spark, sf).where(T.in_business_day(F.col("fetched_at"), "2024-01-01")).orderBy(F.desc("posted_at"), "id").select("seq", "posted_at")


@query("o2_run_log", "SELECT id, source, started_at FROM v_runs WHERE started_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 3 DAY ORDER BY started_at DESC", RUNS_SQL)
def _(spark, sf):
    return v_runs(spark, sf).where(T.within(F.col("started_at"), AS_OF, 72)).orderBy(F.desc("started_at"), F.desc("id")).select("id", "source", "started_at")


@query("u1_union_seq", f"SELECT item, CAST(count(*) AS INT) AS copies, min(seq) AS first, max(seq) AS last FROM (SELECT item, row_number() OVER (ORDER BY part, item) - 1 AS seq FROM (SELECT seq AS item, 0 AS part FROM v_items WHERE {STORED} UNION ALL SELECT seq, 1 FROM v_items) p) n GROUP BY 1", ITEMS_SQL)
def _(spark, sf):
    parts = [df.select(F.col("seq").alias("pos"), F.col("seq").alias("item")) for df in (v_store(spark, sf), v_batch(spark, sf))]
    return normalize.arrival(parts).groupBy("item").agg(F.count(F.lit(1)).cast("int").alias("copies"), F.min("seq").alias("first"), F.max("seq").alias("last"))


@query("u1_arrival", f"SELECT seq, id, title_hash, tier, source FROM ({landing.delivery_sql('TRUE')}) d")
def _(spark, sf):
    """Several files of two sources, landed, normalized and numbered."""
    items = landing.delivery(spark, landing.documents(spark, sf), ["id", "title_hash", "source_tier", "source"])
    return items.select("seq", "id", "title_hash", F.col("source_tier").alias("tier"), "source")


@query("u2_distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    return table(spark, sf, "events").dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")


@query("u3_id_sets", "SELECT 'both' AS kind, count(*) AS n FROM (SELECT id FROM v_batch INTERSECT SELECT id FROM v_store) a UNION ALL SELECT 'new', count(*) FROM (SELECT id FROM v_batch EXCEPT SELECT id FROM v_store) b", ITEMS_SQL)
def _(spark, sf):
    new, old = v_batch(spark, sf).select("id"), v_store(spark, sf).select("id")
    count = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    return count(new.intersect(old), "both").union(count(new.subtract(old), "new"))


@query("c1_error_class", "SELECT id, error_class FROM v_runs WHERE status <> 'ok'", RUNS_SQL)
def _(spark, sf):
    return v_runs(spark, sf).where("status <> 'ok'").select("id", "error_class")


ERROR_NAMES = ["ReadTimeout", "ConnectTimeout", "WriteTimeout", "PoolTimeout", "ReadError", "ConnectError", "WriteError", "RemoteProtocolError", "NetworkError", "CloseError", "TimeoutException", "DecodingError", "ValueError", "unknown source type"]


@query("c1_error_names", f"SELECT event_id AS id, CASE WHEN event_id % {len(ERROR_NAMES)} < 10 THEN 'transient' ELSE 'persistent_error' END AS error_class FROM events")
def _(spark, sf):
    name = F.element_at(F.array(*map(F.lit, ERROR_NAMES)), (F.col("event_id") % len(ERROR_NAMES) + 1).cast("int"))
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), R.error_class(F.concat(name, F.lit(": no answer from 500 lines"))).alias("error_class"))


@query("c2_section", "SELECT seq, section FROM v_items", ITEMS_SQL)
def _(spark, sf):
    return G.placed(v_items(spark, sf)).select("seq", "section")


@query("c3_printed_sections", "SELECT section, count(*) AS items FROM v_items WHERE section IN (" + ", ".join(f"'{k}'" for k, _ in G.SECTIONS) + ") GROUP BY 1", ITEMS_SQL)
def _(spark, sf):
    return G.placed(v_items(spark, sf)).join(F.broadcast(G.sections(spark)), "section").groupBy("section").agg(F.count(F.lit(1)).alias("items"))


@query("c4_issue_bucket", "SELECT source, CASE WHEN consecutive >= 7 THEN 'stable' WHEN last_error_class = 'user_action_required' THEN 'user_action' WHEN last_error_class = 'persistent_error' THEN 'persistent' ELSE 'transient' END AS bucket FROM issues", _ISSUES)
def _(spark, sf):
    return R.known_issues(v_runs(spark, sf)).select("source", R.issue_bucket(F.col("consecutive"), F.col("last_error_class")).alias("bucket"))


@query("c5_attempts", "SELECT id AS run_id, attempts, error_class, TRUE AS within_limit FROM v_runs WHERE status <> 'ok'", RUNS_SQL)
def _(spark, sf):
    tries = v_runs(spark, sf).where("status <> 'ok'").select(F.col("id").alias("run_id"), F.explode(F.sequence(F.lit(1), F.col("attempts"))).alias("attempt"), "error_class")
    return R.attempts_summary(tries)


_KEPT = "kept AS (SELECT id, coalesce(min(seq) FILTER (WHERE stored), min(seq)) AS seq FROM (SELECT *, TRUE AS stored FROM v_store UNION ALL SELECT *, FALSE FROM v_batch) b GROUP BY 1)"


@query("io5_append_new", "SELECT v.day AS fetch_day, v.id, v.seq FROM v_items v JOIN kept k ON v.id = k.id AND v.seq = k.seq", f"{ITEMS_SQL}, {_KEPT}")
def _(spark, sf):
    path = scratch(spark)
    store.append_items(v_store(spark, sf), None, path)
    store.append_items(v_batch(spark, sf), store.read_items(spark, path), path)
    return store.read_items(spark, path).select("fetch_day", "id", "seq")


@query("io1_landed_json", "SELECT CAST(doc_id AS VARCHAR) AS \"objectID\", text AS title, CASE WHEN n_chars % 2 = 0 THEN 'https://e.test/' || source || '/' || doc_id END AS url, n_chars AS points FROM documents")
def _(spark, sf):
    return landing.payloads(spark, sf, "hn").select("objectID", "title", "url", "points")


@query("io2_feed", "SELECT source || ' ' || doc_id AS title, 'https://e.test/' || source || '/' || doc_id AS link, source AS feed, CASE WHEN lang = 'fr' THEN source END AS summary FROM documents")
def _(spark, sf):
    return landing.entries(spark, sf).select(F.trim("title").alias("title"), "link", "feed", "summary")


_REPOS = r"SELECT doc_id AS page_id, source || '/' || doc_id AS slug, regexp_replace(text, '^\s+|\s+$', '', 'g') AS description, CASE WHEN lang = 'fr' THEN format('{:,}', n_chars) ELSE n_chars || 'k' END AS stars FROM documents"


@query("io3_u4_repo_pages", _REPOS)
def _(spark, sf):
    return html.repo_lists(landing.pages(spark, sf, "list")).select("page_id", "slug", "description", "stars")


@query("u5_streamed_pages", "SELECT doc_id AS page_id, CAST(doc_id AS INT) AS rank, n_chars + 0.5::DOUBLE AS score, source || '/' || doc_id AS full_name, text AS description FROM documents")
def _(spark, sf):
    return html.ranked_repos(landing.pages(spark, sf, "chunks")).drop("pos")


def _as_sql(spark: SparkSession, pages: DataFrame, query: str) -> DataFrame:
    html.register(spark)
    return spark.sql(query, pages=pages)


@query("u4_repo_list_sql", _REPOS)
def _(spark, sf):
    return _as_sql(spark, landing.pages(spark, sf, "list"), "SELECT p.page_id, r.slug, r.description, r.stars FROM {pages} p, LATERAL repo_list(p.html) r")


@query("u5_ranked_records_sql", ORACLE["u5_streamed_pages"])
def _(spark, sf):
    return _as_sql(spark, landing.pages(spark, sf, "chunks"), "SELECT p.page_id, r.rank, r.score, r.full_name, r.description FROM {pages} p, LATERAL ranked_records(p.html) r WHERE r.reason IS NULL")


@query(
    "u5_damaged_records",
    """SELECT doc_id AS page_id, doc_id AS rank, CAST(NULL AS VARCHAR) AS reason FROM documents
UNION ALL SELECT doc_id, NULL, CASE lang WHEN 'de' THEN 'rank or score is no number' WHEN 'en' THEN 'rank or score is out of range' WHEN 'es' THEN 'full_name is no text' ELSE 'unbalanced, or more than 64 levels deep' END FROM documents""",
)
def _(spark, sf):
    bad = """CASE lang WHEN 'de' THEN '{"rank": Infinity, "score": 1, "full_name": "a/b"}' WHEN 'en' THEN '{"rank": 99999999999999999999, "score": 1, "full_name": "a/b"}'
      WHEN 'es' THEN '{"rank": 1, "score": 1, "full_name": ["a/b"]}' ELSE concat('{"full_name": "a/b", "x": ', repeat('[', 5000)) END"""
    good = """concat('{"rank": ', doc_id, ', "score": 1.5, "full_name": "o/r"} ')"""
    quoted = "replace({}, '\"', '\\\\\"')"
    made = landing.documents(spark, sf).selectExpr("doc_id AS page_id", f"""concat('<script>self.__next_f.push([1,"', {quoted.format(f"concat({good}, {bad})")}, '"])</script>') AS html""")
    found = html.ranked_repos(made).select("page_id", "rank", F.lit(None).cast("string").alias("reason"))
    return found.union(html.damaged_records(made).select("page_id", F.lit(None).cast("long"), "reason"))


@query("io4_source_config", "SELECT source AS id, min(lang) AS type, min(n_chars) % 2 = 0 AS enabled, CASE WHEN min(n_chars) % 3 = 0 THEN 1 ELSE 2 END AS tier, CASE WHEN min(lang) = max(lang) THEN min(lang) ELSE 'en' END AS language FROM documents GROUP BY 1")
def _(spark, sf):
    rows = table(spark, sf, "documents").groupBy(F.col("source").alias("id")).agg(F.min("lang").alias("type"), F.min("n_chars").alias("n"), F.max("lang").alias("last"))
    landed = rows.select("id", "type", F.when(F.col("n") % 2 != 0, F.lit(False)).alias("enabled"), F.when(F.col("n") % 3 == 0, F.lit(1)).alias("tier"), F.when(F.col("type") == F.col("last"), F.col("type")).alias("language"), F.create_map(F.lit("n"), F.col("n").cast("string")).alias("params"))
    return store.with_config_defaults(landed).drop("params")


@query("io6_append_runs", "SELECT CAST(started_at AS DATE) AS run_day, source, count(*) AS runs FROM v_runs GROUP BY 1, 2", RUNS_SQL)
def _(spark, sf):
    path = scratch(spark)
    for part in ("status = 'ok'", "status <> 'ok'"):  # two appends
        store.append_runs(v_runs(spark, sf).where(part), path)
    return spark.read.parquet(path).groupBy("run_day", "source").agg(F.count(F.lit(1)).alias("runs"))


@query("io7_io8_read_back", "SELECT seq, CASE WHEN lang0 = 'fr' THEN '' ELSE author END AS author, CASE WHEN lang0 = 'de' THEN 2 ELSE source_tier END AS source_tier, CASE WHEN lang0 = 'de' THEN '{}' ELSE '{\"likes\":' || likes || ',\"comments\":' || comments || '}' END AS engagement, CASE WHEN lang0 = 'es' THEN 1 ELSE 0 END AS comments FROM v_items JOIN (SELECT doc_id, lang AS lang0 FROM documents) d ON seq = doc_id", ITEMS_SQL)
def _(spark, sf):
    path, lang = scratch(spark), table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("lang").alias("lang0"))
    rows = v_items(spark, sf).drop("comments").join(lang, "seq").withColumn("author", F.when(F.col("lang0") != "fr", F.col("author"))).withColumn("source_tier", F.when(F.col("lang0") != "de", F.col("source_tier")))
    rows = store.with_json(rows).withColumn("engagement_json", F.when(F.col("lang0") != "de", F.col("engagement_json"))).drop("engagement")
    said = F.to_json(F.array(F.struct(F.col("author"), F.lit("t").alias("text"))))
    rows.where("lang0 <> 'es'").write.mode("append").parquet(path)  # from before the comments column was added
    rows.where("lang0 = 'es'").withColumn("comments_json", said).write.mode("append").parquet(path)
    return store.read_items(spark, path).select("seq", "author", "source_tier", F.to_json("engagement").alias("engagement"), F.size("comments").alias("comments"))


@query("io10_engagement_json", "SELECT seq, '{\"likes\":' || likes || ',\"comments\":' || comments || '}' AS engagement_json FROM v_items", ITEMS_SQL)
def _(spark, sf):
    return v_items(spark, sf).select("seq", F.to_json("engagement").alias("engagement_json"))


_META = "'`' || source || ':' || source_handle || '` · T' || source_tier || ' · ' || strftime(posted_at, '%Y-%m-%d %H:%M UTC') || ' · ' || language || CASE WHEN author <> source_handle THEN ' · by ' || author ELSE '' END || CASE WHEN likes > 0 THEN ' · ♥ ' || likes ELSE '' END || CASE WHEN comments > 0 THEN ' · 💬 ' || comments ELSE '' END"
_BODY = "'### [' || title || '](' || url || ')' || chr(10) || chr(10) || " + _META + " || chr(10) || chr(10) || CASE WHEN excerpt <> '' THEN '> ' || regexp_replace(replace(excerpt, chr(10), ' '), '^\\s+|\\s+$', '', 'g') || chr(10) || chr(10) ELSE '' END"
_END = "'---' || chr(10)"


@query("r1_render_item", f"SELECT seq, {_BODY} || {_END} AS body FROM v_items", ITEMS_SQL)
def _(spark, sf):
    rows = v_items(spark, sf).drop("comments")
    return rows.select("seq", render.item(rows.columns).alias("body"))


@query(
    "r1_render_full",
    f"""SELECT i.seq, {_BODY} || CASE WHEN c.said IS NOT NULL THEN '> 💬 Top comments:' || chr(10) || c.said || chr(10) || chr(10) ELSE '' END
 || CASE WHEN w.seen IS NOT NULL THEN '_also seen at: ' || w.seen || '_' || chr(10) || chr(10) ELSE '' END || {_END} AS body FROM v_items i
LEFT JOIN (SELECT conv_id, string_agg('> - **@' || role || '**: ' || t, chr(10) ORDER BY turn) AS said FROM (SELECT conv_id, role, turn, CASE WHEN length(t) > 300 THEN substr(t, 1, 300) || '…' ELSE t END AS t
  FROM (SELECT *, {_WS.format("regexp_replace(text, '<[^>]+>', '', 'g')")} AS t FROM conversations) p WHERE turn < 5 AND role <> 'system' AND t <> '') q GROUP BY 1) c ON c.conv_id = i.seq
LEFT JOIN (SELECT id, string_agg(source || ':' || source_handle, '; ' ORDER BY seq) AS seen FROM (SELECT w.id, f.seq, f.source, f.source_handle
  FROM fresh f JOIN winners w USING (title_hash) WHERE f.id <> w.id) t GROUP BY 1) w ON w.id = i.id""",
    _A1,
)
def _(spark, sf):
    items = v_items(spark, sf).drop("comments").withColumnRenamed("seq", "story")
    full = W.with_comments(items, v_comments(spark, sf)).withColumnRenamed("story", "seq")
    plain = v_items(spark, sf)
    full = D.with_sightings(full, D.batch_sightings(plain, D.title_winners(plain)))
    return full.select("seq", render.item(full.columns).alias("body"))


GENERATED = "2024-01-31T08:00:00+08:00"
_LABELS = ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(G.SECTIONS))
_DAY = f"""unique_items AS (SELECT * FROM v_items QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1),
bad AS (SELECT CAST(started_at + INTERVAL 8 HOUR AS DATE) AS day, source, error, status FROM v_runs QUALIFY row_number() OVER (PARTITION BY CAST(started_at + INTERVAL 8 HOUR AS DATE), source ORDER BY id DESC) = 1),
failures AS (SELECT day, source, error FROM bad WHERE status <> 'ok'),
days AS (SELECT day, count(*) AS n, count(DISTINCT source || ' ' || source_handle) AS sources FROM unique_items GROUP BY 1),
heads AS (SELECT d.day, n, sources, (SELECT count(*) FROM failures f WHERE f.day = d.day) AS failed FROM days d),
names(section_order, section, label) AS (VALUES {_LABELS})"""
_DAY_SQL = f"""SELECT day, -3 AS section_order, '# AI Daily Digest — ' || day || chr(10) || chr(10) || '> generated_at: {GENERATED} (Asia/Taipei)' || chr(10) || '> total_items: ' || n || '  |  sources_active: ' || sources || '  |  sources_failed: ' || failed || CASE WHEN failed > 0 THEN chr(10) || '> failures:' ELSE '' END AS line FROM heads
UNION ALL SELECT day, -2, '>   - ' || source || ': ' || error FROM failures WHERE day IN (SELECT day FROM days)
UNION ALL SELECT day, -1, chr(10) || '---' || chr(10) FROM days
UNION ALL SELECT day, section_order, '## ' || label || ' (' || count(*) || ' items)' || chr(10) FROM unique_items JOIN names USING (section) GROUP BY day, section_order, label
UNION ALL SELECT day, section_order, {_BODY} || {_END} FROM unique_items JOIN names USING (section)"""


def _day_report(spark: SparkSession, sf: str) -> DataFrame:
    runs = v_runs(spark, sf).withColumn("day", T.business_day(F.col("started_at")))
    last = runs.groupBy("day", "source").agg(F.max_by(F.struct("status", "error"), "id").alias("r"))
    failed = last.where("r.status <> 'ok'").select("day", "source", "r.error")
    return render.day(D.first_per_id(v_items(spark, sf).drop("comments")), G.sections(spark), failed, GENERATED)


@query("r2_render_day", _DAY_SQL, f"{ITEMS_SQL}, {RUNS_SQL}, {_DAY}")
def _(spark, sf):
    return _day_report(spark, sf).select("day", "section_order", "line")


@query("r2_order", "SELECT day, section, id, row_number() OVER (PARTITION BY day, section ORDER BY source_tier, total DESC, posted_at DESC, id) AS rank FROM unique_items", f"{ITEMS_SQL}, {RUNS_SQL}, {_DAY}")
def _(spark, sf):
    return G.ranked(D.first_per_id(v_items(spark, sf))).select("day", "section", "id", "rank")


@query("io9_day_report", f"SELECT day, CAST(sum(len(line) - len(replace(line, chr(10), '')) + 1) AS BIGINT) AS lines, CAST(sum(len(line) + 1) AS BIGINT) AS chars FROM ({_DAY_SQL}) t GROUP BY 1", f"{ITEMS_SQL}, {RUNS_SQL}, {_DAY}")
def _(spark, sf):
    path = scratch(spark)
    for _again in range(2):  # a rerun replaces the day
        store.write_report(_day_report(spark, sf), path)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.groupBy(F.col("day").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.char_length("value") + 1).alias("chars"))


_BUCKET = "CASE WHEN consecutive >= 7 THEN 2 WHEN last_error_class = 'user_action_required' THEN 0 WHEN last_error_class = 'persistent_error' THEN 1 ELSE 3 END"
_HINT = "CASE WHEN source = 'src_1' THEN 'renew the key' WHEN source = 'src_2' THEN 'site moved' WHEN last_error_class = 'user_action_required' THEN 'log in again' WHEN last_error_class = 'transient' THEN 'wait' ELSE '' END"
_TITLES = " ".join(f"WHEN {i} THEN '{v}'" for i, (_, v) in enumerate(render.BUCKETS))


@query(
    "r3_render_issues",
    f"""SELECT -1 AS section_order, '{render.ISSUES_HEAD.format("2024-01-31 08:00")}' || CASE WHEN (SELECT count(*) FROM issues) = 0 THEN chr(10) || '{render.NO_ISSUES}' ELSE '' END AS line
UNION ALL SELECT {_BUCKET}, '## ' || CASE {_BUCKET} {_TITLES} END || ' (' || count(*) || ')' || chr(10) FROM issues GROUP BY 1, {_BUCKET}
UNION ALL SELECT DISTINCT {_BUCKET}, '' FROM issues
UNION ALL SELECT {_BUCKET}, '- **' || source || '** (' || last_error_class || ') — ' || last_error || chr(10) || '  - last ok: ' || coalesce(strftime(last_ok_at + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M CST'), '（無紀錄）') || ' · consecutive fails: ' || consecutive || ' · last attempts: ' || last_attempts || chr(10) || '  - → ' || {_HINT} FROM issues""",
    _ISSUES,
)
def _(spark, sf):
    return render.issues(_with_hints(spark, R.known_issues(v_runs(spark, sf))), "2024-01-31 08:00").select("section_order", "line")


@query("j10_enrich_repos", "SELECT 'https://github.com/' || source || '/' || doc_id AS canonical_url, substr(text, 1, 1500) AS readme, CASE WHEN lang = 'en' THEN substr(upper(source), 1, 500) WHEN lang = 'fr' THEN substr(text, 1, 500) END AS positioning FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").withColumn("url", F.concat(F.lit("https://github.com/"), "source", F.lit("/"), F.col("doc_id").cast("string")))
    items = docs.select(F.col("url").alias("canonical_url")).union(docs.select(F.concat("url", F.lit("/issues"))))  # a page inside a repository is not its front page
    texts = docs.where("lang in ('en', 'fr')").select("url", F.lit("README.md").alias("name"), F.col("text").alias("body")).union(docs.where("lang = 'en'").select("url", F.lit("ABOUT.md"), F.upper("source")))
    return W.enrich_repos(items, docs.select("url", F.col("text").alias("readme"), F.col("n_chars").alias("stars")), texts, ["ABOUT.md", "README.md"]).select("canonical_url", "readme", "positioning")


@query("o3_preview", "SELECT seq, id FROM v_items ORDER BY seq LIMIT 20", ITEMS_SQL)
def _(spark, sf):
    return G.preview(v_items(spark, sf), 20).select("seq", "id")


@query("u1_nfkc", "SELECT doc_id, text FROM documents")
def _(spark, sf):
    wide = F.translate("text", "abcdefghij0123456789!?", "ａｂｃｄｅｆｇｈｉｊ０１２３４５６７８９！？")
    return table(spark, sf, "documents").select("doc_id", X.nfkc(wide).alias("text"))


@query("u2_html_unescape", "SELECT doc_id, text FROM documents")
def _(spark, sf):
    escaped = F.replace(F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&LT;")), F.lit("e"), F.lit("&#x65;")), F.lit("é"), F.lit("&eacute;"))
    return table(spark, sf, "documents").select("doc_id", X.html_unescape(escaped).alias("text"))


@query("u3_malformed_escapes", "SELECT page_id, 'https://e.test/' || page_id || '?a=1%252&b=%25zz%C3%A9+%2A&k=' AS canonical_url FROM pages")
def _(spark, sf):
    url = F.concat(F.lit("HTTPS://E.test/"), F.col("page_id").cast("string"), F.lit("//?k&b=%zzé+*&utm_x=%&a=1%2#f"))
    return table(spark, sf, "pages").select("page_id", canonical_url(url).alias("canonical_url"))


for _name, _run in landing.RUNS.items():
    query(_name, landing.SQL[_name])(_run)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")  # a pattern, as a stream's path may not be a file


def _run_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).selectExpr("event_id AS id", "concat('src_', user_id) AS source", "ts AS started_at", "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status")


def _item_stream(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.readStream.schema(table(spark, sf, "documents").schema).parquet(f"{sf}/document[s].parquet")
    return items_of(docs)


@query("st1_stream_ingest", "SELECT id, min(seq) AS seq FROM winners GROUP BY 1", _A1)
def _(spark, sf):
    at = scratch(spark)
    narrow = _item_stream(spark, sf).select("id", "title_hash", "source_tier", "seq", *D.SIGHTING)
    S.ingest(narrow, f"{at}/store", f"{at}/sightings", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/store").select("id", "seq")


@query("st2_stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    rows = _events(spark, sf).select("user_id", "event_type", F.concat_ws(" ", F.col("user_id").cast("string"), "event_type").alias("id"), F.col("ts").cast("timestamp").alias("fetched_at"))
    return S.run_to_table(spark, S.bounded_dedup(rows, days=40), mode="append").select("user_id", "event_type")


@query("st3_stream_day_counts", "SELECT CAST(ts + INTERVAL 8 HOUR AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    return S.run_to_table(spark, S.day_counts(_events(spark, sf), "ts", ["event_type"]), mode="update", finish=S.last_of(["day", "event_type"]))


@query("st4_stream_health")
def _(spark, sf):
    return S.run_to_table(spark, S.sliding_health(_run_stream(spark, sf)), mode="update", finish=S.last_of(["from_day", "source"]))


ORACLE["st4_stream_health"] = f"WITH {RUNS_SQL} SELECT CAST(started_at AS DATE) - CAST(d.range AS INT) AS from_day, source, count(*) AS runs, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status <> 'ok') AS fail FROM v_runs, range(7) d GROUP BY 1, 2"


@query("st5_stream_streaks", "SELECT k.source, count(r.id) AS streak FROM lastok k LEFT JOIN v_runs r ON r.source = k.source AND r.status <> 'ok' AND (k.last_ok_at IS NULL OR r.started_at > k.last_ok_at) GROUP BY 1", _ISSUES)
def _(spark, sf):
    at = scratch(spark)
    S.live_streaks(_run_stream(spark, sf), f"{at}/state", f"{at}/checkpoint").awaitTermination()
    return S.latest_state(spark, f"{at}/state").select("source", "streak")


@query("st6_late_items", "SELECT day, CAST(posted_at + INTERVAL 8 HOUR AS DATE) < day AS late, count(*) AS n FROM v_items GROUP BY 1, 2", ITEMS_SQL)
def _(spark, sf):
    rows = _item_stream(spark, sf).select("fetched_at", (T.business_day(F.col("posted_at")) < T.business_day(F.col("fetched_at"))).alias("late"))
    return S.run_to_table(spark, S.day_counts(rows, "fetched_at", ["late"]), mode="update", finish=S.last_of(["day", "late"]))
