from pathlib import Path

from pyspark.sql import functions as F

from feedjobs.sources import commits
from feedjobs.streaming import jobs

SCHEMA = "id string, title_hash string, source_tier int, seq long, source string, source_handle string, url string"


def item(i, title, tier, seq):
    return (i, title, tier, seq, "x", "h", f"u{seq}")


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_ingest_and_its_replay(spark, tmp_path):
    landed, store, noted, marks = (str(tmp_path / n) for n in ("landed", "store", "noted", "marks"))

    def run():
        items = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)
        jobs.ingest(items, store, noted, marks).awaitTermination()
        new, seen = (spark.read.parquet(p) for p in (store, noted))
        return sorted((r.seq, r.batch) for r in new.collect()), sorted((r.winner_id, r.url) for r in seen.collect())

    land(spark, landed, [item("a", "t1", 2, 0), item("b", "t1", 2, 1)])
    assert run() == ([(0, 0)], [("a", "u1")])
    land(spark, landed, [item("a", "t1", 1, 2), item("c", "t1", 2, 3), item("d", "t2", 2, 4)])
    want = [(0, 0), (4, 1)], [("a", "u1"), ("a", "u3")]
    assert run() == want
    for mark in Path(marks, "commits").glob("*1*"):  # as if lost between the batch's write and its commit
        mark.unlink()
    assert run() == want
    assert run() == want


def test_bounded_dedup(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2026-05-01 00:00:00"), ("a", "2026-05-02 00:00:00"), ("b", "2026-05-02 00:00:00")], "id string, ts string")
    rows.select("id", F.col("ts").cast("timestamp").alias("fetched_at")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, fetched_at timestamp").parquet(str(tmp_path / "in"))
    assert sorted(r.id for r in jobs.run_to_table(spark, jobs.bounded_dedup(stream), mode="append").collect()) == ["a", "b"]


def test_live_streaks_over_batches_and_a_replay(spark, tmp_path):
    landed, state, marks = (str(tmp_path / n) for n in ("landed", "state", "marks"))
    kind = "source string, id long, started_at timestamp_ntz, status string"

    def land(rows):
        made = spark.createDataFrame([(s, i, t, o) for s, i, t, o in rows], "source string, id long, t string, status string")
        made.select("source", "id", F.col("t").cast("timestamp_ntz").alias("started_at"), "status").coalesce(1).write.mode("append").parquet(landed)

    def run():
        jobs.live_streaks(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(landed), state, marks, alert=3).awaitTermination()
        return {r.source: (r.last_run, r.streak, r.alert) for r in jobs.latest_state(spark, state).collect()}

    land([("a", 1, "2026-05-01 01:00", "failed"), ("a", 2, "2026-05-01 02:00", "ok"), ("a", 3, "2026-05-01 03:00", "failed"), ("b", 4, "2026-05-01 01:00", "failed")])
    assert run() == {"a": (3, 1, False), "b": (4, 1, False)}
    land([("a", 5, "2026-05-01 04:00", "failed"), ("a", 6, "2026-05-01 05:00", None), ("a", 7, "2026-05-01 06:00", "failed"), ("c", 8, "2026-05-01 01:00", "ok")])
    want = {"a": (7, 3, True), "b": (4, 1, False), "c": (8, 0, False)}
    assert run() == want
    for mark in Path(marks, "commits").glob("*1*"):
        mark.unlink()
    assert run() == want
    land([("a", 9, "2026-05-01 07:00", "ok"), ("a", 10, "2026-05-01 06:30", "failed"), ("b", 11, "2026-05-01 02:00", "failed")])
    assert run() == {"a": (9, 0, False), "b": (11, 2, False), "c": (8, 0, False)}


def test_streaks_of_many_batches_are_merged_and_silent_sources_forgotten(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_EVERY", 3)
    landed, state, marks = (str(tmp_path / n) for n in ("landed", "state", "marks"))
    for n in range(7):
        rows = [("busy", 10 * n + i, f"2026-05-01 {n:02d}:{i:02d}:00", "ok" if (n, i) == (4, 3) else "failed") for i in range(5)] + ([("once", 999, "2026-05-01 00:00:00", "failed")] if n == 0 else [])
        spark.createDataFrame(rows, "source string, id long, t string, status string").select("source", "id", F.col("t").cast("timestamp_ntz").alias("started_at"), "status").coalesce(1).write.mode("append").parquet(landed)
    stream = lambda: spark.readStream.schema("source string, id long, started_at timestamp_ntz, status string").option("maxFilesPerTrigger", 1).parquet(landed)
    jobs.live_streaks(stream(), state, marks).awaitTermination()
    assert {r.source: (r.last_run, r.streak, r.alert) for r in jobs.latest_state(spark, state).collect()} == {"busy": (64, 11, True), "once": (999, 1, False)}
    assert len(commits.manifest(spark, state)["folders"]) <= 3  # all but the last batch in one
    jobs.live_streaks(stream(), str(tmp_path / "s2"), str(tmp_path / "m2"), quiet=0).awaitTermination()
    assert jobs.latest_state(spark, str(tmp_path / "s2")).where("source = 'once'").count() == 0


def test_day_counts_and_health_in_update_mode(spark, tmp_path):
    rows = [("a", f"2026-05-0{d} {h}:00:00", "ok" if h == "01" else "failed") for d in range(1, 4) for h in ("01", "15", "16")]
    for n, part in enumerate((rows[:4], rows[4:])):
        spark.createDataFrame(part, "source string, t string, status string").select("source", F.col("t").cast("timestamp_ntz").alias("started_at"), "status").coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    stream = lambda: spark.readStream.schema("source string, started_at timestamp_ntz, status string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    days = jobs.run_to_table(spark, jobs.day_counts(stream(), "started_at", ["source"]), mode="update", finish=jobs.last_of(["day", "source"]))
    assert sorted((str(r.day), r.n) for r in days.collect()) == [("2026-05-01", 2), ("2026-05-02", 3), ("2026-05-03", 3), ("2026-05-04", 1)]
    health = jobs.run_to_table(spark, jobs.sliding_health(stream(), days=2), mode="update", finish=jobs.last_of(["from_day", "source"]))
    assert sorted((str(r.from_day), r.runs, r.ok, r.fail) for r in health.collect()) == [("2026-04-30", 3, 1, 2), ("2026-05-01", 6, 2, 4), ("2026-05-02", 6, 2, 4), ("2026-05-03", 3, 1, 2)]


def test_ingest_keeps_a_link_whose_title_came_under_a_known_link(spark, tmp_path):
    landed, store, noted, marks = (str(tmp_path / n) for n in ("landed", "store", "noted", "marks"))
    land(spark, landed, [item("l1", "t1", 2, 0), item("l1", "t2", 2, 1), item("l2", "t2", 2, 2)])
    jobs.ingest(spark.readStream.schema(SCHEMA).parquet(landed), store, noted, marks).awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(store).collect()) == [0, 2]
