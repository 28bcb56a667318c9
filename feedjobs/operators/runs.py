"""Source reliability from the run log: latest failures, streaks, health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedjobs.functions.text import error_name, error_status
from feedjobs.functions.times import within
from feedjobs.operators.lineage import cut
from feedjobs.operators.ordered import running

# The exceptions that pass by themselves, and what derives from the last one.
TRANSIENT = ["ReadTimeout", "ConnectTimeout", "WriteTimeout", "PoolTimeout", "ReadError", "ConnectError", "WriteError", "RemoteProtocolError", "NetworkError"]
TRANSIENT_KINDS = ["CloseError"]
STABLE_AFTER = 7


def error_class(error: Column) -> Column:
    name, status = error_name(error), error_status(error)
    return (
        F.when(name.isin(TRANSIENT + TRANSIENT_KINDS) | ((name == "HTTPStatusError") & (status >= 500)), "transient")
        .when((name == "HTTPStatusError") & status.isin(401, 403), "user_action_required")
        .otherwise("persistent_error")
    )


def latest(runs: DataFrame) -> DataFrame:
    """The last run of each source by id; one combinable maximum."""
    return runs.groupBy("source").agg(F.max_by(F.struct(*[c for c in runs.columns if c != "source"]), "id").alias("r")).select("source", "r.*")


def latest_failed(runs: DataFrame) -> DataFrame:
    return latest(runs).where("status <> 'ok'")


#: Most sources whose last success is broadcast; more are joined by a shuffle, which Spark splits where it is skewed.
BROADCAST_SOURCES = 100_000


def with_streaks(state: DataFrame, runs: DataFrame) -> DataFrame:
    """``state`` (source, last_ok_at) with consecutive: the failures after the last success, or all if there was none.

    Failures meet one short row a source, so no source goes through one task.
    """
    last = state.select("source", "last_ok_at")
    if last.count() <= BROADCAST_SOURCES:
        last = F.broadcast(last)
    since = runs.where("status <> 'ok'").select("source", "started_at").join(last, "source").where("last_ok_at is null or started_at > last_ok_at")
    return state.join(since.groupBy("source").agg(F.count(F.lit(1)).alias("consecutive")), "source", "left").withColumn("consecutive", F.coalesce("consecutive", F.lit(0)))


def known_issues(runs: DataFrame) -> DataFrame:
    """Sources whose latest run failed, with their last success and the failures since.

    The log is read twice: for the latest run and last success of each source, which combine before the shuffle, and for the failures of the sources that fail.
    """
    last = F.max_by(F.struct("status", "started_at", "error", "error_class", "attempts"), "id")
    state = runs.groupBy("source").agg(last.alias("r"), F.max(F.when(F.col("status") == "ok", F.col("started_at"))).alias("last_ok_at"))
    state = with_streaks(cut(state.where("r.status <> 'ok'")), runs)
    return state.select(
        "source", F.coalesce("r.error", F.lit("")).alias("last_error"), F.coalesce("r.error_class", F.lit("")).alias("last_error_class"),
        F.coalesce("r.attempts", F.lit(1)).alias("last_attempts"), F.col("r.started_at").alias("last_failed_at"), "last_ok_at", "consecutive",
    )


def streaks(runs: DataFrame) -> DataFrame:
    """Failures after the last success of every source."""
    state = cut(runs.groupBy("source").agg(F.max(F.when(F.col("status") == "ok", F.col("started_at"))).alias("last_ok_at")))
    return with_streaks(state, runs).select("source", F.col("consecutive").alias("streak"))


def streak_history(runs: DataFrame) -> DataFrame:
    """Every run of failures: source, island (successes before it), failures."""
    rows = running(runs.select("source", "started_at", "id", "status"), ["source"], ["started_at", "id"], (F.col("status") == "ok").cast("long"), "island")
    return rows.where("status <> 'ok'").groupBy("source", "island").agg(F.count(F.lit(1)).alias("failures"))


def issue_bucket(consecutive: Column, kind: Column) -> Column:
    return F.when(consecutive >= STABLE_AFTER, "stable").when(kind == "user_action_required", "user_action").when(kind == "persistent_error", "persistent").otherwise("transient")


def health(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """runs, ok, fail, rate and last error of each source in the window; here a null status is a failure."""
    bad = F.coalesce(F.col("status") != "ok", F.lit(True))
    rows = runs.where(within(F.col("started_at"), as_of, 24 * days)).groupBy("source").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(~bad).alias("ok"), F.count_if(bad).alias("fail"),
        F.max_by(F.when(bad, F.col("error")), F.when(bad, F.struct("started_at", "id"))).alias("error"),
    )
    return rows.select("source", "runs", "ok", "fail", F.round(100 * F.col("ok") / F.col("runs"), 1).alias("rate"), F.substring(F.coalesce("error", F.lit("")), 1, 60).alias("last_error"))


def with_hints(issues: DataFrame, by_source: DataFrame, by_class: DataFrame) -> DataFrame:
    """Adds hint: the source's own, else its error class's, else empty. Both hint tables are configuration."""
    return issues.join(by_source.withColumnRenamed("hint", "_own"), "source", "left").join(by_class.withColumnRenamed("hint", "_class"), "last_error_class", "left").withColumn("hint", F.coalesce("_own", "_class", F.lit(""))).drop("_own", "_class")


def attempts_summary(attempts: DataFrame, most: int = 4) -> DataFrame:
    """Per run: attempts made and the last one's class; a run may make ``most`` if its errors pass, else one."""
    return attempts.groupBy("run_id").agg(F.max("attempt").alias("attempts"), F.max_by("error_class", "attempt").alias("error_class")).withColumn("within_limit", F.col("attempts") <= F.when(F.col("error_class") == "transient", most).otherwise(1))
