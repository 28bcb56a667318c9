"""Structured Streaming forms of the daily loop."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType

from feedjobs.functions.times import business_day
from feedjobs.operators.dedup import dedup
from feedjobs.operators.lineage import cut, scratch, step
from feedjobs.sources import commits, history

STREAKS = "source string, last_ok_at timestamp_ntz, last_run long, streak long, alert boolean"


#: Batches whose index folders are merged into one.
COMPACT_EVERY = 32


def ingest(items: DataFrame, store_path: str, sightings_path: str, checkpoint: str):
    """Exact dedup of every micro-batch against all history.

    A batch's number names its folder. The history is read through an index under the store, and only where the batch's keys can match (see
    sources.history). A batch is indexed after its rows are written, and a replay after a failure takes earlier batches only, so it overwrites its folders with the same rows. What a batch leaves in the
    shared folder goes at its end; every COMPACT_EVERY batches the index is merged.
    """
    keys = f"{store_path}/_keys"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with step(spark):
            batch = cut(batch)
            new, sightings = dedup(batch, history.matching(spark, keys, batch, before=number))
            new.write.mode("overwrite").parquet(f"{store_path}/batch={number:010d}")
            sightings.write.mode("overwrite").parquet(f"{sightings_path}/batch={number:010d}")
        history.add(spark.read.schema(new.schema).parquet(f"{store_path}/batch={number:010d}"), keys, number)
        if number % COMPACT_EVERY == COMPACT_EVERY - 1:
            history.compact(spark, keys)

    return items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bounded_dedup(items: DataFrame, key: str = "id", ts: str = "fetched_at", days: int = 7) -> DataFrame:
    """Drops repeated keys with state for ``days`` only."""
    return items.withWatermark(ts, f"{days} days").dropDuplicatesWithinWatermark([key])


def day_counts(items: DataFrame, ts: str, keys: list[str]) -> DataFrame:
    """Counts a business day (starting at 16:00 UTC) by fetch time, however old the post."""
    timed = items.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", "1 day")
    counted = timed.groupBy(F.window("_ts", "1 day", "1 day", "16 hours").alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(business_day(F.col("w.start").cast("timestamp_ntz")).alias("day"), *keys, "n")


def sliding_health(runs: DataFrame, days: int = 7) -> DataFrame:
    """runs, ok and fail of each source over windows of ``days`` that start every day."""
    timed = runs.withColumn("_ts", F.col("started_at").cast("timestamp")).withWatermark("_ts", "1 day")
    bad = F.coalesce(F.col("status") != "ok", F.lit(True))
    counted = timed.groupBy(F.window("_ts", f"{days} days", "1 day").alias("w"), "source").agg(F.count(F.lit(1)).alias("runs"), F.count_if(~bad).alias("ok"), F.count_if(bad).alias("fail"))
    return counted.select(F.to_date("w.start").alias("from_day"), "source", "runs", "ok", "fail")


class Streak(StatefulProcessor):
    """A source's last success, last run and failures since, as one short value. A timer at its last run forgets it when the watermark has passed that."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("streak", "last_ok long, run_at long, last_run long, streak long, wakes long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last_ok, run_at, last_run, streak, wakes = self.value.get() if self.value.exists() else (None, None, None, 0, None)
        newest, failures = last_ok, []
        for frame in rows:
            top = frame.iloc[int(np.lexsort((frame["id"], frame["at"]))[-1])]
            if run_at is None or (top["at"], top["id"]) >= (run_at, last_run):
                run_at, last_run = int(top["at"]), int(top["id"])
            ok = frame.loc[frame["status"] == "ok", "at"]
            if len(ok) and (newest is None or ok.max() > newest):
                newest = int(ok.max())
            failures.append(frame.loc[frame["status"].notna() & (frame["status"] != "ok"), ["at", "n"]])
        if newest != last_ok:
            last_ok, streak = newest, 0
        streak += sum(int(f.loc[f["at"] > last_ok, "n"].sum() if last_ok is not None else f["n"].sum()) for f in failures)
        if wakes is not None:
            self.handle.deleteTimer(wakes)
        wakes = run_at // 1000 + 1
        self.handle.registerTimer(wakes)
        self.value.update((last_ok, run_at, last_run, streak, wakes))
        yield pd.DataFrame({"source": [key[0]], "last_ok": pd.array([last_ok], "Int64"), "last_run": [last_run], "streak": [streak]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.value.clear()
        yield pd.DataFrame({"source": [key[0]], "last_ok": pd.array([None], "Int64"), "last_run": pd.array([None], "Int64"), "streak": pd.array([None], "Int64")})

    def close(self) -> None:
        pass


def slimmed(runs: DataFrame) -> DataFrame:
    """source, id, at (microseconds), status, n: of every batch that a task reads the rows that can still matter, so that a busy source is little work for the task that holds its state.

    Of a source's rows there the last success, the last run, and the failures after that success, those of one time as one row.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.sort_values(["source", "at", "id"], kind="stable")
            last_ok = frame[frame["status"] == "ok"].groupby("source")["at"].max()
            ok_at = frame["source"].map(last_ok)
            bad = frame[frame["status"].notna() & (frame["status"] != "ok") & ~(frame["at"] <= ok_at)]
            bad = bad.groupby(["source", "at"], as_index=False).agg(id=("id", "max"), status=("status", "first"), n=("id", "size"))
            good = frame[(frame["status"] == "ok") & (frame["at"] == ok_at)].drop_duplicates("source", keep="last").assign(n=0)
            run_ = frame.drop_duplicates("source", keep="last").assign(n=0, status=None)
            yield pd.concat([bad, good, run_])[["source", "id", "at", "status", "n"]]

    rows = runs.select("source", "id", F.unix_micros(F.col("started_at").cast("timestamp")).alias("at"), "status")
    return rows.mapInPandas(run, "source string, id long, at long, status string, n long")


def live_streaks(runs: DataFrame, state_path: str, checkpoint: str, alert: int = 7, quiet: int = 90):
    """After every micro-batch: source, last_ok_at, last_run, streak (failures since the last success) and whether it is ``alert`` or more, of the sources seen in it.

    The state is a short value a source in Spark's state store, so a micro-batch touches the sources it brings and no others. Its rows are committed as a
    folder under the batch's number; a replay after a failure changes nothing, and every COMPACT_EVERY batches the folders are merged to the newest row a source. A failure that comes late counts if it is later
    than the last success known; a success that comes late ends no failures after it. Rows that are more than ``quiet`` days late (logs go after 90) are left out, and a source without a run for as long is forgotten.
    """

    def write(batch: DataFrame, number: int) -> None:
        at = F.timestamp_micros("last_ok").cast("timestamp_ntz")
        rows = batch.select("source", at.alias("last_ok_at"), "last_run", "streak", (F.col("streak") >= alert).alias("alert"), F.lit(number).cast("long").alias("batch"))
        commits.write(rows, state_path, f"{number:010d}")
        if number % COMPACT_EVERY == COMPACT_EVERY - 1:
            commits.compact(batch.sparkSession, state_path, (), ["source"], reduce=_newest)

    spark, key = runs.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # the only one that this kind of state works with
    try:
        out = "source string, last_ok long, last_run long, streak long"
        timed = slimmed(runs).withColumn("ts", F.timestamp_micros("at")).withWatermark("ts", f"{quiet} days")
        states = timed.groupBy("source").transformWithStateInPandas(Streak(), out, "Update", "EventTime")
        return states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)


def _newest(rows: DataFrame) -> DataFrame:
    rest = F.struct("batch", *[c for c in rows.columns if c not in ("source", "batch")])
    return rows.groupBy("source").agg(F.max_by(rest, "batch").alias("r")).select("source", "r.*")


def latest_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The newest row of every source; those that were forgotten are left out. Empty before the first micro-batch."""
    rows = commits.read(spark, state_path)
    rows = spark.createDataFrame([], f"{STREAKS}, batch long") if rows is None else rows
    return _newest(rows).where("streak is not null").select("source", "last_ok_at", "last_run", "streak", "alert")


def run_to_table(spark: SparkSession, source: DataFrame, *, mode: str, finish: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Run a stream over what is there now; each micro-batch's rows go to a folder of its own, which ``finish`` reads."""
    at = scratch(spark)

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{at}/out/{number:010d}")

    query = source.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(source.schema.add("_batch", IntegerType())).option("recursiveFileLookup", "true").parquet(f"{at}/out")
    return finish(rows)


def last_of(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """What a stream in update mode has in the end: each key's row of the newest micro-batch that changed it."""

    def finish(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys and c != "_batch"]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r")).select(*keys, "_r.*")

    return finish
