"""The item store, the run log, configuration and reports on disk."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedjobs.functions.times import business_day
from feedjobs.operators.dedup import first_per_id, unseen
from feedjobs.sources import commits

ITEM_DEFAULTS = {"author": "", "excerpt": "", "language": "en", "source_handle": ""}
SIGHTINGS = "array<struct<source:string,source_handle:string,url:string>>"
COMMENTS = "array<struct<author:string,text:string,posted_at:string>>"
JSON_COLUMNS = {"engagement_json": ("engagement", "map<string,bigint>"), "also_appeared_in": ("also_appeared_in", SIGHTINGS), "comments_json": ("comments", COMMENTS)}


def source_config(spark: SparkSession, entries: list[dict], language: str = "en") -> DataFrame:
    """id, type, enabled, tier, language, params from parsed configuration; an entry without id or type is an error."""
    rows = []
    for e in entries:
        if not e.get("id") or not e.get("type"):
            raise ValueError(f"a source needs id and type: {e}")
        known = {"id", "type", "enabled", "tier", "language"}
        rows.append((e["id"], e["type"], bool(e.get("enabled", True)), int(e.get("tier", 2)), e.get("language", language), {k: str(v) for k, v in e.items() if k not in known}))
    return spark.createDataFrame(rows, "id string, type string, enabled boolean, tier int, language string, params map<string,string>")


def with_config_defaults(rows: DataFrame, language: str = "en") -> DataFrame:
    """The same from landed rows (id, type, enabled, tier, language, params); a row without id or type ends the job."""
    missing = (F.coalesce("id", F.lit("")) == "") | (F.coalesce("type", F.lit("")) == "")
    checked = F.when(missing, F.raise_error(F.concat(F.lit("a source needs id and type: "), F.to_json(F.struct(*rows.columns))))).otherwise(F.col("id"))
    return rows.select(checked.alias("id"), "type", F.coalesce("enabled", F.lit(True)).alias("enabled"), F.coalesce("tier", F.lit(2)).alias("tier"), F.coalesce("language", F.lit(language)).alias("language"), "params")


def append_items(items: DataFrame, store: DataFrame | None, path: str, name: str | None = None) -> bool:
    """Append items whose id is new, partitioned by the business day of fetching, and commit them (see commits). A day is dealt to one task, a large one to several (see by_day).

    An append that broke half-way is never read and can be repeated; one that is repeated under the ``name`` of a committed one adds nothing and gives False.
    """
    fresh = first_per_id(items if store is None else unseen(items, store))
    return commits.write(by_day(fresh.withColumn("fetch_day", business_day(F.col("fetched_at"))), "fetch_day"), path, name or uuid.uuid4().hex, ("fetch_day",))


def by_day(rows: DataFrame, day: str) -> DataFrame:
    """Each day's rows together, so that files grow with the days and not with days times tasks. Spark splits a day that is too large for a task."""
    return rows.hint("rebalance", F.col(day))


def append_runs(runs: DataFrame, path: str) -> None:
    by_day(runs.withColumn("run_day", F.to_date("started_at")), "run_day").write.mode("append").partitionBy("run_day").parquet(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items with defaults; files from before a column was added read as null there. Of a table with a manifest what is committed, else all files."""
    rows = commits.read(spark, path)
    return with_defaults(spark.read.option("mergeSchema", "true").parquet(path) if rows is None else rows)


def with_defaults(rows: DataFrame) -> DataFrame:
    """Null defaults, and JSON text decoded into typed columns; columns that are missing are added."""
    for c, value in ITEM_DEFAULTS.items():
        rows = rows.withColumn(c, F.coalesce(c, F.lit(value)) if c in rows.columns else F.lit(value))
    rows = rows.withColumn("source_tier", F.coalesce("source_tier", F.lit(2)) if "source_tier" in rows.columns else F.lit(2))
    for c, (name, kind) in JSON_COLUMNS.items():
        empty = F.from_json(F.lit("{}" if kind.startswith("map") else "[]"), kind)
        if c not in rows.columns:
            rows = rows if name in rows.columns else rows.withColumn(name, empty)
        elif dict(rows.dtypes)[c] == "string":
            rows = rows.withColumn(name, F.coalesce(F.from_json(c, kind), empty))
    return rows


def with_json(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text, as the row form of the store has them."""
    for c, (name, _) in JSON_COLUMNS.items():
        if name in rows.columns and dict(rows.dtypes)[name] != "string":
            rows = rows.withColumn(c, F.to_json(name))
    return rows


def write_report(lines: DataFrame, path: str) -> None:
    """Rows (day, section_order, position, line) as text, a folder a day; a day's rerun replaces it.

    A day is range-split by its order, so a large one is several parts in name order.
    """
    order = ["day", "section_order", "position", "line"]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("day", F.col("line").alias("value")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").text(path)
