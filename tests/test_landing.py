"""Landed data in tables of several files, and what its jobs carry along."""

import gzip
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from feedjobs.functions import text as X
from feedjobs.plans import landing
from feedjobs.plans.queries import ORACLE, QUERIES
from feedjobs.sources import normalize, store

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """Documents whose files are not in order of doc_id, some under one doc_id."""
    rows = [(i, f"text {i} of é", lang, f"src_{i % 2}", 9) for i in range(90) for lang in (("fr", "de", None) if i in (58, 59) else ("en",))]
    for n, part in enumerate((rows[50:], rows[:20], rows[20:50])):
        spark.createDataFrame(part, DOCS).coalesce(1).write.mode("append").parquet(str(tmp_path / "documents.parquet"))
    return tmp_path


def expected(folder, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return con.execute(sql)


def rows_of(found):
    return sorted(tuple(str(v) for v in r) for r in found)


@pytest.mark.parametrize("name", ["n7_rss", "n8_rsshub", "n9_wewe_rss"])
def test_feeds_of_tables_in_any_order(spark, folder, name):
    got = QUERIES[name](spark, str(folder))
    want = expected(folder, ORACLE[name])
    assert [c[0] for c in want.description] == got.columns
    assert rows_of(got.collect()) == rows_of(want.fetchall()) and got.count() == 60


def test_stories_are_shuffled_once(spark, folder, monkeypatch):
    """Grouped where they are sorted; lines stand in order over a source's files."""
    made = []
    monkeypatch.setattr(landing, "scratch", lambda spark: str(folder / "landed"))
    monkeypatch.setattr(normalize, "landed", lambda spark, path, *_, **__: made.append(spark.read.json(path)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would make one file of so few rows
    try:
        landing.stories(spark, landing.documents(spark, str(folder)), "hn")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = sorted((folder / "landed" / "hn" / "file=src_1").glob("*.json.gz"))
    ids = [int(x) for f in files for x in re.findall(r'"objectID":"(\d+)"', gzip.decompress(f.read_bytes()).decode())]
    assert len(files) > 1 and ids == sorted(ids) and set(ids) == {i for i in range(90) if i % 2}


def test_arrival_carries_the_columns_it_is_asked_for(spark, folder):
    docs = landing.documents(spark, str(folder))
    whole, narrow = landing.delivery(spark, docs), landing.delivery(spark, docs, ["id", "title_hash"])
    assert {"title", "url"} & set(narrow.columns) == set()
    assert rows_of(whole.select("seq", "id", "title_hash").collect()) == rows_of(narrow.select("seq", "id", "title_hash").collect())


def test_numbers_read_no_titles(spark, folder, monkeypatch):
    monkeypatch.setattr(X, "nfkc", lambda text: F.raise_error(F.lit("a title was read")))
    assert QUERIES["u1_union_seq"](spark, str(folder)).count() == 90


def test_an_append_is_a_file_a_day(spark, tmp_path):
    day = F.timestamp_seconds(F.col("id").cast("long") % 3 * 86400).cast("timestamp_ntz")
    rows = spark.range(300).repartition(20).select(F.col("id").cast("string").alias("id"), F.col("id").alias("seq"), day.alias("fetched_at"), F.lit("x").alias("status"), F.col("id").alias("run"))
    store.append_items(rows, None, str(tmp_path / "items"), "one")
    store.append_runs(rows.withColumn("started_at", F.col("fetched_at")), str(tmp_path / "runs"))
    assert len(list((tmp_path / "items").rglob("*.parquet"))) == len(list((tmp_path / "runs").rglob("*.parquet"))) == 3
    assert store.read_items(spark, str(tmp_path / "items")).count() == 300
