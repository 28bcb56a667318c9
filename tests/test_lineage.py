"""Tables in the shared folder go when they are no longer needed."""

from pathlib import Path

from feedjobs.operators.dedup import dedup
from feedjobs.operators.lineage import cut, replaced, shared_dir, step

SCHEMA = "id string, title_hash string, source_tier int, seq long, source string, source_handle string, url string"


def tables(spark):
    return {p for p in Path(shared_dir(spark).removeprefix("file:")).glob("feedjobs-*/*") if p.is_dir()}


def test_steps_and_rounds_leave_nothing(spark):
    before = tables(spark)
    with step(spark):
        rows, made = cut(spark.range(5)), []
        for _ in range(4):
            rows = replaced(rows.selectExpr("id + 1 AS id"), made)
        assert len(tables(spark) - before) == 2 and rows.agg({"id": "sum"}).first()[0] == 30
        batch = spark.createDataFrame([("a", "t", 2, 0, "x", "h", "u"), ("a", "s", 2, 1, "x", "h", "u"), ("b", "s", 1, 2, "x", "h", "u")], SCHEMA)
        assert {r.seq for r in dedup(batch, batch.limit(0))[0].collect()} == {0, 2}
    assert tables(spark) == before
