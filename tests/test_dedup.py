import random

import pytest
from pyspark.sql import functions as F

from feedjobs.operators import graph, keyfilter, replay
from feedjobs.operators.dedup import batch_sightings, dedup, oldest_stored, title_winners, winners_in_order, with_sightings
from feedjobs.sources import commits, history

SCHEMA = "id string, title_hash string, source_tier int, seq long, source string, source_handle string, url string"


def sequential(rows):
    """Row by row: first arrival of a title; a better tier with another link takes its place once."""
    seen, by_title, inserted = set(), {}, {}
    for id_, title, tier, seq in rows:
        if id_ in seen:
            continue
        if title not in by_title:
            by_title[title] = (tier, seq, id_)
            inserted[title] = seq
            seen.add(id_)
        elif tier < by_title[title][0]:
            by_title[title] = (tier, seq, id_)
            inserted[title] = seq
            seen.add(id_)
    return set(inserted.values())


def test_winners_match_a_sequential_merge(spark):
    rng = random.Random(1)
    batches = []
    for b in range(60):  # each link has one title, two tiers
        batches.append([(f"{b}-{t}-{rng.randrange(4)}", f"{b}-{t}", rng.choice((1, 2)), i) for i in range(12) for t in [rng.randrange(4)]])
    flat = [(i, t, tier, seq + 100 * b) for b, rows in enumerate(batches) for i, t, tier, seq in rows]
    df = spark.createDataFrame([(i, t, k, s, "x", "h", i) for i, t, k, s in flat], SCHEMA)
    got = {r["winner"]["seq"] for r in title_winners(df).collect()}
    assert got == sequential(flat)


def test_sightings_and_store(spark):
    store = spark.createDataFrame([("s1", "t1", 2, 0, "x", "h", "u-s1"), ("s2", "t2", 1, 1, "x", "h", "u-s2")], SCHEMA)
    batch = spark.createDataFrame([("s1", "t1", 1, 2, "y", "h", "again"), ("a", "t1", 1, 3, "y", "h", "u-a"), ("b", "t2", 2, 4, "y", "h", "u-b"), ("c", "t3", 2, 5, "y", "h", "u-c"), ("d", "t3", 1, 6, "z", "h", "u-d")], SCHEMA)
    new, sightings = dedup(batch, store)
    assert {r.id for r in new.collect()} == {"a", "d"}
    assert {(r.winner_id, r.url) for r in sightings.collect()} == {("a", "u-s1"), ("s2", "u-b"), ("d", "u-c")}


def test_reference_rule_forgets(spark):
    rows = [("a", "t", 2, 0, "x", "h", "u"), ("b", "t", 2, 1, "x", "h", "u"), ("c", "t", 1, 2, "x", "h", "u"), ("d", "t", 2, 3, "x", "h", "u")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.seq for r in batch_sightings(df, title_winners(df)).collect()) == [0, 1, 3]
    assert sorted(r.seq for r in batch_sightings(df, title_winners(df), lossless=False).collect()) == [0, 3]


def merge(batch, stored):
    """Row by row over (id, title, tier, seq) with stored {title: (id, tier)}: accepted seqs and (winner id, noted url) pairs."""
    seen, holder, lists, known = set(), {}, {}, {i for i, _ in stored.values()}
    won, noted = set(), []
    for id_, title, tier, seq in batch:
        if id_ in seen or id_ in known:
            continue
        if title in stored:
            old, bar = stored[title]
            if tier < bar:
                won.add(seq)
                seen.add(id_)
                noted.append((id_, f"u-{old}"))
            else:
                noted.append((old, f"u-{seq}"))
        elif title not in holder or tier < holder[title][0]:
            lists[seq] = [f"u-{holder[title][1]}"] if title in holder else []
            holder[title] = (tier, seq, id_)
            seen.add(id_)
        else:
            lists[holder[title][1]].append(f"u-{seq}")
    for _, seq, id_ in holder.values():
        won.add(seq)
        noted += [(id_, url) for url in lists[seq]]
    return won, noted


@pytest.mark.parametrize("together", [0, 50_000])
def test_exact_matches_a_sequential_merge(spark, monkeypatch, together):
    monkeypatch.setattr(replay, "TOGETHER", together)
    rng = random.Random(2)
    batches, stored = [], {}
    for b in range(150):  # links come under several titles, three tiers
        for t in range(5):
            if rng.random() < 0.3:
                stored[f"{b}-t{t}"] = (f"{b}-s{t}", rng.choice((1, 2, 3)))
        batches += [(f"{b}-{rng.choice(('i0', 'i1', 'i2', 'i3', 's0'))}", f"{b}-t{rng.randrange(5)}", rng.choice((1, 2, 3)), 1000 + 20 * b + i) for i in range(14)]
    won, noted = merge(batches, stored)
    store = spark.createDataFrame([(i, t, k, n, "x", "h", f"u-{i}") for n, (t, (i, k)) in enumerate(stored.items())], SCHEMA)
    batch = spark.createDataFrame([(i, t, k, n, "x", "h", f"u-{n}") for i, t, k, n in batches], SCHEMA)
    new, sightings = dedup(batch, store, lossless=False, distinct_sightings=False, exact=True)
    assert new.columns == batch.columns and {r.seq for r in new.collect()} == won
    assert sorted((r.winner_id, r.url) for r in sightings.collect()) == sorted(noted)
    lossless = {(r.winner_id, r.url) for r in dedup(batch, store, exact=True)[1].collect()}
    assert set(noted) <= lossless
    assert dedup(batch.limit(0), store, exact=True)[0].count() == 0


def test_exact_is_the_default_where_links_have_one_title(spark):
    rng = random.Random(3)
    rows = [(f"{t}-{rng.randrange(3)}", f"t{t}", rng.choice((1, 2, None)), i, "x", "h", f"u{i}") for i in range(300) for t in [rng.randrange(60)]]
    batch, store = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("a", "t1", 2, 0, "x", "h", "u-a"), ("b", "t2", 1, 1, "x", "h", "u-b")], SCHEMA)
    assert {r.seq for r in dedup(batch, store)[0].collect()} == {r.seq for r in dedup(batch, store, exact=True)[0].collect()}


def test_no_item_is_lost_where_a_link_has_two_titles(spark):
    rows = [("l1", "t1", 2, 0, "x", "h", "u0"), ("l1", "t2", 2, 1, "x", "h", "u1"), ("l2", "t2", 2, 2, "x", "h", "u2")]
    batch = spark.createDataFrame(rows, SCHEMA)
    new, sightings = dedup(batch, batch.limit(0))
    assert {(r.id, r.seq) for r in new.collect()} == {("l1", 0), ("l2", 2)} and sightings.count() == 0
    won = winners_in_order(batch)
    assert won.columns == batch.columns and {(r.id, r.seq) for r in won.collect()} == {("l1", 0), ("l2", 2)}


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, k, n, "x", "h", f"u-{n}") for i, t, k, n in rows], SCHEMA)


def test_a_chain_of_a_thousand_links_takes_few_rounds(spark, monkeypatch):
    """Each link comes under two titles and each title under two links: every decision rests on the one before it."""
    rows = [(f"l{(i + 1) // 2}", f"t{i // 2}", 2, i) for i in range(2000)]
    monkeypatch.setattr(replay, "TOGETHER", 0)
    rounds, one = [], graph.star_round
    monkeypatch.setattr(graph, "star_round", lambda edges: rounds.append(1) or one(edges))
    won, noted = merge(rows, {})
    assert 900 < len(won) < 1100
    batch = items_of(spark, rows)
    new, sightings = dedup(batch, batch.limit(0), lossless=False, distinct_sightings=False)
    assert {r.seq for r in new.collect()} == won and len(rounds) <= 12
    assert sorted((r.winner_id, r.url) for r in sightings.collect()) == sorted(noted)


def test_large_components_settle_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(replay, "REPLAY", 6)
    monkeypatch.setattr(replay, "TOGETHER", 0)
    rng = random.Random(6)
    rows = [(f"{b}-i{rng.randrange(5)}", f"{b}-t{rng.randrange(4)}", rng.choice((1, 2, 3)), 100 * b + n) for b in range(12) for n in range(20)]
    stored = {f"{b}-t0": (f"{b}-s", 2) for b in range(0, 12, 2)}
    won, _ = merge(rows, stored)
    store = items_of(spark, [(i, t, k, n) for n, (t, (i, k)) in enumerate(stored.items())])
    assert {r.seq for r in dedup(items_of(spark, rows), store)[0].collect()} == won


def test_history_is_read_for_the_batch_only(spark, tmp_path):
    """Of 20,000 stored items a batch of 20 reads few rows and few folders, and the plan aggregates nothing else."""
    store = items_of(spark, [(f"s{i}", f"t{i}", 2, i) for i in range(20_000)])
    batch = items_of(spark, [(f"s{i}" if i % 2 else f"new{i}", f"t{i * 7}" if i % 3 else f"fresh{i}", 1, 30_000 + i) for i in range(20)])
    known = keyfilter.maybe(store, "title_hash", keyfilter.key_filter(batch, "title_hash", 20))
    assert {r.title_hash for r in known.collect()} >= {f"t{i * 7}" for i in range(20) if i % 3} and known.count() < 20 + 20_000 // keyfilter.PER_KEY * 2
    plan = oldest_stored(store, batch)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join Inner") and "_bits" in plan  # the filter stands below the aggregate
    path = str(tmp_path / "keys")
    assert history.add(store, path, 0) and not history.add(store, path, 0)
    near = history.matching(spark, path, batch)
    files = {r[0] for r in near.select(F.input_file_name()).distinct().collect()}
    assert near.count() < 4000 and len(files) <= 2 * 20 and spark.read.parquet(path).count() == 40_000
    got = [sorted(map(tuple, part.collect()), key=str) for part in dedup(batch, near)]
    assert got == [sorted(map(tuple, part.collect()), key=str) for part in dedup(batch, store)]
    history.add(items_of(spark, [("late", "t1", 2, 40_000)]), path, 1)
    history.compact(spark, path)
    assert len(commits.manifest(spark, path)["folders"]) == 1 and not history.add(store, path, 0)
    assert history.matching(spark, path, batch, before=1).count() == near.count()


def test_null_and_hot_keys_pass_the_filter_rightly(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), ("b", 4)], "k string, n int")
    made = keyfilter.key_filter(spark.createDataFrame([("a",), (None,)], "k string"), "k", 2)
    assert {r.n for r in keyfilter.maybe(rows, "k", made).collect()} - {1} == {2, 3}
    assert keyfilter.maybe(rows, "k", keyfilter.key_filter(rows.limit(0), "k", 0)).count() == 0


def test_all_sightings_are_listed(spark):
    batch = items_of(spark, [(f"i{n}", "t", 2, n) for n in range(70)])
    new, sightings = dedup(batch, batch.limit(0))
    assert len(with_sightings(new, sightings).first().also_appeared_in) == 69 and len(with_sightings(new, sightings, most=5).first().also_appeared_in) == 5
