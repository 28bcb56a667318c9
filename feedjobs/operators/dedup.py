"""Two-tier dedup of a batch of items: by link, then by normalized title with tier preference.

Items carry id, title_hash, source_tier and ``seq``, their order of arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedjobs.operators import keyfilter, replay
from feedjobs.operators.lineage import cut
from feedjobs.operators.ordered import running

SIGHTING = ["source", "source_handle", "url"]


def tier(column: str = "source_tier") -> Column:
    return F.coalesce(column, F.lit(2))


def unseen(batch: DataFrame, store: DataFrame) -> DataFrame:
    """Items whose id is not stored. Only the store's ids are read, and those that may be in the batch are shuffled."""
    return batch.join(_matching(store.select("id"), batch, "id"), "id", "left_anti")


def _matching(store: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The stored rows whose key may be in the batch."""
    return keyfilter.maybe(store, key, keyfilter.key_filter(batch, key, batch.count()))


def first_per_id(items: DataFrame) -> DataFrame:
    """The first arrival of each id; the minimum combines before the shuffle."""
    rows = items.groupBy("id").agg(F.min_by(F.struct(*[c for c in items.columns if c != "id"]), "seq").alias("r"))
    return rows.select("id", "r.*").select(items.columns)


def oldest_stored(store: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """One stored row a title: the oldest. With ``batch`` only for titles that may be in it, so what is aggregated grows with the batch and not with the history."""
    rows = store.select("title_hash", "id", "seq", tier().alias("tier"), *SIGHTING)
    if batch is not None:
        rows = _matching(rows, batch, "title_hash")
    return rows.groupBy("title_hash").agg(F.min_by(F.struct("id", "seq", "tier", *SIGHTING), "seq").alias("stored"))


def title_winners(items: DataFrame) -> DataFrame:
    """title_hash, first, winner (structs): the first arrival, or the best of a better tier with another link.

    Both are minima over structs, so a hot title is one row per map task; the members are joined back to the
    first, where a skewed title can be split.
    """
    row = F.struct(tier().alias("tier"), "seq", "id", *SIGHTING)
    firsts = items.groupBy("title_hash").agg(F.min_by(row, "seq").alias("first"))
    members = items.select("title_hash", row.alias("row")).join(firsts, "title_hash")
    better = F.when((F.col("row.tier") < F.col("first.tier")) & (F.col("row.id") != F.col("first.id")), F.col("row"))
    best = members.groupBy("title_hash").agg(F.min(better).alias("better"))
    return firsts.join(best, "title_hash").select("title_hash", "first", F.coalesce("better", "first").alias("winner"))


def batch_sightings(items: DataFrame, winners: DataFrame, *, lossless: bool = True) -> DataFrame:
    """(winner_id, seq, source, source_handle, url) of the members that the winner stands for.

    ``lossless``: all members with another id. Else as a sequential merge that forgets what was noted on a displaced row:
    the displaced first, then later members whose id is neither's.
    """
    rows = items.select("title_hash", "id", "seq", *SIGHTING).join(winners, "title_hash").where(F.col("id") != F.col("winner.id"))
    if not lossless:
        displaced = (F.col("seq") == F.col("first.seq")) & (F.col("winner.seq") != F.col("first.seq"))
        rows = rows.where(displaced | ((F.col("seq") > F.col("winner.seq")) & (F.col("id") != F.col("first.id"))))
    return rows.select(F.col("winner.id").alias("winner_id"), "seq", *SIGHTING)


def against_store(items: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(wins, sightings, rest): items of a better tier than the stored row of their title, what both cases note, items of new titles.

    A win is inserted and notes the stored row; any other match is noted on the stored row.
    """
    joined = items.join(oldest_stored(store, items), "title_hash", "left")
    matched, rest = joined.where("stored is not null"), joined.where("stored is null").select(items.columns)
    wins = tier() < F.col("stored.tier")
    won = matched.where(wins)
    noted = won.select(F.col("id").alias("winner_id"), "seq", *[F.col(f"stored.{c}").alias(c) for c in SIGHTING])
    lost = matched.where(~wins).select(F.col("stored.id").alias("winner_id"), "seq", *SIGHTING)
    return first_per_id(won.select(items.columns)), noted.union(lost), rest


def dedup_in_order(batch: DataFrame, store: DataFrame, *, lossless: bool = True) -> tuple[DataFrame, DataFrame]:
    """(new items, sightings) as a row-by-row merge in order of seq gives them, also where a link comes under several titles and for any number of tiers.

    The batch is written once; what is stored is read for the batch's ids and titles, and narrow rows decide (see replay).
    ``lossless``: a title's winner notes all items that were not passed over. Else what was noted on a displaced row is forgotten.
    """
    batch = cut(batch)
    narrow = batch.select("id", "title_hash", "source_tier", "seq", *SIGHTING)
    fresh = cut(unseen(narrow, store).join(oldest_stored(store, narrow), "title_hash", "left"))
    candidates = fresh.groupBy("title_hash", "id", tier().alias("tier")).agg(F.min("seq").alias("seq"), F.first("stored.tier").alias("stored_tier"))
    accepted = replay.accepted(candidates)
    place = F.row_number().over(Window.partitionBy("title_hash").orderBy(F.desc("seq")))  # a row a tier
    ranked = accepted.where("not is_stored").withColumn("_place", place)
    kept = accepted.where("is_stored").select("seq").union(ranked.where("_place = 1").select("seq"))
    holders = ranked.groupBy("title_hash").agg(F.max("seq").alias("_seq"), F.max_by("id", "seq").alias("_id"), F.max(F.when(F.col("_place") == 2, F.col("seq"))).alias("_prior"))

    live = replay.not_accepted_before(fresh, accepted)
    wins = tier() < F.col("stored.tier")
    noted = live.where(wins).select(F.col("id").alias("winner_id"), "seq", *[F.col(f"stored.{c}").alias(c) for c in SIGHTING])
    lost = live.where(~wins).select(F.col("stored.id").alias("winner_id"), "seq", *SIGHTING)
    merged = live.where("stored is null").join(holders, "title_hash").where("id <> _id" if lossless else "seq > _seq or seq = _prior")
    return batch.join(kept, "seq", "left_semi").select(batch.columns), noted.union(lost).union(merged.select(F.col("_id").alias("winner_id"), "seq", *SIGHTING))


def winners_in_order(items: DataFrame) -> DataFrame:
    """The items that a row-by-row merge into an empty store keeps. Only narrow columns go through the rounds."""
    narrow = items.select("id", "title_hash", "source_tier", "seq", *SIGHTING)
    kept = dedup_in_order(narrow, narrow.limit(0))[0].select("seq")
    return items.join(kept, "seq", "left_semi").select(items.columns)


def dedup(batch: DataFrame, store: DataFrame, *, lossless: bool = True, distinct_sightings: bool = True, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """(new items, sightings). The caller writes both; sightings are appended, and lists are built on read.

    ``exact`` follows the row-by-row merge in all cases (see dedup_in_order). Without it each title
    is taken on its own, which gives the same only if each link has one title in the batch and there are two tiers.
    """
    if exact:
        new, sightings = dedup_in_order(batch, store, lossless=lossless)
    else:
        fresh = unseen(batch, store)
        wins, noted, rest = against_store(fresh, store)
        winners = title_winners(rest)
        accepted = rest.join(winners.select(F.col("winner.seq").alias("_w")), F.col("seq") == F.col("_w"), "left_semi")
        new, sightings = wins.unionByName(first_per_id(accepted)), noted.union(batch_sightings(rest, winners, lossless=lossless))
    if distinct_sightings:
        sightings = sightings.groupBy("winner_id", *SIGHTING).agg(F.min("seq").alias("seq")).select("winner_id", "seq", *SIGHTING)
    return new, sightings


def displaced_by(items: DataFrame) -> DataFrame:
    """Audit: for each member the best (tier, seq) of its title that came before it."""
    rows = items.select("seq", "title_hash", tier().alias("tier"))
    rows = running(rows, ["title_hash"], ["seq"], F.struct("tier", "seq"), "_best", kind="min", inclusive=False)
    return rows.select("seq", "title_hash", "tier", F.col("_best.seq").alias("best_seq"), (F.col("tier") < F.col("_best.tier")).alias("displaces"))


def with_sightings(items: DataFrame, sightings: DataFrame, most: int | None = None) -> DataFrame:
    """Adds also_appeared_in: an item's sightings in order of arrival, or with ``most`` the first so many.

    An item's list is one value of its row, as reports print it; a limit keeps rows short where a story was seen many thousand times.
    """
    if most is not None:
        rank = F.row_number().over(Window.partitionBy("winner_id").orderBy("seq", *SIGHTING))
        sightings = sightings.withColumn("_r", rank).where(F.col("_r") <= most)
    lists = sightings.groupBy("winner_id").agg(F.array_sort(F.collect_list(F.struct("seq", *SIGHTING))).alias("_s"))
    lists = lists.select(F.col("winner_id").alias("_id"), F.transform("_s", lambda s: F.struct(*[s[c].alias(c) for c in SIGHTING])).alias("also_appeared_in"))
    return items.drop("also_appeared_in").join(lists, F.col("id") == F.col("_id"), "left").drop("_id")
