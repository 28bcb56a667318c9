"""Which items a row-by-row merge accepts, settled by components instead of row by row.

Candidates are one row an item's (title_hash, id, tier): seq of its first arrival, and stored_tier, null where the title is not stored. An item is
passed over if its id was accepted before. Else it is accepted if its tier is better than the stored row's or, in a new title, than all that were accepted before it.
So items meet only through an id or a new title:

* An id that comes under one new title only, or under stored titles only, is *plain*. A title of plain ids is settled by a fold over its first few
  candidates, in the JVM.
* Other ids tie titles together. What they connect is a component; each component of up to REPLAY candidates is replayed in order of arrival in one
  pass, and many components share a task.
* Larger components settle in rounds (accepted_in_rounds), distributed.

Before that, an id whose first candidate is sure to be accepted is plain: its later ones are passed over. And what is tied in a batch need not be told apart if all of it fits one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedjobs.operators.graph import components
from feedjobs.operators.lineage import cut, replaced

#: Candidates of a component that one task replays; they are ids, hashes and numbers.
REPLAY = 50_000
#: Tied candidates of a batch that are replayed together, without a look at what connects them.
TOGETHER = 50_000
ACCEPTED = ["title_hash", "id", "tier", "seq", "is_stored"]


def accepted(candidates: DataFrame) -> DataFrame:
    """title_hash, id, tier, seq, is_stored of the accepted candidates, also those that are displaced later."""
    live = _less_sure(candidates.where("stored_tier is null or tier < stored_tier"))  # no other is ever accepted, nor in another's way
    new = F.col("stored_tier").isNull()
    titles = F.when(new, F.col("title_hash"))
    ids = live.groupBy("id").agg(F.min(titles).alias("_first"), F.max(titles).alias("_last"), F.max((~new).cast("int")).alias("_old"))
    ties = F.col("_first").isNotNull() & ((F.col("_first") != F.col("_last")) | (F.col("_old") == 1))
    rows = cut(live.join(ids.select("id", ties.alias("_ties")), "id"))
    tiers, tied_rows = rows.agg(F.count_distinct("tier"), F.count_if("_ties")).first()
    if not tied_rows:
        return cut(plain_stored(rows.where(~new)).union(plain_titles(first_few(rows.where(new), tiers))))

    touched = rows.where("_ties and stored_tier is null").select("title_hash").distinct().withColumn("_touched", F.lit(True))
    rows = rows.join(touched, "title_hash", "left").withColumn("_tangled", F.col("_ties") | (F.coalesce("_touched", F.lit(False)) & new)).drop("_touched")
    plain = rows.where("not _tangled")
    done = [plain_stored(plain.where(~new)), plain_titles(first_few(plain.where(new), tiers))]
    tangled = rows.where("_tangled")
    tangled = cut(tangled.where("_ties").unionByName(first_few(tangled.where("not _ties"), tiers)))
    if tangled.count() <= TOGETHER:
        return cut(done[0].union(done[1]).union(replayed(tangled.withColumn("_root", F.lit("")))))

    edges = tangled.where("_ties and stored_tier is null").select(F.concat(F.lit("t"), "title_hash").alias("a"), F.concat(F.lit("i"), "id").alias("b"))
    tied = cut(components(edges))
    of = lambda kind, name: tied.where(F.col("node").startswith(kind)).select(F.expr("substr(node, 2)").alias(name), F.col("root").alias(f"_{kind}"))
    # a stored title ties nothing: its candidates belong to their id's component
    tangled = tangled.join(of("t", "title_hash"), "title_hash", "left").join(of("i", "id"), "id", "left")
    tangled = cut(tangled.withColumn("_root", F.when(new, F.col("_t")).otherwise(F.col("_i"))).drop("_t", "_i"))
    sizes = tangled.groupBy("_root").agg(F.count(F.lit(1)).alias("_n"))
    done.append(replayed(tangled.join(sizes.where(F.col("_n") <= REPLAY).select("_root"), "_root")))
    large = sizes.where(F.col("_n") > REPLAY).select("_root")
    if not large.isEmpty():
        done.append(accepted_in_rounds(tangled.join(large, "_root").select(candidates.columns)))
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return cut(out)


def _less_sure(live: DataFrame) -> DataFrame:
    """Without the candidates that are passed over because their id's first candidate is the first of its title too, or under a stored one: that is accepted, whatever else is."""
    ids = live.groupBy("id").agg(F.min(F.struct("seq", "title_hash", "stored_tier")).alias("_f"))
    titles = live.where("stored_tier is null").groupBy("title_hash").agg(F.min("seq").alias("_top"))
    sure = ids.select("id", "_f.*").join(titles, "title_hash", "left").where("stored_tier is not null or seq = _top").select("id", F.col("seq").alias("_sure"))
    return live.join(sure, "id", "left").where("_sure is null or seq = _sure").drop("_sure")


def first_few(rows: DataFrame, tiers: int) -> DataFrame:
    """Of a new title's plain ids, those that can be accepted: in each tier the first as many as there are tiers.

    A title accepts a candidate a tier at most. The next accepted plain one is the first of a better tier whose id was not accepted, and as better ones all
    come later, those before it in its tier are ids that this title accepted: fewer than there are tiers.
    """
    place = F.row_number().over(Window.partitionBy("title_hash", "tier").orderBy("seq"))
    return rows.withColumn("_place", place).where(F.col("_place") <= tiers).drop("_place")


def plain_stored(rows: DataFrame) -> DataFrame:
    """Under stored titles an id's first candidate is accepted."""
    first = rows.groupBy("id").agg(F.min(F.struct("seq", "title_hash", "tier")).alias("r"))
    return first.select("r.title_hash", "id", "r.tier", "r.seq", F.lit(True).alias("is_stored"))


def plain_titles(rows: DataFrame) -> DataFrame:
    """New titles of plain ids, each folded in order of arrival over its few candidates (see first_few)."""
    one = F.struct("seq", "tier", "id")
    titles = rows.groupBy("title_hash").agg(F.sort_array(F.collect_list(one)).alias("rows"))
    none = F.array().cast("array<struct<seq:bigint,tier:int,id:string>>")

    def take(done, row):
        better = (F.size(done) == 0) | (row["tier"] < F.try_element_at(done, F.lit(-1))["tier"])
        return F.when(better & ~F.exists(done, lambda r: r["id"] == row["id"]), F.concat(done, F.array(row))).otherwise(done)

    return titles.select("title_hash", F.explode(F.aggregate("rows", none, take)).alias("r")).select("title_hash", "r.id", "r.tier", "r.seq", F.lit(False).alias("is_stored"))


def replayed(rows: DataFrame) -> DataFrame:
    """The accepted candidates of whole components (_root), each replayed in order of arrival."""
    names = ["_root", "title_hash", "id", "tier", "seq", "stored_tier"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, best = None, set(), {}
        for batch in batches:
            out = []
            for root, title, id_, tier, seq, stored in zip(*(batch[c].to_pylist() for c in names), strict=True):
                if root != now:
                    now, seen, best = root, set(), {}
                bar = stored if stored is not None else best.get(title)
                if id_ not in seen and (bar is None or tier < bar):
                    seen.add(id_)
                    if stored is None:
                        best[title] = tier
                    out.append((title, id_, tier, seq, stored is not None))
            columns = zip(*out, strict=True) if out else [[]] * len(ACCEPTED)
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=ACCEPTED)

    rows = rows.select("_root", "title_hash", "id", F.col("tier").cast("int").alias("tier"), F.col("seq").cast("long").alias("seq"), F.col("stored_tier").cast("int").alias("stored_tier"))
    return rows.repartition("_root").sortWithinPartitions("_root", "seq").mapInArrow(run, "title_hash string, id string, tier int, seq long, is_stored boolean")


def accepted_in_rounds(rows: DataFrame) -> DataFrame:
    """The same over all candidates at once, for components too large for one task.

    A decision rests on earlier items only, so repeating both rules over all of them settles on the row-by-row result: each round settles the next link of
    every chain. Minima over a title's tiers and over ids combine before the shuffle, so a hot title or id is a few rows.
    """
    rows = cut(rows)
    before = Window.partitionBy("title_hash").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)  # a row a tier
    found, mark, last, made = None, None, (), []
    while mark != last:
        live = rows if found is None else not_accepted_before(rows, found)
        wins = live.where("tier < stored_tier").groupBy("id").agg(F.min(F.struct("seq", "title_hash", "tier")).alias("r")).select("r.title_hash", "id", "r.tier", "r.seq", F.lit(True).alias("is_stored"))
        firsts = live.where("stored_tier is null").groupBy("title_hash", "tier").agg(F.min("seq").alias("seq"), F.min_by("id", "seq").alias("id"))
        best = firsts.withColumn("_best", F.min("tier").over(before)).where("_best is null or tier < _best")
        found = replaced(wins.union(best.select("title_hash", "id", "tier", "seq", F.lit(False).alias("is_stored"))), made)
        mark, last = tuple(found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("seq", "id").cast("decimal(38,0)"))).first()), mark
    return found.select(ACCEPTED)


def not_accepted_before(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows whose id was not accepted at an earlier place."""
    since = found.groupBy("id").agg(F.min("seq").alias("_since"))
    return rows.join(since, "id", "left").where("_since is null or _since >= seq").drop("_since")
