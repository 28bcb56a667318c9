"""Watch lists, themes and baselines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hits(items: DataFrame, rules: list[tuple[str, str, str]], text: Column) -> DataFrame:
    """Items x rules (name, scope pattern, keyword pattern) where both patterns match; adds rule.

    A few rules are one expression; more than EXPRESSION go by the words they require (see hits_by_words).
    """
    if not rules:
        return items.withColumn("rule", F.lit("")).where(F.lit(False))
    if len(rules) > EXPRESSION:
        return hits_by_words(items, rules, text)
    return items.withColumn("rule", F.explode(_matching(rules, text)))


def _matching(rules: list[tuple[str, str, str]], text: Column) -> Column:
    return F.filter(F.array(*[F.when(text.rlike(scope) & text.rlike(words), F.lit(name)) for name, scope, words in rules]), lambda r: r.isNotNull())


#: Rules that become one expression.
EXPRESSION = 50
#: Characters of the piece of a literal that stands for it in the index.
PIECE = 4


def required(pattern: str) -> str | None:
    """A text, in lower case, that every match of the pattern holds, or None if none is seen: the longest run of plain ASCII letters, digits and blanks
    outside groups, classes and alternatives, less a character that a quantifier may take away."""
    if "|" in pattern or "(?x" in pattern:
        return None
    best = now = ""
    depth = at = 0
    while at < len(pattern):
        c = pattern[at]
        plain = c.isascii() and (c.isalnum() or c == " ")
        if c == "\\":
            at += 1
        elif c == "[":
            at = pattern.find("]", at + 2 + (pattern[at + 1 : at + 2] == "^"))
            if at < 0:
                return None
        elif c in "()":
            depth += 1 if c == "(" else -1
        if plain and not depth:
            now += c.lower()
        else:
            if c in "?*{" and now:
                now = now[:-1]
            best, now = max(best, now, key=len), ""
            if c == "{":
                at = pattern.find("}", at)
                if at < 0:
                    return None
        at += 1
    best = max(best, now, key=len)
    return best if len(best) >= PIECE else None


def any_of(pieces: list[str]) -> str:
    """A pattern for any of the pieces, which are plain (see required) and equally long, as a tree of their characters: most places of a text fail at its root."""
    if not pieces:
        return "(?!)"
    heads: dict[str, list[str]] = {}
    for piece in sorted(pieces):
        heads.setdefault(piece[0], []).append(piece[1:])
    if len(pieces[0]) == 1:
        return f"[{''.join(heads)}]"
    return "(?:" + "|".join(head + any_of(rest) for head, rest in heads.items()) + ")"


def hits_by_words(items: DataFrame, rules: list[tuple[str, str, str]], text: Column) -> DataFrame:
    """The same for thousands of rules, in one pass over the texts: an inverted index from a piece of each rule's required text to the rules.

    The pieces of PIECE characters that a text holds are found by one expression (see any_of) and meet the index, which is a broadcast table of one row a piece, so a text makes a row a piece
    found, only rules that may match are tried, and rules that require no such text are tried on all. A rule's patterns are then tested as they stand. The rules are configuration, and the size of their table is that of the list.
    """
    spark = items.sparkSession
    pieces: dict[str | None, list[tuple[str, str, str]]] = {}
    for rule in rules:
        literal = max((x for x in map(required, rule[1:]) if x), key=len, default=None)
        pieces.setdefault(literal and literal[:PIECE], []).append(rule)
    free = pieces.pop(None, [])
    kind = "name string, scope string, words string"
    index = spark.createDataFrame(list(pieces.items()), f"_piece string, _rules array<struct<{kind}>>")
    low = F.translate(text, _UPPER, _UPPER.lower())
    held = F.array_distinct(F.regexp_extract_all(low, F.lit(f"(?=({any_of(list(pieces))}))"), F.lit(1)))  # at every place, so pieces may overlap
    met = items.withColumn("_text", text).withColumn("_piece", F.explode(held)).join(F.broadcast(index), "_piece").withColumn("_rule", F.explode("_rules"))
    found = met.where(F.expr("_text rlike _rule.scope and _text rlike _rule.words")).select(*items.columns, F.col("_rule.name").alias("rule"))
    rest = items.withColumn("rule", F.explode(_matching(free, text))) if free else None
    return found if rest is None else found.unionByName(rest)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def themes(items: DataFrame, rules: list[tuple[str, str, str]], text: Column) -> DataFrame:
    """Items a theme; an item that no rule matches is ``other``."""
    found = _matching(rules, text)
    named = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("other")))
    return items.select(F.explode(named).alias("theme")).groupBy("theme").agg(F.count(F.lit(1)).alias("items"))


def context(lines: DataFrame, keys: list[str], order: str, hit: Column, before: int = 2, after: int = 5) -> DataFrame:
    """Lines that stand up to ``before`` lines before or ``after`` lines after a hit."""
    near = Window.partitionBy(*keys).orderBy(order).rowsBetween(-after, before)
    return lines.withColumn("_near", F.max(hit.cast("int")).over(near)).where("_near = 1").drop("_near")


def new_since(records: DataFrame, baseline: DataFrame, key: str, ts: str) -> DataFrame:
    """Records later than their key's last_seen; a key without one is all new."""
    return records.join(baseline, key, "left").where(F.col("last_seen").isNull() | (F.col(ts) > F.col("last_seen"))).drop("last_seen")


def first_messages(turns: DataFrame, noise: str, size: int = 500) -> DataFrame:
    """The first user message of each conversation that is not noise, cut to ``size``."""
    rows = turns.where((F.col("role") == "user") & ~F.col("text").rlike(noise))
    return rows.groupBy("conv_id").agg(F.min_by(F.substring("text", 1, size), "turn").alias("message"))


def with_comments(stories: DataFrame, comments: DataFrame, most: int = 5, size: int = 300) -> DataFrame:
    """Stories with up to ``most`` first comments, less the deleted and the empty ones; stories without stay.

    stories: story; comments: story, pos, author, text, deleted. The cut comes before the filter.
    """
    from feedjobs.functions.text import clean_comment

    rows = comments.where((F.col("pos") < most) & ~F.coalesce("deleted", F.lit(False)) & (F.coalesce("author", F.lit("")) != ""))
    rows = rows.withColumn("text", clean_comment(F.col("text"))).where("text <> ''")
    lists = rows.groupBy("story").agg(F.array_sort(F.collect_list(F.struct("pos", "author", "text"))).alias("_c"))
    return stories.join(lists, "story", "left").withColumn("comments", F.coalesce(F.transform("_c", lambda c: F.struct(c["author"].alias("author"), c["text"].alias("text"))), F.array().cast("array<struct<author:string,text:string>>"))).drop("_c")


def enrich_repos(items: DataFrame, repos: DataFrame, docs: DataFrame, priority: list[str]) -> DataFrame:
    """Repository front pages with landed metadata: README cut to 1500, the first of the ``priority`` documents cut to 500.

    repos: url, readme, stars; docs: url, name, body.
    """
    from feedjobs.functions.urls import is_repo_root

    order = reduce(lambda c, p: c.when(F.col("name") == p[1], p[0]), enumerate(priority), F.when(F.lit(False), 0))
    first = docs.withColumn("_o", order).where("_o is not null").groupBy("url").agg(F.substring(F.min_by("body", "_o"), 1, 500).alias("positioning"))
    meta = repos.select("url", F.substring("readme", 1, 1500).alias("readme"), "stars").join(first, "url", "left").withColumnRenamed("url", "_url")
    return items.where(is_repo_root(F.col("canonical_url"))).join(meta, F.col("canonical_url") == F.col("_url"), "left").drop("_url")
