"""Many watch rules in one pass, and sketches of distinct sources."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedjobs.operators import digest, watch


@pytest.mark.parametrize(("pattern", "want"), [("plain words", "plain words"), ("(?i)Energy", "energy"), ("colou?r code", "r code"), ("ab*cdefg", "cdefg"), ("[abcd]efgh", "efgh"), ("[]x]efgh", "efgh"), ("one|other", None), ("abc", None), ("(group)s only", "s only"), ("x{2}yyyy", "yyyy"), (r"\d+ dollars", " dollars"), (r"\bword", "word"), ("ab+cde", None), ("wxyz+ab", "wxyz")])
def test_required_text(pattern, want):
    assert watch.required(pattern) == want


def test_required_text_stands_in_every_match():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choice(["abcd", "wxyz", "e", "q?", "r*", "s+", "[tu]", "(?:vv)?", ".", "k{2}", "\\d"]) for _ in range(5))
        literal = watch.required(pattern)
        text = "".join(rng.choice(["abcd", "wxyz", "e", "q", "rr", "s", "t", "vv", "kk", "5"]) for _ in range(40))
        for m in re.finditer(pattern, text):
            assert literal is None or literal in m[0].lower()


def test_five_thousand_rules(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(5000)]
    rules = [(f"r{i}", "(?i)the", w if i % 3 else f"(?i){w.upper()} ?") for i, w in enumerate(words)] + [("any", "the", "[0-9]{3}"), ("either", "the", "zebra|yak"), ("scoped", "scoped word", "x")]
    texts = [" ".join(["The"] * (n % 4 > 0) + [rng.choice(words) for _ in range(6)] + (["the 123 yak"] if n % 5 == 0 else []) + (["a scoped word x"] if n == 7 else [])) for n in range(60)] + ["", None]
    items = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    want = {(n, name) for n, t in enumerate(texts) if t for name, scope, w in rules if re.search(scope, t) and re.search(w, t)}
    got = [(r.seq, r.rule) for r in watch.hits(items, rules, F.col("text")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_sketches_of_days(spark):
    rows = spark.range(60_000).selectExpr("concat('s', id % 7) AS source", "concat('h', id % 40000) AS source_handle", "timestamp_ntz '2026-05-01 00:00:00' + make_dt_interval(cast(id div 20000 as int)) AS fetched_at")
    kept = digest.source_sketches(rows)
    for first, last, days in (("2026-05-01", "2026-05-03", (0, 1, 2)), ("2026-05-02", "2026-05-02", (1,))):
        exact = len({(i % 7, i % 40000) for d in days for i in range(20_000 * d, 20_000 * (d + 1))})
        got = digest.sources_in(kept, first, last).first()
        assert abs(got.sources_active - exact) <= 0.02 * exact and got["items"] == 20_000 * len(days)
    assert tuple(digest.sources_in(kept, "2020-01-01", "2020-01-02").first()) == (0, 0)


def test_pieces_are_found_at_every_place(spark):
    """A text makes a row a piece of a rule that it holds, also where pieces overlap, and none a character."""
    assert re.findall(f"(?=({watch.any_of(['abca', 'bcab', 'abcb', 'zzzz'])}))", "xabcabcb") == ["abca", "bcab", "abcb"] and not re.search(watch.any_of([]), "abc")
    rules = [(w, "", w) for w in ("abcabc", "bcabcb", "cabcba", "Abcabc", "zzzz")]
    found = watch.hits_by_words(spark.createDataFrame([(1, "xABCabcbabcabc"), (2, "nothing here"), (3, None)], "n int, t string"), rules, F.col("t"))
    assert sorted(map(tuple, found.select("n", "rule").collect())) == [(1, "abcabc")]
    assert "regexp_extract_all" in found._jdf.queryExecution().optimizedPlan().toString()
