"""The prefix trie against a plain form, for any number of shards."""

import hashlib
import re
import zlib

import pytest

from feedjobs.llm import queries, trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SAME = [("user", "hello there"), ("assistant", "one  two\tthree")]
ODD = [(1, None, None, None), (1, 0, "user", ""), (2, 0, None, None), (2, 1, "user", "x y"), (7, 5, "user", "late"), (20, 0, "user", "base a"), (20, 1, "assistant", "base b"), (20, 2, "user", "c"), *[(c, t, *SAME[t]) for c in range(21, 33) for t in (0, 1)], (33, 0, "user", "w " * 50000), (33, 1, "u", "ser:x"), (33, 2, "u:s", "er:x"), (41, 0, "a", "lone"), (None, 0, "user", "nobody"), (60, 0, "user", "same"), (60, 0, "user", "same")]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for n, cs in members.items():
        below = [m for m in members if m[: len(n)] == n]
        saved = sum((len(members[m]) - 1) * len(WORD.findall(m[-1][1])) for m in below if m)
        leaf = [m for m in below if not any(len(k) == len(m) + 1 and k[: len(m)] == m for k in members)]
        ends = ",".join(map(str, sorted(c for c in cs if built[c] == n)))
        out.append((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), sum(len(k) == len(n) + 1 and k[: len(n)] == n for k in members), len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def shown(nodes, ends):
    found = nodes.join(trie.ends_digest(ends), ["conv_id", "depth"], "left").na.fill({"ends_sha256": hashlib.sha256(b"").hexdigest()})
    return sorted((tuple(r[n] for n in NAMES) for r in found.collect()), key=str)


@pytest.mark.parametrize("shards", [1, 3, 50])
def test_documents(spark, shards, monkeypatch):
    monkeypatch.setattr(trie, "IDS", 3)
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    want = brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert shown(*trie.prefix_trie(trie.rebuilt(trie.conversations(turns)), shards=shards)) == want


@pytest.mark.parametrize("kind", ["odd", "empty", "copies"])
@pytest.mark.parametrize("shards", [1, 9])
def test_odd_rows(spark, kind, shards, monkeypatch):
    monkeypatch.setattr(trie, "IDS", 4)
    rows = {"odd": ODD, "empty": [], "copies": [(c, t, *SAME[t]) for c in range(100, 400) for t in range(1 + (c % 3 > 0))]}[kind]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, path string")
    assert shown(*trie.prefix_trie(trie.rebuilt(trie.conversations(turns)), shards=shards)) == brute(rows)


def test_turnless_conversations_end_at_the_root(spark):
    convs = spark.createDataFrame([(5, []), (3, []), (4, ["0" * 32 + "00000002"])], "conv_id long, steps array<string>")
    got = shown(*trie.prefix_trie(convs))
    assert got[0][:7] == (3, 0, None, 3, 1, 1, 0) and got[0][7] == hashlib.sha256(b"3,5").hexdigest()
    assert got[1][:7] == (4, 1, 3, 1, 0, 1, 0)


def test_long_paths_mean_fewer_shards(spark, monkeypatch):
    monkeypatch.setattr(trie, "SPLITTERS", 300)
    paths = spark.createDataFrame([(i, bytes([i]) * 40) for i in range(100)], "conv_id long, path binary")
    cut = trie.splitters(paths, 64)
    assert 0 < len(cut) <= 300 // 48


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    want = sorted((tuple(r) for r in con.sql(f"SELECT {', '.join(NAMES)} FROM ({queries.oracle_sql()['op12_prefix_trie']})").fetchall()), key=str)
    got = queries.op12_prefix_trie(spark, "/root/testdata/sf0.01").select(NAMES).collect()
    assert sorted(map(tuple, got), key=str) == want
