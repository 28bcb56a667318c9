"""SimHash components against all pairs, on whole small tables and odd rows."""

import re
import zlib

import numpy as np
import pytest
import xxhash

from feedjobs.llm import queries, simhash
from feedjobs.llm.simhash import Forest, apart, links_of, majority, populations, simhash_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one two three"), (5, "ONE two  three"), (6, "one two three four"), (7, "one two three four five"), (7, "one two three four five"), (None, "one two three four five"), (None, "alone here now and then"), (9, "many words of one long text " * 20000), (10, "É é İ ß a\xa0b \x1c c d"), (11, "é É İ ß a\xa0b \x1c c d")]


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    made = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=4):
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, f in enumerate(prints):
        for j in range(i):
            if (f ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (d, least.get(r)) if x is not None), default=None)
    return sorted(((d, f"{prints[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert shown(queries.op11_simhash(spark, "/root/testdata/sf0.001")) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("kind", ["odd", "empty", "near"])
def test_odd_rows(spark, kind):
    long = " ".join(f"w{i}" for i in range(400))
    rows = {"odd": ODD, "empty": [], "near": [(i, long.replace(f"w{7 * i} ", "") if i % 3 else f"{zlib.crc32(b'%d' % i)} {i} a b {i * i} c") for i in range(60)]}[kind]
    docs = spark.createDataFrame([(d, t, 1, "x", 2, "y") for d, t in rows], "doc_id long, text string, node long, root string, fingerprint int, component_id string")
    assert shown(simhash_components(docs, size=8)) == brute(rows)


def test_links_reach_as_far_as_all_pairs(monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", 16)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(6)]])
    prints = np.unique(near)
    pairs = np.argwhere(np.triu(np.bitwise_count(prints[:, None] ^ prints) <= 4, 1))
    names = {int(p): i for i, p in enumerate(prints)}
    all_, inside = Forest(len(prints)), Forest(len(prints))
    all_.add(pairs[:, 0], pairs[:, 1])
    found = links_of(prints, None)
    assert len(found) < len(pairs) and all((a ^ b).bit_count() <= 4 for a, b in found)
    inside.add(*np.array([(names[a], names[b]) for a, b in found]).T)
    assert inside.root.tolist() == all_.root.tolist()
    x, y = prints[::2], prints[1::2]
    across = {(int(a), int(b)) for a in x for b in y if (int(a) ^ int(b)).bit_count() <= 4}
    assert set(links_of(x, y)) <= across and bool(links_of(x, y)) == bool(across)


def test_population_counts_bound_distances():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**63, 500, dtype=np.uint64), rng.integers(0, 2**63, 500, dtype=np.uint64)
    b[:250] = a[:250] ^ (np.uint64(1) << rng.integers(0, 64, 250, dtype=np.uint64))
    x, y = populations(a), populations(b)
    assert (apart(x, x, y, y) <= np.bitwise_count(a ^ b)).all()


def test_majority_is_over_half():
    hashes = np.array([1, 3, 3, 2, 2**63], np.uint64)
    assert majority(hashes, np.array([2, 0, 2, 1])).tolist() == [1, 0, 2, 2**63]
