"""Alignment of two tokenizers against a plain form that tokenizes whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from feedjobs.llm import alignment, queries
from feedjobs.llm.alignment import align, common_ends, gallop

A, B = queries._vocabulary("byte_bpe_50k.json"), queries._vocabulary("piece_bpe_32k.model")
BLANKS = ["plain words here", "  two  blanks ", "a\n b \n\nc\t d", "x\n  y", "\n \n", " ", "   ", "end\n", "tab\t", "　wide　 blank", "a\xa0b \xa0c", "\x1c x\x1d y", "café naïve 漢字かな 😀🎉 ", "it's we'll DON'T 'S", "1234567890 12", "<|endoftext|> <s> </s> <unk> <0x0A>", "under▁score", "nul\0 byte", "é combining", "foo;\r\n bar();\r", "a" * 3000, "\n" * 50, "!?" * 100, "ﬁ ligature Ⅻ"]
ODD = [(1, None), (2, ""), (3, "  \t\n "), (4, "many words of one long text " * 4000), (5, "same text"), (5, "same text"), (6, "same text"), (None, "ligne é 漢字"), (8, "under▁score")]


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), alignment.Vocabularies(A, B)


def groups_of(text, plain):
    """[(A ids, B ids)] by walking both token lists, or None."""
    if not text:
        return None
    a_ids, b_ids = plain[0].encode(" " + text, add_special_tokens=False).ids, plain[1].encode(text)
    a, b = [plain[2].a[i] for i in a_ids], [plain[2].b[i] for i in b_ids]
    if not b"".join(a) == b"".join(b) == (" " + text).encode():
        return None
    out, i, j, x, y = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            x += len(a[i])
            out[-1][0].append(a_ids[i])
            i += 1
        else:
            y += len(b[j])
            out[-1][1].append(b_ids[j])
            j += 1
        if x == y and out[-1][0] and out[-1][1]:
            out.append(([], []))
    return out[:-1]


def brute(rows, plain, digest=True):
    every = [groups_of(t, plain) for _, t in rows]
    links = [Counter((a, b) for x, y in g or [] for a in x for b in y) for g in every]
    count = Counter(p for c in links for p in c)
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (i, _), g, c in zip(rows, every, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        shown = "" if g is None else hashlib.sha256(text.encode()).hexdigest() if digest else text
        out.append((i, *(sum(len(p[k]) for p in g or []) for k in (0, 1)), len(g or []), sum(c.values()), sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()), shown))
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()), key=str)


def test_documents(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = queries.op13_alignment(spark, "/root/testdata/sf0.001").withColumnRenamed("groups_sha256", "groups")
    assert shown(got) == brute(rows, plain)


@pytest.mark.parametrize("kind", ["blanks", "odd", "empty", "random"])
def test_odd_texts(spark, plain, kind, monkeypatch):
    random.seed(3)
    alphabet = " \n\t\r \xa0aeé漢!1'▂　Zx"
    rows = {"blanks": list(enumerate(BLANKS)), "odd": ODD, "empty": [], "random": [(i, "".join(random.choices(alphabet, k=random.randint(1, 40)))) for i in range(400)]}[kind]
    clash = spark.createDataFrame([(i, t, 1, "x", [2]) for i, t in rows], "doc_id long, text string, block long, groups string, pairs array<int>")
    assert shown(align(clash, A, B)) == brute(rows, plain, digest=False)


def test_small_blocks_and_large_groups_agree(plain, monkeypatch):
    texts = pa.array([t for t in BLANKS if t])
    want = alignment._align_block(texts, plain[2], False)
    monkeypatch.setattr(alignment, "PAIRS", 0)
    monkeypatch.setattr(alignment, "JOINED", 1)
    got = alignment._align_block(texts, plain[2], False)
    assert got[2] == want[2]
    links = [Counter({(k // len(x[3]), int(x[3][k % len(x[3])])): n for k, n in zip(x[5].tolist(), x[6].tolist(), strict=True)}) for x in (got, want)]
    assert links[0] == links[1] and got[4].sum() == want[4].sum()


def test_gallop():
    rng = np.random.default_rng(1)
    for n, m in [(0, 5), (5, 0), (1, 1), (3, 4000), (4000, 3), (2000, 2500)]:
        a, b = (np.sort(rng.choice(6000, k, replace=False)) + 1 for k in (n, m))
        i, j = common_ends(a, b)
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()
        assert gallop(a, b, np.zeros(len(a), int)).tolist() == np.searchsorted(b, a).tolist()


def test_packed():
    x, y = np.array([0, 5, 2**40]), np.zeros(0, np.int64)
    assert [v.tolist() for v in alignment._unpacked(alignment._packed(x, y), 2)] == [x.tolist(), []]
