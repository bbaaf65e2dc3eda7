import hashlib
import random

import numpy as np
import pytest

from tranche.llm import suffix_dedup
from tranche.llm.catalog import QUERIES
from tranche.llm.suffix_dedup import anchored, removal_digest, repeated_starts, sliding_least, without_repeats
from tranche.llm.suffix_sort import common_prefix, deep_shallow_order


def brute(texts, length):
    """Bytes covered by a string that starts at two places of the input."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for r in raw:
        for p in range(len(r) - length + 1):
            seen[r[p:p + length]] = seen.get(r[p:p + length], 0) + 1
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for p in range(len(r) - length + 1):
            if seen[r[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(r) else 0))
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_deep_shallow_equals_sorted():
    rng = random.Random(0)
    for _ in range(300):
        head = bytes(rng.choices(b"ab", k=rng.randint(0, 60)))
        s = [head + bytes(rng.choices(b"ab", k=rng.randint(0, 80))) for _ in range(rng.randint(1, 40))]
        s += [s[0][:rng.randint(len(head), len(s[0]))] for _ in range(3)] + s[:2]
        order = deep_shallow_order(s, len(head))
        assert sorted(order) == list(range(len(s))) and [s[i] for i in order] == sorted(s)
    assert common_prefix(b"abcde", b"abcxe") == 3 and common_prefix(b"", b"a") == 0


def test_sliding_least():
    rng = np.random.default_rng(0)
    for n, w in ((5, 5), (17, 4), (100, 7), (3, 1)):
        x = rng.integers(0, 1000, n).astype(np.uint64)
        assert sliding_least(x, w).tolist() == [int(x[i:i + w].min()) for i in range(n - w + 1)]


def test_every_start_has_one_anchor_and_equal_strings_equal_ones():
    rng = random.Random(4)
    for _ in range(40):
        base = bytes(rng.choices(b"abc", k=50))
        texts = [bytes(rng.choices(b"abc", k=rng.randint(0, 30))) + base + bytes(rng.choices(b"abc", k=rng.randint(0, 30))) for _ in range(3)] + [b"ab" * 40, b""]
        data, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        seen = {}
        runs = list(zip(*anchored(data, offs, 20, 6)))
        starts = [p for _, _, a, z, _ in runs for p in range(a, z + 1)]
        assert sorted(starts) == [p for i, t in enumerate(texts) for p in range(offs[i], offs[i] + len(t) - 19)]
        for _, h, a, z, at in runs:
            for p in range(a, z + 1):
                assert seen.setdefault(data[p:p + 20].tobytes(), (h, at - p)) == (h, at - p)


def test_meeting_neighbours_finds_all():
    rng = random.Random(9)
    for _ in range(150):
        gram = b"GRAM"
        pieces = [bytes(rng.choices(b"xy", k=8)) for _ in range(3)]
        made = {}
        for _ in range(rng.randint(2, 14)):
            left = (rng.choice(pieces) + bytes(rng.choices(b"xy", k=8)))[-rng.randint(3, 8):]
            left = rng.choice([left, rng.choice(pieces)])[-8:]
            right = (rng.choice(pieces)[:rng.randint(0, 8)] + bytes(rng.choices(b"xy", k=12)))[:12]
            made[left + gram + right] = len(left)
        contexts, anchors, length = list(made), list(made.values()), 12
        got = repeated_starts(contexts, anchors, length, 4)
        for i, c in enumerate(contexts):
            want = {p for p in range(len(c) - length + 1) for j, d in enumerate(contexts)
                    if j != i and 0 <= anchors[j] - anchors[i] + p and len(d) >= anchors[j] - anchors[i] + p + length
                    and p <= anchors[i] and anchors[i] + 4 <= p + length and d[anchors[j] - anchors[i] + p:][:length] == c[p:p + length]}
            have = {p for a, z in got[i] for p in range(a, z + 1) if p <= anchors[i] and anchors[i] + 4 <= p + length}
            assert have == want


def random_docs(seed, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 7))) for _ in range(300)]
    passages = [" ".join(rng.choices(words, k=30)) for _ in range(4)]
    docs = []
    for i in range(n):
        t = " ".join(rng.choices(words, k=rng.randint(0, 60)))
        for _ in range(rng.choice([0, 0, 1, 2])):
            cut = rng.randint(0, len(t))
            t = t[:cut] + rng.choice(passages) + t[cut:]
        if rng.random() < 0.15:
            t += "word " * rng.randint(5, 90)
        if docs and rng.random() < 0.2:
            t = rng.choice(docs)
            if rng.random() < 0.5:
                cut = rng.randint(0, len(t))
                t = t[:cut] + "X" + t[cut:]
        docs.append(t)
    return docs


@pytest.mark.parametrize("most", [256, 3])
def test_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (suffix_dedup.LENGTH, 16))
    docs = random_docs(most)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, removal_digest(df, 60).collect()))
    assert got == [(i, *b) for i, b in enumerate(brute(docs, 60))]
    assert sum(g[2] for g in got) > 0


def test_edge_rows(spark):
    a = "".join(random.Random(1).choices("abcdefgh ", k=900))
    long = "".join(random.Random(2).choices("abcdefgh ", k=200_000))
    rows = [(1, a, 3), (1, a, 4), (2, None, 5), (None, "", 6), (4, "short", 7), (4, "short", 8), (5, "q" * 399, 9), (6, "z" * 401, 10), (7, long, 11), (8, "é" * 500 + a[:450], 12),
            (9, long[777:1300], 13)]
    df = spark.createDataFrame(rows, "doc_id long, text string, copies int")
    want = sorted(((r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], 400))), key=str)
    assert sorted(map(tuple, removal_digest(df).collect()), key=str) == want
    assert removal_digest(df.limit(0)).collect() == []
    kept = {r.copies: r for r in without_repeats(df.withColumn("n_chars", df.copies.cast("long"))).collect()}
    assert sorted(kept) == [5, 6, 7, 8, 9, 11] and kept[11].n_chars == 200_000 - 523 == len(kept[11].text)
    assert kept[5].text is None and kept[7].n_chars == 7
    assert without_repeats(df.limit(0)).collect() == []


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r)[:5] for r in QUERIES["op1_suffix_dedup"](spark, sf).collect())
    assert got == sorted((i, *b) for (i, _), b in zip(docs, brute([t for _, t in docs], 400)))
