import random
import re

import numpy as np
import pytest

from tranche.llm.catalog import QUERIES
from tranche.llm.graph import components
from tranche.llm.jaccard_join import bitmap, may_link, near_duplicates, needed_overlap


def plain_sets(texts, words):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append(frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else []))
    return out


def brute(docs, words, num, den):
    """Every pair that shares a shingle, compared exactly."""
    sets = plain_sets([t for _, t in docs], words)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    tried = set()
    for group in by.values():
        for k, a in enumerate(group):
            for b in group[k + 1:]:
                if (a, b) not in tried and find(a) != find(b):
                    tried.add((a, b))
                    i = len(sets[a] & sets[b])
                    if den * i >= num * (len(sets[a]) + len(sets[b]) - i):
                        parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def same(got, docs, words, num, den):
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(docs, words, num, den)


def test_bound_never_hides_a_link():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 2**63, rng.choice([3, 60, 250, 900])).astype(np.uint64)
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 2**63, rng.integers(0, 4)).astype(np.uint64)]))
        a = np.unique(a)
        if not len(b):
            continue
        i = len(np.intersect1d(a, b))
        for num in (80, 90, 100):
            links = 100 * i >= num * (len(a) + len(b) - i)
            assert links == (i >= needed_overlap(len(a), len(b), num, 100))
            ok = may_link(np.array([len(a)]), [bitmap(a)], np.array([len(b)]), [bitmap(b)], num, 100)[0]
            assert ok or not links


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, x) for x in range(5001, 5100)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("words,num", [(3, 90), (5, 80), (1, 50)])
def test_random_copies_against_brute_force(spark, words, num):
    rng = random.Random(words)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    docs, n = [], 0
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 40, 90]))]
        if rng.random() < 0.5:
            base = base + passage
        for _ in range(rng.choice([1, 2, 3, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append((n, " ".join(copy)))
            n += 1
    hub = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(330):                 # one group over the size of a tile
        copy = list(hub)
        copy[rng.randrange(120)] = rng.choice(vocabulary) + "x"
        docs.append((n, " ".join(copy)))
        n += 1
    rng.shuffle(docs)
    same(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words, num).collect(), docs, words, num, 100)


def test_edge_rows(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    docs = [(5, None), (6, ""), (7, " \t\n"), (8, "One two"), (2, "one TWO"), (9, "one two three"), (None, "one two"), (None, "only null ids here"),
            (3, long), (1, long + " end"), (4, "É é"), (10, "é É"), (11, "x y z"), (8, "One two")]
    df = spark.createDataFrame([(a, b, 1, "k") for a, b in docs], "doc_id long, text string, n int, comp string")
    same(near_duplicates(df, 3, 90, 100).collect(), docs, 3, 90, 100)
    assert near_duplicates(df.limit(0), 3, 90, 100).collect() == []


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    same(QUERIES["op5_jaccard_join"](spark, sf).collect(), docs, 3, 90, 100)


def test_copies_around_one_text_are_not_paired_with_each_other(spark, monkeypatch):
    """Each copy links with the middle, hardly any two copies with each other."""
    from tranche.llm import jaccard_join

    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    docs = [(0, " ".join(base))]
    for k in range(1, 400):
        words = list(base)
        for i in rng.sample(range(len(base)), 1 + k % 3):
            words[i] = f"own{k}x{i}"
        docs.append((k, " ".join(words)))
    made, bounded = [], jaccard_join.bounded

    def counted(pairs, *rest):
        made.append(pairs.count())
        return bounded(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "bounded", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    same(near_duplicates(df, 3, 90, 100).collect(), docs, 3, 90, 100)
    assert sum(made) < 4 * len(docs), made
