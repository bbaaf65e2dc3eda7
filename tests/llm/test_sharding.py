import random
import zlib
from collections import Counter, defaultdict

import pytest

from tranche.llm.catalog import QUERIES
from tranche.llm.sharding import SpaceTree, best_fit_decreasing, near_equal_bins, shard_documents


def plain_best_fit(sizes, capacity):
    space, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fit = min(((s, b) for b, s in enumerate(space) if s >= sizes[i]), default=None)
        if fit is None:
            space.append(capacity)
            fit = (capacity, len(space) - 1)
        out[i] = fit[1]
        space[fit[1]] -= sizes[i]
    return out


def test_tree_equals_a_scan():
    rng = random.Random(2)
    for _ in range(60):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(0, 80))]
        assert best_fit_decreasing(sizes, 50) == plain_best_fit(sizes, 50)
    tree = SpaceTree()
    assert tree.take_tightest(1) is None
    with pytest.raises(ValueError):
        best_fit_decreasing([9], 8)


def test_near_equal_and_a_group_of_a_third():
    rng = random.Random(4)
    sizes = [rng.randint(1, 900) for _ in range(5000)]
    loads = Counter()
    for s, b in zip(sizes, near_equal_bins(sizes, 16)):
        loads[b] += s
    assert len(loads) == 16 and max(loads.values()) <= 1.001 * min(loads.values())
    hot = [sum(sizes) // 2, *sizes]
    loads = Counter()
    for s, b in zip(hot, near_equal_bins(hot, 16)):
        loads[b] += s
    rest = sorted(loads.values())[:-1]
    assert max(loads.values()) == hot[0] and max(rest) <= 1.001 * min(rest)
    assert near_equal_bins([], 16) == [] and near_equal_bins([3], 16) == [0]


def check(rows, docs):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert want == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    slots, shard_of, text = defaultdict(list), {}, {}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < 16 and r["law"] == "bytes" and r["grown_shard"] is None
        assert shard_of.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    return loads


def test_edge_cases(spark):
    rows = [(1, "same", 1), (1, "same", 2), (None, None, 3), (7, "", 4), (8, "x" * 90_000, 5), *((i, "hot", i) for i in range(100, 160))]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    check(shard_documents(df).collect(), [(a, b) for a, b, _ in rows])
    assert shard_documents(df.limit(0)).collect() == []


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    loads = check(QUERIES["op8_best_fit_shards"](spark, sf).collect(), docs)
    assert len(loads) == 16 and max(loads.values()) <= 1.01 * min(loads.values())
