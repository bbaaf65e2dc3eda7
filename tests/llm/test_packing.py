import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tranche.llm.catalog import QUERIES
from tranche.llm.packing import fit_repeats, exact_patterns, pack_documents, pack_histogram

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def check_plan(histogram, plan, capacity):
    used = Counter()
    for lengths, n in plan:
        assert sum(lengths) <= capacity and n > 0
        for v in lengths:
            used[v] += n
    assert used == Counter({k: v for k, v in histogram.items() if v})
    return sum(n for _, n in plan)


def test_plan_uses_every_piece_and_is_close_to_the_bound():
    rng = np.random.default_rng(3)
    lengths = np.minimum(1024, rng.lognormal(5.3, 0.9, 20_000).astype(int) + 1)
    h = dict(Counter(lengths.tolist()))
    n = check_plan(h, pack_histogram(h), 1024)
    assert n <= 1.005 * -(-int(lengths.sum()) // 1024)


def test_edge_histograms():
    assert pack_histogram({}) == []
    assert check_plan({600: 7}, pack_histogram({600: 7}), 1024) == 7
    assert check_plan({1024: 5}, pack_histogram({1024: 5}), 1024) == 5
    assert check_plan({1: 2049}, pack_histogram({1: 2049}), 1024) == 3
    assert check_plan({512: 5, 256: 2}, pack_histogram({512: 5, 256: 2}), 1024) == 3
    rng = random.Random(0)
    for _ in range(20):
        h = {rng.randint(1, 16): rng.randint(1, 9) for _ in range(6)}
        check_plan(h, pack_histogram(h, 16), 16)


def test_fit_reaches_an_exact_mixture():
    counts = np.zeros(17, np.int64)
    for a, n in ((10, 30), (6, 30), (8, 20), (4, 20)):
        counts[a] += n
    p = exact_patterns(np.flatnonzero(counts), 16)
    x = fit_repeats(p, counts)
    used = np.bincount(p.ravel(), np.repeat(x, 3), 17)
    assert np.abs(used[1:] - counts[1:]).max() < 0.05


def check_rows(rows, texts):
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for places in at.values():
        end = 0
        for off, n in sorted(places):
            assert off == end
            end += n
        assert end <= 1024
    want = Counter()
    for i, t in texts:
        ids = LIB.encode(t or "", add_special_tokens=False).ids + [2]
        first, at0 = len(ids) % 1024 or 1024, 0
        k = 0
        while at0 < len(ids):
            to = at0 + (first if not k else 1024)
            want[(i, k, at0, to - at0, zlib.crc32(np.array(ids[at0:to], "<u4").tobytes()))] += 1
            at0, k = to, k + 1
    assert want == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def test_pieces_edge_cases(spark):
    rows = [(1, "word " * 3000, 1), (2, None, 2), (None, "", 3), (1, "word " * 3000, 4), (5, "<|endoftext|> x", 5), (6, "日本語 ɐ", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    check_rows(pack_documents(df, PATH).collect(), [(a, b) for a, b, _ in rows])
    assert pack_documents(df.limit(0), PATH).collect() == []


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_rows(QUERIES["op3_pattern_packing"](spark, sf).collect(), docs)
