import hashlib
import zlib

import duckdb

from tranche.llm.catalog import ORACLE, QUERIES
from tranche.llm.merkle import manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    i, text, lang, source, n = row
    values = (i, source, lang, n if n is None else n + more, text)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, k):
    for level in tree[:-1]:
        s = k ^ 1
        yield k & 1, level[s] if s < len(level) else ""
        k >>= 1


def plain(rows):
    """The whole tree in Python: rows are (doc_id, text, lang, source, n_chars)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    members = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: levels([leaf(r) for r in members[x]]) for x in langs}
    crown = levels([trees[x][-1][0] for x in langs])
    out = []
    for at, x in enumerate(langs):
        for k, r in enumerate(members[x]):
            path = [*siblings(trees[x], k), *siblings(crown, at)]
            tried = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf(r, int(tried))
            for left, s in path:
                h = H(s, h) if left else H(h, s)
            root = crown[-1][0]
            out.append((r[0], leaf(r), trees[x][-1][0], root, H(*(s for _, s in path)), h, h == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def held(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, manifest(df).collect()), key=str) == plain(rows)


def test_sizes_around_block_borders(spark):
    rows = [(i, f"text {i}", f"l{n}", "s", i) for n in (1, 2, 3, 16, 17, 255, 256, 257, 515) for i in range(n)]
    held(spark, rows)


def test_one_language_and_one_row(spark):
    held(spark, [(7, "x", "en", None, 1)])
    held(spark, [(i, "x", "en", None, 1) for i in range(5)])


def test_more_languages_than_a_block(spark):
    held(spark, [(i, "x", f"{i % 300}é", "s", 2) for i in range(700)])


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 5), (None, "", "en", "s", 5), (3, "é" * 50_000, "", "a|b", -1),
            (3, "same", "en", "s", 4), (3, "same", "en", "s", 4), (5, "", None, "s", 2**63 - 1), (11, "x", "日本", "s", 0)]
    rows += [(i, "t", None, "s", None) for i in range(40)]
    held(spark, rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", leaf string, n int")
    assert sorted(map(tuple, manifest(df).collect()), key=str) == plain(rows)
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_whole_table_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    got = sorted(map(tuple, QUERIES["op11_merkle_manifest"](spark, sf).collect()), key=str)
    assert got == plain(list(map(tuple, docs.collect())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    assert sorted(con.execute(ORACLE["op11_merkle_manifest"]).fetchall(), key=str) == got
