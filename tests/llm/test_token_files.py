import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from tranche.llm.catalog import QUERIES
from tranche.llm.token_files import file_digest, read_token_files, write_token_files
from tranche.llm.tokenizing import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def test_both_roads_give_the_library_ids():
    rng = random.Random(5)
    low = [chr(c) for c in range(0x240)]
    parts = low + ["the", " of", "  ", "\n\n", "'s", "'LL", "12", "日本", "<|endoftext|>", "é", " " * 1500, "x" * 1500, "ɐ", "؀", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["", None]
    texts += ["".join(rng.choice(low) for _ in range(60)) for _ in range(1500)]
    texts += [a + c + b for c in low for a in ("a", " ", "1", "!") for b in ("a", " ", "1", "!")]
    got = byte_bpe(PATH).encode(pa.array(texts, pa.string()))
    for t, g in zip(texts, got):
        assert g.tolist() == ids(t), repr(t)


def check(rows, docs):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    rows = sorted(rows, key=lambda r: r.start)
    at = 0
    assert len(rows) == len(docs)
    for r, (i, t) in zip(rows, docs):
        x = [*ids(t), 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)


def test_round_trip_and_pruning(spark, tmp_path):
    rows = [(9, "nine " * 700, 1), (2, None, 2), (None, "", 3), (2, None, 4), (5, "five", 5), (-1, "minus", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    write_token_files(df, str(tmp_path / "t"), PATH)
    check(file_digest(read_token_files(spark, str(tmp_path / "t"))).collect(), [(a, b) for a, b, _ in rows])
    one = read_token_files(spark, str(tmp_path / "t"), [5])
    assert [r.ids for r in one.collect()] == [[*ids("five"), 0]]
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or "EqualTo(doc_id" in one._jdf.queryExecution().toString()
    write_token_files(df.limit(0), str(tmp_path / "e"), PATH)
    assert file_digest(read_token_files(spark, str(tmp_path / "e"))).collect() == []


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(QUERIES["op6_token_files"](spark, sf).collect(), docs)
