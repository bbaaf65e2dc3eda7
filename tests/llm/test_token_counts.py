import random

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tranche.llm.catalog import QUERIES
from tranche.llm.token_counts import PieceCounter, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
C = PieceCounter(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_counts_equal_the_library(text):
    assert C.count(text) == len(LIB.encode(text))


def test_repeats_spaces_and_special_strings():
    rng = random.Random(1)
    alphabet = ["the", "a", " ", "  ", "\n", "\t", "ing", "é", "日本", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "　", "aaaa", "=", "...", "\x00"]
    for _ in range(2000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert C.count(t) == len(LIB.encode(t)), repr(t)
    assert C.count("a" * 50_000) == len(LIB.encode("a" * 50_000))


def test_rows(spark):
    rows = [(1, "two words", 5), (1, "two words", 5), (None, "", 6), (3, None, 7), (4, "x " * 5000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_counts(df, PATH).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), len(LIB.encode(t or "")), len(LIB.encode(t or "")) > 4096) for i, t, _ in rows), key=str)
    assert got == want
    assert token_counts(df.limit(0), PATH).collect() == []


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op4_token_counts"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(docs) == len(got)
    for d in docs:
        n = len(LIB.encode(d.text or ""))
        assert (got[d.doc_id].n_tokens, got[d.doc_id].over_limit, got[d.doc_id].n_bytes) == (n, n > 4096, len((d.text or "").encode()))
