"""Each stage against a plain version of it on its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_jaccard_join import brute as brute_components
from tests.llm.test_packing import check_rows
from tests.llm.test_suffix_dedup import brute as brute_repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """The rows that each stage gets, and the last stage's rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        out.append(docs.collect())
    return out


def test_stages_in_order(inputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "suffix_dedup", "mixing", "packing"]
    for rows in inputs[1:5]:
        assert rows and list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_good_rows(spark, inputs):
    before, after = {r.doc_id for r in inputs[0]}, {r.doc_id for r in inputs[1]}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert after <= before
    good = [i for i in before if label.get(i) == 1]
    assert sum(i in after for i in good) >= 0.97 * len(good)


def test_one_row_of_each_component(inputs):
    docs = [(r.doc_id, r.text) for r in inputs[1]]
    comps = {d: c for d, _, c in brute_components(docs, 5, 80, 100)}
    assert sorted(r.doc_id for r in inputs[2]) == sorted(set(comps.values()))
    assert {r.doc_id: r for r in inputs[2]} == {r.doc_id: r for r in inputs[1] if comps[r.doc_id] == r.doc_id}


def test_repeats_are_cut(inputs):
    want = {}
    for r, (n, gone, _, _) in zip(inputs[2], brute_repeats([r.text for r in inputs[2]], 400)):
        want[r.doc_id] = (n, n - gone)
    got = {r.doc_id: len(r.text.encode()) for r in inputs[3]}
    for i, (n, left) in want.items():
        assert (i in got) == (left > 0) and (i not in got or 0 <= left - got[i] <= 12)
    assert all(r.n_chars == len(r.text) for r in inputs[3])


def test_mix_repeats_or_drops_whole_rows(inputs):
    before, after = Counter(inputs[3]), Counter(inputs[4])
    assert set(after) <= set(before)


def test_packing(inputs):
    check_rows(inputs[5], [(r.doc_id, r.text) for r in inputs[4]])


def test_run_is_the_stages(spark, inputs):
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in got.collect()) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in inputs[5])


def test_stages_take_odd_rows(spark):
    text = " ".join(f"Word{i}" for i in range(200))
    rows = [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (None, text, None, None, None), (None, None, None, None, None), (3, "", "en", "b", 0), (3, "", "en", "b", 0), (4, " ", "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    once = corpus_pipeline.one_of_each_group(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, re.sub(r"\s.*", "", r.text or "")) for r in once) == [(0, ""), (1, "Word0"), (3, ""), (4, "")]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
        assert len(stage(spark, docs, SF).collect()) >= 0
