import zlib

import numpy as np
from pyspark.sql import functions as F

from tranche.llm.catalog import QUERIES
from tranche.llm.features import text_features
from tranche.llm.quality import BUCKETS, FactorisationMachine, fit, raw_scores, score_documents, with_scores


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    fm = FactorisationMachine(np.zeros((0, 9)), 0.3, rng.normal(size=40), rng.normal(size=(40, 3)))
    o = np.array([0, 0, 0, 1, 1, 2])
    i = np.array([3, 7, 9, 1, 39, 5])
    x = rng.normal(size=6)
    got, _ = raw_scores(fm, 3, o, i, x)
    for r in range(3):
        at = np.flatnonzero(o == r)
        want = 0.3 + sum(fm.linear[i[a]] * x[a] for a in at)
        want += sum(fm.factors[i[a]] @ fm.factors[i[b]] * x[a] * x[b] for a in at for b in at if a < b)
        assert abs(got[r] - want) < 1e-9


def test_words_match_a_plain_split():
    texts = ["The the THE end", "", "a\tb\x0bc  d\n", "x" * 5000, "é à é"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.cumsum([0, *map(len, raw)])
    stats, o, b, w = text_features(data, offs, BUCKETS)
    assert np.allclose(np.expm1(stats[:, 1]), [4, 0, 4, 1, 3])
    assert np.allclose(stats[:, 8], [0.5, 0, 0, 0, 1 / 3])
    assert np.bincount(o, minlength=5).tolist() == [2, 0, 4, 1, 2]
    assert np.allclose(np.sqrt(np.bincount(o, w * w, 5)), [1, 0, 1, 1, 1])
    assert np.isfinite(stats).all()


def test_one_class_and_no_labels():
    stats = np.random.default_rng(0).normal(size=(6, 16))
    lists = [(np.array([1]), np.array([1.0]))] * 6
    assert fit(stats, lists, np.ones(6)).factors.any() == False  # noqa: E712
    fm = fit(np.empty((0, 16)), [], np.empty(0))
    assert fm.bias == 0


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    p = y.sum()
    return (rank[y > 0].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op9_quality"](spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    pairs = [(x.quality, rows[x.doc_id].score) for x in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[x.doc_id].held_out]
    y, s = np.array(pairs).T
    print("held-out AUC", auc(y, s), "good kept", (s[y == 1] >= 0.3).mean(), "bad rejected", (s[y == 0] < 0.3).mean())
    assert auc(y, s) > 0.9
    assert (s[y == 1] >= 0.3).mean() > 0.98


def test_inputs_leave_out_labels_and_names(spark):
    """Scores do not change with id, language, source or the held-out labels."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    a = {r.doc_id: r.score for r in score_documents(docs, labels).collect()}
    flipped = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    b = {r.doc_id: r.score for r in score_documents(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")), flipped).collect()}
    assert a == b


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "good words here", 15, 1.0), (1, "good words here", 15, 2.0), (None, None, None, 3.0), (4, "", 0, 4.0), (5, "x " * 40_000, -5, 5.0)],
                                 "doc_id long, text string, n_chars long, score double")
    labels = spark.createDataFrame([(1, 1), (None, 0), (4, None), (5, 0), (5, 1)], "doc_id long, quality int")
    got = score_documents(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert score_documents(docs.limit(0), labels).collect() == []
    assert all(r.score == 0.5 for r in score_documents(docs.drop("n_chars"), labels.limit(0)).collect())
    fm = fit(np.empty((0, 16)), [], np.empty(0))
    assert with_scores(docs, fm, "s").columns == ["doc_id", "text", "n_chars", "score", "s"]


def test_labelled_texts_become_features_a_few_at_a_time(spark, monkeypatch):
    from tranche.llm import quality

    most, statistics = quality.WIDE_SLICE, quality._statistics

    def bounded(batch, text, chars):
        assert batch.num_rows == 1 or batch.column(text).nbytes <= most + 16 * batch.num_rows
        return statistics(batch, text, chars)

    docs = spark.createDataFrame([(k, f"word{k} " * 3000) for k in range(60)], "doc_id long, text string").coalesce(1)
    labelled = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, label int")
    whole = quality.sample_features(docs, labelled, 100)
    monkeypatch.setattr(quality, "_statistics", bounded)
    stats, lists, y = quality.sample_features(docs, labelled, 100)
    assert len(y) == 60 and np.array_equal(stats, whole[0], equal_nan=True) and all(np.array_equal(a[1], b[1]) for a, b in zip(lists, whole[1]))
