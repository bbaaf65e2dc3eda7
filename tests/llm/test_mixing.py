import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from tranche.llm.catalog import QUERIES
from tranche.llm.mixing import DOMAINS, MAIN_RATE, MOST_REPEATS, TARGETS, TOLERANCE, Mixer, corpus_sums, fit_mixer, fit_rates, fit_softmax, label_domains, mixed, mixing_rates


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3, 0.3, 0.5, 0.2], 400)
    t = rng.integers(0, 900, 400)
    df = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(t, p)], "n_tokens long, posterior array<double>")
    target = np.array([0.1, 0.05, 0.8, 0.05])
    mixer = fit_rates(df, Mixer(None), target, 1.0)
    x = mixer.rates(p)
    totals = (t * x) @ p
    assert (x >= 0).all() and np.abs(totals / totals.sum() - target).max() < 2e-3
    assert np.allclose(corpus_sums(df, mixer, 4)[0], totals)
    assert abs(totals[2] / (t @ p)[2] - 1) < 2e-3


def test_targets_out_of_reach_stay_nonnegative(spark):
    df = spark.createDataFrame([(10, [0.5, 0.5]), (20, [0.6, 0.4])], "n_tokens long, posterior array<double>")
    mixer = fit_rates(df, Mixer(None), np.array([1.0, 0.0]))
    assert (mixer.rates(np.array([[0.5, 0.5], [0.6, 0.4]])) >= 0).all()
    assert fit_rates(df.limit(0), Mixer(None), np.array([1.0, 0.0])).pull == []


def test_a_domain_hardly_there_does_not_blow_up(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.02, 1e-3, 3.0, 0.3], 300)
    df = spark.createDataFrame([(100, [float(v) for v in b]) for b in p], "n_tokens long, posterior array<double>")
    mixer = fit_rates(df, Mixer(None), np.array([0.07, 0.01, 0.9, 0.02]))
    x = mixer.rates(p)
    assert x.max() < 12 and abs((x @ p)[2] / p[:, 2].sum() - MAIN_RATE) < 0.03


def test_scarce_domains_meet_the_stated_targets(spark):
    rows, labels = [], []
    for d, n in enumerate((4, 2, 390, 8)):      # documents of low_clean, low_toxic, high_clean, high_toxic
        for _ in range(n):
            i = len(rows)
            rows.append((i, " ".join(f"{DOMAINS[d]}{(i * 7 + j) % 20}" for j in range(60))))
            labels.append((i, d >> 1, d & 1))
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    goal = np.array([TARGETS[d] for d in DOMAINS])
    got = mixing_rates(docs, known).collect()
    totals = np.array([[r.n_tokens * r.rate * r[f"p_{d}"] for d in DOMAINS] for r in got]).sum(0)
    assert np.abs(totals / totals.sum() - goal).max() < 5e-3
    out = {d: 0 for d in DOMAINS}
    for r in mixed(docs, known).collect():
        out[r.text.split()[0].rstrip("0123456789")] += 1
    assert abs(out["low_clean"] / sum(out.values()) - 0.07) < 0.02
    capped, _ = fit_mixer(docs, label_domains(known), TARGETS, most_repeats=MOST_REPEATS)
    assert np.allclose(capped.asked, goal) and capped.reached[0] < 0.05 and capped.reached[2] > 0.92


@pytest.mark.parametrize("seed", [5, 8, 9])
def test_last_step_is_the_nearest(spark, seed):
    rng = np.random.default_rng(seed)      # targets far from the mix: most rates are zero
    p = rng.dirichlet([0.05, 2.0, 0.3, 0.02], 200)
    t = rng.integers(1, 900, 200)
    target = np.array([0.5, 0.05, 0.05, 0.4])
    df = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(t, p)], "n_tokens long, posterior array<double>").coalesce(1)
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        mixer = fit_rates(df, Mixer(None), target)
    goal = np.minimum(target * MAIN_RATE * (t @ p)[0] / target[0], MOST_REPEATS * (t @ p))
    off = [(t * Mixer(None, mixer.pull[:i]).rates(p)) @ p - goal for i in range(len(mixer.pull) + 1)]
    assert len(off) > 1 and all(b @ b < a @ a for a, b in zip(off, off[1:]))
    assert np.isclose(mixer.distance, np.abs(off[-1]).max() / t.sum())
    assert any("from its target" in str(w.message) for w in said) == (mixer.distance >= TOLERANCE)
    x, y = mixer.rates(p), mixer.rates(p)         # many plain steps from there come hardly nearer
    for _ in range(3000):
        y = np.maximum(0, y - p @ ((t * y) @ p - goal) / np.linalg.eigvalsh((p * t[:, None]).T @ p)[-1])
    assert np.linalg.norm((t * x) @ p - goal) < np.linalg.norm((t * y) @ p - goal) + 1e-3 * t.sum()


def test_softmax_tells_domains_apart():
    rng = np.random.default_rng(1)
    stats = rng.normal(size=(600, 16))
    y = (stats[:, 3] > 0).astype(int) + 2 * (stats[:, 5] > 0)
    lists = [(np.array([int(v) + 50]), np.array([1.0])) for v in y]
    m = fit_softmax(stats, lists, y, 4)
    p = m.posteriors(stats, np.arange(600), np.array([x[0][0] for x in lists]), np.ones(600))
    assert np.allclose(p.sum(1), 1) and (p.argmax(1) == y).mean() > 0.97
    assert np.allclose(fit_softmax(np.empty((0, 16)), [], np.empty(0, int), 4).bias, np.log(0.25))


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op2_soft_mixing"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    words = {r.doc_id: r.n for r in docs.select("doc_id", F.size(F.expr("filter(split(text, '[ \\t-\\r]+'), x -> x <> '')")).alias("n")).collect()}
    assert all(r.n_tokens == words[r.doc_id] for r in rows)
    p = np.array([[r[f"p_{d}"] for d in DOMAINS] for r in rows])
    t, x, c = (np.array([r[k] for r in rows], float) for k in ("n_tokens", "rate", "copies"))
    totals = (t * x) @ p
    goal = np.array([TARGETS[d] for d in DOMAINS])
    assert np.abs(totals / totals.sum() - goal).max() < 5e-3
    assert abs(totals[2] - MAIN_RATE * (t @ p)[2]) < 0.01 * totals[2]
    assert ((c == np.floor(x)) | (c == np.floor(x) + 1)).all() and abs((c * t).sum() / (x * t).sum() - 1) < 0.03


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "good words here", 15, 1.0), (1, "good words here", 15, 2.0), (None, None, None, 3.0), (4, "", 0, 4.0), (5, "x " * 30_000, 5, 5.0)],
                                 "doc_id long, text string, n_chars long, rate double")
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (5, 1, 1), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    got = mixing_rates(docs, labels).collect()
    assert len(got) == 5 and all(r.rate >= 0 and r.copies >= 0 for r in got)
    assert mixing_rates(docs.limit(0), labels).collect() == []
    out = mixed(docs, labels.limit(0))
    assert out.columns == docs.columns
    assert {r["rate"] for r in out.collect()} <= {1.0, 2.0, 3.0, 4.0, 5.0}


def test_sums_over_the_corpus_do_not_send_the_classifier(spark):
    class Heavy:
        def __reduce__(self):
            raise TypeError("sent to a task")

    df = spark.createDataFrame([(10, [0.5, 0.5]), (20, [0.9, 0.1])], "n_tokens long, posterior array<double>")
    mixer = fit_rates(df, Mixer(Heavy()), np.array([0.6, 0.4]))
    assert isinstance(mixer.model, Heavy) and mixer.distance < TOLERANCE
