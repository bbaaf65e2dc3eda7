"""Mixing sources to target weights by soft membership (operator 2).

A softmax classifier, fitted on the labelled table, gives every document the
probability of each domain.  A document's expected tokens of a domain are its
tokens times that probability times its rate.  Nonnegative rates that bring
the domains' totals to the targets are found by projected gradient steps for
a least squares problem: a step is a few grouped sums over the corpus, of some
squared number of domains, and every document replays the steps so far on its
own posterior, so no state is kept between them.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, slices, stored, text_key
from .quality import BUCKETS, MAX_TRAIN, WIDE_SLICE, _metadata, _statistics, assemble, sample_features, text_column

DOMAINS = ("low_clean", "low_toxic", "high_clean", "high_toxic")
TARGETS = {"low_clean": 0.07, "low_toxic": 0.01, "high_clean": 0.90, "high_toxic": 0.02}
MAIN_RATE = 1.15         # mean rate of the domain with the largest target
MOST_REPEATS = 4.0       # mean rate that a capped fit lets a target ask of a domain; no cap in the queries
VISITS_OF_CORPUS = 60    # grouped sums, at most
TURNS = 12               # Newton turns of a step
TOLERANCE = 1e-4         # of all tokens, at which steps end
LEAST_GAIN = 1e-3        # of the squared distance, that a step brings at full length
FLAT = 1e-7              # of the squared distance, that a plain step gains where the projected gradient is near zero
VISITS = 150_000         # rows visited in fitting, over at least MIN_EPOCHS passes
MIN_EPOCHS = 8
WORD_SCALE = 8.0         # a word's weight against a statistic's
BATCH = 128


@dataclass
class Softmax:
    edges: np.ndarray
    bias: np.ndarray
    weights: np.ndarray      # inputs x domains

    def posteriors(self, stats, o, k, w) -> np.ndarray:
        if not len(stats):
            return np.empty((0, len(self.bias)))
        o, i, x = assemble(self.edges, stats, o, k, WORD_SCALE * w)
        at = np.searchsorted(o, np.arange(len(stats)))
        z = self.bias + np.add.reduceat(self.weights[i] * x[:, None], at, axis=0)
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit_softmax(stats, lists, y, domains: int, seed: int = 1) -> Softmax:
    """Adagrad on the log loss.  A domain without rows keeps a small prior;
    without any row the posteriors are even."""
    m = stats.shape[1]
    edges = np.array([np.quantile(c, np.arange(1, 10) / 10) if len(c := stats[~np.isnan(stats[:, j]), j]) else np.zeros(9) for j in range(m)])
    prior = np.bincount(y, minlength=domains) + 1.0
    model = Softmax(edges, np.log(prior / prior.sum()), np.zeros((BUCKETS + m * 11, domains)))
    rng, g = np.random.default_rng(seed), np.full(model.weights.shape, 1e-3)
    epochs = max(MIN_EPOCHS, -(-VISITS // len(y))) if len(y) else 0
    for epoch in range(epochs):
        rate, order = 0.3 / (1 + 3 * epoch / epochs), rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            rows = order[lo:lo + BATCH]
            counts = [len(lists[r][0]) for r in rows]
            owner = np.repeat(np.arange(len(rows)), counts)
            k, w = np.concatenate([lists[r][0] for r in rows]), np.concatenate([lists[r][1] for r in rows])
            d = model.posteriors(stats[rows], owner, k, w)
            d[np.arange(len(rows)), y[rows]] -= 1
            d /= len(rows)
            o, i, x = assemble(edges, stats[rows], owner, k, WORD_SCALE * w)
            used, back = np.unique(i, return_inverse=True)
            grad = np.column_stack([np.bincount(back, d[o, j] * x, len(used)) for j in range(domains)]) + 1e-6 * model.weights[used]
            g[used] += grad * grad
            model.weights[used] -= rate * grad / np.sqrt(g[used])
            model.bias -= 0.05 * d.sum(0)
    return model


@dataclass
class Mixer:
    model: Softmax
    pull: list[np.ndarray] = field(default_factory=list)   # one vector of domains per step
    asked: np.ndarray | None = None      # share of the expected tokens that each domain should have
    reached: np.ndarray | None = None    # and has at these rates
    distance: float = 0.0                # largest distance of a fitted total from its goal, of all tokens

    def rates(self, p: np.ndarray) -> np.ndarray:
        """Replay the projected steps: x <- max(0, x - p . pull), from 1."""
        x = np.ones(len(p))
        for v in self.pull:
            x = np.maximum(0, x - p @ v)
        return x


def with_posteriors(docs: DataFrame, mixer: Mixer, tokens: str, posterior: str, rate: str) -> DataFrame:
    """``docs`` with its words, posteriors and rate appended; a narrow map."""
    names, chars = docs.columns, f"__chars_{rate}"
    x, text = text_column(docs, f"__text_{rate}")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{tokens}` long, `{posterior}` array<double>, `{rate}` double"

    def run(batches):
        for b in slices(batches, text, WIDE_SLICE):
            stats, o, k, w = _statistics(b, text, chars)
            p = mixer.model.posteriors(stats, o, k, w)
            words = np.rint(np.expm1(stats[:, 1])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(names))), pa.array(words), pa.array(list(p), pa.list_(pa.float64())), pa.array(mixer.rates(p))],
                [*names, tokens, posterior, rate])

    return x.withColumn(chars, _metadata(docs)).mapInArrow(run, schema)


def fit_rates(members: DataFrame, mixer: Mixer, targets: np.ndarray, main_rate: float = MAIN_RATE, most_repeats: float | None = MOST_REPEATS) -> Mixer:
    """Projected gradient on 1/2 r' r, r = expected domain totals - targets.

    ``members`` has n_tokens and posterior.  Gradients are taken in the metric
    of the documents' tokens, so a rate depends on the posterior alone.  A step
    x <- max(0, x - p . pull) is implicit: its pull is the gradient at the rates
    it leads to, times a length, so it never leads further away.  The pull is
    found by Newton turns on a convex problem of as many numbers as there are
    domains, shortened until they descend; the first turn is the gradient in
    the metric of the inverse Gram matrix of the documents with a rate, and
    mostly enough.  Only pulls that came nearer are kept, so the last are the
    best.  Steps that gain little are lengthened until the projected gradient
    is near zero.  ``distance`` tells what is left, with a warning where the
    targets are not met.

    ``most_repeats`` lowers the target of a domain to that many times its
    tokens and leaves the others as they are, so the shares change; None fits
    the targets as stated.  The mixer's ``asked`` and ``reached`` tell the
    stated and the fitted shares either way."""
    n = len(targets)
    have, gram, total, squares = corpus_sums(members, mixer, n)
    half = squares / 2
    share = targets / targets.sum()
    mixer.asked, mixer.reached = share, np.zeros(n)
    if not total:
        return mixer
    main = int(np.argmax(share))
    goal = share * main_rate * have[main] / share[main]
    if most_repeats is not None:
        goal = np.minimum(goal, most_repeats * have)
    steepest, visits, damping, now, held = np.linalg.eigvalsh(gram)[-1], 0, 1e-5 * total, have, gram
    while np.abs(now - goal).max() >= TOLERANCE * total and visits < VISITS_OF_CORPUS:
        r = now - goal
        pull, low, at, active = np.zeros(n), half, now, held
        best = r @ r, None
        for _ in range(TURNS):
            climb = at - goal - damping * pull       # against the slope of the step's convex problem
            if climb @ climb < 0.01 * (r @ r):
                break
            way, length = np.linalg.solve(active + damping * np.eye(n), climb), 1.0
            while visits < VISITS_OF_CORPUS and length > 1e-4:
                tried = pull + length * way
                sums, some, _, squares = corpus_sums(members, replace(mixer, pull=[*mixer.pull, tried]), n)
                visits += 1
                height = squares / 2 + goal @ tried + damping / 2 * (tried @ tried)
                off = sums - goal
                if off @ off < best[0]:
                    best = off @ off, tried, sums, some, squares / 2
                if height <= low - 1e-4 * length * (climb @ way):
                    break
                length /= 4
            else:
                break
            pull, low, at, active = tried, height, sums, some
            if np.abs(off).max() < TOLERANCE * total:
                break
        gain = 1 - best[0] / (r @ r)
        if best[1] is not None:
            mixer.pull.append(best[1])
            _, _, now, held, half = best
        if gain < LEAST_GAIN:
            if slope(members, mixer, now - goal) < FLAT * steepest * ((now - goal) @ (now - goal)):
                break
            damping = max(damping / 10, 1e-12 * total)
    mixer.distance = float(np.abs(now - goal).max() / total)
    if mixer.distance >= TOLERANCE:
        warnings.warn(f"mixing: a domain's expected tokens stay {mixer.distance:.2g} of all tokens from its target", stacklevel=2)
    if now.sum():
        mixer.reached = now / now.sum()
    return mixer


def corpus_sums(members: DataFrame, mixer: Mixer, domains: int) -> tuple[np.ndarray, np.ndarray, float, float]:
    """At the mixer's rates: expected tokens of each domain, the Gram matrix of
    the posteriors of documents with a rate, all tokens, and the tokens times
    squared rates.  One grouped sum of some (domains + 1) squared numbers, added
    up in the tasks first."""
    size = domains + domains * domains + 2
    mixer = replace(mixer, model=None)       # rates need the pulls alone

    def run(batches):
        out = np.zeros(size)
        for b in batches:
            if b.num_rows:
                p, t = b.column("posterior").flatten().to_numpy().reshape(b.num_rows, -1), b.column("n_tokens").to_numpy()
                x = mixer.rates(p)
                out[:domains] += (x * t) @ p
                out[domains:-2] += ((p * (t * (x > 0))[:, None]).T @ p).ravel()
                out[-2:] += t.sum(), t @ (x * x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(out)], ["at", "v"])

    rows = members.select("n_tokens", "posterior").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["at"]] = r["v"]
    return out[:domains], out[domains:-2].reshape(domains, domains), out[-2], out[-1]


def slope(members: DataFrame, mixer: Mixer, r: np.ndarray) -> float:
    """Squared length, in the documents' tokens, of the projected gradient of
    the squared distance at the mixer's rates; a rate of zero cannot fall."""
    mixer = replace(mixer, model=None)

    def run(batches):
        out = 0.0
        for b in batches:
            if b.num_rows:
                p, t = b.column("posterior").flatten().to_numpy().reshape(b.num_rows, -1), b.column("n_tokens").to_numpy()
                g = p @ r
                out += float(t @ np.square(np.where(mixer.rates(p) > 0, g, np.minimum(g, 0))))
        yield pa.RecordBatch.from_arrays([pa.array([out])], ["v"])

    return members.select("n_tokens", "posterior").mapInArrow(run, "v double").agg(F.sum("v")).first()[0] or 0.0


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id, label: the number in DOMAINS of the quality and toxic labels;
    an id labelled twice takes the larger number, null labels are not used."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") > 0).cast("int") * 2 + (F.col("toxic") > 0).cast("int")).alias("label"))


def fit_mixer(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], main_rate: float = MAIN_RATE, max_train: int = MAX_TRAIN,
              most_repeats: float | None = None) -> tuple[Mixer, DataFrame]:
    """The fitted mixer and the stored table doc_id, tkey, n_tokens, posterior."""
    goal = np.array([targets[d] for d in targets], float)
    mixer = Mixer(fit_softmax(*sample_features(docs, labelled, max_train), len(goal)))
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"), _metadata(docs).alias("n_chars"), text_key().alias("tkey"))
    members = stored(with_posteriors(slim, mixer, "n_tokens", "posterior", "rate").select("doc_id", "tkey", "n_tokens", "posterior"), "members")
    return fit_rates(members, mixer, goal, main_rate, most_repeats), members


def copies_of(rate, *identity):
    """Whole copies for a rate: its floor, and one more with the probability of
    the rest, drawn from a hash of the row's identity."""
    u = F.pmod(F.xxhash64(*identity, F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + u).cast("int")


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, most_repeats: float | None = None) -> DataFrame:
    """doc_id, n_tokens, p_<domain>, rate, copies per row.

    Tokens are words.  The domain totals are scaled so that the domain with
    the largest target has a mean rate near MAIN_RATE.  Null and empty texts
    have no tokens and the rate of their posterior.  Repeated and null ids are
    rows like others.  A scarce domain's documents are repeated as often as
    its target needs, unless ``most_repeats`` caps that at so many times its
    tokens; a domain that no document is likely to be of, such as one without
    labelled rows, falls short.  An empty table gives no rows.
    """
    mixer, members = fit_mixer(docs, label_domains(labels), targets, most_repeats=most_repeats)
    kind = members.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            p = b.column("posterior").flatten().to_numpy().reshape(b.num_rows, -1) if b.num_rows else np.empty((0, len(targets)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(mixer.rates(p))], [*b.schema.names, "rate"])

    rated = members.mapInArrow(run, f"doc_id {kind}, tkey binary, n_tokens long, posterior array<double>, rate double")
    return rated.select("doc_id", "n_tokens", *(F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(targets)), "rate",
                        copies_of(F.col("rate"), F.col("doc_id"), F.col("tkey")).alias("copies"))


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, most_repeats: float | None = None) -> DataFrame:
    """``docs`` with every row as often as its copies say."""
    mixer, _ = fit_mixer(docs, label_domains(labels), targets, most_repeats=most_repeats)
    rated = with_posteriors(docs, mixer, "__tokens", "__posterior", "__rate")
    n = copies_of(F.col("__rate"), F.col("doc_id"), text_key())
    return rated.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), n))).select(*docs.columns)


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; domains are the quality and toxic labels."""
    return mixing_rates(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
