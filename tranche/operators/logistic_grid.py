"""Many logistic models in shared passes over the rows (M4, M5).

The models of a search differ in their penalty and in the fold they leave out.
They are the columns of one coefficient matrix, so a pass is a matrix product
per block of rows: every task returns, for each model that is not finished,
its loss and gradient over the rows outside that model's fold, and a grouped
sum adds the tasks up.  Folds are masks; no row is copied.  The curvature costs
by far the most, and models whose margins hardly differ share it: it is summed
per fold at the coefficients of one of them.  Loss and gradient are each
model's own, so a shared curvature bends a step a little and never its end.

Between passes each model takes a proximal Newton step on the driver, where
only numbers of the size (features + 1) squared per model arrive: a linear
system for the ridge penalty, feature-sign search on the quadratic model for
the lasso, with coordinate descent after it where rounding stopped that.  A step that does not lower the objective enough is halved and
looked at in the next pass; models whose step promises nothing leave.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows multiplied at a time
BLOCK = 4096
#: models whose margins differ by less take their curvature at one point
NEAR = 0.05
#: scores sorted by a task
ROWS_PER_RANGE = 500_000
#: turns of coordinate descent between two passes; the next pass goes on from there
SWEEPS = 100


@dataclass(frozen=True)
class Point:
    """sum(log loss) + |b|_1 / C or |b|^2 / (2 C) over the rows whose fold is
    not ``fold`` (None: all rows); the intercept is free of penalty."""
    C: float
    penalty: str = "l2"
    fold: int | None = None


class GridLogisticModel:
    """A fitted logistic model; ``transform`` adds rawPrediction and probability."""

    def __init__(self, coefficients, intercept: float, objective: float, passes: int, features: str = "features"):
        self.coefficients, self.intercept = DenseVector(coefficients), float(intercept)
        self.objective, self.passes, self.features = float(objective), passes, features

    def transform(self, df: DataFrame) -> DataFrame:
        product = F.zip_with(vector_to_array(self.features), F.array(*[F.lit(float(c)) for c in self.coefficients]), lambda x, c: x * c)
        margin = F.aggregate(product, F.lit(self.intercept), lambda a, x: a + x)
        chance = 1 / (1 + F.exp(-F.col("__margin")))
        return (df.withColumn("__margin", margin)
                .withColumn("rawPrediction", array_to_vector(F.array(-F.col("__margin"), F.col("__margin"))))
                .withColumn("probability", array_to_vector(F.array(1 - chance, chance))).drop("__margin"))

    def write(self) -> "GridLogisticModel":
        return self

    def save(self, path: str) -> None:
        row = json.dumps({"coefficients": self.coefficients.tolist(), "intercept": self.intercept,
                          "objective": self.objective, "passes": self.passes, "features": self.features})
        SparkSession.getActiveSession().createDataFrame([(row,)], "value string").write.mode("error").text(path)

    @classmethod
    def load(cls, path: str) -> "GridLogisticModel":
        return cls(**json.loads(SparkSession.getActiveSession().read.text(path).first()[0]))


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` (x, y, fold, w) with x as its doubles' bytes, which a pass takes
    as they are; a list costs Spark a step per number."""
    def run(batches):
        for b in batches:
            x = np.ascontiguousarray(b.column("x").flatten().to_numpy(zero_copy_only=False), np.float64)
            ends = np.arange(b.num_rows + 1, dtype=np.int64) * (x.nbytes // max(b.num_rows, 1))
            held = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([held.cast(pa.binary()), *(b.column(c) for c in ("y", "fold", "w"))], ["x", "y", "fold", "w"])

    return rows.select("x", "y", "fold", "w").mapInArrow(run, "x binary, y double, fold int, w double")


def _features(x: pa.Array) -> np.ndarray:
    """A row per entry, of lists or of packed doubles."""
    if pa.types.is_binary(x.type) or pa.types.is_large_binary(x.type):
        kind = np.int64 if pa.types.is_large_binary(x.type) else np.int32
        ends = np.frombuffer(x.buffers()[1], kind)[x.offset:x.offset + len(x) + 1]
        numbers = np.frombuffer(x.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(np.float64)
    else:
        numbers = x.flatten().to_numpy(zero_copy_only=False)
    return numbers.reshape(len(x), -1)


def _rows(batch: pa.RecordBatch):
    """(features with a leading 1, label, fold, weight) in blocks."""
    for lo in range(0, batch.num_rows, BLOCK):
        b = batch.slice(lo, BLOCK)
        yield (np.column_stack([np.ones(b.num_rows), _features(b.column("x"))]),
               *(b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold", "w")))


def _margins(x: np.ndarray, b: np.ndarray):
    """Margins, probabilities and, for label 0, losses; b has a model a column."""
    m = x @ b
    small = np.exp(-np.abs(m))
    chance = np.where(m >= 0, 1, small) / (1 + small)
    return m, chance, np.log1p(small) + np.maximum(m, 0)


def _leaders(betas: dict[int, np.ndarray], hess: dict[int, np.ndarray], alone: set[int]) -> dict[int, int]:
    """The model at whose coefficients each model's curvature is taken: one
    whose margins differ by ``NEAR`` at most (root mean square, weighed by the
    model's last curvature), or the model itself (always so in ``alone``)."""
    lead: dict[int, int] = {}
    for k in sorted(betas):
        lead[k] = k
        for j in () if k in alone else sorted(set(lead.values()) - {k}):
            gap = betas[k] - betas[j]
            if not gap.any() or (k in hess and gap @ hess[k] @ gap <= NEAR ** 2 * hess[k][0, 0]):
                lead[k] = j
                break
    return lead


def _pass(data: DataFrame, betas: dict[int, np.ndarray], points: list[Point],
          lead: dict[int, int] | None = None) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Loss and gradient of each model at its coefficients, and its Hessian at
    those of its leader.  Models with one leader differ in their rows only:
    the curvature is summed per fold, and a model adds up the folds it uses."""
    ids = sorted(betas)
    lead = lead or {k: k for k in ids}
    b = np.column_stack([betas[k] for k in ids])
    out_of = np.array([-1 if points[k].fold is None else points[k].fold for k in ids])
    d = len(b)
    upper = np.triu_indices(d)
    # leader -> the folds that its models leave out; a part of the curvature
    # for each, and one (None) for all other rows
    groups: dict[int, list[int | None]] = {}
    for k in ids:
        groups.setdefault(lead[k], [])
        if points[k].fold not in groups[lead[k]]:
            groups[lead[k]].append(points[k].fold)
    parts = [(j, f) for j, out in groups.items() for f in dict.fromkeys([*out, None])
             if f is None or len(out) > 1]       # a fold that all models of a leader leave out needs no sum

    def run(batches):
        loss, grad, hess = np.zeros(len(ids)), np.zeros((d, len(ids))), np.zeros((len(parts), d, d))
        at = {part: n for n, part in enumerate(parts)}
        column = {k: n for n, k in enumerate(ids)}
        for batch in batches:
            for x, y, fold, w in _rows(batch):
                order = np.argsort(fold, kind="stable")
                x, y, fold, w = x[order], y[order], fold[order], w[order]
                cuts = [0, *(np.flatnonzero(np.diff(fold)) + 1), len(fold)]
                use = (fold[:, None] != out_of[None, :]) * w[:, None]
                m, chance, zero = _margins(x, b)
                loss += (use * (zero - y[:, None] * m)).sum(axis=0)
                grad += x.T @ (use * (chance - y[:, None]))
                for j, out in groups.items():
                    p = chance[:, column[j]]
                    bent = (w * p * (1 - p))[:, None] * x
                    for lo, hi in zip(cuts[:-1], cuts[1:]):
                        own = int(fold[lo])
                        part = at.get((j, own if own in out else None))
                        if part is not None:
                            hess[part] += x[lo:hi].T @ bent[lo:hi]
        sums = [*np.concatenate([loss[None], grad]).T, *(h[upper] for h in hess)]
        keys = [*ids, *range(len(points), len(points) + len(parts))]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(sums, pa.list_(pa.float64()))], ["key", "sums"])

    rows = (data.mapInArrow(run, "key int, sums array<double>")
            .select("key", F.posexplode("sums").alias("at", "v")).groupBy("key", "at").agg(F.sum("v").alias("v")).toArrow())
    key, at, v = (rows[c].to_numpy() for c in ("key", "at", "v"))

    def summed(k: int, size: int) -> np.ndarray:
        own = key == k
        out = np.zeros(size)
        out[at[own]] = v[own]
        return out

    curved = {part: summed(len(points) + n, len(upper[0])) for n, part in enumerate(parts)}
    result = {}
    for k in ids:
        s, h = summed(k, 1 + d), np.zeros((d, d))
        h[upper] = sum(c for (j, f), c in curved.items() if j == lead[k] and (f is None or f != points[k].fold))
        result[k] = (s[0], s[1:], h + np.triu(h, 1).T)
    return result


def _penalty(p: Point, beta: np.ndarray) -> float:
    return np.abs(beta[1:]).sum() / p.C if p.penalty == "l1" else beta[1:] @ beta[1:] / (2 * p.C)


def _lasso(h: np.ndarray, c: np.ndarray, start: np.ndarray, lam: float) -> np.ndarray:
    """The x that minimises x'hx / 2 + c'x + lam |x[1:]|_1, from ``start`` on,
    by feature-sign search: the signs say which linear system holds.  Its
    solution is walked to as far as the objective falls, at most to where
    coefficients change their sign and leave; if none does and the system is
    solved, the column with the steepest slope above ``lam`` comes in.  Columns
    that others add up to leave too, where coordinate descent creeps."""
    d = len(start)
    cost = np.r_[0.0, np.full(d - 1, lam)]
    value = lambda v: v @ h @ v / 2 + c @ v + cost @ np.abs(v)
    x, sign, least = start.copy(), np.sign(start), 1e-10 * max(1.0, np.abs(c).max())
    sign[0] = 0                                   # the intercept is always in and has no sign
    now = value(x)
    for _ in range(20 * d):
        slope, used = h @ x + c, (sign != 0) | (np.arange(d) == 0)
        if np.abs((slope + cost * sign)[used]).max() <= least:
            steep = np.where(used, 0, np.abs(slope) - cost)
            j = int(np.argmax(steep))
            if steep[j] <= least:
                break
            sign[j], used[j] = -np.sign(slope[j]), True
        new = np.zeros(d)
        new[used] = np.linalg.lstsq(h[np.ix_(used, used)], -(c + cost * sign)[used], rcond=None)[0]
        turns = used & (x * new < 0) & (cost > 0)
        shares = np.r_[1.0, np.unique((x / np.where(turns, x - new, 1))[turns])]
        ways = [x + t * (new - x) for t in shares]
        for t, way in zip(shares[1:], ways[1:]):
            way[turns & (x / np.where(turns, x - new, 1) == t)] = 0
        values = [value(way) for way in ways]
        best = int(np.argmin(values))
        if not values[best] < now:
            break
        x, now = ways[best], values[best]
        sign = np.where(cost > 0, np.sign(x), 0)
    return x


def _direction(p: Point, beta: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """The step that minimises the quadratic model, and what it promises."""
    h = hess + np.eye(len(beta)) * 1e-12 * max(np.trace(hess), 1e-300)
    if p.penalty == "l2":
        ridge = np.r_[0, np.full(len(beta) - 1, 1 / p.C)]
        g = grad + ridge * beta
        step = -np.linalg.lstsq(h + np.diag(ridge), g, rcond=None)[0]
        return step, float(g @ step)
    lam, first = 1 / p.C, None
    step = _lasso(h, grad - h @ beta, beta, lam) - beta
    bent = h @ step
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(beta)):
            if h[j, j] <= 0:
                continue
            slope = grad[j] + bent[j] - h[j, j] * step[j]
            if j:
                z = beta[j] - slope / h[j, j]
                new = np.sign(z) * max(abs(z) - lam / h[j, j], 0) - beta[j]
            else:
                new = -slope / h[j, j]
            if new != step[j]:
                moved = max(moved, h[j, j] * (new - step[j]) ** 2)
                bent += h[:, j] * (new - step[j])
                step[j] = new
        first = moved if first is None else first
        if moved <= max(1e-14, 1e-7 * first):      # the next pass corrects what is left
            break
    return step, float(grad @ step + lam * (np.abs(beta + step)[1:].sum() - np.abs(beta[1:]).sum()))


def fit_points(data: DataFrame, points: list[Point], max_passes: int = 100, tol: float = 1e-9,
               lasso_tol: float | None = None, start: list[np.ndarray] | None = None) -> list[GridLogisticModel]:
    """A model per point.  ``data`` has x (array<double>, no missing values,
    or ``packed``), y (0/1), fold (int) and w (weight), and is read once a pass: pass a
    written table.  A model ends when a step promises less than ``tol`` of its
    objective (``lasso_tol`` for the l1 penalty, if given).  ``start``: where
    each point's search begins (intercept first; default: at zero)."""
    first = data.select("x").first()["x"]
    d = (len(first) // 8 if isinstance(first, (bytes, bytearray)) else len(first)) + 1
    beta = {k: np.zeros(d) if start is None else np.array(start[k], float) for k in range(len(points))}
    value = dict.fromkeys(beta, np.inf)
    step, promise, size, passes = {}, {}, {}, 0
    done: dict[int, GridLogisticModel] = {}
    tried = dict(beta)
    bends: dict[int, np.ndarray] = {}
    alone: set[int] = set()             # models that a step has failed
    while tried and passes < max_passes:
        passes += 1
        for k, (loss, grad, hess) in _pass(data, tried, points, _leaders(tried, bends, alone)).items():
            bends[k] = hess
            f = loss + _penalty(points[k], tried[k])
            if f > value[k] + 1e-4 * size.get(k, 0) * promise.get(k, 0) + 1e-12 * abs(value[k]) and size[k] > 1e-6:
                size[k] /= 2
                alone.add(k)
                tried[k] = beta[k] + size[k] * step[k]
                continue
            if f <= value[k]:
                beta[k], value[k] = tried[k], f
            step[k], promise[k] = _direction(points[k], beta[k], grad, hess)
            size[k] = 1.0
            least = tol if lasso_tol is None or points[k].penalty != "l1" else lasso_tol
            if -promise[k] <= least * max(1.0, abs(value[k])):
                last = beta[k] + step[k]        # too small a step to need another look
                done[k] = GridLogisticModel(last[1:], last[0], value[k], passes)
                del tried[k]
            else:
                tried[k] = beta[k] + step[k]
    for k in tried:     # out of passes: the best coefficients seen
        done[k] = GridLogisticModel(beta[k][1:], beta[k][0], value[k], passes)
    return [done[k] for k in range(len(points))]


def held_out_scores(data: DataFrame, points: list[Point], models: list[GridLogisticModel]) -> DataFrame:
    """point (its index), fold, label, p of every row under the models that left
    its fold out; one map over the rows."""
    by_fold: dict[int, list[int]] = {}
    for k, p in enumerate(points):
        by_fold.setdefault(p.fold, []).append(k)
    b = {f: np.column_stack([np.r_[models[k].intercept, models[k].coefficients.toArray()] for k in ks]) for f, ks in by_fold.items()}

    def run(batches):
        for batch in batches:
            for x, y, fold, _ in _rows(batch):
                for f, ks in by_fold.items():
                    own = np.flatnonzero(fold == f)
                    if len(own):
                        _, chance, _ = _margins(x[own], b[f])
                        n = len(own)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.tile(np.array(ks, np.int32), n)), pa.array(np.full(n * len(ks), f, np.int32)),
                             pa.array(np.repeat(y[own], len(ks)).astype(np.int32)), pa.array(chance.reshape(-1))],
                            ["point", "fold", "label", "p"])

    return data.mapInArrow(run, "point int, fold int, label int, p double")


def held_out_auc(scores: DataFrame, rows: int) -> dict[int, float | None]:
    """ROC-AUC of each point, ties counted half, from ``rows`` scores.  They are
    dealt by ranges of (point, p), so equal scores meet in one range; a task
    sorts its own, and a range's positives stand above all negatives of the
    point's earlier ranges.  A row per range and point reaches the driver."""
    ranges = max(scores.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_RANGE))

    def run(batches):
        parts: dict[int, list] = {}
        for batch in batches:
            point, label, p = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("point", "label", "p"))
            for k in np.unique(point):
                own = point == k
                parts.setdefault(int(k), []).append((p[own], label[own]))
        for k, own in parts.items():
            p, label = (np.concatenate(c) for c in zip(*own))
            order = np.argsort(p)
            p, positive = p[order], label[order].astype(np.int64)
            first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            pos = np.add.reduceat(positive, first)
            neg = np.diff(np.r_[first, len(p)]) - pos
            won = float((pos * (np.cumsum(neg) - neg + neg / 2)).sum())
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (TaskContext.get().partitionId(), k, int(pos.sum()), int(neg.sum()), won)],
                                             ["range", "point", "pos", "neg", "won"])

    dealt = scores.select("point", "label", "p").repartitionByRange(ranges, "point", "p")
    out: dict[int, list] = {}
    for r in sorted(dealt.mapInArrow(run, "range long, point long, pos long, neg long, won double").collect()):
        s = out.setdefault(r["point"], [0, 0, 0.0])         # positives, negatives, pairs won so far
        s[2] += r["won"] + r["pos"] * s[1]
        s[0] += r["pos"]
        s[1] += r["neg"]
    return {k: won / (pos * neg) if pos and neg else None for k, (pos, neg, won) in out.items()}
