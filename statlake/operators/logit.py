"""Many L2-penalised logistic regressions at once.

The models of a batch differ in the features they use, the class they tell from
the rest and the fold they are not trained on.  One pass over the rows gives the
loss and the gradient of all of them as matrix products; what a partition
returns is bounded by features x models.  All models are then minimised
together: L-BFGS whose starting matrix is the inverse Hessian of a model nearby
(the one that a search step adds a feature to, or takes one from), so a few
passes do for a whole step of a search.

Loss: half the squared length of the coefficients, the intercept included,
plus C times the sum of log(1 + exp(-margin)).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.exprs import clean_numeric

TASK_ROWS = 2000     # rows from which a pass is worth a task of its own
GATHER = 32          # rows of partial sums that reach the driver
CELLS = 1 << 17      # row x model values that a task holds at a time: as many as stay in a core's cache
RUN = 100            # factors from 1 to 2 whose product a float holds
SINGLE_ROWS = 50_000 # rows from which losses and gradients are summed from single-precision values ...
SINGLE_MAX = 100.0   # ... if no feature is larger: the error is then far below the tolerance of the fits
MEMORY = 6           # steps that L-BFGS remembers


class Batch(NamedTuple):
    mask: np.ndarray    # (features + 1, models): coefficients in use, the intercept last
    target: np.ndarray  # (models,): class told from the rest
    fold: np.ndarray    # (models,): fold left out of training; -1: none


class Rows:
    """Rows with all features finite, held in memory for the passes of a search
    as blocks of one fold each: a pass reads only the folds that its models use.
    Rows of fold -1 are never trained on.  Use as a context."""

    def __init__(self, df: DataFrame, cols: Sequence[str], label: str, fold_col: str | None = None, c: float = 1.0):
        self.cols, self.c = list(cols), c
        fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
        d = clean_numeric(df.select(F.col(label).alias("_label"), fold.alias("fold"), *self.cols), self.cols)
        d = d.filter(F.col("_label").isNotNull() & F.col("fold").isNotNull())
        size = F.array_max(F.array(*[F.abs(F.col(f).cast("double")) for f in self.cols]))
        counts = d.groupBy("_label", "fold").agg(F.count(F.lit(1)).alias("count"), F.max(size).alias("size")).collect()
        self.classes = sorted({r["_label"] for r in counts})
        self.folds: dict[int, int] = {}
        for r in counts:
            self.folds[r["fold"]] = self.folds.get(r["fold"], 0) + r["count"]
        self.n_train = sum(n for f, n in self.folds.items() if f >= 0)
        self.single = self.n_train >= SINGLE_ROWS and max(r["size"] for r in counts) <= SINGLE_MAX
        y = F.array_position(F.array(*[F.lit(x) for x in self.classes]), F.col("_label")) - 1
        x = F.array(*[F.col(f).cast("double") for f in self.cols], F.lit(1.0))
        most = max(d.rdd.getNumPartitions(), 2 * d.sparkSession.sparkContext.defaultParallelism)
        self.parts = max(1, min(most, -(-sum(self.folds.values()) // TASK_ROWS)))
        width = len(self.cols) + 1

        def pack(batches):
            for b in batches:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                y, fold = b.column("y").to_numpy(), b.column("fold").to_numpy()
                for f in np.unique(fold):
                    at = fold == f
                    yield pa.RecordBatch.from_arrays([pa.array([int(f)], pa.int32()), pa.array([x[at].tobytes()], pa.binary()),
                                                      pa.array([y[at].tobytes()], pa.binary())], ["fold", "x", "y"])
        rows = d.select(x.alias("x"), y.cast("int").alias("y"), "fold").repartition(self.parts)
        self.held = rows.mapInArrow(pack, "fold int, x binary, y binary").persist()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.held.unpersist()

    def _sum(self, run, beta: np.ndarray, batch: Batch, folds: Sequence[int], size: int) -> np.ndarray:
        """The sum of the vectors of ``size`` that ``run(fold, beta, target, left_out)``
        makes of ``folds``: it returns what takes a block and what gives their vector."""
        sc = self.held.sparkSession.sparkContext
        cast = sc.broadcast((beta, batch.target, batch.fold))
        width = len(self.cols) + 1

        def partial(batches):
            work = {}
            for b in batches:
                for fold, x, y in zip(b.column("fold").to_pylist(), b.column("x"), b.column("y")):
                    if fold not in work:
                        work[fold] = run(fold, *cast.value)
                    work[fold][0](np.frombuffer(x.as_buffer()).reshape(-1, width), np.frombuffer(y.as_buffer(), np.int32))
            if work:
                total = sum(end() for _, end in work.values())
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])
        parts = self.held.filter(F.col("fold").isin([int(f) for f in folds])).mapInArrow(partial, "sums binary")
        if self.parts > GATHER:
            def add(pdf):
                total = np.sum([np.frombuffer(v) for v in pdf["sums"]], axis=0)
                return pdf.iloc[:1].assign(sums=[total.tobytes()])[["sums"]]
            parts = (parts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(GATHER))).groupBy("part").applyInPandas(add, "sums binary"))
        total = np.zeros(size)
        for r in parts.collect():
            total += np.frombuffer(r[0])
        cast.unpersist()
        return total

    def evaluate(self, beta: np.ndarray, batch: Batch, hessian: bool = False):
        """(loss, gradient[, Hessians]) of each model at its column of ``beta``;
        gradients and Hessians are over all features, in use or not."""
        k, m = beta.shape
        classes, half = len(self.classes), k * (k + 1) // 2
        kind = np.float32 if self.single and not hessian else np.float64

        def run(fold, beta, target, left_out):
            use = np.flatnonzero(left_out != fold)
            b, of = beta[:, use].astype(kind), target[use]
            step = max(1, min(RUN, CELLS // max(1, len(use))))
            loss, grad, h = np.zeros(len(use)), np.zeros((k, len(use))), np.zeros((len(use) if hessian else 0, half))
            own = np.zeros((classes, k))
            room = np.empty((3, step, len(use)), kind)

            def add(x, y):
                nonlocal loss, grad, h
                x = x.astype(kind, copy=False)
                for c in range(classes):
                    own[c] += x[y == c].sum(0, dtype=np.float64)
                for at in range(0, len(x), step):
                    xs = x[at:at + step]
                    z, e, p = room[:, :len(xs)]
                    np.matmul(xs, b, out=z)
                    np.exp(np.negative(np.abs(z, out=e), out=e), out=e)
                    np.maximum(e, (z >= 0).view(np.uint8), out=p)
                    e += 1.0
                    p /= e  # chance of the model's class
                    loss += np.log(np.multiply.reduce(e, axis=0).astype(float))
                    loss += np.maximum(z, 0.0, out=z).sum(0)
                    grad += xs.T @ p
                    for r in range(0, len(xs) if hessian else 0, 128):
                        w, xr = p[r:r + 128], xs[r:r + 128]
                        h += (w * (1.0 - w)).T @ np.concatenate([xr[:, i:i + 1] * xr[:, i:] for i in range(k)], axis=1)

            def end():
                # a row adds log(1 + e^z) to the loss, less z if it is of the model's class
                mine = own[of].T
                out = np.zeros(m), np.zeros((k, m)), np.zeros((m if hessian else 0, half))
                out[0][use], out[1][:, use] = loss - (mine * b).sum(0), grad - mine
                if hessian:
                    out[2][use] = h
                return np.concatenate([v.ravel() for v in out])
            return add, end
        size = m + k * m + (m * half if hessian else 0)
        total = self._sum(run, beta, batch, [f for f in self.folds if f >= 0], size)
        loss = self.c * total[:m] + 0.5 * (beta ** 2).sum(0)
        grad = self.c * total[m:m + k * m].reshape(k, m) + beta
        if not hessian:
            return loss, grad
        h = np.zeros((m, k, k))
        i, j = np.triu_indices(k)
        h[:, i, j] = h[:, j, i] = total[m + k * m:].reshape(m, half)
        return loss, grad, self.c * h + np.eye(k)

    def accuracy(self, beta: np.ndarray, batch: Batch) -> dict:
        """``{(group, fold): accuracy}`` on the rows left out: models lie in groups
        of one per class, all of a group leaving out the same fold; the class of
        the largest value is the answer, the first of those equal to 9 places."""
        classes, groups = len(self.classes), beta.shape[1] // len(self.classes)

        def run(fold, beta, target, left_out):
            hits = np.zeros(groups)
            some = np.flatnonzero(left_out[::classes] == fold)
            b = beta[:, (some[:, None] * classes + np.arange(classes)).ravel()]
            step = max(1, CELLS // max(1, b.shape[1]))

            def add(x, y):
                for at in range(0, len(x), step):
                    z = (x[at:at + step] @ b).round(9).reshape(-1, len(some), classes)
                    hits[some] += (z.argmax(2) == y[at:at + step, None]).sum(0)
            return add, lambda: hits
        of = batch.fold[::classes]
        hits = self._sum(run, beta, batch, sorted({int(f) for f in of} & set(self.folds)), groups)
        return {(g, int(of[g])): hits[g] / self.folds[int(of[g])] for g in range(groups) if self.folds.get(int(of[g]))}

    def fit(self, batch: Batch, start: np.ndarray, precondition, max_passes: int = 60, known=None) -> np.ndarray:
        """The coefficients of each model, from ``start``; ``precondition`` maps
        gradients to steps, close to multiplying by the inverse Hessian;
        ``known``: loss and gradient at ``start`` if an earlier pass gave them."""
        tol = 1e-4 * self.c * max(self.n_train, 1)
        x = np.where(batch.mask, start, 0.0)
        loss, grad = known or self.evaluate(x, batch)
        grad = np.where(batch.mask, grad, 0.0)
        s_, y_, r_ = (np.zeros((MEMORY, *x.shape)), np.zeros((MEMORY, *x.shape)), np.zeros((MEMORY, x.shape[1])))
        step = np.ones(x.shape[1])
        for _ in range(max_passes):
            active = np.abs(grad).max(0) > tol
            if not active.any():
                break
            direction = -_two_loops(grad, s_, y_, r_, precondition)
            slope = (grad * direction).sum(0)
            uphill = slope >= 0
            direction[:, uphill], slope[uphill] = -grad[:, uphill], -(grad[:, uphill] ** 2).sum(0)
            trial = np.where(active, x + step * direction, x)
            t_loss, t_grad, go = loss.copy(), grad.copy(), np.flatnonzero(active)  # only these are evaluated
            t_loss[go], t_grad[:, go] = self.evaluate(trial[:, go], Batch(batch.mask[:, go], batch.target[go], batch.fold[go]))
            t_grad = np.where(batch.mask, t_grad, 0.0)
            ok = active & (t_loss <= loss + 1e-4 * step * slope + 1e-12 * np.abs(loss))
            ds, dy = (trial - x)[:, ok], (t_grad - grad)[:, ok]
            curve = (ds * dy).sum(0)
            good = curve > 1e-14
            at = np.flatnonzero(ok)[good]
            for store, new in ((s_, ds), (y_, dy)):
                store[:-1, :, at] = store[1:, :, at]
                store[-1][:, at] = new[:, good]
            r_[:-1, at] = r_[1:, at]
            r_[-1, at] = 1.0 / curve[good]
            x[:, ok], loss[ok], grad[:, ok] = trial[:, ok], t_loss[ok], t_grad[:, ok]
            step = np.where(ok, 1.0, step * 0.4)
        return x


def _two_loops(grad, s_, y_, r_, precondition):
    q, kept = grad.copy(), []
    for s, y, r in zip(s_[::-1], y_[::-1], r_[::-1]):
        a = r * (s * q).sum(0)
        kept.append(a)
        q -= a * y
    q = precondition(q)
    for s, y, r, a in zip(s_, y_, r_, kept[::-1]):
        q += s * (a - r * (y * q).sum(0))
    return q


def _inverse(h: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Inverses of the parts of ``h`` that each ``mask`` keeps; zero elsewhere."""
    out = np.zeros_like(h)
    for i, m in enumerate(mask):
        at = np.flatnonzero(m)
        out[i][np.ix_(at, at)] = np.linalg.inv(h[i][np.ix_(at, at)])
    return out


def _every_class(rows: Rows, mask: np.ndarray, folds: Sequence[int]) -> Batch:
    """Models of each group (a column of ``mask`` and its fold), one per class."""
    k = len(rows.classes)
    return Batch(np.repeat(mask, k, axis=1), np.tile(np.arange(k), mask.shape[1]), np.repeat(np.asarray(folds), k))


def _by_matrix(inverse: np.ndarray):
    """Precondition by one inverse Hessian a model."""
    return lambda q: np.einsum("mij,jm->im", inverse, q)


def fit_subsets(rows: Rows, subsets: Sequence[Sequence[int]]) -> tuple[np.ndarray, Batch]:
    """One model per class for each subset of feature numbers, trained on all folds."""
    width = len(rows.cols) + 1
    mask = np.zeros((width, len(subsets)), bool)
    mask[-1] = True
    for i, s in enumerate(subsets):
        mask[list(s), i] = True
    batch = _every_class(rows, mask, [-1] * len(subsets))
    zero = np.zeros(batch.mask.shape)
    one = Batch(np.ones((width, 1), bool), np.zeros(1, int), np.array([-1]))
    h = rows.evaluate(np.zeros((width, 1)), one, hessian=True)[2]  # at 0 it is the same for all
    inverse = np.repeat(_inverse(np.repeat(h, len(subsets), 0), mask.T), len(rows.classes), 0)
    return rows.fit(batch, zero, _by_matrix(inverse)), batch


def sequential(rows: Rows, k: int, direction: str = "forward") -> list[int]:
    """Greedy search for ``k`` features by mean accuracy over the folds left
    out; every step fits all candidates x folds x classes together.  Equal
    accuracies go to the first feature."""
    p, classes = len(rows.cols), len(rows.classes)
    folds = sorted(f for f in rows.folds if f >= 0)
    forward = direction == "forward"
    chosen = [] if forward else list(range(p))
    width, bases = p + 1, len(folds) * classes

    def mask_of(features):
        m = np.zeros(width, bool)
        m[[*features, p]] = True
        return m
    base_batch = _every_class(rows, np.repeat(mask_of(chosen)[:, None], len(folds), 1), folds)
    base = np.zeros((width, bases))
    if not forward:
        h = rows.evaluate(base, base_batch, hessian=True)[2]
        base = rows.fit(base_batch, base, _by_matrix(_inverse(h, base_batch.mask.T)))
    while (len(chosen) < k) if forward else (len(chosen) > k):
        loss, grad, h = rows.evaluate(base, base_batch, hessian=True)
        inv = _inverse(h, base_batch.mask.T)
        cand = [j for j in range(p) if j not in chosen] if forward else list(chosen)
        js = np.array(cand)
        masks = np.array([mask_of([*chosen, j] if forward else [x for x in chosen if x != j]) for j in cand]).T
        # groups: candidate by candidate, the folds of each; models of a group: the classes
        batch = _every_class(rows, np.repeat(masks, len(folds), 1), np.tile(folds, len(cand)))
        of_base = [np.arange(len(cand)) * bases + b for b in range(bases)]  # models of each base, in order of js
        here = np.arange(len(js))

        def step(q, h=h, inv=inv, js=js, of_base=of_base, here=here):
            out = np.empty_like(q)
            for b, cols in enumerate(of_base):
                g = q[:, cols]
                if forward:  # bordered inverse: feature j joins
                    u = inv[b] @ h[b][:, js]
                    s = h[b][js, js] - (h[b][:, js] * u).sum(0)
                    x = (g[js, here] - (u * g).sum(0)) / s
                    r = inv[b] @ g - u * x
                    r[js, here] += x
                else:  # feature j leaves
                    a = inv[b][:, js]
                    r = inv[b] @ g - a * ((a * g).sum(0) / a[js, here])
                out[:, cols] = r
            return out
        start = np.empty(batch.mask.shape)
        for b, cols in enumerate(of_base):
            start[:, cols] = base[:, [b]]
            if not forward:
                a = inv[b][:, js]
                start[:, cols] -= a * (base[js, b] / a[js, here])
        # a feature joins with coefficient 0, where loss and gradient are those of the base
        beta = rows.fit(batch, start, step, known=(np.tile(loss, len(cand)), np.tile(grad, len(cand))) if forward else None)
        scores = rows.accuracy(beta, batch)
        mean = [np.mean([scores[c * len(folds) + i, f] for i, f in enumerate(folds)]) for c in range(len(cand))]
        best = int(np.argmax(np.round(mean, 12)))
        chosen = sorted([*chosen, cand[best]]) if forward else [x for x in chosen if x != cand[best]]
        base = beta[:, best * bases:(best + 1) * bases]
        base_batch = _every_class(rows, np.repeat(mask_of(chosen)[:, None], len(folds), 1), folds)
    return chosen


def eliminate(rows: Rows, k: int, step: int = 1) -> list[int]:
    """Recursive elimination: the feature of the smallest sum of squared
    coefficients over the classes goes, ``step`` at a time, until ``k`` are left."""
    p, classes = len(rows.cols), len(rows.classes)
    keep = list(range(p))
    beta, batch = fit_subsets(rows, [keep])
    while len(keep) > k:
        weight = (beta[keep] ** 2).sum(1)
        gone = [keep[i] for i in np.argsort(weight, kind="stable")[:min(step, len(keep) - k)]]
        h = rows.evaluate(beta, batch, hessian=True)[2]
        old = _inverse(h, batch.mask.T)
        keep = [j for j in keep if j not in gone]
        mask = np.zeros((p + 1, 1), bool)
        mask[[*keep, p]] = True
        batch = _every_class(rows, mask, [-1])
        start = beta.copy()
        for m in range(classes):
            start[:, m] -= old[m][:, gone] @ np.linalg.solve(old[m][np.ix_(gone, gone)], beta[gone, m])
        beta = rows.fit(batch, start, _by_matrix(_inverse(h, batch.mask.T)))
    return keep


def holdout_accuracy(rows: Rows, subsets: Sequence[Sequence[int]]) -> list[float]:
    """Accuracy on the rows of fold -1 of models trained on the others, per subset."""
    beta, batch = fit_subsets(rows, subsets)
    scores = rows.accuracy(beta, batch)
    return [float(scores.get((i, -1), float("nan"))) for i in range(len(subsets))]
