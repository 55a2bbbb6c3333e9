"""Classification trees grown level by level, many at a time.

A node's split depends on the criterion and the smallest leaf only; the
largest depth and ``min_samples_split`` say where a path stops.  So one grown
tree answers every (depth, min_split) setting exactly: a row's prediction is
the majority of the first node on its path at which the setting stops.  The
3·5·4·3 grid over five folds takes 30 trees (log-loss is entropy) that all grow
in the same passes, one aggregate a level.

* Candidate thresholds lie between neighbouring values of a feature, or between
  ``max_bins`` quantiles of its different values where it has more.  They come
  from a hash sample of different rows (``BIN_ROWS``, all rows below that): a
  function of the rows, not of their partitions.
* A level's histogram is (tree, node, feature, bin, class) counts, summed in
  the task, then by Spark; a group of it holds one node (features × bins ×
  classes cells).  Only the chosen splits reach the driver.
* A node whose rows (training and scored) number ``local_rows`` or fewer is
  finished in one group by the same split search, so the limit changes where
  the work is done and not the tree.  The driver holds the nodes above it: two
  for each ``local_rows`` rows of a tree.  Every tree's rows are shuffled once,
  as numbers, for that last step.

Splits are ranked by impurity, then feature, then threshold (costs within 1e-12
tie); a node splits while it is impure and a split leaves ``min_leaf`` rows on
either side, even without gain.  Majority ties go to the smaller class.
A tree without training rows predicts the smallest class.  Rows with a null, NaN
or infinite feature or a null label take no part; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from statlake.functions.exprs import clean_numeric

BIN_ROWS = 50_000  # different rows that the candidate thresholds are taken from
BATCH = 200_000    # rows whose counts are merged before they leave a task
TIE = 1e-12


@dataclass(frozen=True)
class Spec:
    """One tree: rows with ``part`` = holdout are scored, the others with part >= 0 train it."""
    tree: int
    holdout: int
    criterion: str = "gini"
    min_leaf: int = 1


@dataclass
class Nodes:
    """A tree as parallel lists; children come after their parent."""
    parent: list = field(default_factory=list)
    depth: list = field(default_factory=list)
    path: list = field(default_factory=list)
    counts: list = field(default_factory=list)
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    left: list = field(default_factory=list)

    def add(self, parent, depth, path, counts) -> int:
        self.parent.append(parent)
        self.depth.append(depth)
        self.path.append(path)
        self.counts.append(np.asarray(counts, dtype=np.int64))
        self.feature.append(-1)
        self.threshold.append(0.0)
        self.gain.append(0.0)
        self.left.append(-1)
        return len(self.parent) - 1

    def split(self, node, feature, threshold, gain, left_counts) -> tuple[int, int]:
        d, p, c = self.depth[node] + 1, self.path[node], self.counts[node]
        a = self.add(node, d, p + "L", left_counts)
        b = self.add(node, d, p + "R", c - np.asarray(left_counts))
        self.feature[node], self.threshold[node], self.gain[node], self.left[node] = int(feature), float(threshold), float(gain), a
        return a, b

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The last node on each row's path."""
        f, t, left = np.array(self.feature), np.array(self.threshold), np.array(self.left)
        at, live = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while len(live):
            live = live[f[at[live]] >= 0]
            a = at[live]
            at[live] = left[a] + (x[live, f[a]] > t[a])
        return at

    def stops(self, cuts) -> np.ndarray:
        """(nodes × cuts): the node at which a path through this one ends, itself if no ancestor ends it."""
        n, depth = np.array([c.sum() for c in self.counts]), np.array(self.depth)
        halt = np.column_stack([(depth >= (np.inf if d is None else d)) | (n < s) for d, s in cuts])
        parent, out = np.array(self.parent), np.repeat(np.arange(len(n))[:, None], len(cuts), axis=1)
        for d in range(depth.min() + 1, depth.max() + 1):
            at = np.flatnonzero(depth == d)
            up = parent[at]
            ended = halt[up] | (out[up] != up[:, None])
            out[at] = np.where(ended, out[up], at[:, None])
        return out

    def majority(self) -> np.ndarray:
        return np.array([c.argmax() for c in self.counts])


def _impurity(counts: np.ndarray, criterion: str) -> np.ndarray:
    p = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    if criterion == "gini":
        return 1.0 - (p * p).sum(1)
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(1)


def best_splits(node, feature, bin_, counts, criterion: str, min_leaf: int, bins):
    """The best split of every node from histogram cells sorted by (node, feature, bin):
    arrays node, feature, threshold, gain, left counts; nodes without a valid split are left out."""
    new = np.r_[True, (np.diff(node) != 0) | (np.diff(feature) != 0)]
    first, seg = np.flatnonzero(new), np.cumsum(new) - 1
    cum = counts.cumsum(0)
    left = cum - (cum[first] - counts[first])[seg]
    total = left[np.r_[first[1:] - 1, len(node) - 1]][seg]
    right = total - left
    nl, nr = left.sum(1), right.sum(1)
    ok = (nl >= max(min_leaf, 1)) & (nr >= max(min_leaf, 1))
    cost = np.full(len(node), np.inf)
    cost[ok] = (nl[ok] * _impurity(left[ok], criterion) + nr[ok] * _impurity(right[ok], criterion)) / (nl + nr)[ok]
    head = np.flatnonzero(np.r_[True, np.diff(node) != 0])
    low = np.minimum.reduceat(cost, head)
    at = np.flatnonzero(ok & (cost <= np.repeat(low, np.diff(np.r_[head, len(node)])) + TIE))
    at = at[np.r_[True, np.diff(node[at]) != 0]] if len(at) else at  # first by feature and bin
    thr = np.array([(bins[f][1][b] + bins[f][0][c]) / 2 for f, b, c in zip(feature[at], bin_[at], bin_[at + 1])])
    return node[at], feature[at], thr, _impurity(total[at], criterion) - cost[at], left[at]


def _histogram(node, x, y, bins, classes):
    """Sorted cells (node, feature, bin) and their class counts."""
    wide = max(len(b[0]) for b in bins)
    code = [((node * len(bins) + j) * wide + np.searchsorted(bins[j][2], x[:, j])) * classes + y for j in range(len(bins))]
    code, n = np.unique(np.concatenate(code), return_counts=True)
    cell, of = np.unique(code // classes, return_inverse=True)
    counts = np.zeros((len(cell), classes), dtype=np.int64)
    counts[of, code % classes] = n
    return cell // (wide * len(bins)), cell // wide % len(bins), cell % wide, counts


def _finish(tree: Nodes, x, y, spec: Spec, bins, classes, deepest, min_split) -> Nodes:
    """Grow a tree whose rows are all here; the root's counts are set."""
    at = np.zeros(len(x), dtype=np.int64)
    front = [0]
    while front:
        open_ = np.zeros(len(tree.parent), dtype=bool)
        for v in front:
            c = tree.counts[v]
            open_[v] = (c > 0).sum() > 1 and c.sum() >= min_split and (deepest is None or tree.depth[v] < deepest)
        rows = np.flatnonzero(open_[at])
        if not len(rows):
            break
        cells = _histogram(at[rows], x[rows], y[rows], bins, classes)
        front = []
        for v, f, t, g, lc in zip(*best_splits(*cells, spec.criterion, spec.min_leaf, bins)):
            front += tree.split(int(v), f, t, g, lc)
        f, t, left = np.array(tree.feature), np.array(tree.threshold), np.array(tree.left)
        rows = rows[f[at[rows]] >= 0]
        a = at[rows]
        at[rows] = left[a] + (x[rows, f[a]] > t[a])
    return tree


def _bins(d: DataFrame, cols: Sequence[str], max_bins: int):
    """Per feature: low and high value of each bin, and the cuts (row goes to the bin of the first cut >= value)."""
    h = F.xxhash64(*cols)
    m = d.agg(F.approx_count_distinct(h)).first()[0]
    if m > BIN_ROWS:
        d = d.filter(F.shiftrightunsigned(h, 11) < F.lit(int(2 ** 53 * BIN_ROWS / m)))
    v = np.array([tuple(r) for r in d.select(*cols).distinct().collect()], dtype=float).reshape(-1, len(cols))
    out = []
    for j in range(len(cols)):
        u = np.unique(v[:, j])
        if len(u) <= max_bins:
            out.append((u, u, (u[:-1] + u[1:]) / 2))
        else:
            q = np.unique(u[(np.arange(1, max_bins) * len(u)) // max_bins - 1])
            out.append((np.r_[q[0], q], np.r_[q, q[-1]], q))
    return out


class Forest:
    """Trees of ``specs`` over one prepared table; ``confusion`` and ``nodes`` read them."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, part: str, specs: Sequence[Spec],
                 cuts: Sequence[tuple], max_bins: int = 256, local_rows: int = 100_000):
        self.features, self.specs, self.cuts = list(features), list(specs), list(cuts)
        self.local_rows, self.spark = local_rows, df.sparkSession
        self.deepest = None if any(d is None for d, _ in cuts) else max(d for d, _ in cuts)
        self.min_split = min(s for _, s in cuts)
        self.cols = [f"x{j}" for j in range(len(features))]
        d = clean_numeric(df.select(F.col(part).cast("int").alias("part"), F.col(label).alias("label"),
                                    *[F.col(c).cast("double").alias(x) for c, x in zip(features, self.cols)])
                          .filter("label is not null and part is not null"), self.cols).persist(StorageLevel.MEMORY_AND_DISK)
        self.held = d
        sizes = d.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n")).collect()
        self.labels = sorted({r["label"] for r in sizes})
        code = F.array_position(F.array(*[F.lit(v) for v in self.labels]), F.col("label")) - 1 if self.labels else F.lit(0)
        self.data = d.select("part", code.cast("int").alias("y"), *self.cols)
        self.top: dict[int, Nodes] = {}
        self.small: dict[int, set] = {}
        if not self.labels:
            return
        self.bins = _bins(self.data.filter("part >= 0"), self.cols, max_bins)
        by = {(r["part"], self.labels.index(r["label"])): r["n"] for r in sizes}
        k = range(len(self.labels))
        for s in self.specs:
            t, self.small[s.tree] = Nodes(), set()
            t.add(-1, 0, "", [sum(n for (p, y), n in by.items() if p >= 0 and p != s.holdout and y == c) for c in k])
            self.top[s.tree] = t
            if t.counts[0].sum() + sum(by.get((s.holdout, c), 0) for c in k) <= local_rows:
                self.small[s.tree].add(0)
        self._grow_top()

    def close(self):
        """Give the kept rows back; results read later compute them again."""
        self.held.unpersist()

    # ---- nodes too large for one group ----------------------------------------------

    def _is_open(self, t: Nodes, v: int) -> bool:
        c = t.counts[v]
        return bool((c > 0).sum() > 1 and c.sum() >= self.min_split and (self.deepest is None or t.depth[v] < self.deepest))

    def _grow_top(self):
        front = {s.tree: [0] for s in self.specs if 0 not in self.small[s.tree] and self._is_open(self.top[s.tree], 0)}
        while front:
            nxt: dict[int, list] = {}
            for r in self._level(front):
                t = self.top[r["tree"]]
                if int(t.counts[r["node"]].sum()) + r["scored"] <= self.local_rows:
                    self.small[r["tree"]].add(r["node"])
                elif r["feature"] is not None:
                    kids = t.split(r["node"], r["feature"], r["threshold"], r["gain"], r["left_counts"])
                    nxt.setdefault(r["tree"], []).extend(v for v in kids if self._is_open(t, v))
            front = {k: v for k, v in nxt.items() if v}

    def _level(self, front):
        specs, top, bins, cols, k = self.specs, self.top, self.bins, self.cols, len(self.labels)

        def count(batches):
            import pandas as pd
            for pdf in _batched(batches):
                part, y, x = pdf["part"].to_numpy(), pdf["y"].to_numpy(), pdf[cols].to_numpy()
                for s in specs:
                    if s.tree not in front:
                        continue
                    at = top[s.tree].descend(x)
                    live = np.isin(at, front[s.tree])
                    tr, ev = live & (part >= 0) & (part != s.holdout), live & (part == s.holdout)
                    v, n = np.unique(at[ev], return_counts=True)
                    yield pd.DataFrame({"tree": s.tree, "node": v, "feature": -1, "bin": 0, "y": 0, "n": n})
                    if tr.any():
                        node, f, b, c = _histogram(at[tr], x[tr], y[tr], bins, k)
                        i, j = np.nonzero(c)
                        yield pd.DataFrame({"tree": s.tree, "node": node[i], "feature": f[i], "bin": b[i], "y": j, "n": c[i, j]})

        by_tree = {s.tree: s for s in specs}

        def choose(pdf):
            import pandas as pd
            s = by_tree[int(pdf["tree"].iloc[0])]
            scored = int(pdf.loc[pdf["feature"] < 0, "n"].sum())
            h = pdf[pdf["feature"] >= 0]
            cell = h.pivot_table(index=["feature", "bin"], columns="y", values="n", fill_value=0, aggfunc="sum")
            cell = cell.reindex(columns=range(k), fill_value=0).sort_index()
            f, b = (cell.index.get_level_values(i).to_numpy() for i in (0, 1))
            _, f, t, g, lc = best_splits(np.zeros(len(f), dtype=np.int64), f, b, cell.to_numpy().astype(np.int64),
                                         s.criterion, s.min_leaf, bins)
            found = len(f) > 0
            return pd.DataFrame({"tree": [s.tree], "node": [pdf["node"].iloc[0]], "scored": [scored],
                                 "feature": pd.array([f[0] if found else None], dtype="Int32"),
                                 "threshold": [t[0] if found else None], "gain": [g[0] if found else None],
                                 "left_counts": [lc[0] if found else None]})

        hist = self.data.mapInPandas(count, "tree int, node int, feature int, bin int, y int, n long")
        hist = hist.groupBy("tree", "node", "feature", "bin", "y").agg(F.sum("n").alias("n"))
        return hist.groupBy("tree", "node").applyInPandas(
            choose, "tree int, node int, scored long, feature int, threshold double, gain double, left_counts array<long>").collect()

    # ---- the rest: one group a small node ------------------------------------------

    def _groups(self, scored: bool) -> DataFrame:
        specs, top, small, cols = self.specs, self.top, self.small, self.cols

        def deal(batches):
            for pdf in batches:
                part, x = pdf["part"].to_numpy(), pdf[cols].to_numpy()
                for s in specs:
                    use = (part >= 0) | (part == s.holdout) if scored else (part >= 0) & (part != s.holdout)
                    use = use & (part >= 0) if s.holdout >= 0 else use
                    at = top[s.tree].descend(x[use])
                    hit = np.isin(at, list(small[s.tree]))
                    out = pdf[use][hit].assign(tree=s.tree, node=at[hit])
                    yield out[["tree", "node", "part", "y", *cols]]
        return self.data.mapInPandas(deal, "tree int, node int, part int, y int, " + ", ".join(f"{c} double" for c in cols))

    def _subtree(self):
        by_tree, top, bins, cols, k = {s.tree: s for s in self.specs}, self.top, self.bins, self.cols, len(self.labels)
        deepest, min_split = self.deepest, self.min_split

        def grow(pdf):
            s, v = by_tree[int(pdf["tree"].iloc[0])], int(pdf["node"].iloc[0])
            train = pdf[pdf["part"] != s.holdout]
            sub, up = Nodes(), top[s.tree]
            sub.add(-1, up.depth[v], up.path[v], up.counts[v])
            return s, v, _finish(sub, train[cols].to_numpy(), train["y"].to_numpy(), s, bins, k, deepest, min_split)
        return grow

    def confusion(self) -> DataFrame:
        """``(tree, cut, truth, pred, n)``: scored rows by class number, for every cut of ``cuts``."""
        schema = "tree int, cut int, truth int, pred int, n long"
        if not self.labels:
            return self.spark.createDataFrame([], schema)
        specs, top, small, cols, cuts, grow = self.specs, self.top, self.small, self.cols, self.cuts, self._subtree()

        def count(tree, y, pred):
            import pandas as pd
            cut = np.broadcast_to(np.arange(len(cuts)), pred.shape)
            key = np.stack([cut.ravel(), np.repeat(y, len(cuts)), pred.ravel()])
            (c, a, p), n = np.unique(key, axis=1, return_counts=True)
            return pd.DataFrame({"tree": tree, "cut": c, "truth": a, "pred": p, "n": n})

        def in_leaves(batches):  # rows that end above the small nodes
            answers = {s.tree: top[s.tree].majority()[top[s.tree].stops(cuts)] for s in specs}
            for pdf in _batched(batches):
                part, y, x = pdf["part"].to_numpy(), pdf["y"].to_numpy(), pdf[cols].to_numpy()
                for s in specs:
                    ev = part == s.holdout
                    at = top[s.tree].descend(x[ev])
                    out = ~np.isin(at, list(small[s.tree]))
                    if out.any():
                        yield count(s.tree, y[ev][out], answers[s.tree][at[out]])

        def in_group(pdf):
            s, v, sub = grow(pdf)
            ev = pdf[pdf["part"] == s.holdout]
            if not len(ev):
                return count(s.tree, np.zeros(0, dtype=int), np.zeros((0, len(cuts)), dtype=int))
            above = top[s.tree].stops(cuts)[v]
            pred = sub.majority()[sub.stops(cuts)[sub.descend(ev[cols].to_numpy())]]
            pred = np.where(above != v, top[s.tree].majority()[above], pred)
            return count(s.tree, ev["y"].to_numpy(), pred)

        d = self._groups(True).groupBy("tree", "node").applyInPandas(in_group, schema)
        d = d.unionByName(self.data.mapInPandas(in_leaves, schema))
        return d.groupBy("tree", "cut", "truth", "pred").agg(F.sum("n").alias("n"))

    def nodes(self) -> DataFrame:
        """The nodes of every tree, grown as deep as the cuts allow: ``(tree, path, depth, feature, threshold,
        gain, n, counts, pred)``; path is L and R from the root, feature null at a leaf, pred a class number."""
        schema = ("tree int, path string, depth int, feature string, threshold double, gain double, n long, "
                  "counts array<long>, pred int")
        if not self.labels:
            return self.spark.createDataFrame([], schema)
        names, grow = self.features, self._subtree()

        def rows(tree, t: Nodes, skip=()):
            for v in range(len(t.parent)):
                if v in skip:
                    continue
                f = t.feature[v]
                yield (tree, t.path[v], t.depth[v], names[f] if f >= 0 else None, t.threshold[v] if f >= 0 else None,
                       t.gain[v] if f >= 0 else None, int(t.counts[v].sum()), [int(c) for c in t.counts[v]], int(t.counts[v].argmax()))

        def in_group(pdf):
            import pandas as pd
            s, _, sub = grow(pdf)
            return pd.DataFrame(list(rows(s.tree, sub)), columns=["tree", "path", "depth", "feature", "threshold", "gain", "n",
                                                                  "counts", "pred"])
        above = [r for s in self.specs for r in rows(s.tree, self.top[s.tree], self.small[s.tree])
                 if self.top[s.tree].counts[0].sum()]
        return self._groups(False).groupBy("tree", "node").applyInPandas(in_group, schema).unionByName(
            self.spark.createDataFrame(above, schema))


def _batched(batches):
    import pandas as pd
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= BATCH:
            yield pd.concat(held)
            held, n = [], 0
    if n:
        yield pd.concat(held)


# ---- M4, M6, M7 ---------------------------------------------------------------------------

# The reference grid
GRID = {"criterion": ["gini", "entropy", "log_loss"], "max_depth": [None, 2, 3, 4, 5],
        "min_samples_leaf": [1, 2, 3], "min_samples_split": [2, 4, 6, 8]}


def grid_scores(df: DataFrame, features: Sequence[str], label: str, fold: str = "fold", folds: int = 5,
                grid: dict | None = None, **kw) -> list[dict]:
    """Every setting with its mean fold accuracy, σ (ddof 0), rank (1 = best;
    ties to the earlier setting, criterion outermost and min_samples_split
    innermost) and the accuracy on rows of fold -1 when trained on all folds
    (null without such rows).  Rows of any other fold take no part; a fold
    without rows to score is left out of the mean."""
    g = GRID | (grid or {})
    kinds = sorted({(("gini" if c == "gini" else "entropy"), m) for c in g["criterion"] for m in g["min_samples_leaf"]})
    cuts = [(d, s) for d in g["max_depth"] for s in g["min_samples_split"]]
    held = [*range(folds), -1]
    specs = [Spec(i * len(held) + j, f, c, m) for i, (c, m) in enumerate(kinds) for j, f in enumerate(held)]
    forest = Forest(df.filter(F.col(fold).between(-1, folds - 1)), features, label, fold, specs, cuts, **kw)
    try:
        hits = forest.confusion().groupBy("tree", "cut").agg(
            F.sum(F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0)).alias("ok"), F.sum("n").alias("n")).collect()
    finally:
        forest.close()
    acc = {(r["tree"], r["cut"]): r["ok"] / r["n"] for r in hits}
    out = []
    for c in g["criterion"]:
        for d in g["max_depth"]:
            for m in g["min_samples_leaf"]:
                for s in g["min_samples_split"]:
                    tree, cut = kinds.index(("gini" if c == "gini" else "entropy", m)) * len(held), cuts.index((d, s))
                    a = [acc[tree + f, cut] for f in range(folds) if (tree + f, cut) in acc]
                    out.append({"criterion": c, "max_depth": d, "min_samples_leaf": m, "min_samples_split": s,
                                "mean_accuracy": float(np.mean(a)) if a else None, "sd_accuracy": float(np.std(a)) if a else None,
                                "test_accuracy": acc.get((tree + folds, cut))})
    order = sorted(range(len(out)), key=lambda i: (-round(out[i]["mean_accuracy"] or 0.0, 12), i))
    for r, i in enumerate(order):
        out[i]["rank"] = r + 1
    return out


def importances(nodes: DataFrame) -> DataFrame:
    """``(tree, feature, importance)``: impurity decrease weighted by rows, shares of a tree's total."""
    d = nodes.filter("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("n") * F.col("gain")).alias("_g"))
    t = d.groupBy("tree").agg(F.sum("_g").alias("_t"))
    return d.join(t, "tree").select("tree", "feature", F.when(F.col("_t") > 0, F.col("_g") / F.col("_t")).otherwise(0.0).alias("importance"))
