"""Exact nearest neighbours and the exact Euclidean silhouette.

**knn.**  Equal points of a group are one entry with the k+1 smallest ids.
A k-d tree over a bounded hash sample (groups first, then the widest
coordinate) cuts the entries into leaves of about ``leaf_rows``.  Every entry is
searched in its own leaf, which bounds its k-th distance; it then visits just
the leaves that this ball reaches.  A leaf that many entries visit is copied
for slots of ``slot_rows`` visitors, so no task holds more than a leaf and a slot,
and no pair of rows leaves a task: each visit gives back k+1 candidates.
With many coordinates a ball reaches most leaves, and the work grows with the
square of the rows, as it must; it stays in blocks.

**silhouette.**  Distances of a block of rows to all rows are added per
(row, cluster) in the tasks that hold the other rows, so sums are shuffled,
not pairs.  The work is quadratic; ``score_rows`` scores a hash sample of about
that many different rows against all rows, with the error of the mean.

Rows with a null, NaN or infinite coordinate, a null id (knn) or a null label
(silhouette) take no part.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.functions.exprs import clean_numeric
from statlake.session import ensure_checkpoint_dir

TILE = 2_000_000  # distances held at once
CACHED = 250_000  # distances that stay in a core's cache
NEAR = 1e-6  # of the largest squared lengths: nearer pairs are not left to a matrix product


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def _sq(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d += (a[:, j, None] - b[None, :, j]) ** 2
    return d


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by one matrix product.  Pairs so near that the product
    lost more than half of the digits are taken from their differences."""
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    d = (-2.0 * a) @ b.T
    d += aa[:, None]
    d += bb
    close = np.flatnonzero(d < NEAR * (aa.max(initial=0.0) + bb.max(initial=0.0)))
    for s in range(0, len(close), TILE // 16):
        i, j = np.divmod(close[s:s + TILE // 16], len(b))
        d.flat[close[s:s + TILE // 16]] = ((a[i] - b[j]) ** 2).sum(1)
    return np.sqrt(d, out=d)


class _Tree:
    """A k-d tree; coordinate -1 is the group.  Rows at or below a cut go left."""

    def __init__(self, g: np.ndarray, x: np.ndarray, limit: float):
        self.dim, self.cut, self.kids, self.leaves = [], [], [], 0
        todo = [(np.arange(len(g)), None, 0)]
        while todo:
            rows, up, side = todo.pop()
            at = len(self.dim)
            if up is not None:
                self.kids[up][side] = at
            split = self._split(g[rows], x[rows]) if len(rows) > limit else None
            if split is None:
                self.dim.append(None)
                self.cut.append(None)
                self.kids.append([self.leaves, self.leaves])
                self.leaves += 1
                continue
            dim, cut = split
            self.dim.append(dim)
            self.cut.append(cut)
            self.kids.append([0, 0])
            left = (g[rows] if dim < 0 else x[rows, dim]) <= cut
            todo += [(rows[left], at, 0), (rows[~left], at, 1)]

    @staticmethod
    def _split(g, x):
        u, n = np.unique(g, return_counts=True)
        if len(u) > 1:
            return -1, u[np.abs(n.cumsum()[:-1] - len(g) / 2).argmin()]
        wide = x.max(0) - x.min(0)
        dim = int(wide.argmax())
        if wide[dim] <= 0:
            return None
        v = np.sort(x[:, dim])
        mid = v[len(v) // 2 - 1]
        return dim, mid if mid < v[-1] else v[v < v[-1]][-1]

    def reach(self, g, x, ball):
        """(row, leaf) for every leaf that a row's ball (radius, may be infinite) can reach in its group."""
        out = [(np.zeros(0, np.int64), 0)]
        far = np.zeros((len(g), x.shape[1]))  # distance to the box, by coordinate
        todo = [(0, np.arange(len(g)), far)]
        while todo:
            at, rows, far = todo.pop()
            if not len(rows):
                continue
            dim, cut = self.dim[at], self.cut[at]
            if dim is None:
                out.append((rows, self.kids[at][0]))
                continue
            if dim < 0:
                left = g[rows] <= cut
                todo += [(self.kids[at][0], rows[left], far[left]), (self.kids[at][1], rows[~left], far[~left])]
                continue
            gap = x[rows, dim] - cut
            for kid, away in ((self.kids[at][0], np.maximum(gap, 0)), (self.kids[at][1], np.maximum(-gap, 0))):
                f = far.copy()
                f[:, dim] = np.maximum(f[:, dim], away)
                near = np.sqrt((f * f).sum(1)) <= ball[rows]
                todo.append((kid, rows[near], f[near]))
        return np.concatenate([r for r, _ in out]), np.concatenate([np.full(len(r), leaf) for r, leaf in out]).astype(np.int64)

    def home(self, g, x):
        row, leaf = np.zeros(len(g), np.int64), np.zeros(len(g), np.int64)
        todo = [(0, np.arange(len(g)))]
        while todo:
            at, row = todo.pop()
            dim = self.dim[at]
            if dim is None:
                leaf[row] = self.kids[at][0]
            elif len(row):
                left = (g[row] if dim < 0 else x[row, dim]) <= self.cut[at]
                todo += [(self.kids[at][0], row[left]), (self.kids[at][1], row[~left])]
        return leaf


def _search(g, x, bound, pg, px, pids, k):
    """For each query its k+1 nearest (squared distance, id) among the entries, none beyond its bound."""
    first = np.array([i[0] for i in pids], dtype=np.int64)
    ids, dist = [], []
    step = max(1, TILE // max(1, len(pg)))
    for s in range(0, len(g), step):
        d = _sq(x[s:s + step], px)
        d[g[s:s + step, None] != pg[None, :]] = np.inf
        edge = np.partition(d, k, axis=1)[:, k] if d.shape[1] > k + 1 else np.full(len(d), np.inf)
        row, col = np.nonzero((d <= np.minimum(edge, bound[s:s + step])[:, None]) & np.isfinite(d))
        o = np.lexsort((first[col], d[row, col], row))
        row, col = row[o], col[o]
        ends = np.searchsorted(row, np.arange(len(d) + 1))
        for i in range(len(d)):
            near = col[ends[i]:ends[i + 1]][:k + 1]
            best = sorted((d[i, c], int(v)) for c in near for v in pids[c])[:k + 1]
            ids.append([v for _, v in best])
            dist.append([float(v) for v, _ in best])
    return ids, dist


def knn(df: DataFrame, keys, id_col: str, cols: Sequence[str], k: int = 1, leaf_rows: int = 4_096,
        sample_rows: int = 50_000, slot_rows: int = 16_384) -> DataFrame:
    """``(keys, id, rank, neighbour, distance)``: the k other rows of the
    group that are nearest by Euclidean distance, ties to the smaller id; all
    if there are fewer.  Ids are integers; rows that repeat an id at the same
    place count once, a null key is a group of its own."""
    keys, spark = _k(keys), df.sparkSession
    ensure_checkpoint_dir(spark)
    xs, ks = [f"x{j}" for j in range(len(cols))], [f"k{j}" for j in range(len(keys))]
    group = F.xxhash64(*[F.col(c).isNull() for c in keys], *[F.col(c) for c in keys]) if keys else F.lit(0).cast("long")
    base = df.select(*[F.col(c).alias(n) for c, n in zip(keys, ks)], group.alias("g"), F.col(id_col).cast("long").alias("id"),
                     *[(F.col(c).cast("double") + 0.0).alias(n) for c, n in zip(cols, xs)])
    base = clean_numeric(base.filter("id is not null"), xs).distinct()
    place = ["g", *xs]
    first = F.row_number().over(Window.partitionBy(*place).orderBy("id"))  # Spark limits the ranks before the shuffle
    pts = base.select(*place, "id").withColumn("r", first).filter(F.col("r") <= k + 1)
    pts = pts.groupBy(*place).agg(F.sort_array(F.collect_list("id")).alias("ids")).checkpoint()
    m = pts.count()
    h, some = F.xxhash64(*place), pts
    if m > sample_rows:
        some = pts.filter(F.shiftrightunsigned(h, 11) < F.lit(int(2 ** 53 * sample_rows / m)))
    some = some.select(*place).orderBy(*place).collect()
    tree = _Tree(np.array([r[0] for r in some], dtype=np.int64), np.array([r[1:] for r in some], dtype=float).reshape(-1, len(xs)),
                 max(8.0, leaf_rows * len(some) / max(1, m)))
    shape = "g long, " + ", ".join(f"{c} double" for c in xs)

    def at_home(batches):
        for b in batches:
            yield b.assign(leaf=tree.home(b["g"].to_numpy(), b[xs].to_numpy()))
    entries = pts.mapInPandas(at_home, shape + ", ids array<long>, leaf long")

    def own(pdf):
        g, x = pdf["g"].to_numpy(), pdf[xs].to_numpy()
        ids, d = _search(g, x, np.full(len(g), np.inf), g, x, pdf["ids"].to_list(), k)
        return pdf[place].assign(cid=ids, cd=d, leaf=pdf["leaf"])
    found = shape + ", cid array<long>, cd array<double>"
    near = entries.groupBy("leaf").applyInPandas(own, found + ", leaf long").checkpoint()

    def visits(slots):
        def run(batches):
            for b in batches:
                g, x = b["g"].to_numpy(), b[xs].to_numpy()
                ball = np.array([math.sqrt(d[k]) * (1 + 1e-9) if len(d) > k else np.inf for d in b["cd"]], dtype=float)
                row, leaf = tree.reach(g, x, ball)
                other = leaf != b["leaf"].to_numpy()[row]
                row, leaf = row[other], leaf[other]
                out = b[place].iloc[row].assign(ball=ball[row], leaf=leaf)
                of = pd.util.hash_pandas_object(out[place], index=False).to_numpy()
                n = np.array([slots.get(v, 1) for v in leaf.tolist()], dtype=np.uint64)
                yield out.assign(slot=(of % n).astype(np.int64) if len(n) else 0)
        return near.mapInPandas(run, shape + ", ball double, leaf long, slot long")

    count = visits({}).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a leaf, bounded by the sample
    slots = {r["leaf"]: -(-r["n"] // slot_rows) for r in count}

    def copies(batches):
        for b in batches:
            n = b["leaf"].map(lambda v: slots.get(v, 0)).to_numpy()
            out = b.iloc[np.repeat(np.arange(len(b)), n)]
            yield out.assign(slot=np.concatenate([np.arange(c) for c in n]).astype(np.int64) if n.sum() else 0)
    there = entries.mapInPandas(copies, shape + ", ids array<long>, leaf long, slot long")

    def visit(q, p):
        if not len(q) or not len(p):
            return pd.DataFrame(columns=[*place, "cid", "cd"])
        ids, d = _search(q["g"].to_numpy(), q[xs].to_numpy(), q["ball"].to_numpy() ** 2, p["g"].to_numpy(), p[xs].to_numpy(),
                         p["ids"].to_list(), k)
        return q[place].assign(cid=ids, cd=d)
    more = visits(slots).groupBy("leaf", "slot").cogroup(there.groupBy("leaf", "slot")).applyInPandas(visit, found)

    cand = near.drop("leaf").unionByName(more).select(*place, F.explode(F.arrays_zip("cd", "cid")).alias("c"))
    best = F.row_number().over(Window.partitionBy(*place).orderBy("c.cd", "c.cid"))
    cand = cand.withColumn("r", best).filter(F.col("r") <= k + 1).groupBy(*place).agg(F.sort_array(F.collect_list("c")).alias("c"))
    # read back from the checkpoint, so that adaptive execution may split a place that holds many rows
    out = base.join(cand.checkpoint(), place)
    out = out.withColumn("c", F.slice(F.filter("c", lambda e: e["cid"] != F.col("id")), 1, k))
    out = out.select(*ks, "id", F.posexplode("c").alias("rank", "c"))
    return out.select(*[F.col(n).alias(c) for n, c in zip(ks, keys)], F.col("id").alias(id_col), (F.col("rank") + 1).alias("rank"),
                      F.col("c.cid").alias("neighbour"), F.sqrt("c.cd").alias("distance"))


def silhouette(df: DataFrame, cols: Sequence[str], label: str, score_rows: int | None = None, block_rows: int = 8_192) -> DataFrame:
    """K3: mean Euclidean silhouette, ``(label, n, silhouette, error)`` per cluster and
    for ``__all__``.  The own-cluster mean leaves the row itself out; a cluster of
    one and a lone cluster score 0.  Without ``score_rows`` every row is scored
    and the error is 0; with it the error is the standard error of the mean over
    the scored different rows, each with its number of copies."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    xs = [f"x{j}" for j in range(len(cols))]
    d = clean_numeric(df.select(F.col(label).alias("label"), *[(F.col(c).cast("double") + 0.0).alias(x) for c, x in zip(cols, xs)])
                      .filter("label is not null"), xs)
    d = d.groupBy("label", *xs).agg(F.count(F.lit(1)).alias("w")).checkpoint()
    size = {r[0]: r[1] for r in d.groupBy("label").agg(F.sum("w")).collect()}  # one row a cluster
    names, m = sorted(size), d.count()
    place, n = {v: i for i, v in enumerate(names)}, np.array([size[v] for v in names], dtype=float)
    h, scored = F.xxhash64("label", *xs), d
    if score_rows and m > score_rows:
        scored = d.filter(F.shiftrightunsigned(h, 11) < F.lit(int(2 ** 53 * score_rows / m)))
    blocks = max(1, -(-min(m, score_rows or m) // block_rows))
    total = [np.zeros(4) for _ in names]  # weight, sum, sum of squares, rows
    for b in range(blocks):
        rows = scored.filter(F.pmod(F.xxhash64(h), F.lit(blocks)) == b).select("label", "w", *xs).collect()
        if not rows:
            continue
        held = spark.sparkContext.broadcast(np.array([r[2:] for r in rows], dtype=float))

        def add(batches):
            q = held.value
            middle = q.mean(0)  # distances between rows far from the origin keep their digits
            q = q - middle
            sums, step = np.zeros((len(q), len(names))), 0
            for pdf in batches:
                x, w, c = pdf[xs].to_numpy(), pdf["w"].to_numpy(), pdf["label"].map(place).to_numpy()
                hot = np.zeros((len(x), len(names)))
                hot[np.arange(len(x)), c] = w
                x = x - middle
                step = 512
                for t in range(0, len(x), CACHED // step):
                    u, v = x[t:t + CACHED // step], hot[t:t + CACHED // step]
                    for s in range(0, len(q), step):
                        sums[s:s + step] += _distances(q[s:s + step], u) @ v
            if step:
                yield pd.DataFrame({"i": np.arange(len(q)), **{f"s{j}": sums[:, j] for j in range(len(names))}})
        part = d.mapInPandas(add, "i long, " + ", ".join(f"s{j} double" for j in range(len(names))))
        got = part.groupBy("i").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(len(names))]).orderBy("i").collect()
        s = np.array([r[1:] for r in got], dtype=float)
        held.unpersist()
        own = np.array([place[r["label"]] for r in rows])
        w, at = np.array([r["w"] for r in rows], dtype=float), np.arange(len(rows))
        a = s[at, own] / np.maximum(1, n[own] - 1)
        mean = s / n
        mean[at, own] = np.inf
        near = mean.min(1)
        top = np.maximum(a, near)
        ok = (n[own] > 1) & np.isfinite(near) & (top > 0)
        v = np.where(ok, (near - a) / np.where(ok, top, 1), 0.0)
        for j in range(len(names)):
            u = own == j
            total[j] += [w[u].sum(), (w * v)[u].sum(), (w * v * v)[u].sum(), u.sum()]
    whole = scored is d

    def line(name, t, rows):
        if not t[0]:
            return (name, int(rows), None, None)
        mean = t[1] / t[0]
        spread = max(0.0, t[2] / t[0] - mean * mean)
        return name, int(rows), float(mean), 0.0 if whole else math.sqrt(spread / max(1, t[3] - 1))
    out = [line(str(v), t, c) for v, t, c in zip(names, total, n)]
    if names:
        out.append(line("__all__", sum(total), n.sum()))
    return spark.createDataFrame(out, "label string, n long, silhouette double, error double").withColumnRenamed("label", label)
