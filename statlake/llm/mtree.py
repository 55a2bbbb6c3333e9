"""Exact top-k inner products by best-first search of M-trees (operator 1).

Vectors are integers: floor(64 * x) of each component.  With M the largest
squared length, the extra coordinate sqrt(M - |x|^2) puts every vector on one
sphere, and the largest inner products with q become the smallest Euclidean
distances: d^2 = |q|^2 + M - 2 q.x.  An M-tree can then search them exactly.

1. Equal vectors become one entry with its k + 1 smallest ids.  No more can be
   asked for: ties go to the smaller id, and a query leaves out its own id only.
2. Entries go to the nearest of ``PIVOTS`` pivots, and each pivot's entries to
   as many cells as it takes to keep a cell near ``CELL`` entries, so that a
   crowded region is spread over tasks.
3. Each cell bulk-loads an M-tree: pages of routing objects with covering
   radius and distance to the parent's object, down to pages of entries.
4. Queries, in blocks, visit every cell whose ball can hold a better score
   than their bound (the best of a fixed sample to start with), and search
   its tree best first, each in its own order; queries that stand at the same
   page share a product.  ``| d(q, parent) - d(entry, parent) | - radius``
   is a lower bound that costs nothing; only entries below it are computed.
5. The k best of each cell meet in a window by query.

Distances only prune, with a margin for rounding; scores are exact integers.

Defined cases: null vectors and those with null or non-finite components take
no part; shorter vectors count as padded with zeros; rows that repeat id and
vector count once; a query with fewer candidates returns all; an empty table
gives an empty result.  Vectors whose squared length is 2**50 or more stay out
of the trees: they are compared in blocks, by floats with an error bound and,
where that leaves a choice, by integers of any size; a score in the result that
64 bits can't hold is an error.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm import store

PIVOTS, SAMPLE = 16, 2048  # fixed sizes of what the driver holds
CELL, QUERIES, PAGE = 4096, 4096, 256
WIDE = 2.0 ** 50  # squared length from which products of floats may not be exact


def scale(vectors: DataFrame, factor: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, v array<double>, wide)`` of the vectors that take part: whole
    numbers, wide if their products can pass what floats hold exactly."""
    d = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("e"))
    fine = F.col("e").isNotNull() & F.forall("e", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = lambda x: F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x) + F.lit(0.0)
    length2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    return (d.filter(F.col("vec_id").isNotNull() & fine)
            .select("vec_id", F.transform("e", lambda x: whole(x * factor)).alias("v")).distinct()
            .withColumn("wide", length2 >= WIDE))


def _exact_blocks(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The k best of each query in each block of candidates, any numbers: ``query_id,
    vec_id, score, over``; a score beyond 64 bits is cut there and marked over."""
    n_q, n_c = (max(1, -(-x.count() // QUERIES)) for x in (queries, candidates))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(F.col("vec_id").alias("query_id"), "v", deal("vec_id", n_q).alias("block")).withColumn("cell", every(n_c))
    c = candidates.select("vec_id", "v", deal("vec_id", n_c).alias("cell")).withColumn("block", every(n_q))

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            dim = max(1, *map(len, a["v"]), *map(len, b["v"]))
            x, ids = _matrix(b["v"], dim, np.float64), b["vec_id"].to_numpy()
            for own, v in zip(a["query_id"], _matrix(a["v"], dim, np.float64), strict=True):
                with np.errstate(all="ignore"):
                    about = x @ v
                    error = np.sqrt(np.einsum("ij,ij->i", x, x)) * math.sqrt(v @ v) * dim * 2.0 ** -50
                unsure = ~np.isfinite(about) | ~np.isfinite(error)
                low, high = np.where(unsure, -np.inf, about - error), np.where(unsure, np.inf, about + error)
                rows = np.flatnonzero(ids != own)
                if len(rows) > k:
                    rows = rows[high[rows] >= np.partition(low[rows], len(rows) - k)[len(rows) - k]]
                whole = [int(p) for p in v]
                best = sorted((-sum(p * int(y) for p, y in zip(whole, x[r])), int(ids[r])) for r in rows)[:k]
                found += [(own, i, min(max(-s, -(2 ** 63)), 2 ** 63 - 1), not -(2 ** 63) <= -s < 2 ** 63) for s, i in best]
        out = pd.DataFrame(found, columns=["query_id", "vec_id", "score", "over"])
        return out.astype({"query_id": "int64", "vec_id": "int64", "score": "int64", "over": "bool"})
    keys = ["block", "cell"]
    return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long, over boolean")


def _matrix(col, dim: int, kind=np.int64) -> np.ndarray:
    """Rows of an Arrow or pandas column of lists of whole numbers, padded to ``dim``."""
    rows = col.to_pylist() if hasattr(col, "to_pylist") else list(col)
    out = np.zeros((len(rows), dim), kind)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


class Space:
    """The sphere: ``dim`` integer coordinates and one that completes the length to ``top``."""

    def __init__(self, dim: int, top: int):
        self.dim, self.top = dim, top
        self.exact = top < 1 << 52  # float products of integers are exact

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        rest = np.sqrt(np.maximum(0.0, self.top - np.einsum("ij,ij->i", x, x)))
        return np.concatenate([x, rest[:, None]], 1)

    def scores(self, x: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.exact:
            return np.rint(x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return x.astype(np.int64) @ q.astype(np.int64)

    def radius(self, length2: float, score: float) -> float:
        """The distance at which a query of that squared length has this score."""
        return math.sqrt(max(0.0, length2 + self.top - 2.0 * score))


class Page:
    __slots__ = ("entries", "parent", "radius", "children")

    def __init__(self, entries, parent, radius, children):
        self.entries, self.parent, self.radius, self.children = entries, parent, radius, children


class MTree:
    """Bulk-loaded over the rows of ``x``; deterministic."""

    def __init__(self, space: Space, x: np.ndarray, page: int = PAGE):
        self.space, self.x, self.page = space, x, page
        self.z = space.lift(x)
        self.f = x.astype(np.float64)
        self.computed = 0
        self.root = self._build(np.arange(len(x)), None)

    def _far(self, rows: np.ndarray, row: int) -> np.ndarray:
        d = self.z[rows] - self.z[row]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _build(self, rows: np.ndarray, parent: int | None) -> Page:
        to_parent = self._far(rows, parent) if parent is not None else None
        if len(rows) <= self.page:
            return Page(rows, to_parent, None, None)
        k = min(self.page, -(-len(rows) // (self.page // 2)))
        routes = rows[np.linspace(0, len(rows) - 1, k).astype(int)]
        # distances to all routes by one product; the exact ones are taken again below
        near = np.argmin(-2 * self.z[rows] @ self.z[routes].T + (self.z[routes] ** 2).sum(1), axis=1)
        groups = [rows[near == i] for i in range(k)]
        if max(map(len, groups)) == len(rows):  # nothing apart: cut in order
            groups = np.array_split(rows, k)
        entries, radius, children = [], [], []
        for route, group in zip(routes, groups, strict=True):
            if len(group):
                entries.append(route)
                radius.append(self._far(group, route).max())
                children.append(self._build(group, route))
        entries = np.array(entries)
        return Page(entries, self._far(entries, parent) if parent is not None else None, np.array(radius), children)

    def search(self, q: np.ndarray, own: int, k: int, ids: list, least: float) -> list[tuple[int, int]]:
        """The k best (score, id) with score of at least ``least``, best first."""
        return self.search_many(q[None, :], [own], k, ids, np.array([least], float))[0]

    def search_many(self, q: np.ndarray, own: list[int], k: int, ids: list, least: np.ndarray) -> list[list[tuple[int, int]]]:
        """``search`` for the rows of ``q``.  Every query visits its own pages
        best first and stops by its own bound; in a round each takes its next
        page, and queries that meet at a page share one matrix product."""
        qf = q.astype(np.float64)
        length2 = np.einsum("ij,ij->i", qf, qf)
        base = length2 + self.space.top
        margin = 1e-6 * (1 + np.sqrt(base))
        floor = np.array(least, float)
        reach = np.full(len(q), np.inf)
        some = np.isfinite(floor)
        reach[some] = np.sqrt(np.maximum(0.0, base[some] - 2 * floor[some]))
        best: list[list[tuple[int, int]]] = [[] for _ in q]  # heaps: worst on top, as (score, -id)
        queues: list[list] = [[] for _ in q]  # (low, tie, page, children in order, place, lows, distances)
        groups = {id(self.root): (self.root, list(range(len(q))), None, None)}
        n = 0
        while groups:
            for page, members, to_parent, lows in groups.values():
                at = np.array(members)
                limit = (reach + margin)[at]
                if to_parent is None:
                    need = np.ones((len(at), len(page.entries)), bool)
                else:
                    bound = np.abs(page.parent[None, :] - np.array(to_parent)[:, None])
                    if page.radius is not None:
                        bound -= page.radius[None, :]
                    need = bound <= limit[:, None]
                cols = np.flatnonzero(need.any(0))
                if not len(cols):
                    continue
                need = need[:, cols]
                self.computed += int(need.sum())
                rows = page.entries[cols]
                products = qf[at] @ self.f[rows].T
                if page.children is not None:
                    d = np.sqrt(np.maximum(0.0, base[at][:, None] - 2 * products))
                    low = d - page.radius[cols][None, :]
                    if lows is not None:
                        low = np.maximum(low, np.array(lows)[:, None])
                    low[~need] = np.inf
                    order = np.argsort(low, axis=1, kind="stable")
                    for r, i in enumerate(members):
                        if low[r, order[r, 0]] <= limit[r]:
                            n += 1
                            heapq.heappush(queues[i], (float(low[r, order[r, 0]]), n, page, cols[order[r]], 0, low[r, order[r]], d[r, order[r]]))
                    continue
                scores = np.rint(products).astype(np.int64) if self.space.exact else \
                    np.stack([self.space.scores(self.x[rows], q[i]) for i in members])
                r_hit, c_hit = np.nonzero(need & (scores >= floor[at][:, None]))
                changed = set()
                for r, c in zip(r_hit.tolist(), c_hit.tolist(), strict=True):
                    i, s = members[r], int(scores[r, c])
                    heap = best[i]
                    for v in ids[rows[c]]:
                        if v == own[i]:
                            continue
                        if len(heap) < k:
                            heapq.heappush(heap, (s, -v))
                        elif (s, -v) > heap[0]:
                            heapq.heapreplace(heap, (s, -v))
                        else:
                            break
                    changed.add(i)
                for i in changed:
                    if len(best[i]) == k:
                        floor[i] = best[i][0][0]
                        reach[i] = min(reach[i], math.sqrt(max(0.0, base[i] - 2 * floor[i])))
            groups = {}
            for i, queue in enumerate(queues):
                if queue and queue[0][0] <= reach[i] + margin[i]:
                    low, tie, page, order, place, lows, d = queue[0]
                    child = page.children[order[place]]
                    got = groups.get(id(child))
                    if got is None:
                        groups[id(child)] = (child, [i], [d[place]], [low])
                    else:
                        got[1].append(i)
                        got[2].append(d[place])
                        got[3].append(low)
                    if place + 1 < len(order) and lows[place + 1] < np.inf:
                        heapq.heapreplace(queue, (float(lows[place + 1]), tie, page, order, place + 1, lows, d))
                    else:
                        heapq.heappop(queue)
        return [[(s, -v) for s, v in sorted(heap, reverse=True)] for heap in best]


def top_k(vectors: DataFrame, is_query, k: int = 20, factor: float = 64.0, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that ``is_query`` (a
    function of the id column) selects, against all rows."""
    rows = store.table(scale(vectors, factor, id_col, vec_col), "vectors")
    narrow, wide = rows.filter("not wide"), rows.filter("wide")
    hits = _tree_hits(narrow.select("vec_id", F.col("v").cast("array<int>").alias("v")), is_query, k)
    if not wide.isEmpty():
        chosen = lambda d: d.filter(is_query(F.col("vec_id")))
        # written first: a later count must not prune columns out of the grouped tables
        hits = store.table(hits.union(_exact_blocks(chosen(rows), wide, k)).union(_exact_blocks(chosen(wide), narrow, k)), "hits")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    score = F.when(F.col("over"), F.raise_error(F.lit("a score does not fit in 64 bits")).cast("long")).otherwise(F.col("score"))
    return hits.select("query_id", "rank", "vec_id", score.alias("score"))


def _tree_hits(v: DataFrame, is_query, k: int) -> DataFrame:
    """The k best of each query in each cell it visits: ``query_id, vec_id, score, over``."""
    spark = v.sparkSession
    length2 = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)
    facts = v.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.max(length2).alias("top")).first()
    empty = "query_id long, vec_id long, score long, over boolean"
    if not facts["n"]:
        return spark.createDataFrame([], empty)
    space = Space(facts["dim"] or 1, int(facts["top"]))
    dim = space.dim
    salts = max(16, facts["n"] // 100_000)
    smallest = lambda c: F.slice(F.array_sort(c), 1, k + 1)
    entries = (v.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).alias("salt")).agg(smallest(F.collect_list("vec_id")).alias("ids"))
               .groupBy("v").agg(smallest(F.flatten(F.collect_list("ids"))).alias("ids")))
    entries = store.table(entries, "entries")
    sample = _matrix([r["v"] for r in store.sample(entries.select("v"), F.xxhash64("v"), SAMPLE).collect()], dim)
    pivots = space.lift(sample[:PIVOTS])

    def assign(batches):
        for b in batches:
            z = space.lift(_matrix(b.column("v"), dim))
            near = np.empty(len(z), np.int32)
            far = np.empty(len(z))
            for a in range(0, len(z), 4096):
                d = ((z[a:a + 4096, None, :] - pivots[None]) ** 2).sum(2)
                near[a:a + 4096] = d.argmin(1)
                far[a:a + 4096] = np.sqrt(d.min(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near), pa.array(far)], ["v", "ids", "pivot", "far"])
    entries = store.table(entries.mapInArrow(assign, "v array<int>, ids array<long>, pivot int, far double"), "assigned")
    shape = {r["pivot"]: (-(-r["n"] // CELL), r["far"]) for r in
             entries.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    splits = F.create_map(*[F.lit(x) for p, (s, _) in shape.items() for x in (p, s)])
    entries = entries.withColumn("split", F.pmod(F.xxhash64("v"), splits[F.col("pivot")]).cast("int"))
    queries = v.filter(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "v")
    n_blocks = max(1, -(-queries.count() // QUERIES))

    def route(batches):
        sf = sample.astype(np.float64)
        for b in batches:
            q = _matrix(b.column("v"), dim)
            qf = q.astype(np.float64)
            length2 = np.einsum("ij,ij->i", qf, qf)
            if len(sample) > k:
                # the (k+1)-th best of the sample: at least k others score as much
                least = np.floor(np.partition(qf @ sf.T, len(sample) - k - 1, axis=1)[:, len(sample) - k - 1] - 0.5)
            else:
                least = np.full(len(q), -np.inf)
            reach = np.sqrt(np.maximum(0.0, length2 + space.top - 2 * least))
            out = [[], [], []]
            for p, (n_splits, far) in shape.items():
                d = np.sqrt(np.maximum(0.0, length2 + space.top - 2 * qf @ pivots[p, :dim]))
                go = np.flatnonzero(~(d - far > reach + 1e-6 * (1 + reach)))
                for s in range(n_splits):
                    out[0].append(go)
                    out[1].append(np.full(len(go), p))
                    out[2].append(np.full(len(go), s))
            at, p, s = (np.concatenate(x).astype(np.int64) for x in out)
            rows = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(least[at]), pa.array(p.astype(np.int32)), pa.array(s.astype(np.int32))],
                                             ["query_id", "v", "least", "pivot", "split"])
    routed = (queries.mapInArrow(route, "query_id long, v array<int>, least double, pivot int, split int")
              .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")))
    cells = entries.drop("far").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    keys = ["pivot", "split", "block"]

    def search(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(q) and len(e):
            e = e.iloc[np.lexsort(_matrix(e["v"], dim).T[::-1])]
            tree = MTree(space, _matrix(e["v"], dim))
            ids = [list(x) for x in e["ids"]]
            own = [int(x) for x in q["query_id"]]
            for a, hits in zip(own, tree.search_many(_matrix(q["v"], dim), own, k, ids, q["least"].to_numpy(float)), strict=True):
                found += [(a, i, s) for s, i in hits]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")
    hits = routed.groupBy(*keys).cogroup(cells.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    return hits.withColumn("over", F.lit(False))


def op1_query(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, lambda vec_id: vec_id % 20 == 0, k=20)


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.e, b.e) as bigint) as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""
