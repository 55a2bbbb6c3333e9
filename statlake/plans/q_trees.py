"""Trees grown level by level: nodes, held-out confusion and the full grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import learn, trees
from statlake.plans.common import rnd
from statlake.plans.q_learn import DOC_F, _doc_features
from statlake.plans.registry import register
from statlake.sources.tables import table

LINE_F = ["l_quantity", "l_discount", "l_tax"]
LEAF = 20


def _level_sql(i: int) -> str:
    """Best split of every node of level i (rows ``r{i}``), and the rows one level down."""
    impure = " + ".join(f"({t} > 0)::INT" for t in ("ta", "tn", "tr"))
    side = lambda p, n: f"(1 - ({p}a*{p}a + {p}n*{p}n + {p}r*{p}r) / ({n}*{n}))"
    return f"""
long{i} AS ({" UNION ALL ".join(f"SELECT path, y, {j} AS f, {c} AS v FROM r{i}" for j, c in enumerate(LINE_F))}),
cells{i} AS (SELECT path, f, v, count(*) FILTER (y = 'A') AS a, count(*) FILTER (y = 'N') AS n, count(*) FILTER (y = 'R') AS r
             FROM long{i} GROUP BY ALL),
cum{i} AS (SELECT path, f, v, lead(v) OVER w AS nv, (sum(a) OVER w)::DOUBLE AS la, (sum(n) OVER w)::DOUBLE AS ln,
                  (sum(r) OVER w)::DOUBLE AS lr, (sum(a) OVER p)::DOUBLE AS ta, (sum(n) OVER p)::DOUBLE AS tn,
                  (sum(r) OVER p)::DOUBLE AS tr
           FROM cells{i} WINDOW w AS (PARTITION BY path, f ORDER BY v), p AS (PARTITION BY path, f)),
side{i} AS (SELECT *, ta - la AS ra, tn - ln AS rn, tr - lr AS rr, la + ln + lr AS nl, ta + tn + tr AS nt,
                   ta + tn + tr - la - ln - lr AS nr FROM cum{i}),
cost{i} AS (SELECT *, (nl * {side("l", "nl")} + nr * {side("r", "nr")}) / nt AS cost, {side("t", "nt")} AS own
            FROM side{i} WHERE nl >= {LEAF} AND nr >= {LEAF} AND {impure} > 1),
best{i} AS (SELECT path, f, (v + nv) / 2 AS thr, own - cost AS gain FROM cost{i}
            QUALIFY row_number() OVER (PARTITION BY path ORDER BY round(cost, 12), f, v) = 1),
r{i + 1} AS (SELECT r.path || CASE WHEN (CASE b.f {" ".join(f"WHEN {j} THEN {c}" for j, c in enumerate(LINE_F))} END) <= b.thr
                               THEN 'L' ELSE 'R' END AS path, y, {", ".join(LINE_F)}
             FROM r{i} r JOIN best{i} b ON r.path = b.path),"""


def _nodes_sql(levels: int) -> str:
    names = " ".join(f"WHEN {j} THEN '{c}'" for j, c in enumerate(LINE_F))
    rows = " UNION ALL ".join(f"SELECT path, y FROM r{i}" for i in range(levels + 1))
    best = " UNION ALL ".join(f"SELECT * FROM best{i}" for i in range(levels))
    return f"""
WITH r0 AS (SELECT '' AS path, l_returnflag AS y, {", ".join(f"{c}::DOUBLE AS {c}" for c in LINE_F)} FROM lineitem),
{"".join(_level_sql(i) for i in range(levels))}
counts AS (SELECT path, count(*) AS n, count(*) FILTER (y = 'A') AS n_a, count(*) FILTER (y = 'N') AS n_n,
                  count(*) FILTER (y = 'R') AS n_r FROM ({rows}) GROUP BY path),
best AS ({best})
SELECT c.path, length(c.path)::BIGINT AS depth, CASE b.f {names} END AS feature, round(b.thr, 9) AS threshold,
       round(b.gain, 9) AS gain, c.n, n_a, n_n, n_r,
       CASE WHEN n_a >= n_n AND n_a >= n_r THEN 'A' WHEN n_n >= n_r THEN 'N' ELSE 'R' END AS pred
FROM counts c LEFT JOIN best b ON c.path = b.path"""


@register("tree_nodes_lineitem", _nodes_sql(3))
def tree_nodes_lineitem(spark, sf):
    """M5 + M6: the gini tree of depth 3 (leaf >= 20) that tells the return
    flag from quantity, discount and tax, node by node."""
    li = table(spark, sf, "lineitem").select("l_returnflag", *LINE_F, F.lit(0).alias("part"))
    forest = trees.Forest(li, LINE_F, "l_returnflag", "part", [trees.Spec(0, -1, "gini", LEAF)], [(3, 2)])
    label = {v: i for i, v in enumerate(forest.labels)}

    def count(c):
        return F.get("counts", F.lit(label[c])) if c in label else F.lit(0).cast("long")
    nodes = forest.nodes()
    forest.close()
    return nodes.select(
        "path", F.col("depth").cast("long").alias("depth"), "feature", rnd("threshold", 9).alias("threshold"),
        rnd("gain", 9).alias("gain"), "n", count("A").alias("n_a"), count("N").alias("n_n"), count("R").alias("n_r"),
        F.get(F.array(*[F.lit(v) for v in forest.labels]), F.col("pred")).alias("pred"))


@register("tree_grid_documents")
def tree_grid_documents(spark, sf):
    """M2 + M4: all 180 settings of the reference grid (criterion × depth,
    unlimited too × min_samples_split × min_samples_leaf) by accuracy over five
    stratified folds of the training 75 %, ranked, with the accuracy on the
    held-out 25 %."""
    d = learn.stratified_split(_doc_features(spark, sf), "quality", "doc_id", 0.25).withColumnRenamed("is_test", "test_row")
    d = learn.stratified_folds(d.filter("not test_row"), "quality", "doc_id", 5).unionByName(
        d.filter("test_row").withColumn("fold", F.lit(-1)))
    names = ["criterion", "max_depth", "min_samples_split", "min_samples_leaf", "mean_accuracy", "sd_accuracy", "rank", "test_accuracy"]
    rows = [tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in names) for r in trees.grid_scores(d, DOC_F, "quality")]
    return spark.createDataFrame(rows, "criterion string, max_depth long, min_samples_split long, min_samples_leaf long, "
                                       "mean_accuracy double, sd_accuracy double, rank long, test_accuracy double")
