"""Registered queries: nearest points and the Euclidean silhouette."""

from __future__ import annotations

from statlake.operators import neighbours
from statlake.plans.common import rnd
from statlake.plans.registry import register
from statlake.sources.tables import embedding_points

DIMS = [f"x{i}" for i in range(64)]


@register("nearest_points_embeddings", """
WITH p AS (SELECT vec_id AS id, label::BIGINT AS grp, embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS x1 FROM embeddings),
d AS (SELECT a.grp, a.id, b.id AS neighbour, (a.x0 - b.x0)*(a.x0 - b.x0) + (a.x1 - b.x1)*(a.x1 - b.x1) AS d
      FROM p a JOIN p b ON a.grp = b.grp AND a.id <> b.id)
SELECT grp, id, row_number() OVER (PARTITION BY grp, id ORDER BY d, neighbour)::BIGINT AS rank, neighbour,
       round(sqrt(d), 9) AS distance FROM d QUALIFY rank <= 3""")
def nearest_points_embeddings(spark, sf):
    """The three nearest points of the same label, by the first two coordinates."""
    d = neighbours.knn(embedding_points(spark, sf), "grp", "id", ["x0", "x1"], 3)
    return d.select("grp", "id", d["rank"].cast("long").alias("rank"), "neighbour", rnd("distance", 9).alias("distance"))


@register("silhouette_euclid_embeddings", """
WITH p AS (SELECT vec_id AS id, label::BIGINT AS g, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT a.id, a.g AS own, b.g AS g, sum(list_distance(a.e, b.e)) AS total, count(*) AS n FROM p a CROSS JOIN p b GROUP BY ALL),
v AS (SELECT id, own, max(CASE WHEN g = own THEN total / greatest(n - 1, 1) END) AS a, min(CASE WHEN g <> own THEN total / n END) AS b,
             max(CASE WHEN g = own THEN n END) AS n FROM s GROUP BY id, own),
t AS (SELECT own, CASE WHEN n > 1 AND b IS NOT NULL AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END AS sil FROM v)
SELECT own::VARCHAR AS grp, count(*) AS n, round(avg(sil), 6) AS silhouette FROM t GROUP BY own
UNION ALL SELECT '__all__', count(*), round(avg(sil), 6) FROM t""")
def silhouette_euclid_embeddings(spark, sf):
    """K3: the Euclidean silhouette of the labels over all coordinates, every row scored."""
    d = neighbours.silhouette(embedding_points(spark, sf, 64), DIMS, "grp")
    return d.select("grp", "n", rnd("silhouette").alias("silhouette"))
