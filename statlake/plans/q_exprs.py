"""Registered queries: scalar expressions, cleaning, joins, sorting, top-k, IO."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from statlake.functions import exprs
from statlake.operators.ranks import exact_quantiles
from statlake.plans.common import rnd
from statlake.plans.registry import register
from statlake.sources.files import to_kv
from statlake.sources.tables import monthly_order_totals, table


@register("clean_clip_bins_lineitem", """
WITH d AS (SELECT l_returnflag, l_quantity,
                  CASE WHEN l_discount IS NULL THEN NULL ELSE greatest(0.02, least(0.08, l_discount)) END AS disc_c,
                  CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'small' WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'mid'
                       WHEN l_quantity > 25 THEN 'large' END AS qbin
           FROM lineitem WHERE l_quantity IS NOT NULL AND isfinite(l_quantity) AND l_extendedprice IS NOT NULL
                 AND isfinite(l_extendedprice) AND l_extendedprice > 1000)
SELECT l_returnflag, qbin, count(*)::BIGINT AS n, round(avg(disc_c), 6) AS avg_disc_clipped,
       round(avg(l_quantity), 6) AS avg_qty FROM d GROUP BY 1, 2""")
def clean_clip_bins_lineitem(spark, sf):
    """Finite-value cleaning, threshold filter (pushed to the scan),
    two-sided clip of discount to [0.02, 0.08] and right-closed quantity bins."""
    li = table(spark, sf, "lineitem")
    d = exprs.clean_numeric(li, ["l_quantity", "l_extendedprice"]).filter(F.col("l_extendedprice") > 1000)
    d = d.select("l_returnflag", "l_quantity", exprs.clip("l_discount", 0.02, 0.08).alias("disc_c"),
                 exprs.bin_right("l_quantity", [0, 10, 25, float("inf")], ["small", "mid", "large"]).alias("qbin"))
    return d.groupBy("l_returnflag", "qbin").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("disc_c")).alias("avg_disc_clipped"),
                                                 rnd(F.avg("l_quantity")).alias("avg_qty"))


@register("quantile_classes_lineitem", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.33) AS q1, quantile_cont(l_extendedprice, 0.66) AS q2
           FROM lineitem GROUP BY 1)
SELECT l_returnflag, CASE WHEN l_extendedprice < q1 THEN 'Low' WHEN l_extendedprice < q2 THEN 'Med' ELSE 'High' END AS cls,
       count(*)::BIGINT AS n FROM lineitem JOIN q USING (l_returnflag) GROUP BY 1, 2""")
def quantile_classes_lineitem(spark, sf):
    """Low/Med/High by exact 0.33/0.66 quantiles of price per flag."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    q = exact_quantiles(li, "l_extendedprice", [0.33, 0.66], ["l_returnflag"])
    w = q.groupBy("l_returnflag").agg(F.max(F.when(F.col("q") == 0.33, F.col("quantile"))).alias("q1"),
                                      F.max(F.when(F.col("q") == 0.66, F.col("quantile"))).alias("q2"))
    d = li.join(w, "l_returnflag")
    cls = F.when(F.col("l_extendedprice") < F.col("q1"), "Low").when(F.col("l_extendedprice") < F.col("q2"), "Med").otherwise("High")
    return d.groupBy("l_returnflag", cls.alias("cls")).agg(F.count(F.lit(1)).alias("n"))


@register("pv_physics_events", f"""
WITH e AS (SELECT event_id, value*50.0 AS g, 20.0 + hour(ts)/2.0 AS ta, (user_id % 10)/2.0 AS wind,
                  greatest(cos(pi()*(hour(ts) - 12)/24.0), 0.0) AS cos_theta FROM events),
c AS (SELECT *, ta + (g/800.0)*25.0 - 3.0*wind AS t_cell FROM e)
SELECT event_id, round(g*(1.0 - 0.0045*(t_cell - 25.0)), 9) AS g_stab, round(t_cell, 6) AS t_cell,
       round(greatest(0.18*(1.0 - 0.004*(t_cell - 25.0))*g*1.6*cos_theta, 0.0), 6) AS power,
       round(ln(g), 6) AS ln_g, round(exp(ln(g)), 6) AS g_back FROM c WHERE g > 0""")
def pv_physics_events(spark, sf):
    """Irradiance-like signal from event values; stabilised
    irradiance, cell temperature, clipped PV power, ln and its inverse."""
    ev = table(spark, sf, "events")
    d = ev.select("event_id", (F.col("value") * 50.0).alias("g"), (20.0 + F.hour("ts") / 2.0).alias("ta"),
                  ((F.col("user_id") % 10) / 2.0).alias("wind"),
                  F.greatest(F.cos(F.lit(math.pi) * (F.hour("ts") - 12) / 24.0), F.lit(0.0)).alias("cos_theta"))
    d = d.filter(F.col("g") > 0).withColumn("t_cell", exprs.cell_temperature("ta", "g", "wind"))
    # g_stab is an exact decimal of up to 11 places; 9 places was checked to
    # round identically in both engines (DuckDB rounds by float multiply)
    return d.select("event_id", rnd(exprs.stabilize_irradiance("g", "t_cell"), 9).alias("g_stab"), rnd("t_cell").alias("t_cell"),
                    rnd(exprs.pv_power("g", "t_cell", "cos_theta")).alias("power"), rnd(F.log("g")).alias("ln_g"),
                    rnd(F.exp(F.log("g"))).alias("g_back"))


@register("daily_profile_events", """
WITH d AS (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1),
h AS (SELECT day, n, hour FROM d, range(0, 24) t(hour)),
p AS (SELECT day, n, hour, greatest(sin(pi()*(hour - 6)/12.0), 0.0)*1000.0 AS irr FROM h)
SELECT strftime(day, '%Y-%m-%d') AS day, hour::BIGINT AS hour, round(irr, 6) AS irradiance,
       round(irr/1000.0*(n/100.0)*0.2, 6) AS dc_kw, round(irr/1000.0*(n/100.0)*0.2*0.96, 6) AS ac_kw FROM p""")
def daily_profile_events(spark, sf):
    """E11 + E17: hourly clear-sky profile for every event day; panel area
    grows with the day's event count (n/100 m²), efficiency 0.2."""
    ev = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    ev = ev.withColumn("_area", F.col("n") / 100.0)
    out = ev.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    irr = F.greatest(F.sin(F.lit(math.pi) * (F.col("hour") - F.lit(6)) / F.lit(12.0)), F.lit(0.0)) * 1000.0
    out = out.withColumn("irradiance", irr).withColumn("dc_kw", F.col("irradiance") / 1000.0 * F.col("_area") * 0.2)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("hour").cast("long").alias("hour"),
                      rnd("irradiance").alias("irradiance"), rnd("dc_kw").alias("dc_kw"),
                      rnd(F.col("dc_kw") * 0.96).alias("ac_kw"))


@register("scaling_part", """
WITH s AS (SELECT min(p_retailprice) AS mn, max(p_retailprice) AS mx, avg(p_size) AS mu, stddev_pop(p_size) AS sd FROM part)
SELECT p_partkey, round((p_retailprice - mn)/CASE WHEN mx - mn = 0 THEN 1e-6 ELSE mx - mn END, 9) AS price_01,
       round((p_size - mu)/sd, 9) AS size_z, round(sqrt(p_retailprice*p_retailprice + p_size*p_size), 6) AS norm
FROM part, s""")
def scaling_part(spark, sf):
    """min–max scaling (zero range → 1e-6), z-score with the
    population σ and the Euclidean norm of (price, size)."""
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    p = exprs.minmax_scale(p, ["p_retailprice"], suffix="_01")
    p = exprs.standardize(p, ["p_size"], suffix="_z")
    return p.select("p_partkey", rnd("p_retailprice_01", 9).alias("price_01"), rnd("p_size_z", 9).alias("size_z"),
                    rnd(exprs.norm2(["p_retailprice", "p_size"])).alias("norm"))


@register("embedding_norms", """
SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))), 6) AS norm,
       round(list_sum(list_transform(list_zip(list_slice(embedding, 1, 32), list_slice(embedding, 33, 64)),
                                     lambda p: p[1]::DOUBLE * p[2]::DOUBLE)), 6) AS half_dot FROM embeddings""")
def embedding_norms(spark, sf):
    """Array norm and the dot product of the two halves of each
    embedding (zip_with + aggregate, JVM side)."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    return e.select("vec_id", rnd(F.sqrt(exprs.array_dot("v", "v"))).alias("norm"),
                    rnd(exprs.array_dot(F.slice("v", 1, 32), F.slice("v", 33, 32))).alias("half_dot"))


@register("aligned_monthly", """
WITH o AS (SELECT date_trunc('month', o_orderdate)::DATE AS ts, sum(o_totalprice) AS orders_total FROM orders GROUP BY 1),
l AS (SELECT date_trunc('month', l_shipdate)::DATE AS ts, sum(l_extendedprice) AS ship_revenue, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT strftime(ts, '%Y-%m-%d') AS ts, round(orders_total, 2) AS orders_total, round(ship_revenue, 2) AS ship_revenue,
       lines::BIGINT AS lines, 1.0 AS intercept FROM o JOIN l USING (ts)""")
def aligned_monthly(spark, sf):
    """J5 + J6: exogenous and endogenous monthly series aligned by month
    (inner join) with a constant intercept column."""
    o = table(spark, sf, "orders").groupBy(exprs.month_start("o_orderdate").alias("ts")).agg(
        F.sum("o_totalprice").alias("orders_total"))
    li = table(spark, sf, "lineitem").groupBy(exprs.month_start("l_shipdate").alias("ts")).agg(
        F.sum("l_extendedprice").alias("ship_revenue"), F.count(F.lit(1)).alias("lines"))
    j = o.join(li, "ts").withColumn("intercept", F.lit(1.0))
    return j.select(F.date_format("ts", "yyyy-MM-dd").alias("ts"), rnd("orders_total", 2).alias("orders_total"),
                    rnd("ship_revenue", 2).alias("ship_revenue"), F.col("lines").cast("long").alias("lines"), "intercept")


@register("topk_parts", """
SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1
ORDER BY sum(l_extendedprice) DESC, l_partkey LIMIT 10""")
def topk_parts(spark, sf):
    """J7 + J8: ten parts with the largest revenue (ties by key) — the
    limit is the feature; Spark plans it as TakeOrderedAndProject."""
    r = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("_rev"))
    return r.orderBy(F.desc("_rev"), "l_partkey").limit(10).select("l_partkey", rnd("_rev", 2).alias("revenue"))


@register("argminmax_orders", """
WITH s AS (SELECT o_orderpriority AS series_key, date_trunc('month', o_orderdate)::DATE AS ts, sum(o_totalprice) AS value
           FROM orders GROUP BY 1, 2)
SELECT series_key, strftime(max({'v': value, 't': ts}).t, '%Y-%m-%d') AS best_month,
       strftime(min({'v': value, 't': ts}).t, '%Y-%m-%d') AS worst_month, round(max(value), 2) AS best_value
FROM s GROUP BY 1""")
def argminmax_orders(spark, sf):
    """Month of the highest and lowest order total per priority (ties
    broken by month through struct ordering)."""
    s = monthly_order_totals(spark, sf)
    g = s.groupBy("series_key").agg(F.max(F.struct("value", "ts")).alias("b"), F.min(F.struct("value", "ts")).alias("w"))
    return g.select("series_key", F.date_format("b.ts", "yyyy-MM-dd").alias("best_month"),
                    F.date_format("w.ts", "yyyy-MM-dd").alias("worst_month"), rnd("b.value", 2).alias("best_value"))


@register("stacked_groups_embeddings", """
SELECT 'low' AS part, label, count(*)::BIGINT AS n FROM embeddings WHERE label < 5 GROUP BY 2
UNION ALL SELECT 'high', label, count(*)::BIGINT FROM embeddings WHERE label >= 5 GROUP BY 2""")
def stacked_groups_embeddings(spark, sf):
    """Vertical stack (unionByName) of the two label ranges (together
    the whole table), counted per label."""
    e = table(spark, sf, "embeddings").select("label")
    a = e.filter(F.col("label") < 5).withColumn("part", F.lit("low"))
    b = e.filter(F.col("label") >= 5).withColumn("part", F.lit("high"))
    return a.unionByName(b).groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"))


@register("kv_report_orders", """
SELECT metric, value FROM (
  SELECT round(count(*)::DOUBLE, 6) AS n, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std,
         round(min(o_totalprice), 6) AS min, round(max(o_totalprice), 6) AS max FROM orders)
UNPIVOT (value FOR metric IN (n, mean, std, min, max))""")
def kv_report_orders(spark, sf):
    """IO3: a one-row summary unpivoted to ``(metric, value)`` rows."""
    o = table(spark, sf, "orders")
    one = o.agg(rnd(F.count(F.lit(1)).cast("double")).alias("n"), rnd(F.avg("o_totalprice")).alias("mean"),
                rnd(F.stddev_samp("o_totalprice")).alias("std"), rnd(F.min("o_totalprice")).alias("min"),
                rnd(F.max("o_totalprice")).alias("max"))
    kv = to_kv(one)
    return kv.select("metric", F.col("value").cast("double").alias("value"))
