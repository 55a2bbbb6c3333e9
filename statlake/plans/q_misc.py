"""Registered queries: economics, text statistics, selection and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions.exprs import monthly_rate
from statlake.functions.safe import div
from statlake.operators import econ, sampling, text
from statlake.plans.common import rnd
from statlake.plans.registry import register
from statlake.sources.tables import table

RM = monthly_rate(0.08)


def _flows(spark, sf):
    li = table(spark, sf, "lineitem")
    m = (li.groupBy(F.col("l_partkey").alias("p_partkey"), F.trunc(F.col("l_shipdate").cast("date"), "month").alias("ts"))
           .agg((F.sum("l_quantity") * 10.0).alias("kwh"),
                F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("_rev"),
                (F.sum(F.col("l_extendedprice") * F.col("l_tax")) / 100.0).alias("maint")))
    m = m.withColumn("tariff", div(F.col("_rev"), F.col("kwh")))
    first = m.groupBy("p_partkey").agg(F.min("ts").alias("_t0"))
    m = m.join(first, "p_partkey").withColumn(
        "t", (F.year("ts") * 12 + F.month("ts") - F.year("_t0") * 12 - F.month("_t0")).cast("long"))
    part = table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") * 50.0).alias("capex"))
    return econ.cash_flows(m.join(part, "p_partkey"), "kwh", "tariff", 5.0, "maint", 3, 20.0)


ECON_SQL = f"""
WITH m AS (SELECT l_partkey AS p_partkey, date_trunc('month', l_shipdate)::DATE AS ts, sum(l_quantity)*10.0 AS kwh,
                  sum(l_extendedprice*(1-l_discount)) AS rev, sum(l_extendedprice*l_tax)/100.0 AS maint
           FROM lineitem GROUP BY 1, 2),
f AS (SELECT m.*, rev/kwh AS tariff, p_retailprice*50.0 AS capex,
             (year(ts)*12 + month(ts)) - min(year(ts)*12 + month(ts)) OVER (PARTITION BY m.p_partkey) AS t
      FROM m JOIN part USING (p_partkey)),
c AS (SELECT *, kwh*tariff AS revenue, 5.0 + maint + CASE WHEN month(ts) = 3 THEN 20.0 ELSE 0.0 END AS costs FROM f),
s AS (SELECT p_partkey, count(*) AS months, any_value(capex) AS capex, sum(costs) AS total_costs, sum(kwh) AS total_kwh,
             sum((revenue - costs)/pow(1.0 + {RM!r}, t)) - any_value(capex) AS npv,
             sum(kwh)/count(*)*12 AS annual_kwh, sum(revenue)/sum(kwh) AS avg_tariff, sum(maint)/count(*)*12 AS opex
      FROM c GROUP BY 1),
p AS (SELECT *, annual_kwh*avg_tariff - opex AS annual_saving FROM s),
q AS (SELECT *, capex / greatest(annual_saving, 1e-6) AS payback_years FROM p)
SELECT p_partkey, months::BIGINT AS months, round(total_costs, 6) AS total_costs,
       round((capex + total_costs)/total_kwh, 6) AS lcoe, round(npv, 3) AS npv,
       round(payback_years, 6) AS payback_years,
       CASE WHEN payback_years > 0 AND payback_years <= 5 THEN 'fast' WHEN payback_years > 5 AND payback_years <= 8 THEN 'mid'
            WHEN payback_years > 8 THEN 'slow' END AS payback_class, annual_saving > 0 AS is_viable
FROM q"""


@register("economics_part", ECON_SQL)
def economics_part(spark, sf):
    """C1–C6 (annual saving feeds the payback; sums of exact cents can sit on
    a rounding tie, so the report shows payback rather than the saving):
    monthly cash flows per part (kWh from quantity, tariff from
    net price, maintenance from tax, March spike), LCOE, NPV at 8 %/year
    (capex at t=0), annual saving, payback years and class."""
    flows = _flows(spark, sf)
    summ = econ.project_summary(flows, ["p_partkey"], "capex", "kwh", "t", 0.08)
    yearly = flows.groupBy("p_partkey").agg(
        (F.sum("kwh") / F.count(F.lit(1)) * 12).alias("annual_kwh"),
        (F.sum("revenue") / F.sum("kwh")).alias("avg_tariff"),
        (F.sum("maint") / F.count(F.lit(1)) * 12).alias("opex"))
    pb = econ.payback(summ.join(yearly, "p_partkey"), "capex", "annual_kwh", "avg_tariff", "opex")
    return pb.select("p_partkey", F.col("months").cast("long").alias("months"), rnd("total_costs", 6).alias("total_costs"),
                     rnd("lcoe").alias("lcoe"), rnd("npv", 3).alias("npv"),
                     rnd("payback_years").alias("payback_years"), "payback_class", "is_viable")


PAT = text.TOKEN_PATTERN


@register("tokens_documents", f"""
SELECT doc_id, len(regexp_extract_all(lower(text), '{PAT}'))::BIGINT AS n_tokens,
       len(list_distinct(regexp_extract_all(lower(text), '{PAT}')))::BIGINT AS n_terms FROM documents""")
def tokens_documents(spark, sf):
    """Token and distinct-term counts of every whole document."""
    toks = F.regexp_extract_all(F.lower(F.col("text")), F.lit(PAT), 0)
    d = table(spark, sf, "documents").select("doc_id", toks.alias("_t"))
    return d.select("doc_id", F.size("_t").cast("long").alias("n_tokens"),
                    F.size(F.array_distinct("_t")).cast("long").alias("n_terms"))


@register("tfidf_documents", f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{PAT}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf, df.df, tf.tf * (ln((1.0 + n.n)/(1.0 + df.df)) + 1.0) AS w FROM tf JOIN df USING (term), n)
SELECT doc_id, term, tf::BIGINT AS tf, df::BIGINT AS df, round(w / sqrt(sum(w*w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w""")
def tfidf_documents(spark, sf):
    """Smoothed TF-IDF, L2-normalised per document (long form)."""
    t = text.tfidf(table(spark, sf, "documents"), "text", "doc_id")
    return t.select("doc_id", "term", F.col("tf").cast("long").alias("tf"), F.col("df").cast("long").alias("df"),
                    rnd("tfidf").alias("tfidf"))


@register("zipf_documents", f"""
WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '{PAT}')) AS term FROM documents),
c AS (SELECT term, count(*) AS count FROM t GROUP BY 1)
SELECT term, count::BIGINT AS count, row_number() OVER (ORDER BY count DESC, term)::BIGINT AS rank FROM c""")
def zipf_documents(spark, sf):
    """Corpus term frequencies with rank (count desc, term)."""
    z = text.zipf_table(table(spark, sf, "documents"), "text", "doc_id")
    return z.select("term", F.col("count").cast("long").alias("count"), "rank")


SEL_SQL = """
WITH b AS (SELECT p_partkey, p_type, p_retailprice AS f,
                  row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey) - 1 AS wr,
                  count(*) OVER (PARTITION BY p_type) AS n, sum(p_retailprice) OVER (PARTITION BY p_type) AS s,
                  min(p_retailprice) OVER (PARTITION BY p_type) AS mn, max(p_retailprice) OVER (PARTITION BY p_type) AS mx
           FROM part),
q AS (SELECT p_type, quantile_cont(p_retailprice, 0.5) AS thr FROM part GROUP BY 1),
m AS (SELECT b.p_type, sum(CASE WHEN f >= thr THEN 1 ELSE 0 END) AS m FROM b JOIN q USING (p_type) GROUP BY 1)
SELECT p_partkey, p_type, round(f / s, 9) AS p_prop,
       round((f - mn + 1e-12) / (s - n*mn + n*1e-12), 9) AS p_prop_ga,
       round((2.0 - 1.5)/n + 2.0*wr*(1.5 - 1.0)/(n*(n - 1.0)), 9) AS p_rank,
       round((pow(wr + 1.0, 3) - pow(wr + 0.0, 3)) / pow(n, 3), 9) AS p_tour_w,
       round(CASE WHEN wr + 1.0 >= 3 THEN ((wr + 1.0 - 1)/1 * (wr + 1.0 - 2)/2) / (n/1 * (n - 1)/2 * (n - 2)/3) ELSE 0.0 END, 9) AS p_tour_wo,
       round(CASE WHEN m > 0 THEN CASE WHEN f >= thr THEN 1.0/m ELSE 0.0 END ELSE CASE WHEN f = mx THEN 1.0 ELSE 0.0 END END, 9) AS p_thr
FROM b JOIN q USING (p_type) JOIN m USING (p_type)"""


@register("selection_probs_part", SEL_SQL)
def selection_probs_part(spark, sf):
    """Per-part selection probability within its type (fitness =
    retail price) under proportional, GA-shifted proportional, linear rank
    (s=1.5), tournament k=3 with/without replacement and median threshold."""
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    out = sampling.selection_probabilities(p, "p_retailprice", "p_partkey", ["p_type"])
    return out.select("p_partkey", "p_type", *[rnd(c, 9).alias(c) for c in
                                               ["p_prop", "p_prop_ga", "p_rank", "p_tour_w", "p_tour_wo", "p_thr"]])


WEIGHTED_SQL = """
WITH t AS (SELECT sum(p_retailprice) AS total, count(*) AS n FROM part),
iv AS (SELECT p_partkey, p_retailprice / total AS p,
              coalesce(sum(p_retailprice) OVER (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / total AS lo
       FROM part, t),
d AS (SELECT g.draw, cast('0x' || substr(md5(cast(g.draw AS varchar) || ':11'), 1, 13) AS bigint) / 4503599627370496.0::double AS u
      FROM (SELECT unnest(range(n)) AS draw FROM t) g),
h AS (SELECT iv.p_partkey, count(*) AS hits FROM d ASOF JOIN iv ON d.u >= iv.lo GROUP BY 1)
SELECT iv.p_partkey, round(p, 9) AS p, coalesce(hits, 0)::BIGINT AS hits, round(coalesce(hits, 0) / t.n::double, 9) AS share
FROM iv LEFT JOIN h USING (p_partkey), t"""


@register("weighted_sample_part", WEIGHTED_SQL)
def weighted_sample_part(spark, sf):
    """R5 + R6: as many proportional draws as parts (inverse CDF, one sort of
    draws and starts); observed share next to the probability for every part."""
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    n = p.count()
    draws = sampling.weighted_sample(p, "p_retailprice", "p_partkey", n, seed=11)
    probs = sampling.proportional(p, "p_retailprice")
    rep = sampling.selection_shares(draws, probs, "p_partkey", n)
    return rep.select("p_partkey", rnd("p", 9).alias("p"), F.col("hits").cast("long").alias("hits"), rnd("share", 9).alias("share"))


TOURNAMENT_SQL = """
WITH t AS (SELECT count(*) AS n FROM part),
pos AS (SELECT p_partkey, p_retailprice AS f, row_number() OVER (ORDER BY p_partkey) - 1 AS i,
               row_number() OVER (ORDER BY p_retailprice, p_partkey) AS r FROM part),
picks AS (SELECT draw, cast(floor(cast('0x' || substr(md5(cast(draw AS varchar) || ':' || cast(slot AS varchar) || ':5'), 1, 13) AS bigint)
                 / 4503599627370496.0::double * n) AS bigint) AS i
          FROM (SELECT unnest(range(20 * n)) AS draw, n FROM t), (SELECT unnest(range(3)) AS slot)),
won AS (SELECT draw, arg_max(p_partkey, {'f': f, 'id': p_partkey}) AS id FROM picks JOIN pos USING (i) GROUP BY draw),
h AS (SELECT id AS p_partkey, count(*) AS hits FROM won GROUP BY 1)
SELECT pos.p_partkey, round((pow(r, 3) - pow(r - 1.0, 3)) / pow(n, 3), 9) AS p, coalesce(hits, 0)::BIGINT AS hits,
       round(coalesce(hits, 0) / (20.0::double * n), 9) AS share
FROM pos LEFT JOIN h USING (p_partkey), t"""


@register("tournament_shares_part", TOURNAMENT_SQL)
def tournament_shares_part(spark, sf):
    """R3 + R6: 20 draws per part of size-3 tournaments with replacement
    (fitness = retail price, whole table); observed win share next to the
    closed-form probability (r³ − (r−1)³)/N³."""
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    n_draws = 20 * p.count()
    draws = sampling.tournament_draws(p, "p_retailprice", "p_partkey", 3, n_draws, seed=5)
    probs = sampling.tournament(p, "p_retailprice", "p_partkey", 3, replacement=True).select("p_partkey", "p")
    rep = sampling.selection_shares(draws, probs, "p_partkey", n_draws)
    return rep.select("p_partkey", rnd("p", 9).alias("p"), F.col("hits").cast("long").alias("hits"),
                      rnd("share", 9).alias("share"))
