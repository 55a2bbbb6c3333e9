"""Systematic sampling of documents to target source weights (operator 3).

Every document of a source is expected ``target / source_size`` times.  The
expected copies are prefix-summed within the source, one random offset is
added, and a copy is emitted for every integer boundary that the sum crosses.
Documents are taken by size, so the words taken from a source miss its
target by less than its longest document.

Only DataFrame functions.  The prefix sum never gathers a source in one task:
counts are summed per (source, size), then per (source, size, 1/256 hash
part), and only rows of one part are numbered together.

Defined cases: null text has size 0; null source is a source of its own, last
in order; null doc_id is ordered as the empty string; repeated rows are
separate documents; an empty table gives an empty result; a source of size 0
has target 0 and takes no copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm import store

WORD = r"[^\x20\x09-\x0D]+"
ONE = 1 << 30  # fixed-point unit of expected copies


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """``(source, source_size, target)``.  Sources in code-point order take
    ``weights`` in turn; targets sum to ``share`` of all words and stop at
    ``limit`` times the source, the excess being shared again by weight.

    The reshared solution is ``min(limit * size, weight * level)``.  Sources
    are sorted by the level at which they reach their limit; each compares it
    with the level that the sources before it, all at their limits, would
    leave.  The table has one row per source, so its windows are small."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("_w", w).withColumn("_cap", F.lit(float(limit)) * F.col("source_size"))
    every = Window.partitionBy()
    before = (Window.orderBy("_full", F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0.0)
    per = (per.withColumn("_full", F.col("_cap") / F.col("_w"))
           .withColumn("_level", (F.lit(float(share)) * F.sum("source_size").over(every)
                                  - F.coalesce(F.sum("_cap").over(before), zero))
                       / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), zero)))
           .withColumn("_top", F.max("_level").over(every)))
    target = F.when(F.col("_full") <= F.col("_level"), F.col("_cap")).otherwise(F.col("_w") * F.col("_top"))
    return per.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0,
             seed: int = 7, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    copies`` (times the mix holds it, 0 to ceil(limit))."""
    slim = store.table(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                   word_count(F.col(text_col)).alias("size")), "sizes")
    targets = source_targets(slim, weights, share, limit)
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(limit))))
    targets = (targets.withColumn("_step", F.coalesce(F.floor(ratio * F.lit(float(ONE))), F.lit(0)).cast("long"))
               .withColumn("_shift", F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(
                   F.concat(F.lit("s"), "source"), F.lit("n")))), 1, 7), 16, 10).cast("long") * 4))

    part = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 2)
    rows = slim.withColumn("_part", part)
    parts = rows.groupBy("source", "size", "_part").agg(F.count(F.lit(1)).alias("_n"))
    inner = Window.partitionBy("source", "size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_in_cell", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    cells = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("_n"))
    outer = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_in_source", F.coalesce(F.sum("_n").over(outer), F.lit(0)))

    same = lambda a, b, cols: [a[c].eqNullSafe(b[c]) for c in cols]
    c = cells.select("source", "size", "_in_source")
    p = parts.join(c, same(parts, c, ("source", "size"))).select(
        parts["source"], parts["size"], "_part", (F.col("_in_cell") + F.col("_in_source")).alias("_before"))
    t = targets.select("source", "source_size", "target", "_step", "_shift")
    p = p.join(t, same(p, t, ("source",))).select(p["source"], "size", "_part", "_before", "source_size", "target",
                                                  "_step", "_shift")
    own = Window.partitionBy("source", "size", "_part").orderBy(F.col("doc_id").asc_nulls_first())
    r = rows.withColumn("_own", F.row_number().over(own))
    r = r.join(p, same(r, p, ("source", "size", "_part"))).select(
        "doc_id", r["source"], r["size"], "source_size", "target", "_step", "_shift",
        (F.col("_before") + F.col("_own")).alias("_rank"))

    def crossed(i: Column) -> Column:  # floor(i * step + shift), without overflow
        low = F.pmod(i, F.lit(ONE))
        return F.shiftright(i, 30) * F.col("_step") + F.shiftright(low * F.col("_step") + F.col("_shift"), 30)
    copies = crossed(F.col("_rank")) - crossed(F.col("_rank") - 1)
    return r.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def systematic_mix(docs: DataFrame, plan: DataFrame | None = None, id_col: str = "doc_id",
                   source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as planned.

    The n-th row of a doc_id, source and size takes the n-th plan row of them;
    documents whose plan is 0 copies are left out.  Columns of any name are
    carried as they are."""
    if plan is None:
        plan = mix_plan(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    d, at = store.renamed(docs)
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    own = ["key", "source", "size"]
    nth = F.row_number().over(Window.partitionBy(*own).orderBy(F.lit(0)))
    d = d.withColumns({"key": key(at[id_col]), "source": key(at[source_col]), "size": word_count(F.col(at[text_col]))}).withColumn("nth", nth)
    by_copies = F.row_number().over(Window.partitionBy(*own).orderBy("copies"))
    p = (plan.select(key("doc_id").alias("key"), key("source").alias("source"), "size", "copies")
         .withColumn("nth", by_copies).filter("copies > 0"))
    j = d.join(p, [*own, "nth"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return store.named_back(j, at)


def op3_query(docs: DataFrame) -> DataFrame:
    return mix_plan(docs).select("doc_id", "size", "source_size", "target",
                                 (F.col("copies") * F.col("size")).alias("taken"), "copies")


ORACLE = r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
           from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double
      else 2.0::double end as w, 2.0::double * source_size as cap from s),
f as (select *, cap / w as full_at from w),
l as (select *, (1.5::double * sum(source_size) over ()
        - coalesce(sum(cap) over (order by full_at, source nulls last rows between unbounded preceding and 1 preceding), 0))
        / (sum(w) over () - coalesce(sum(w) over (order by full_at, source nulls last
           rows between unbounded preceding and 1 preceding), 0)) as level from f),
t as (select *, case when full_at <= level then cap else w * max(level) over () end as target from l),
g as (select source, source_size, target,
        coalesce(cast(floor(case when source_size > 0 then least(target / source_size, 2.0::double) end * 1073741824.0::double)
          as hugeint), 0) as step,
        cast('0x' || substr(md5('7:' || coalesce('s' || source, 'n')), 1, 7) as hugeint) * 4 as shift from t),
r as (select d.doc_id, d.size, g.source_size, g.target, g.step, g.shift,
        cast(row_number() over (partition by d.source order by d.size,
          substr(md5(coalesce(cast(d.doc_id as varchar), '')), 1, 2), d.doc_id nulls first) as hugeint) as i
      from d join g on d.source is not distinct from g.source),
c as (select *, cast((i * step + shift) // 1073741824 - ((i - 1) * step + shift) // 1073741824 as bigint) as copies from r)
select doc_id, size, source_size, target, copies * size as taken, copies from c
"""
