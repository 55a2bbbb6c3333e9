"""Conversation prefix trie with subtree totals by parallel tree contraction (operator 12).

Every distinct sequence of first turns is a node; conversations that start
with it are its members.  Totals of whole subtrees come from contraction:

1. Rake: every leaf gives its values to its parent and goes.
2. Compress: in unary chains, nodes whose hash is larger than their parent's
   and their only child's are taken out at once (no two of them adjoin); the
   child hangs on the parent, which takes the node's values.
3. Rounds of 1 and 2 go on until nothing is left: their number grows with the
   logarithm of the tree's size, also for chains of any length.
4. Re-expansion, last round first: a node that was taken out totals what it
   held then plus the total of its only child of then.

Each round is two aggregates on parents and two joins on unique nodes, and
writes two tables that shrink geometrically; a parent of very many children is
summed before the shuffle and is never one key of a join.

A prefix is named by the exclusive-or of two 64-bit hashes of its (place,
turn) pairs: such names are prefix sums, so that a conversation of any length is
numbered and named in blocks, not in one task.

Defined cases: null role or text is empty; a null turn comes first; turns that
tie are ordered by the MD5 of role, a zero character and text; equal rows are
repeated turns; rows without a conv_id are left out; remainders have the sign of
conv_id; other columns are never read; without conversations there is no root
and the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm import store
from statlake.operators.ranks import keyed_prefix

BLOCK = 1024         # turns of a conversation that one window holds
COPIES = 1 << 16     # repeated rows that one array holds
MEMBERS_SHIFT = 12   # ids of 4,096 neighbouring numbers make one piece of a digest's input


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, t1, t2, chars)``: turns of each conversation, placed
    from 1; t1 and t2 are hashes of role and text, chars the text's code points."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().cast("int").alias("has_turn"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"),
        F.md5(F.concat(role, F.lit("\0"), text)).alias("tie"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(text, role, F.lit(1)).alias("t2"), F.length(text).cast("long").alias("chars"))
    cells = store.table(rows.groupBy("conv_id", "has_turn", "turn", "tie", "t1", "t2", "chars")
                        .agg(F.count(F.lit(1)).alias("copies")), "turns")
    cells = keyed_prefix(cells, ["conv_id"], ["has_turn", "turn", "tie"], "copies")
    first = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(COPIES).cast("long")))
    cells = cells.withColumn("nth", first)
    nth = F.explode(F.sequence("nth", F.least("copies", F.col("nth") + (COPIES - 1))))
    return cells.withColumn("nth", nth).select("conv_id", (F.col("before") + F.col("nth")).cast("long").alias("place"), "t1", "t2", "chars")


def grafted(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``(conv_id, place, t1, t2, chars, ends)`` and conversations
    ``(conv_id, n_turns)``: the first ``crc32(conv_id) % most`` turns come from the
    conversation whose id is the multiple of ``group``, the others are its own."""
    turns = store.table(turns, "numbered")
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("n_own"))
    base = F.col("conv_id") - F.col("conv_id") % group
    convs = lengths.select("conv_id", "n_own", base.alias("base"),
                           (F.crc32(F.col("conv_id").cast("string")) % most).cast("long").alias("head"))
    convs = convs.join(lengths.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base")), "base", "left")
    shared = F.least("head", F.coalesce("n_base", F.lit(0)))
    convs = convs.select("conv_id", "base", "head", shared.alias("shared"),
                         (shared + F.greatest(F.col("n_own") - F.col("head"), F.lit(0))).alias("n_turns"))
    convs = store.table(convs, "conversations")
    heads = turns.filter(F.col("place") < most).withColumnRenamed("conv_id", "base").join(
        convs.select("conv_id", "base", "head", "n_turns"), "base").filter("place <= head")
    # a long conversation is many rows of one key
    tails = store.lookup(turns, convs.select("conv_id", "head", "shared", "n_turns"), ["conv_id"], "place").filter("place > head")
    tails = tails.withColumn("place", F.col("place") - F.col("head") + F.col("shared"))
    columns = ["conv_id", "place", "t1", "t2", "chars", (F.col("place") == F.col("n_turns")).alias("ends")]
    return heads.select(*columns).union(tails.select(*columns)), convs.select("conv_id", "n_turns")


def named_prefixes(turns: DataFrame) -> DataFrame:
    """Adds ``k1, k2``, the name of the turns up to this one, and ``p1, p2``, of those before."""
    z = {"k1": F.xxhash64("place", "t1", "t2"), "k2": F.xxhash64("t2", "place", "t1", F.lit(7))}
    rows = store.table(turns.withColumns({"z1": z["k1"], "z2": z["k2"], "block": F.floor((F.col("place") - 1) / BLOCK)}), "rebuilt")
    blocks = rows.groupBy("conv_id", "block").agg(F.bit_xor("z1").alias("b1"), F.bit_xor("z2").alias("b2"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("long")
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(b).over(earlier), nothing).alias(b) for b in ("b1", "b2")])
    inside = Window.partitionBy("conv_id", "block").orderBy("place")
    rows = rows.withColumns({"k1": F.bit_xor("z1").over(inside), "k2": F.bit_xor("z2").over(inside)}).join(blocks, ["conv_id", "block"])
    rows = rows.withColumns({k: F.col(k).bitwiseXOR(F.col(b)) for k, b in (("k1", "b1"), ("k2", "b2"))})
    return rows.withColumns({p: F.col(k).bitwiseXOR(F.col(z)) for p, k, z in (("p1", "k1", "z1"), ("p2", "k2", "z2"))}).select(
        "conv_id", F.col("place").alias("depth"), "k1", "k2", "p1", "p2", "chars", "ends")


def subtree_totals(tree: DataFrame, values: Sequence[str], seed: int = 0) -> DataFrame:
    """``(node, *values)``: sums over the subtree of each node of ``tree (node,
    parent, n, *values)``, n being its number of children and null the parent of a
    root.  Nodes are of any type that Spark hashes."""
    state = store.table(tree.select("node", "parent", "n", *values), "tree")
    raked, taken = [], []
    while True:
        leaf = F.col("n") == 0
        raked.append(state.filter(leaf).select("node", *values))
        # rake
        given = state.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.when(leaf, F.col(v)).otherwise(0)).alias(f"given_{v}") for v in values],
            F.sum(leaf.cast("long")).alias("gone"), F.min(F.when(~leaf, F.col("node"))).alias("child"))
        rest = state.filter(~leaf).join(given, "node").select(
            "node", "parent", (F.col("n") - F.col("gone")).alias("n"), "child",
            *[(F.col(v) + F.col(f"given_{v}")).alias(v) for v in values])
        rest = store.table(rest, "raked")
        if rest.isEmpty():
            break
        # compress
        turn = F.lit(seed + len(taken))
        place = lambda node: F.xxhash64(node, turn)
        out = (F.col("n") == 1) & F.col("parent").isNotNull() & (place("node") > place("parent")) & (place("node") > place("child"))
        chain = rest.filter(out)
        taken.append(chain.select("node", "child", *values))
        moves = chain.select(F.col("child").alias("node"), F.col("parent").alias("up"), *[F.lit(0).cast("long").alias(f"given_{v}") for v in values])
        gives = chain.select(F.col("parent").alias("node"), F.lit(None).alias("up"), *[F.col(v).alias(f"given_{v}") for v in values])
        news = moves.union(gives).groupBy("node").agg(F.max("up").alias("up"), *[F.sum(f"given_{v}").alias(f"given_{v}") for v in values])
        state = store.table(rest.filter(~F.coalesce(out, F.lit(False))).join(news, "node", "left").select(
            "node", F.coalesce("up", "parent").alias("parent"), "n",
            *[(F.col(v) + F.coalesce(f"given_{v}", F.lit(0))).alias(v) for v in values]), "compressed")
    # re-expand: the only child of then went later
    totals = [raked[-1]]
    for leaves, chain in zip(raked[-2::-1], taken[::-1]):
        known = reduce(DataFrame.union, totals).withColumnsRenamed({v: f"below_{v}" for v in values} | {"node": "child"})
        back = chain.join(known, "child").select("node", *[(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values])
        totals += [store.table(back, "expanded"), leaves]
    return reduce(DataFrame.union, totals)


def _digests(ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, ends_sha256)`` of each group's conv_ids, ascending and
    comma-joined.  Ids are sorted and written as text piece by piece; a digest
    is fed its group's pieces one after the other and holds none of them."""
    piece = F.shiftright("conv_id", MEMBERS_SHIFT)
    pieces = ends.groupBy(*keys, piece.alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches):
        at, digest = None, None
        for b in batches:
            rows = [b.column(k).to_pylist() for k in (*keys, "ids")]
            done = []
            for *key, ids in zip(*rows):
                if at != key:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield pack(done)
        yield pack([(*at, digest.hexdigest())] if at is not None else [])

    def pack(done):
        columns = list(zip(*done)) or [[]] * (len(keys) + 1)
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.string())],
                                          [*keys, "ends_sha256"])
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.repartition(n, *keys).sortWithinPartitions(*keys, "piece").select(*keys, "ids")
    return pieces.mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", ends_sha256 string")


def _node(conv: str, depth: Column) -> Column:
    return F.struct(F.col(conv).alias("conv_id"), depth.cast("long").alias("depth"))


def prefix_trie(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``; a node is its smallest member and depth."""
    turns, convs = grafted(numbered_turns(conversations), group, most)
    rows = store.table(named_prefixes(turns), "prefixes")
    nothing = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(nothing.alias("depth"), nothing.alias("k1"), nothing.alias("k2"), "conv_id", "n_convs",
                       F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), nothing.alias("chars"))
    nodes = rows.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.max("chars").alias("chars"))
    nodes = store.table(nodes.union(root.select(*nodes.columns)), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    nodes = store.table(store.lookup(nodes, above, ["depth", "p1", "p2"], "conv_id"), "children")
    children = nodes.filter("depth > 0").groupBy(_node("parent_conv_id", F.col("depth") - 1).alias("node")).agg(
        F.count(F.lit(1)).alias("n"))
    tree = nodes.select(_node("conv_id", F.col("depth")).alias("node"),
                        F.when(F.col("depth") > 0, _node("parent_conv_id", F.col("depth") - 1)).alias("parent"),
                        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    tree = tree.join(children, "node", "left").fillna(0, ["n"]).withColumn("n_leaves", (F.col("n") == 0).cast("long"))
    tree = store.table(tree, "trie")
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    ends = rows.filter("ends").select("depth", "k1", "k2", "conv_id").union(
        convs.filter("n_turns = 0").select(nothing, nothing, nothing, "conv_id"))
    out = nodes.withColumn("node", _node("conv_id", F.col("depth"))).join(
        _digests(ends, ["depth", "k1", "k2"]), ["depth", "k1", "k2"], "left")
    out = out.join(totals, "node").join(children.withColumnRenamed("n", "n_children"), "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", nothing).alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op12_query(conversations: DataFrame) -> DataFrame:
    return prefix_trie(conversations)


#: crc32 is computed bit by bit; subtrees are the distinct pairs of nodes that a conversation passes through.
ORACLE = r"""
with recursive own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first,
           md5(coalesce(role, '') || chr(0) || coalesce(text, ''))) as place,
         md5(coalesce(role, '')) || md5(coalesce(text, '')) as turn_key, length(coalesce(text, '')) as chars
  from conversations where conv_id is not null),
bits(conv_id, s, i, v) as (
  select distinct conv_id, cast(conv_id as varchar), 0, cast(4294967295 as bigint) from own
  union all
  select conv_id, s, i + 1, xor(y >> 1, case when y & 1 = 1 then cast(3988292384 as bigint) else 0 end) from (
    select conv_id, s, i, case when i % 8 = 0 then xor(v, cast(ascii(substr(s, i // 8 + 1, 1)) as bigint)) else v end as y from bits
    where i < 8 * length(s))),
heads as (select conv_id, xor(v, cast(4294967295 as bigint)) % 6 as head, conv_id - conv_id % 100 as base from bits where i = 8 * length(s)),
sizes as (select conv_id, max(place) as n from own group by conv_id),
convs as (select h.conv_id, head, base, least(head, coalesce(b.n, 0)) as shared from heads h left join sizes b on b.conv_id = h.base),
turns as (
  select c.conv_id, o.place, o.turn_key, o.chars from convs c join own o on o.conv_id = c.base and o.place <= c.head
  union all
  select c.conv_id, o.place - c.head + c.shared, o.turn_key, o.chars from convs c join own o using (conv_id) where o.place > c.head
  union all
  select conv_id, 0, '', 0 from convs),
prefixes as (
  select conv_id, place as depth, md5(cast(list(turn_key) over (partition by conv_id order by place) as varchar)) as k, chars,
         place = max(place) over (partition by conv_id) as ends from turns),
named as (select *, min(conv_id) over (partition by depth, k) as node from prefixes),
nodes as (select node, depth, count(*) as n_convs, max(chars) as chars,
            sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '')) as ends_sha256
          from named group by node, depth),
links as (select distinct b.node, b.depth, a.node as parent from named b join named a on a.conv_id = b.conv_id and a.depth = b.depth - 1),
below as (select distinct a.node, a.depth, b.node as low, b.depth as low_depth from named a join named b on a.conv_id = b.conv_id and b.depth >= a.depth),
children as (select parent as node, depth - 1 as depth, count(*) as n from links group by 1, 2),
totals as (select b.node, b.depth, count(*) filter (where c.n is null) as n_leaves, sum((n.n_convs - 1) * n.chars) as saved
           from below b join nodes n on n.node = b.low and n.depth = b.low_depth
           left join children c on c.node = b.low and c.depth = b.low_depth group by 1, 2)
select n.node as conv_id, n.depth, l.parent as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children, t.n_leaves,
       cast(t.saved as bigint) as saved_tokens, n.ends_sha256
from nodes n join totals t using (node, depth) left join links l using (node, depth) left join children c using (node, depth)
"""
