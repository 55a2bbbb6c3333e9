import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from statlake.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def truth(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((t is not None, t or 0, hashlib.md5(f"{role}\0{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children, below = defaultdict(int), defaultdict(lambda: [0, 0])
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            below[p[:d]][0] += children[p] == 0
            below[p[:d]][1] += (len(m) - 1) * len(p[-1][1] if p else "")
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], *below[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed=5):
    """Shared first turns, long chains, ties, nulls, repeated rows, turnless and negative conversations."""
    r = random.Random(seed)
    rows = []
    for c in [*range(0, 60), 100, 103, 104, 107, 250, 251, 252, 299, -3, -100, -101, -205, 5_000_000_017]:
        for t in range(r.randrange(1, 9)):
            text = r.choice(["hello", "hi", None, "", "é 漢字", f"own {c}"]) if t < 3 else f"{c % 7} turn {t}"
            rows.append((c, t, r.choice(["user", "assistant", None]) if t == 1 else "user", text))
    rows += [(400, t, "user", f"long {t}") for t in range(300)] + [(401, t, "user", f"long {t}") for t in range(290)]
    rows += [(500, None, "user", "first"), (500, None, "a", "tie"), (500, 3, "user", "x"), (500, 3, "user", "x"), (500, 3, "user", "y")]
    rows += [(600 + k, 0, "user", "same") for k in range(100)] + [(None, 1, "user", "nobody")]
    r.shuffle(rows)
    return rows


def _frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({k: F.lit(1) for k in ("place", "depth", "node", "k1", "copies", "n", "ends", "parent", "block", "_cell")})


def _rows(df):
    assert df.columns == COLUMNS
    return sorted((tuple(x) for x in df.collect()), key=str)


@pytest.mark.parametrize("block,shift,copies", [(1024, 12, 65536), (7, 2, 1)])
def test_equals_brute_force(spark, monkeypatch, block, shift, copies):
    monkeypatch.setattr(T, "BLOCK", block)
    monkeypatch.setattr(T, "MEMBERS_SHIFT", shift)
    monkeypatch.setattr(T, "COPIES", copies)
    rows = conversations()
    assert _rows(T.op12_query(_frame(spark, rows))) == truth(rows)


def test_sql_equals_brute_force(spark):
    rows = conversations(9)
    con = duckdb.connect()
    con.register("conversations", spark.createDataFrame(rows, SCHEMA).toArrow())
    got = con.execute(T.ORACLE)
    assert [d[0] for d in got.description] == COLUMNS
    assert sorted(got.fetchall(), key=str) == truth(rows)


def test_totals_of_any_tree(spark):
    """A random tree, a chain and a star: contraction against plain sums; few rounds."""
    r = random.Random(2)
    parent = {0: None} | {i: r.randrange(max(0, i - 3), i) for i in range(1, 120)}
    parent |= {1000 + i: 999 + i if i else 5 for i in range(150)} | {2000 + i: 3 for i in range(80)} | {3000: None}
    value = {n: r.randrange(100) for n in parent}
    want = dict.fromkeys(parent, 0)
    for n in parent:
        at = n
        while at is not None:
            want[at] += value[n]
            at = parent[at]
    n_children = defaultdict(int)
    for p in parent.values():
        n_children[p] += 1
    tree = spark.createDataFrame([(n, parent[n], n_children[n], value[n]) for n in parent], "node long, parent long, n long, v long")
    got = {x["node"]: x["v"] for x in T.subtree_totals(tree, ["v"]).collect()}
    assert got == want


def test_no_rows_and_one_turnless(spark):
    assert _rows(T.op12_query(_frame(spark, [(None, 1, "a", "b")]))) == []
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    assert _rows(T.op12_query(_frame(spark, [(c, 0, "a", "b")]))) == truth([(c, 0, "a", "b")])
    assert _rows(T.op12_query(_frame(spark, [(c, 0, "a", "b")])))[0][:3] == (c, 0, None)
