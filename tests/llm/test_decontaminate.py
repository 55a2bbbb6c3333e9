import random

import numpy as np
import pytest

from statlake.llm import decontaminate as D
from tests.llm import helpers as H


def _edited(r, words):
    w = list(words)
    for _ in range(r.choice((0, 0, 1, 1, 2, 4))):
        j = r.choice((0, len(w) - 1, r.randrange(len(w))))
        q = r.random()
        if q < 0.4:
            w[j] = f"new{r.randrange(99)}"
        elif q < 0.7:
            w.insert(j, "more")
        elif len(w) > 1:
            del w[j]
    return w


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(8)
    items = [(i, H.prose(r, r.choice((1, 3, 4, 5, 6, 12, 30, 60)), 4000)) for i in range(40)]
    items += [(100, None), (101, ""), (102, "a a a a a a a a a a"), (103, items[5][1].upper()), (None, H.prose(r, 20))]
    docs = [x[:2] for x in H.awkward()]
    for k in range(150):
        body = _edited(r, H.words(r.choice(items)[1]) or ["x"])
        docs.append((1000 + k, " ".join([H.prose(r, r.randrange(0, 25))[:-1], *body, H.prose(r, r.randrange(1, 25))])))
    docs += [(2000, "a " * 500), (2001, items[6][1]), (2002, "first word only")]
    return (H.documents(spark, docs), docs, items,
            spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, similarity int"))


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_leaks_match_brute_force(data, block_bytes):
    frame, docs, items, bench = data
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in D.op10_query(frame, bench, block_bytes=block_bytes).collect()}
    want = {}
    for d, t in docs:
        for i, x in items:
            s = D.brute_force(t, x)
            if s >= 0.8:
                want[d, i] = s
    assert set(got) == set(want)
    assert all(abs(got[k] - s) < 1e-12 for k, s in want.items())


def test_dropping(data, spark):
    frame, _, _, bench = data
    leaked = {r["doc_id"] for r in D.op10_query(frame, bench).select("doc_id").distinct().collect()}
    kept = D.drop_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in frame.collect()} - leaked
    assert D.op10_query(frame.filter("false"), bench).count() == 0
    assert D.op10_query(frame, bench.filter("false")).count() == 0 and D.drop_leaks(frame, bench.filter("false")).count() == frame.count()


def test_multi_index_meets_all_within_the_radius():
    r = np.random.default_rng(1)
    near = D._ball()
    for _ in range(300):
        a = r.integers(0, 1 << 63, dtype=np.uint64)
        b = a
        for bit in r.choice(64, r.integers(0, D.RADIUS + 1), replace=False):
            b ^= np.uint64(1) << np.uint64(bit)
        x, y = (np.array([v], np.uint64).view(np.uint8) for v in (a, b))
        assert any(near[p, q] for p, q in zip(x, y)) and D.distance(a, b) <= D.RADIUS


def test_swapped_parts_match_brute_force(spark):
    """Shingle similarity ignores word order: parts of an item may stand in another order."""
    r = random.Random(4)
    items = [(i, " ".join(f"i{i}n{k}" for k in range(n))) for i, n in enumerate((60, 60, 90, 200, 40))]
    items.append((9, " ".join(["again and again we say it"] * 12)))
    docs = []
    for k in range(60):
        w = r.choice(items)[1].split(" ")
        cuts = sorted(r.sample(range(1, len(w)), r.choice((1, 1, 2, 3))))
        if k < 5:
            w, cuts = items[k][1].split(" "), [len(items[k][1].split(" ")) // 2]
        parts = [w[a:b] for a, b in zip([0, *cuts], [*cuts, len(w)])]
        parts.reverse()
        docs.append((k, " ".join([H.prose(r, 40), *[x for p in parts for x in p], H.prose(r, 40)])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in D.op10_query(H.documents(spark, docs), bench).collect()}
    want = {(d, i): s for d, t in docs for i, x in items if (s := D.brute_force(t, x)) >= 0.8}
    assert {(0, 0), (1, 1), (2, 2), (3, 3)} <= set(want) and abs(want[0, 0] - 52 / 60) < 1e-12
    assert got.keys() == want.keys() and all(abs(got[k] - s) < 1e-12 for k, s in want.items())
    kept = {x["doc_id"] for x in D.drop_leaks(H.documents(spark, docs), bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}
