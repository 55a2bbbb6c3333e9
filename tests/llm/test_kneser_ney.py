import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from statlake.llm import kneser_ney as K
from tests.llm import helpers as H


class Plain:
    """The model with dictionaries."""

    def __init__(self, texts):
        self.u, self.b = Counter(), Counter()
        for w in texts:
            self.u.update(w)
            self.b.update(zip(["<s>", *w], w))
        self.total, self.v = sum(self.u.values()), len(self.u)
        tally = lambda c: [sum(1 for x in c.values() if x == k) for k in (1, 2, 3, 4)]
        self.cont = Counter(w for _, w in self.b)
        self.d2, self.d1 = K.discounts(tally(self.b)), K.discounts(tally(self.cont))
        self.back = sum(self.d1[min(c, 3)] for c in self.cont.values()) / max(1, len(self.b))
        self.ctx, self.weight = Counter(), Counter()
        for (v, _), c in self.b.items():
            self.ctx[v] += c
            self.weight[v] += self.d2[min(c, 3)]

    def lower(self, w):
        return (self.cont[w] - self.d1[min(self.cont[w], 3)]) / len(self.b) + self.back / (self.v + 1)

    def p(self, v, w):
        if not self.ctx[v]:
            return self.lower(w)
        c = self.b[v, w]
        return (c - self.d2[min(c, 3)]) / self.ctx[v] + self.weight[v] / self.ctx[v] * self.lower(w)


def _tokens(t):
    return [*H.words(t), "\n"]


@pytest.mark.parametrize("taken", [255, 3])
def test_scores_match_the_plain_model(spark, taken, monkeypatch):
    monkeypatch.setattr(K, "FLUSH", 4000)
    rows = H.awkward() + [(900 + i, "the cat sat on the mat " * (i % 4)) for i in range(60)]
    docs = H.documents(spark, rows + [rows[0]])
    got = K.op7_query(docs, taken=taken, bucket_bytes=2000).collect()
    assert len(got) == len(rows) + 1
    train = [_tokens(t) for i, t, *_ in rows + [rows[0]] if i is not None and zlib.crc32(str(i).encode()) % 10]
    m = Plain(train)
    vocabulary = list(m.u) + ["unseen word"]
    for v in ("the", "<s>", "w1x", "never"):
        assert abs(sum(m.p(v, w) for w in vocabulary) - 1) < 1e-9
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        w = _tokens(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in m.u for x in w), m.total)
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        base = sum(math.log10((m.u[x] + 0.1) / (m.total + 0.1 * (m.v + 1))) for x in w)
        score = sum(math.log10(m.p(v, x)) for v, x in zip(["<s>", *w], w))
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)


def test_nothing_to_learn_from(spark):
    docs = H.documents(spark, [(1, "a b"), (2, None)])
    assert K.op7_query(docs.filter("false")).count() == 0
    m = K.fit(docs.filter("false"))
    got = K.score(docs, m, ["doc_id"]).collect()
    assert all(r["n_known"] == 0 and r["score"] == 0.0 for r in got)


def test_packing():
    r = np.random.default_rng(2)
    for n in (0, 1, 1000):
        k = np.sort(r.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert (K.unpack(K.pack(k)) == k).all()
        c = r.integers(0, 1 << 40, n)
        assert (K.unpack_small(K.pack_small(c), n) == c).all()
    assert (K.discounts([0, 0, 0, 0]) < [1, 1, 2, 3]).all()


def test_candidates_for_hot_contexts_stay_in_spark(spark, monkeypatch):
    r = random.Random(9)
    docs = H.documents(spark, [(i, "the " * 30 + H.prose(r, 100, 3000)) for i in range(60)])
    cls, rows = type(docs), []
    collect = cls.collect

    def recorded(self):
        rows.extend(got := collect(self))
        return got
    monkeypatch.setattr(cls, "collect", recorded)
    model = K.fit(docs)
    assert 1 < len(model.hot) <= 8 * 24 + 1
    assert max(len(x) for row in rows for x in row if isinstance(x, list)) <= 8
