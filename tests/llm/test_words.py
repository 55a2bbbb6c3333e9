import random

import numpy as np
import pyarrow as pa

from statlake.llm import words as W
from tests.llm import helpers as H


def test_words_match_the_pattern_and_hash_alike():
    r = random.Random(3)
    texts = [t for _, t, _ in H.awkward()] + ["A\tb\x0bC", "ÀB àb", "x" * 5000, "\x1cq\x85z"]
    raw, offsets = W.text_bytes(pa.array(texts))
    seen = {}
    for size in (1, 50, 1 << 20):
        got = [[] for _ in texts]
        for a, e in W.slices(offsets, size):
            part = raw[offsets[a]:offsets[e]]
            doc, h, s, t = W.words(part, offsets[a:e + 1] - offsets[a])
            for d, x, i, j in zip(doc, h, s, t):
                w = bytes(part[i:j]).decode().translate(H.LOW)
                assert seen.setdefault(w, x) == x
                got[a + d].append(w)
        assert got == [H.words(t) for t in texts]
    assert len(set(seen.values())) == len(seen)
    assert W.word_hash("Word") == W.word_hash("word") == int(seen["word"])
    del r


def test_sliced_and_empty_columns():
    col = pa.array(["zero", None, "two words", ""]).slice(1, 3)
    raw, offsets = W.text_bytes(col)
    assert bytes(raw) == b"two words" and list(offsets) == [0, 0, 9, 9]
    raw, offsets = W.text_bytes(pa.array([], pa.string()))
    assert len(raw) == 0 and list(W.slices(offsets)) == []


def test_grams_stay_in_their_document():
    raw, offsets = W.text_bytes(pa.array(["a b c", "d e", "a b c"]))
    doc, h, _, _ = W.words(raw, offsets)
    d, g, at = W.grams(doc, h, 3)
    assert list(d) == [0, 2] and g[0] == g[1] and list(at) == [0, 5]
    assert len(W.grams(doc, h, 9)[0]) == 0 and W.whole(h[:2]) != W.whole(h[:3])
    assert np.unique(W.mix64(np.arange(1000, dtype=np.uint64))).size == 1000
