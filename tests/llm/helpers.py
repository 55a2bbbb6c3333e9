"""Small tables with the awkward rows that every operator must take."""

import random
import re

from pyspark.sql import functions as F

WORDS = "the of and to in that it is was for on with as by at from this or had not but what all were when we there can".split()
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: columns with the names that operators use inside
CLASHES = {"n": 1, "rep": 2, "score": 3.5, "spans": "x", "rank": 4, "size": 5, "bucket": 6, "_text": "y", "leaks": "z", "node": 7,
           "component": 8, "copies": 9, "_k": 10, "salt": 11}


def prose(r: random.Random, n: int, vocabulary: int = 400) -> str:
    words = [r.choice(WORDS) if r.random() < 0.4 else f"w{r.randrange(vocabulary)}x" for _ in range(n)]
    return " ".join(words) + "."


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def documents(spark, rows, clash=True):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s1", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({k: F.lit(v) for k, v in CLASHES.items()}) if clash else df


def awkward(seed=1, n=60):
    """Documents: ordinary, null, empty, blank, one word, very long, copies, near copies, odd characters."""
    r = random.Random(seed)
    rows = [(i, prose(r, r.randrange(1, 120)), r.choice(["s1", "s2", None])) for i in range(n)]
    base = prose(r, 200)
    rows += [(n + i, base, "s1") for i in range(5)]
    for i in range(12):
        w = base.split(" ")
        for _ in range(r.randrange(1, 6)):
            w[r.randrange(len(w))] = f"edit{r.randrange(99)}"
        rows.append((n + 10 + i, " ".join(w), "s2"))
    rows += [(n + 30, None, "s1"), (n + 31, "", "s2"), (n + 32, " \t\n ", None), (n + 33, "Word", "s1"), (n + 34, "word", "s3"),
             (n + 35, prose(r, 9000), "s3"), (n + 36, "é ß ñ 漢字  x " * 30, "s3"), (n + 37, "same same same " * 80, None),
             (None, "no id here " + base, "s1")]
    r.shuffle(rows)
    return rows


class UnionFind:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
