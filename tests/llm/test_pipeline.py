import random
import re

import pytest

from tests.llm import helpers as H

BAD = ["idiot", "scum", "moron", "trash"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of small tables with planted toxic, copied, leaked and secret texts."""
    r = random.Random(11)
    docs, labels, items = [], [], [(i, H.prose(r, 25, 5000)) for i in range(10)]
    for i in range(300):
        docs.append((i, H.prose(r, r.randrange(30, 150), 5000), f"src{i % 3}"))
    for i in range(0, 300, 6):
        w = docs[i][1].split(" ")
        for _ in range(6):
            w.insert(r.randrange(len(w)), r.choice(BAD))
        docs[i] = (i, " ".join(w), docs[i][2])
    labels = [(i, 1, int(i % 6 == 0)) for i in range(300)]
    for k in range(20):  # near copies of clean documents
        w = docs[6 * k + 1][1].split(" ")
        w[-2] = "changed"
        docs.append((400 + k, " ".join(w), "src0"))
    for k in range(10):  # leaks
        docs.append((500 + k, H.prose(r, 20, 5000) + " " + items[k][1] + " " + H.prose(r, 20, 5000), "src1"))
    for k in range(5):
        docs.append((600 + k, H.prose(r, 40, 5000) + f" password=q8Zr{k}Lw2Tt ok", "src2"))
    docs += [(700, None, None), (701, "", "src1"), (702, "lone", None)]
    path = str(tmp_path_factory.mktemp("sf"))
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in docs]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {i: t for i, t, _ in docs}


def test_each_stage_on_its_own_input(spark, tables):
    import corpus_pipeline as P
    path, texts = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = {"": docs}
    for k, (name, stage) in enumerate(P.STAGES):
        at = f"{path}/out-{k}"
        stage(spark, steps[list(steps)[-1]], path).write.mode("overwrite").parquet(at)
        steps[name] = spark.read.parquet(at)
        if name != "mix":
            assert steps[name].columns == docs.columns
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in steps.items()}
    assert list(ids)[1:] == ["toxicity", "near-duplicates", "decontamination", "secrets", "mix"]
    assert ids[""] - ids["toxicity"] == set(range(0, 300, 6))
    assert ids["toxicity"] - ids["near-duplicates"] == set(range(400, 420))
    assert ids["near-duplicates"] - ids["decontamination"] == set(range(500, 510))
    assert ids["secrets"] == ids["decontamination"]
    for r in steps["secrets"].collect():
        t = r["text"]
        if 600 <= r["doc_id"] < 605:
            assert "password" not in t and t.endswith("[assign] ok") and r["n_chars"] == len(t)
        else:
            assert t == texts[r["doc_id"]]
    words = lambda d: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in d.collect())
    assert abs(words(steps["mix"]) / words(steps["secrets"]) - 1.5) < 0.05


def test_run_gives_the_last_stage(spark, tables):
    import corpus_pipeline as P
    path, _ = tables
    a, b = ({(r["doc_id"], r["text"]): r["count"] for r in P.run(spark, path).groupBy("doc_id", "text").count().collect()} for _ in range(2))
    assert a == b and max(a.values()) <= 2
    empty = path + "-empty"
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").filter("false").write.parquet(f"{empty}/{t}.parquet")
    assert P.run(spark, empty).count() == 0
