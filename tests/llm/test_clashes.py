"""Stages carry columns of any name, those that operators use inside included."""

import random

import pytest
from pyspark.sql import functions as F

from statlake.llm import decontaminate, minhash, mixing, secrets, toxicity
from tests.llm import helpers as H

NAMES = ("_s _src _k _nth _copy _copies copies copy nth key size rank _spans _hide spans kind start _leaks leaks _text _gone gone doc node "
         "component component_id kept _score score n_hits _n_hits weight n_words _c0 _c1 c0 c1 c4 _cell cell salt n k1 rep label x a b").split()


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(5)
    rows = [(i, H.prose(r, 60), f"s{i % 2}") for i in range(30)] + [(40, H.prose(r, 30) + " password=q8Zr1Lw2Tt ok", "s1"), (None, "no id", "s0"), (3, "again", None)]
    df = H.documents(spark, rows, clash=False)
    return df.withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in NAMES})


def _check(docs, out):
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows
    for r in rows:
        for c in NAMES:
            assert r[c] == f"{c}:{'none' if r['doc_id'] is None else r['doc_id']}"
    return rows


def test_mix(docs):
    got = _check(docs, mixing.systematic_mix(docs))
    plan = {}
    for r in mixing.mix_plan(docs).collect():
        plan[r["doc_id"], r["size"]] = r["copies"]
    want = sorted(((i, n) for (i, n), c in plan.items() for _ in range(c)), key=str)
    assert sorted(((r["doc_id"], len(H.words(r["text"]))) for r in got), key=str) == want


def test_secrets(docs):
    got = _check(docs, secrets.redact(docs))
    assert len(got) == docs.count() and any("[assign]" in r["text"] for r in got)


def test_near_duplicates(docs):
    assert len(_check(docs, minhash.drop_near_duplicates(docs.union(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(5)))))) == docs.count() + 1


def test_decontamination(spark, docs):
    item = spark.createDataFrame([(1, docs.filter("doc_id = 7").first()["text"])], "item_id long, text string")
    assert 7 not in {r["doc_id"] for r in _check(docs, decontaminate.drop_leaks(docs, item))}


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(i, 0) for i in range(30)], "doc_id long, toxic int")
    assert len(_check(docs, toxicity.drop_toxic(docs, labels))) == docs.count()


def test_stages_take_empty_tables(spark, docs, tmp_path):
    """No labels and no items reject nothing; no documents give no rows; an id that is null stays until the mix."""
    import corpus_pipeline as P
    path = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id is null or doc_id < 12")
    for name, stage in P.STAGES[:4]:
        assert stage(spark, plain, path).count() == plain.count(), name
    for name, stage in P.STAGES:
        assert stage(spark, plain.filter("false"), path).count() == 0, name
