import duckdb
import pytest

from statlake.llm import mixing
from tests.llm import helpers as H


def _oracle(df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    return con.execute(mixing.ORACLE).df()


@pytest.fixture(scope="module")
def mixed(spark):
    rows = H.awkward() + [(500 + i, "a b c", "hot") for i in range(300)] + [(999, "", "zero"), (7, "twice same", "s1"), (7, "twice same", "s1")]
    docs = H.documents(spark, rows)
    return docs, mixing.op3_query(docs).toPandas()


def test_plan_matches_sql(mixed):
    docs, got = mixed
    want, cols = _oracle(docs), sorted(got.columns)
    a = got[cols].sort_values(cols).reset_index(drop=True)
    b = want[cols].sort_values(cols).reset_index(drop=True)
    assert len(a) == docs.count()
    for c in cols:
        assert (a[c].fillna(-1) == b[c].fillna(-1)).all(), c


def test_targets_and_limits(mixed):
    docs, got = mixed
    assert (got.taken <= 2 * got["size"]).all() and (got.target <= 2 * got.source_size + 1e-9).all()
    per = got.merge(docs.select("doc_id", "source").distinct().toPandas().assign(source=lambda x: x.source.fillna("-")), on="doc_id")
    per = per.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert ((per.taken - per.target).abs() <= per.most + 1).all()


def test_mix_emits_the_planned_rows(spark, mixed):
    docs, got = mixed
    out = mixing.systematic_mix(docs)
    assert out.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    want = got.groupby("doc_id", dropna=False).copies.sum()
    want = {None if k != k else int(k): int(v) for k, v in want.items() if v}
    assert counts == want


def test_empty_and_wordless(spark):
    empty = H.documents(spark, [(1, "a", "s")]).filter("false")
    assert mixing.op3_query(empty).count() == 0 and mixing.systematic_mix(empty).count() == 0
    got = mixing.op3_query(H.documents(spark, [(1, None, None), (2, "", "s")])).collect()
    assert all(r["taken"] == 0 and r["target"] == 0 for r in got)
