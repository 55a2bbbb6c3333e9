import duckdb
import pytest

import __spark_entry__ as E
from statlake.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["corr_choice_lineitem", "describe_lineitem", "quantiles_lineitem", "spearman_lineitem",
        "monthly_windows_orders", "acf_orders", "cumulative_share_orders", "economics_part",
        "tfidf_documents", "zipf_documents", "selection_probs_part", "kendall_events", "lda_report_lineitem",
        "corr_choice_events", "anova_lineitem", "ks_norm_events", "weighted_sample_part", "tournament_shares_part",
        "f_scores_embeddings", "chi2_embeddings", "nearest_centroid_embeddings", "silhouette_labels_embeddings",
        "path_length_embeddings", "stratified_split_lineitem", "holt_winters_orders", "decompose_orders", "granger_l1_lineitem",
        "tree_nodes_lineitem"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 3
    assert "method" in df.columns and "r" in df.columns


def test_entry_works_without_the_optional_subpackage(tmp_path):
    """With the llm folders and the pipeline gone, the entry imports and keeps all other queries."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(os.path.join(root, "statlake"), tmp_path / "statlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    n, extra = out.stdout.split()
    from statlake.plans.catalog import QUERIES
    assert int(n) == len(QUERIES) and extra == "False", out.stderr


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)

    def norm(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        out = [tuple(None if v != v else v for v in (r[i] for i in order)) for r in rows]
        return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))

    assert norm(sdf.columns, [tuple(r) for r in sdf.collect()]) == norm(dcols, res.fetchall())
