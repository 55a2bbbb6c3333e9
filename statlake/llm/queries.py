"""One registered query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from statlake.llm import decontaminate, extract, kneser_ney, lexical, minhash, mixing, mtree, prefix_trie, secrets, simhash, store, suffix_dedup, toxicity, warc
from statlake.session import ship_package
from statlake.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}


def _op(name, sources, fn, sql=None):
    def run(spark, sf_dir):
        ship_package(spark)
        store.small_batches(spark)
        return fn(*[table(spark, sf_dir, t) for t in sources.split()])
    run.__name__ = name
    QUERIES[name] = run
    if sql:
        ORACLE[name] = sql


_op("op1_mtree_topk", "embeddings", mtree.op1_query, mtree.ORACLE)
_op("op2_secret_scan", "documents", secrets.op2_query)
_op("op3_systematic_mix", "documents", mixing.op3_query, mixing.ORACLE)
_op("op4_zip_warc", "pages", warc.op4_query, warc.ORACLE)
_op("op5_circulant_minhash", "documents", minhash.op5_query)
_op("op6_suffix_dedup", "documents", suffix_dedup.op6_query)
_op("op7_kneser_ney", "documents", kneser_ney.op7_query)
_op("op8_toxicity", "documents labels", toxicity.op8_query)
_op("op9_block_labeller", "pages", extract.op9_query)
_op("op10_decontaminate", "documents benchmark", decontaminate.op10_query)
_op("op11_norm_buckets", "documents benchmark", lexical.op11_query, lexical.ORACLE)
_op("op12_prefix_trie", "conversations", prefix_trie.op12_query, prefix_trie.ORACLE)
_op("op13_simhash_tiles", "documents", simhash.op13_query)
