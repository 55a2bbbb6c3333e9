"""The corpus pipeline: documents to a clean, mixed training corpus.

Every stage takes the rows that its predecessor kept, with the columns of
``documents``, and returns the rows that it keeps:

1. toxicity: documents that the lexicon scores 0.7 or more go;
2. near-duplicates: of each group (five-word shingles, similarity 0.8) the
   document with the smallest id stays;
3. decontamination: documents that hold a benchmark item go;
4. secrets: each secret is replaced by its kind in brackets, no document goes;
5. mix: documents are repeated or left out to meet the sources' weights.

Defined cases: null and empty texts are clean, no copies and hold no secret,
and count no words in the mix; documents without an id stay through the first
four stages; rows that repeat an id belong to one document; columns of any
name are carried as they are; an empty table gives an empty result, and empty
labels or benchmark tables reject nothing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.llm import decontaminate, minhash, mixing, secrets, store, toxicity
from statlake.session import ship_package


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prepare(spark):
    ship_package(spark)
    store.small_batches(spark)


def toxicity_stage(spark, docs, sf_dir):
    _prepare(spark)
    return toxicity.drop_toxic(docs, _read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark, docs, sf_dir):
    _prepare(spark)
    return minhash.drop_near_duplicates(docs, words=5)


def decontamination_stage(spark, docs, sf_dir):
    _prepare(spark)
    return decontaminate.drop_leaks(docs, _read(spark, sf_dir, "benchmark"))


def secrets_stage(spark, docs, sf_dir):
    _prepare(spark)
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing_stage(spark, docs, sf_dir):
    _prepare(spark)
    return mixing.systematic_mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near-duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mix", mixing_stage),
]

#: Learned scores, MinHash, SimHash and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
