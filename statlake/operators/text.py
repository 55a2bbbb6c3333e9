"""Text statistics: tokenising, TF-IDF, term frequencies and rank–frequency."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.operators.ranks import keyed_prefix

# Fixed value: token pattern (Latin and Ukrainian Cyrillic letters and '-',
# at least two characters), applied to lower-cased text.
TOKEN_PATTERN = "[А-Яа-яA-Za-zЇїІіЄєҐґ-]{2,}"


def tokenize(df: DataFrame, text: str, doc_id: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """``(doc_id, term)`` one row per token occurrence, whole texts."""
    toks = F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), 0)
    return df.select(doc_id, F.explode(toks).alias("term"))


def term_counts(tokens: DataFrame, doc_id: str) -> DataFrame:
    return tokens.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def row_term_counts(df: DataFrame, text: str, doc_id: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """``(doc_id, term, tf)`` with one row per row of ``df`` and different term,
    counted where the text lies: no token is shuffled."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql import types as T
    toks = df.select(doc_id, F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), 0).alias("_t"))

    def count(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                terms = b.column(1).flatten().dictionary_encode()
                m = b.num_rows
                row = pc.list_parent_indices(b.column(1)).to_numpy().astype(np.int64)
                # rows of one term follow each other, which the shuffle's compression makes use of
                cell, n = np.unique(terms.indices.to_numpy().astype(np.int64) * m + row, return_counts=True)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cell % m)), terms.dictionary.take(pa.array(cell // m)),
                                                  pa.array(n, pa.int64())], [doc_id, "term", "tf"])
    return toks.mapInArrow(count, T.StructType([toks.schema[doc_id], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]))


def tfidf(df: DataFrame, text: str, doc_id: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """tf·(ln((1+n)/(1+df)) + 1), rows L2-normalised; long
    ``(doc_id, term, tf, df, tfidf)``.  The counts are shuffled twice: by term,
    where rows that repeat an id are added up and the document frequencies
    are counted and joined, and by document for the norms.  Weights are taken
    after that, so they are not shuffled."""
    docs = df.select(doc_id, text)
    n_docs = docs.agg(F.count(F.lit(1)).alias("_n"))
    # the term's partition holds all its documents: neither the sums nor the join below shuffle again
    tf = row_term_counts(docs, text, doc_id, pattern).repartition("term").groupBy(doc_id, "term").agg(F.sum("tf").alias("tf"))
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = tf.join(dfreq.hint("shuffle_hash"), "term").repartition(doc_id).crossJoin(F.broadcast(n_docs))
    w = w.withColumn("_w", F.col("tf") * (F.log((1.0 + F.col("_n")) / (1.0 + F.col("df"))) + 1.0))
    # L2 norm per document: a window over one document's distinct terms
    # (bounded by the document, never by the corpus)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(doc_id)))
    return w.withColumn("tfidf", F.col("_w") / norm).select(doc_id, "term", "tf", "df", "tfidf")


def zipf_table(df: DataFrame, text: str, doc_id: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Corpus term counts with rank 1.. by (count desc, term); ranks
    from bucketed prefix counts, so a large vocabulary is never sorted in
    one task.  ``(term, count, rank, log_rank, log_count)``.  The counts (one
    row per term) are kept on the executors' disks for the sampling job and
    the ranking that follow."""
    counts = tokenize(df, text, doc_id, pattern).groupBy("term").agg(F.count(F.lit(1)).alias("count")).persist(StorageLevel.DISK_ONLY)
    c = counts.withColumn("_neg", -F.col("count")).withColumn("_one", F.lit(1))
    r = keyed_prefix(c, [], ["_neg", "term"], "_one", out="_before")
    return r.select("term", "count", (F.col("_before") + 1).cast("long").alias("rank")).withColumn(
        "log_rank", F.log(F.col("rank").cast("double"))).withColumn("log_count", F.log(F.col("count").cast("double")))
