"""Corpus pipeline: reject toxic documents, keep one of each group of near copies, mask secrets, mix sources, pack.

STAGES holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. Each
stage's result is written as Parquet and read again as the next one's documents. All but the last
return the columns of documents; extra columns are passed on. The classifier of the first stage and
the packing cannot be said in SQL, so there is no ORACLE_SQL; a test holds the stages against plain
versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import jaccard, mixing, queries, secrets, toxicity
from tradeloom.llm.common import free, table, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below one half. Null and empty texts stay."""
    return toxicity.reject(docs, queries.toxic_chain(spark, sf_dir, docs), "toxic")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near copies: five-word Jaccard of 0.8 or more.

    Texts without words are linked with nothing and stay. Rows that repeat doc_id and text become
    one; rows of one doc_id with different texts are judged one by one, and of those in one component
    the smallest hash of a text stays. Rows without a doc_id stay, as nothing tells which one of a
    group would be theirs.
    """
    found = jaccard.grouped(docs, n=5, percent=80).filter(F.col("doc_id").isNotNull())
    first = found.filter("n_shingles > 0").groupBy("group").agg(F.min(F.struct("doc_id", "th")).alias("f")).select("f.doc_id", "f.th")
    (th,) = free(docs, "_th")
    keep = first.unionByName(found.filter("n_shingles = 0").select("doc_id", "th").distinct()).toDF("doc_id", th)
    rows = docs.withColumn(th, F.xxhash64(F.col("text").cast("string"))).join(keep, ["doc_id", th], "left_semi")
    return rows.dropDuplicates(["doc_id", th]).select(docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are masked and n_chars follows."""
    return secrets.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, 0 to 3 times.

    Rows that repeat doc_id, source and text are one document of their joint size; when it is
    taken, all of them are.
    """
    i, src, th, n, copy = free(docs, "_i", "_s", "_t", "_n", "_copy")
    key = [F.col("doc_id").alias(i), F.col("source").alias(src), F.xxhash64("text").alias(th)]
    sized = docs.select(*key, mixing.n_words(F.col("text")).alias("size")).groupBy(i, src, th).agg(F.sum("size").alias("size"))
    taken = mixing.mix(written(sized.select(F.struct(i, th).alias("doc_id"), F.col(src).alias("source"), "size"), "sizes"))
    taken = taken.filter("copies > 0").select(f"doc_id.{i}", f"doc_id.{th}", F.col("source").alias(src), F.col("copies").alias(n))
    same = docs["doc_id"].eqNullSafe(F.col(i)) & docs["source"].eqNullSafe(F.col(src)) & (F.xxhash64(docs["text"]) == F.col(th))
    rows = docs.join(taken, same).withColumn(copy, F.explode(F.expr(f"array_repeat(0, cast({n} as int))")))
    return rows.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most 2048 tokens."""
    return queries.packed(docs)


STAGES = [
    ("toxicity", reject_toxic), ("ngram_jaccard_join", one_of_each), ("secret_scan", mask_secrets),
    ("source_mix", mix_sources), ("best_fit_packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
