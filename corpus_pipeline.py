"""From raw documents to packed training sequences, in five stages of the operators in ``landfall.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import line_dedup, minhash, mixing, packing, toxicity
from landfall.llm.common import Work, table
from landfall.llm.queries import tokenizer, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    return scored.filter("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that five or more of them share; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(Work(spark, "pipeline-lines"), docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Jaccard similarity of five-word shingles 0.8 or more): the one with the smallest id.

    Of several rows of an id one stays; a document without an id stays, once for each text. 30 bands of 4 hashes miss a pair at
    0.8 with odds 1.4e-7.
    """
    work = Work(spark, "pipeline-minhash")
    lost = minhash.near_duplicates(work, docs, percent=80, bands=30, band_rows=4).filter("not kept").select("doc_id").distinct()
    kept = docs.join(lost, "doc_id", "left_anti").select(docs.columns)
    key = {"_id": F.col("doc_id"), "_digest": F.when(F.col("doc_id").isNull(), F.sha2(F.col("text").cast("binary"), 256))}
    rows = docs.withColumns(key).groupBy("_id", "_digest").agg(F.count("*").alias("_rows")).filter("_rows > 1").select(*key)
    rows = work.keep(rows, "repeated")
    if rows.isEmpty():
        return kept
    keyed = kept.withColumns(key)
    among = [keyed[c].eqNullSafe(rows[c]) for c in key]
    once = keyed.join(rows, among, "left_semi").groupBy(*key)
    once = once.agg(F.min(F.struct(F.xxhash64("text").alias("first"), F.struct(*docs.columns).alias("row"))).alias("least"))
    rest = keyed.join(rows, among, "left_anti").select(docs.columns)
    return rest.union(once.select("least.row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken."""
    return mixing.emitted(mixing.mix(docs)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their places in sequences of 1,024 tokens."""
    return packing.pack(Work(spark, "pipeline-packing"), docs, tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Toxicity, MinHash and tokenizing have no SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    work = Work(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
