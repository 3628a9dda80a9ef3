"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

A stage takes (spark, docs, sf_dir) and returns documents with the columns of ``docs``; the last one
returns token ids. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import pfair_mix, pii_surrogates, piece_lattice, quality_rules, simhash
from ledgermill.llm.common import new_folder, table
from ledgermill.llm.queries import PIECE_MODEL, SURROGATE_KEY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the learned decision list go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: the one with the smallest id.

    The verdict is each row's own: rows of one id whose texts are no near-duplicates are judged apart. Where the smallest
    id has several texts in a group, the one with the smallest digest stays, and of equal rows the first by the other columns.
    Rows without an id cannot stand for a group and stay.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct("text", *[F.col(f"`{c}`") for c in rest]).alias("_row")
    rows = docs.select(F.col("doc_id").alias("_id"), simhash.text_key().alias("_key"), row)
    stay = simhash.survivors(docs, words=3, max_bits=3).toDF("_id", "_key")
    one = rows.join(stay, ["_id", "_key"]).groupBy("_id", "_key").agg(F.min("_row").alias("_row"))  # the join's order serves the grouping
    out = one.drop("_key").unionByName(rows.where(F.col("_id").isNull()).drop("_key"))
    return out.select(*[F.col("_id").alias(c) if c == "doc_id" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; ``n_chars`` follows the new text."""
    out = pii_surrogates.replace(docs, SURROGATE_KEY, count=None)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in mixed order, file by file and row by row."""
    return pfair_mix.in_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return piece_lattice.encode(docs.select("doc_id", "lang", "source", "text"), piece_lattice.read_model(PIECE_MODEL))


STAGES = [
    ("quality rules", quality), ("SimHash near-dedup", near_duplicates), ("PII surrogates", surrogates), ("Pfair mixing", mixing),
    ("SentencePiece encoding", tokens),
]

#: Learned rules, XXH64 and piece lattices are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = new_folder(spark, f"pipeline-{k + 1}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
