"""One query for each operator, over its whole table, and the oracle SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import compression_quality, conversation_repair, ego_join, license_scan, pfair_mix, phrase_mining, pii_surrogates, piece_lattice, ppm_langid, quality_rules, resharding, simhash, warc_writer
from ledgermill.llm.common import id_crc, stage, table
from ledgermill.llm.sql import EMBEDDING_LINKS, MIXED, PHRASES, WARC_RECORDS, licenses

#: A path parameter; the file is never copied.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: For the test tables only; real runs pass a secret.
SURROGATE_KEY = "a key for the test tables"
OLD_SHARDS, NEW_SHARDS = 12, 16
#: Mixing targets go from 1 to this, by source.
TARGETS = 4


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed", "rule", "kept")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op3_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc_writer.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, max_bits=3)


def op5_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), id_crc() % 3 == 1)


def op6_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve shards (by id) become sixteen of equal bytes; checksums are those of the texts read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    placed = resharding.place(docs, F.coalesce(id_crc() % OLD_SHARDS, F.lit(0)), OLD_SHARDS, NEW_SHARDS)
    folder = resharding.write_shards(placed)
    text_crc32 = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32")
    return resharding.layout(spark, folder, placed.schema).select(
        "doc_id", "size", text_crc32, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved",
    )


def op7_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), id_crc() % 4 == 2)


def op8_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = piece_lattice.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_lattice.read_model(PIECE_MODEL))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "round_trip", "ids")


def op9_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), cosine=0.98)


def op10_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents laid out in mixed order; the result is what the stored rows say. Sources by name have targets 1, 2, 3, 4, 1 and so on."""
    docs = table(spark, sf_dir, "documents")
    names = sorted((r[0] for r in docs.select("source").distinct().collect()), key=lambda x: (x is not None, x))  # components of the mixture
    mixed = pfair_mix.mix(docs, {name: 1.0 + k % TARGETS for k, name in enumerate(names)})
    laid = stage(pfair_mix.lay_out(mixed), "mixed", "zstd")
    return pfair_mix.positions(laid.select("doc_id", "source", *pfair_mix.RESULTS))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, those that lost all rows too."""
    rows = table(spark, sf_dir, "conversations")
    summaries, turns = conversation_repair.repair(conversation_repair.damaged(rows))
    found = summaries.withColumnRenamed("conv", "_a").join(
        conversation_repair.digests(turns).withColumnRenamed("conv", "_b"), F.col("_a").eqNullSafe(F.col("_b")))
    out = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_a")), "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "conv_id", count(F.col("high") - F.col("low") + 1 - F.col("n_distinct")).alias("gaps"),
        *[count(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.mine(table(spark, sf_dir, "documents").select("lang", "text"), least=30, top=2000)


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_pii_surrogates, op3_warc_writer, op4_simhash, op5_compression_quality, op6_resharding, op7_ppm_langid,
    op8_piece_lattice, op9_ego_join, op10_pfair_mix, op11_conversation_repair, op12_license_scan, op13_phrase_mining,
)}
ORACLE = {"op3_warc_writer": WARC_RECORDS, "op9_ego_join": EMBEDDING_LINKS, "op10_pfair_mix": MIXED} | {
    "op12_license_scan": licenses(
        [(license_scan.words_of(p), label) for p, label in license_scan.PHRASES], [(license_scan.template_words(t), label) for t, label in license_scan.TEMPLATES],
        license_scan.PERCENT, license_scan.BLOCK_WORDS),
    "op13_phrase_mining": PHRASES,
}
