"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, covering_lsh, decontaminate, jaccard_join, licenses, packing, periodic_runs, quality, reshard, simhash, suffix_dedup, toxicity, warc
from ._store import materialize, scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("offending").cast("long").alias("n_offending"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"), length=100).drop("spans")


def op3_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = reshard.reshard(table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also ``n_within_3``: for the query set doc_id % 100 = 0, the other rows within 3 bits, found by block tables."""
    rows = materialize(simhash.fingerprint_and_follow(table(spark, sf_dir, "documents")), "op4")
    return simhash.count_within(rows, radius=3)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each pair of a document and a test item found in it."""
    return decontaminate.find_contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.digests(warc.read_pages(spark, path))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"), width=5, num=75, den=100)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), "score", "permitted"
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False)


def op11_covering_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering_lsh.near_duplicates(table(spark, sf_dir, "documents"), width=4, radius=4)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the texts are made periodic first."""
    return periodic_runs.run_report(periodic_runs.find_runs(periodic_runs.plant_periods(table(spark, sf_dir, "documents"))))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {"op1_toxicity": op1_toxicity, "op2_suffix_dedup": op2_suffix_dedup, "op3_reshard": op3_reshard, "op4_simhash": op4_simhash, "op5_decontamination": op5_decontamination, "op6_warc": op6_warc, "op7_jaccard_join": op7_jaccard_join, "op8_licenses": op8_licenses, "op9_quality": op9_quality, "op10_packing": op10_packing, "op11_covering_lsh": op11_covering_lsh, "op12_periodic_runs": op12_periodic_runs, "op13_conversation_repair": op13_conversation_repair}
ORACLES: dict[str, str] = {}
