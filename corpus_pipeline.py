"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

A stage takes (spark, docs, sf_dir) and works on all that its predecessor kept:

1. quality: documents that the classifier, trained on ``labels``, scores below 0.3 go.
2. near_duplicates: one document (the smallest id) of each group of linked documents stays.
3. repeated_substrings: every byte covered by a 100-byte string that also starts earlier is cut from the texts.
4. decontamination: documents that hold a test item of ``benchmark`` go.
5. packing: all tokens are packed into sequences of 2048 along a Hilbert curve; a row per piece.

All but the last return the columns of ``documents``; n_chars follows the text. Rows with a null doc_id and rows without words take part
in no near-duplicate group and stay. Rows that share an id are one node of stage 2, so all rows of an id that stays, stay; in
the other stages each row is a document of its own. An empty table gives no rows; extra columns are carried along to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import decontaminate, jaccard_join, packing, quality, suffix_dedup
from shardloom.llm._store import discard, scratch
from shardloom.llm.queries import table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.reject_low_quality(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_representatives(docs, width=5, num=75, den=100)


def cut_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(docs, length=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), keep_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("repeated_substrings", cut_repeated_substrings),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]
#: SQL has neither the models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; a stage's table is deleted once the next one's is written."""
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
        if held:
            discard(spark, held)
        held = path
    return STAGES[-1][1](spark, docs, sf_dir)
