"""Five stages from raw documents to tokens: repetition rules, line dedup, near-duplicate join, decontamination, piece encoding.

Each stage works on all that its predecessor kept. `run` writes what a stage returns as Parquet to the folder that driver and executors share, and the
next stage reads it back, so a lost executor costs a stage at most.

* quality rules: documents that fail the base rule or the repetition rules go.
* line dedup: of equal or nearly equal lines the first occurrence stays; `n_chars` follows the text. Documents stay, even without lines.
* n-gram join: of each group of linked documents the one with the smallest id stays. Documents without words link with nothing and stay.
* decontamination: documents with any window of a benchmark item go.
* pieces: the result, doc_id, n_tokens, ids and decoded_same, with merge-dropout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, line_dedup, ngram_join, pieces, quality_rules
from millrace.llm.shared import discard, written


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_clean(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, length_col="n_chars")


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pieces.encode(docs, ["doc_id"], pieces.load_vocabulary())
    return found.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"), "ids", "decoded_same")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("SentencePiece encoding and decoding", pieces_stage),
]

#: Edit distances of lines, suffix arrays and the merge agenda are not SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; each result is written and read back, the last one too."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
        if last is not None:
            discard(last)
        last = docs
    return docs
