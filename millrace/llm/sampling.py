"""A bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FIT_CHARS = 200_000


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, id_col: str = "doc_id", text_col: str = "text", longest: int = FIT_CHARS
) -> DataFrame:
    """(text, label) of at most `rows` labelled documents: those with the smallest hash among the labels that `learn` allows.

    Texts of more than `longest` characters are not fitted on (they are scored whole like any other), which bounds the sample in bytes too. Null labels, ids and texts are left out; an id that has several labels counts once, with the largest. The chosen ids, `rows` at most, are broadcast."""
    chosen = (
        labels.where(learn & F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.max(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(rows)
        .select(F.col(id_col).alias("_id"), "_label")
    )
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).dropna().where(F.length("text") <= longest).join(F.broadcast(chosen), "_id").select("text", F.col("_label").alias("label"))
