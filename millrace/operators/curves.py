"""The tables behind ROC, precision-recall, residual and learning-curve charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.operators.metrics import ranked_scores


def roc_curve(df: DataFrame, y_true: str = "y_true", score: str = "score", **options) -> DataFrame:
    """(threshold, fpr, tpr): starts at (infinity, 0, 0); points on a straight stretch are dropped."""
    totals = df.agg(F.count_if(col(y_true) == 1).alias("p"), F.count_if(col(y_true) != 1).alias("n")).first()
    ranked = ranked_scores(df, y_true, score, **options)
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    last = F.col("next_pos").isNull()
    bends = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    fpr = F.col("fp") / F.lit(totals["n"]) if totals["n"] else F.lit(float("nan"))
    tpr = F.col("tp") / F.lit(totals["p"]) if totals["p"] else F.lit(float("nan"))
    points = ranked.where(first | last | bends).select(
        F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr")
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def pr_curve(df: DataFrame, y_true: str = "y_true", score: str = "score", **options) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end point (null, 1, 0)."""
    p = df.agg(F.count_if(col(y_true) == 1).alias("p")).first()["p"]
    ranked = ranked_scores(df, y_true, score, **options)
    recall = F.col("tp") / F.lit(p) if p else F.lit(1.0)
    points = ranked.select(
        F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        recall.alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def residuals(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """The input with ``residual`` = true - predicted."""
    return df.withColumn("residual", col(y_true).cast("double") - col(y_pred).cast("double"))


def bin_of(value, low, high, bins: int):
    """Equal-width bin index with the last bin closed; a single-valued range is widened by one half."""
    width = F.when(high > low, (high - low) / bins).otherwise(F.lit(1.0 / bins))
    start = F.when(high > low, low).otherwise(low - 0.5)
    return F.least(F.floor((value - start) / width).cast("int"), F.lit(bins - 1)), start, width


def residual_histogram(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", bins: int = 50) -> DataFrame:
    """(bin, low, high, n): equal-width bins over the residual range, empty bins included."""
    values = residuals(df, y_true, y_pred).select("residual").where(F.col("residual").isNotNull())
    span = values.agg(F.min("residual").alias("lo"), F.max("residual").alias("hi")).first()
    if span["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    index, start, width = bin_of(F.col("residual"), F.lit(span["lo"]), F.lit(span["hi"]), bins)
    counts = values.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin", (start + F.col("bin") * width).alias("low"), (start + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def learning_curve(results: DataFrame, param: str) -> DataFrame:
    """(value, train_score, test_score): search results averaged per value of one parameter."""
    return results.groupBy(F.col("params")[param].alias("value")).agg(
        F.avg("train_score").alias("train_score"), F.avg("test_score").alias("test_score")
    )
