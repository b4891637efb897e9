"""Score held-out rows with a fitted model and gather every metric, curve and importance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import quoted
from millrace.operators import curves, metrics
from millrace.operators.models import importance_table
from millrace.operators.preprocess import feature_names
from millrace.spec import Spec

LONG = "section string, item string, metric string, value double"


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The input columns with ``prediction`` and, for classifiers, the ``probability`` array."""
    scored = model.transform(df)
    out = [quoted(c) for c in df.columns] + ["prediction"]
    if "probability" in scored.columns:
        out.append(vector_to_array("probability").alias("probability"))
    return scored.select(*out)


@dataclass
class Evaluation:
    """Metrics of one model on one table; ``scored`` stays cached until ``close``."""

    name: str
    scored: DataFrame
    values: dict[str, float]
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def close(self) -> None:
        self.scored.unpersist()

    def long(self) -> DataFrame:
        """(section, item, metric, value): every number of the evaluation in one table."""
        spark = self.scored.sparkSession
        parts = [spark.createDataFrame([("metric", self.name, k, v) for k, v in sorted(self.values.items())], LONG)]
        if "confusion_matrix" in self.tables:
            cm = self.tables["confusion_matrix"]
            cell = F.concat(F.lit("true="), F.col("y_true").cast("int"), F.lit(",pred="), F.col("y_pred").cast("int"))
            parts.append(cm.select(F.lit("confusion_matrix").alias("section"), F.lit(self.name).alias("item"),
                                   cell.alias("metric"), F.col("n").cast("double").alias("value")))
            rep = self.tables["classification_report"]
            entries = [F.struct(F.lit(m).alias("m"), F.col(m).cast("double").alias("v"))
                       for m in ("precision", "recall", "f1", "support")]
            parts.append(rep.select(F.concat(F.lit(f"{self.name}/"), F.col("label")).alias("item"),
                                    F.explode(F.array(*entries)).alias("e")).select(
                F.lit("classification_report").alias("section"), "item",
                F.col("e.m").alias("metric"), F.col("e.v").alias("value")))
        if "feature_importance" in self.tables:
            parts.append(self.tables["feature_importance"].select(
                F.lit("feature_importance").alias("section"), F.lit(self.name).alias("item"),
                F.col("feature").alias("metric"), F.col("importance").alias("value")))
        return reduce(DataFrame.unionByName, parts)


def evaluate(model: PipelineModel, df: DataFrame, spec: Spec, name: str = "model", n_classes: int | None = None) -> Evaluation:
    """``df`` has the feature columns and ``label``; rows are scored once and cached."""
    scored = score(model, df)
    columns = ["label", "prediction"] + (["probability"] if "probability" in scored.columns else [])
    scored = scored.select(*columns).persist()
    spark = df.sparkSession
    if spec.is_classification:
        summary = metrics.summary_metrics(scored, "label", "prediction").first()
        values = {"balanced_accuracy": summary["balanced_accuracy"], "f1_score": summary["f1_weighted"],
                  "accuracy": summary["accuracy"]}
        tables = {
            "confusion_matrix": metrics.confusion_matrix(scored, "label", "prediction"),
            "classification_report": metrics.classification_report(scored, "label", "prediction"),
        }
        width = n_classes or getattr(model.stages[-1], "numClasses", 2)
        if width == 2:
            binary = scored.select(F.col("label").alias("y_true"), F.col("probability")[1].alias("score"))
            ranking = metrics.ranking_metrics(binary, "y_true", "score").first()
            values |= {"roc_auc": ranking["roc_auc"], "average_precision": ranking["average_precision"]}
            tables |= {"roc_curve": curves.roc_curve(binary), "pr_curve": curves.pr_curve(binary)}
        else:
            values["roc_auc"] = metrics.roc_auc_ovr_weighted(scored, "label", F.col("probability")).first()["roc_auc"]
    else:
        row = metrics.regression_metrics(scored, "label", "prediction").first()
        values = {m: row[m] for m in ("rmse", "mae", "r2", "mse")}
        if row["mape"] is not None:
            values["mape"] = row["mape"]
        tables = {
            "residuals": curves.residuals(scored, "label", "prediction"),
            "residual_histogram": curves.residual_histogram(scored, "label", "prediction"),
        }
    if hasattr(model.stages[-1], "featureImportances"):
        tables["feature_importance"] = importance_table(spark, model.stages[-1], feature_names(model))
    return Evaluation(name, scored, {k: v for k, v in values.items() if v is not None}, tables)


def union_long(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
