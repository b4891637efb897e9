"""Classification and regression metrics as aggregations over scored rows.

Every function takes a frame with the true value, the prediction and, where needed, a
score. ``parts`` names extra grouping columns (fold, train/test, class) so that one job
scores all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col

SCORES_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4_096


# --- counts ------------------------------------------------------------------------------


def confusion_counts(df: DataFrame, y_true: str, y_pred: str, parts: Sequence[str] = ()) -> DataFrame:
    """(parts, y_true, y_pred, n) for the pairs that occur."""
    return df.groupBy(*parts, col(y_true).alias("y_true"), col(y_pred).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Counts over the sorted union of the labels, zero where a pair never occurs."""
    counts = confusion_counts(df, y_true, y_pred)
    # the label set has one element per class, and the result is its square by definition
    labels = counts.agg(
        F.array_sort(F.array_union(F.collect_set("y_true"), F.collect_set("y_pred"))).alias("labels")
    )
    grid = labels.select(F.explode("labels").alias("y_true"), "labels").select(
        "y_true", F.explode("labels").alias("y_pred")
    )
    return grid.join(counts, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def class_scores(counts: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per label, 0 where undefined."""
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("tp")),
    )
    per_label = counts.select(*parts, F.explode(sides).alias("s")).groupBy(*parts, "s.label").agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.tp").alias("tp")
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    return per_label.select(
        *parts, "label",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support", "tp",
    )


def class_summary(scores: DataFrame, parts: Sequence[str] = (), positive=1) -> DataFrame:
    """One row per part: accuracy, balanced accuracy and averaged scores."""
    support = F.sum("support")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / support

    def of_positive(c: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("label") == F.lit(positive), F.col(c))), F.lit(0.0))

    return scores.groupBy(*parts).agg(
        (F.sum("tp") / support).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"), weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        of_positive("precision").alias("precision"), of_positive("recall").alias("recall"), of_positive("f1").alias("f1"),
        support.alias("support"),
    )


def classification_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """(label, precision, recall, f1, support): classes, accuracy, macro and weighted rows."""
    scores = class_scores(confusion_counts(df, y_true, y_pred))
    summary = class_summary(scores)
    rows = F.array(*[
        F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                 F.col("support").alias("support"))
        for name, p, r, f in (
            ("accuracy", F.col("accuracy"), F.col("accuracy"), F.col("accuracy")),
            ("macro avg", F.col("precision_macro"), F.col("recall_macro"), F.col("f1_macro")),
            ("weighted avg", F.col("precision_weighted"), F.col("recall_weighted"), F.col("f1_weighted")),
        )
    ])
    averages = summary.select(F.explode(rows).alias("r")).select("r.*")
    classes = scores.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1", "support")
    return classes.unionByName(averages)


def summary_metrics(df: DataFrame, y_true: str, y_pred: str, parts: Sequence[str] = (), positive=1) -> DataFrame:
    return class_summary(class_scores(confusion_counts(df, y_true, y_pred, parts), parts), parts, positive)


# --- ranking -----------------------------------------------------------------------------


def ranked_scores(
    df: DataFrame, y_true: str, score: str, parts: Sequence[str] = (), scores_per_bucket: int = SCORES_PER_BUCKET,
    n_rows: int | None = None,
) -> DataFrame:
    """One row per distinct score, highest first, with running counts.

    Columns: parts, score, pos, neg, tp, fp (counts at or above the score) and
    next_pos, next_neg (the counts of the next lower score, null at the end).

    With few distinct scores one window per part does it. With many, scores are bucketed by
    approximate quantiles, running sums are taken inside each bucket, and the totals of
    the higher buckets (a table of at most MAX_BUCKETS rows per part) are added. A known
    ``n_rows`` of the largest part saves the pass that estimates the distinct scores if it fits.
    """
    positive = (col(y_true) == 1).cast("bigint")
    given = F.coalesce(col(score).cast("double"), F.raise_error(F.lit(f"row without {score}")).cast("double"))
    # no row fails this filter; stated here, it is the same in every branch below, which then share one shuffle
    base = df.select(*parts, given.alias("score"), positive.alias("pos")).where(F.col("score").isNotNull())
    grouped = base.groupBy(*parts, "score").agg(
        F.sum("pos").alias("pos"), (F.count(F.lit(1)) - F.sum("pos")).alias("neg")
    )
    if n_rows is not None and n_rows <= scores_per_bucket:
        distinct = n_rows
    else:
        per_part = base.groupBy(*parts).agg(F.approx_count_distinct("score").alias("d"))
        distinct = per_part.agg(F.max("d").alias("d")).first()["d"] or 0
    upto = (Window.unboundedPreceding, 0)
    if distinct <= scores_per_bucket:
        order = Window.partitionBy(*parts).orderBy(F.desc("score"))
        return grouped.select(
            "*",
            F.sum("pos").over(order.rowsBetween(*upto)).alias("tp"),
            F.sum("neg").over(order.rowsBetween(*upto)).alias("fp"),
            F.lead("pos").over(order).alias("next_pos"),
            F.lead("neg").over(order).alias("next_neg"),
        )

    n = min(MAX_BUCKETS, max(2, -(-distinct // scores_per_bucket)))
    # over the distinct scores, which is what the buckets hold: a score that most rows share bounds one bucket at most
    at = grouped.agg(F.percentile_approx("score", [i / n for i in range(1, n)], 10_000).alias("q")).first()["q"]
    splits = [float("-inf"), *sorted(set(at)), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(grouped)
    inside = Window.partitionBy(*parts, "bucket").orderBy(F.desc("score"))
    totals = bucketed.groupBy(*parts, "bucket").agg(
        F.sum("pos").alias("bucket_pos"), F.sum("neg").alias("bucket_neg"),
        F.max_by(F.struct("pos", "neg"), "score").alias("head"),
    )
    higher = Window.partitionBy(*parts).orderBy(F.desc("bucket"))
    before = higher.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts, "bucket",
        F.coalesce(F.sum("bucket_pos").over(before), F.lit(0)).alias("pos_before"),
        F.coalesce(F.sum("bucket_neg").over(before), F.lit(0)).alias("neg_before"),
        F.lead("head").over(higher).alias("next_head"),
    )
    return bucketed.join(offsets, [*parts, "bucket"]).select(
        *parts, "score", "pos", "neg",
        (F.sum("pos").over(inside.rowsBetween(*upto)) + F.col("pos_before")).alias("tp"),
        (F.sum("neg").over(inside.rowsBetween(*upto)) + F.col("neg_before")).alias("fp"),
        F.coalesce(F.lead("pos").over(inside), F.col("next_head.pos")).alias("next_pos"),
        F.coalesce(F.lead("neg").over(inside), F.col("next_head.neg")).alias("next_neg"),
    )


def ranking_metrics(df: DataFrame, y_true: str, score: str, parts: Sequence[str] = (), **options) -> DataFrame:
    """(parts, roc_auc, average_precision, n_pos, n_neg); exact, ties count half."""
    ranked = ranked_scores(df, y_true, score, parts, **options)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    n_pos, n_neg = F.sum(pos), F.sum(neg)
    auc = F.sum(neg * (tp - pos / 2)) / (n_pos * n_neg)
    precision = F.sum(pos * tp / (tp + fp)) / n_pos
    return ranked.groupBy(*parts).agg(
        F.when((n_pos > 0) & (n_neg > 0), auc).alias("roc_auc"),
        F.when(n_pos > 0, precision).otherwise(0.0).alias("average_precision"),
        n_pos.cast("bigint").alias("n_pos"), n_neg.cast("bigint").alias("n_neg"),
    )


def one_vs_rest(df: DataFrame, y_true: str, probabilities: Column, parts: Sequence[str] = ()) -> DataFrame:
    """(parts, class, hit, score): one row per row and class."""
    return df.select(
        *parts, col(y_true).cast("int").alias("_y"), F.posexplode(probabilities).alias("class", "score")
    ).select(*parts, "class", (F.col("_y") == F.col("class")).cast("int").alias("hit"), "score")


def roc_auc_ovr_weighted(
    df: DataFrame, y_true: str, probabilities: Column, parts: Sequence[str] = (), **options
) -> DataFrame:
    """(parts, roc_auc): per-class AUC against the rest, weighted by class prevalence."""
    long = one_vs_rest(df, y_true, probabilities, parts)
    per_class = ranking_metrics(long, "hit", "score", [*parts, "class"], **options)
    weighted = F.sum(F.col("roc_auc") * F.col("n_pos")) / F.sum("n_pos")
    return per_class.groupBy(*parts).agg(weighted.alias("roc_auc"))


# --- regression --------------------------------------------------------------------------


def regression_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", parts: Sequence[str] = ()) -> DataFrame:
    """(parts, mse, rmse, mae, r2, mape) in one pass; mape is null if any true value is 0."""
    y, p = col(y_true).cast("double"), col(y_pred).cast("double")
    error = y - p
    mse = F.avg(error * error)
    spread = F.var_pop(y)
    r2 = F.when(spread > 0, 1 - mse / spread).otherwise(F.when(mse == 0, 1.0).otherwise(0.0))
    mape = F.when(F.count_if(y == 0) == 0, F.avg(F.abs(F.try_divide(error, y))) * 100)
    return df.groupBy(*parts).agg(
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(error)).alias("mae"), r2.alias("r2"), mape.alias("mape")
    )


# --- many metrics at once ------------------------------------------------------------------

RANKING = {"roc_auc", "average_precision"}
COUNTING = {"accuracy", "balanced_accuracy", "f1", "precision", "recall", "f1_weighted", "f1_macro",
            "precision_weighted", "recall_weighted", "precision_macro", "recall_macro"}
BINARY = {"f1", "precision", "recall"}
REGRESSION = {
    "neg_root_mean_squared_error": ("rmse", -1.0), "neg_mean_squared_error": ("mse", -1.0),
    "neg_mean_absolute_error": ("mae", -1.0), "r2": ("r2", 1.0), "rmse": ("rmse", 1.0),
    "mse": ("mse", 1.0), "mae": ("mae", 1.0),
}


def check_metrics(names: Sequence[str], task: str) -> None:
    known = set(REGRESSION) if task == "regression" else RANKING | COUNTING | {"roc_auc_ovr_weighted"}
    unknown = [m for m in names if m not in known]
    if unknown:
        raise ValueError(f"unknown {task} metrics: {unknown}")


def score_parts(
    scored: DataFrame, names: Sequence[str], task: str, parts: Sequence[str], n_classes: int = 2,
    n_rows: int | None = None,
) -> dict[tuple, dict[str, float]]:
    """Metric values per combination of parts, from label, prediction and probability (an array)."""
    check_metrics(names, task)
    parts = list(parts)
    out: dict[tuple, dict[str, float]] = {}

    def put(table: DataFrame, columns: dict[str, tuple[str, float]]) -> None:
        for r in table.collect():  # one row per part
            for name, (column, sign) in columns.items():
                value = r[column]
                place = out.setdefault(tuple(r[p] for p in parts), {})
                place[name] = float("nan") if value is None else sign * value

    if task == "regression":
        put(regression_metrics(scored, "label", "prediction", parts), {m: REGRESSION[m] for m in names})
        return out
    counting = [m for m in names if m in COUNTING]
    if n_classes > 2 and (single := sorted(BINARY & set(names))):
        raise ValueError(f"{single} are defined for two classes; use the macro or weighted forms for {n_classes}")
    if counting:
        put(summary_metrics(scored, "label", "prediction", parts), {m: (m, 1.0) for m in counting})
    ranking = [m for m in names if m in RANKING]
    multiclass = n_classes > 2
    if ranking and not multiclass:
        positive = scored.select(*parts, "label", F.col("probability")[1].alias("score"))
        put(ranking_metrics(positive, "label", "score", parts, n_rows=n_rows), {m: (m, 1.0) for m in ranking})
    if "roc_auc_ovr_weighted" in names or (multiclass and "roc_auc" in names):
        table = roc_auc_ovr_weighted(scored, "label", F.col("probability"), parts,
                                     n_rows=n_rows)
        put(table, {m: ("roc_auc", 1.0) for m in names if m in ("roc_auc", "roc_auc_ovr_weighted")})
    if multiclass and "average_precision" in names:
        long = one_vs_rest(scored, "label", F.col("probability"), parts)
        per_class = ranking_metrics(long, "hit", "score", [*parts, "class"], n_rows=n_rows)
        put(per_class.groupBy(*parts).agg(F.avg("average_precision").alias("average_precision")),
            {"average_precision": ("average_precision", 1.0)})
    return out
