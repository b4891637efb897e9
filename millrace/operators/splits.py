"""Train/test splits, folds, label codes and class weights as columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, quoted
from millrace.operators.ordering import membership
from millrace.sources.sinks import scratch_path
from millrace.spec import Spec

SENT_CLASSES = 50_000  # up to so many, the table of codes is sent to the rows


def train_rows(n: int, test_size: float) -> int:
    return n - math.ceil(round(test_size * n, 9))


def class_quotas(sizes: dict[str, int], total: int) -> dict[str, int]:
    """Share ``total`` over classes: whole parts first, then the largest remainders."""
    n = sum(sizes.values())
    exact = {g: total * m / n for g, m in sizes.items()}
    quota = {g: math.floor(x) for g, x in exact.items()}
    spare = total - sum(quota.values())
    for g in sorted(exact, key=lambda g: (-round(exact[g] - quota[g], 9), g))[:spare]:
        quota[g] += 1
    return quota


def fold_sizes(n: int, folds: int) -> list[int]:
    return [n // folds + (1 if i < n % folds else 0) for i in range(folds)]


def dealt_sizes(sizes: dict[str, int], folds: int) -> dict[str, list[int]]:
    """Rows of each class per fold when the class-sorted table is dealt round-robin."""
    out, start = {}, 0
    for g in sorted(sizes):
        stop = start + sizes[g]
        out[g] = [(stop - i + folds - 1) // folds - (start - i + folds - 1) // folds for i in range(folds)]
        start = stop
    return out


def _inner_bounds(sizes: Sequence[int]) -> list[int]:
    bounds, total = [], 0
    for s in sizes[:-1]:
        total += s
        bounds.append(total)
    return bounds


def train_test_split(
    df: DataFrame,
    key: Sequence[str] = (),
    test_size: float = 0.2,
    seed: int = 42,
    stratify: str | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``split`` = 'train' or 'test' with exact sizes."""

    def plan(sizes: dict[str, int]) -> dict[str, list[int]]:
        total = train_rows(sum(sizes.values()), test_size)
        quotas = class_quotas(sizes, total) if sizes else {}
        return {g: [q] for g, q in quotas.items()}

    def table(sizes: DataFrame) -> DataFrame:
        """The quotas of `class_quotas`, in Spark."""
        n = sizes.agg(F.sum("n")).first()[0] or 0
        total = train_rows(n, test_size)
        exact = F.lit(total) * F.col("n") / F.lit(n)
        parts = sizes.withColumn("_base", F.floor(exact)).withColumn("_rest", F.round(exact - F.floor(exact), 9))
        spare = total - (parts.agg(F.sum("_base")).first()[0] or 0)
        larger = parts.orderBy(F.desc("_rest"), "_g").limit(spare).select("_g", F.lit(1).alias("_more"))
        quota = F.col("_base") + F.coalesce("_more", F.lit(0))
        return parts.join(larger, "_g", "left").select("_g", F.array(quota).alias("_cuts"))

    tagged = membership(df, "_m", plan, key, seed, group=stratify, order_by=order_by, table=table)
    return tagged.withColumn("split", F.when(F.col("_m") == 0, "train").otherwise("test")).drop("_m")


def split_table(df: DataFrame, spec: Spec) -> DataFrame:
    """The split a spec asks for; stratified only for classification with a target."""
    stratify = None
    if spec.stratify and spec.is_classification and spec.target in df.columns:
        stratify = spec.target
    order_by = () if spec.shuffle else (spec.order_by or spec.key)
    return train_test_split(df, spec.key, spec.test_size, spec.seed, stratify, order_by)


def kfold(df: DataFrame, key: Sequence[str] = (), folds: int = 5, seed: int = 42, order_by: Sequence[str] = ()) -> DataFrame:
    """Add ``fold``; the first ``n mod folds`` folds hold one row more. With ``order_by`` folds are contiguous in that order."""

    def plan(sizes: dict[str, int]) -> dict[str, list[int]]:
        return {g: _inner_bounds(fold_sizes(n, folds)) for g, n in sizes.items()}

    return membership(df, "fold", plan, key, seed, order_by=order_by)


def stratified_kfold(
    df: DataFrame, label: str, key: Sequence[str] = (), folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` with each class spread as evenly as round-robin dealing would."""

    def plan(sizes: dict[str, int]) -> dict[str, list[int]]:
        return {g: _inner_bounds(s) for g, s in dealt_sizes(sizes, folds).items()}

    def table(sizes: DataFrame) -> DataFrame:
        """The bounds of `dealt_sizes`, in Spark: where the class-sorted table reaches each class, and how dealing goes on from there."""
        earlier = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)  # one row per class
        placed = sizes.withColumn("_start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

        def upto(j: Column) -> Column:
            """Rows of the class in the folds before fold j."""
            each = F.transform(F.sequence(F.lit(0), j - 1), lambda i: F.floor((F.col("_start") + F.col("n") - i + folds - 1) / folds) - F.floor((F.col("_start") - i + folds - 1) / folds))
            return F.aggregate(each, F.lit(0).cast("bigint"), lambda t, x: t + x)

        bounds = F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), upto) if folds > 1 else F.array().cast("array<bigint>")
        return placed.select("_g", bounds.alias("_cuts"))

    return membership(df, "fold", plan, key, seed, group=label, table=table)


def class_codes(df: DataFrame, target: str) -> list:
    """The sorted classes; position is the code. A model has coefficients or counts of each class on the driver anyway."""
    values = df.where(col(target).isNotNull()).select(col(target).alias("value")).distinct()
    return sorted(r["value"] for r in values.collect())


def code_table(df: DataFrame, target: str) -> DataFrame:
    """(value, code): every class with its place in the order of classes, from 0, numbered in Spark however many classes there are.

    Distinct values are sorted into ranges and written; a range's first code is the number of values in the ranges before it, and inside a range they are counted. The
    driver sees the sizes of the ranges."""
    path = scratch_path(df.sparkSession, "classes")
    values = df.where(col(target).isNotNull()).select(col(target).alias("value")).distinct()
    values.repartitionByRange("value").withColumn("range", F.spark_partition_id()).write.parquet(path)
    ranges = df.sparkSession.read.parquet(path)
    sizes = sorted((r["range"], r["n"]) for r in ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = [(k, sum(n for _, n in sizes[:i])) for i, (k, _) in enumerate(sizes)]
    first = df.sparkSession.createDataFrame(starts, "range int, start bigint")
    place = F.row_number().over(Window.partitionBy("range").orderBy("value")) - 1
    return ranges.withColumn("place", place).join(F.broadcast(first), "range").select("value", (F.col("start") + F.col("place")).cast("double").alias("code"))


def encode_label(df: DataFrame, target: str, classes: Sequence | DataFrame, out: str = "label") -> DataFrame:
    """Replace classes by codes; a class that was not learned, or none, is an error.

    ``classes``: in the order of their codes, or a table of ``code_table``, which is joined on the typed value, however many classes there are."""
    unseen = F.raise_error(F.concat(F.lit(f"unseen or null class in {target}: "),
                                    F.coalesce(col(target).cast("string"), F.lit("null")))).cast("double")
    if isinstance(classes, DataFrame):
        codes = classes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        few = codes.limit(SENT_CLASSES + 1).count() <= SENT_CLASSES
    else:
        schema = T.StructType([T.StructField("_value", df.schema[target].dataType), T.StructField("_code", T.DoubleType())])
        codes = df.sparkSession.createDataFrame([(v, float(i)) for i, v in enumerate(classes)], schema)
        few = len(classes) <= SENT_CLASSES
    # shuffled by class, the rows of two classes would all meet in two tasks
    codes = F.broadcast(codes) if few else codes
    joined = df.join(codes, col(target) == F.col("_value"), "left")
    return joined.withColumn(out, F.coalesce("_code", unseen)).drop("_value", "_code")


def with_label(df: DataFrame, spec: Spec, classes: Sequence | None) -> DataFrame:
    """Add the numeric ``label``; the target must exist. Classes become their codes, and only learned classes may occur."""
    if spec.target not in df.columns:
        raise ValueError(f"target column {spec.target!r} not found")
    if spec.is_classification and classes is not None:
        return encode_label(df, spec.target, classes)
    return df.withColumn("label", col(spec.target).cast("double"))


def project_xy(df: DataFrame, target: str) -> DataFrame:
    """Features with the target renamed to ``label`` as last column."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    features = [quoted(c) for c in df.columns if c != target]
    return df.select(*features, col(target).alias("label"))


def balanced_weights(counts: dict) -> dict:
    """class -> n / (C * n_c)."""
    n, c = sum(counts.values()), len(counts)
    return {k: n / (c * m) for k, m in counts.items()}


def weight_column(label: str, weights: dict) -> Column:
    out = F.lit(1.0)
    for value, w in weights.items():
        out = F.when(col(label) == F.lit(value), F.lit(w)).otherwise(out)
    return out


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight), one row per class."""
    counts = df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    mean = counts.agg(F.avg("n")).scalar()  # rows / classes
    return counts.withColumn("weight", mean / F.col("n"))
