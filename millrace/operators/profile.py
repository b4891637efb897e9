"""Schema checks, null checks and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col, is_missing, number, numeric_columns, settled, string_columns
from millrace.operators.quantiles import exact_quantiles

SHORT_VALUE = 64
VALUE_HEAD = 32


def unpivot_structs(entries: Sequence[Column]) -> Column:
    return F.explode(F.array(*entries))


def schema_findings(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(finding, column) for missing and extra column names; nothing expected is valid."""
    actual = set(df.columns)
    rows = []
    if expected:
        rows += [("missing", c) for c in sorted(set(expected) - actual)]
        rows += [("extra", c) for c in sorted(actual - set(expected))]
    return df.sparkSession.createDataFrame(rows, "finding string, column string")


def schema_is_valid(df: DataFrame, expected: Sequence[str]) -> bool:
    return not expected or set(expected) <= set(df.columns)


def profile_missing(df: DataFrame) -> DataFrame:
    """(column, n_rows, missing, fraction): one pass, one row per column."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
               for i, c in enumerate(df.columns)]
    long = wide.select("n_rows", unpivot_structs(entries).alias("e")).select("e.column", "n_rows", "e.missing")
    return long.withColumn("fraction", F.try_divide(F.col("missing"), F.col("n_rows")))


def null_findings(df: DataFrame, max_fraction: float = 0.05) -> DataFrame:
    """Columns whose null fraction is strictly above the threshold."""
    return profile_missing(df).where(F.col("fraction") > F.lit(max_fraction)).select("column", "fraction")


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    spark = df.sparkSession
    schema = ("column string, count bigint, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double")
    if not columns:
        return spark.createDataFrame([], schema)
    aggs = []
    for i, c in enumerate(columns):
        x = number(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"), F.approx_count_distinct(x).alias(f"d{i}")]
    stats = df.agg(*aggs).first()
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75),
                                known={c: (stats[f"n{i}"], stats[f"d{i}"]) for i, c in enumerate(columns)})
    rows = [
        (c, stats[f"n{i}"], stats[f"mean{i}"], stats[f"std{i}"], stats[f"min{i}"],
         *quartiles[c], stats[f"max{i}"])
        for i, c in enumerate(columns)
    ]
    return spark.createDataFrame(rows, schema)


def profile_top_values(df: DataFrame, top: int = 5, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n, rank): the most frequent non-null values per text column.

    Equal counts are ordered by value. Long values are counted under a short key, their head and
    digest, so whole texts are not shuffled; the texts of the few winners are fetched in a second scan.
    """
    columns = list(columns or string_columns(df))
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "column string, value string, n bigint, rank int")
    value = F.col("e.value")
    long = F.length(value) > SHORT_VALUE
    key = F.when(long, F.concat(F.left(value, F.lit(VALUE_HEAD)), F.md5(value))).otherwise(value)
    entries = [F.struct(F.lit(c).alias("column"), col(c).alias("value")) for c in columns]
    cells = df.select(unpivot_structs(entries).alias("e")).where(value.isNotNull()).select(
        "e.column", key.alias("key"), long.alias("long"), "e.value"
    )
    counts = cells.groupBy("column", "long", "key").agg(F.count(F.lit(1)).alias("n"))
    # rank limits let Spark keep only the top rows of each task before the shuffle
    by_head = Window.partitionBy("column").orderBy(F.desc("n"), F.left("key", F.lit(VALUE_HEAD)))
    leaders = settled(counts.withColumn("place", F.rank().over(by_head)).where(F.col("place") <= top).drop("place"))
    named = leaders.where("not long").select("column", F.col("key").alias("value"), "n")
    if not leaders.where("long").isEmpty():
        texts = cells.where("long").join(leaders, ["column", "long", "key"]).groupBy("column", "key").agg(
            F.first("value").alias("value"), F.first("n").alias("n")
        )
        named = named.unionByName(texts.drop("key"))
    best = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return named.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """(value, n, percent, type, distinct): the frequency table of the target.

    Null is not a class: it is left out of the table, the distinct count and
    the frequencies, but it counts in the rows that ``percent`` refers to.
    """
    counts = df.groupBy(col(target).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("n_rows"), F.count("value").alias("distinct")).first()
    return counts.where(F.col("value").isNotNull()).select(
        "value", "n", (F.col("n") * 100 / F.lit(totals["n_rows"])).alias("percent"),
        F.lit(dict(df.dtypes)[target]).alias("type"), F.lit(totals["distinct"]).cast("bigint").alias("distinct"),
    )


def share_by_class(df: DataFrame, prediction: str) -> DataFrame:
    """(prediction, n, percent) per predicted class; one row per class."""
    counts = df.groupBy(col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.col("n") * 100 / counts.agg(F.sum("n")).scalar())


def prediction_confidence(df: DataFrame, probabilities: Column) -> DataFrame:
    """mean, median, min and max of the largest class probability per row."""
    top = df.select(F.array_max(probabilities).alias("confidence"))
    stats = top.agg(F.avg("confidence").alias("mean"), F.min("confidence").alias("min"),
                    F.max("confidence").alias("max"), F.count("confidence").alias("n"),
                    F.approx_count_distinct("confidence").alias("d")).first()
    median = exact_quantiles(top, ["confidence"], [0.5], known={"confidence": (stats["n"], stats["d"])})["confidence"][0]
    return df.sparkSession.createDataFrame(
        [(stats["mean"], median, stats["min"], stats["max"])],
        "mean double, median double, min double, max double",
    )
