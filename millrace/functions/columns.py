"""Column helpers shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.DoubleType, T.FloatType)

# Text cells that a delimited reader treats as null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def quoted(name: str) -> str:
    """A column name as SQL text, safe for dots and spaces."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating-point columns."""
    c = col(name)
    if isinstance(df.schema[name].dataType, FLOATS):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def number(df: DataFrame, name: str) -> Column:
    """The column as a double with NaN turned into null."""
    c = col(name).cast("double")
    if isinstance(df.schema[name].dataType, FLOATS):
        return F.when(~F.isnan(c), c)
    return c


def row_digest(columns: Sequence[str]) -> Column:
    """MD5 of all cells. Each goes in with its length, and null as '-', so that different rows never spell the same text."""
    cells = []
    for c in columns:
        text = col(c).cast("string")
        cells.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws("|", *cells))


def row_hash(columns: Sequence[str], seed: int | None = None) -> Column:
    """32 hex digits that order rows pseudo-randomly but reproducibly."""
    digest = row_digest(columns)
    return digest if seed is None else F.md5(F.concat_ws("|", digest, F.lit(str(seed))))


def rounded(c: Column, digits: int = 6) -> Column:
    """Round and turn -0.0 into 0.0, for results that are compared by value."""
    return F.round(c, digits) + F.lit(0.0)


#: Equal rows that `spread` sends to one partition together.
COPIES = 1_000


def fit_partitions(rows: int) -> int:
    """Partitions of a fit over so many rows: a sixteenth of the root, so that their number and their size grow together (60,000 rows: 15 of 4,000; 10^9: 1,976 of 506,000)."""
    return max(1, round(math.sqrt(rows) / 16))


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out by content and copy number to a number of partitions that follows from the number of rows, in a fixed order inside each.

    A fit then depends neither on the machine nor on the input's files, and a row that is repeated a million times
    is dealt out like any others. Columns need to be of types that can be grouped and ordered."""
    if partitions is None:
        partitions = fit_partitions(df.count())
    names = [quoted(c) for c in df.columns]
    run, copies = "_run_of_copies", "_copies"
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias(copies))
    runs = counted.select(*names, copies, F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(copies) - 1) / COPIES))).alias(run))
    dealt = runs.repartition(partitions, F.xxhash64(*names, run))
    own = F.least(F.lit(COPIES).cast("bigint"), F.col(copies) - F.col(run) * COPIES)
    return dealt.sortWithinPartitions(*names).select(*names, F.explode(F.array_repeat(F.lit(0), own.cast("int"))).alias(copies)).drop(copies)


def settled(df: DataFrame, limit: int = 50_000) -> DataFrame:
    """A small result as a local table that joins by broadcast; a larger one unchanged.

    At most ``limit`` + 1 rows reach the driver, so the broadcast is bounded by what was counted,
    and the big side of the join is never shuffled while the small side is being computed.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in rows], df.schema))
