"""Input frames derived from the given tables; the same expressions run in Spark and in SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.spec import FOREST_SPACE, Spec

LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")

# nulls in about one row of 17 and of 13, and a learnable target with about 10 % noise
LINE_COLUMNS = {
    "l_orderkey": "l_orderkey",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "l_linenumber": "l_linenumber",
    "qty": "case when (l_orderkey + l_partkey) % 17 = 0 then null else l_quantity end",
    "price": "l_extendedprice",
    "disc": "l_discount",
    "tax": "l_tax",
    "flag": "case when (l_orderkey + l_suppkey) % 13 = 0 then null else l_returnflag end",
    "status": "l_linestatus",
    "cls": "case when (l_extendedprice * (1 - l_discount) > 50000) <> ((l_orderkey + l_linenumber) % 10 = 0) "
           "then 'yes' else 'no' end",
}
SCORED_COLUMNS = {
    "y_true": "case when l_returnflag = 'R' then 1 else 0 end",
    "score": "round(l_discount * 10 + l_tax, 2)",
    "y_pred": "case when round(l_discount * 10 + l_tax, 2) > 0.5 then 1 else 0 end",
}
MULTI_WEIGHTS = ("1 + l_linenumber % 3", "1 + l_partkey % 5", "1 + l_suppkey % 4")
MULTI_LABEL = "case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end"
REGRESSION_COLUMNS = {
    "y_true": "p_retailprice",
    "y_pred": "cast(900 + p_partkey % 100 as double)",
}
PART_CLUSTERS = (2, 3, 4, 5)


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} as {name}" for name, text in columns.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{t} as {n}" for n, t in LINE_COLUMNS.items()])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{t} as {n}" for n, t in SCORED_COLUMNS.items()])


def multi_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = " + ".join(f"({w})" for w in MULTI_WEIGHTS)
    parts = ", ".join(f"cast({w} as double) / ({total})" for w in MULTI_WEIGHTS)
    return table(spark, sf_dir, "lineitem").selectExpr(f"{MULTI_LABEL} as y_true", f"array({parts}) as p")


def regression_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{t} as {n}" for n, t in REGRESSION_COLUMNS.items()])


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers with a fixed assignment to three clusters."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity as qty", "l_extendedprice as price", "l_discount as disc", "l_tax as tax",
        "cast(l_linenumber % 3 as int) as cluster")


def part_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two part features on similar scales with one fixed assignment per k."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_size as double) as f0", "p_retailprice / 50 as f1",
        *[f"cast(p_size % {k} as int) as c{k}" for k in PART_CLUSTERS])


LINE_SPEC = Spec(
    target="cls", task="classification", numeric=("qty", "price", "disc", "tax"), categorical=("flag", "status"),
    key=LINE_KEY, stratify=True,
    # both search stages of the jobs run, over few and small forests: see the README; the query random_search has SEARCH_SPEC
    forest_params={"n_estimators": 10, "max_depth": 5}, search_iterations=2,
    search_space={"max_features": ["sqrt", 0.5], "min_samples_leaf": [1, 4]}, parallelism=8,
)
# the whole random search: every default of a spec, as the README says what it takes
SEARCH_SPEC = LINE_SPEC.but(forest_params={}, search_iterations=20, search_space=dict(FOREST_SPACE))
PART_SPEC = Spec(
    target="p_retailprice", task="regression", numeric=("p_partkey",), key=("p_partkey",), parallelism=8,
    metrics=("neg_root_mean_squared_error", "r2"),
)
EVENT_SPEC = Spec(
    target="event_type", task="classification", numeric=("value", "user_id"), key=("event_id",), stratify=True,
    parallelism=8, metrics=("roc_auc", "balanced_accuracy"),
)
