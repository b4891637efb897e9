"""A least size of nodes that are split, which Spark's trees don't know, by cutting grown trees back.

Whether and where a node is split does not depend on what happens above or below it. So a tree whose nodes need ``min_samples_split`` rows to be split is the tree that is grown without that rule,
cut off at every node with fewer rows. Counts fall from the root down: a node goes if its parent has too few rows, and is a leaf if it has too few itself. The
nodes are those of the model's own table, which is saved, rewritten by joins and loaded again.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.sinks import remove_path, scratch_path

NODE = "id prediction impurity impurityStats rawCount gain leftChild rightChild split".split()


def cut_back(nodes: DataFrame, least: int) -> DataFrame:
    """Nodes of trees (treeID and the columns of a node), numbered from 0 in the same order, without what lies below nodes of fewer than ``least`` rows."""
    small = F.col("rawCount") < least
    inner = nodes.where("leftChild >= 0").select("treeID", F.explode(F.array("leftChild", "rightChild")).alias("id"), small.alias("parent_small"))
    kept = nodes.join(inner, ["treeID", "id"], "left").where("parent_small is null or not parent_small").drop("parent_small")
    # a tree's nodes, as the loaded model holds them in memory too
    numbered = kept.withColumn("new", (F.row_number().over(Window.partitionBy("treeID").orderBy("id")) - 1).cast("int"))
    names = numbered.select("treeID", F.col("id").alias("child"), F.col("new").alias("child_new"))
    for side in ("leftChild", "rightChild"):
        of_side = names.withColumnRenamed("child", side).withColumnRenamed("child_new", f"{side}_new")
        numbered = numbered.join(of_side, ["treeID", side], "left")
    leaf = small | (F.col("leftChild") < 0)

    def unless_leaf(value: Column, otherwise: Column) -> Column:
        return F.when(leaf, otherwise).otherwise(value)

    none = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    return numbered.select(
        "treeID", F.col("new").alias("id"), "prediction", "impurity", "impurityStats", "rawCount", unless_leaf(F.col("gain"), F.lit(-1.0)).alias("gain"),
        *[unless_leaf(F.col(f"{side}_new"), F.lit(-1)).alias(side) for side in ("leftChild", "rightChild")], unless_leaf(F.col("split"), none).alias("split"),
    )


def require_split_size(model: Model, least: int, leaf: int, spark) -> Model:
    """The model with every node of fewer than ``least`` training rows made a leaf; ``leaf``: the rows that its leaves have at least."""
    if least <= 2 * leaf:  # every node that is split has as many
        return model
    old, new = scratch_path(spark, "trees"), scratch_path(spark, "trees")
    model.save(old)
    saved = spark.read.parquet(f"{old}/data")
    forest = "treeID" in saved.columns
    nodes = saved.select("treeID", "nodeData.*") if forest else saved.withColumn("treeID", F.lit(0))
    cut = cut_back(nodes, least)
    cut = cut.select("treeID", F.struct(*NODE).alias("nodeData")) if forest else cut.select(*NODE)
    cut.write.parquet(f"{new}/data")
    spark.read.text(f"{old}/metadata").coalesce(1).write.text(f"{new}/metadata")
    if forest:
        spark.read.parquet(f"{old}/treesMetadata").write.parquet(f"{new}/treesMetadata")
    out = type(model).load(new)
    for path in (old, new):
        remove_path(spark, path)
    return out
