"""Connected groups from shared keys, without ever listing all pairs of a group.

Nodes that share a key may be linked; whether they are is up to a `verify` step that gets pairs. In `ROUNDS` rounds every node is held against one leader. A
key's leader is the node that shares most of its keys with others (of a group of near copies, the one that was changed least); ties are
broken anew in each round. What gets linked is one component, and a component's own pairs need no further look. At last all pairs that share a key across
components are verified, so the components are exactly those that all pairs would give.

A key under which more than `CROWD` pairs a node would be left (or `crowd`, where `fits` is cheap and sharp) is split first: its nodes meet only under that key together with another of their `marks`. The caller vouches that
nodes which link and share a key share a mark besides it, so that nothing is lost; nodes that share but the one key are never paired.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import discard, written

ROUNDS, CROWD = 2, 64
Verify = Callable[[DataFrame], DataFrame]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of `edges` (a, b): the smallest node that can be reached. Alternates large and small stars until every component is one star."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        # in a star forest no node has two centres, and no centre has one
        ends = now.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
        if ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down")).where("up + down > 1 and up > 0").isEmpty():
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        after = written(small.where("u <> v").distinct())
        discard(now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _leaders(keyed: DataFrame, fits: Callable[[str, str], Column], extra: list[str], turn: int) -> DataFrame:
    """For each node one pair (a: leader, b: node): the leader, of another component, that it shares most keys with."""
    fields = ["label", "node", *extra]
    rank = F.struct((-F.col("weight")).alias("w"), F.xxhash64("label", F.lit(turn)).alias("h"), *fields)
    lead = keyed.groupBy("key").agg(F.min(rank).alias("x"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key", "x")
    pairs = keyed.join(lead, "key").where("label <> x.label").withColumn("y", F.struct(*fields)).where(fits("x", "y"))
    shared = pairs.groupBy(F.col("node").alias("b"), F.col("x.node").alias("a")).agg(F.count("*").alias("n"))
    return shared.groupBy("b").agg(F.max(F.struct("n", "a")).alias("best")).select("best.a", "b")


def _rest(keyed: DataFrame, fits: Callable[[str, str], Column], extra: list[str], once: Callable[[str, str], Column] | None = None) -> DataFrame:
    """All pairs that share a key across components, once each. Components meet before their nodes do, so that no pair inside one is made."""
    if once is not None:
        together = fits
        fits = lambda x, y: together(x, y) & once(x, y)
    kinds = keyed.groupBy("key", "label").agg(F.count("*").alias("n"))
    x, y = F.struct("node", *extra).alias("x"), F.struct("node", *extra).alias("y")
    rows = keyed.join(kinds, ["key", "label"])
    single, crowd = rows.where("n = 1"), rows.where("n > 1")
    pairs = single.select("key", "label", x).join(single.select("key", F.col("label").alias("label2"), y), "key").where("label < label2").where(fits("x", "y")).select("x", "y")
    pairs = pairs.unionByName(crowd.select("key", x).join(single.select("key", y), "key").where(fits("x", "y")).select("x", "y"))
    across = kinds.where("n > 1").select("key", "label")
    across = across.join(across.withColumnRenamed("label", "label2"), "key").where("label < label2")
    both = across.join(crowd.select("key", "label", x), ["key", "label"]).join(crowd.select("key", F.col("label").alias("label2"), y), ["key", "label2"])
    pairs = pairs.unionByName(both.where(fits("x", "y")).select("x", "y"))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _pairs_left(rows: DataFrame, crowd: int) -> DataFrame:
    """(key, crowded) of keys that more than one label has: whether its pairs across labels are more than `crowd` a node."""
    kinds = rows.groupBy("key", "label").agg(F.count("*").cast("double").alias("n"))
    left = kinds.groupBy("key").agg(F.count("*").alias("labels"), F.sum("n").alias("nodes"), F.sum(F.col("n") * F.col("n")).alias("inside"))
    return left.where("labels > 1").select("key", ((F.col("nodes") * F.col("nodes") - F.col("inside")) / 2 > crowd * F.col("nodes")).alias("crowded"))


def _split(rows: DataFrame, marks: DataFrame, extra: list[str]) -> DataFrame:
    """Rows of crowded keys under each pair of the key and another mark of the node."""
    both = rows.join(marks.select("node", "mark"), "node").where("mark <> key")
    return both.select(F.xxhash64("key", "mark").alias("key"), "node", *extra, "label")


def _hop(edges: DataFrame) -> DataFrame:
    """(node, component) after a round in which every node has one leader at most: the leader's leader, or the leader. Not all of a component need agree."""
    up = edges.select(F.col("b").alias("node"), F.col("a").alias("up"))
    far = edges.select(F.col("b").alias("up"), F.col("a").alias("far"))
    return up.join(far, "up", "left").select("node", F.when(F.col("far") == F.col("node"), F.least("node", "up")).otherwise(F.coalesce("far", "up")).alias("component"))


def linked(keyed: DataFrame, verify: Verify, fits: Callable[[str, str], Column], extra: list[str] | None = None, marks: DataFrame | None = None, crowd: int | None = None,
           once: Callable[[str, str], Column] | None = None) -> DataFrame:
    """(node, component) of the nodes that have a link. `keyed`: (key, node, *extra).

    `verify` turns pairs (a, b) into those that are linked; `fits` may rule out pairs by the `extra` columns of both sides. `marks`: (node, mark), the keys of each
    node and what else may split crowded keys; without it they are paired as they are. `once` may tell whether column `key` is the first that both sides share, so that a
    pair is made under one of its keys only."""
    extra = extra or []
    weight = keyed.groupBy("node").agg(F.count("*").alias("weight"))
    keyed = written(keyed.join(weight, "node"))

    def labelled(groups: DataFrame | None) -> DataFrame:
        if groups is None:
            return keyed.withColumn("label", F.col("node"))
        return keyed.join(groups, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs)
        if pairs.isEmpty():
            return pairs
        new = written(verify(pairs).select("a", "b"))
        discard(pairs)
        return new

    groups, found = None, []
    for turn in range(ROUNDS):
        found.append(verified(_leaders(labelled(groups), fits, extra, turn)))
        groups = _hop(found[0]) if turn == 0 and ROUNDS > 1 else components(reduce(DataFrame.unionByName, found))
    rows = written(labelled(groups).drop("weight"))
    discard(keyed)
    tables = [rows]
    if marks is None:
        pairs = _rest(rows, fits, extra, once)
    else:
        left = written(_pairs_left(rows, CROWD if crowd is None else crowd))
        tables.append(left)
        pairs = _rest(rows.join(left.where("not crowded"), "key", "left_semi"), fits, extra, once)
        crowded = left.where("crowded")
        if not crowded.isEmpty():
            finer = written(_split(rows.join(crowded, "key", "left_semi"), marks, extra))
            tables.append(finer)
            pairs = pairs.unionByName(_rest(finer, fits, extra))
        pairs = pairs.distinct()
    new = verified(pairs)
    for table in tables:
        discard(table)
    if new.isEmpty():
        return groups
    return components(reduce(DataFrame.unionByName, [*found, new]))
