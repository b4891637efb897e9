"""Exact sizes, class balance and tie handling of splits and folds."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import ordering, splits
from millrace.spec import Spec


def counts(df, *columns):
    return {tuple(r[c] for c in columns): r["count"] for r in df.groupBy(*columns).count().collect()}


@given(st.integers(1, 500), st.floats(0.05, 0.9))
def test_train_rows_is_the_complement_of_the_ceiling(n, size):
    assert splits.train_rows(n, size) == n - math.ceil(round(size * n, 9))


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 300), min_size=1, max_size=6),
       st.integers(2, 7))
def test_dealt_sizes_match_round_robin(sizes, folds):
    labels = [g for g in sorted(sizes) for _ in range(sizes[g])]
    dealt = Counter((g, i % folds) for i, g in enumerate(labels))
    got = splits.dealt_sizes(sizes, folds)
    assert all(got[g][f] == dealt[(g, f)] for g in sizes for f in range(folds))


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 300), min_size=1, max_size=6),
       st.floats(0, 1))
def test_quotas_add_up_and_stay_within_one(sizes, share):
    total = int(sum(sizes.values()) * share)
    quotas = splits.class_quotas(sizes, total)
    assert sum(quotas.values()) == total
    assert all(abs(q - total * sizes[g] / sum(sizes.values())) < 1 + 1e-6 for g, q in quotas.items())


def test_split_is_a_partition_and_ignores_layout(spark):
    df = spark.range(1237).withColumn("v", F.col("id") % 7)
    one = splits.train_test_split(df, ["id"])
    two = splits.train_test_split(df.repartition(13, "v"), ["id"])
    assert counts(one, "split") == {("train",): 1237 - 248, ("test",): 248}
    assert one.exceptAll(two).count() == 0
    assert one.select("id").distinct().count() == 1237


def test_seed_changes_the_split(spark):
    df = spark.range(500)
    a = splits.train_test_split(df, ["id"], seed=1).where("split = 'test'").select("id")
    b = splits.train_test_split(df, ["id"], seed=2).where("split = 'test'").select("id")
    assert a.exceptAll(b).count() > 0


def test_stratified_split_and_folds_are_balanced(spark):
    df = spark.range(1003).withColumn("c", F.when(F.col("id") % 10 == 0, "rare").otherwise("common"))
    split = counts(splits.train_test_split(df, ["id"], stratify="c"), "c", "split")
    assert split[("rare", "test")] in (20, 21) and split[("rare", "train")] in (80, 81)
    folds = counts(splits.stratified_kfold(df, "c", ["id"]), "c", "fold")
    for c in ("rare", "common"):
        sizes = [folds[(c, f)] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_kfold_sizes(spark):
    folds = counts(splits.kfold(spark.range(1003), ["id"]), "fold")
    assert [folds[(f,)] for f in range(5)] == [201, 201, 201, 200, 200]


def test_ordered_split_keeps_the_head(spark):
    df = spark.range(101).select((F.lit(1000) - F.col("id") * 3).alias("t"))
    out = splits.train_test_split(df, ["t"], order_by=["t"])
    assert out.where("split = 'train'").agg(F.max("t")).first()[0] < out.where("split = 'test'").agg(F.min("t")).first()[0]
    assert counts(out, "split")[("test",)] == 21


def test_ordered_split_breaks_ties_and_puts_nulls_last(spark):
    df = spark.range(100).select("id", F.when(F.col("id") >= 95, None).otherwise(F.lit(5)).alias("t"))
    out = splits.train_test_split(df, ["id"], order_by=["t"])
    assert counts(out, "split") == {("train",): 80, ("test",): 20}
    assert out.where("t is null and split = 'train'").count() == 0


@pytest.mark.parametrize("rows", [1000, 30_000])
def test_equal_rows_are_split_by_count(spark, rows):
    """A third of the rows are one and the same row; sizes stay exact and no row is lost."""
    df = spark.range(rows).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v"))
    out = splits.train_test_split(df)
    assert counts(out, "split")[("test",)] == rows // 5
    assert out.drop("split").exceptAll(df).count() == 0 and out.count() == rows
    folds = counts(splits.kfold(df), "fold")
    assert set(folds.values()) == {rows // 5}


def test_only_equal_rows(spark):
    df = spark.range(1000).select(F.lit("x").alias("v"))
    assert counts(splits.train_test_split(df), "split") == {("train",): 800, ("test",): 200}
    assert set(counts(splits.kfold(df), "fold").values()) == {200}


def test_equal_rows_inside_classes(spark):
    df = spark.range(900).select(F.lit("x").alias("v"), (F.col("id") % 3).cast("string").alias("c"))
    out = counts(splits.train_test_split(df, stratify="c"), "c", "split")
    assert sum(n for (c, s), n in out.items() if s == "test") == 180
    assert all(out[(c, "test")] == 60 for c in "012")


def test_duplicate_keys_are_told_apart_by_the_row(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = splits.train_test_split(df, ["k"])
    assert counts(out, "split") == {("train",): 4000, ("test",): 1000}
    again = splits.train_test_split(df.repartition(7), ["k"])
    assert out.exceptAll(again).count() == 0


def test_cuts_descend_when_few_rows_are_listed(spark, monkeypatch):
    monkeypatch.setattr(ordering, "FINISH_BELOW", 1)
    df = spark.range(3000)
    assert counts(splits.kfold(df, ["id"]), "fold") == {(f,): 600 for f in range(5)}


def test_many_classes_use_the_joined_cut_table(spark):
    df = spark.range(3000).withColumn("c", (F.col("id") % 300).cast("string"))
    folds = counts(splits.stratified_kfold(df, "c", ["id"]), "c", "fold")
    assert set(folds.values()) == {2}


def test_empty_table(spark):
    df = spark.range(0)
    assert splits.train_test_split(df, ["id"]).count() == 0
    assert splits.kfold(df, ["id"]).count() == 0


def test_label_codes_and_unseen_class(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "y string")
    classes = splits.class_codes(train, "y")
    assert classes == ["a", "b", "c"]
    assert [r["label"] for r in splits.encode_label(train, "y", classes).collect()] == [1.0, 0.0, 2.0, 0.0]
    with pytest.raises(Exception, match="unseen or null class"):
        splits.encode_label(spark.createDataFrame([("z",)], "y string"), "y", classes).collect()


def test_target_must_exist(spark):
    with pytest.raises(ValueError, match="not found"):
        splits.project_xy(spark.range(3), "y")
    with pytest.raises(ValueError, match="not found"):
        splits.with_label(spark.range(3), Spec(target="y"), None)


def test_balanced_weights_average_to_one(spark):
    df = spark.createDataFrame([(0.0,)] * 30 + [(1.0,)] * 10, "label double")
    rows = {r["label"]: (r["n"], r["weight"]) for r in splits.class_weights(df, "label").collect()}
    assert rows == {0.0: (30, 40 / 60), 1.0: (10, 2.0)}
    assert splits.balanced_weights({0: 30, 1: 10}) == {0: 40 / 60, 1: 2.0}


@settings(deadline=None, max_examples=5)
@given(st.integers(2, 60), st.integers(2, 5))
def test_small_tables_keep_exact_fold_sizes(spark, n, folds):
    got = counts(splits.kfold(spark.range(n), ["id"], folds), "fold")
    assert [got.get((f,), 0) for f in range(folds)] == splits.fold_sizes(n, folds)


def test_numeric_classes_are_coded(spark):
    spec = Spec(target="y")
    df = spark.createDataFrame([(1,), (2,), (1,)], "y int")
    classes = splits.class_codes(df, "y")
    assert classes == [1, 2]
    assert [r["label"] for r in splits.with_label(df, spec, classes).collect()] == [0.0, 1.0, 0.0]
    ready = spark.createDataFrame([(0,), (1,)], "y int")
    assert [r["label"] for r in splits.with_label(ready, spec, [0, 1]).collect()] == [0.0, 1.0]
    for odd in (7, None):  # classes 0..C-1 are checked like any others
        with pytest.raises(Exception, match="unseen or null class"):
            splits.with_label(spark.createDataFrame([(0,), (odd,)], "y int"), spec, [0, 1]).collect()


def test_many_classes_are_coded_by_a_join(spark):
    df = spark.range(200).select((F.col("id") * 3).alias("y"))
    classes = splits.class_codes(df, "y")
    got = splits.encode_label(df, "y", classes)
    assert got.columns == ["y", "label"] and got.where("label <> y / 3").count() == 0 and got.count() == 200
    with pytest.raises(Exception, match="unseen or null class"):
        splits.encode_label(spark.createDataFrame([(1,)], "y bigint"), "y", classes).collect()


@pytest.mark.parametrize("n", [3, 64, 65, 12_000])
def test_codes_do_not_depend_on_the_number_of_classes(spark, n):
    df = spark.range(n).select((F.col("id") * 1e-6).alias("y"))
    classes = splits.class_codes(df, "y")
    got = splits.encode_label(df, "y", classes)
    assert len(classes) == n and got.agg(F.countDistinct("label"), F.max("label")).first()[:] == (n, n - 1.0)


@pytest.mark.parametrize("n, target", [(0, "y bigint"), (3, "y string"), (200_000, "y bigint")])
def test_classes_are_numbered_in_spark(spark, monkeypatch, n, target):
    """The same codes as from the sorted list, without a list; nulls have none."""
    kind = target.split()[1]
    df = spark.range(n).union(spark.range(n // 2)).select((F.col("id") * 7919 % 1_000_003 - 500_000).cast(kind).alias("y"))
    codes = splits.code_table(df.union(spark.createDataFrame([(None,)], target)), "y")
    got = splits.encode_label(df, "y", codes)
    assert got.count() == n + n // 2 and codes.count() == n
    values = [r["y"] for r in df.distinct().collect()]
    expected = {v: float(i) for i, v in enumerate(sorted(values))}
    assert {r["y"]: r["label"] for r in got.distinct().collect()} == expected
    if n:
        with pytest.raises(Exception, match="unseen or null class"):
            splits.encode_label(spark.createDataFrame([(None,)], target), "y", codes).collect()


def test_rows_that_spell_alike_keep_exact_sizes(spark):
    """Null beside empty text, and separators inside cells, without a key."""
    halves = spark.createDataFrame([(None,)] * 500 + [("",)] * 500, "x string")
    assert counts(splits.train_test_split(halves), "split") == {("train",): 800, ("test",): 200}
    bars = spark.createDataFrame([("x|y", "z")] * 500 + [("x", "y|z")] * 500, "a string, b string")
    assert counts(splits.kfold(bars, folds=5), "fold") == {(f,): 200 for f in range(5)}
    assert splits.kfold(bars, folds=5).groupBy("a", "b").count().count() == 2


cells = st.one_of(st.none(), st.sampled_from(["", "-", "1:", "|", "a|b", "a"]))


@settings(deadline=None, max_examples=8, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(cells, cells), min_size=4, max_size=60), st.integers(2, 4))
def test_any_cells_keep_exact_sizes(spark, rows, folds):
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    n = len(rows)
    assert counts(splits.train_test_split(df), "split").get(("train",), 0) == splits.train_rows(n, 0.2)
    assert [counts(splits.kfold(df, folds=folds), "fold").get((f,), 0) for f in range(folds)] == splits.fold_sizes(n, folds)
    by_class = counts(splits.stratified_kfold(df, "a", folds=folds), "fold")
    assert max(by_class.values()) - min(by_class.get((f,), 0) for f in range(folds)) <= 1
    halves = splits.train_test_split(df, stratify="a")
    assert counts(halves, "split").get(("train",), 0) == splits.train_rows(n, 0.2) and halves.count() == n


def test_contiguous_folds(spark):
    got = splits.kfold(spark.range(10), ["id"], 3, order_by=["id"])
    assert [r["fold"] for r in got.orderBy("id").collect()] == [0] * 4 + [1] * 3 + [2] * 3


def test_many_groups_are_cut_like_few(spark, monkeypatch):
    """The same rows in the same parts, whether groups are counted on the driver or in Spark."""
    df = spark.range(2_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 37).cast("string")).alias("g"))
    df = df.unionByName(spark.createDataFrame([(5_000, None), (5_001, None)], "id bigint, g string"))
    make = (lambda: splits.train_test_split(df, ["id"], stratify="g"), lambda: splits.stratified_kfold(df, "g", ["id"], 4))
    few = [sorted(map(str, m().collect())) for m in make]
    monkeypatch.setattr(ordering, "MANY_GROUPS", 1)
    assert [sorted(map(str, m().collect())) for m in make] == few


def test_a_hundred_thousand_classes(spark):
    df = spark.range(250_000).select("id", (F.col("id") % 100_000).alias("g"))
    got = splits.train_test_split(df, ["id"], stratify="g")
    assert got.where("split = 'train'").count() == splits.train_rows(250_000, 0.2)
    folds = splits.stratified_kfold(df, "g", ["id"])
    assert counts(folds, "fold") == {(f,): 50_000 for f in range(5)}


def test_labelled_rows_stay_where_they_are(spark):
    """Two classes leave the rows in as many tasks as before, whether the codes are a list or a table."""
    df = spark.range(800).selectExpr("id", "case when id % 3 = 0 then 'b' else 'a' end as y").repartition(8, "id")
    for classes in (splits.class_codes(df, "y"), splits.code_table(df, "y")):
        got = splits.encode_label(df, "y", classes).withColumn("task", F.spark_partition_id())
        assert got.select("task").distinct().count() == 8
        assert {(r["y"], r["label"]) for r in got.select("y", "label").distinct().collect()} == {("a", 0.0), ("b", 1.0)}


def test_more_classes_than_are_sent(spark, monkeypatch):
    monkeypatch.setattr(splits, "SENT_CLASSES", 2)
    df = spark.range(30).selectExpr("id % 3 as y")
    for classes in (splits.class_codes(df, "y"), splits.code_table(df, "y")):
        got = splits.encode_label(df, "y", classes)
        assert sorted((r["y"], r["label"]) for r in got.distinct().collect()) == [(0, 0.0), (1, 1.0), (2, 2.0)]
