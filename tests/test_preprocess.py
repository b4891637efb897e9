"""Imputation, scaling, encoding and reduction against their definitions."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import preprocess as pp
from millrace.sources.readers import rename_dots
from millrace.spec import Spec

NAN = float("nan")


def matrix(model, df, column="features"):
    rows = model.transform(df).select(vector_to_array(column).alias("x")).collect()
    return np.array([r["x"] for r in rows])


def test_median_fill_and_population_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (3.0,), (10.0,), (NAN,)], "x double")
    model = pp.Preprocessor(numeric=["x"]).fit(df)
    filled = np.array([1, 2, 2.5, 3, 10, 2.5])
    np.testing.assert_allclose(matrix(model, df)[:, 0], (filled - filled.mean()) / filled.std())


@pytest.mark.parametrize("strategy,fill", [("mean", 4.0), ("most_frequent", 1.0), ("constant", 0.0), ("median", 2.0)])
def test_fill_strategies(spark, strategy, fill):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (2.0,), (14.0,), (None,)], "x double")
    assert pp.learn_numeric(df, ["x"], strategy, "none")[0].fill == fill


def test_unknown_options(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="scaling"):
        pp.learn_numeric(df, ["x"], "median", "robust")
    with pytest.raises(ValueError, match="strategy"):
        pp.learn_numeric(df, ["x"], "mode")
    with pytest.raises(ValueError, match="no features"):
        pp.Preprocessor().fit(df)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(5.0, None, 1.0), (5.0, None, 3.0)], "c double, e double, x double")
    standard = pp.Preprocessor(numeric=["c", "e", "x"]).fit(df)
    assert pp.feature_names(standard) == ["c", "x"]
    np.testing.assert_allclose(matrix(standard, df), [[0, -1], [0, 1]])
    minmax = pp.Preprocessor(numeric=["c", "x"], scaling="minmax").fit(df)
    np.testing.assert_allclose(matrix(minmax, df), [[0, 0], [0, 1]])


def test_one_hot_drops_first_and_unseen_is_all_zeros(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), (None,)], "x string")
    model = pp.Preprocessor(categorical=["x"]).fit(train)
    assert pp.feature_names(model) == ["x_b", "x_c"]
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("zzz",), (None,)], "x string")
    np.testing.assert_array_equal(matrix(model, test), [[0, 0], [1, 0], [0, 1], [0, 0], [1, 0]])


def test_most_frequent_category_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "x string")
    assert pp.learn_categories(df, ["x"])["x"] == ("a", ["a", "b"])
    assert pp.learn_categories(df, ["x"], "constant")["x"] == ("missing_value", ["a", "b", "missing_value"])


def test_awkward_names_and_values(spark):
    df = spark.createDataFrame([("it's", 1.0), ("a\\b", 2.0), ("it's", 3.0), (None, 4.0)], "`my col` string, `x.y` double")
    model = pp.Preprocessor(numeric=["x_y"], categorical=["my col"]).fit(rename_dots(df))
    assert pp.feature_names(model) == ["x_y", "my col_it's"]
    assert matrix(model, rename_dots(df))[:, 1].tolist() == [1, 0, 1, 1]


def test_category_limit_is_per_column_whatever_the_folds(spark):
    df = spark.range(20).select((F.col("id") % 5).cast("string").alias("x"), (F.col("id") % 4).cast("string").alias("y"), (F.col("id") % 4).cast("int").alias("fold"))
    spec = Spec(categorical=("x", "y"), max_categories=5)
    pp.preprocessor(spec).fit(df)
    assert len(pp.fit_by_fold(df, spec, range(4))) == 4
    for fit in (lambda s: pp.preprocessor(s).fit(df), lambda s: pp.fit_by_fold(df, s, range(4))):
        with pytest.raises(ValueError, match="more than 4 categories in x"):
            fit(spec.but(max_categories=4))


def test_numeric_categories_sort_as_numbers(spark):
    df = spark.createDataFrame([(2,), (3,), (10,), (10,), (2,), (None,)], "x int")
    assert pp.learn_categories(df, ["x"])["x"] == ("2", ["2", "3", "10"])
    assert pp.learn_categories(df, ["x"], "constant")["x"] == ("missing_value", ["2", "3", "10", "missing_value"])


def test_columns_of_the_input_survive_and_temporaries_do_not(people):
    df = rename_dots(people)
    model = pp.Preprocessor(numeric=["age", "emp_var_rate"], categorical=["job", "month"]).fit(df)
    assert model.transform(df).columns == [*df.columns, "features"]


def test_by_fold_equals_fitting_each_fold(people):
    df = rename_dots(people).withColumn("fold", (F.col("id") % 4).cast("int"))
    for strategy in ("median", "mean"):
        together = pp.learn_numeric_by_fold(df, ["age", "pdays"], strategy, "standard", range(4))
        for f in range(4):
            alone = pp.learn_numeric(df.where(F.col("fold") != f), ["age", "pdays"], strategy)
            for a, b in zip(alone, together[f]):
                np.testing.assert_allclose([a.fill, a.centre, a.scale], [b.fill, b.centre, b.scale], rtol=1e-12)


def random_table(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    z = rng.normal(size=(n, 2))
    x = np.c_[z, z @ rng.normal(size=(2, 2)) + 0.05 * rng.normal(size=(n, 2))]
    columns = ["a", "b", "c", "d"]
    return x, columns, spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in columns))


@pytest.mark.parametrize("scaling", ["standard", "minmax"])
def test_pca_matches_numpy(spark, scaling):
    x, columns, df = random_table(spark)
    model = pp.Preprocessor(numeric=columns, scaling=scaling, reduce=True).fit(df)
    s = (x - x.mean(0)) / x.std(0) if scaling == "standard" else (x - x.min(0)) / (x.max(0) - x.min(0))
    s = s - s.mean(0)
    _, values, vt = np.linalg.svd(s, full_matrices=False)
    ratio = values**2 / (values**2).sum()
    m = int(np.searchsorted(np.cumsum(ratio), 0.95, side="right")) + 1
    got = matrix(model, df)
    assert got.shape[1] == m and pp.feature_names(model) == [f"component_{i}" for i in range(m)]
    np.testing.assert_allclose(np.abs(got), np.abs(s @ vt[:m].T), atol=1e-8)
    info = pp.reduction_info(model, df).orderBy("component").collect()
    np.testing.assert_allclose([r["ratio"] for r in info], ratio[:m], rtol=1e-8)
    np.testing.assert_allclose([r["explained_variance"] for r in info], values[:m] ** 2 / (len(x) - 1), rtol=1e-8)


def test_truncated_svd_matches_numpy_without_centring(spark):
    x, columns, df = random_table(spark)
    df = df.withColumn("g", F.when(F.col("a") > 0.5, "u").when(F.col("b") > 0, "v").otherwise("w"))
    model = pp.Preprocessor(numeric=columns, categorical=["g"], scaling="minmax", reduce=True).fit(df)
    plain = matrix(pp.Preprocessor(numeric=columns, categorical=["g"], scaling="minmax").fit(df), df)
    k = min(50, 4 + 1 - 1)
    _, _, vt = np.linalg.svd(plain, full_matrices=False)
    np.testing.assert_allclose(np.abs(matrix(model, df)), np.abs(plain @ vt[:k].T), atol=1e-8)


def test_no_reduction_has_no_info(people):
    df = rename_dots(people)
    assert pp.reduction_info(pp.Preprocessor(numeric=["age"]).fit(df), df) is None


def test_components_for():
    assert pp.components_for([0.6, 0.3, 0.1], 0.95) == 3
    assert pp.components_for([0.6, 0.36, 0.04], 0.95) == 2
    assert pp.components_for([1.0], 0.95) == 1


def test_saved_model_scores_the_same(people, tmp_path):
    df = rename_dots(people)
    model = pp.Preprocessor(numeric=["age", "pdays"], categorical=["job", "month"], reduce=True).fit(df)
    model.write().save(str(tmp_path / "m"))
    np.testing.assert_array_equal(matrix(PipelineModel.load(str(tmp_path / "m")), df), matrix(model, df))


def test_projection_sign_is_fixed(spark):
    x, columns, df = random_table(spark)
    out = pp.project_2d(df, columns).toPandas()
    s = (x - x.mean(0)) / x.std(0)
    _, _, vt = np.linalg.svd(s, full_matrices=False)
    for j in range(2):
        v = vt[j] * np.sign(vt[j][np.argmax(np.abs(vt[j]))])
        np.testing.assert_allclose(out[f"pc{j + 1}"], s @ v, atol=1e-8)
