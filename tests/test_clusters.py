"""Cluster metrics, choice of k and descriptions; published values as fixed expectations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import clusters, lloyd, silhouette
from millrace.operators.silhouette import check_method, euclidean_silhouettes
from millrace.spec import Spec

# Published k-means quality table (32,950 rows, 10 scaled features).
ROWS, FEATURES = 32_950, 10
K_TABLE = [
    (2, 213563.96312683195, 0.4281013496319182, 17886.259867860415, 1.1841519704548358),
    (3, 172868.52615678828, 0.43859581885453486, 14926.190682135839, 1.0169063603734008),
    (4, 155150.7663759737, 0.4172041295452441, 12340.920566380604, 1.0006709686260018),
    (5, 138635.56489250832, 0.4242845891268457, 11339.133683863482, 1.1052381379237073),
    (6, 126717.69363557022, 0.25444008786440536, 10543.85991233185, 1.3819530911185582),
    (7, 113977.2637769164, 0.26958303060014893, 10382.15505376946, 1.2678600979852679),
    (8, 105711.41757378203, 0.2503694535278741, 9962.496916981298, 1.2784865117836683),
    (9, 99502.30227499106, 0.2669953581942247, 9517.819009687932, 1.2328290177624655),
    (10, 96298.96150540769, 0.2833493960307305, 8863.188331947033, 1.2762902258576794),
]
# Published z-score centroids for k = 3 and the cluster sizes.
NAMES = ["age", "duration", "campaign", "pdays", "previous", "emp.var.rate", "cons.price.idx", "cons.conf.idx",
         "euribor3m", "nr.employed"]
CENTROIDS = [
    [0.0179252694707385, -0.021664128441791435, 0.08284879602424287, 0.19658383874351804, -0.2996973570430281,
     0.6604830192664181, 0.46263585277135477, 0.22591443265963534, 0.6914190979186219, 0.6429301232415126],
    [-0.06250666158042423, 0.01809518637675573, -0.15521304815555828, 0.19658383874349664, 0.2909503182512533,
     -1.3392203932302937, -1.0150323960221541, -0.5828089185408675, -1.392207598744298, -1.2284763637574474],
    [0.16406223531660524, 0.24440305364770903, -0.2718677783743112, -4.997832750349157, 3.06798059216731,
     -1.382632773954906, -0.3753249701308687, 0.4882577570788777, -1.5224464579632115, -1.9249949988377055],
]
SIZES = [22094, 9609, 1247]


@pytest.fixture(scope="module")
def published(spark):
    return spark.createDataFrame(
        K_TABLE, "k int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double").persist()


def test_published_choices(published):
    choices = {m: clusters.best_k(published, m) for m in ("silhouette", "calinski_harabasz", "davies_bouldin", "elbow")}
    assert choices == {"silhouette": 3, "calinski_harabasz": 2, "davies_bouldin": 4, "elbow": 5}
    assert clusters.best_k(published.where("k <= 8"), "elbow") == 3
    with pytest.raises(ValueError, match="unknown"):
        clusters.best_k(published, "gap")


def test_elbow_is_undefined_for_one_k_or_a_flat_curve(spark, published):
    assert clusters.best_k(published.where("k = 2"), "elbow") is None
    flat = spark.createDataFrame([(2, 5.0), (3, 5.0)], "k int, inertia double")
    assert clusters.best_k(flat, "elbow") is None


def test_first_k_wins_ties(spark):
    tied = spark.createDataFrame([(3, 0.5), (2, 0.5), (4, float("nan"))], "k int, silhouette double")
    assert clusters.best_k(tied) == 2


def test_curves_mark_the_optimum(published):
    best = {r["metric"]: r["k"] for r in clusters.k_curves(published).where("is_best").collect()}
    assert best == {"silhouette": 3, "calinski_harabasz": 2, "davies_bouldin": 4}
    assert clusters.k_curves(published).count() == 36


def moment_table(spark, sizes, means, spread):
    """Moments of clusters that share the within-cluster variance evenly."""
    d = len(means[0])
    rows = [(i, n, *map(float, m), *([spread] * d)) for i, (n, m) in enumerate(zip(sizes, means))]
    schema = "cluster int, n bigint, " + ", ".join([f"m{i} double" for i in range(d)] + [f"v{i} double" for i in range(d)])
    return spark.createDataFrame(rows, schema)


def test_published_centroids_reproduce_inertia_and_score(spark):
    between = sum(n * sum(v * v for v in c) for n, c in zip(SIZES, CENTROIDS))
    within = ROWS * FEATURES - between  # population scaling makes the total n * d
    assert within == pytest.approx(K_TABLE[1][1], rel=1e-9)
    stats = moment_table(spark, SIZES, CENTROIDS, within / (ROWS * FEATURES))
    row = clusters.spread_metrics(stats, FEATURES).first()
    assert row["n"] == ROWS and row["inertia"] == pytest.approx(K_TABLE[1][1], rel=1e-9)
    assert row["calinski_harabasz"] == pytest.approx(K_TABLE[1][3], rel=2e-6)


@pytest.mark.parametrize("k,inertia,_s,score,_d", K_TABLE)
def test_published_scores_follow_from_inertia(k, inertia, _s, score, _d):
    total = ROWS * FEATURES
    assert ((total - inertia) / (k - 1)) / (inertia / (ROWS - k)) == pytest.approx(score, rel=2e-6)


def test_published_differences(spark):
    rows = [(i, f, v) for i, c in enumerate(CENTROIDS) for f, v in zip(NAMES, c)]
    got = clusters.cluster_differences(spark.createDataFrame(rows, "cluster int, feature string, z_value double")).collect()
    assert [r["feature"] for r in got] == ["pdays", "previous", "nr.employed", "euribor3m", "emp.var.rate"]
    np.testing.assert_allclose([r["variance_between_clusters"] for r in got], [8.994, 3.234, 1.764, 1.543, 1.363], atol=1e-3)


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == o].mean() for o in set(labels) - {c})
        out.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("block", [4096, 37])
def test_silhouette_with_copies_and_singletons(spark, block):
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(240, 2)), 1)
    x[80:160] = x[0]  # a third of the rows are one point
    three = rng.integers(0, 3, 240)
    lonely = np.zeros(240, dtype=int)
    lonely[5] = 9
    rows = [(float(p[0]), float(p[1]), int(a), int(b), 0) for p, a, b in zip(x, three, lonely)]
    df = spark.createDataFrame(rows, "a double, b double, three int, lonely int, one int")
    got = euclidean_silhouettes(df, ["a", "b"], ["three", "lonely", "one"], points_per_block=block)
    assert got["three"] == pytest.approx(brute_silhouette(x, three), abs=1e-10)
    assert got["lonely"] == pytest.approx(brute_silhouette(x, lonely), abs=1e-10)
    assert got["one"] is None


@pytest.mark.parametrize("rows", [60, 120_000])
def test_one_silhouette_at_every_size(spark, rows):
    """The default statistic does not change with the table."""
    df = spark.range(rows).select(F.col("id").alias("k"), (F.col("id") % 1009 + F.col("id") / rows).alias("x"))
    run = clusters.evaluate_k_range(df, Spec(numeric=("x",), key=("k",), k_range=(2,), n_init=1, max_iter=5))
    assert [r["silhouette_method"] for r in run.table.collect()] == ["squared"]


def test_method_is_explicit():
    assert Spec().silhouette == "squared" and check_method("euclidean") == "euclidean"
    for name in ("auto", "cosine"):
        with pytest.raises(ValueError):
            check_method(name)


def test_davies_bouldin_of_coinciding_means_is_zero(spark):
    df = spark.createDataFrame([(1.0, 0), (3.0, 0), (0.0, 1), (4.0, 1)], "x double, c int")
    row = clusters.davies_bouldin(df, clusters.moments(df, ["x"], "c"), ["x"], "c").first()
    assert row["davies_bouldin"] == 0.0


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(m, 0.3, size=(60, 2)) for m in ((0, 0), (5, 5), (0, 6))])
    rows = [(i, float(a) if i % 23 else None, float(b) * 100, f"t{i % 2}") for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, a double, b double, t string").persist()


@pytest.fixture(scope="module")
def run(blobs):
    spec = Spec(numeric=("a", "b"), k_range=(2, 3, 4), n_init=3, max_iter=50, silhouette="euclidean")
    return clusters.evaluate_k_range(blobs, spec)


def test_three_blobs_are_found(run, blobs):
    assert clusters.best_k(run.table, "silhouette") == 3
    row = run.table.where("k = 3").first()
    assert sum(row["n_samples_per_cluster"].values()) == 180 and list(row["n_samples_per_cluster"]) == [
        "cluster_0", "cluster_1", "cluster_2"]
    assigned = run.assign(blobs, 3)
    assert assigned.columns == [*blobs.columns, "cluster"]
    pdf = run.encoder.transform(assigned).toPandas()
    x = np.stack([v.toArray() for v in pdf["features"]])
    assert row["silhouette"] == pytest.approx(brute_silhouette(x, pdf["cluster"].to_numpy()), abs=1e-9)
    centres = np.array(run.models[3].clusterCenters())
    assert row["inertia"] == pytest.approx(((x - centres[pdf["cluster"]]) ** 2).sum(), rel=1e-9)
    inertias = [r["inertia"] for r in run.table.orderBy("k").collect()]
    assert inertias == sorted(inertias, reverse=True)


def test_centroids_in_both_units(run):
    rows = run.centroids(3).collect()
    for r in rows:
        f = next(f for f in run.fits if f.column == r["feature"])
        assert (r["value"] - f.centre) / f.scale == pytest.approx(r["z_value"])
    with pytest.raises(ValueError, match="not fitted"):
        run.centroids(7)
    with pytest.raises(ValueError, match="not fitted"):
        run.model(7)


def test_profile_skips_nulls_and_singletons_have_no_std(spark):
    df = spark.createDataFrame([(0, 1.0), (0, None), (0, 3.0), (1, 5.0)], "c int, x double")
    rows = {r["cluster"]: r for r in clusters.cluster_profile(df, "c", ["x"]).collect()}
    assert (rows[0]["size"], rows[0]["mean"], rows[0]["std"]) == (3, 2.0, pytest.approx(2**0.5))
    assert rows[1]["std"] is None and rows[1]["percent"] == 25.0


def test_histograms_use_each_clusters_own_range(spark):
    rng = np.random.default_rng(9)
    values = np.r_[rng.normal(0, 1, 100), rng.normal(50, 5, 100)]
    df = spark.createDataFrame([(int(i >= 100), float(v)) for i, v in enumerate(values)], "c int, x double")
    rows = clusters.cluster_feature_histograms(df, "c", ["x"]).orderBy("cluster", "bin").collect()
    for c, part in ((0, values[:100]), (1, values[100:])):
        np.testing.assert_array_equal([r["n"] for r in rows if r["cluster"] == c], np.histogram(part, bins=20)[0])


def test_nearest_centre_and_first_on_ties(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    got = [r["cluster"] for r in clusters.assign_nearest(df, ["x"], [[0.0], [2.0]]).orderBy("x").collect()]
    assert got == [0, 0, 1]


def test_squared_silhouettes_of_all_k_equal_the_evaluator(spark):
    from pyspark.ml.feature import VectorAssembler

    from millrace.operators.silhouette import squared_silhouette

    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), int(abs(a) > 1), i % 3, 9 if i == 7 else 0, 0) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, c2 int, c3 int, c4 int, c5 int")
    table = {r["k"]: r["silhouette"] for r in clusters.k_table(df, ["a", "b"], {2: "c2", 3: "c3", 4: "c4", 5: "c5"}).collect()}
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    for k in (2, 3, 4):
        assert table[k] == pytest.approx(squared_silhouette(ready, "v", f"c{k}"), abs=1e-9)
    assert table[5] is None


# --- all k and starts at once ------------------------------------------------------------------


def cloud(spark, rows=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, 3)) + rng.integers(0, 4, size=(rows, 1))
    return x, spark.createDataFrame([tuple(map(float, p)) for p in x], "a double, b double, c double")


def test_squared_silhouettes_leave_rows_where_they_are(spark):
    """No k gathers its rows in a task, so nothing is shuffled; a row without features counts only as a cluster of its own."""
    from millrace.operators.silhouette import squared_silhouettes

    rows = [(float(i), i % 2, 2 if i == 0 else i % 2) for i in range(60)] + [(None, 1, 1)]
    df = spark.createDataFrame(rows, "x double, a int, b int").repartition(8, "x").persist()
    stats = [{"k": k, **r.asDict()} for k, c in ((2, "a"), (3, "b")) for r in clusters.moments(df, ["x"], c).collect()]
    spark.sparkContext.setJobGroup("silhouettes", "")
    got = squared_silhouettes(df, ["x"], {2: "a", 3: "b"}, stats)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("silhouettes")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds if tracker.getStageInfo(s)) == 8
    x = np.arange(60.0)
    for k, label in ((2, x % 2), (3, np.where(x == 0, 2, x % 2))):
        scores = []
        for v, c in zip(x, label):
            n = {r["cluster"]: r["n"] for r in stats if r["k"] == k}
            far = {r["cluster"]: (v - r["m0"]) ** 2 + r["v0"] for r in stats if r["k"] == k}
            a, b = far[c] * n[c] / max(n[c] - 1, 1), min(d for o, d in far.items() if o != c)
            scores.append(0.0 if n[c] == 1 else (b - a) / max(a, b))
        assert got[k] == pytest.approx(np.mean(scores), abs=1e-12)


def test_nearest_of_each_is_what_the_models_give(spark):
    df = spark.range(500).selectExpr("cast(id % 23 as double) as x", "cast(id % 7 as double) as y")
    fits = {k: lloyd.Centres(("x", "y"), tuple((3.0 * i, 2.0 * (i % 3)) for i in range(k)), 0.0, 0, 0) for k in (2, 5)}
    got = lloyd.nearest_of_each(df, ["x", "y"], {f"c{k}": m.centres for k, m in fits.items()})
    wanted = df
    for k, m in fits.items():
        wanted = m.stage(f"c{k}").transform(wanted)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_ties_between_centres_go_to_the_first(spark):
    packed = lloyd.blocks(spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double"), ["x"])
    sums = lloyd._sums(packed, 1, [np.array([[2.0], [0.0]]), np.array([[1.0], [1.0], [5.0]])], 1, costs=True)
    assert sums[0].tolist() == [[2.0, 1.0, 3.0], [1.0, 0.0, 0.0]]
    assert sums[1].tolist() == [[3.0, 2.0, 3.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]




def test_shared_iterations_equal_sparks_from_equal_starts(spark):
    from pyspark.mllib.clustering import KMeans as OldKMeans
    from pyspark.mllib.clustering import KMeansModel as OldModel

    from millrace.operators import lloyd

    x, df = cloud(spark)
    packed = lloyd.blocks(df.repartition(3), ["a", "b", "c"])
    first = [x[i * 20 : i * 20 + k] for i, k in enumerate((2, 3, 5, 8, 8))]
    points = spark.sparkContext.parallelize(x.tolist(), 3)
    for max_iter in (1, 4, 300):
        for (centres, cost, took), start in zip(lloyd.iterate(packed, 3, first, max_iter, 0.0), first):
            model = OldKMeans.train(points, len(start), maxIterations=max_iter, epsilon=1e-12, initialModel=OldModel([list(c) for c in start]))
            np.testing.assert_allclose(centres, np.array([np.array(c) for c in model.clusterCenters]), atol=1e-9)
            assert cost == pytest.approx(((x[:, None] - centres) ** 2).sum(2).min(1).sum())
            assert took <= max_iter


def test_starts_do_not_depend_on_partitions(spark, monkeypatch):
    from millrace.operators import lloyd

    x, df = cloud(spark)
    one = lloyd.starts(lloyd.blocks(df.repartition(1), ["a", "b", "c"]), 3, 4, 6, 42)
    monkeypatch.setattr(lloyd, "BLOCK", 17)
    two = lloyd.starts(lloyd.blocks(df.union(df).repartition(5), ["a", "b", "c"]), 3, 4, 6, 42)
    assert [c.tolist() for c in one] == [c.tolist() for c in two]
    assert all(len(np.unique(c, axis=0)) == 6 for c in one) and len({c.tobytes() for c in one}) == 4
    known = {tuple(p) for p in x.tolist()}
    assert all(tuple(p) in known for c in one for p in c.tolist())


def test_far_points_are_drawn_more_often(spark):
    """The second centre falls on a point with a chance in proportion to its squared distance."""
    from millrace.operators import lloyd

    df = spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "a double")
    drawn = [tuple(c[:2, 0]) for c in lloyd.starts(lloyd.blocks(df, ["a"]), 1, 600, 2, 1)]
    after_zero = [b for a, b in drawn if a == 0.0]
    assert 150 < len(after_zero) < 250
    assert 0.82 < sum(b == 3.0 for b in after_zero) / len(after_zero) < 0.97  # 9 of 10


@pytest.mark.parametrize("direct", [0, 64])
def test_range_of_k_with_few_points(spark, monkeypatch, direct):
    from millrace.functions import partials
    from millrace.operators import lloyd

    monkeypatch.setattr(partials, "DIRECT", direct)
    df = spark.createDataFrame([(0.0,), (0.0,), (5.0,), (9.0,)] * 5, "a double").repartition(4)
    found = lloyd.fit_range(df, ["a"], (2, 3, 4), n_init=5)
    assert sorted(c[0] for c in found[2].centres) == [0.0, 7.0] and found[2].cost == pytest.approx(40.0)
    assert sorted(c[0] for c in found[3].centres) == sorted(c[0] for c in found[4].centres) == [0.0, 5.0, 9.0]
    with pytest.raises(ValueError, match="rows"):
        lloyd.fit_range(df.limit(0), ["a"], (2,))


def test_rows_are_dealt_by_content_and_copy(spark):
    from millrace.functions.columns import fit_partitions, spread

    df = spark.range(30_000).select(F.when(F.col("id") < 10_000, 7).otherwise(F.col("id")).alias("x"), F.lit("t").alias("t"))
    dealt = spread(df)
    assert dealt.rdd.getNumPartitions() == fit_partitions(30_000) == 11
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / 11 + 2_000
    assert dealt.exceptAll(df).count() == df.exceptAll(dealt).count() == 0
    parts = lambda d: sorted(map(tuple, d.rdd.glom().map(lambda rows: [r["x"] for r in rows]).collect()))
    assert parts(spread(df.repartition(7))) == parts(dealt)


@pytest.mark.parametrize("away", [0.0, 1e3, 1e8])
def test_distances_by_products_keep_their_digits(monkeypatch, away):
    """Equal, nearly equal and far points, near the origin or not; only few pairs are done by differences."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6)) + away
    y = np.vstack([x[:20], x[20:40] + 1e-7, x[40:60] * (1 + 1e-12), rng.normal(size=(150, 6)) + away])
    exact = np.array([[math.dist(p, q) for q in y] for p in x])
    monkeypatch.setattr(silhouette, "_by_differences", lambda a, b: pytest.fail("all pairs by differences"))
    got = silhouette.distances(x, y)
    assert got == pytest.approx(exact, rel=1e-9, abs=0)
    assert silhouette.distances(x[:0], y).shape == (0, len(y))
