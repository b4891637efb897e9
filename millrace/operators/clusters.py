"""K-means over a range of k, cluster quality metrics, choice of k and cluster descriptions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col, fit_partitions, quoted, settled, spread
from millrace.operators.curves import bin_of
from millrace.operators.lloyd import Centres, fit_range, nearest_of_each
from millrace.operators.preprocess import NumericFit, encoder_stages, learn_numeric
from millrace.operators.silhouette import check_method, euclidean_silhouettes, squared_silhouettes
from millrace.spec import Spec

SELECTIONS = {"silhouette": "max", "calinski_harabasz": "max", "davies_bouldin": "min"}
ROUNDS_SHARE = 4  # k-means goes over the rows hundreds of times, and a pass over small partitions is mostly the start of its tasks: a fourth of the partitions of other fits
K_METRICS = ("inertia", "silhouette", "calinski_harabasz", "davies_bouldin")


# --- quality of an assignment --------------------------------------------------------------


def moments(df: DataFrame, features: Sequence[str], cluster: str, parts: Sequence[str] = ()) -> DataFrame:
    """(parts, cluster, n, m0.., v0..): size, means and population variances per cluster, one pass."""
    xs = [col(f).cast("double") for f in features]
    return df.groupBy(*parts, col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
        *[F.var_pop(x).alias(f"v{i}") for i, x in enumerate(xs)],
    )


def _total(terms: Sequence[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def spread_metrics(stats: DataFrame, d: int, parts: Sequence[str] = ()) -> DataFrame:
    """(parts, n_clusters, n, inertia, calinski_harabasz) from the moment table."""
    whole = Window.partitionBy(*parts)  # one row per cluster
    n = F.sum("n").over(whole)
    centred = stats.select(
        *parts, "n",
        (F.col("n") * _total([F.col(f"v{i}") for i in range(d)])).alias("within"),
        (F.col("n") * _total([
            F.pow(F.col(f"m{i}") - F.sum(F.col(f"m{i}") * F.col("n")).over(whole) / n, 2) for i in range(d)
        ])).alias("between"),
    )
    k, rows = F.count(F.lit(1)), F.sum("n")
    within, between = F.sum("within"), F.sum("between")
    score = F.when(within == 0, 1.0).otherwise((between / (k - 1)) / (within / (rows - k)))
    return centred.groupBy(*parts).agg(
        k.alias("n_clusters"), rows.alias("n"), within.alias("inertia"),
        F.when((k > 1) & (rows > k), score).alias("calinski_harabasz"),
    )


def davies_bouldin(
    df: DataFrame, stats: DataFrame, features: Sequence[str], cluster: str, parts: Sequence[str] = ()
) -> DataFrame:
    """(parts, davies_bouldin): mean over clusters of the worst (s_i + s_j) / d_ij."""
    d = len(features)
    rows = df.select(*parts, col(cluster).alias("cluster"),
                     *[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    stats = settled(stats)  # one row per cluster
    gap = F.sqrt(_total([F.pow(F.col(f"x{i}") - F.col(f"m{i}"), 2) for i in range(d)]))
    scatter = rows.join(stats, [*parts, "cluster"]).groupBy(*parts, "cluster").agg(
        F.avg(gap).alias("s"), F.array(*[F.first(f"m{i}") for i in range(d)]).alias("mean")
    )
    # every cluster of a part beside the list of them all: k entries, no join
    every = scatter.groupBy(*parts).agg(F.collect_list(F.struct("cluster", "s", "mean")).alias("all"))
    one = every.select(*parts, "all", F.explode("all").alias("c"))

    def ratio(o: Column) -> Column:
        squares = F.zip_with(F.col("c")["mean"], o["mean"], lambda a, b: (a - b) * (a - b))
        apart = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
        return F.when((o["cluster"] != F.col("c")["cluster"]) & (apart > 0), (F.col("c")["s"] + o["s"]) / apart).otherwise(0.0)

    worst = one.select(*parts, F.array_max(F.transform("all", ratio)).alias("worst"), F.size("all").alias("_n"))
    return worst.groupBy(*parts).agg(F.avg(F.when(F.col("_n") > 1, F.col("worst"))).alias("davies_bouldin"))


def size_map(cluster: Column, n: Column) -> Column:
    """Aggregate (cluster, n) rows into a map cluster_<i> -> n, in cluster order."""
    name = F.concat(F.lit("cluster_"), cluster.cast("string"))
    entries = F.array_sort(F.collect_list(F.struct(cluster.alias("c"), name.alias("key"), n.alias("value"))))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))


def ordered_map(name: str) -> Column:
    """The size map with its entries back in cluster order."""
    entries = F.transform(F.map_entries(name), lambda e: F.struct(F.length(e["key"]), e["key"], e["value"]))
    return F.map_from_entries(F.transform(F.array_sort(entries), lambda e: F.struct(e["key"], e["value"])))


def k_table(
    df: DataFrame, features: Sequence[str], assignments: dict[int, str], silhouette: str = "squared",
    centres: dict[int, list] | None = None,
) -> DataFrame:
    """One row per k: inertia, silhouette, Calinski-Harabasz, Davies-Bouldin and sizes.

    All assignments are scored together: one pass for the moments, one for
    the distances to the cluster means, whatever the number of assignments.
    """
    spark = df.sparkSession
    long = df.select(
        *[col(f) for f in features],
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), col(c).cast("int").alias("cluster")) for k, c in assignments.items()
        ])).alias("_assigned"),
    ).select(*[quoted(f) for f in features], "_assigned.k", "_assigned.cluster")
    d = len(features)
    computed = moments(long, features, "cluster", ["k"]).collect()  # sum of k rows
    schema = "k int, cluster int, n bigint, " + ", ".join(
        [f"m{i} double" for i in range(d)] + [f"v{i} double" for i in range(d)])
    stats = spark.createDataFrame([tuple(r) for r in computed], schema)
    base = spread_metrics(stats, d, ["k"])
    if centres is not None:
        # inertia is measured from the fitted centres, not from the cluster means
        shift: dict[int, float] = dict.fromkeys(assignments, 0.0)
        for r in computed:
            centre = centres[r["k"]][r["cluster"]]
            shift[r["k"]] += r["n"] * sum((r[f"m{i}"] - float(centre[i])) ** 2 for i in range(d))
        extra = spark.createDataFrame(list(shift.items()), "k int, shift double")
        base = base.join(extra, "k").withColumn("inertia", F.col("inertia") + F.col("shift")).drop("shift")
    apart = davies_bouldin(long, stats, features, "cluster", ["k"])
    sizes = stats.groupBy("k").agg(size_map(F.col("cluster"), F.col("n")).alias("n_samples_per_cluster"))
    if silhouette == "euclidean":
        by_column = euclidean_silhouettes(df, features, list(assignments.values()))
        scores = [(k, by_column[c]) for k, c in assignments.items()]
    else:
        by_k = squared_silhouettes(df, features, assignments, computed)
        scores = [(k, by_k.get(k)) for k in assignments]
    shape = spark.createDataFrame([(k, s, silhouette) for k, s in scores],
                                  "k int, silhouette double, silhouette_method string")
    return base.join(shape, "k").join(apart, "k", "left").join(sizes, "k").select(
        "k", "inertia", "silhouette", "calinski_harabasz", "davies_bouldin", "n_samples_per_cluster", "silhouette_method"
    )


# --- choice of k -----------------------------------------------------------------------------


def elbow_table(table: DataFrame) -> DataFrame:
    """(k, distance): distance of each point of the normalised inertia curve to its chord."""
    every = Window.partitionBy()  # one row per k

    def unit(c: str) -> Column:
        low, high = F.min(c).over(every), F.max(c).over(every)
        return F.try_divide(F.col(c).cast("double") - low, (high - low).cast("double"))

    points = table.select("k", unit("k").alias("x"), unit("inertia").alias("y"))
    ends = points.select(
        "k", "x", "y",
        F.min_by("x", "k").over(every).alias("x1"), F.min_by("y", "k").over(every).alias("y1"),
        F.max_by("x", "k").over(every).alias("x2"), F.max_by("y", "k").over(every).alias("y2"),
    )
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    cross = dx * (F.col("y1") - F.col("y")) - dy * (F.col("x1") - F.col("x"))
    return ends.select("k", (F.abs(cross) / F.sqrt(dx * dx + dy * dy)).alias("distance"))


def select_best_k(table: DataFrame, method: str = "silhouette") -> DataFrame:
    """(method, best_k): one row; the smaller k on ties."""
    if method == "elbow":
        ranked = elbow_table(table).where(F.col("distance").isNotNull()).orderBy(F.desc("distance"), "k")
    elif method in SELECTIONS:
        usable = table.where(F.col(method).isNotNull() & ~F.isnan(method))
        order = F.desc(method) if SELECTIONS[method] == "max" else F.asc(method)
        ranked = usable.orderBy(order, "k")
    else:
        raise ValueError(f"unknown selection method: {method}")
    return ranked.limit(1).select(F.lit(method).alias("method"), F.col("k").alias("best_k"))


def best_k(table: DataFrame, method: str = "silhouette") -> int | None:
    row = select_best_k(table, method).first()
    return None if row is None else row["best_k"]


def k_curves(table: DataFrame) -> DataFrame:
    """(metric, k, value, is_best): the k table unpivoted, with the optimum of each metric marked."""
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in K_METRICS]
    long = table.select("k", F.explode(F.array(*entries)).alias("e")).select("e.metric", "k", "e.value")
    per_metric = Window.partitionBy("metric")
    highest = F.max_by("k", F.struct("value", -F.col("k"))).over(per_metric)
    lowest = F.min_by("k", F.struct("value", F.col("k"))).over(per_metric)
    optimum = F.when(F.col("metric").isin("silhouette", "calinski_harabasz"), highest).when(
        F.col("metric") == "davies_bouldin", lowest
    )
    return long.withColumn("is_best", F.coalesce(F.col("k") == optimum, F.lit(False)))


# --- description -----------------------------------------------------------------------------


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    """(cluster, n, percent)."""
    counts = df.groupBy(col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.col("n") * 100 / counts.agg(F.sum("n")).scalar())


def cluster_profile(df: DataFrame, cluster: str, numeric: Sequence[str]) -> DataFrame:
    """(cluster, size, percent, feature, mean, std, min, max) in the units of the input, nulls skipped."""
    xs = [col(c).cast("double") for c in numeric]
    wide = df.groupBy(col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"),
        *[F.avg(x).alias(f"mean{i}") for i, x in enumerate(xs)],
        *[F.stddev_samp(x).alias(f"std{i}") for i, x in enumerate(xs)],
        *[F.min(x).alias(f"min{i}") for i, x in enumerate(xs)],
        *[F.max(x).alias(f"max{i}") for i, x in enumerate(xs)],
    )
    shares = wide.withColumn("percent", F.col("size") * 100 / df.agg(F.count(F.lit(1))).scalar())
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(f"mean{i}").alias("mean"), F.col(f"std{i}").alias("std"),
                 F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
        for i, c in enumerate(numeric)
    ]
    return shares.select("cluster", "size", "percent", F.explode(F.array(*entries)).alias("e")).select(
        "cluster", "size", "percent", "e.*"
    )


def cluster_differences(centroids: DataFrame, top: int = 5) -> DataFrame:
    """Features by sample variance of their z-score centroids, with the mean centroid value."""
    per_feature = centroids.groupBy("feature").agg(
        F.var_samp("z_value").alias("variance_between_clusters"), F.avg("z_value").alias("mean_centroid_value")
    )
    return per_feature.orderBy(F.desc("variance_between_clusters"), "feature").limit(top)


def cluster_feature_histograms(
    df: DataFrame, cluster: str, numeric: Sequence[str], top: int = 6, bins: int = 20, among: int = 20
) -> DataFrame:
    """(feature, cluster, bin, low, high, n): bins over each cluster's own range.

    The features are the ``top`` of the first ``among`` by variance of the cluster means.
    """
    numeric = list(numeric)[:among]
    xs = [col(c).cast("double") for c in numeric]
    ranges = df.groupBy(col(cluster).alias("cluster")).agg(
        *[F.avg(x).alias(f"mean{i}") for i, x in enumerate(xs)],
        *[F.min(x).alias(f"min{i}") for i, x in enumerate(xs)],
        *[F.max(x).alias(f"max{i}") for i, x in enumerate(xs)],
    )
    ranges = settled(ranges)  # one row per cluster
    between = ranges.agg(*[F.var_samp(f"mean{i}").alias(f"s{i}") for i in range(len(xs))]).first()
    chosen = sorted(range(len(xs)), key=lambda i: (-(between[f"s{i}"] or 0.0), i))[:top]
    binned, edges = [], []
    for i in chosen:
        lo, hi = F.col(f"min{i}"), F.col(f"max{i}")
        index, start, width = bin_of(F.col(f"x{i}"), lo, hi, bins)
        binned.append(F.when(F.col(f"x{i}").isNotNull(), F.struct(F.lit(i).alias("f"), index.alias("bin"))))
        edges.append(F.when(lo.isNotNull(), F.struct(
            F.lit(i).alias("f"), F.lit(numeric[i]).alias("feature"), start.alias("start"), width.alias("width"))))
    rows = df.select(col(cluster).alias("cluster"), *[xs[i].alias(f"x{i}") for i in chosen])
    counts = (
        rows.join(ranges, "cluster")
        .select("cluster", F.explode(F.array_compact(F.array(*binned))).alias("b"))
        .groupBy("cluster", "b.f", "b.bin").agg(F.count(F.lit(1)).alias("n"))
    )
    grid = ranges.select("cluster", F.explode(F.array_compact(F.array(*edges))).alias("e")).select(
        "cluster", "e.*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return grid.join(counts, ["cluster", "f", "bin"], "left").select(
        "feature", "cluster", "bin",
        (F.col("start") + F.col("bin") * F.col("width")).alias("low"),
        (F.col("start") + (F.col("bin") + 1) * F.col("width")).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


# --- k-means ---------------------------------------------------------------------------------


def assign_nearest(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Index of the nearest given centre, the first on ties; plain arithmetic, no join."""
    squares = [
        _total([F.pow(col(f).cast("double") - F.lit(float(v)), 2) for f, v in zip(features, centre)])
        for centre in centres
    ]
    d2 = F.array(*squares)
    return df.withColumn("_d2", d2).withColumn(
        out, (F.array_position("_d2", F.array_min("_d2")) - 1).cast("int")
    ).drop("_d2")


def lloyd_step(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """(cluster, n, m0..): the means after one assignment to the given centres."""
    assigned = assign_nearest(df, features, centres, "_cluster")
    return moments(assigned, features, "_cluster").drop(*[f"v{i}" for i in range(len(features))])


def kmeans_encoder(df: DataFrame, numeric: Sequence[str]) -> tuple[list[NumericFit], PipelineModel]:
    """Median fill and standard scaling of the numeric features, whatever else the spec says."""
    if not numeric:
        raise ValueError("k-means needs numeric features")
    fits = [f for f in learn_numeric(df, numeric, "median", "standard") if not f.empty]
    return fits, PipelineModel(encoder_stages(df, fits, {}, "features"))


@dataclass
class KMeansRange:
    """Fitted models for several k on one table, with their k table."""

    spec: Spec
    fits: list[NumericFit]
    encoder: PipelineModel
    models: dict[int, Centres] = field(default_factory=dict)
    table: DataFrame | None = None

    @property
    def features(self) -> list[str]:
        return [f.column for f in self.fits]

    def model(self, k: int) -> PipelineModel:
        """Encoder and k-means as one model, for scoring and saving."""
        if k not in self.models:
            raise ValueError(f"k={k} was not fitted")
        return PipelineModel([*self.encoder.stages, self.models[k].stage()])

    def assign(self, df: DataFrame, k: int) -> DataFrame:
        """The input columns and ``cluster``."""
        scored = self.model(k).transform(df)
        return scored.select(*[quoted(c) for c in df.columns], "cluster")

    def centroids(self, k: int) -> DataFrame:
        """(k, cluster, feature, z_value, value): scaled and original units side by side."""
        if k not in self.models:
            raise ValueError(f"k={k} was not fitted")
        rows = []
        for i, centre in enumerate(self.models[k].clusterCenters()):
            for f, z in zip(self.fits, centre):
                rows.append((k, i, f.column, float(z), float(z) * f.scale + f.centre))
        spark = self.table.sparkSession
        return spark.createDataFrame(rows, "k int, cluster int, feature string, z_value double, value double")


def evaluate_k_range(df: DataFrame, spec: Spec) -> KMeansRange:
    """Prepare once, fit every k, score all of them together."""
    fits, encoder = kmeans_encoder(df, spec.numeric)
    run = KMeansRange(spec, fits, encoder)
    scaled = [f"_num_{f.column}" for f in fits]
    encoded = encoder.transform(df).select(*[quoted(c) for c in scaled])
    ready = spread(encoded, spec.fit_partitions or max(1, fit_partitions(encoded.count()) // ROUNDS_SHARE)).persist()
    assigned = ready
    try:
        run.models = fit_range(ready, scaled, spec.k_range, spec.n_init, spec.max_iter, spec.seed)
        assigned = nearest_of_each(ready, scaled, {f"c{k}": model.centres for k, model in run.models.items()}).persist()  # three passes read it
        method = check_method(spec.silhouette)
        table = k_table(
            assigned, scaled, {k: f"c{k}" for k in run.models}, method,
            {k: m.clusterCenters() for k, m in run.models.items()},
        )
        # k rows, detached from the cached input
        rows = table.orderBy("k").collect()
        run.table = df.sparkSession.createDataFrame([tuple(r) for r in rows], table.schema).withColumn(
            "n_samples_per_cluster", ordered_map("n_samples_per_cluster"))
    finally:
        assigned.unpersist()
        ready.unpersist()
    return run
