"""Imputation, scaling, one-hot encoding and dimension reduction as one ML estimator.

``Preprocessor.fit`` learns small tables (fills, centres, scales, category lists) and
returns a ``PipelineModel`` made only of Spark's own stages: a ``SQLTransformer`` with
the learned literals, a ``StringIndexerModel``, a ``OneHotEncoderModel`` and a
``VectorAssembler``. Scoring stays inside the JVM and models save and load as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import (
    PCA,
    OneHotEncoder,
    PCAModel,
    SQLTransformer,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.mllib.linalg import Vectors as OldVectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import FLOATS, col, number, numeric_columns, quoted
from millrace.operators.quantiles import exact_quantiles, quantiles_without_fold

NUMERIC_STRATEGIES = ("median", "mean", "most_frequent", "constant")
CATEGORICAL_STRATEGIES = ("most_frequent", "constant")
SCALINGS = ("standard", "minmax", "none")
MISSING_CATEGORY = "missing_value"
SVD_MAX_COMPONENTS = 50


@dataclass(frozen=True)
class NumericFit:
    """What is learned for one numeric column on the training rows."""

    column: str
    fill: float | None
    centre: float
    scale: float

    @property
    def empty(self) -> bool:
        return self.fill is None


def _most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Most frequent number per column, the smallest on ties."""
    entries = [F.struct(F.lit(c).alias("column"), number(df, c).alias("value")) for c in columns]
    counts = (
        df.select(F.explode(F.array(*entries)).alias("e")).where(F.col("e.value").isNotNull())
        .groupBy("e.column", "e.value").agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.max(F.struct(F.col("n"), (-F.col("value")).alias("v"))).alias("b")
    return {r["column"]: 0.0 - r["b"]["v"] for r in counts.groupBy("column").agg(best).collect()}


@dataclass(frozen=True)
class Moments:
    """Non-null rows of a column in a set of rows; two sets of rows merge."""

    rows: int
    n: int
    mean: float
    var: float
    low: float | None
    high: float | None
    distinct: int = 0  # estimated, never less than the estimate of any part

    @classmethod
    def of(cls, row, i: int) -> "Moments":
        return cls(row["rows"], row[f"n{i}"], row[f"mean{i}"] or 0.0, row[f"var{i}"] or 0.0, row[f"min{i}"], row[f"max{i}"],
                   row[f"d{i}"])

    def merge(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if n == 0:
            return replace(self, rows=self.rows + other.rows)
        mean = (self.n * self.mean + other.n * other.mean) / n
        spread = sum(p.n * (p.var + (p.mean - mean) ** 2) for p in (self, other))
        lows = [x for x in (self.low, other.low) if x is not None]
        highs = [x for x in (self.high, other.high) if x is not None]
        return Moments(self.rows + other.rows, n, mean, spread / n, min(lows), max(highs),
                       self.distinct + other.distinct)

    def filled(self, value: float) -> "Moments":
        """The same rows with the nulls replaced by a value."""
        missing = self.rows - self.n
        return self.merge(Moments(0, missing, value, 0.0, value, value)) if missing else self


def _moments(df: DataFrame, columns: Sequence[str]) -> list:
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = number(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.var_pop(x).alias(f"var{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"), F.approx_count_distinct(x).alias(f"d{i}")]
    return aggs


def _numeric_fit(column: str, m: Moments, fill: float | None, scaling: str) -> NumericFit:
    if fill is None or m.rows == 0:
        return NumericFit(column, None, 0.0, 1.0)
    m = m.filled(fill)
    if scaling == "standard":
        return NumericFit(column, fill, m.mean, math.sqrt(m.var) if m.high > m.low and m.var > 0 else 1.0)
    if scaling == "minmax":
        return NumericFit(column, fill, m.low, (m.high - m.low) if m.high > m.low else 1.0)
    return NumericFit(column, fill, 0.0, 1.0)


def _fills(df: DataFrame, moments: dict[str, Moments], strategy: str, constant: float) -> dict[str, float | None]:
    columns = list(moments)
    if strategy == "median":
        found = exact_quantiles(df, columns, [0.5], known={c: (m.n, m.distinct) for c, m in moments.items()})
        return {c: v[0] for c, v in found.items()}
    if strategy == "mean":
        return {c: m.mean if m.n else None for c, m in moments.items()}
    if strategy == "most_frequent":
        return _most_frequent(df, columns)
    return {c: float(constant) for c in columns}


def _check_numeric(strategy: str, scaling: str) -> None:
    if strategy not in NUMERIC_STRATEGIES:
        raise ValueError(f"unknown numeric strategy: {strategy}")
    if scaling not in SCALINGS:
        raise ValueError(f"unknown scaling: {scaling}")


def learn_numeric(
    df: DataFrame, columns: Sequence[str], strategy: str = "median", scaling: str = "standard", constant: float = 0.0
) -> list[NumericFit]:
    """Fill, centre and scale per column from one moment pass plus the fill values.

    Moments after filling follow from the moments of the non-null rows, so the filled
    column is never scanned again.
    """
    _check_numeric(strategy, scaling)
    if not columns:
        return []
    row = df.agg(*_moments(df, columns)).first()
    moments = {c: Moments.of(row, i) for i, c in enumerate(columns)}
    fills = _fills(df, moments, strategy, constant)
    return [_numeric_fit(c, m, fills.get(c), scaling) for c, m in moments.items()]


def learn_numeric_by_fold(
    df: DataFrame, columns: Sequence[str], strategy: str, scaling: str, folds: Sequence[int]
) -> dict[int, list[NumericFit]]:
    """``learn_numeric`` on "all folds but f" for every f, in the passes that one fit takes.

    Moments are grouped by fold and merged. Medians come from counts by value and fold, shared by all folds; for the most frequent
    values each fold contributes a copy of the columns that is null on its own rows.
    """
    _check_numeric(strategy, scaling)
    if not columns:
        return {f: [] for f in folds}
    rows = df.groupBy("fold").agg(*_moments(df, columns)).collect()
    names = {(f, c): f"{f}:{c}" for f in folds for c in columns}
    moments = {
        a: reduce(Moments.merge, [Moments.of(r, columns.index(c)) for r in rows if r["fold"] != f])
        for (f, c), a in names.items()
    }
    if strategy == "median":
        of_fold = {c: {r["fold"]: r[f"n{i}"] for r in rows} for i, c in enumerate(columns)}
        distinct = {c: min(sum(r[f"n{i}"] for r in rows), sum(r[f"d{i}"] for r in rows)) for i, c in enumerate(columns)}
        fills = {names[a]: v for a, v in quantiles_without_fold(df, columns, 0.5, of_fold, distinct).items() if a in names}
    else:
        wide = df.select(*[F.when(F.col("fold") != f, number(df, c)).alias(a) for (f, c), a in names.items()])
        fills = _fills(wide, moments, strategy, 0.0)
    return {f: [_numeric_fit(c, moments[names[f, c]], fills.get(names[f, c]), scaling) for c in columns] for f in folds}


def category_counts(df: DataFrame, columns: Sequence[str], parts: Sequence[str] = (), most: int = 1_000_000) -> list[tuple]:
    """(column, value, *parts, n) for every category; an error if one column has more than ``most`` of them.

    The bound is per column, whatever the other columns and the parts hold."""
    if not columns:
        return []
    entries = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(*parts, F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.column", "e.value", *parts).agg(F.count(F.lit(1)).alias("n"))
    )
    counts = counts.persist()
    try:
        distinct = counts.select("column", "value").distinct() if parts else counts
        for r in distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect():
            if r["n"] > most:
                raise ValueError(f"more than {most} categories in {r['column']}: too many for one-hot encoding")
        return [tuple(r) for r in counts.collect()]
    finally:
        counts.unpersist()


def choose_categories(
    counts: Iterable[tuple[str, str | None, int]], columns: Sequence[str], strategy: str = "most_frequent",
    numbers: Iterable[str] = (),
) -> dict[str, tuple[str | None, list[str]]]:
    """column -> (fill, sorted categories after filling). Empty columns are left out; those of ``numbers`` sort as numbers."""
    numbers = set(numbers)
    if strategy not in CATEGORICAL_STRATEGIES:
        raise ValueError(f"unknown categorical strategy: {strategy}")
    per_column: dict[str, dict[str | None, int]] = {c: {} for c in columns}
    for c, value, n in counts:
        per_column[c][value] = per_column[c].get(value, 0) + n
    out = {}
    for c, all_counts in per_column.items():
        seen = {v: n for v, n in all_counts.items() if v is not None and n}

        def order(v: str, number: bool = c in numbers) -> tuple:
            try:
                return (0, float(v), v) if number else (1, 0.0, v)
            except ValueError:  # the constant fill
                return (1, 0.0, v)

        if strategy == "constant":
            fill = MISSING_CATEGORY
            categories = set(seen) | ({fill} if all_counts.get(None) else set())
        elif seen:
            fill = min(seen, key=lambda v: (-seen[v], order(v)))
            categories = set(seen)
        else:
            continue
        if categories:
            out[c] = (fill, sorted(categories, key=order))
    return out


def learn_categories(
    df: DataFrame, columns: Sequence[str], strategy: str = "most_frequent", most: int = 1_000_000
) -> dict[str, tuple[str | None, list[str]]]:
    return choose_categories(category_counts(df, columns, most=most), columns, strategy, numeric_columns(df))


def learn_by_fold(df: DataFrame, spec, folds: Sequence[int]) -> dict[int, tuple[list[NumericFit], dict]]:
    """Fills, scales and categories for each held-out fold, learned on the other folds, all of them together."""
    numeric = learn_numeric_by_fold(df, list(spec.numeric), spec.numeric_strategy, spec.scaling, folds)
    counts = category_counts(df, spec.categorical, ["fold"], spec.max_categories)
    out = {}
    for f in folds:
        rest = [(c, v, n) for c, v, fold, n in counts if fold != f]
        cats = choose_categories(rest, spec.categorical, spec.categorical_strategy, numeric_columns(df))
        out[f] = (numeric[f], cats)
    return out


def fit_by_fold(df: DataFrame, spec, folds: Sequence[int], learned: dict[int, tuple[list[NumericFit], dict]] | None = None) -> dict[int, PipelineModel]:
    """One encoder per held-out fold, from what ``learn_by_fold`` gives; only a reduction, which needs the encoded rows, is fitted fold by fold."""
    estimator, learned = preprocessor(spec), learned or learn_by_fold(df, spec, folds)
    return {f: estimator.assemble(df.where(F.col("fold") != f), fits, cats) for f, (fits, cats) in learned.items()}


def sql_number(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)" if math.isfinite(x) else f"CAST('{x}' AS DOUBLE)"


def sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _scaled_name(c: str) -> str:
    return f"_num_{c}"


def _filled_name(c: str) -> str:
    return f"_cat_{c}"


def _numeric_sql(df: DataFrame, fit: NumericFit) -> str:
    name = quoted(fit.column)
    value = f"CAST({name} AS DOUBLE)"
    if isinstance(df.schema[fit.column].dataType, FLOATS):
        value = f"CASE WHEN NOT isnan({name}) THEN {value} END"
    filled = f"coalesce({value}, {sql_number(fit.fill)})"
    return f"({filled} - {sql_number(fit.centre)}) / {sql_number(fit.scale)} AS {quoted(_scaled_name(fit.column))}"


class Preprocessor(Estimator):
    """Learn imputation, scaling, encoding and optional reduction on the training rows."""

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "text columns", TypeConverters.toListString)
    numericStrategy = Param(Params._dummy(), "numericStrategy", "fill for numbers", TypeConverters.toString)
    categoricalStrategy = Param(Params._dummy(), "categoricalStrategy", "fill for text", TypeConverters.toString)
    scaling = Param(Params._dummy(), "scaling", "standard, minmax or none", TypeConverters.toString)
    reduce = Param(Params._dummy(), "reduce", "reduce dimensions", TypeConverters.toBoolean)
    maxCategories = Param(Params._dummy(), "maxCategories", "most categories of one column", TypeConverters.toInt)
    varianceRatio = Param(Params._dummy(), "varianceRatio", "variance to keep", TypeConverters.toFloat)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numeric=(), categorical=(), numericStrategy="median", categoricalStrategy="most_frequent",
                 scaling="standard", reduce=False, varianceRatio=0.95, outputCol="features", maxCategories=1_000_000):
        super().__init__()
        given = dict(self._input_kwargs)
        self._setDefault(numeric=[], categorical=[], numericStrategy="median", categoricalStrategy="most_frequent",
                         scaling="standard", reduce=False, varianceRatio=0.95, outputCol="features", maxCategories=1_000_000)
        for name in ("numeric", "categorical"):
            if name in given:
                given[name] = list(given[name])
        self._set(**given)

    def _fit(self, df: DataFrame) -> PipelineModel:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        if not numeric and not categorical:
            raise ValueError("no features given")
        fits = learn_numeric(df, numeric, self.getOrDefault("numericStrategy"), self.getOrDefault("scaling"))
        cats = learn_categories(df, categorical, self.getOrDefault("categoricalStrategy"), self.getOrDefault("maxCategories"))
        return self.assemble(df, fits, cats)

    def assemble(self, df: DataFrame, fits: Sequence[NumericFit], cats: dict) -> PipelineModel:
        """The model for learned fills, scales and categories; columns without any value are dropped."""
        fits = [f for f in fits if not f.empty]
        if not fits and not cats:
            raise ValueError("every feature is empty in the training rows")
        reducing = self.getOrDefault("reduce")
        out = self.getOrDefault("outputCol")
        assembled = "_assembled" if reducing else out
        stages = encoder_stages(df, fits, cats, assembled)
        if reducing:
            encoded = PipelineModel(stages).transform(df)
            numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
            if categorical:
                k = max(1, min(SVD_MAX_COMPONENTS, len(numeric) + len(categorical) - 1))
                stages += fit_svd(encoded, assembled, out, k)
            else:
                stages += fit_pca(encoded, assembled, out, self.getOrDefault("varianceRatio"))
        temporary = [_scaled_name(f.column) for f in fits] + [_filled_name(c) for c in cats]
        temporary += [f"_idx_{c}" for c in cats] + [f"_hot_{c}" for c in cats]
        temporary += ["_assembled", "_centred", "_components"] if reducing else []
        stages.append(SQLTransformer(statement=_except_statement(temporary, PipelineModel(stages), df)))
        return PipelineModel(stages)


def _except_statement(temporary: Sequence[str], model: PipelineModel, df: DataFrame) -> str:
    made = set(model.transform(df.limit(0)).columns)
    dropped = ", ".join(quoted(c) for c in temporary if c in made)
    return f"SELECT * EXCEPT ({dropped}) FROM __THIS__"


def encoder_stages(df: DataFrame, fits: Sequence[NumericFit], cats: dict, out: str) -> list[Transformer]:
    """Scaled numbers first, then indicators of every category but the first of each column.

    The first category is not in the label list, so it shares the slot of unseen values,
    which the encoder drops: both become all zeros.
    """
    items = [_numeric_sql(df, f) for f in fits]
    items += [f"coalesce(CAST({quoted(c)} AS STRING), {sql_text(fill)}) AS {quoted(_filled_name(c))}"
              for c, (fill, _) in cats.items()]
    stages: list[Transformer] = [SQLTransformer(statement=f"SELECT *, {', '.join(items)} FROM __THIS__")]
    inputs = [_scaled_name(f.column) for f in fits]
    wide = {c: values for c, (_, values) in cats.items() if len(values) > 1}
    if wide:
        stages += [
            StringIndexerModel.from_labels(values[1:], inputCol=_filled_name(c), outputCol=f"_idx_{c}",
                                           handleInvalid="keep")
            for c, values in wide.items()
        ]
        # label metadata gives the sizes, so this fit reads no rows
        coded = PipelineModel(stages).transform(df.limit(0))
        encoder = OneHotEncoder(inputCols=[f"_idx_{c}" for c in wide], outputCols=[f"_hot_{c}" for c in wide],
                                dropLast=True, handleInvalid="error")
        stages.append(encoder.fit(coded))
        inputs += [f"_hot_{c}" for c in wide]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out))
    return stages


def preprocessor(spec, **changes) -> Preprocessor:
    """The estimator for a spec."""
    given = dict(numeric=list(spec.numeric), categorical=list(spec.categorical),
                 numericStrategy=spec.numeric_strategy, categoricalStrategy=spec.categorical_strategy,
                 scaling=spec.scaling, reduce=spec.pca, varianceRatio=spec.variance_ratio, maxCategories=spec.max_categories)
    return Preprocessor(**{**given, **changes})


def feature_names(model: PipelineModel, vector: str = "features") -> list[str]:
    """Names in vector order: numbers, then ``<column>_<category>``."""
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            return feature_names(stage, vector)
    reduced = [s for s in model.stages if isinstance(s, PCAModel)]
    if reduced:
        sliced = [s for s in model.stages if isinstance(s, VectorSlicer)]
        width = len(sliced[0].getIndices()) if sliced else reduced[0].getK()
        return [f"component_{i}" for i in range(width)]
    return encoded_names(model)


def encoded_names(model: PipelineModel) -> list[str]:
    """Names of the assembled vector before any reduction."""
    labels = {s.getInputCol(): s.labels for s in model.stages if isinstance(s, StringIndexerModel)}
    names = []
    for column in next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols():
        if column.startswith("_num_"):
            names.append(column.removeprefix("_num_"))
        else:
            base = column.removeprefix("_hot_")
            names += [f"{base}_{v}" for v in labels[_filled_name(base)]]
    return names


# --- reduction -------------------------------------------------------------------------


def components_for(ratios: Sequence[float], keep: float) -> int:
    """Smallest count whose cumulative explained ratio exceeds ``keep``."""
    total = 0.0
    for i, r in enumerate(ratios, start=1):
        total += r
        if total > keep:
            return i
    return len(ratios)


def fit_pca(df: DataFrame, vector: str, out: str, keep: float) -> list[Transformer]:
    """Centre, project on all components, keep the first few. One fit, no second scan."""
    width = len(df.select(vector).schema[vector].metadata.get("ml_attr", {}).get("attrs", {}).get("numeric", []))
    width = width or df.select(F.size(vector_to_array(vector)).alias("d")).first()["d"]
    centre = StandardScaler(withMean=True, withStd=False, inputCol=vector, outputCol="_centred").fit(df)
    model = PCA(k=width, inputCol="_centred", outputCol="_components").fit(centre.transform(df))
    m = components_for(model.explainedVariance.toArray().tolist(), keep)
    return [centre, model, VectorSlicer(inputCol="_components", outputCol=out, indices=list(range(m)))]


def fit_svd(df: DataFrame, vector: str, out: str, k: int) -> list[Transformer]:
    """Truncated SVD without centring.

    The right singular vectors come from Spark's distributed matrix over the rows as they are, sparse ones stay sparse. A fitted PCA model is the projection on them: it is fitted on
    the vectors themselves, each with its negative and as long as its singular value, whose mean is zero and whose principal components they are; Spark's PCA transform does not centre.
    """
    rows = RowMatrix(df.select(vector).rdd.map(lambda r: OldVectors.fromML(r[0])))
    svd = rows.computeSVD(min(k, vector_width(df, vector)), computeU=False)
    values, vectors = svd.s.toArray(), svd.V.toArray()
    scaled = vectors * (values / values[0])
    both = [(Vectors.dense(sign * scaled[:, i]),) for i in range(len(values)) for sign in (1.0, -1.0)]
    local = df.sparkSession.createDataFrame(both, [vector])
    return [PCA(k=len(values), inputCol=vector, outputCol=out).fit(local)]


def vector_width(df: DataFrame, vector: str = "features") -> int:
    """From the column's metadata, else from one row."""
    known = df.schema[vector].metadata.get("ml_attr", {}).get("num_attrs")
    if known is not None:
        return int(known)
    row = df.select(vector).first()
    return row[0].size if row else 0


def reduction_info(model: PipelineModel, df: DataFrame, vector: str = "features") -> DataFrame | None:
    """(component, explained_variance, ratio, cumulative) of the reduced vector, or None.

    Ratios are variances of the projected columns over the total variance before projection.
    """
    if not any(isinstance(s, PCAModel) for s in _flat(model)):
        return None
    stages = [s for s in _flat(model) if not isinstance(s, SQLTransformer)]
    first = next(s for s in _flat(model) if isinstance(s, SQLTransformer))
    scored = PipelineModel([first, *stages]).transform(df)
    pca = next(s for s in stages if isinstance(s, PCAModel))
    assembled = next(s for s in stages if isinstance(s, VectorAssembler)).getOutputCol()
    head = scored.select(F.size(vector_to_array(vector)).alias("m"), F.size(vector_to_array(assembled)).alias("d")).first()
    parts, whole = vector_to_array(vector), vector_to_array(assembled)
    wide = scored.select(parts.alias("p"), whole.alias("w"))
    centred = any(s.__class__.__name__ == "StandardScalerModel" for s in stages)
    spread = F.var_samp if centred else F.var_pop
    stats = wide.agg(
        *[spread(F.col("p")[i]).alias(f"p{i}") for i in range(head["m"])],
        *[spread(F.col("w")[i]).alias(f"w{i}") for i in range(head["d"])],
    ).first()
    total = sum(stats[f"w{i}"] for i in range(head["d"]))
    rows, running = [], 0.0
    for i in range(head["m"]):
        ratio = stats[f"p{i}"] / total
        running += ratio
        rows.append((i, stats[f"p{i}"], ratio, running))
    return df.sparkSession.createDataFrame(
        rows, "component int, explained_variance double, ratio double, cumulative double")


def _flat(model: PipelineModel) -> list[Transformer]:
    out: list[Transformer] = []
    for s in model.stages:
        out += _flat(s) if isinstance(s, PipelineModel) else [s]
    return out


def project_2d(df: DataFrame, numeric: Sequence[str], n_components: int = 2) -> DataFrame:
    """Median fill, standardise, project; adds pc1..pcn.

    Signs are fixed so that the largest loading of each component is positive.
    """
    prep = Preprocessor(numeric=list(numeric), outputCol="_scaled").fit(df)
    scaled = prep.transform(df)
    model = PCA(k=n_components, inputCol="_scaled", outputCol="_pcs").fit(scaled)
    loadings = model.pc.toArray()
    pcs = vector_to_array("_pcs")
    out = model.transform(scaled)
    for j in range(n_components):
        column = loadings[:, j]
        biggest = max(range(len(column)), key=lambda i: (round(abs(column[i]), 9), -i))
        sign = -1.0 if column[biggest] < 0 else 1.0
        out = out.withColumn(f"pc{j + 1}", pcs[j] * F.lit(sign))
    return out.drop("_scaled", "_pcs")
