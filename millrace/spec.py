"""Job description: column roles, split, preprocessing, models and clustering options."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

# The default search space of the forest tuning job.
FOREST_SPACE: dict[str, list[Any]] = {
    "n_estimators": [50, 100, 200, 300, 500],
    "max_depth": [5, 10, 15, 20, 25, None],
    "max_features": ["sqrt", "log2", 0.3, 0.5],
    "min_samples_split": [2, 5, 10, 20],
    "min_samples_leaf": [1, 2, 4, 8],
}

# Default metric names per task, primary first.
DEFAULT_METRICS = {
    "classification": ("roc_auc", "average_precision", "balanced_accuracy", "f1"),
    "regression": ("neg_root_mean_squared_error", "r2"),
}


@dataclass(frozen=True)
class Spec:
    """Everything a job needs to know about one table.

    ``key`` names the columns that identify a row; they drive every split.
    With no key the whole row is used.
    """

    target: str | None = None
    task: str = "classification"
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    expected_columns: tuple[str, ...] = ()
    max_null_fraction: float = 0.05
    test_size: float = 0.2
    stratify: bool = False
    shuffle: bool = True
    order_by: tuple[str, ...] = ()
    numeric_strategy: str = "median"
    categorical_strategy: str = "most_frequent"
    scaling: str = "standard"
    pca: bool = False
    variance_ratio: float = 0.95
    folds: int = 5
    metrics: tuple[str, ...] = ()
    baseline: str | None = None
    baseline_params: Mapping[str, Any] = field(default_factory=dict)
    forest_params: Mapping[str, Any] = field(default_factory=dict)
    forest_class_weight: str | None = "balanced"
    search_iterations: int = 20
    search_space: Mapping[str, list[Any]] = field(default_factory=lambda: dict(FOREST_SPACE))
    grid_enabled: bool = True
    max_candidates: int | None = None
    k_range: tuple[int, ...] = tuple(range(2, 11))
    n_init: int = 10
    max_iter: int = 300
    silhouette: str = "squared"  # or "euclidean", which is quadratic in the distinct points
    seed: int = 42
    parallelism: int = 4
    fit_partitions: int | None = None  # what iterative fits read; None: as many as follow from the number of rows
    max_categories: int = 1_000_000  # of any one column; more is an error, as every category is one-hot encoded
    max_bins: int = 64  # of trees and forests
    tree_memory_mb: int = 256  # histograms that one pass over the rows may hold
    fold_shuffle: bool = True  # False: regression folds are contiguous in key order
    project: str = "tabular"

    def __post_init__(self) -> None:
        if self.task not in DEFAULT_METRICS:
            raise ValueError(f"unknown task: {self.task}")
        if self.stratify and not self.shuffle:
            raise ValueError("a stratified split needs shuffle=True")

    @property
    def scoring(self) -> tuple[str, ...]:
        """Metric names used in cross-validation, primary first."""
        return self.metrics or DEFAULT_METRICS[self.task]

    @property
    def primary(self) -> str:
        return self.scoring[0]

    @property
    def is_classification(self) -> bool:
        return self.task == "classification"

    def but(self, **changes: Any) -> "Spec":
        return replace(self, **changes)

    @classmethod
    def from_config(cls, config: Mapping[str, Any], key: tuple[str, ...] = ()) -> "Spec":
        """Build a spec from a nested configuration mapping (already parsed). The keys are fixed values."""

        def get(path: str, default: Any = None) -> Any:
            node: Any = config
            for part in path.split("."):
                if not isinstance(node, Mapping) or node.get(part) is None:
                    return default
                node = node[part]
            return node

        def column(name: str) -> str:
            return name.replace(".", "_")

        task = get("data.task_type", "classification")
        primary = get(f"metrics.{task}.primary", DEFAULT_METRICS[task][0])
        target = get("data.target_column")
        shuffle = get("split.shuffle", True)
        forest = "supervised_models.random_forest"
        return cls(
            target=None if target is None else column(target),
            task=task,
            numeric=tuple(map(column, get("preprocessing.numeric_features", ()))),
            categorical=tuple(map(column, get("preprocessing.categorical_features", ()))),
            key=tuple(map(column, key)),
            expected_columns=tuple(map(column, get("schema.expected_columns", ()))),
            max_null_fraction=get("schema.max_null_percentage", 0.05),
            test_size=get("split.test_size", 0.2),
            stratify=bool(get("split.stratify", False)) and task == "classification",
            shuffle=shuffle,
            order_by=() if shuffle else tuple(map(column, key)),
            numeric_strategy=get("preprocessing.imputation.numeric_strategy", "median"),
            categorical_strategy=get("preprocessing.imputation.categorical_strategy", "most_frequent"),
            scaling=get("preprocessing.scaling.method", "standard"),
            pca=get("preprocessing.pca.enabled", False),
            variance_ratio=get("preprocessing.pca.variance_ratio", 0.95),
            folds=get("cross_validation.n_splits", 5),
            fold_shuffle=get("cross_validation.shuffle", True),
            metrics=(primary, *get(f"metrics.{task}.secondary", ())),
            baseline=get("supervised_models.baseline.model_type"),
            baseline_params=get("supervised_models.baseline.params", {}),
            forest_class_weight=get(f"{forest}.class_weight"),
            search_iterations=get(f"{forest}.randomized_search.n_iter", 20),
            search_space=get(f"{forest}.randomized_search.params", dict(FOREST_SPACE)),
            grid_enabled=get(f"{forest}.grid_search.enabled", True),
            k_range=tuple(get("kmeans.k_range", range(2, 11))),
            n_init=get("kmeans.n_init", 10),
            max_iter=get("kmeans.max_iter", 300),
            seed=get("random_seed", 42),
            project=get("project_name", "ml_project"),
        )
