"""Tabular analytics and machine learning as Spark jobs."""

from millrace.operators.clusters import KMeansRange, best_k, evaluate_k_range, select_best_k
from millrace.operators.preprocess import Preprocessor, feature_names
from millrace.operators.splits import kfold, split_table, stratified_kfold, train_test_split
from millrace.operators.tuning import Candidate, cross_validate, grid_search, random_search, refine_grid
from millrace.plans.evaluate import Evaluation, evaluate, score
from millrace.plans.jobs import cluster, data_summary, full, model_comparison, report_tables, train, tune
from millrace.sources.readers import read_delimited, read_table
from millrace.sources.sinks import load_model, save_model
from millrace.spec import Spec

__all__ = [
    "Candidate", "Evaluation", "KMeansRange", "Preprocessor", "Spec", "best_k", "cluster", "cross_validate",
    "data_summary", "evaluate", "evaluate_k_range", "feature_names", "full", "grid_search", "kfold", "load_model",
    "model_comparison", "random_search", "read_delimited", "read_table", "refine_grid", "report_tables", "save_model",
    "score", "select_best_k", "split_table", "stratified_kfold", "train", "train_test_split", "tune",
]
