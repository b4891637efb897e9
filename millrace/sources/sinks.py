"""Writing results, models and run records; where scratch tables go."""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid
from collections.abc import Mapping
from datetime import UTC, datetime
from functools import lru_cache
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.readers import file_hashes, row_fingerprint

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names for checkpoints; a local one only in local mode."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    return _local_dir()


@lru_cache(maxsize=1)
def _local_dir() -> str:
    """One folder for local runs, gone when the process ends; the session's settings stay as they are."""
    folder = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never reused."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, wherever it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    """Write as CSV with a header; maps, arrays and structs become JSON text."""
    flat = df
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType)):
            flat = flat.withColumn(field.name, F.to_json(F.col(field.name)))
    # blanks at the ends of cells are part of them
    keep = flat.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    keep.option("header", True).option("sep", separator).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_centroids(centroids: DataFrame, path: str) -> None:
    """One folder per k."""
    centroids.write.partitionBy("k").option("header", True).csv(path)


def export_results(spark: SparkSession, results: DataFrame | Mapping[str, Any], path: str) -> None:
    """A table as CSV, or a flat mapping as a one-row CSV."""
    if isinstance(results, DataFrame):
        write_csv(results, path)
    else:
        row = tuple(None if v is None else str(v) for v in results.values())
        schema = T.StructType([T.StructField(str(k), T.StringType()) for k in results])
        write_csv(spark.createDataFrame([row], schema), path)


def save_model(model: PipelineModel, folder: str, name: str, run_id: str | None = None) -> str:
    """Save under the name and the run, by default the time; an earlier model is never overwritten."""
    run_id = run_id or datetime.now(UTC).strftime("%Y%m%d_%H%M%S_%f")
    path = f"{folder.rstrip('/')}/{name}_{run_id}"
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_record(
    spark: SparkSession,
    seed: int,
    project: str,
    dataset: DataFrame | None = None,
    dataset_path: str | None = None,
    hash_files: bool = False,
    details: Mapping[str, Any] | None = None,
) -> DataFrame:
    """One row describing a run: time, seed, project, dataset identity, results."""
    n_rows = checksum = sha = None
    if dataset is not None:
        mark = row_fingerprint(dataset).first()
        n_rows, checksum = mark["n_rows"], str(mark["checksum"])
    if dataset_path is not None and hash_files:
        # the digest of a single file is its own; those of several are added up, in any order
        word = F.conv(F.substring("sha256", 1, 16), 16, 10).cast("decimal(20,0)")
        files = file_hashes(spark, dataset_path).agg(
            F.count(F.lit(1)).alias("n"), F.max("sha256").alias("one"), F.sum(word).alias("total")
        ).first()
        sha = files["one"] if files["n"] == 1 else hashlib.sha256(f"{files['n']}|{files['total']}".encode()).hexdigest()
    row = [(uuid.uuid4().hex, seed, project, dataset_path, sha, n_rows, checksum,
            {k: str(v) for k, v in (details or {}).items()})]
    schema = ("run_id string, seed int, project string, dataset_path string, dataset_sha256 string, "
              "n_rows bigint, checksum string, details map<string,string>")
    return spark.createDataFrame(row, schema).withColumn("finished_at", F.current_timestamp())


def append_run(record: DataFrame, log_path: str) -> None:
    record.write.mode("append").json(log_path)


def read_runs(spark: SparkSession, log_path: str) -> DataFrame:
    schema = ("run_id string, seed int, project string, dataset_path string, dataset_sha256 string, "
              "n_rows bigint, checksum string, details map<string,string>, finished_at timestamp")
    return spark.read.schema(schema).json(log_path)
