"""Tables between the jobs of one operator, in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN = "_millrace_shared_folder"


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where that is unset a local master gets a temporary folder, and any other an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not hasattr(spark.sparkContext, _OWN):
        setattr(spark.sparkContext, _OWN, "file://" + tempfile.mkdtemp(prefix="millrace-"))
    return getattr(spark.sparkContext, _OWN)


def _delete(spark: SparkSession, path: str, now: bool) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(at, True) if now else fs.deleteOnExit(at)


def written(df: DataFrame) -> DataFrame:
    """The table, written once and read back: later jobs neither repeat what led to it nor need the executors that did. Deleted when the application ends."""
    path = f"{shared_folder(df.sparkSession)}/millrace-{uuid.uuid4().hex}"
    # Spark deletes the shuffle files of earlier steps once their plans are garbage on the driver, which by itself may take until long after the disks are full
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    df.write.parquet(path)
    _delete(df.sparkSession, path, now=False)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, text): a document is known by a hash of its id and text together, so that an id with two texts is two documents."""
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).select("id", F.xxhash64("id", "text").alias("row"), "text")


#: Cells that a table may have to be sent to every task whole: some megabytes.
SMALL = 500_000


def light(df: DataFrame, cells: Column) -> DataFrame:
    """The table, marked for broadcast if its rows have no more than `SMALL` cells together; beyond that it is joined by a shuffle. Counted, so give it a written table."""
    return F.broadcast(df) if (df.agg(F.sum(cells)).first()[0] or 0) <= SMALL else df


def discard(df: DataFrame) -> None:
    """Delete a table that `written` made, once nothing reads it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, path, now=True)
