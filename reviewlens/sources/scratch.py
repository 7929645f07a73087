"""Shared scratch folder: where lineage is cut and intermediate tables are written.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a ``local`` master with
nothing configured (tests) gets a temporary one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="reviewlens-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def run_folder(spark: SparkSession) -> str:
    """The folder of this application under the shared one."""
    return f"{scratch_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of this application."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> bool:
    """Deletes what this application has written to the shared folder; frames that read it are of no use then."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, name: str = "frame") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, so that losing executors loses nothing; several consumers share one computation;
    and the planner knows the size of what it joins.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes what ``materialise`` wrote for frames that nothing reads any more, and shuffles out of reach."""
    for df in frames:
        spark, files = df.sparkSession, df.inputFiles()
        if files:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    if frames:
        # the context cleaner deletes shuffles when the driver's heap is collected
        frames[0].sparkSession.sparkContext._jvm.System.gc()
