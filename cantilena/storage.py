"""Where tables are written to cut their lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which the cluster names in spark.checkpoint.dir. A temporary one serves on a local master alone."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="cantilena-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df computed once and written to the shared checkpoint folder; its lineage ends there.

    The files go when Spark's cleaner finds that nobody refers to the table any more, if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ours, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
