"""Intermediate tables in the folder all executors share."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

MOST_SPREAD = 8

_local_root: dict[str, str] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process may go without that
    setting; it gets a temporary folder.
    """
    return f"{_session_folder(spark)}/{uuid.uuid4().hex}/{name}"


def _session_folder(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _local_root:
            _local_root[app] = tempfile.mkdtemp(prefix="litsearch-")
        root = _local_root[app]
    return f"{root.rstrip('/')}/litsearch/{app}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this session; frames made of them are gone too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write once, read back: lineage is cut and the size on disk is known.

    The copy outlives lost executors, and what is read from it several times is
    computed once. ``compression`` is that of the session if none is given.
    """
    path = scratch_folder(df.sparkSession, name)
    options = {"compression": compression} if compression else {}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_scan(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer splits than there are cores.

    Small inputs in one file would run in one task. Inputs of more than
    ``MOST_SPREAD`` splits, about a gigabyte, are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() <= min(cores, MOST_SPREAD) else df
