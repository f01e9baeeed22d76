"""Intermediate tables in the folder a cluster shares.

Used to cut lineage where several results read the same costly frame. A
written table survives lost executors and is read back with column pruning.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local master that names none gets a temporary folder of this application,
    which goes when it ends; a cluster must name one.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="moraine-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/moraine/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table that a job has written for itself."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
