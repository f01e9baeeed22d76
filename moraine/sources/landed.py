"""Responses that some fetcher has saved, waiting to be loaded into bronze.

Two layouts, both split by a ``family=`` folder so that a job reads only the
families it loads:

* ``json`` / ``parquet``: many responses per file, columns ``scope_key``,
  ``status``, ``fetched_at_utc``, ``response_json``. Parquet is the one to use
  at scale: planning reads the scope keys alone, and a load of few units can
  skip row groups.
Below the family a landing may have a folder for each day of arrival
(``family=../arrived=YYYY-MM-DD``); ``since`` and ``until`` then open the days
asked for and no other. Responses outside such folders are read always.

* ``text``: one file per response, everything but the body in the path:
  ``family=../scope_key=../status=../fetched_at_utc=../<any name>``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANDED = T.StructType(
    [
        T.StructField("scope_key", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("fetched_at_utc", T.TimestampType()),
        T.StructField("response_json", T.StringType()),
        T.StructField("family", T.StringType()),
    ]
)
_FILES = T.StructType([*LANDED.fields, T.StructField("arrived", T.DateType())])
_TEXT = "value string, family string, scope_key string, status int, fetched_at_utc string"


def _shaped(df: DataFrame, fmt: str) -> DataFrame:
    if fmt != "text":
        return df.select(*LANDED.fieldNames())
    return df.select(
        "scope_key",
        "status",
        F.col("fetched_at_utc").cast("timestamp").alias("fetched_at_utc"),
        F.col("value").alias("response_json"),
        "family",
    )


def _configured(reader, fmt: str):
    if fmt == "text":
        return reader.format("text").option("wholetext", True).schema(_TEXT)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(fmt).schema(_FILES)


def read_landed(
    spark: SparkSession,
    path: str,
    family: str | None = None,
    fmt: str = "json",
    since: date | str | None = None,
    until: date | str | None = None,
) -> DataFrame:
    """Saved responses, optionally of one family and of some days of arrival (both inclusive).

    Both choices prune folders before a file is opened.
    """
    df = _configured(spark.read, fmt).load(path)
    if family is not None:
        df = df.where(F.col("family") == family)
    if "arrived" not in df.columns:  # text files may hold one column and their folders' names
        df = df.withColumn("arrived", F.lit(None).cast("date"))
    undated = F.col("arrived").isNull()
    if since is not None:
        df = df.where(undated | (F.col("arrived") >= F.lit(str(since)).cast("date")))
    if until is not None:
        df = df.where(undated | (F.col("arrived") <= F.lit(str(until)).cast("date")))
    return _shaped(df, fmt)


def stream_landed(
    spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """The same rows as a stream of newly arriving files."""
    reader = _configured(spark.readStream, fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _shaped(reader.load(path), fmt)
