"""The log of successful loads: one row per (endpoint, scope key) written."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from .shared import stored
from .versioned import current, files, read_parts, replace_parts

MANIFEST = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("scope_key", T.StringType()),
        T.StructField("fetched_at_utc", T.TimestampType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)
_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def new_run_id() -> str:
    return uuid.uuid4().hex


def snapshot_path(path: str) -> str:
    return f"{path.rstrip('/')}_snapshot"


def _entries(spark: SparkSession, path: str) -> dict[str, int]:
    """What lies right under a manifest's folder, with its time of change; nothing below is listed."""
    fs, folder = files(spark, path)
    if not fs.exists(folder) or not fs.getFileStatus(folder).isDirectory():
        return {}
    found = {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(folder)}
    return {name: int(time) for name, time in found.items() if not name.startswith(("_", "."))}


def snapshot_manifest(spark: SparkSession, path: str, fmt: str = "json") -> int:
    """Store what has been logged since the last snapshot as columns; returns the rows taken in.

    The log itself stays as it is. Reads afterwards take the snapshot and the
    log's newer entries alone; a batch that is written again later counts as
    newer, and its rows in the snapshot no longer count. Rows are kept in parts
    by endpoint. A snapshot that ends half way changes nothing.
    """
    where = snapshot_path(path)
    at = current(spark, where)
    taken = json.loads(at.note) if at.note else {}
    fs, folder = files(spark, path)
    is_whole = lambda name: "." in name or fs.exists(files(spark, f"{path.rstrip('/')}/{name}/_SUCCESS")[1])
    new = {n: t for n, t in _entries(spark, path).items() if taken.get(n) != t and is_whole(n)}
    if not new:
        return 0
    rows = _checked(_read_log(spark, [f"{path.rstrip('/')}/{n}" for n in new], fmt))
    rows = stored(rows.withColumn(_ENTRY, _entry_of(path)).drop("__file"), "manifest")
    again = [n for n in new if n in taken]
    before = read_parts(spark, where, at=at, schema=rows.schema)
    endpoints = rows if not again else rows.unionByName(before.where(F.col(_ENTRY).isin(again)))
    touched = sorted(r[0] for r in endpoints.select("endpoint").distinct().collect())
    kept = read_parts(spark, where, touched, at, rows.schema).where(~F.col(_ENTRY).isin(again))
    replace_parts(kept.unionByName(rows), where, F.col("endpoint"), touched, at, note=json.dumps({**taken, **new}))
    return rows.count()


_ENTRY = "__entry"


def _entry_of(path: str) -> Column:
    """The name right under the manifest's folder that a row was read from."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return F.substring_index(F.element_at(F.split("__file", f"/{re.escape(name)}/"), -1), "/", 1)


def _read_log(spark: SparkSession, paths: list[str], fmt: str) -> DataFrame:
    reader = spark.read.schema(MANIFEST).option("recursiveFileLookup", True)
    df = reader.option("mode", "FAILFAST").json(paths) if fmt == "json" else reader.parquet(*paths)
    return df.withColumn("__file", F.col("_metadata.file_path"))


def read_manifest(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """All manifest rows; an absent path is an empty manifest.

    JSON lines are read strictly: a malformed line or a missing key raises,
    blank lines are skipped and an absent ``status`` means ``ok``. ``fmt`` may
    be ``parquet``, which reads only the columns a job needs. Where there is a
    snapshot (``snapshot_manifest``), only newer entries of the log are opened.
    """
    at = current(spark, snapshot_path(path))
    if at.schema is not None:
        taken, found = json.loads(at.note), _entries(spark, path)
        newer = [n for n, t in found.items() if taken.get(n) != t]
        held = read_parts(spark, snapshot_path(path), at=at)
        replaced = [n for n in newer if n in taken]
        held = held.where(~F.col(_ENTRY).isin(replaced)) if replaced else held
        held = held.select(*MANIFEST.fieldNames())
        if not newer:
            return held
        return held.unionByName(_checked(_read_log(spark, [f"{path.rstrip('/')}/{n}" for n in newer], fmt)).select(*MANIFEST.fieldNames()))
    try:
        df = _read_log(spark, [path], fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    return _checked(df).select(*MANIFEST.fieldNames())


def _checked(df: DataFrame) -> DataFrame:
    checked = [
        F.coalesce(F.col(f.name), F.raise_error(F.lit(f"manifest row lacks {f.name}"))).alias(f.name)
        for f in MANIFEST.fields
        if f.name != "status"
    ]
    return df.select(*checked, F.coalesce("status", F.lit("ok")).alias("status"), "__file")


def append_manifest(df: DataFrame, path: str, fmt: str = "json", batch: str | None = None) -> int:
    """Append rows as new files and return how many; other rows stay untouched.

    ``batch`` names a folder of its own for these rows: appending the same
    batch again after a failure replaces them instead of doubling them.
    """
    seen = Observation()
    counted = df.select(*MANIFEST.fieldNames()).observe(seen, F.count(F.lit(1)).alias("rows"))
    if batch is not None:
        path = f"{path.rstrip('/')}/{batch}"
    writer = counted.write.mode("append" if batch is None else "overwrite")
    if fmt == "json":
        writer.option("timestampFormat", _TIME_FORMAT).json(path)
    else:
        writer.parquet(path)
    return int(seen.get["rows"])


def manifest_rows(
    written: DataFrame,
    run_id: str,
    scope_key: Column,
    compression: float = 1.0,
    status: str = "ok",
    at: Column | None = None,
) -> DataFrame:
    """One manifest row per (endpoint, scope key) of the envelope rows ``written``.

    ``bytes`` is the raw body size times ``compression`` (stored per raw byte),
    so the rows of one write add up to what it stored, within rounding.
    """
    raw = F.sum(F.octet_length("response_json"))
    return (
        written.groupBy("endpoint", scope_key.alias("scope_key"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(raw * F.lit(float(compression))).cast("bigint").alias("bytes"),
        )
        .select(
            F.lit(run_id).alias("run_id"),
            "endpoint",
            "scope_key",
            (F.current_timestamp() if at is None else at).alias("fetched_at_utc"),
            "rows",
            "bytes",
            F.lit(status).alias("status"),
        )
    )
