"""Tables in parts, of which a load replaces some and leaves the others' files alone.

A table is a folder with ``data/<build>/<part>`` folders that are never changed
once written, and ``_snapshots/<number>.json``, which name the folder of every
part. A new snapshot appears under its final name at once, so a reader sees the
parts as they were before or after it, and a writer that ends half way leaves
only folders that no snapshot names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "__part"
NO_PART = "none"


@dataclass(frozen=True)
class Snapshot:
    """``parts`` maps a part to its folder, ``sources`` to what it was built from, if that was named."""

    number: int = 0
    schema: T.StructType | None = None
    parts: Mapping[str, str] = field(default_factory=dict)
    sources: Mapping[str, str] = field(default_factory=dict)
    note: str | None = None


class SnapshotTaken(RuntimeError):
    """Another writer has published a snapshot since this one read the table."""


def files(spark: SparkSession, path: str):
    """(file system, path object) of a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = files(spark, f"{path}/_snapshots")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def _snapshot(spark: SparkSession, path: str, number: int) -> Snapshot:
    text = spark.read.text(f"{path}/_snapshots/{number:010d}.json", wholetext=True).first()[0]
    held = json.loads(text)
    return Snapshot(number, T.StructType.fromJson(held["schema"]), held["parts"], held["sources"], held["note"])


def current(spark: SparkSession, path: str) -> Snapshot:
    """The table's last snapshot; an absent table has none and no parts."""
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    return _snapshot(spark, path, numbers[-1]) if numbers else Snapshot()


def read_parts(
    spark: SparkSession, path: str, parts: Collection[str] | None = None, at: Snapshot | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of the named parts, or of all; files of other parts are not listed or opened.

    ``schema`` is that of a table which may not be there yet.
    """
    at = current(spark, path) if at is None else at
    folders = [folder for part, folder in sorted(at.parts.items()) if parts is None or part in parts]
    known = at.schema or schema
    if known is None:
        raise FileNotFoundError(f"no table in {path}")
    if not folders:
        return spark.createDataFrame([], known)
    return spark.read.schema(known).parquet(*(f"{path.rstrip('/')}/{folder}" for folder in folders))


def replace_parts(
    df: DataFrame,
    path: str,
    part: Column,
    replaced: Collection[str],
    at: Snapshot,
    sources: Mapping[str, str] | None = None,
    note: str | None = None,
) -> Snapshot:
    """Put the rows of ``df`` in place of the parts ``replaced`` and publish the new snapshot.

    ``at`` is the snapshot that ``df`` was worked out from. Rows of other parts
    fail the write; a part that has no rows any more goes. NULL is the part
    ``none``. Large parts are split into files by size.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    build = f"data/{uuid.uuid4().hex}"
    name = F.coalesce(part.cast("string"), F.lit(NO_PART))
    known = name.isin(*replaced) if replaced else F.lit(False)
    checked = F.when(known, name).otherwise(F.raise_error(F.concat(F.lit("row of another part: "), name)))
    rows = df.withColumn(PART, checked).hint("rebalance", PART)
    rows.write.partitionBy(PART).option("compression", "zstd").parquet(f"{path}/{build}")
    fs, folder = files(spark, f"{path}/{build}")
    written = [s.getPath().getName() for s in fs.listStatus(folder)]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    new = {unescape(w.removeprefix(f"{PART}=")): f"{build}/{w}" for w in written if w.startswith(f"{PART}=")}
    keep = lambda held: {k: v for k, v in held.items() if k not in replaced}
    after = Snapshot(at.number + 1, df.schema, {**keep(at.parts), **new}, {**keep(at.sources), **(sources or {})}, note)
    _publish(spark, path, after)
    return after


def _publish(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    text = json.dumps(
        {
            "schema": json.loads(snapshot.schema.json()),
            "parts": dict(snapshot.parts),
            "sources": dict(snapshot.sources),
            "note": snapshot.note,
        }
    )
    fs, draft = files(spark, f"{path}/_snapshots/.{uuid.uuid4().hex}")
    _, final = files(spark, f"{path}/_snapshots/{snapshot.number:010d}.json")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise SnapshotTaken(f"snapshot {snapshot.number} of {path} is there already")


def remove_unused(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete builds that none of the last ``keep`` snapshots names; readers of those may still be at work.

    Returns how many were deleted. Not to be run beside a writer, whose build is not named yet.
    """
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    used = {folder.split("/")[1] for n in numbers[-keep:] for folder in _snapshot(spark, path, n).parts.values()}
    fs, folder = files(spark, f"{path}/data")
    unused = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in used] if fs.exists(folder) else []
    for n in numbers[:-keep]:
        fs.delete(files(spark, f"{path}/_snapshots/{n:010d}.json")[1], False)
    for build in unused:
        fs.delete(build, True)
    return len(unused)
