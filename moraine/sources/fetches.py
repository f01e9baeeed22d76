"""Index of stored fetches: which fetch of which unit bronze holds, without reading bronze.

One small table per family, in parts by the year a unit's key begins with (a
game's number, a season and a date all do), so that a load opens the parts of
its own units however long the history is.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .versioned import NO_PART, Snapshot, current, read_parts, replace_parts

FETCHES = "scope_key string, fetched_at_utc timestamp, digest string, batch string"


def fetch_index(base: str, family: str) -> str:
    return f"{base.rstrip('/')}/_index/{family}"


def part_of_key() -> Column:
    return F.substring("scope_key", 1, 4)


def parts_of_keys(df: DataFrame) -> list[str]:
    """The parts of some units: years, so a short list."""
    return sorted(r[0] for r in df.select(F.coalesce(part_of_key(), F.lit(NO_PART)).alias("p")).distinct().collect())


def known_fetches(spark: SparkSession, base: str, family: str, units: DataFrame, without: str) -> DataFrame | None:
    """(scope_key, fetched_at_utc, digest) of stored fetches in the parts that ``units`` fall into,
    except those of the batch ``without``; None if the family has no index yet."""
    path = fetch_index(base, family)
    at = current(spark, path)
    if at.schema is None:
        return None
    return read_parts(spark, path, parts_of_keys(units), at).where(F.col("batch") != without).drop("batch")


def index_fetches(spark: SparkSession, base: str, family: str, fetches: DataFrame, batch: str, earlier: DataFrame | None = None) -> Snapshot:
    """Put a batch's fetches into the index; what an earlier try of this batch put there goes.

    ``fetches`` has scope_key, fetched_at_utc and digest; ``earlier`` holds what
    was stored before the index, with its batch, and is read if there is none.
    """
    path = fetch_index(base, family)
    at = current(spark, path)
    rows = fetches.select("scope_key", "fetched_at_utc", "digest", F.lit(batch).alias("batch"))
    if at.schema is None and earlier is not None:
        rows = rows.unionByName(earlier.where(F.col("batch") != batch))
    parts = parts_of_keys(rows)
    last = json.loads(at.note) if at.note else {}
    if not parts and last.get("batch") != batch and at.schema is not None:
        return at
    touched = sorted({*parts, *(last.get("parts", []) if last.get("batch") == batch else [])})
    before = read_parts(spark, path, touched, at, rows.schema).where(F.col("batch") != batch)
    return replace_parts(before.unionByName(rows), path, part_of_key(), touched, at, note=json.dumps({"batch": batch, "parts": parts}))
