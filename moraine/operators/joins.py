"""Key spines, dimension look-ups and the pending-work gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_spine(key: str, frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct keys over all frames. Each side is made distinct before the
    union, so a hot key is one row per map task when it is shuffled."""
    return reduce(DataFrame.union, [f.select(key) for f in frames]).distinct()


def spine_left_join(key: str, sources: Mapping[str, DataFrame]) -> DataFrame:
    """All keys of ``sources`` with each source's columns as a struct.

    Sources must hold one row per key (see ``latest_by``). The result has
    ``key`` and one struct column per source, NULL where the source has no
    such key. Same rows as a distinct union of the keys followed by one left
    join per source, but planned as a single shuffle: the tagged union is
    grouped by key once, with map-side combining.
    """
    lanes = []
    for name, frame in sources.items():
        payload = F.when(F.col(key).isNotNull(), F.struct(*[F.col(c) for c in frame.columns]))
        lanes.append(frame.select(F.col(key), payload.alias(name)))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lanes)
    return merged.groupBy(key).agg(
        *[F.first(name, ignorenulls=True).alias(name) for name in sources]
    )


def enrich_left(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to a dimension with unique keys; unmatched rows get NULLs.

    No hint: Spark broadcasts the dimension when its measured size allows and
    splits skewed partitions otherwise.
    """
    return df.join(dim, on, "left")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, out: str = "n_rows") -> DataFrame:
    """Non-NULL foreign keys without a parent, with the child row count.

    The child is reduced to one row per key value before the join, so a hot
    key costs one row per map task.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias(out))
    parents = parent.select(F.col(pk).alias(fk)).distinct()
    return keys.join(parents, fk, "left_anti")


def complete_units(manifest: DataFrame, endpoints: Sequence[str]) -> DataFrame:
    """Scope keys that have an ``ok`` manifest row for every endpoint."""
    seen = [F.bool_or(F.col("endpoint") == e) for e in endpoints]
    done = reduce(lambda a, b: a & b, seen)
    return (
        manifest.where((F.col("status") == "ok") & F.col("endpoint").isin(list(endpoints)))
        .groupBy("scope_key")
        .agg(done.alias("__done"))
        .where("__done")
        .select("scope_key")
    )


def pending_units(units: DataFrame, manifest: DataFrame, endpoints: Sequence[str]) -> DataFrame:
    """Units (``scope_key``) not yet complete; a partly done unit is redone whole."""
    return units.join(complete_units(manifest, endpoints), "scope_key", "left_anti")
