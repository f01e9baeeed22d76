"""Incremental ingest of newly saved responses."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.unnest import union_facts
from ..plans.backfill import Load, RejectedBodies, write_family
from ..sources import endpoints as E
from ..sources.landed import stream_landed
from ..sources.manifest import append_manifest
from ..sources.shared import remove_table


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    base: str,
    stream_id: str = "stream",
    manifest_format: str = "json",
    strict: bool = False,
    ingest_date: date | None = None,
) -> int:
    """Load one micro-batch; returns the manifest rows appended.

    A response whose (endpoint, scope key) an earlier batch or run has logged
    is dropped. Everything written is named after the batch, so a batch that
    is replayed after a failure replaces its own output; its own manifest rows
    do not count as "earlier". The batch is read once: what is new is written
    by family under the lake, and each family reads its own folder. Rows are
    filed under the run's UTC date.
    """
    spark = batch.sparkSession
    name = f"{stream_id}-{batch_id}"
    day = ingest_date or datetime.now(timezone.utc).date()
    load = Load(spark, "", base, name, day, manifest_format=manifest_format, strict=strict)
    loadable = {f: E.TEMPLATES[f] for phase in E.PHASE_FAMILIES.values() for f in phase}
    templates = F.create_map(*[F.lit(x) for pair in loadable.items() for x in pair])
    earlier = load.manifest().where((F.col("status") == "ok") & (F.col("run_id") != name))
    earlier = earlier.select("endpoint", "scope_key").distinct()
    fresh = (
        batch.where(F.col("family").isin(list(loadable)))
        .withColumn("endpoint", templates[F.col("family")])
        .join(earlier, ["endpoint", "scope_key"], "left_anti")
        .drop("endpoint")
    )
    path = f"{base.rstrip('/')}/_arriving/{name}"
    fresh.write.mode("overwrite").partitionBy("family").parquet(path)
    arrived = spark.read.schema(fresh.schema).parquet(path)
    # At most one row per family reaches the driver.
    present = sorted(r.family for r in arrived.select("family").distinct().collect())
    logs, rejected = [], 0
    for family in present:
        log, bad = write_family(load, arrived.where(F.col("family") == family), family, name)
        logs.append(log)
        rejected += bad
    if rejected and strict:
        raise RejectedBodies(f"{rejected} responses rejected in batch {name}")
    appended = append_manifest(union_facts(*logs), load.paths.manifest, manifest_format, batch=name) if logs else 0
    remove_table(spark, path)
    return appended


def ingest_stream(
    spark: SparkSession,
    landing: str,
    base: str,
    checkpoint: str,
    fmt: str = "json",
    max_files: int | None = None,
    manifest_format: str = "json",
    strict: bool = False,
    ingest_date: date | None = None,
) -> StreamingQuery:
    """Load whatever has arrived since the last run, then stop.

    The checkpoint remembers the files seen; ``max_files`` bounds a batch.
    Batches are named after the checkpoint's own id: a new checkpoint counts
    its batches from zero again and must not replace an older one's output.
    ``strict`` fails the query on a rejected response, as the batch load does.
    """
    arriving = stream_landed(spark, landing, fmt, max_files)

    def load(batch: DataFrame, batch_id: int) -> None:
        meta = batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata").first()
        ingest_batch(batch, batch_id, base, f"stream-{meta.id}", manifest_format, strict, ingest_date)

    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
