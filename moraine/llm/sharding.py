"""Proportional stratified interleaving into shards of equal row counts.

Rows are ranked within their source in a seeded order, turned into fractional
ranks, and the order of fractional ranks is cut into equal pieces: each piece
holds every source in proportion. Both rankings run in buckets of a uniform
key, whose counts give each bucket its first rank, so no task sees a whole
source however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 24
SEED = 17
# Buckets of each ranking. The counts per bucket are the only thing broadcast:
# at most this many rows of two numbers.
BUCKETS = 16384


def _uniform(*parts: Column) -> Column:
    """Hex digest that orders rows at random, the same way for the same seed."""
    return F.md5(F.concat_ws(":", *parts))


def _bucket(digest: Column, buckets: int) -> Column:
    first = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(first * buckets / F.lit(2**32)).cast("int")


def shard(
    docs: DataFrame,
    n_shards: int = SHARDS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, size, text_crc32, source, law, shard, slot, grown_shard) per row.

    Law ``rows``: counts of shards differ by one at most, slots are gapless
    from 0, and each source is spread over the shards in proportion. A null
    source is a source of its own; a null text has crc32 0 and size 8. Rows
    that tie in id are ordered by their text, and identical rows are
    interchangeable. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.col(source).alias("source"),
        F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source).cast("string"))).alias("stratum"),
    ).withColumn("h", _uniform(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("hb", _bucket(F.col("h"), buckets))

    # Rank within the source: rows of earlier buckets, then the place in the own one.
    counts = rows.groupBy("stratum", "hb").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("stratum").orderBy("hb").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("stratum")
    offsets = counts.select(
        "stratum",
        "hb",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("n_source"),
    )
    own = Window.partitionBy("stratum", "hb").orderBy("h", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("place", F.row_number().over(own)).join(offsets, ["stratum", "hb"])

    # A source's share of the way; its own offset spreads sources of few rows.
    shift = F.conv(F.substring(_uniform(F.lit(seed), F.col("stratum")), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    ranked = ranked.withColumn("f", (F.col("before") + F.col("place") - 1 + shift) / F.col("n_source"))
    ranked = ranked.withColumn("fb", F.least(F.floor(F.col("f") * buckets), F.lit(buckets - 1)).cast("int"))

    # Rank over all sources, the same way; the counts of at most `buckets` rows are broadcast.
    totals = ranked.groupBy("fb").agg(F.count(F.lit(1)).alias("n"))
    before_all = Window.orderBy("fb").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "fb",
        F.coalesce(F.sum("n").over(before_all), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy(F.lit(1))).alias("n_rows"),
    )
    within = Window.partitionBy("fb").orderBy("f", "stratum", "h", "doc_id", "text_crc32", "size")
    placed = (
        ranked.withColumn("at", F.row_number().over(within))
        .join(F.broadcast(starts), "fb")
        .withColumn("at", F.col("start") + F.col("at") - 1)
    )
    cut = F.call_function("div", F.col("at") * n_shards, F.col("n_rows"))
    first = F.call_function("div", F.col("shard_no") * F.col("n_rows") + n_shards - 1, F.lit(n_shards))
    return placed.withColumn("shard_no", cut).select(
        "doc_id",
        "size",
        "text_crc32",
        "source",
        F.lit("rows").alias("law"),
        F.col("shard_no").cast("int").alias("shard"),
        (F.col("at") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
