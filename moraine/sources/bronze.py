"""The raw layer: one row per fetched response, in date-partitioned Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import canonical_json
from .endpoints import LakePaths

ENVELOPE = T.StructType(
    [
        T.StructField("entity_id", T.StringType(), False),
        T.StructField("season", T.StringType(), True),
        T.StructField("event_date", T.DateType(), True),
        T.StructField("endpoint", T.StringType(), False),
        T.StructField("endpoint_params_json", T.StringType(), False),
        T.StructField("fetched_at_utc", T.TimestampType(), False),
        T.StructField("response_json", T.StringType(), False),
        T.StructField("response_sha256", T.StringType(), False),
    ]
)
PARTITIONED = T.StructType([*ENVELOPE.fields, T.StructField("ingest_date", T.DateType(), True)])
ZSTD = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3"}


@dataclass(frozen=True)
class WriteResult:
    """``bytes`` is the stored (compressed) size, ``body_bytes`` the raw one."""

    key: str
    rows: int
    bytes: int
    body_bytes: int

    @property
    def compression(self) -> float:
        return self.bytes / self.body_bytes if self.body_bytes else 0.0


def to_envelope(
    df: DataFrame,
    endpoint: str,
    entity: Column,
    params: Mapping[str, Column],
    fetched_at: Column,
    body: str = "response_json",
    season: Column | None = None,
    event_date: Column | None = None,
    sha256: Column | None = None,
) -> DataFrame:
    """Responses to envelope rows. ``endpoint`` is the template, not a filled URL.

    ``fetched_at`` must be an instant: a timestamp without time zone is refused.
    """
    kind = df.select(fetched_at.alias("t")).schema["t"].dataType
    if not isinstance(kind, T.TimestampType):
        raise ValueError(f"fetched_at must be an instant (timestamp), got {kind.simpleString()}")
    text = F.col(body)
    digest = F.sha2(text, 256) if sha256 is None else F.coalesce(sha256, F.sha2(text, 256))
    return df.select(
        entity.cast("string").alias("entity_id"),
        (F.lit(None) if season is None else season).cast("string").alias("season"),
        (F.lit(None) if event_date is None else event_date).cast("date").alias("event_date"),
        F.lit(endpoint).alias("endpoint"),
        canonical_json(**params).alias("endpoint_params_json"),
        fetched_at.alias("fetched_at_utc"),
        text.alias("response_json"),
        digest.alias("response_sha256"),
    )


def partition_path(base: str, family: str, ingest_date: date | str, file_id: str) -> str:
    return f"{LakePaths(base).family(family)}/ingest_date={ingest_date}/{file_id}.parquet"


def write_bronze(
    df: DataFrame,
    base: str,
    family: str,
    ingest_date: date | str,
    file_id: str | None = None,
    allow_empty: bool = False,
) -> WriteResult:
    """Write envelope rows under one partition of one family.

    Each call owns one dataset folder. A new ``file_id`` is drawn unless one is
    given; writing the same ``file_id`` again replaces exactly those rows.
    A NULL in a required column fails the write, and so does empty input unless
    ``allow_empty``. Row and raw byte counts come from the write itself; the
    stored size reads file metadata, no column.
    """
    key = partition_path(base, family, ingest_date, file_id or uuid.uuid4().hex)
    required = [f.name for f in ENVELOPE.fields if not f.nullable]
    checked = df.select(
        *[
            F.coalesce(F.col(f.name), F.raise_error(F.lit(f"{f.name} must not be NULL"))).alias(f.name)
            if f.name in required
            else F.col(f.name)
            for f in ENVELOPE.fields
        ]
    )
    seen = Observation()
    # Rebalanced by size: many small tasks do not become as many small files.
    counted = checked.hint("rebalance").observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length("response_json")), F.lit(0)).alias("body_bytes"),
    )
    counted.write.mode("overwrite").options(**ZSTD).parquet(key)
    got = seen.get
    if not got["rows"] and not allow_empty:
        raise ValueError(f"no rows to write to {key}")
    return WriteResult(
        key, int(got["rows"]), stored_bytes(df.sparkSession, key), int(got["body_bytes"])
    )


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the Parquet files under ``path`` that hold rows."""
    files = spark.read.schema(ENVELOPE).parquet(path).select("_metadata.file_path", "_metadata.file_size")
    total = files.distinct().agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("n"))
    return int(total.first()["n"])


def read_bronze(
    spark: SparkSession,
    base: str,
    family: str,
    since: date | str | None = None,
    until: date | str | None = None,
) -> DataFrame:
    """All envelope rows of a family, with ``ingest_date`` from the path.

    ``since``/``until`` (inclusive) prune partitions before any file is opened.
    """
    df = spark.read.schema(PARTITIONED).parquet(LakePaths(base).family(family))
    if since is not None:
        df = df.where(F.col("ingest_date") >= F.lit(str(since)).cast("date"))
    if until is not None:
        df = df.where(F.col("ingest_date") <= F.lit(str(until)).cast("date"))
    return df


def bronze_digests(spark: SparkSession, base: str, family: str, without: str) -> DataFrame:
    """Keys, fetch times and digests of a family's stored rows, except files whose path holds ``without``.

    A family of which nothing is stored yet has no rows.
    """
    try:
        stored = read_bronze(spark, base, family)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "entity_id string, season string, fetched_at_utc timestamp, response_sha256 string")
    rows = stored.select(
        "entity_id", "season", "fetched_at_utc", "response_sha256", F.col("_metadata.file_path").alias("path")
    )
    return rows.where(~F.col("path").contains(without)).drop("path")
