"""Dense numbers in a sort order, without a task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.sources.shared import stored

_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below


def numbered(df: DataFrame, order: list[Column], name: str = "nr") -> DataFrame:
    """``df`` with ``name``: 1, 2, 3 ... in the given order.

    The sort is written once, so that a place and its partition stay what they
    are; what leaves a partition is its row count alone. Rows that tie in the
    whole order are numbered in any order. An empty table gives no rows.
    """
    sorted_rows = stored(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", _BITS)
    before, counts = 0, []
    for row in sorted_rows.groupBy(part.alias("part")).count().orderBy("part").collect():
        counts.append((row["part"], before))
        before += row["count"]
    # One row per partition of the sort.
    starts = df.sparkSession.createDataFrame(counts, "_part long, _before long")
    place = F.col("_at") - F.shiftleft("_part", _BITS) + F.col("_before") + 1
    joined = sorted_rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn(name, place).drop("_part", "_before", "_at")
