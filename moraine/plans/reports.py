"""Grouped, rolling and filtered totals over an expense-like table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import stored

ROWS = 100_000  # rows of a rolling mean that one task sees, about
RECURRING_LENGTH = 7  # YYYY-MM; one-off entries carry a full date


def period_totals(df: DataFrame, keys: Sequence[str], value: str, out: str = "total") -> DataFrame:
    """Sum per key combination, latest first key first, then largest total."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias(out))
    return totals.orderBy(F.col(keys[0]).desc(), F.col(out).desc())


def recurring(df: DataFrame, period: str, length: int = RECURRING_LENGTH) -> DataFrame:
    return df.where(F.length(period) == length)


def total_like(df: DataFrame, period: str, pattern: str, value: str, out: str = "total") -> DataFrame:
    """One row: the sum of ``value`` where ``period`` matches ``pattern``."""
    return df.where(F.col(period).like(pattern)).agg(F.sum(value).alias(out))


def rolling_mean(
    df: DataFrame, order: str, value: str, n: int = 3, out: str = "rolling_mean", rows: int = ROWS
) -> DataFrame:
    """Mean of ``value`` over the current and the ``n - 1`` preceding rows.

    ``order`` is unique. The frame spans the whole table without a grouping
    key, which as a plain window would be one task. Instead every row gets its
    rank, ranks are cut into blocks of ``rows`` (``n`` at least), and the last
    ``n - 1`` rows of a block are copied into the next one. Whole numbers and
    decimals are summed by running totals. Floating point values, which
    differences of totals would blur, are only ever added: ranks are cut into
    runs of ``n``, and a frame is the end of one run and the beginning of the
    next. The work for a row does not depend on ``n`` either way.
    """
    ranked = _ranked(df, order)
    size = F.lit(max(n, rows)).cast("bigint")
    block = F.call_function("div", F.col("__rank"), size)
    later = F.call_function("div", F.col("__rank") + (n - 1), size)
    blocks = F.when(later > block, F.array(block, block + 1)).otherwise(F.array(block))
    dealt = ranked.select("*", F.posexplode(blocks).alias("__copy", "__block"))
    within = Window.partitionBy("__block").orderBy("__rank")
    kind = df.select(F.avg(value).alias("m")).schema["m"].dataType
    if isinstance(df.schema[value].dataType, (T.IntegralType, T.DecimalType)):
        so_far = within.rowsBetween(Window.unboundedPreceding, 0)
        exact = F.col(value).cast(f"decimal(38,{getattr(df.schema[value].dataType, 'scale', 0)})")
        dealt = dealt.withColumns({"__sum": F.sum(exact).over(so_far), "__n": F.count(value).over(so_far)})
        span = lambda c: F.coalesce(c, F.lit(0)) - F.coalesce(F.lag(c, n).over(within), F.lit(0))
        count = span(F.col("__n"))
        total = span(F.col("__sum"))
        total = total.cast(kind) if isinstance(kind, T.DoubleType) else total
        mean = F.when(count > 0, total / count).cast(kind)
    else:
        dealt = dealt.repartition("__block").withColumn("__run", F.call_function("div", F.col("__rank"), F.lit(n)))
        number = F.col(value).cast("double")
        for name, order_in_run in (("head", F.asc("__rank")), ("tail", F.desc("__rank"))):
            so_far = Window.partitionBy("__block", "__run").orderBy(order_in_run).rowsBetween(Window.unboundedPreceding, 0)
            dealt = dealt.withColumns({f"__{name}": F.sum(number).over(so_far), f"__{name}_n": F.count(value).over(so_far)})
        # A frame that ends with its run needs nothing of the run before.
        whole = F.col("__rank") % n == n - 1
        before = lambda c: F.when(whole, F.lit(0)).otherwise(F.coalesce(F.lag(c, n - 1).over(within), F.lit(0)))
        count = F.col("__head_n") + before("__tail_n")
        total = F.coalesce("__head", F.lit(0.0)) + before("__tail")
        mean = F.when(count > 0, total / count).cast(kind)
    return dealt.withColumn(out, mean).where(F.col("__copy") == 0).select(*df.columns, out)


def _ranked(df: DataFrame, order: str) -> DataFrame:
    """The rows, stored once in ranges of ``order``, with ``__rank`` from 0.

    A row's rank is its place in its range plus the rows of earlier ranges;
    one task sees the count of each range, no more.
    """
    ranges = stored(df.repartitionByRange(F.col(order)).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(order)) - 1
    ranked = ranges.withColumn("__place", place).join(starts, "__range")
    return ranked.withColumn("__rank", F.col("__before") + F.col("__place")).drop("__range", "__before", "__place")
