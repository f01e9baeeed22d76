"""Latest-row-per-key and duplicate-key operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_by(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Column | str,
    tie_break: Sequence[Column | str] = (),
) -> DataFrame:
    """Keep one row per key: the greatest ``order``, then ``tie_break`` in turn.

    ``tie_break`` entries are sort expressions (ascending unless they say
    otherwise). NULL keys form one group; a NULL ``order`` loses.

    ``row_number() = 1`` is planned as a group limit on both sides of the
    shuffle: each map task sends at most one row per key, so a key that holds
    a third of the table still reaches its reducer as one row per task.
    Project the frame to the columns needed before calling: what is in the
    frame is what gets shuffled.
    """
    rank = "__latest_rank"
    spec = Window.partitionBy(*[_col(k) for k in keys]).orderBy(
        _col(order).desc(), *[_col(t) for t in tie_break]
    )
    return df.withColumn(rank, F.row_number().over(spec)).where(F.col(rank) == 1).drop(rank)


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Keys seen more than once, with their row counts; NULL keys are ignored."""
    present = None
    for key in keys:
        check = F.col(key).isNotNull()
        present = check if present is None else present & check
    return (
        df.where(present)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(out))
        .where(F.col(out) > 1)
    )
