"""Which scope units a load has to work on, and how each one fares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import active_members, season_dates, season_start_year
from ..operators.joins import complete_units

SKIPPED, LOADED, WAITING = "skipped", "loaded", "waiting"


def team_season_units(seasons: DataFrame) -> DataFrame:
    """One unit per season and team active in it; key ``season|team``."""
    teams = active_members(seasons.select("season"), season_start_year(F.col("season")))
    return teams.withColumn("scope_key", F.concat_ws("|", "season", "team"))


def summary_units(seasons: DataFrame) -> DataFrame:
    """One unit per season."""
    return seasons.select("season", F.col("season").alias("scope_key"))


def game_day_units(seasons: DataFrame) -> DataFrame:
    """One unit per calendar day of each season's window; key is the ISO date."""
    days = season_dates(seasons.select("season"))
    return days.withColumn("scope_key", F.col("game_date").cast("string"))


def plan_units(
    units: DataFrame, manifest: DataFrame, endpoints: Sequence[str], arrived: DataFrame | None = None
) -> DataFrame:
    """Give each unit a ``state``.

    ``skipped``: the manifest has an ``ok`` row for every endpoint. Otherwise
    ``loaded`` if a response for it has arrived, else ``waiting``. A unit with
    some endpoints done counts as not done and is loaded whole.
    """
    done = complete_units(manifest, endpoints).withColumn("__done", F.lit(True))
    planned = units.join(done, "scope_key", "left")
    pending = F.lit(LOADED)
    if arrived is not None:
        seen = arrived.select("scope_key").distinct().withColumn("__arrived", F.lit(True))
        planned = planned.join(seen, "scope_key", "left")
        pending = F.when(F.col("__arrived"), F.lit(LOADED)).otherwise(F.lit(WAITING))
    state = F.when(F.col("__done"), F.lit(SKIPPED)).otherwise(pending)
    return planned.withColumn("state", state).select(*units.columns, "state")


def in_work_order(units: DataFrame, *keys: str) -> DataFrame:
    """Early seasons first, then teams or days ascending."""
    return units.orderBy(*keys)


def phase_counts(planned: DataFrame, keys: Sequence[str] = ("phase",)) -> DataFrame:
    """Attempted, skipped, loaded and waiting units per phase."""
    state = F.col("state")
    return planned.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(state == SKIPPED).alias("skipped"),
        F.count_if(state == LOADED).alias("loaded"),
        F.count_if(state == WAITING).alias("waiting"),
    )
