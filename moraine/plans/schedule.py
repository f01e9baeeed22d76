"""From a saved schedule week to the games worth loading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import path_schema, to_integer
from ..sources.endpoints import FINISHED_STATES

_GAME_PATHS = {
    "game_id": "id",
    "season": "season",
    "game_type": "gameType",
    "game_state": "gameState",
    "start_time_utc": "startTimeUTC",
}
_WEEK = T.StructType(
    [
        T.StructField(
            "gameWeek",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("date", T.StringType()),
                        T.StructField("games", T.ArrayType(path_schema(_GAME_PATHS.values()))),
                    ]
                )
            ),
        )
    ]
)


class ScheduleDayNotFound(LookupError):
    """A schedule week lacks the day it was requested for."""


def schedule_days(df: DataFrame, body: str = "response_json", keep: Sequence[str] = ()) -> DataFrame:
    """One row per day of each week: ``schedule_date`` and its ``games``."""
    weeks = df.select(*keep, F.explode(F.from_json(F.col(body), _WEEK)["gameWeek"]).alias("__day"))
    return weeks.select(
        *keep, F.to_date("__day.date").alias("schedule_date"), F.col("__day.games").alias("games")
    )


def schedule_games(
    df: DataFrame,
    day: Column,
    states: Sequence[str] | None = FINISHED_STATES,
    body: str = "response_json",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Games of ``day`` in the wanted states, in schedule order.

    The state alone decides; the game type is not looked at. ``position`` is
    the game's place within its day. ``states=None`` keeps every game.
    """
    games = (
        schedule_days(df, body, keep)
        .where(F.col("schedule_date") == day)
        .select(*keep, "schedule_date", F.posexplode("games").alias("position", "__game"))
        .select(
            *keep,
            "schedule_date",
            "position",
            *[F.col(f"__game.{path}").alias(name) for name, path in _GAME_PATHS.items()],
        )
        .withColumns(
            {
                "game_id": to_integer(F.col("game_id"), "bigint"),
                "game_type": to_integer(F.col("game_type")),
            }
        )
    )
    return games if states is None else games.where(F.col("game_state").isin(list(states)))


def weeks_without_day(df: DataFrame, day: Column, body: str = "response_json") -> DataFrame:
    """Weeks that do not hold the day asked for."""
    dates = F.transform(F.from_json(F.col(body), _WEEK)["gameWeek"], lambda d: F.to_date(d["date"]))
    held = F.coalesce(F.array_contains(dates, day), F.lit(False))
    return df.where(~held)


def require_days(df: DataFrame, day: Column, body: str = "response_json") -> None:
    """Raise unless every week holds the day it was requested for."""
    missing = weeks_without_day(df, day, body).select(day.cast("string").alias("d")).take(5)
    if missing:
        raise ScheduleDayNotFound(f"schedule lacks its requested day: {[r.d for r in missing]}")
