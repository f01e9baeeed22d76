"""All models wired together: as lazy frames, or written as tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources import endpoints as E
from ..sources.bronze import read_bronze
from ..sources.tables import dim_league, dim_sport
from . import core, intermediate, staging

# Model, the family it stages.
STAGING: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "stg_landing": (staging.stg_landing, E.LANDING),
    "stg_boxscore": (staging.stg_boxscore, E.BOXSCORE),
    "stg_play_by_play": (staging.stg_play_by_play, E.PLAY_BY_PLAY),
    "stg_skater_summary": (staging.stg_skater_summary, E.SKATER_SUMMARY),
    "stg_goalie_summary": (staging.stg_goalie_summary, E.GOALIE_SUMMARY),
    "stg_team_summary": (staging.stg_team_summary, E.TEAM_SUMMARY),
    "stg_roster": (staging.stg_roster, E.ROSTER),
    "stg_club_schedule_season": (staging.stg_club_schedule_season, E.CLUB_SCHEDULE),
}
# Model, its function, the models it reads; in an order that respects them.
INTERMEDIATE = {
    "int_game_events": (intermediate.int_game_events, ["stg_play_by_play"]),
    "int_game_players": (intermediate.game_players, ["stg_boxscore"]),
    "int_game_skater_stats": (intermediate.int_game_skater_stats, ["int_game_players"]),
    "int_game_goalie_stats": (intermediate.int_game_goalie_stats, ["int_game_players"]),
    "int_player_spine": (
        intermediate.int_player_spine,
        ["stg_roster", "stg_skater_summary", "stg_goalie_summary"],
    ),
    "int_team_spine": (intermediate.int_team_spine, ["stg_landing", "stg_team_summary"]),
}
CORE = {
    "dim_team": (core.dim_team, ["int_team_spine"]),
    "dim_player": (core.dim_player, ["int_player_spine"]),
    "fct_game": (core.fct_game, ["stg_landing"]),
    "fct_game_outcome": (core.fct_game_outcome, ["stg_landing"]),
    "fct_game_event": (core.fct_game_event, ["int_game_events"]),
    "fct_game_lineup": (core.fct_game_lineup, ["int_game_players"]),
}
# Model, how to build it straight from bronze, the family, the staging model
# that is used instead if it is stored.
DIRECT = {
    "int_game_events": (intermediate.bronze_game_events, E.PLAY_BY_PLAY, "stg_play_by_play"),
    "int_game_players": (intermediate.bronze_game_players, E.BOXSCORE, "stg_boxscore"),
}


SEEDS = {"dim_sport": dim_sport, "dim_league": dim_league}
MODELS = [*SEEDS, *STAGING, *INTERMEDIATE, *CORE]


class Models:
    """The models over one lake as lazy frames, each defined on first use.

    ``bronze`` gives a family's envelope frame; ``known`` holds frames to use
    as they are, such as tables that are already stored.
    """

    def __init__(
        self,
        spark: SparkSession,
        bronze: Callable[[str], DataFrame],
        known: Mapping[str, DataFrame] | None = None,
    ):
        self._spark = spark
        self._bronze = bronze
        self._known = dict(known or {})
        self._frames = dict(self._known)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._define(name)
        return self._frames[name]

    def using(self, known: Mapping[str, DataFrame]) -> Models:
        """The same models, with ``known`` in place of their definitions."""
        return Models(self._spark, self._bronze, known)

    def _define(self, name: str) -> DataFrame:
        if name in SEEDS:
            return SEEDS[name](self._spark)
        if name in STAGING:
            build, family = STAGING[name]
            return build(self._bronze(family))
        if name in DIRECT and DIRECT[name][2] not in self._known:
            build, family, _ = DIRECT[name]
            return build(self._bronze(family))
        build, inputs = (INTERMEDIATE | CORE)[name]
        return build(*[self[i] for i in inputs])


def lake_models(spark: SparkSession, base: str, since=None, until=None) -> Models:
    """Models over a stored lake, optionally of some ingest dates only."""
    return Models(spark, lambda family: read_bronze(spark, base, family, since, until))


def create_views(models: Models, names: list[str] = MODELS) -> None:
    """Register models for SQL users."""
    for name in names:
        models[name].createOrReplaceTempView(name)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace one stored table and return it as stored."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_models(models: Models, names: Sequence[str], path_of: Callable[[str], str]) -> Models:
    """Store the named models under ``path_of(name)``, in dependency order.

    Each one reads the models stored before it, so a staging table that several
    models read is computed once and no lineage grows long.
    """
    kept: dict[str, DataFrame] = {}
    for name in [m for m in MODELS if m in names]:
        kept[name] = write_table(models.using(kept)[name], path_of(name))
    return models.using(kept)


def build_silver(spark: SparkSession, base: str, out: str) -> Models:
    """Build the star schema from a whole lake: ``out/staging/*`` and ``out/core/*``.

    Tables are replaced whole, so they are built from all ingest dates;
    ``lake_models`` reads a period without storing it.
    """
    layer = lambda name: "staging" if name in STAGING else "core"
    return store_models(
        lake_models(spark, base),
        [*SEEDS, *STAGING, *CORE],
        lambda name: f"{out.rstrip('/')}/{layer(name)}/{name}",
    )
