"""The star schema: dimensions and facts, with fixed column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import json_object
from ..functions.text import alias_or_replace, surrogate_key, winner

# Fixed values.
LEAGUE_ID = 1
EVENT_ALIASES = {"shot-on-goal": "shot"}
UNKNOWN_TEXT = ["arena_name", "city", "state_province", "country_code"]


def dim_team(team_spine: DataFrame) -> DataFrame:
    return team_spine.select(
        "team_id",
        F.lit(LEAGUE_ID).alias("league_id"),
        "team_abbrev",
        "team_full_name",
        *[F.lit(None).cast("string").alias(name) for name in UNKNOWN_TEXT],
        json_object(nhl_api_team_id=F.col("team_id")).alias("external_ids"),
    )


def dim_player(player_spine: DataFrame) -> DataFrame:
    return player_spine.select(
        "player_id",
        "full_name",
        "first_name",
        "last_name",
        "position_group",
        "position_code",
        "shoots_catches",
        "height_in",
        "weight_lb",
        "birth_date",
        "birth_country",
        json_object(nhl_api_player_id=F.col("player_id")).alias("external_ids"),
    )


def fct_game(landing: DataFrame) -> DataFrame:
    return landing.select(
        "game_id",
        F.lit(LEAGUE_ID).alias("league_id"),
        "season",
        F.col("start_time_utc").alias("game_datetime_utc"),
        "home_team_id",
        "away_team_id",
        F.col("home_team_id").alias("venue_team_id"),
        "game_type",
        F.col("game_state").alias("status"),
    )


def fct_game_outcome(landing: DataFrame) -> DataFrame:
    winning_team, home_win = winner(
        F.col("home_score"), F.col("away_score"), F.col("home_team_id"), F.col("away_team_id")
    )
    return landing.select(
        "game_id",
        F.col("home_score").alias("home_goals"),
        F.col("away_score").alias("away_goals"),
        F.col("final_period_type").alias("period_end"),
        winning_team.alias("winning_team_id"),
        home_win.alias("home_win"),
    )


def fct_game_event(game_events: DataFrame) -> DataFrame:
    return game_events.select(
        "game_id",
        "period",
        "period_time_elapsed_s",
        "x_coord",
        "y_coord",
        F.col("event_team_id").alias("team_id"),
        "primary_player_id",
        "secondary_player_id",
        "details_json",
        surrogate_key(F.col("game_id"), F.col("event_sequence")).alias("event_id"),
        alias_or_replace(F.col("type_desc_key"), EVENT_ALIASES, "-", "_").alias("event_type"),
    )


def fct_game_lineup(players: DataFrame) -> DataFrame:
    """Skaters and goalies; read in one pass rather than as a union of two."""
    return players.select(
        surrogate_key(F.col("game_id"), F.col("player_id")).alias("lineup_id"),
        "game_id",
        "team_id",
        "player_id",
        "position_type",
        "toi_s",
        "goals",
        "assists",
        "shots",
        "saves",
        "goals_against",
    )
