"""Reusable steps between staging and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import json_texts, to_integer
from ..functions.text import clock_to_seconds, first_non_null, joined_name
from ..operators.dedup import latest_by
from ..operators.joins import enrich_left, spine_left_join
from ..operators.unnest import (
    element_columns,
    element_type,
    explode_arrays,
    explode_groups,
    unnest_json,
    unpivot,
)
from .staging import latest_games

# Members of a play's details, in the order they name a participant.
PRIMARY_PLAYER = [
    "scoringPlayerId",
    "shootingPlayerId",
    "hittingPlayerId",
    "blockingPlayerId",
    "winningPlayerId",
    "committedByPlayerId",
    "playerId",
]
SECONDARY_PLAYER = [
    "assist1PlayerId",
    "goalieInNetId",
    "hitteePlayerId",
    "losingPlayerId",
    "drawnByPlayerId",
]
# Summary position code to position group.
FORWARD_CODES = ["C", "L", "R"]
DEFENSE_CODE = "D"


# Members read of a play, and of a player's line in a boxscore.
PLAY = {
    "type_desc_key": "typeDescKey",
    "period_type": "periodDescriptor.periodType",
    "time_in_period_raw": "timeInPeriod",
    "event_sequence": "eventId",
    "period": "periodDescriptor.number",
    "details_json": "details",
}
PLAYER_LINE = {
    "player_id": "playerId",
    "toi": "toi",
    "goals": "goals",
    "assists": "assists",
    "shots": "sog",
    "saves": "saves",
    "goals_against": "goalsAgainst",
}
# Array of players in a boxscore side, position type.
BOXSCORE_GROUPS = {"forwards": "F", "defense": "D", "goalies": "G"}
SIDES = ("away", "home")


def int_game_events(play_by_play: DataFrame) -> DataFrame:
    """One row per play. Plays without details have no team, place or players."""
    return _events(unnest_json(play_by_play.select("game_id", "plays_json"), "plays_json", PLAY))


def bronze_game_events(bronze: DataFrame) -> DataFrame:
    """``int_game_events`` straight from bronze.

    Where staging is not stored, going through its JSON text would parse the
    plays a second time. Here the plays are read in the body's only parse.
    """
    plays = latest_games(bronze, {"plays": "plays"}, {"plays": T.ArrayType(element_type(PLAY))})
    rows = plays.select("game_id", F.explode("plays").alias("__play"))
    return _events(rows.select("game_id", *element_columns("__play", PLAY)))


def _events(plays: DataFrame) -> DataFrame:
    numbers = {
        "event_team_id": "eventOwnerTeamId",
        "x_coord": "xCoord",
        "y_coord": "yCoord",
        **{p: p for p in PRIMARY_PLAYER + SECONDARY_PLAYER},
    }
    opened = json_texts(plays, "details_json", numbers, plays.columns)
    number = lambda name: to_integer(F.col(name)).alias(name)
    return opened.select(
        "game_id",
        "type_desc_key",
        "period_type",
        "time_in_period_raw",
        number("event_sequence"),
        number("period"),
        number("event_team_id"),
        number("x_coord"),
        number("y_coord"),
        "details_json",
        clock_to_seconds(F.col("time_in_period_raw")).alias("period_time_elapsed_s"),
        # Pick among the texts, then cast once.
        to_integer(first_non_null(*map(F.col, PRIMARY_PLAYER))).alias("primary_player_id"),
        to_integer(first_non_null(*map(F.col, SECONDARY_PLAYER))).alias("secondary_player_id"),
    )


def game_players(boxscore: DataFrame) -> DataFrame:
    """Skaters and goalies of both sides in one pass over the boxscores.

    Statistics of the other role are NULL.
    """
    groups = [
        (f"{side}Team.{array}", {"team_id": F.col(f"{side}_team_id"), "position_type": F.lit(role)})
        for side in SIDES
        for array, role in BOXSCORE_GROUPS.items()
    ]
    rows = explode_groups(
        boxscore.select("game_id", "away_team_id", "home_team_id", "player_by_game_stats_json"),
        "player_by_game_stats_json",
        groups,
        PLAYER_LINE,
        keep=["game_id"],
    )
    return _players(rows)


def bronze_game_players(bronze: DataFrame) -> DataFrame:
    """``game_players`` straight from bronze, with the body's only parse.

    Just the members that are read travel through the dedup's shuffle.
    """
    teams = {f"{side}_team_id": f"{side}Team.id" for side in SIDES}
    arrays = {
        f"{side}_{array}": f"playerByGameStats.{side}Team.{array}"
        for side in SIDES
        for array in BOXSCORE_GROUPS
    }
    kind = T.ArrayType(element_type(PLAYER_LINE))
    games = latest_games(bronze, teams | arrays, dict.fromkeys(arrays, kind))
    typed = games.withColumns({team: to_integer(F.col(team)) for team in teams})
    groups = [
        (F.col(f"{side}_{array}"), {"team_id": F.col(f"{side}_team_id"), "position_type": F.lit(role)})
        for side in SIDES
        for array, role in BOXSCORE_GROUPS.items()
    ]
    return _players(explode_arrays(typed, groups, PLAYER_LINE, keep=["game_id"]))


def _players(rows: DataFrame) -> DataFrame:
    goalie = F.col("position_type") == "G"

    def stat(name: str, for_goalie: bool):
        return F.when(goalie if for_goalie else ~goalie, to_integer(F.col(name))).alias(name)

    return rows.select(
        "game_id",
        "team_id",
        "position_type",
        to_integer(F.col("player_id")).alias("player_id"),
        clock_to_seconds(F.col("toi")).alias("toi_s"),
        *[stat(name, False) for name in ("goals", "assists", "shots")],
        *[stat(name, True) for name in ("saves", "goals_against")],
    )


def int_game_skater_stats(players: DataFrame) -> DataFrame:
    """One row per (game, skater)."""
    return players.where(F.col("position_type") != "G").drop("saves", "goals_against")


def int_game_goalie_stats(players: DataFrame) -> DataFrame:
    """One row per (game, goalie); goalies who did not play keep their zeros."""
    return players.where(F.col("position_type") == "G").drop("goals", "assists", "shots")


def int_player_spine(roster: DataFrame, skater_summary: DataFrame, goalie_summary: DataFrame) -> DataFrame:
    """One row per player seen in a roster or a season summary.

    "Latest" means the latest fetch, not the latest season. Names and positions
    come from the roster where it has them, else from the summaries.
    """

    def latest(df: DataFrame, columns: list[str], ties: list[str]) -> DataFrame:
        seen = df.where(F.col("player_id").isNotNull())
        return latest_by(seen, ["player_id"], "fetched_at_utc", ties).select("player_id", *columns)

    bio = [
        "first_name",
        "last_name",
        "position_group",
        "position_code",
        "shoots_catches",
        "height_in",
        "weight_lb",
        "birth_date",
        "birth_country",
    ]
    season_last = F.col("season").desc()
    joined = spine_left_join(
        "player_id",
        {
            "r": latest(roster, bio, [season_last, "team_abbrev"]),
            "s": latest(skater_summary, ["skater_full_name", "position_code"], [season_last]),
            "g": latest(goalie_summary, ["goalie_full_name"], [season_last]),
        },
    )
    summary_group = (
        F.when(F.col("s.position_code").isin(FORWARD_CODES), F.lit("F"))
        .when(F.col("s.position_code") == DEFENSE_CODE, F.lit("D"))
        .when(F.col("g.player_id").isNotNull(), F.lit("G"))
    )
    return joined.select(
        "player_id",
        *[F.col(f"r.{c}").alias(c) for c in bio if not c.startswith("position")],
        first_non_null(
            joined_name(F.col("r.first_name"), F.col("r.last_name")),
            F.col("s.skater_full_name"),
            F.col("g.goalie_full_name"),
        ).alias("full_name"),
        first_non_null(F.col("r.position_group"), summary_group).alias("position_group"),
        first_non_null(F.col("r.position_code"), F.col("s.position_code")).alias("position_code"),
    )


def int_team_spine(landing: DataFrame, team_summary: DataFrame) -> DataFrame:
    """One row per team seen in a game, with its latest code and full name."""
    sides = unpivot(
        landing,
        [
            {"team_id": F.col(f"{side}_team_id"), "team_abbrev": F.col(f"{side}_team_abbrev")}
            for side in ("home", "away")
        ],
        keep=["fetched_at_utc", "game_id"],
    )
    codes = latest_by(
        sides.where(F.col("team_id").isNotNull()),
        ["team_id"],
        "fetched_at_utc",
        [F.col("game_id").desc(), "team_abbrev"],
    ).select("team_id", "team_abbrev")
    names = latest_by(
        team_summary.where(F.col("team_id").isNotNull()),
        ["team_id"],
        "fetched_at_utc",
        [F.col("season").desc()],
    ).select("team_id", "team_full_name")
    return enrich_left(codes, names, "team_id")
