"""Declared tests of every table. Fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.quality import Contract, run_tests

_STATES = ("FINAL", "OFF")
_TYPES = (2, 3)
_GROUPS = ("F", "D", "G")
_GAME_STAGE = (
    "game_id", "season", "game_type", "game_date", "game_state", "start_time_utc",
    "away_team_id", "away_team_abbrev", "home_team_id", "home_team_abbrev",
)
_FETCH = ("ingest_date", "fetched_at_utc")
_GAME_VALUES = {"game_type": _TYPES, "game_state": _STATES}

CONTRACTS: dict[str, Contract] = {
    # Seeds
    "dim_sport": Contract(("sport_id", "sport_name", "sport_slug"), ("sport_id", "sport_slug")),
    "dim_league": Contract(
        ("league_id", "sport_id", "league_name", "league_abbreviation", "country_code"),
        ("league_id",),
        relationships={"sport_id": ("dim_sport", "sport_id")},
    ),
    # Staging
    "stg_landing": Contract((*_GAME_STAGE, *_FETCH), ("game_id",), _GAME_VALUES),
    "stg_boxscore": Contract(
        (*_GAME_STAGE, "player_by_game_stats_json", *_FETCH), ("game_id",), _GAME_VALUES
    ),
    "stg_play_by_play": Contract(
        (*_GAME_STAGE, "play_count", "plays_json", *_FETCH), ("game_id",), _GAME_VALUES
    ),
    "stg_skater_summary": Contract(
        ("season", "player_id", "games_played", "goals", "assists", "points", *_FETCH)
    ),
    "stg_goalie_summary": Contract(("season", "player_id", "games_played", *_FETCH)),
    "stg_team_summary": Contract(("season", "team_id", "games_played", *_FETCH)),
    "stg_roster": Contract(
        ("season", "team_abbrev", "player_id", "position_group", *_FETCH),
        accepted={"position_group": _GROUPS},
    ),
    "stg_club_schedule_season": Contract(("season", "team_abbrev", "games_json", *_FETCH)),
    # Intermediate
    "int_team_spine": Contract(("team_id", "team_abbrev"), ("team_id",)),
    "int_player_spine": Contract(
        ("player_id", "full_name"), ("player_id",), {"position_group": _GROUPS}
    ),
    "int_game_skater_stats": Contract(
        ("game_id", "team_id", "player_id", "position_type", "toi_s"),
        accepted={"position_type": ("F", "D")},
    ),
    "int_game_goalie_stats": Contract(
        ("game_id", "team_id", "player_id", "position_type", "toi_s"),
        accepted={"position_type": ("G",)},
    ),
    # Core
    "dim_team": Contract(
        ("team_id", "league_id", "team_abbrev", "external_ids"),
        ("team_id",),
        relationships={"league_id": ("dim_league", "league_id")},
    ),
    "dim_player": Contract(
        ("player_id", "full_name", "external_ids"), ("player_id",), {"position_group": _GROUPS}
    ),
    "fct_game": Contract(
        (
            "game_id", "league_id", "season", "game_datetime_utc", "home_team_id",
            "away_team_id", "venue_team_id", "game_type", "status",
        ),
        ("game_id",),
        {"game_type": _TYPES, "status": _STATES},
        {
            "league_id": ("dim_league", "league_id"),
            "home_team_id": ("dim_team", "team_id"),
            "away_team_id": ("dim_team", "team_id"),
            "venue_team_id": ("dim_team", "team_id"),
        },
    ),
    "fct_game_outcome": Contract(
        ("game_id", "home_goals", "away_goals", "winning_team_id", "period_end", "home_win"),
        ("game_id",),
        {"period_end": ("REG", "OT", "SO")},
        {"game_id": ("fct_game", "game_id"), "winning_team_id": ("dim_team", "team_id")},
    ),
    "fct_game_event": Contract(
        ("event_id", "game_id", "period", "period_time_elapsed_s", "event_type"),
        ("event_id",),
        {},
        {
            "game_id": ("fct_game", "game_id"),
            "team_id": ("dim_team", "team_id"),
            "primary_player_id": ("dim_player", "player_id"),
            "secondary_player_id": ("dim_player", "player_id"),
        },
    ),
    "fct_game_lineup": Contract(
        ("lineup_id", "game_id", "team_id", "player_id", "position_type", "toi_s"),
        ("lineup_id",),
        {"position_type": _GROUPS},
        {
            "game_id": ("fct_game", "game_id"),
            "team_id": ("dim_team", "team_id"),
            "player_id": ("dim_player", "player_id"),
        },
    ),
}


def check_table(name: str, tables) -> DataFrame:
    """``(model, column, test, failures)`` of one table's declared tests."""
    return check_tables(tables, [name])


def check_tables(tables, names=tuple(CONTRACTS)) -> DataFrame:
    """Results of the declared tests of the named tables, each table scanned once.

    ``tables`` gives frames by name: a dict or ``Models``.
    """
    return run_tests(tables, {name: CONTRACTS[name] for name in names})
