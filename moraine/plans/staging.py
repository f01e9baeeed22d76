"""Typed staging frames over bronze, one per response family.

Each function takes the family's bronze envelope (see ``read_bronze``) and
returns a lazy frame. The shape is always: one parse in the map stage, dedup on
narrow extracted texts, strict casts last on the surviving rows only. Bodies
are never shuffled unless a column that holds most of the body is selected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import cast_text, json_len, json_text, json_texts, to_integer
from ..functions.text import digest_bytes
from ..operators.dedup import latest_by
from ..operators.unnest import explode_groups, unnest_json
from ..sources.endpoints import COMPETITIVE_TYPES

Field = tuple[str, str, bool]  # dotted path, type, strict cast
BODY = "response_json"
FETCH = ["ingest_date", "fetched_at_utc", "response_sha256"]

# Output column, path in the body, type, strict cast.
GAME_FIELDS: dict[str, Field] = {
    "game_id": ("id", "bigint", True),
    "game_type": ("gameType", "int", True),
    "game_date": ("gameDate", "date", True),
    "start_time_utc": ("startTimeUTC", "timestamp", True),
    "away_team_id": ("awayTeam.id", "int", True),
    "home_team_id": ("homeTeam.id", "int", True),
    "season": ("season", "string", True),
    "game_state": ("gameState", "string", True),
    "away_team_abbrev": ("awayTeam.abbrev", "string", True),
    "home_team_abbrev": ("homeTeam.abbrev", "string", True),
}
LANDING_FIELDS: dict[str, Field] = {
    **GAME_FIELDS,
    "away_score": ("awayTeam.score", "int", True),
    "home_score": ("homeTeam.score", "int", True),
    "reg_periods": ("regPeriods", "int", True),
    "ot_in_use": ("otInUse", "boolean", True),
    "shootout_in_use": ("shootoutInUse", "boolean", True),
    "venue_name": ("venue.default", "string", True),
    "venue_timezone": ("venueTimezone", "string", True),
    "final_period_type": ("periodDescriptor.periodType", "string", True),
}
BOXSCORE_FIELDS: dict[str, Field] = {
    **GAME_FIELDS,
    "player_by_game_stats_json": ("playerByGameStats", "string", True),
    "last_period_type": ("gameOutcome.lastPeriodType", "string", True),
    "ot_periods": ("gameOutcome.otPeriods", "int", False),
}
PLAY_BY_PLAY_FIELDS: dict[str, Field] = {
    **GAME_FIELDS,
    "plays_json": ("plays", "string", True),
    "roster_spots_json": ("rosterSpots", "string", True),
}
SKATER_FIELDS: dict[str, Field] = {
    "player_id": ("playerId", "int", True),
    "games_played": ("gamesPlayed", "int", True),
    "goals": ("goals", "int", True),
    "assists": ("assists", "int", True),
    "points": ("points", "int", True),
    "season": ("seasonId", "string", True),
    "skater_full_name": ("skaterFullName", "string", True),
    "team_abbrevs": ("teamAbbrevs", "string", True),
    "position_code": ("positionCode", "string", True),
    "shots": ("shots", "int", False),
    "plus_minus": ("plusMinus", "int", False),
    "faceoff_win_pct": ("faceoffWinPct", "double", False),
    "toi_per_game_s": ("timeOnIcePerGame", "double", False),
}
GOALIE_FIELDS: dict[str, Field] = {
    "player_id": ("playerId", "int", True),
    "games_played": ("gamesPlayed", "int", True),
    "season": ("seasonId", "string", True),
    "goalie_full_name": ("goalieFullName", "string", True),
    "team_abbrevs": ("teamAbbrevs", "string", True),
    "wins": ("wins", "int", False),
    "losses": ("losses", "int", False),
    "ot_losses": ("otLosses", "int", False),
    "save_pct": ("savePct", "double", False),
    "goals_against_avg": ("goalsAgainstAverage", "double", False),
    "shutouts": ("shutouts", "int", False),
}
TEAM_FIELDS: dict[str, Field] = {
    "team_id": ("teamId", "int", True),
    "games_played": ("gamesPlayed", "int", True),
    "season": ("seasonId", "string", True),
    "team_full_name": ("teamFullName", "string", True),
    "wins": ("wins", "int", False),
    "losses": ("losses", "int", False),
    "ot_losses": ("otLosses", "int", False),
    "points": ("points", "int", False),
    "point_pct": ("pointPct", "double", False),
    "regulation_and_ot_wins": ("regulationAndOtWins", "int", False),
    "goals_for_per_game": ("goalsForPerGame", "double", False),
    "goals_against_per_game": ("goalsAgainstPerGame", "double", False),
}
ROSTER_FIELDS: dict[str, Field] = {
    "player_id": ("id", "int", True),
    "position_code": ("positionCode", "string", True),
    "first_name": ("firstName.default", "string", True),
    "last_name": ("lastName.default", "string", True),
    "sweater_number": ("sweaterNumber", "int", False),
    "shoots_catches": ("shootsCatches", "string", True),
    "height_in": ("heightInInches", "int", False),
    "weight_lb": ("weightInPounds", "int", False),
    "birth_date": ("birthDate", "date", False),
    "birth_country": ("birthCountry", "string", True),
}
CLUB_SCHEDULE_FIELDS: dict[str, Field] = {
    "games_json": ("games", "string", True),
    "current_season": ("currentSeason", "string", True),
    "previous_season": ("previousSeason", "string", True),
    "next_season": ("nextSeason", "string", True),
    "club_timezone": ("clubTimezone", "string", True),
    "club_utc_offset": ("clubUTCOffset", "string", True),
}
# Roster array in the body, position group.
ROSTER_GROUPS = {"forwards": "F", "defensemen": "D", "goalies": "G"}


def _paths(fields: Mapping[str, Field]) -> dict[str, str]:
    return {name: path for name, (path, _, _) in fields.items()}


def _typed(df: DataFrame, fields: Mapping[str, Field], keep: list[str], done: tuple[str, ...] = ()) -> DataFrame:
    """Cast the extracted texts; columns in ``done`` are typed already."""
    casts = [
        F.col(name) if name in done else cast_text(F.col(name), kind, strict).alias(name)
        for name, (_, kind, strict) in fields.items()
    ]
    return df.select(*keep, *casts)


def _latest(texts: DataFrame, keys: list[str]) -> DataFrame:
    """The latest fetch of each key. Its digest, which only breaks ties, travels as bytes."""
    short = texts.withColumn("response_sha256", digest_bytes("response_sha256"))
    return latest_by(short, keys, "fetched_at_utc", ["response_sha256"])


@dataclass(frozen=True)
class Stage:
    """A staging model in two steps, between which only the latest fetch of each key is kept.

    ``extract`` takes texts out of bronze rows one by one, ``finish`` turns the
    latest ones into the model.
    """

    extract: Callable[[DataFrame], DataFrame]
    keys: list[str]
    finish: Callable[[DataFrame], DataFrame]

    def __call__(self, bronze: DataFrame) -> DataFrame:
        return self.finish(_latest(self.extract(bronze), self.keys))


def _game_texts(
    bronze: DataFrame, paths: Mapping[str, str], types: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    wanted = {**_paths({k: GAME_FIELDS[k] for k in ("game_id", "game_type")}), **paths}
    texts = json_texts(bronze, BODY, wanted, FETCH, types)
    return texts.withColumns(
        {"game_id": to_integer(F.col("game_id"), "bigint"), "game_type": to_integer(F.col("game_type"))}
    ).where(F.col("game_type").isin(*COMPETITIVE_TYPES))


def latest_games(
    bronze: DataFrame, paths: Mapping[str, str], types: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """Latest fetch per game with the wanted members of its body, as text.

    ``game_id`` and ``game_type`` come typed. The type filter runs on every
    fetch, before the dedup: a game whose type changed keeps its latest
    *competitive* fetch. ``types`` is as for ``json_texts``.
    """
    return _latest(_game_texts(bronze, paths, types), ["game_id"])


def _game_stage(fields: Mapping[str, Field], finish: Callable[[DataFrame], DataFrame] = lambda df: df) -> Stage:
    typed = lambda latest: _typed(latest, fields, ["ingest_date", "fetched_at_utc"], ("game_id", "game_type"))
    return Stage(lambda bronze: _game_texts(bronze, _paths(fields)), ["game_id"], lambda latest: finish(typed(latest)))


def _summary_rows(latest: DataFrame, fields: Mapping[str, Field], entity: str) -> DataFrame:
    """Rows of the latest fetch of each season, then the latest row per (season, entity).

    The first dedup goes by the envelope's season, the second by the season
    each row states. Rows of one fetch tie; the earliest element then wins.
    """
    rows = unnest_json(latest, "__data", _paths(fields), position="__position", keep=FETCH)
    keyed = rows.withColumn(entity, to_integer(F.col(entity)))
    unique = latest_by(keyed, ["season", entity], "fetched_at_utc", ["response_sha256", "__position"])
    return _typed(unique, fields, ["ingest_date", "fetched_at_utc"], done=(entity,))


def _summary_stage(fields: Mapping[str, Field], entity: str) -> Stage:
    return Stage(
        lambda bronze: json_texts(bronze, BODY, {"__data": "data"}, ["season", *FETCH]),
        ["season"],
        lambda latest: _summary_rows(latest, fields, entity),
    )


def _roster_bodies(bronze: DataFrame) -> DataFrame:
    return bronze.select(*FETCH, "season", json_text("endpoint_params_json", "team").alias("team_abbrev"), BODY)


def _roster_rows(latest: DataFrame) -> DataFrame:
    rows = explode_groups(
        latest,
        BODY,
        [(path, {"position_group": F.lit(group)}) for path, group in ROSTER_GROUPS.items()],
        _paths(ROSTER_FIELDS),
        position="__position",
    )
    keyed = rows.withColumn("player_id", to_integer(F.col("player_id")))
    unique = latest_by(
        keyed,
        ["season", "team_abbrev", "player_id"],
        "fetched_at_utc",
        ["response_sha256", "__position"],
    )
    keep = ["ingest_date", "fetched_at_utc", "season", "team_abbrev", "position_group"]
    return _typed(unique, ROSTER_FIELDS, keep, done=("player_id",))


def _club_texts(bronze: DataFrame) -> DataFrame:
    params = bronze.withColumn("team_abbrev", json_text("endpoint_params_json", "team"))
    return json_texts(params, BODY, _paths(CLUB_SCHEDULE_FIELDS), [*FETCH, "season", "team_abbrev"])


def _club_rows(latest: DataFrame) -> DataFrame:
    keep = ["ingest_date", "fetched_at_utc", "season", "team_abbrev"]
    return _typed(latest, CLUB_SCHEDULE_FIELDS, keep).withColumn("game_count", json_len("games_json"))


STAGES: dict[str, Stage] = {
    "stg_landing": _game_stage(LANDING_FIELDS),
    "stg_boxscore": _game_stage(BOXSCORE_FIELDS),
    "stg_play_by_play": _game_stage(PLAY_BY_PLAY_FIELDS, lambda df: df.withColumn("play_count", json_len("plays_json"))),
    "stg_skater_summary": _summary_stage(SKATER_FIELDS, "player_id"),
    "stg_goalie_summary": _summary_stage(GOALIE_FIELDS, "player_id"),
    "stg_team_summary": _summary_stage(TEAM_FIELDS, "team_id"),
    "stg_roster": Stage(_roster_bodies, ["season", "team_abbrev"], _roster_rows),
    "stg_club_schedule_season": Stage(_club_texts, ["season", "team_abbrev"], _club_rows),
}


def stg_landing(bronze: DataFrame) -> DataFrame:
    """One row per game: metadata, scores, venue and period rules."""
    return STAGES["stg_landing"](bronze)


def stg_boxscore(bronze: DataFrame) -> DataFrame:
    """One row per game: outcome, and player statistics still as JSON text."""
    return STAGES["stg_boxscore"](bronze)


def stg_play_by_play(bronze: DataFrame) -> DataFrame:
    """One row per game: plays and roster spots as JSON text, and a play count."""
    return STAGES["stg_play_by_play"](bronze)


def stg_skater_summary(bronze: DataFrame) -> DataFrame:
    """One row per (season, skater)."""
    return STAGES["stg_skater_summary"](bronze)


def stg_goalie_summary(bronze: DataFrame) -> DataFrame:
    """One row per (season, goalie)."""
    return STAGES["stg_goalie_summary"](bronze)


def stg_team_summary(bronze: DataFrame) -> DataFrame:
    """One row per (season, team)."""
    return STAGES["stg_team_summary"](bronze)


def stg_roster(bronze: DataFrame) -> DataFrame:
    """One row per (season, team, player); season and team come from the envelope."""
    return STAGES["stg_roster"](bronze)


def stg_club_schedule_season(bronze: DataFrame) -> DataFrame:
    """One row per (season, team): the games as JSON text and their count."""
    return STAGES["stg_club_schedule_season"](bronze)
