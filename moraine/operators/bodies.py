"""Checks on response bodies before they enter bronze.

A body is judged by a ``reason`` column: NULL passes, anything else rejects.
Members that no check names are tolerated, the body is kept verbatim.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import game_id_matches_season, season_start
from ..functions.json import json_texts
from ..sources import endpoints as E
from ..sources.bronze import to_envelope

# Required member paths and their kinds, per family.
_GAME = {
    "id": "int",
    "season": "int",
    "gameType": "int",
    "gameDate": "date",
    "gameState": "text",
    "startTimeUTC": "time",
    "awayTeam.id": "int",
    "awayTeam.abbrev": "text",
    "homeTeam.id": "int",
    "homeTeam.abbrev": "text",
}
REQUIRED: dict[str, dict[str, str]] = {
    E.LANDING: _GAME,
    E.BOXSCORE: {**_GAME, "playerByGameStats": "object", "gameOutcome": "object"},
    E.PLAY_BY_PLAY: {**_GAME, "plays": "objects", "rosterSpots": "objects"},
    E.ROSTER: {"forwards": "objects", "defensemen": "objects", "goalies": "objects"},
    E.CLUB_SCHEDULE: {
        "previousSeason": "int",
        "currentSeason": "int",
        "nextSeason": "int",
        "games": "objects",
    },
    E.SKATER_SUMMARY: {"total": "int", "data": "objects"},
    E.GOALIE_SUMMARY: {"total": "int", "data": "objects"},
    E.TEAM_SUMMARY: {"total": "int", "data": "objects"},
    E.SCHEDULE: {"gameWeek": "objects"},
}
# Required members of the elements of an array.
ELEMENTS: dict[str, dict[str, dict[str, str]]] = {
    E.ROSTER: {
        group: {"id": "int", "positionCode": "text"} for group in ("forwards", "defensemen", "goalies")
    },
    E.SKATER_SUMMARY: {
        "data": dict.fromkeys(
            ("seasonId", "playerId", "gamesPlayed", "goals", "assists", "points"), "int"
        )
    },
    E.GOALIE_SUMMARY: {"data": dict.fromkeys(("seasonId", "playerId", "gamesPlayed"), "int")},
    E.TEAM_SUMMARY: {"data": dict.fromkeys(("seasonId", "teamId", "gamesPlayed"), "int")},
    E.SCHEDULE: {"gameWeek": {"date": "date"}},
}
# The date of a scheduled game may be absent, but not malformed.
_SCHEDULED_GAME = {k: v for k, v in _GAME.items() if k != "gameDate"}


def _text(body: Column, path: str) -> Column:
    return F.try_variant_get(body, f"$.{path}", "string")


def _array(body: Column, path: str) -> Column:
    """The elements of a member that is an array, NULL for anything else."""
    return F.try_variant_get(body, f"$.{path}", "array<variant>")


def _object(body: Column, path: str = "") -> Column:
    """Is the member, or the value itself, an object?"""
    return F.try_variant_get(body, f"$.{path}" if path else "$", "map<string,variant>").isNotNull()


def _is(kind: str, body: Column, path: str, text: Column | None = None) -> Column:
    """Does the member have this kind? An absent or null member has none.

    Numbers may be written as text, texts must be JSON strings. ``text`` is the
    member as text, if it is there already.
    """
    if kind == "object":
        return _object(body, path)
    if kind == "objects":
        return _array(body, path).isNotNull()
    text = _text(body, path) if text is None else text
    if kind == "int":
        number = text.try_cast("decimal(38,6)")
        return text.try_cast("bigint").isNotNull() | (number.isNotNull() & (F.floor(number) == number))
    string = F.schema_of_variant(F.try_variant_get(body, f"$.{path}", "variant")) == "STRING"
    if kind == "date":
        return string & text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & text.try_cast("date").isNotNull()
    if kind == "time":
        dated = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}")
        return string & dated & text.try_cast("timestamp").isNotNull()
    return string


def _holds(condition: Column) -> Column:
    """An unknown condition does not hold."""
    return F.coalesce(condition, F.lit(False))


def _rejected(condition: Column, reason: str) -> Column:
    """``reason`` unless ``condition`` holds."""
    return F.when(~_holds(condition), F.lit(reason))


def _complete(item: Column, members: Mapping[str, str]) -> Column:
    """Does an element hold every required member?"""
    held = F.lit(True)
    for path, kind in members.items():
        held = held & _holds(_is(kind, item, path))
    return held


def _array_reason(family: str, array: str, items: Column) -> Column:
    """Elements must be objects, and hold the members required of them."""
    members = ELEMENTS.get(family, {}).get(array)
    if members is None:
        return _rejected(F.forall(items, lambda e: _holds(_object(e))), f"missing:{array}")
    return _rejected(F.forall(items, lambda e: _complete(e, members)), f"incomplete:{array}")


def with_reason(df: DataFrame, family: str) -> DataFrame:
    """Add ``reason`` to saved responses of one family.

    ``df`` has ``scope_key``, ``status`` and ``response_json``. What was
    requested is read from the scope key and compared with what came back. The
    body is parsed once, into a variant that keeps the kind of every member;
    a second, shallow pass refuses text after the body's end.
    """
    required = REQUIRED[family]
    # Behind generators, so that the many checks copy neither the parse nor the
    # texts, and a filter on the reason does not copy the checks.
    parsed = df.select(*df.columns, F.explode(F.array(F.try_parse_json("response_json"))).alias("__body"))
    body = F.col("__body")
    scalars = [path for path, kind in required.items() if kind not in ("object", "objects")]
    if scalars:
        texts = F.struct(*[_text(body, path).alias(path) for path in scalars])
        parsed = parsed.select("*", F.explode(F.array(texts)).alias("__texts"))
    text = {path: F.col("__texts").getField(path) for path in scalars}
    arrays = [path for path, kind in required.items() if kind == "objects"]
    items = {array: _array(body, array) for array in arrays}

    reasons = [_rejected(_is(kind, body, path, text.get(path)), f"missing:{path}") for path, kind in required.items()]
    reasons += [_array_reason(family, array, items[array]) for array in arrays]
    whole = lambda path: text[path].try_cast("decimal(38,6)").try_cast("bigint")
    scope = F.col("scope_key")
    if family in E.GAME_FAMILIES:
        reasons.append(
            _rejected(game_id_matches_season(whole("id"), whole("season")), "id_season_mismatch")
        )
        reasons.append(_rejected(whole("id") == scope.try_cast("bigint"), "id_not_requested"))
    if family in E.SUMMARY_FAMILIES:
        reasons.append(_rejected(F.size(items["data"]) == whole("total"), "total_mismatch"))
    if family == E.CLUB_SCHEDULE:
        requested = F.split_part(scope, F.lit("|"), F.lit(1)).try_cast("bigint")
        reasons.append(_rejected(whole("currentSeason") == requested, "season_not_requested"))
    if family == E.SCHEDULE:
        reasons += _schedule_reasons(items["gameWeek"])
    judged = parsed.withColumn("__first", F.coalesce(*reasons))
    alone = F.json_array_length(F.concat(F.lit("["), "response_json", F.lit("]"))) == 1
    malformed = F.col("__first").isNotNull() & F.json_object_keys("response_json").isNull()
    reason = F.when(malformed | ~_holds(alone), F.lit("malformed_json")).otherwise(F.col("__first"))
    return judged.select(*df.columns, F.explode(F.array(reason)).alias("reason"))


def _schedule_reasons(week: Column) -> list[Column]:
    games = F.flatten(F.transform(week, lambda day: _array(day, "games")))

    def complete(game: Column) -> Column:
        dated = _text(game, "gameDate").isNull() | _is("date", game, "gameDate")
        return _holds(dated) & _complete(game, _SCHEDULED_GAME)

    matches = lambda g: _holds(
        game_id_matches_season(_text(g, "id").try_cast("bigint"), _text(g, "season"))
    )
    return [
        _rejected(F.forall(games, complete), "incomplete:games"),
        _rejected(F.forall(games, matches), "id_season_mismatch"),
    ]


def split_bodies(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of responses that carry ``reason``."""
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(
        F.col("reason").isNotNull()
    )


def found(df: DataFrame) -> DataFrame:
    """Drop responses that report a missing resource: neither rows nor rejects."""
    return df.where(F.coalesce(F.col("status"), F.lit(200)) != 404)


def validate_bodies(df: DataFrame, family: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of saved responses; rejects carry the first ``reason``."""
    return split_bodies(with_reason(found(df), family))


def envelopes(valid: DataFrame, family: str) -> DataFrame:
    """Valid saved responses of one family as bronze envelope rows."""
    template = E.TEMPLATES[family]
    scope = F.col("scope_key")
    fetched = F.col("fetched_at_utc")
    if family in E.GAME_FAMILIES:
        texts = json_texts(
            valid,
            "response_json",
            {"__season": "season", "__date": "gameDate"},
            ["scope_key", "fetched_at_utc", "response_json"],
        )
        return to_envelope(
            texts,
            template,
            scope,
            {"gameId": scope.cast("bigint")},
            fetched,
            season=F.col("__season"),
            event_date=F.col("__date"),
        )
    if family in E.TEAM_SEASON_FAMILIES:
        season = F.split_part(scope, F.lit("|"), F.lit(1))
        team = F.split_part(scope, F.lit("|"), F.lit(2))
        return to_envelope(
            valid,
            template,
            team,
            {"season": season, "team": team},
            fetched,
            season=season,
            event_date=season_start(season),
        )
    if family in E.SUMMARY_FAMILIES:
        return to_envelope(
            valid,
            template,
            scope,
            {"cayenneExp": F.concat(F.lit("seasonId="), scope), "limit": F.lit(-1)},
            fetched,
            season=scope,
            event_date=season_start(scope),
        )
    raise ValueError(f"family {family!r} has no bronze envelope")


def scope_of(family: str) -> Column:
    """Scope key of an envelope row."""
    if family in E.TEAM_SEASON_FAMILIES:
        return F.concat_ws("|", "season", "entity_id")
    return F.col("entity_id")
