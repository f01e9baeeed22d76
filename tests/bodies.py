"""Small synthetic responses of every family's shape."""

import json
from datetime import datetime, timezone

FETCHED = datetime(2026, 5, 12, 12, 0, 0, 123456, tzinfo=timezone.utc)


def at(hour: int, minute: int = 0) -> datetime:
    return datetime(2026, 5, 12, hour, minute, tzinfo=timezone.utc)


def team(team_id, abbrev, score=None):
    ref = {"id": team_id, "abbrev": abbrev}
    return ref if score is None else {**ref, "score": score}


def game(game_id=2025030457, **changes):
    body = {
        "id": game_id,
        "season": 20252026,
        "gameType": 3,
        "gameDate": "2026-05-11",
        "gameState": "OFF",
        "startTimeUTC": "2026-05-11T23:00:00Z",
        "awayTeam": team(14, "TBL", 2),
        "homeTeam": team(8, "MTL", 3),
    }
    return {**body, **changes}


def landing(game_id=2025030457, **changes):
    body = game(
        game_id,
        venue={"default": "Centre"},
        venueTimezone="America/Montreal",
        periodDescriptor={"number": 4, "periodType": "OT", "maxRegulationPeriods": 3},
        regPeriods=3,
        otInUse=True,
        shootoutInUse=False,
        tiesInUse=False,
        summary={"unread": [1, 2]},
    )
    return {**body, **changes}


def skater(player_id, toi="12:34", **changes):
    row = {
        "playerId": player_id,
        "sweaterNumber": 9,
        "name": {"default": "N"},
        "position": "C",
        "goals": 1,
        "assists": 2,
        "points": 3,
        "sog": 4,
        "faceoffWinningPctg": 0.5,
        "toi": toi,
    }
    return {**row, **changes}


def goalie(player_id, toi="60:05", saves=20, against=2):
    return {
        "playerId": player_id,
        "goalsAgainst": against,
        "toi": toi,
        "starter": toi != "00:00",
        "shotsAgainst": saves + against,
        "saves": saves,
    }


def boxscore(game_id=2025030457, **changes):
    body = game(
        game_id,
        gameOutcome={"lastPeriodType": "OT", "otPeriods": 1},
        playerByGameStats={
            "awayTeam": {
                "forwards": [skater(1), skater(2, "00:07")],
                "defense": [skater(3)],
                "goalies": [goalie(4), goalie(5, "00:00", 0, 0)],
            },
            "homeTeam": {"forwards": [skater(6)], "defense": [], "goalies": [goalie(7)]},
        },
    )
    return {**body, **changes}


def play(event_id, kind, clock="00:00", period=1, **details):
    body = {
        "eventId": event_id,
        "typeDescKey": kind,
        "timeInPeriod": clock,
        "periodDescriptor": {"number": period, "periodType": "REG"},
    }
    return {**body, "details": details} if details else body


def play_by_play(game_id=2025030457, plays=None, **changes):
    some = [
        play(1, "period-start"),
        play(2, "faceoff", "00:00", winningPlayerId=1, losingPlayerId=6, eventOwnerTeamId=14, xCoord=0, yCoord=0),
        play(3, "shot-on-goal", "01:10", shootingPlayerId=2, goalieInNetId=7, eventOwnerTeamId=14, xCoord=-70, yCoord=12),
        play(4, "goal", "19:59", 2, scoringPlayerId=6, assist1PlayerId=8, goalieInNetId=4, eventOwnerTeamId=8),
        play(5, "hit", "05:00", 2, hittingPlayerId=3, hitteePlayerId=6, eventOwnerTeamId=14),
        play(6, "penalty", "06:00", 2, committedByPlayerId=3, drawnByPlayerId=6, eventOwnerTeamId=14),
        play(7, "some-new-kind", "07:00", 2, playerId=1),
        play(8, "game-end", "20:00", 3),
    ]
    body = game(game_id, plays=some if plays is None else plays, rosterSpots=[{"playerId": 1}])
    return {**body, **changes}


def skater_row(player_id, season=20242025, **changes):
    row = {
        "seasonId": season,
        "playerId": player_id,
        "skaterFullName": f"Skater {player_id}",
        "teamAbbrevs": "ANA,BUF",
        "positionCode": "C",
        "gamesPlayed": 82,
        "goals": 10,
        "assists": 20,
        "points": 30,
        "shots": 100,
        "plusMinus": -3,
        "faceoffWinPct": None,
        "ties": None,
        "timeOnIcePerGame": 1340.2,
    }
    return {**row, **changes}


def goalie_row(player_id, season=20242025, **changes):
    row = {
        "seasonId": season,
        "playerId": player_id,
        "goalieFullName": f"Goalie {player_id}",
        "teamAbbrevs": "TOR",
        "gamesPlayed": 40,
        "wins": 20,
        "losses": 15,
        "otLosses": 5,
        "ties": None,
        "savePct": None,
        "goalsAgainstAverage": 2.51,
        "shutouts": 3,
    }
    return {**row, **changes}


def team_row(team_id, season=20242025, **changes):
    row = {
        "seasonId": season,
        "teamId": team_id,
        "teamFullName": f"Team {team_id}",
        "gamesPlayed": 82,
        "wins": 40,
        "losses": 30,
        "otLosses": 12,
        "ties": None,
        "points": 92,
        "pointPct": 0.561,
        "regulationAndOtWins": None,
        "goalsForPerGame": 3.1,
        "goalsAgainstPerGame": 2.9,
    }
    return {**row, **changes}


def summary(*rows, total=None):
    return {"data": list(rows), "total": len(rows) if total is None else total}


def person(player_id, code="C", first="Ann", last="Lee", **changes):
    row = {
        "id": player_id,
        "firstName": {"default": first, "fr": "Anne"},
        "lastName": {"default": last},
        "positionCode": code,
        "sweaterNumber": 9,
        "shootsCatches": "L",
        "heightInInches": 70,
        "weightInPounds": 180,
        "birthDate": "2001-01-05",
        "birthCountry": "CAN",
    }
    return {**row, **changes}


def roster(forwards=(), defensemen=(), goalies=()):
    return {"forwards": list(forwards), "defensemen": list(defensemen), "goalies": list(goalies)}


def club_schedule(season=20242025, games=None):
    return {
        "previousSeason": season - 10001,
        "currentSeason": season,
        "nextSeason": season + 10001,
        "clubTimezone": "America/Toronto",
        "clubUTCOffset": "-04:00",
        "games": [{"id": 2024020001, "gameType": 2}] if games is None else games,
    }


def scheduled(game_id, state="OFF", **changes):
    return game(game_id, gameState=state, **changes)


def schedule(days):
    """``{date: [games]}``"""
    week = [
        {"date": d, "dayAbbrev": "FRI", "numberOfGames": len(g), "games": g} for d, g in days.items()
    ]
    return {"gameWeek": week, "previousStartDate": "2026-05-04", "nextStartDate": "2026-05-18"}


def text(body) -> str:
    return body if isinstance(body, str) else json.dumps(body, separators=(",", ":"))


LANDED = "scope_key string, status int, fetched_at_utc timestamp, response_json string"


def landed(spark, rows):
    """``(scope_key, body[, fetched_at[, status]])`` as saved responses."""
    full = []
    for row in rows:
        scope, body, *rest = row
        fetched = rest[0] if rest else FETCHED
        full.append((str(scope), rest[1] if len(rest) > 1 else 200, fetched, text(body)))
    return spark.createDataFrame(full, LANDED)


def bronze(spark, family, rows):
    """Saved responses as bronze rows, without judging them."""
    from pyspark.sql import functions as F

    from moraine.operators.bodies import envelopes

    return envelopes(landed(spark, rows), family).withColumn("ingest_date", F.to_date("fetched_at_utc"))
