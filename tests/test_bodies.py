from datetime import date

import pytest
from pyspark.sql import functions as F

from moraine.operators.bodies import envelopes, scope_of, validate_bodies, with_reason
from moraine.sources import endpoints as E

from . import bodies as b

GAME = 2025030457


def without(body, path):
    *parents, leaf = path.split(".")
    body = {**body}
    node = body
    for name in parents:
        node[name] = {**node[name]}
        node = node[name]
    del node[leaf]
    return body


def check(spark, family, cases):
    """``(scope, body, wanted reason)`` judged in one job."""
    df = b.landed(spark, [(scope, body) for scope, body, _ in cases])
    rows = with_reason(df, family).collect()
    got = sorted((r.scope_key, r.response_json, str(r.reason)) for r in rows)
    assert got == sorted((str(scope), b.text(body), str(want)) for scope, body, want in cases)


def of_family(cases, family):
    return [(scope, body, want[0] if want else None) for f, scope, body, *want in cases if f == family]


GOOD = [
    (E.LANDING, GAME, b.landing()),
    (E.LANDING, GAME, b.landing(brandNew={"x": [1]})),
    (E.BOXSCORE, GAME, b.boxscore()),
    (E.PLAY_BY_PLAY, GAME, b.play_by_play()),
    (E.PLAY_BY_PLAY, GAME, b.play_by_play(plays=[])),
    (E.ROSTER, "20242025|TOR", b.roster([b.person(1)], [], [b.person(2, "G")])),
    (E.CLUB_SCHEDULE, "20242025|TOR", b.club_schedule()),
    (E.SKATER_SUMMARY, "20242025", b.summary(b.skater_row(1), b.skater_row(2))),
    (E.SKATER_SUMMARY, "20242025", b.summary()),
    (E.GOALIE_SUMMARY, "20242025", b.summary(b.goalie_row(1))),
    (E.TEAM_SUMMARY, "20242025", b.summary(b.team_row(1))),
    (E.SCHEDULE, "2026-05-11", b.schedule({"2026-05-11": [b.scheduled(GAME)], "2026-05-12": []})),
    (E.SCHEDULE, "2026-05-11", b.schedule({"2026-05-11": [without(b.scheduled(GAME), "gameDate")]})),
]


@pytest.mark.parametrize("family", E.TEMPLATES)
def test_good_bodies_pass(spark, family):
    check(spark, family, of_family(GOOD, family))


BAD = [
    (E.LANDING, GAME, without(b.landing(), "id"), "missing:id"),
    (E.LANDING, GAME, without(b.landing(), "startTimeUTC"), "missing:startTimeUTC"),
    (E.LANDING, GAME, without(b.landing(), "awayTeam"), "missing:awayTeam.id"),
    (E.LANDING, GAME, without(b.landing(), "homeTeam.abbrev"), "missing:homeTeam.abbrev"),
    (E.LANDING, GAME, b.landing(id="abc"), "missing:id"),
    (E.LANDING, GAME, b.landing(season=None), "missing:season"),
    (E.LANDING, GAME, b.landing(gameDate="soon"), "missing:gameDate"),
    (E.LANDING, GAME, b.landing(season=20242025), "id_season_mismatch"),
    (E.LANDING, GAME + 1, b.landing(), "id_not_requested"),
    (E.LANDING, GAME, b.text(b.landing())[:-5], "malformed_json"),
    (E.LANDING, GAME, "<html>404</html>", "malformed_json"),
    (E.LANDING, GAME, "[1]", "malformed_json"),
    (E.BOXSCORE, GAME, without(b.boxscore(), "playerByGameStats"), "missing:playerByGameStats"),
    (E.BOXSCORE, GAME, b.boxscore(gameOutcome=[]), "missing:gameOutcome"),
    (E.PLAY_BY_PLAY, GAME, without(b.play_by_play(), "plays"), "missing:plays"),
    (E.PLAY_BY_PLAY, GAME, b.play_by_play(rosterSpots={}), "missing:rosterSpots"),
    (E.PLAY_BY_PLAY, GAME, b.play_by_play(plays=[1, {}]), "missing:plays"),
    (E.ROSTER, "20242025|TOR", without(b.roster(), "goalies"), "missing:goalies"),
    (E.ROSTER, "20242025|TOR", b.roster([without(b.person(1), "positionCode")]), "incomplete:forwards"),
    (E.CLUB_SCHEDULE, "20242025|TOR", b.club_schedule(20232024), "season_not_requested"),
    (E.CLUB_SCHEDULE, "20242025|TOR", without(b.club_schedule(), "games"), "missing:games"),
    (E.SKATER_SUMMARY, "20242025", b.summary(b.skater_row(1), total=2), "total_mismatch"),
    (E.SKATER_SUMMARY, "20242025", without(b.summary(), "total"), "missing:total"),
    (E.SKATER_SUMMARY, "20242025", b.summary(without(b.skater_row(1), "points")), "incomplete:data"),
    (E.SKATER_SUMMARY, "20242025", {"data": [5], "total": 1}, "incomplete:data"),
    (E.GOALIE_SUMMARY, "20242025", b.summary(b.goalie_row(None)), "incomplete:data"),
    (E.TEAM_SUMMARY, "20242025", b.summary(without(b.team_row(1), "teamId")), "incomplete:data"),
    (E.SCHEDULE, "2026-05-11", {"gameWeek": [{"games": []}]}, "incomplete:gameWeek"),
    (E.SCHEDULE, "2026-05-11", {"gameWeek": [{"date": "2026-05-11"}]}, "incomplete:games"),
    (E.SCHEDULE, "2026-05-11", b.schedule({"2026-05-11": [without(b.scheduled(GAME), "gameState")]}), "incomplete:games"),
    (E.SCHEDULE, "2026-05-11", b.schedule({"2026-05-11": [b.scheduled(GAME, season=20242025)]}), "id_season_mismatch"),
    (E.SCHEDULE, "2026-05-11", {}, "missing:gameWeek"),
    # Members of the wrong JSON kind, and text after the body.
    (E.LANDING, GAME, b.landing(gameState=5), "missing:gameState"),
    (E.LANDING, GAME, b.landing(gameState=True), "missing:gameState"),
    (E.LANDING, GAME, b.landing(gameDate=20260424), "missing:gameDate"),
    (E.LANDING, GAME, b.landing(startTimeUTC="T10:00:00"), "missing:startTimeUTC"),
    (E.LANDING, GAME, b.landing(startTimeUTC={"x": 1}), "missing:startTimeUTC"),
    (E.LANDING, GAME, b.landing(gameType=[3]), "missing:gameType"),
    (E.LANDING, GAME, b.landing(homeTeam={"id": 1, "abbrev": {"x": 1}}), "missing:homeTeam.abbrev"),
    (E.LANDING, GAME, b.landing(homeTeam="x"), "missing:homeTeam.id"),
    (E.LANDING, GAME, b.text(b.landing()) + " xx", "malformed_json"),
    (E.LANDING, GAME, b.text(b.landing()) + "}", "malformed_json"),
    (E.BOXSCORE, GAME, b.boxscore(playerByGameStats="{}"), "missing:playerByGameStats"),
    (E.PLAY_BY_PLAY, GAME, b.play_by_play(plays="[]"), "missing:plays"),
    (E.PLAY_BY_PLAY, GAME, b.play_by_play(plays=["{}"]), "missing:plays"),
    (E.ROSTER, "20242025|TOR", b.roster([{**b.person(1), "positionCode": 5}]), "incomplete:forwards"),
    (E.ROSTER, "20242025|TOR", {**b.roster(), "goalies": "[]"}, "missing:goalies"),
    (E.CLUB_SCHEDULE, "20242025|TOR", {**b.club_schedule(), "nextSeason": {}}, "missing:nextSeason"),
    (E.CLUB_SCHEDULE, "20242025|TOR", {**b.club_schedule(), "games": {}}, "missing:games"),
    (E.SKATER_SUMMARY, "20242025", {**b.summary(), "data": "[]"}, "missing:data"),
    (E.SKATER_SUMMARY, "20242025", b.summary({**b.skater_row(1), "goals": [1]}), "incomplete:data"),
    (E.GOALIE_SUMMARY, "20242025", b.summary({**b.goalie_row(1), "gamesPlayed": "x"}), "incomplete:data"),
    (E.TEAM_SUMMARY, "20242025", {**b.summary(), "total": {}}, "missing:total"),
    (E.TEAM_SUMMARY, "20242025", b.summary({**b.team_row(1), "teamId": True}), "incomplete:data"),
    (E.SCHEDULE, "2026-05-11", {"gameWeek": [{"date": 5, "games": []}]}, "incomplete:gameWeek"),
    (E.SCHEDULE, "2026-05-11", {"gameWeek": [{"date": "2026-05-11", "games": "[]"}]}, "incomplete:games"),
    (E.SCHEDULE, "2026-05-11", b.schedule({"2026-05-11": [b.scheduled(GAME, 5)]}), "incomplete:games"),
    (E.SCHEDULE, "2026-05-11", b.text(b.schedule({"2026-05-11": []})) + " {}", "malformed_json"),
]


@pytest.mark.parametrize("family", E.TEMPLATES)
def test_bad_bodies_are_named(spark, family):
    check(spark, family, of_family(BAD, family))


def test_split_keeps_siblings_and_drops_missing_resources(spark):
    df = b.landed(
        spark,
        [(1, b.landing()), (GAME, b.landing()), ("20232024|UTA", "<html>gone</html>", b.FETCHED, 404)],
    )
    valid, rejects = validate_bodies(df, E.LANDING)
    assert [r.scope_key for r in valid.collect()] == [str(GAME)]
    assert [(r.scope_key, r.reason) for r in rejects.collect()] == [("1", "id_not_requested")]


def test_envelopes_of_each_kind(spark):
    made = {
        E.LANDING: (GAME, b.landing()),
        E.ROSTER: ("20242025|TOR", b.roster()),
        E.GOALIE_SUMMARY: ("20242025", b.summary()),
    }
    got = {f: envelopes(b.landed(spark, [row]), f).withColumn("scope", scope_of(f)).first() for f, row in made.items()}
    game, team, season = got[E.LANDING], got[E.ROSTER], got[E.GOALIE_SUMMARY]
    assert (game.entity_id, game.season, game.event_date) == (str(GAME), "20252026", date(2026, 5, 11))
    assert game.endpoint_params_json == f'{{"gameId": {GAME}}}' and game.endpoint == "/v1/gamecenter/{gameId}/landing"
    assert (team.entity_id, team.season, team.event_date) == ("TOR", "20242025", date(2024, 10, 1))
    assert team.endpoint_params_json == '{"season": "20242025", "team": "TOR"}'
    assert (season.entity_id, season.event_date) == ("20242025", date(2024, 10, 1))
    assert season.endpoint_params_json == '{"cayenneExp": "seasonId=20242025", "limit": -1}'
    assert [g.scope for g in (game, team, season)] == [str(GAME), "20242025|TOR", "20242025"]
    with pytest.raises(ValueError):
        envelopes(b.landed(spark, [("d", {})]), E.SCHEDULE)


def test_schedule_games(spark):
    from moraine.plans.schedule import ScheduleDayNotFound, require_days, schedule_games

    week = b.schedule(
        {
            "2026-05-11": [b.scheduled(GAME)],
            "2026-05-12": [b.scheduled(GAME + 3, "LIVE"), b.scheduled(GAME + 2), b.scheduled(GAME + 1, "FINAL", gameType=4)],
            "2026-05-13": [],
        }
    )
    df = b.landed(spark, [("2026-05-12", week)])
    got = schedule_games(df, F.to_date("scope_key")).orderBy("position").collect()
    assert [(r.position, r.game_id, r.game_type, r.game_state) for r in got] == [
        (1, GAME + 2, 3, "OFF"),
        (2, GAME + 1, 4, "FINAL"),
    ]
    assert schedule_games(df, F.lit("2026-05-12").cast("date"), states=None).count() == 3
    assert schedule_games(df, F.lit("2026-05-13").cast("date")).count() == 0
    require_days(df, F.to_date("scope_key"))
    with pytest.raises(ScheduleDayNotFound, match="2026-05-01"):
        require_days(b.landed(spark, [("2026-05-01", week)]), F.to_date("scope_key"))
