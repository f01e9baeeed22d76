from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from moraine.operators.unnest import union_facts
from moraine.plans import core, intermediate, staging
from moraine.plans.contracts import CONTRACTS, check_table, check_tables
from moraine.plans.silver import CORE, MODELS, Models, build_silver, create_views, lake_models
from moraine.sources import endpoints as E
from moraine.sources.bronze import write_bronze

from . import bodies as b

GAME = 2025030457


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_landing_to_outcome(spark):
    df = staging.stg_landing(b.bronze(spark, E.LANDING, [(GAME, b.landing())]))
    row = only(df)
    assert (row.game_id, row.game_type, row.game_date) == (GAME, 3, date(2026, 5, 11))
    assert row.start_time_utc == datetime(2026, 5, 11, 23) and row.season == "20252026"
    assert (row.reg_periods, row.ot_in_use, row.shootout_in_use, row.venue_name) == (3, True, False, "Centre")
    outcome = only(core.fct_game_outcome(df))
    assert tuple(outcome) == (GAME, 3, 2, "OT", 8, True)
    fact = only(core.fct_game(df))
    assert tuple(fact) == (GAME, 1, "20252026", datetime(2026, 5, 11, 23), 8, 14, 8, 3, "OFF")


def test_latest_fetch_wins_and_type_filter_comes_first(spark):
    fetches = [
        (GAME, b.landing(gameState="LIVE"), b.at(10)),
        (GAME, b.landing(gameState="OFF"), b.at(12)),
        (GAME, b.landing(gameState="FINAL"), b.at(11)),
        # The latest fetch has another type, so an earlier competitive one stays.
        (GAME + 1, b.landing(GAME + 1, gameType=2, venueTimezone="kept"), b.at(9)),
        (GAME + 1, b.landing(GAME + 1, gameType=4, venueTimezone="dropped"), b.at(13)),
        (GAME + 2, b.landing(GAME + 2, gameType=1), b.at(9)),
    ]
    rows = {r.game_id: r for r in staging.stg_landing(b.bronze(spark, E.LANDING, fetches)).collect()}
    assert set(rows) == {GAME, GAME + 1}
    assert rows[GAME].game_state == "OFF" and rows[GAME + 1].venue_timezone == "kept"


def test_ties_are_settled_the_same_way_every_time(spark):
    same_time = [(GAME, b.landing(venueTimezone=z)) for z in "abcdef"]
    seen = {
        only(staging.stg_landing(b.bronze(spark, E.LANDING, order).repartition(n))).venue_timezone
        for order, n in ((same_time, 1), (same_time[::-1], 3), (same_time[3:] + same_time[:3], 4))
    }
    assert len(seen) == 1


def test_superseded_rows_never_fail_a_cast(spark):
    bad = b.landing(homeTeam=b.team(8, "MTL", "three"))
    fetches = [(GAME, bad, b.at(9)), (GAME, b.landing(), b.at(10))]
    assert only(staging.stg_landing(b.bronze(spark, E.LANDING, fetches))).home_score == 3
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_landing(b.bronze(spark, E.LANDING, fetches[:1])).collect()


def test_missing_scores_fall_to_the_away_side(spark):
    body = b.landing(awayTeam=b.team(14, "TBL"), homeTeam=b.team(8, "MTL", 1))
    outcome = only(core.fct_game_outcome(staging.stg_landing(b.bronze(spark, E.LANDING, [(GAME, body)]))))
    assert (outcome.winning_team_id, outcome.home_win, outcome.away_goals) == (14, None, None)


def test_game_events(spark):
    stage = staging.stg_play_by_play(b.bronze(spark, E.PLAY_BY_PLAY, [(GAME, b.play_by_play())]))
    assert only(stage).play_count == 8 and only(stage).roster_spots_json == '[{"playerId":1}]'
    rows = {r.event_id: r for r in core.fct_game_event(intermediate.int_game_events(stage)).collect()}
    assert len(rows) == 8
    row = lambda i: rows[f"{GAME}_{i}"]
    assert [row(i).event_type for i in range(1, 9)] == [
        "period_start", "faceoff", "shot", "goal", "hit", "penalty", "some_new_kind", "game_end"
    ]
    assert row(1)[3:9] == (None,) * 6 and row(8).details_json is None
    assert [(row(i).primary_player_id, row(i).secondary_player_id) for i in range(2, 8)] == [
        (1, 6), (2, 7), (6, 8), (3, 6), (3, 6), (1, None)
    ]
    assert (row(3).x_coord, row(3).y_coord, row(3).team_id, row(4).period_time_elapsed_s) == (-70, 12, 14, 1199)
    assert row(7).details_json == '{"playerId":1}'


def test_bronze_shortcuts_equal_the_staged_way(spark):
    games = [(GAME, b.boxscore(), b.at(1)), (GAME, b.boxscore(awayTeam=b.team(99, "X")), b.at(2)), (GAME + 1, b.boxscore(GAME + 1, gameType=1))]
    box = b.bronze(spark, E.BOXSCORE, games)
    same = lambda x, y: sorted(map(str, x.collect())) == sorted(map(str, y.collect()))
    direct = intermediate.bronze_game_players(box)
    assert direct.count() == 7 and same(direct, intermediate.game_players(staging.stg_boxscore(box)))
    pbp = b.bronze(spark, E.PLAY_BY_PLAY, [(GAME, b.play_by_play(plays=[]), b.at(1)), (GAME, b.play_by_play(), b.at(2))])
    events = intermediate.bronze_game_events(pbp)
    assert events.count() == 8 and same(events, intermediate.int_game_events(staging.stg_play_by_play(pbp)))
    parses = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("from_json")
    staged = intermediate.int_game_events(staging.stg_play_by_play(pbp))
    assert parses(events) == parses(staged) - 1


def test_no_plays_no_events(spark):
    stage = staging.stg_play_by_play(b.bronze(spark, E.PLAY_BY_PLAY, [(GAME, b.play_by_play(plays=[]))]))
    assert only(stage).play_count == 0 and intermediate.int_game_events(stage).count() == 0


def test_lineup_is_the_union_of_both_roles(spark):
    body = b.boxscore()
    del body["playerByGameStats"]["homeTeam"]["defense"]
    stage = staging.stg_boxscore(b.bronze(spark, E.BOXSCORE, [(GAME, body)]))
    assert (only(stage).last_period_type, only(stage).ot_periods) == ("OT", 1)
    players = intermediate.game_players(stage)
    skaters, goalies = intermediate.int_game_skater_stats(players), intermediate.int_game_goalie_stats(players)
    assert skaters.columns == ["game_id", "team_id", "position_type", "player_id", "toi_s", "goals", "assists", "shots"]
    assert goalies.columns == ["game_id", "team_id", "position_type", "player_id", "toi_s", "saves", "goals_against"]
    lineup = core.fct_game_lineup(players)
    both = union_facts(skaters, goalies)
    assert sorted(map(tuple, lineup.drop("lineup_id").select(*both.columns).collect())) == sorted(map(tuple, both.collect()))
    rows = {r.lineup_id: r for r in lineup.collect()}
    assert len(rows) == 7
    assert tuple(rows[f"{GAME}_2"])[1:] == (GAME, 14, 2, "F", 7, 1, 2, 4, None, None)
    assert tuple(rows[f"{GAME}_5"])[1:] == (GAME, 14, 5, "G", 0, None, None, None, 0, 0)


def test_summaries_dedup_twice(spark):
    first = b.summary(b.skater_row(1, goals=1), b.skater_row(1, goals=2), b.skater_row(2, shots="12.7", plusMinus="x"))
    newer = b.summary(b.skater_row(3))
    other = b.summary(b.skater_row(3, season=20242025, goals=99))
    rows = [
        ("20242025", b.summary(b.skater_row(9)), b.at(1)),
        ("20242025", first, b.at(2)),
        ("20232024", newer, b.at(3)),
        ("20222023", other, b.at(4)),
    ]
    got = {r.player_id: r for r in staging.stg_skater_summary(b.bronze(spark, E.SKATER_SUMMARY, rows)).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1].goals == 1  # the earlier element of one response
    assert (got[2].shots, got[2].plus_minus, got[2].toi_per_game_s, got[2].faceoff_win_pct) == (13, None, 1340.2, None)
    # Keyed by the season the row states, not by the envelope's.
    assert (got[3].goals, got[3].season) == (99, "20242025")


def test_goalie_and_team_summaries(spark):
    goalies = staging.stg_goalie_summary(b.bronze(spark, E.GOALIE_SUMMARY, [("20242025", b.summary(b.goalie_row(1)))]))
    assert (only(goalies).wins, only(goalies).save_pct, only(goalies).goals_against_avg) == (20, None, 2.51)
    teams = staging.stg_team_summary(b.bronze(spark, E.TEAM_SUMMARY, [("20242025", b.summary(b.team_row(8)))]))
    assert (only(teams).points, only(teams).point_pct, only(teams).regulation_and_ot_wins) == (92, 0.561, None)


def test_roster_groups(spark):
    body = b.roster(
        [b.person(1, "L", birthDate="?", sweaterNumber=None)], [b.person(2, "D"), b.person(1, "D")], [b.person(3, "G")]
    )
    rows = [("20242025|TOR", body, b.at(2)), ("20242025|TOR", b.roster([b.person(9)]), b.at(1)), ("20242025|MTL", b.roster([b.person(1)]))]
    got = {(r.team_abbrev, r.player_id): r for r in staging.stg_roster(b.bronze(spark, E.ROSTER, rows)).collect()}
    assert set(got) == {("TOR", 1), ("TOR", 2), ("TOR", 3), ("MTL", 1)}
    one = got["TOR", 1]
    assert (one.position_group, one.position_code, one.birth_date, one.sweater_number) == ("F", "L", None, None)
    assert (one.first_name, one.last_name, one.height_in, one.season) == ("Ann", "Lee", 70, "20242025")
    assert got["TOR", 2].birth_date == date(2001, 1, 5)


def test_club_schedule(spark):
    rows = [("20242025|TOR", b.club_schedule(), b.at(1)), ("20242025|TOR", b.club_schedule(games=[]), b.at(2))]
    row = only(staging.stg_club_schedule_season(b.bronze(spark, E.CLUB_SCHEDULE, rows)))
    assert (row.game_count, row.games_json, row.current_season, row.next_season) == (0, "[]", "20242025", "20252026")
    assert (row.club_timezone, row.club_utc_offset, row.team_abbrev) == ("America/Toronto", "-04:00", "TOR")


def spine(spark):
    roster = b.bronze(
        spark,
        E.ROSTER,
        [
            ("20232024|TOR", b.roster([b.person(1, "C", "Old", "Fetch")]), b.at(3)),
            ("20242025|TOR", b.roster([b.person(1, "C", "New", "Season"), b.person(2, "L", "No", None)]), b.at(1)),
        ],
    )
    skaters = b.bronze(
        spark,
        E.SKATER_SUMMARY,
        [("20242025", b.summary(b.skater_row(2), b.skater_row(4, positionCode="D"), b.skater_row(6, positionCode="?")))],
    )
    goalies = b.bronze(spark, E.GOALIE_SUMMARY, [("20242025", b.summary(b.goalie_row(5), b.goalie_row(6)))])
    return intermediate.int_player_spine(
        staging.stg_roster(roster), staging.stg_skater_summary(skaters), staging.stg_goalie_summary(goalies)
    )


def test_player_spine(spark):
    rows = {r.player_id: r for r in core.dim_player(spine(spark)).collect()}
    assert set(rows) == {1, 2, 4, 5, 6}
    # The latest fetch decides, even of an earlier season.
    assert (rows[1].full_name, rows[1].external_ids) == ("Old Fetch", '{"nhl_api_player_id":1}')
    # Half a roster name falls back to the summary; the position stays the roster's.
    assert (rows[2].full_name, rows[2].position_group, rows[2].position_code) == ("Skater 2", "F", "L")
    assert (rows[4].position_group, rows[4].position_code, rows[4].height_in) == ("D", "D", None)
    assert (rows[5].full_name, rows[5].position_group, rows[5].position_code) == ("Goalie 5", "G", None)
    assert (rows[6].full_name, rows[6].position_group, rows[6].position_code) == ("Skater 6", "G", "?")


def test_team_spine(spark):
    landing = staging.stg_landing(
        b.bronze(
            spark,
            E.LANDING,
            [(GAME, b.landing(), b.at(1)), (GAME + 1, b.landing(GAME + 1, awayTeam=b.team(8, "NEW"), homeTeam=b.team(9, "OTT")), b.at(2))],
        )
    )
    summary = staging.stg_team_summary(b.bronze(spark, E.TEAM_SUMMARY, [("20242025", b.summary(b.team_row(8)))]))
    rows = {r.team_id: r for r in core.dim_team(intermediate.int_team_spine(landing, summary)).collect()}
    assert {k: (r.team_abbrev, r.team_full_name) for k, r in rows.items()} == {
        8: ("NEW", "Team 8"), 9: ("OTT", None), 14: ("TBL", None)
    }
    assert rows[14].external_ids == '{"nhl_api_team_id":14}' and rows[14].arena_name is None
    assert rows[14].league_id == 1


# Core columns in order.
CORE_COLUMNS = {
    "dim_sport": "sport_id sport_name sport_slug",
    "dim_league": "league_id sport_id league_name league_abbreviation country_code",
    "dim_team": "team_id league_id team_abbrev team_full_name arena_name city state_province country_code external_ids",
    "dim_player": "player_id full_name first_name last_name position_group position_code shoots_catches height_in "
    "weight_lb birth_date birth_country external_ids",
    "fct_game": "game_id league_id season game_datetime_utc home_team_id away_team_id venue_team_id game_type status",
    "fct_game_outcome": "game_id home_goals away_goals period_end winning_team_id home_win",
    "fct_game_event": "game_id period period_time_elapsed_s x_coord y_coord team_id primary_player_id "
    "secondary_player_id details_json event_id event_type",
    "fct_game_lineup": "lineup_id game_id team_id player_id position_type toi_s goals assists shots saves goals_against",
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    people = [b.person(i) for i in (1, 2, 3, 6, 8)]
    bodies = {
        E.LANDING: (GAME, b.landing()),
        E.BOXSCORE: (GAME, b.boxscore()),
        E.PLAY_BY_PLAY: (GAME, b.play_by_play()),
        E.ROSTER: ("20252026|TOR", b.roster(people, [], [b.person(i, "G") for i in (4, 5)])),
        E.CLUB_SCHEDULE: ("20252026|TOR", b.club_schedule(20252026)),
        E.SKATER_SUMMARY: ("20252026", b.summary(b.skater_row(1, 20252026))),
        E.GOALIE_SUMMARY: ("20252026", b.summary(b.goalie_row(4, 20252026))),
        E.TEAM_SUMMARY: ("20252026", b.summary(b.team_row(8, 20252026))),
    }
    for family, row in bodies.items():
        write_bronze(b.bronze(spark, family, [row]), base, family, "2026-05-12")
    return base


def test_build_silver_stores_everything(spark, lake, tmp_path):
    models = build_silver(spark, lake, str(tmp_path))
    stored = {p.name for layer in ("staging", "core") for p in (tmp_path / layer).iterdir()}
    assert {n for n in MODELS if not n.startswith("int_")} == stored
    for name, columns in CORE_COLUMNS.items():
        assert models[name].columns == columns.split()
        assert "core/" in models[name].inputFiles()[0]
    lazy = lake_models(spark, lake)
    for name in CORE:
        assert sorted(map(str, models[name].collect())) == sorted(map(str, lazy[name].collect()))


def test_declared_tests(spark, lake):
    models = lake_models(spark, lake)
    failed = {(r.model, r.column, r.test): r.failures for r in check_tables(models).collect() if r.failures}
    # Player 7 is only in the boxscore and the plays: a known gap of the player dimension.
    assert failed == {
        ("fct_game_event", "secondary_player_id", "relationships"): 1,
        ("fct_game_lineup", "player_id", "relationships"): 1,
    }


def test_declared_test_counts():
    count = lambda kind: sum(len(getattr(c, kind)) for c in CONTRACTS.values())
    assert [count(k) for k in ("not_null", "unique", "accepted", "relationships")] == [123, 14, 15, 15]


def test_declared_tests_catch_faults(spark, lake):
    models = lake_models(spark, lake)
    wrong = models["fct_game"].withColumns({"status": F.lit("LIVE"), "home_team_id": F.lit(99)})
    tables = Models(spark, lambda family: None, {"fct_game": wrong.union(wrong), "dim_team": models["dim_team"], "dim_league": models["dim_league"]})
    failed = {(r.column, r.test): r.failures for r in check_table("fct_game", tables).collect() if r.failures}
    assert failed == {("status", "accepted_values"): 2, ("game_id", "unique"): 1, ("home_team_id", "relationships"): 2}


def test_views_for_sql_users(spark, lake):
    create_views(lake_models(spark, lake), ["fct_game", "fct_game_outcome"])
    row = spark.sql("SELECT season, home_win FROM fct_game JOIN fct_game_outcome USING (game_id)").first()
    assert tuple(row) == ("20252026", True)


def test_only_needed_columns_are_shuffled(spark, lake):
    plan = lake_models(spark, lake)["fct_game_outcome"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<fetched_at_utc:timestamp,response_json:string,response_sha256:string>" in plan
    exchange = next(line for line in plan.splitlines() if "Exchange" in line)
    assert plan.count("Exchange hash") == 1 and "response_json" not in exchange
