from datetime import date

import pytest
from pyspark.sql import functions as F

from moraine.plans import backfill as bf
from moraine.plans import worklists as wl
from moraine.plans.staging import stg_landing
from moraine.plans.costs import CostCheckTripped, check_cost, project_cost
from moraine.functions.calendar import active_members, season_range
from moraine.sources import endpoints as E
from moraine.sources import manifest as mf
from moraine.sources.bronze import read_bronze
from moraine.sources.landed import read_landed
from moraine.sources.manifest import read_manifest
from moraine.streaming.ingest import ingest_batch, ingest_stream

from . import bodies as b

GAME = 2025020001
DAY = "2025-10-07"


def save(spark, path, family, rows, fmt="json"):
    """Add saved responses to a landing folder."""
    df = b.landed(spark, rows).withColumn("family", F.lit(family))
    df.coalesce(1).write.mode("append").partitionBy("family").format(fmt).save(str(path))


def save_game(spark, path, game_id, families=E.GAME_FAMILIES, **changes):
    make = {E.LANDING: b.landing, E.BOXSCORE: b.boxscore, E.PLAY_BY_PLAY: b.play_by_play}
    for family in families:
        save(spark, path, family, [(game_id, make[family](game_id, **changes))])


def save_week(spark, path, day=DAY, games=None):
    games = [b.scheduled(GAME), b.scheduled(GAME + 1, "FINAL"), b.scheduled(GAME + 2, "LIVE")] if games is None else games
    save(spark, path, E.SCHEDULE, [(day, b.schedule({"2025-10-06": [], day: games}))])


def load_of(spark, tmp_path, run, **options):
    return bf.Load(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), run, date(2026, 5, 12), **options)


def rows_in(spark, tmp_path, family):
    return read_bronze(spark, str(tmp_path / "lake"), family)


def logged(spark, tmp_path):
    return read_manifest(spark, E.LakePaths(str(tmp_path / "lake")).manifest)


def test_a_day_then_the_same_day_again(spark, tmp_path):
    landing = tmp_path / "landing"
    save_week(spark, landing)
    for g in (GAME, GAME + 1):
        save_game(spark, landing, g)
    first = bf.load_day(load_of(spark, tmp_path, "one"), date(2025, 10, 7))
    assert (first.in_schedule, first.eligible, first.skipped, first.loaded) == (3, 2, 0, 2)
    entries = logged(spark, tmp_path).collect()
    assert len(entries) == 6 and {e.run_id for e in entries} == {"one"} and all(e.bytes > 0 and e.rows == 1 for e in entries)
    assert {r.entity_id for r in rows_in(spark, tmp_path, E.LANDING).collect()} == {str(GAME), str(GAME + 1)}
    # Again: nothing to do, nothing written.
    again = bf.load_day(load_of(spark, tmp_path, "two"), date(2025, 10, 7))
    assert (again.skipped, again.loaded) == (2, 0)
    assert logged(spark, tmp_path).count() == 6 and rows_in(spark, tmp_path, E.LANDING).count() == 2


def test_parquet_landing(spark, tmp_path):
    landing = tmp_path / "landing"
    for family, body in zip(E.SUMMARY_FAMILIES, (b.skater_row, b.goalie_row, b.team_row)):
        save(spark, landing, family, [(s, b.summary(body(1, int(s)))) for s in ("20232024", "20242025")], "parquet")
    load = load_of(spark, tmp_path, "run", landing_format="parquet", manifest_format="parquet")
    for wanted in (1, 0):
        units = spark.createDataFrame([("20242025",), ("20252026",)], "scope_key string")
        result = bf.run_phase(load, "season-summaries", units)
        assert (result.loaded, result.skipped, result.waiting) == (wanted, 1 - wanted, 1)
        load = load_of(spark, tmp_path, "again", landing_format="parquet", manifest_format="parquet")
    assert {r.entity_id for r in rows_in(spark, tmp_path, E.TEAM_SUMMARY).collect()} == {"20242025"}


def test_pending_keys_are_joined_whatever_their_number(spark, tmp_path):
    save(spark, tmp_path, E.LANDING, [(GAME, b.landing(GAME))], "parquet")
    load = bf.Load(spark, str(tmp_path), str(tmp_path), "run", date(2026, 5, 12), "parquet")
    plan = load.landed(E.LANDING)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(family" in plan


def test_a_later_day_opens_no_file_of_an_earlier_one(spark, tmp_path):
    landing = tmp_path / "landing"
    for day, game in (("2026-05-11", GAME), ("2026-05-12", GAME + 1)):
        rows = b.landed(spark, [(game, b.landing(game))]).withColumns({"family": F.lit(E.LANDING), "arrived": F.lit(day)})
        rows.write.mode("append").partitionBy("family", "arrived").json(str(landing))
    load = load_of(spark, tmp_path, "run", since=date(2026, 5, 12))
    rows = load.landed(E.LANDING)
    assert [r.scope_key for r in rows.collect()] == [str(GAME + 1)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "arrived" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert rows.select(F.input_file_name()).distinct().count() == 1
    assert read_landed(spark, str(landing), E.LANDING, until="2026-05-11").count() == 1


def test_a_partly_logged_game_is_loaded_whole(spark, tmp_path):
    landing = tmp_path / "landing"
    save_week(spark, landing)
    save_game(spark, landing, GAME, [E.LANDING, E.BOXSCORE])
    save_game(spark, landing, GAME + 1)
    bf.load_day(load_of(spark, tmp_path, "one"), date(2025, 10, 7))
    assert logged(spark, tmp_path).count() == 5
    save_game(spark, landing, GAME, [E.PLAY_BY_PLAY])
    second = bf.load_day(load_of(spark, tmp_path, "two"), date(2025, 10, 7))
    assert (second.skipped, second.loaded) == (1, 1)
    new = logged(spark, tmp_path).where("run_id = 'two'").collect()
    assert {(e.scope_key, e.endpoint) for e in new} == {(str(GAME), t) for t in E.templates_of([E.PLAY_BY_PLAY])}
    # What was stored and logged before is not appended again.
    assert rows_in(spark, tmp_path, E.LANDING).where(F.col("entity_id") == str(GAME)).count() == 1


def test_reruns_with_an_absent_sibling_change_nothing(spark, tmp_path):
    landing = tmp_path / "landing"
    save_week(spark, landing, games=[b.scheduled(GAME)])
    save_game(spark, landing, GAME, [E.LANDING, E.BOXSCORE])
    counts = []
    for run in ("one", "two", "three"):
        result = bf.load_day(load_of(spark, tmp_path, run), date(2025, 10, 7))
        counts.append((result.loaded, logged(spark, tmp_path).count(), rows_in(spark, tmp_path, E.LANDING).count()))
    assert counts == [(1, 2, 1), (0, 2, 1), (0, 2, 1)]
    # A changed body is new.
    save(spark, landing, E.LANDING, [(GAME, b.landing(GAME, regPeriods=4))])
    assert bf.load_day(load_of(spark, tmp_path, "four"), date(2025, 10, 7)).loaded == 1
    assert rows_in(spark, tmp_path, E.LANDING).count() == 2


def test_a_body_fetched_again_after_another_is_the_latest(spark, tmp_path):
    landing = tmp_path / "landing"
    save_week(spark, landing, games=[b.scheduled(GAME)])
    save_game(spark, landing, GAME, [E.BOXSCORE])
    for run, (hour, periods) in enumerate([(10, 3), (11, 4), (12, 3)]):
        save(spark, landing, E.LANDING, [(GAME, b.landing(GAME, regPeriods=periods), b.at(hour))])
        bf.load_day(load_of(spark, tmp_path, f"run{run}"), date(2025, 10, 7))
    assert rows_in(spark, tmp_path, E.LANDING).count() == 3
    assert stg_landing(rows_in(spark, tmp_path, E.LANDING)).first().reg_periods == 3


def test_rerun_of_a_crashed_run_replaces_its_own_output(spark, tmp_path):
    landing = tmp_path / "landing"
    save_week(spark, landing)
    save_game(spark, landing, GAME)
    load = load_of(spark, tmp_path, "run")
    bodies = load.landed(E.LANDING)
    bf.write_family(load, bodies, E.LANDING, "run-games")  # written, never logged
    bf.load_day(load, date(2025, 10, 7))
    assert rows_in(spark, tmp_path, E.LANDING).count() == 1


def test_rejected_bodies_stay_out(spark, tmp_path):
    landing = tmp_path / "landing"
    save_week(spark, landing)
    save_game(spark, landing, GAME, season=20242025)  # id and season disagree
    save_game(spark, landing, GAME + 1)
    load = load_of(spark, tmp_path, "run")
    units = bf.game_units(load, spark.createDataFrame([(DAY,)], "scope_key string"))
    result = bf.run_phase(load, "games", units)
    assert (result.loaded, result.refused, result.rejected, result.appended) == (1, 1, 3, 3)
    assert [r.entity_id for r in rows_in(spark, tmp_path, E.BOXSCORE).collect()] == [str(GAME + 1)]
    saved = spark.read.parquet(f"{load.paths.rejects(E.LANDING)}/run-games.parquet").collect()
    assert [(r.scope_key, r.reason) for r in saved] == [(str(GAME), "id_season_mismatch")]
    strict = load_of(spark, tmp_path, "strict", strict=True)
    before = logged(spark, tmp_path).count()
    with pytest.raises(bf.RejectedBodies):
        bf.run_phase(strict, "games", units)
    assert logged(spark, tmp_path).count() == before


def test_missing_or_bad_schedules_raise(spark, tmp_path):
    from moraine.plans.schedule import ScheduleDayNotFound

    landing = tmp_path / "landing"
    save(spark, landing, E.SCHEDULE, [("2025-10-08", b.schedule({"2025-10-07": []})), ("2025-10-09", {"x": 1})])
    load = load_of(spark, tmp_path, "run")
    with pytest.raises(FileNotFoundError):
        bf.load_day(load, date(2025, 12, 24))
    with pytest.raises(ScheduleDayNotFound):
        bf.load_day(load, date(2025, 10, 8))
    with pytest.raises(bf.RejectedBodies, match="missing:gameWeek"):
        bf.load_day(load, date(2025, 10, 9))


def fill_season(spark, landing):
    """A whole small 2025-26 season: three teams arrived, one of them half missing."""
    save(spark, landing, E.ROSTER, [
        ("20252026|TOR", b.roster([b.person(1)])),
        ("20252026|MTL", b.roster()),
        ("20252026|UTA", "<html>none</html>", b.FETCHED, 404),
    ])
    save(spark, landing, E.CLUB_SCHEDULE, [(f"20252026|{t}", b.club_schedule(20252026)) for t in ("TOR", "MTL", "UTA")])
    for family, row in ((E.SKATER_SUMMARY, b.skater_row), (E.GOALIE_SUMMARY, b.goalie_row), (E.TEAM_SUMMARY, b.team_row)):
        save(spark, landing, family, [("20252026", b.summary(row(1, 20252026)))])
    save_week(spark, landing)
    save_week(spark, landing, "2025-10-08", [b.scheduled(GAME + 5)])
    save_week(spark, landing, "2024-10-08", [b.scheduled(2024020001, season=20242025)])  # another season
    for g in (GAME, GAME + 1, GAME + 5):
        save_game(spark, landing, g)


def backfill(spark, tmp_path, **options):
    settings = {"seasons": ["2025-26"], "ingest_date": date(2026, 5, 12), **options}
    return bf.run_backfill(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), **settings)


def test_backfill_runs_resumes_and_stops(spark, tmp_path):
    fill_season(spark, tmp_path / "landing")
    first = backfill(spark, tmp_path, run_id="one")
    got = {p.phase: (p.attempted, p.skipped, p.loaded, p.waiting, p.rejected, p.appended) for p in first.phases}
    assert list(got) == ["team-season", "season-summaries", "games"] and not first.aborted
    assert got["team-season"] == (32, 0, 3, 29, 0, 5)  # the 404 logs nothing, its sibling does
    assert got["season-summaries"] == (1, 0, 1, 0, 0, 3)
    assert got["games"] == (3, 0, 3, 0, 0, 9)
    assert {e.run_id for e in logged(spark, tmp_path).collect()} == {"one"} and len(first.projections) == 3
    # Resume: only the pair with a missing resource is tried again.
    second = backfill(spark, tmp_path, run_id="two")
    again = {p.phase: (p.skipped, p.loaded, p.appended) for p in second.phases}
    assert again == {"team-season": (2, 0, 0), "season-summaries": (1, 0, 0), "games": (3, 0, 0)}
    assert rows_in(spark, tmp_path, E.ROSTER).count() == 2

    # One phase alone, and a cost trip in each mode.
    assert [p.phase for p in backfill(spark, tmp_path, loader="games").phases] == ["games"]
    tripped = backfill(spark, tmp_path, threshold=1e-12)
    assert tripped.aborted and "above" in tripped.aborted_reason and len(tripped.phases) == 1
    for mode in ("warn", "off"):
        free = backfill(spark, tmp_path, loader="season-summaries", threshold=1e-12, cost_check=mode)
        assert not free.aborted and free.projections[-1]["tripped"]


@pytest.mark.parametrize("bad", [{"loader": "everything"}, {"seasons": ["2025-27"]}])
def test_backfill_arguments(spark, tmp_path, bad):
    with pytest.raises(ValueError):
        backfill(spark, tmp_path, **bad)


def manifest_of(spark, sizes):
    return spark.createDataFrame([("r", "/e", str(i), b.FETCHED, 1, n, "ok" if i else "failed") for i, n in enumerate(sizes)], mf.MANIFEST)


def test_cost_projection(spark):
    row = project_cost(manifest_of(spark, [2**29, 2**29])).first()
    assert (row.bytes_cumulative, row.gigabytes_cumulative, row.monthly_cost_usd, row.tripped) == (2**30, 1.0, 0.015, False)
    empty = project_cost(manifest_of(spark, [1]).limit(0)).first()
    assert (empty.bytes_cumulative, empty.monthly_cost_usd, empty.tripped) == (0, 0.0, False)
    at_limit = project_cost(manifest_of(spark, [2**30]), rate=5.0, threshold=5.0)
    assert not at_limit.first().tripped
    above = project_cost(manifest_of(spark, [2**30 + 1]), rate=5.0, threshold=5.0)
    with pytest.raises(CostCheckTripped):
        check_cost(above, "fail")
    assert check_cost(above, "warn")["tripped"] and check_cost(above, "off")["tripped"]
    with pytest.raises(ValueError):
        check_cost(above, "sometimes")


def test_work_lists(spark):
    seasons = season_range(spark, "2016-17", "2017-18")
    units = wl.in_work_order(wl.team_season_units(seasons), "season", "team").collect()
    assert len(units) == 61 and units[0].scope_key == "20162017|ANA" and units[-1].scope_key == "20172018|WSH"
    assert [u.scope_key for u in wl.summary_units(seasons).orderBy("scope_key").collect()] == ["20162017", "20172018"]
    days = wl.game_day_units(seasons)
    assert days.count() == 606 and days.agg(F.min("scope_key")).first()[0] == "2016-09-01"


def test_membership_is_no_join(spark):
    plan = active_members(spark.range(2015, 2026), F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_stream_ingests_new_files_once(spark, tmp_path):
    landing, lake, checkpoint = (str(tmp_path / n) for n in ("landing", "lake", "checkpoint"))
    save_game(spark, landing, GAME)
    save(spark, landing, E.LANDING, [(GAME + 9, b.landing(GAME))])  # not what was asked for
    save_week(spark, landing)  # schedules are not bronze

    def run():
        query = ingest_stream(spark, landing, lake, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None

    run()
    assert logged(spark, tmp_path).count() == 3
    assert rows_in(spark, tmp_path, E.LANDING).count() == 1
    run()  # no new files
    save_game(spark, landing, GAME)  # the same game again: logged already
    save_game(spark, landing, GAME + 1)
    run()
    entries = logged(spark, tmp_path).collect()
    assert len(entries) == 6 and {e.scope_key for e in entries} == {str(GAME), str(GAME + 1)}
    assert rows_in(spark, tmp_path, E.PLAY_BY_PLAY).count() == 2


def test_stream_reads_each_batch_once_and_files_by_run_date(spark, tmp_path):
    landing, lake, checkpoint = (str(tmp_path / n) for n in ("landing", "lake", "checkpoint"))
    save_game(spark, landing, GAME)
    late = b.FETCHED.replace(year=2099)
    save(spark, landing, E.LANDING, [(GAME + 1, b.landing(GAME + 1), late)])
    query = ingest_stream(spark, landing, lake, checkpoint, manifest_format="parquet", ingest_date=date(2026, 5, 1))
    query.awaitTermination(120)
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == 4
    assert {r.ingest_date for r in rows_in(spark, tmp_path, E.LANDING).collect()} == {date(2026, 5, 1)}
    # A second stream over the same lake reads its Parquet manifest.
    save_game(spark, landing, GAME + 2)
    query = ingest_stream(spark, landing, lake, checkpoint, manifest_format="parquet", ingest_date=date(2026, 5, 2))
    query.awaitTermination(120)
    assert query.exception() is None
    assert read_manifest(spark, E.LakePaths(lake).manifest, "parquet").count() == 7
    assert not (tmp_path / "lake" / "_arriving").exists() or not list((tmp_path / "lake" / "_arriving").iterdir())


def test_strict_batches_fail_on_rejects(spark, tmp_path):
    batch = b.landed(spark, [(GAME + 9, b.landing(GAME))]).withColumn("family", F.lit(E.LANDING))
    with pytest.raises(bf.RejectedBodies):
        ingest_batch(batch, 0, str(tmp_path / "lake"), strict=True)


def test_replayed_batch_replaces_itself(spark, tmp_path):
    lake = str(tmp_path / "lake")
    batch = b.landed(spark, [(GAME, b.landing(GAME))]).withColumn("family", F.lit(E.LANDING))
    for _ in range(2):
        assert ingest_batch(batch, 0, lake) == 1
    assert logged(spark, tmp_path).count() == 1 and rows_in(spark, tmp_path, E.LANDING).count() == 1
    assert ingest_batch(batch, 1, lake) == 0
    assert rows_in(spark, tmp_path, E.LANDING).count() == 1
