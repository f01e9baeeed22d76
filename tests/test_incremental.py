"""Kept latest rows and facts by season against whole rebuilds."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import moraine as m
from moraine.plans import incremental
from moraine.plans.silver import CORE, STAGING, lake_models
from moraine.plans.staging import STAGES
from moraine.sources import endpoints as E
from moraine.sources import versioned
from moraine.sources.bronze import write_bronze

from . import bodies as b

SEASONS = {2023: "20232024", 2024: "20242025", 2025: "20252026"}


def rows(df):
    return sorted(map(str, df.collect()))


def save(spark, base, day, batch):
    """Write one day's fetches: {family: [(key, body, time)]}."""
    for family, fetched in batch.items():
        if fetched:
            write_bronze(b.bronze(spark, family, fetched), base, family, day)


def game_batch(rng, ids, hour):
    """One fetch of each game in each family; bodies differ from fetch to fetch."""
    out = {E.LANDING: [], E.BOXSCORE: [], E.PLAY_BY_PLAY: []}
    for k, i in enumerate(ids):
        t = b.at(0) + timedelta(hours=hour, minutes=k)
        kind = rng.choice([2, 2, 3, 1])
        out[E.LANDING].append((str(i), b.landing(i, gameType=kind, gameState=rng.choice(["OFF", "FINAL"])), t))
        out[E.BOXSCORE].append((str(i), b.boxscore(i, gameType=kind), t))
        out[E.PLAY_BY_PLAY].append((str(i), b.play_by_play(i, gameType=kind), t))
    return out


def season_batch(rng, season, hour):
    t = b.at(0) + timedelta(hours=hour)
    people = [b.person(rng.randint(1, 9), "C") for _ in range(3)]
    return {
        E.ROSTER: [(f"{season}|TOR", b.roster(people, [], [b.person(4, "G")]), t)],
        E.CLUB_SCHEDULE: [(f"{season}|TOR", b.club_schedule(int(season)), t)],
        E.SKATER_SUMMARY: [(season, b.summary(b.skater_row(rng.randint(1, 9), int(season))), t)],
        E.GOALIE_SUMMARY: [(season, b.summary(b.goalie_row(4, int(season))), t)],
        E.TEAM_SUMMARY: [(season, b.summary(b.team_row(rng.choice([8, 14]), int(season))), t)],
    }


def parts_of(spark, out, table):
    """Part: the names of its files."""
    now = versioned.current(spark, f"{out}/{table}").parts
    return {p: {f.name for f in (out / table / folder).glob("*.parquet")} for p, folder in now.items()}


def test_late_repeated_and_new_fetches_equal_a_ranking_of_all(spark, tmp_path):
    base, path, rng = str(tmp_path / "lake"), str(tmp_path / "kept"), random.Random(3)
    ids = [year * 1_000_000 + 20_001 + k for year in SEASONS for k in range(2)]
    stage = STAGES["stg_landing"]
    for turn, hour in enumerate((0, 30, -40, 12)):
        batch = {E.LANDING: game_batch(rng, rng.sample(ids, 3), hour)[E.LANDING]}
        save(spark, base, f"2026-01-0{turn + 1}", batch)
        new = m.read_bronze(spark, base, E.LANDING, f"2026-01-0{turn + 1}")
        m.merge_latest(spark, path, stage, new)
    assert m.merge_latest(spark, path, stage, new) == []  # the same fetches once more
    assert rows(stage.finish(m.read_parts(spark, path))) == rows(stage(m.read_bronze(spark, base, E.LANDING)))


def test_daily_builds(spark, tmp_path, monkeypatch):
    """First build; a day of one season; a build that ends half way; all as a whole rebuild would have it."""
    base, out, rng = str(tmp_path / "lake"), tmp_path / "silver", random.Random(5)
    ids = [year * 1_000_000 + 20_001 + k for year in SEASONS for k in range(2)]
    save(spark, base, "2026-01-01", game_batch(rng, ids, 0) | season_batch(rng, SEASONS[2025], 0))
    first = m.update_silver(spark, base, str(out))
    assert first.merged["stg_landing"] and first.dimensions == ["dim_team", "dim_player"]

    before = {t: parts_of(spark, out, t) for t in ("core/fct_game", "kept/stg_landing")}
    opened, real = [], incremental.read_parts

    def watched(spark, path, parts=None, at=None, schema=None):
        df = real(spark, path, parts, at, schema)
        if "dim_" not in path:
            opened.extend(df.inputFiles())
        return df

    day = game_batch(rng, ids[:1], 50)
    save(spark, base, "2026-01-02", {k: [(key, body | {"gameType": 2}, t) for key, body, t in v] for k, v in day.items()})
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "read_parts", watched)
        done = m.update_silver(spark, base, str(out), since="2026-01-02", tables=list(incremental.FACTS))
    assert done.facts == {name: ["2023"] for name in incremental.FACTS} and not done.dimensions
    assert opened and all(f"{versioned.PART}=2023" in f for f in opened)
    for table, held in before.items():
        now = parts_of(spark, out, table)
        assert all(now[p] == held[p] for p in held if p != "2023") and not now["2023"] & held.get("2023", set())

    # Late fetches of earlier days, and a season seen for the first time.
    save(spark, base, "2026-01-03", game_batch(rng, ids[1:4], -60) | season_batch(rng, SEASONS[2024], 60))
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "_update_fact", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            m.update_silver(spark, base, str(out))
    m.update_silver(spark, base, str(out))
    kept, whole = m.kept_models(spark, str(out)), lake_models(spark, base)
    for name in [*STAGING, *CORE]:
        assert kept[name].columns == whole[name].columns
        assert rows(kept[name]) == rows(whole[name]), name
    again = m.update_silver(spark, base, str(out))
    assert not any(again.merged.values()) and not any(again.facts.values()) and not again.dimensions


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    part = F.col("k").cast("string")
    data = lambda *pairs: spark.createDataFrame(pairs, "k int, v string")
    one = m.replace_parts(data((1, "a"), (2, "b"), (None, "c")), path, part, ["1", "2", "none"], versioned.current(spark, path))
    held = m.read_parts(spark, path, at=one)
    two = m.replace_parts(data((2, "B")), path, part, ["2", "none"], one)
    assert sorted(tuple(r) for r in m.read_parts(spark, path).collect()) == [(1, "a"), (2, "B")]
    assert len(held.collect()) == 3  # a reader of the earlier snapshot
    with pytest.raises(versioned.SnapshotTaken):
        m.replace_parts(data((1, "x")), path, part, ["1"], one)
    with pytest.raises(Exception, match="row of another part"):
        m.replace_parts(data((3, "x")), path, part, ["1"], two)
    assert sorted(tuple(r) for r in m.read_parts(spark, path).collect()) == [(1, "a"), (2, "B")]
    m.replace_parts(data(), path, part, ["2"], two)
    assert m.remove_unused(spark, path, keep=1) >= 2
    assert [tuple(r) for r in m.read_parts(spark, path).collect()] == [(1, "a")]
    with pytest.raises(FileNotFoundError):
        m.read_parts(spark, str(tmp_path / "absent"))
