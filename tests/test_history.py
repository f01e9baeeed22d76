"""Loads whose cost follows what is new: the index of fetches and the manifest's snapshot."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from moraine.plans import backfill as bf
from moraine.sources import endpoints as E
from moraine.sources import fetches, manifest, versioned
from moraine.sources.bronze import read_bronze

from . import bodies as b
from .test_loads import load_of, save, save_game


def units(spark, *keys):
    return spark.createDataFrame([(str(k),) for k in keys], "scope_key string")


def body(game, **changes):
    year = game // 1_000_000
    return b.landing(game, season=year * 10_000 + year + 1, **changes)


def test_a_load_opens_the_years_of_its_own_units(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    games = [year * 1_000_000 + 20_001 for year in (2021, 2022, 2023)]
    for g in games:
        save(spark, landing, E.LANDING, [(g, body(g))])
    run = lambda name, *keys: bf.run_phase(load_of(spark, tmp_path, name), "games", units(spark, *keys))
    assert run("one", *games).loaded == 3
    path = fetches.fetch_index(str(tmp_path / "lake"), E.LANDING)
    before = versioned.current(spark, path)
    assert set(before.parts) == {"2021", "2022", "2023"}

    # The next load opens one part.
    opened, read = [], fetches.read_parts
    monkeypatch.setattr(fetches, "read_parts", lambda *a, **k: opened.append(read(*a, **k).inputFiles()) or read(*a, **k))
    save(spark, landing, E.LANDING, [(games[2], body(games[2], regPeriods=4), b.at(23))])
    assert run("two", games[2]).loaded == 1
    read_files = [f for found in opened for f in found if f"/{E.LANDING}/" in f]
    assert read_files and all(f"{versioned.PART}=2023" in f for f in read_files)
    after = versioned.current(spark, path)
    assert {p: after.parts[p] == before.parts[p] for p in after.parts} == {"2021": True, "2022": True, "2023": False}
    # Loaded again, nothing is appended.
    assert run("three", *games).loaded == 0
    assert read_bronze(spark, str(tmp_path / "lake"), E.LANDING).count() == 4


def test_a_lake_without_an_index_gets_one(spark, tmp_path, monkeypatch):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    save_game(spark, landing, 2023020001, [E.LANDING], season=20232024)
    with monkeypatch.context() as patch:
        patch.setattr(bf, "index_fetches", lambda *a: None)
        bf.run_phase(load_of(spark, tmp_path, "old"), "games", units(spark, 2023020001))
    save_game(spark, landing, 2023020002, [E.LANDING], season=20232024)
    bf.run_phase(load_of(spark, tmp_path, "new"), "games", units(spark, 2023020001, 2023020002))
    assert read_bronze(spark, lake, E.LANDING).count() == 2
    rows = versioned.read_parts(spark, fetches.fetch_index(lake, E.LANDING)).collect()
    assert sorted((r.scope_key, r.batch) for r in rows) == [("2023020001", ""), ("2023020002", "new-games")]


def test_a_batch_tried_again_replaces_its_entries(spark, tmp_path):
    base = str(tmp_path)
    rows = lambda *keys: spark.createDataFrame([(k, b.at(1), "d") for k in keys], "scope_key string, fetched_at_utc timestamp, digest string")
    fetches.index_fetches(spark, base, "f", rows("2021x", "2022x"), "a")
    fetches.index_fetches(spark, base, "f", rows("2022y", "2023y"), "b")
    fetches.index_fetches(spark, base, "f", rows("2023z"), "b")
    held = versioned.read_parts(spark, fetches.fetch_index(base, "f")).collect()
    assert sorted((r.scope_key, r.batch) for r in held) == [("2021x", "a"), ("2022x", "a"), ("2023z", "b")]
    fetches.index_fetches(spark, base, "f", rows(), "c")
    assert fetches.known_fetches(spark, base, "f", units(spark, "2021q"), "a").count() == 0
    assert fetches.known_fetches(spark, base, "f", units(spark, "2021q", "2023q"), "b").count() == 1


def entry(run, key, endpoint="/e", n=1):
    return (run, endpoint, key, b.at(2), n, 10, "ok")


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_manifest_snapshot(spark, tmp_path, monkeypatch, fmt):
    path = str(tmp_path / "runs")
    log = lambda batch, *rows: manifest.append_manifest(spark.createDataFrame(list(rows), manifest.MANIFEST), path, fmt, batch)
    keys = lambda: sorted((r.run_id, r.scope_key, r.rows) for r in manifest.read_manifest(spark, path, fmt).collect())
    assert manifest.snapshot_manifest(spark, path, fmt) == 0
    log("a", entry("a", "1"), entry("a", "2", "/f"))
    log("b", entry("b", "3"))
    whole = keys()
    assert manifest.snapshot_manifest(spark, path, fmt) == 3 and keys() == whole
    # Only entries after the snapshot are opened from the log.
    log("c", entry("c", "4"))
    opened = [f for f in manifest.read_manifest(spark, path, fmt).inputFiles() if "/runs/" in f]
    assert opened and all("/runs/c/" in f for f in opened)
    assert keys() == [*whole, ("c", "4", 1)]
    # A batch that is written again counts as it is now.
    log("a", entry("a", "9", "/g", 7))
    again = [("a", "9", 7), ("b", "3", 1), ("c", "4", 1)]
    assert keys() == again
    # A snapshot that ends half way changes nothing; the next one takes all in.
    with monkeypatch.context() as patch:
        patch.setattr(versioned, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            manifest.snapshot_manifest(spark, path, fmt)
    assert keys() == again
    assert manifest.snapshot_manifest(spark, path, fmt) == 2 and keys() == again
    assert not [f for f in manifest.read_manifest(spark, path, fmt).inputFiles() if "/runs/" in f]
    assert manifest.snapshot_manifest(spark, path, fmt) == 0


def test_loads_gate_on_the_snapshot(spark, tmp_path):
    landing = tmp_path / "landing"
    save(spark, landing, E.TEAM_SUMMARY, [("20242025", b.summary(b.team_row(8, 20242025)))])
    load = load_of(spark, tmp_path, "one")
    wanted = units(spark, "20242025")
    bf.run_phase(load, "season-summaries", wanted)
    manifest.snapshot_manifest(spark, load.paths.manifest)
    assert load.manifest().where(F.col("scope_key") == "20242025").count() == 1
    result = bf.run_phase(load_of(spark, tmp_path, "two"), "season-summaries", wanted)
    assert (result.loaded, result.skipped) == (0, 0) and date(2026, 5, 12) == load.ingest_date
