import hashlib
import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from moraine.sources import bronze as br
from moraine.sources import manifest as mf
from moraine.sources import tables
from moraine.sources.landed import read_landed

from . import bodies as b


def envelope_rows(spark, n=2, **changes):
    df = spark.createDataFrame([(i, f'{{"id": {i}, "é": "x"}}', b.FETCHED) for i in range(n)], "k long, response_json string, t timestamp")
    options = {"season": F.lit("20252026"), "event_date": F.lit("2026-05-11"), **changes}
    return br.to_envelope(df, "/v1/{id}", F.col("k"), {"id": F.col("k")}, F.col("t"), **options)


def test_envelope_schema_hash_and_params(spark):
    df = envelope_rows(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in br.ENVELOPE]
    for row in df.collect():
        assert row.response_sha256 == hashlib.sha256(row.response_json.encode()).hexdigest()
        assert row.endpoint_params_json == json.dumps({"id": int(row.entity_id)}, sort_keys=True)
        assert (row.season, row.event_date, row.endpoint) == ("20252026", date(2026, 5, 11), "/v1/{id}")


def test_supplied_hash_is_kept(spark):
    assert {r.response_sha256 for r in envelope_rows(spark, sha256=F.lit("given")).collect()} == {"given"}


def test_time_without_zone_is_refused(spark):
    df = spark.createDataFrame([("{}",)], "response_json string").withColumn("t", F.lit("2026-01-01").cast("timestamp_ntz"))
    with pytest.raises(ValueError, match="instant"):
        br.to_envelope(df, "/e", F.lit("1"), {"a": F.lit(1)}, F.col("t"))


def test_write_layout_counts_and_round_trip(spark, tmp_path):
    base = str(tmp_path)
    first = br.write_bronze(envelope_rows(spark, 3), base, "landing", date(2026, 5, 12))
    second = br.write_bronze(envelope_rows(spark, 2), base, "landing", "2026-05-13", file_id="run-1")
    assert first.key != second.key and second.key == f"{base}/landing/ingest_date=2026-05-13/run-1.parquet"
    assert (first.rows, second.rows) == (3, 2) and first.bytes > 0 and first.body_bytes > 0
    files = list((tmp_path / "landing").rglob("*.zstd.parquet"))
    assert files
    got = br.read_bronze(spark, base, "landing")
    assert got.dtypes[-1] == ("ingest_date", "date") and got.count() == 5
    assert br.read_bronze(spark, base, "landing", since="2026-05-13").count() == 2
    assert br.read_bronze(spark, base, "landing", until=date(2026, 5, 12)).count() == 3


def test_same_file_id_replaces_only_itself(spark, tmp_path):
    base = str(tmp_path)
    br.write_bronze(envelope_rows(spark, 4), base, "f", "2026-05-12", "a")
    br.write_bronze(envelope_rows(spark, 1), base, "f", "2026-05-12", "other")
    br.write_bronze(envelope_rows(spark, 2), base, "f", "2026-05-12", "a")
    assert br.read_bronze(spark, base, "f").count() == 3


def test_reads_plain_files_in_partition_folders_too(spark, tmp_path):
    base = str(tmp_path)
    br.write_bronze(envelope_rows(spark, 2), base, "f", "2026-05-12", "a")
    part = max((tmp_path / "f").rglob("part-*.parquet"), key=lambda f: f.stat().st_size)
    plain = tmp_path / "f" / "ingest_date=2026-05-13"
    plain.mkdir()
    (plain / "abc.parquet").write_bytes(part.read_bytes())
    days = {r.ingest_date for r in br.read_bronze(spark, base, "f").collect()}
    assert days == {date(2026, 5, 12), date(2026, 5, 13)}


def test_null_in_required_column_fails(spark, tmp_path):
    bad = envelope_rows(spark, 1).withColumn("entity_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="entity_id must not be NULL"):
        br.write_bronze(bad, str(tmp_path), "f", "2026-05-12")


def test_empty_write_is_refused(spark, tmp_path):
    none = envelope_rows(spark, 1).limit(0)
    with pytest.raises(ValueError, match="no rows"):
        br.write_bronze(none, str(tmp_path), "f", "2026-05-12")
    done = br.write_bronze(none, str(tmp_path), "f", "2026-05-12", allow_empty=True)
    assert (done.rows, done.bytes, done.compression) == (0, 0, 0.0)


def test_partition_and_column_pruning(spark, tmp_path):
    br.write_bronze(envelope_rows(spark, 2), str(tmp_path), "f", "2026-05-12")
    narrow = br.read_bronze(spark, str(tmp_path), "f", since="2026-05-12").where("season = '20252026'").select("entity_id")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "EqualTo(season,20252026)" in plan
    assert "ReadSchema: struct<entity_id:string,season:string>" in plan


def entries(spark, rows):
    return spark.createDataFrame([(*r[:3], b.FETCHED, *r[3:]) for r in rows], mf.MANIFEST)


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_manifest_round_trip(spark, tmp_path, fmt):
    path = str(tmp_path / "m")
    assert mf.read_manifest(spark, path, fmt).count() == 0
    assert mf.append_manifest(entries(spark, [("r", "/e", "1", 1, 10, "ok")]), path, fmt, batch="r-a") == 1
    assert mf.append_manifest(entries(spark, [("r", "/e", "2", 1, 20, "bad"), ("r", "/f", "1", 2, 5, "ok")]), path, fmt, batch="r-b") == 2
    assert mf.append_manifest(entries(spark, []), path, fmt, batch="r-c") == 0
    got = mf.read_manifest(spark, path, fmt)
    assert got.count() == 3 and got.agg(F.sum("bytes")).first()[0] == 35
    assert {r.fetched_at_utc.replace(tzinfo=timezone.utc) for r in got.collect()} == {b.FETCHED}


def test_manifest_batch_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "m")
    for _ in range(2):
        mf.append_manifest(entries(spark, [("r", "/e", "1", 1, 10, "ok")]), path, batch="same")
    mf.append_manifest(entries(spark, [("q", "/e", "2", 1, 10, "ok")]), path)
    mf.append_manifest(entries(spark, [("q", "/e", "3", 1, 10, "ok")]), path)
    assert mf.read_manifest(spark, path).count() == 3


LINE = {
    "run_id": "r", "endpoint": "/e", "scope_key": "1", "fetched_at_utc": "2026-05-12T12:00:00.123456+00:00",
    "rows": 1, "bytes": 5,
}


def test_manifest_lines(spark, tmp_path):
    file = tmp_path / "ingest_runs.jsonl"
    file.write_text(json.dumps(LINE) + "\n\n" + json.dumps({**LINE, "status": "failed"}) + "\n   \n")
    rows = mf.read_manifest(spark, str(file)).collect()
    assert sorted(r.status for r in rows) == ["failed", "ok"]
    assert rows[0].fetched_at_utc == datetime(2026, 5, 12, 12, 0, 0, 123456)


@pytest.mark.parametrize("line", ["{not json", json.dumps({k: v for k, v in LINE.items() if k != "bytes"})])
def test_bad_manifest_lines_raise(spark, tmp_path, line):
    file = tmp_path / "m.jsonl"
    file.write_text(json.dumps(LINE) + "\n" + line + "\n")
    with pytest.raises(Exception):
        mf.read_manifest(spark, str(file)).collect()


def test_manifest_rows_add_up_to_stored_bytes(spark, tmp_path):
    rows = envelope_rows(spark, 6)
    done = br.write_bronze(rows, str(tmp_path), "f", "2026-05-12")
    made = mf.manifest_rows(rows, "run", F.col("entity_id"), done.compression).collect()
    assert len(made) == 6 and abs(sum(r.bytes for r in made) - done.bytes) <= 6
    assert {(r.run_id, r.status, r.rows) for r in made} == {("run", "ok", 1)}
    assert len(mf.new_run_id()) == 32 and mf.new_run_id() != mf.new_run_id()


def test_seeds(spark, tmp_path):
    file = tmp_path / "dim_league.csv"
    file.write_text("league_id,sport_id,league_name,league_abbreviation,country_code\n1,1,National Hockey League,NHL,US\n")
    stored = tables.read_seed(spark, str(file), tables.DIM_LEAGUE)
    assert stored.collect() == tables.dim_league(spark).collect()
    assert tables.dim_sport(spark).first().asDict() == {"sport_id": 1, "sport_name": "Ice Hockey", "sport_slug": "ice_hockey"}
    file.write_text("league_id,sport_id,league_name,league_abbreviation,country_code\nx,1,A,B,C\n")
    with pytest.raises(Exception):
        tables.read_seed(spark, str(file), tables.DIM_LEAGUE).collect()


def test_landed_text_files(spark, tmp_path):
    folder = tmp_path / "family=landing" / "scope_key=2025030457" / "status=200" / "fetched_at_utc=2026-05-12T12%3A00%3A00Z"
    folder.mkdir(parents=True)
    (folder / "body.json").write_text('{\n "id": 2025030457\n}')
    row = read_landed(spark, str(tmp_path), "landing", fmt="text").first()
    assert (row.scope_key, row.status, row.family) == ("2025030457", 200, "landing")
    assert row.response_json == '{\n "id": 2025030457\n}' and row.fetched_at_utc == datetime(2026, 5, 12, 12)
    assert read_landed(spark, str(tmp_path), "boxscore", fmt="text").count() == 0
