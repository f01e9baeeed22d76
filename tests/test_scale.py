"""Work and bytes that must not grow with how often a step reads its input."""

import json
from datetime import date

from pyspark.sql import functions as F

from checks import models, packed
from moraine.functions.text import digest_bytes
from moraine.operators.bodies import with_reason
from moraine.operators.dedup import latest_by
from moraine.plans import backfill as bf
from moraine.plans.staging import stg_landing
from moraine.sources import endpoints as E

from . import bodies as b

GAME = 2025020001


def small_tables(spark, path):
    k = F.col("id")
    day = F.timestamp_seconds(F.lit(800_000_000) + k * 86_400)
    tables = {
        "orders": [k.alias("o_orderkey"), (k % 7).alias("o_custkey"), F.when(k % 3 == 0, "F").otherwise("O").alias("o_orderstatus"),
                   (k * 1.5).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("3-MEDIUM").alias("o_orderpriority")],
        "customer": [k.alias("c_custkey"), (k * 2.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")],
        "supplier": [k.alias("s_suppkey"), (k * 3.5).alias("s_acctbal")],
        "documents": [k.alias("doc_id"), F.concat(F.lit("one\ntwo "), k).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), (k % 50).alias("n_chars")],
    }
    for name, columns in tables.items():
        spark.range(40).select(*columns).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_tests_of_all_tables_store_no_bronze(spark, tmp_path, monkeypatch):
    def refused(df, name="table"):
        raise AssertionError(f"{name} is read once and need not be stored")

    monkeypatch.setattr(packed, "stored", refused)
    rows = models.silver_table_tests(spark, small_tables(spark, tmp_path)).collect()
    assert len(rows) == 167
    found = {(r.model, r.column, r.test): r.failures for r in rows}
    assert found["stg_landing", "game_id", "unique"] == 0 and found["fct_game", "league_id", "relationships"] == 0


def test_a_larger_table_is_dealt_into_more_tasks(spark, tmp_path, monkeypatch):
    sf = small_tables(spark, tmp_path)
    few = packed.spread(packed.table(spark, sf, "orders")).rdd.getNumPartitions()
    monkeypatch.setattr(packed, "PACK_BYTES", 100)
    many = packed.spread(packed.table(spark, sf, "orders")).rdd.getNumPartitions()
    assert few == spark.sparkContext.defaultParallelism < many


def test_digests_travel_as_bytes_and_break_ties_as_their_text_does(spark):
    texts = spark.range(200).select(F.sha2(F.col("id").cast("string"), 256).alias("d"))
    ordered = [r.d for r in texts.orderBy(digest_bytes("d")).collect()]
    assert ordered == sorted(ordered)
    odd = spark.createDataFrame([("b",), ("a",), (None,), ("A" * 64,)], "d string")
    assert [r.d for r in odd.orderBy(digest_bytes("d")).collect()] == [None, "A" * 64, "a", "b"]
    fetch = spark.createDataFrame([(1, "b" * 64), (1, "a" * 64)], "k int, d string").withColumn("t", F.lit(0))
    assert latest_by(fetch, ["k"], "t", [digest_bytes("d")]).first().d == "a" * 64
    bronze = b.landed(spark, [(GAME, b.landing(GAME))]).select(
        F.lit(date(2025, 1, 1)).alias("ingest_date"), F.current_timestamp().alias("fetched_at_utc"), F.sha2("response_json", 256).alias("response_sha256"), "response_json"
    )
    plan = stg_landing(bronze)._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan and stg_landing(bronze).count() == 1


def test_a_filter_on_the_reason_copies_no_checks(spark):
    rows = b.landed(spark, [(GAME, b.landing(GAME))])
    valid = with_reason(rows, E.LANDING).where(F.col("reason").isNull())
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("missing:gameState") == 1
    assert valid.count() == 1


def load_of(spark, path, run):
    return bf.Load(spark, str(path / "landing"), str(path / "lake"), run, date(2026, 5, 12))


def test_responses_are_judged_once_though_some_are_rejected(spark, tmp_path, monkeypatch):
    judged = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        judged.add(1)
        return True

    monkeypatch.setattr(bf, "with_reason", lambda df, family: with_reason(df.where(seen("scope_key")), family))
    good, bad = (GAME, b.landing(GAME)), (GAME + 1, json.dumps(b.landing(GAME + 1))[:-5])
    load = load_of(spark, tmp_path, "run")
    log, rejected = bf.write_family(load, b.landed(spark, [good, bad]), E.LANDING, "batch")
    assert rejected == 1 and [r.scope_key for r in log.collect()] == [str(GAME)]
    saved = spark.read.parquet(f"{load.paths.rejects(E.LANDING)}/batch.parquet").collect()
    assert [(r.scope_key, r.reason) for r in saved] == [(str(GAME + 1), "malformed_json")]
    assert judged.value == 2
    assert not list((tmp_path / "lake" / "_judged").rglob("*.parquet"))


def test_a_first_load_looks_up_no_earlier_fetches(spark, tmp_path):
    bodies = b.landed(spark, [(GAME, b.landing(GAME))])
    load = load_of(spark, tmp_path, "run")
    assert bf.not_loaded(load, bodies, E.LANDING, "batch") is bodies
