import re

import duckdb
import pytest

import __spark_entry__ as driver
from checks.compare import TABLES, compare
from moraine.plans.contracts import CONTRACTS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


OWN = {**driver.QUERIES, **driver.MODEL_QUERIES}


@pytest.mark.parametrize("name", list(OWN))
def test_query_matches_its_oracle(spark, con, name):
    good, note, _ = compare(spark, con, name, driver.queries()[name], driver.oracle_sql()[name], SF)
    assert good, note


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_an_oracle_over_given_tables():
    sql = driver.oracle_sql()
    assert set(OWN) <= set(sql) <= set(driver.queries())
    for text in sql.values():
        assert any(re.search(rf"\b{t}\b", text) for t in TABLES)


def test_staged_bodies_are_compared(spark):
    for name, column in (("stg_boxscore", "player_by_game_stats_json"), ("stg_play_by_play", "plays_json")):
        assert column in driver.queries()[name](spark, SF).columns
        assert column in driver.oracle_sql()[name]


def test_every_declared_test_is_run(spark):
    rows = driver.queries()["silver_table_tests"](spark, SF).collect()
    assert {r.model for r in rows} == set(CONTRACTS)
    assert len({(r.model, r.column, r.test) for r in rows}) == len(rows) == 167
