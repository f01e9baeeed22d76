"""Small CSV inputs and the seed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DIM_SPORT = "sport_id int, sport_name string, sport_slug string"
DIM_LEAGUE = (
    "league_id int, sport_id int, league_name string, league_abbreviation string, country_code string"
)
EXPENSES = (
    "date date, vendor string, category string, amount_usd decimal(12,2), "
    "billing_period string, invoice_ref string, notes string"
)

# The seed rows.
DIM_SPORT_ROWS = [(1, "Ice Hockey", "ice_hockey")]
DIM_LEAGUE_ROWS = [(1, 1, "National Hockey League", "NHL", "US")]


def read_seed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A headed CSV file with a declared schema; malformed rows raise."""
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path, header=True)


def dim_sport(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIM_SPORT_ROWS, DIM_SPORT)


def dim_league(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIM_LEAGUE_ROWS, DIM_LEAGUE)


def read_expenses(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, EXPENSES)
