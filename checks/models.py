"""The models, run over bronze packed from whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.functions.json import json_len
from moraine.plans.contracts import CONTRACTS, check_tables
from moraine.plans.incremental import kept_models, merge_latest, part_of, update_silver
from moraine.plans.silver import CORE, INTERMEDIATE, STAGING, Models, store_models
from moraine.plans.staging import STAGES
from moraine.sources import endpoints as E
from moraine.sources.shared import shared_folder
from moraine.sources.versioned import read_parts

from . import packed

# Staging models that hand JSON text on.
WHOLE = ["stg_boxscore", "stg_play_by_play"]


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps, the type the oracle returns."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


def tables(spark: SparkSession, sf_dir: str) -> Models:
    return Models(spark, lambda family: packed.bronze(spark, sf_dir, family))


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = tables(spark, sf_dir)[name]
        if name == "stg_boxscore":
            df = df.withColumn("away_forwards", json_len("player_by_game_stats_json", "awayTeam.forwards"))
        return plain_times(df)

    return run


def _whole(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(tables(spark, sf_dir)[name])

    return run


def silver_table_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared tests of every contract, over models stored once.

    Each family's bronze is read once, by its staging model, so it is not stored.
    """
    out = f"{shared_folder(spark)}/moraine/{uuid.uuid4().hex}"
    read_once = Models(spark, lambda family: packed.unstored_bronze(spark, sf_dir, family))
    kept = store_models(read_once, [*CONTRACTS, "int_game_players"], lambda name: f"{out}/{name}")
    return check_tables(kept)


# Games in one part of a kept table: the numbers packed from the given tables hold no year.
PART_GAMES = 20_000


def _batch(bronze: DataFrame, batch: int, of: int) -> DataFrame:
    """A part of the fetches, dealt by digest: fetches of one game come in any order."""
    return bronze.where(F.pmod(F.xxhash64("response_sha256"), F.lit(of)) == batch)


def kept_latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest fetch of each game, merged batch by batch into a kept table."""
    path = f"{shared_folder(spark)}/moraine/{uuid.uuid4().hex}/stg_landing"
    stage, bronze = STAGES["stg_landing"], packed.bronze(spark, sf_dir, E.LANDING)
    for batch in range(3):
        merge_latest(spark, path, stage, _batch(bronze, batch, 3), part_of(stage, PART_GAMES))
    return plain_times(stage.finish(read_parts(spark, path)))


def facts_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes from a table of which two builds have each rewritten the parts they touched."""
    out = f"{shared_folder(spark)}/moraine/{uuid.uuid4().hex}"
    for batch in range(2):
        fetches = lambda family, _, batch=batch: _batch(packed.bronze(spark, sf_dir, family), batch, 2)
        update_silver(spark, "", out, games=PART_GAMES, bronze=fetches, tables=["fct_game_outcome"])
    return kept_models(spark, out)["fct_game_outcome"]


MODEL_QUERIES = {
    **{name: _model(name) for name in [*STAGING, *INTERMEDIATE, *CORE]},
    **{f"{name}_whole": _whole(name) for name in WHOLE},
    "kept_latest_rows": kept_latest_rows,
    "facts_by_season": facts_by_season,
    "silver_table_tests": silver_table_tests,
    # The same query under its earlier name.
    "silver_all_table_tests": silver_table_tests,
}
