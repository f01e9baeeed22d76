"""Loads: work out the pending units, load what has arrived, log it, check cost.

A phase is three steps over written tables, so that it can be rerun at any
point:

1. the plan (one row per unit with its state) is written under the run's id;
2. each family's pending responses are judged and written to one bronze
   dataset named after the run;
3. the manifest rows are counted from the bronze just written and appended.

A crash before step 3 leaves units pending; the next run loads them again and
the staging dedup keeps the latest fetch. A body that is stored and logged is
not appended again, however often its unit is tried.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import checked_season, season_id
from ..operators.bodies import envelopes, found, scope_of, with_reason
from ..operators.dedup import latest_by
from ..operators.unnest import union_facts
from ..sources import endpoints as E
from ..sources.bronze import ENVELOPE, bronze_digests, write_bronze
from ..sources.fetches import index_fetches, known_fetches
from ..sources.landed import read_landed
from ..sources.manifest import append_manifest, manifest_rows, new_run_id, read_manifest
from ..sources.shared import remove_table, stored
from .costs import THRESHOLD_USD, CostCheckTripped, check_cost, project_cost
from .schedule import require_days, schedule_games
from .worklists import (
    LOADED,
    game_day_units,
    phase_counts,
    plan_units,
    summary_units,
    team_season_units,
)


class RejectedBodies(ValueError):
    """A strict load met responses that fail their checks."""


@dataclass(frozen=True)
class PhaseResult:
    phase: str
    attempted: int
    skipped: int
    loaded: int
    waiting: int
    rejected: int
    appended: int
    refused: int = 0


@dataclass
class BackfillResult:
    run_id: str
    seasons: list[str]
    phases: list[PhaseResult] = field(default_factory=list)
    projections: list[dict] = field(default_factory=list)
    aborted: bool = False
    aborted_reason: str | None = None


@dataclass(frozen=True)
class DayResult:
    run_id: str
    in_schedule: int
    eligible: int
    skipped: int
    loaded: int


@dataclass(frozen=True)
class Load:
    """What one run works with."""

    spark: SparkSession
    landing: str
    base: str
    run_id: str
    ingest_date: date
    landing_format: str = "json"
    manifest_format: str = "json"
    strict: bool = False
    since: date | None = None  # days of arrival that the load looks at
    until: date | None = None

    @property
    def paths(self) -> E.LakePaths:
        return E.LakePaths(self.base)

    def manifest(self) -> DataFrame:
        return read_manifest(self.spark, self.paths.manifest, self.manifest_format)

    def landed(self, family: str) -> DataFrame:
        return read_landed(self.spark, self.landing, family, self.landing_format, self.since, self.until)


def write_family(load: Load, bodies: DataFrame, family: str, batch: str) -> tuple[DataFrame, int]:
    """Judge responses, write the valid ones; returns (manifest rows, rejects).

    Rejects never reach bronze. Responses are judged once: they are written
    with their reasons, from which bronze and the rejects are taken.
    """
    seen = Observation()
    counted = with_reason(found(bodies), family).observe(seen, F.count("reason").alias("rejected"))
    judged_path = f"{load.base.rstrip('/')}/_judged/{batch}/{family}"
    counted.write.mode("overwrite").option("compression", "zstd").parquet(judged_path)
    judged = load.spark.read.schema(counted.schema).parquet(judged_path)
    valid = judged.where(F.col("reason").isNull())
    written = write_bronze(
        envelopes(valid, family), load.base, family, load.ingest_date, batch, allow_empty=True
    )
    rejected = int(seen.get["rejected"] or 0)
    if rejected:
        rejects = judged.where(F.col("reason").isNotNull())
        rejects.write.mode("overwrite").parquet(f"{load.paths.rejects(family)}/{batch}.parquet")
    remove_table(load.spark, judged_path)
    kept = load.spark.read.schema(ENVELOPE).parquet(written.key)
    # Before the log: a fetch counts as known only once its unit is logged.
    fetches = kept.select(scope_of(family).alias("scope_key"), "fetched_at_utc", F.col("response_sha256").alias("digest"))
    index_fetches(load.spark, load.base, family, fetches, batch, _stored_fetches(load, family, batch))
    return manifest_rows(kept, load.run_id, scope_of(family), written.compression), rejected


def not_loaded(load: Load, bodies: DataFrame, family: str, batch: str, units: DataFrame | None = None) -> DataFrame:
    """Bodies without the very fetches that an earlier load has stored and logged.

    Stored fetches are looked up in the family's index, of which only the years
    of these bodies' units are opened; ``units`` are those of the bodies, if
    they are known. A lake without one is read once in full.
    A body that comes back in a later fetch is new: it is the latest again.
    What this very batch wrote before a crash does not count: it is replaced.
    """
    logged = load.manifest().where((F.col("endpoint") == E.TEMPLATES[family]) & (F.col("status") == "ok"))
    if logged.isEmpty():
        return bodies
    fetches = known_fetches(load.spark, load.base, family, bodies if units is None else units, batch)
    if fetches is None:
        fetches = _stored_fetches(load, family, batch).drop("batch")
    fetches = fetches.withColumnRenamed("digest", "__digest")
    known = fetches.join(logged.select("scope_key").distinct(), "scope_key", "left_semi")
    digested = bodies.withColumn("__digest", F.sha2("response_json", 256))
    return digested.join(known, ["scope_key", "fetched_at_utc", "__digest"], "left_anti").select(*bodies.columns)


def _stored_fetches(load: Load, family: str, batch: str) -> DataFrame:
    """(scope_key, fetched_at_utc, digest, batch) of all bronze of a family but this batch's."""
    rows = bronze_digests(load.spark, load.base, family, f"/{batch}.parquet/")
    return rows.select(
        scope_of(family).alias("scope_key"), "fetched_at_utc", F.col("response_sha256").alias("digest"), F.lit("").alias("batch")
    )


def run_phase(load: Load, phase: str, units: DataFrame) -> PhaseResult:
    """Load one phase's pending units of whatever families have arrived.

    ``loaded`` counts units of which something was logged, ``refused`` units of
    which everything new was rejected, ``waiting`` the other pending ones.
    """
    families = E.PHASE_FAMILIES[phase]
    batch = f"{load.run_id}-{phase}"
    arrived = union_facts(*[load.landed(f).select("scope_key") for f in families])
    plan = plan_units(
        units.select("scope_key").distinct(), load.manifest(), E.templates_of(families), arrived
    )
    # Written, not cached: every step below sees the same plan, also after a
    # lost executor, and its true size decides how it is joined.
    plan_path = f"{load.base.rstrip('/')}/_plans/{batch}.parquet"
    plan.write.mode("overwrite").parquet(plan_path)
    plan = load.spark.read.schema("scope_key string, state string").parquet(plan_path)
    pending = plan.where(F.col("state") == LOADED).select("scope_key")

    logs, rejects, rejected = [], [], 0
    for family in families:
        arrived = load.landed(family).join(pending, "scope_key", "left_semi")
        log, bad = write_family(load, not_loaded(load, arrived, family, batch, pending), family, batch)
        logs.append(log)
        rejected += bad
        if bad:
            rejects.append(load.spark.read.parquet(f"{load.paths.rejects(family)}/{batch}.parquet").select("scope_key"))
    if rejected and load.strict:
        raise RejectedBodies(f"{rejected} responses rejected in phase {phase}, run {load.run_id}")
    logged = union_facts(*logs)
    appended = append_manifest(logged, load.paths.manifest, load.manifest_format, batch=batch)
    # What was just written, rather than bronze's bodies again.
    done = read_manifest(load.spark, f"{load.paths.manifest}/{batch}", load.manifest_format).select("scope_key").distinct()
    loaded = done.count()
    refused = 0
    if rejects:
        refused = union_facts(*rejects).distinct().join(done, "scope_key", "left_anti").count()
    counts = phase_counts(plan, keys=[]).first()
    waiting = counts.attempted - counts.skipped - loaded - refused
    return PhaseResult(phase, counts.attempted, counts.skipped, loaded, waiting, rejected, appended, refused)


def _scheduled(load: Load, days: DataFrame) -> DataFrame:
    """All games that the latest saved week of each day lists for that day.

    The weeks are judged once and stored, and so are the games, which a load
    counts and then filters.
    """
    weeks = load.landed(E.SCHEDULE).join(days.select("scope_key"), "scope_key", "left_semi")
    latest = latest_by(found(weeks), ["scope_key"], "fetched_at_utc", [F.sha2("response_json", 256)])
    day = F.to_date("scope_key")
    judged = stored(with_reason(latest, E.SCHEDULE), "weeks")
    bad = judged.where(F.col("reason").isNotNull()).select("scope_key", "reason").take(5)
    if bad:
        raise RejectedBodies(f"schedule rejected: {[(r.scope_key, r.reason) for r in bad]}")
    require_days(judged, day)
    return stored(schedule_games(judged, day, states=None, keep=["scope_key"]), "games")


def _eligible(games: DataFrame) -> DataFrame:
    finished = games.where(F.col("game_state").isin(*E.FINISHED_STATES))
    return finished.select(F.col("game_id").cast("string").alias("scope_key"))


def game_units(load: Load, days: DataFrame) -> DataFrame:
    """One unit per finished game that the saved schedules list on ``days``."""
    return _eligible(_scheduled(load, days))


def load_day(load: Load, day: date) -> DayResult:
    """Load the finished games of one schedule day."""
    days = load.spark.range(1).select(F.lit(day.isoformat()).alias("scope_key"))
    if load.landed(E.SCHEDULE).join(days, "scope_key", "left_semi").isEmpty():
        raise FileNotFoundError(f"no saved schedule for {day}")
    games = _scheduled(load, days)
    in_schedule = games.count()
    result = run_phase(load, "games", _eligible(games))
    return DayResult(load.run_id, in_schedule, result.attempted, result.skipped, result.loaded)


def units_of(load: Load, phase: str, seasons: DataFrame) -> DataFrame:
    if phase == "team-season":
        return team_season_units(seasons)
    if phase == "season-summaries":
        return summary_units(seasons)
    return game_units(load, game_day_units(seasons))


def run_backfill(
    spark: SparkSession,
    landing: str,
    base: str,
    seasons: list[int | str],
    loader: str = "all",
    cost_check: str = "fail",
    threshold: float = THRESHOLD_USD,
    ingest_date: date | None = None,
    run_id: str | None = None,
    **options,
) -> BackfillResult:
    """Run the phases in order over ``seasons`` and check cost after each.

    Cheap phases come first. A trip in ``fail`` mode ends the run before the
    next phase; running again continues where the manifest stands.
    """
    if loader != "all" and loader not in E.PHASE_FAMILIES:
        raise ValueError(f"unknown loader {loader!r}")
    wanted = [checked_season(s) for s in seasons]
    load = Load(
        spark,
        landing,
        base,
        run_id or new_run_id(),
        ingest_date or datetime.now(timezone.utc).date(),
        **options,
    )
    years = spark.createDataFrame([(int(s[:4]),) for s in wanted], "start_year int")
    season_rows = years.select(season_id(F.col("start_year")).alias("season"))
    result = BackfillResult(load.run_id, wanted)
    for phase in E.PHASE_FAMILIES if loader == "all" else [loader]:
        result.phases.append(run_phase(load, phase, units_of(load, phase, season_rows)))
        projection = project_cost(load.manifest(), threshold=threshold)
        try:
            result.projections.append(check_cost(projection, cost_check))
        except CostCheckTripped as trip:
            result.aborted, result.aborted_reason = True, str(trip)
            break
    return result
