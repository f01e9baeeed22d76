"""Silver tables whose cost follows what is new.

The latest fetch of every key is kept as a table in parts, so a build reads the
bronze of the last days, merges it into the parts it touches and ranks nothing
else again. Facts come in the same parts, by season, and each part remembers
the state it was built from: only parts whose state has changed are rewritten.
A build that ends half way is taken up by the next one, since what is out of
date is read from the tables and not from the run.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_by
from ..sources.bronze import read_bronze
from ..sources.shared import stored
from ..sources.versioned import NO_PART, Snapshot, current, read_parts, replace_parts
from . import core, intermediate
from .silver import CORE, INTERMEDIATE, STAGING, Models
from .staging import STAGES, Stage

GAMES_PER_SEASON = 1_000_000  # fixed: a game's number starts with the year its season begins in

# Fact, the staging model it is read from, how. Each row depends on one game only.
FACTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "fct_game": ("stg_landing", core.fct_game),
    "fct_game_outcome": ("stg_landing", core.fct_game_outcome),
    "fct_game_event": ("stg_play_by_play", lambda plays: core.fct_game_event(intermediate.int_game_events(plays))),
    "fct_game_lineup": ("stg_boxscore", lambda boxes: core.fct_game_lineup(intermediate.game_players(boxes))),
}
DIMENSIONS = [name for name in CORE if name not in FACTS]


@dataclass(frozen=True)
class Update:
    """The parts that one build rewrote, by table, and the dimensions it wrote anew."""

    merged: dict[str, list[str]]
    facts: dict[str, list[str]]
    dimensions: list[str]


def part_of(stage: Stage, games: int = GAMES_PER_SEASON) -> Column:
    """The part of a kept row: its season, taken from the key alone, as a later fetch must meet it again."""
    if stage.keys == ["game_id"]:
        return F.call_function("div", F.col("game_id"), F.lit(games)).cast("string")
    return F.col("season").cast("string")


def _named(part: Column) -> Column:
    return F.coalesce(part, F.lit(NO_PART))


def latest_rows(df: DataFrame, stage: Stage) -> DataFrame:
    return latest_by(df, stage.keys, "fetched_at_utc", ["response_sha256"])


def merge_latest(
    spark: SparkSession, path: str, stage: Stage, new: DataFrame, part: Column | None = None, note: str | None = None
) -> list[str]:
    """Merge the new bronze rows of a family into its kept latest rows; returns the parts rewritten.

    The latest of two latest rows is the latest of all, whatever the order in
    which fetches come and however often one comes, so the table equals a
    ranking of every fetch ever stored. Of the table, only parts with new
    fetches are opened, and only those with a change are written.
    """
    part = part_of(stage) if part is None else part
    at = current(spark, path)
    fresh = stored(latest_rows(stage.extract(new), stage), "fresh")
    kept = read_parts(spark, path, _parts(fresh, part), at, fresh.schema)
    # Only a fetch that comes after the kept one changes anything.
    known = kept.select(*[F.col(c).alias(f"__{c}") for c in [*stage.keys, "fetched_at_utc", "response_sha256"]])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in stage.keys]
    later = (F.col("fetched_at_utc") > F.col("__fetched_at_utc")) | (
        (F.col("fetched_at_utc") == F.col("__fetched_at_utc")) & (F.col("response_sha256") < F.col("__response_sha256"))
    )
    changed = _parts(fresh.join(known, same, "left").where(F.col("__fetched_at_utc").isNull() | later), part)
    if not changed and at.schema is not None:
        return []
    before = read_parts(spark, path, changed, at, fresh.schema)
    merged = latest_rows(before.unionByName(fresh.where(_named(part).isin(*changed))), stage) if changed else before
    replace_parts(merged, path, part, changed, at, note=note)
    return changed


def _parts(df: DataFrame, part: Column) -> list[str]:
    """The parts that rows fall into: seasons, so a short list."""
    return sorted(r[0] for r in df.select(_named(part).alias("p")).distinct().collect())


def _layer(out: str, layer: str, name: str) -> str:
    return f"{out.rstrip('/')}/{layer}/{name}"


def _last_date(note: str | None) -> str | None:
    return json.loads(note)["until"] if note else None


def update_silver(
    spark: SparkSession,
    base: str,
    out: str,
    since: date | str | None = None,
    games: int = GAMES_PER_SEASON,
    bronze: Callable[[str, str | None], DataFrame] | None = None,
    tables: Sequence[str] = (*FACTS, *DIMENSIONS, *STAGING),
) -> Update:
    """Bring ``out/kept/*`` and ``out/core/*`` up to date with the bronze of a lake.

    ``tables`` names facts, dimensions and staging models; what they are built
    from is kept as well.

    A family is read from its last merged ingest date on, that day included,
    or from ``since``, which must be given where older dates were written to.
    Facts are rewritten by season, dimensions whole, and only if a table they
    read has changed. ``bronze`` may stand in for the lake's own layer.
    """
    read = bronze or (lambda family, first: read_bronze(spark, base, family, first))
    merged: dict[str, list[str]] = {}
    needed = {s for name in tables for s in _sources_of(name)}
    for name, (_, family) in STAGING.items():
        if name not in needed:
            continue
        path = _layer(out, "kept", name)
        last = _last_date(current(spark, path).note)
        first = str(since) if since is not None else last
        try:
            new = read(family, first)
        except AnalysisException as error:  # nothing of this family is stored yet
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            new = None
        if new is None:
            merged[name] = []
            continue
        until = new.agg(F.max("ingest_date")).first()[0]
        until = max(filter(None, (str(until) if until else None, last)), default=None)
        stage = STAGES[name]
        merged[name] = merge_latest(spark, path, stage, new, part_of(stage, games), json.dumps({"until": until}))
    facts = {name: _update_fact(spark, out, name, games) for name in FACTS if name in tables}
    return Update(merged, facts, [name for name in DIMENSIONS if name in tables and _update_dimension(spark, out, name)])


def _update_fact(spark: SparkSession, out: str, name: str, games: int) -> list[str]:
    """Rewrite the parts of a fact whose kept rows have changed since it was built."""
    source, build = FACTS[name]
    kept_path, path = _layer(out, "kept", source), _layer(out, "core", name)
    kept, at = current(spark, kept_path), current(spark, path)
    if kept.schema is None:
        return []
    stale = sorted(p for p in {*kept.parts, *at.sources} if kept.parts.get(p) != at.sources.get(p))
    if not stale and at.schema is not None:
        return []
    rows = build(STAGES[source].finish(read_parts(spark, kept_path, stale, kept)))
    part = F.call_function("div", F.col("game_id"), F.lit(games))
    replace_parts(rows, path, part, stale, at, {p: kept.parts[p] for p in stale if p in kept.parts})
    return stale


def _sources_of(name: str) -> list[str]:
    """The staging models that a model is built from."""
    if name in STAGING:
        return [name]
    if name in FACTS:
        return [FACTS[name][0]]
    return [s for i in (INTERMEDIATE | CORE)[name][1] for s in _sources_of(i)]


def _update_dimension(spark: SparkSession, out: str, name: str) -> bool:
    """Write a dimension anew if one of its kept tables has changed; it is one part."""
    path, at = _layer(out, "core", name), current(spark, _layer(out, "core", name))
    kept = {s: current(spark, _layer(out, "kept", s)) for s in _sources_of(name)}
    if any(k.schema is None for k in kept.values()):
        return False
    built_from = json.dumps({s: k.number for s, k in kept.items()}, sort_keys=True)
    if at.sources.get(NO_PART) == built_from:
        return False
    staged = {s: _staged(spark, out, s, k) for s, k in kept.items()}
    replace_parts(Models(spark, None, staged)[name], path, F.lit(None).cast("string"), [NO_PART], at, {NO_PART: built_from})
    return True


def _staged(spark: SparkSession, out: str, name: str, at: Snapshot | None = None) -> DataFrame:
    return STAGES[name].finish(read_parts(spark, _layer(out, "kept", name), at=at))


def kept_models(spark: SparkSession, out: str) -> Models:
    """All models over the tables that ``update_silver`` keeps, as lazy frames."""
    known = {name: _staged(spark, out, name) for name in STAGING if current(spark, _layer(out, "kept", name)).schema}
    known |= {name: read_parts(spark, _layer(out, "core", name)) for name in CORE if current(spark, _layer(out, "core", name)).schema}
    return Models(spark, None, known)
