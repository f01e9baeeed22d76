"""Layered sports lake on Spark: raw JSON responses in, star schema out."""

from .functions.calendar import (
    active_members,
    game_id_matches_season,
    normalize_season,
    normalize_team,
    previous_local_day,
    season_dates,
    season_range,
    season_reject_reason,
    season_start,
)
from .functions.json import (
    canonical_json,
    json_fields,
    json_len,
    json_object,
    json_text,
    json_texts,
    to_integer,
)
from .functions.text import (
    alias_or_replace,
    clock_to_seconds,
    first_non_null,
    joined_name,
    surrogate_key,
    winner,
)
from .operators.bodies import envelopes, validate_bodies, with_reason
from .operators.dedup import duplicate_keys, latest_by
from .operators.joins import (
    complete_units,
    enrich_left,
    key_spine,
    orphans,
    pending_units,
    spine_left_join,
)
from .operators.quality import Contract, assert_no_rows, run_tests, table_tests
from .operators.unnest import explode_groups, union_facts, unnest_json, unpivot
from .plans.backfill import Load, load_day, run_backfill
from .plans.contracts import check_table, check_tables
from .plans.costs import check_cost, project_cost
from .plans.incremental import kept_models, merge_latest, update_silver
from .plans.reports import period_totals, recurring, rolling_mean, total_like
from .plans.schedule import schedule_days, schedule_games
from .plans.silver import Models, build_silver, create_views, lake_models, store_models
from .plans.worklists import phase_counts, plan_units
from .session import local_session, prepare
from .sources.bronze import read_bronze, to_envelope, write_bronze
from .sources.landed import read_landed, stream_landed
from .sources.manifest import append_manifest, manifest_rows, new_run_id, read_manifest, snapshot_manifest
from .sources.shared import stored
from .sources.tables import dim_league, dim_sport, read_expenses, read_seed
from .sources.versioned import read_parts, remove_unused, replace_parts
from .streaming.ingest import ingest_batch, ingest_stream

__all__ = [name for name in dir() if not name.startswith("_")]
