"""Season, date and team-code rules as column expressions and small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Season window (first and last month-day) and its stand-in date.
SEASON_FIRST = (9, 1)
SEASON_LAST = (6, 30)
SEASON_SENTINEL = (10, 1)

# Time zone whose calendar day a game belongs to.
GAME_DAY_ZONE = "America/Toronto"

# Team code, first season's start year, first start year after the
# last season (None while active). Right for seasons from 2015-16 on; teams that
# played before then start at 0.
TEAM_INTERVALS: list[tuple[str, int, int | None]] = [
    ("ANA", 0, None), ("ARI", 0, 2024), ("BOS", 0, None), ("BUF", 0, None), ("CAR", 0, None),
    ("CBJ", 0, None), ("CGY", 0, None), ("CHI", 0, None), ("COL", 0, None), ("DAL", 0, None),
    ("DET", 0, None), ("EDM", 0, None), ("FLA", 0, None), ("LAK", 0, None), ("MIN", 0, None),
    ("MTL", 0, None), ("NJD", 0, None), ("NSH", 0, None), ("NYI", 0, None), ("NYR", 0, None),
    ("OTT", 0, None), ("PHI", 0, None), ("PIT", 0, None), ("SEA", 2021, None), ("SJS", 0, None),
    ("STL", 0, None), ("TBL", 0, None), ("TOR", 0, None), ("UTA", 2024, None), ("VAN", 0, None),
    ("VGK", 2017, None), ("WPG", 0, None), ("WSH", 0, None),
]


def normalize_season(season: Column) -> Column:
    """``YYYYYYYY`` from an integer, ``YYYYYYYY`` or ``YYYY-YY``; NULL if invalid.

    Both forms must name consecutive years, so ``1999-00`` is valid and
    ``2024-26`` is not. Integers are not trimmed or dashed, they simply print.
    """
    text = F.trim(season.cast("string"))
    start = F.substring(text, 1, 4).try_cast("int")
    full = F.concat(F.lpad(start.cast("string"), 4, "0"), (start + 1).cast("string"))
    dashed = text.rlike(r"^[0-9]{4}-[0-9]{2}$") & (
        F.substring(text, 6, 2).try_cast("int") == (start + 1) % 100
    )
    solid = text.rlike(r"^[0-9]{8}$") & (F.substring(text, 5, 4).try_cast("int") == start + 1)
    return F.when(dashed, full).when(solid, text)


def season_reject_reason(season: Column) -> Column:
    """Why ``normalize_season`` gives NULL; NULL for a valid season."""
    text = F.trim(season.cast("string"))
    shaped = text.rlike(r"^[0-9]{4}-[0-9]{2}$") | text.rlike(r"^[0-9]{8}$")
    return F.when(normalize_season(season).isNotNull(), F.lit(None).cast("string")).otherwise(
        F.when(shaped, F.lit("non_consecutive_years")).otherwise(F.lit("malformed_season"))
    )


def season_id(start_year: Column) -> Column:
    """``YYYYYYYY`` for a start year."""
    return F.concat(start_year.cast("string"), (start_year + 1).cast("string"))


def season_start_year(season: Column) -> Column:
    return F.substring(season, 1, 4).cast("int")


def season_start(season: Column) -> Column:
    """Stand-in event date of season-scoped rows."""
    month, day = SEASON_SENTINEL
    return F.make_date(season_start_year(season), F.lit(month), F.lit(day))


def checked_season(season: int | str) -> str:
    """Driver-side form of ``normalize_season`` for a job argument; raises if invalid."""
    text = str(season).strip()
    head, tail = text[:4], text[5:] if text[4:5] == "-" else text[4:]
    shaped = text.isascii() and head.isdigit() and tail.isdigit()
    if not shaped or (len(head), len(tail), "-" in text) not in ((4, 2, True), (4, 4, False)):
        raise ValueError(f"season must look like 20242025 or 2024-25, got {season!r}")
    following = int(head) + 1
    if int(tail) != (following % 100 if len(tail) == 2 else following):
        raise ValueError(f"season {season!r} does not span consecutive years")
    return f"{head}{following}"


def season_range(spark: SparkSession, first: int | str, last: int | str) -> DataFrame:
    """One row per season from ``first`` to ``last`` inclusive, ascending."""
    start, end = int(checked_season(first)[:4]), int(checked_season(last)[:4])
    if end < start:
        raise ValueError(f"season range is reversed: {first!r} to {last!r}")
    years = spark.range(start, end + 1).select(F.col("id").cast("int").alias("start_year"))
    return years.select(season_id(F.col("start_year")).alias("season"), "start_year")


def season_dates(df: DataFrame, season_col: str = "season", out: str = "game_date") -> DataFrame:
    """One row per calendar day of each season's window."""
    year = season_start_year(F.col(season_col))
    first = F.make_date(year, F.lit(SEASON_FIRST[0]), F.lit(SEASON_FIRST[1]))
    last = F.make_date(year + 1, F.lit(SEASON_LAST[0]), F.lit(SEASON_LAST[1]))
    return df.select("*", F.explode(F.sequence(first, last)).alias(out))


def normalize_team(team: Column) -> Column:
    """Upper-case three-letter code; NULL if it is not one."""
    code = F.upper(F.trim(team))
    return F.when(code.rlike(r"^\p{L}{3}$"), code)


def previous_local_day(ts: Column, zone: str = GAME_DAY_ZONE) -> Column:
    """The calendar day before ``ts`` (an instant, session zone UTC) in ``zone``."""
    return F.date_sub(F.to_date(F.from_utc_timestamp(ts, zone)), 1)


def game_id_matches_season(game_id: Column, season: Column) -> Column:
    """Does the id's leading part equal the season's start year?"""
    encoded = F.call_function("div", game_id, F.lit(1_000_000))
    return encoded == season_start_year(season.cast("string"))


def active_members(
    df: DataFrame,
    year: Column,
    intervals: Sequence[tuple[str, int, int | None]] = tuple(TEAM_INTERVALS),
    out: str = "team",
) -> DataFrame:
    """Range join of ``df`` with validity intervals, ``from <= year < to``.

    ``intervals`` is a literal list held by the caller (tens of rows), so the
    match is a filter over an array literal: no join, no shuffle and no
    nested loop over two tables.
    """
    members = F.array(
        *[
            F.struct(
                F.lit(name).alias("member"),
                F.lit(start).alias("from_year"),
                F.lit(end).cast("int").alias("to_year"),
            )
            for name, start, end in intervals
        ]
    )
    active = F.filter(
        members,
        lambda m: (year >= m["from_year"]) & (m["to_year"].isNull() | (year < m["to_year"])),
    )
    return df.select("*", F.explode(F.transform(active, lambda m: m["member"])).alias(out))
