"""Loads, streams and stored layouts from end to end, over landings written from whole tables.

Bodies are plain texts, so that the oracles can state their digests. What
arrives, is malformed or missing depends on the number of the game alone.
"""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.functions import calendar as cal
from moraine.operators.bodies import with_reason
from moraine.operators.quality import assert_no_rows
from moraine.operators.unnest import union_facts
from moraine.plans import reports
from moraine.plans.backfill import Load, run_backfill, run_phase
from moraine.plans.worklists import team_season_units
from moraine.sources import endpoints as E
from moraine.sources.bronze import read_bronze, write_bronze
from moraine.sources.manifest import read_manifest
from moraine.sources.shared import shared_folder, stored
from moraine.sources.tables import read_expenses, read_seed
from moraine.streaming.ingest import ingest_stream

from .operators import TEAMS_SQL, case
from .packed import spread, table

DAY = date(2024, 5, 12)
GAME = (
    '"id":<g>,"season":<s>,"gameType":2,"gameDate":"<day>","gameState":"OFF","startTimeUTC":"<day>T19:00:00Z",'
    '"awayTeam":{"id":1,"abbrev":"A"},"homeTeam":{"id":2,"abbrev":"B"}'
)


def filled(template: str, **values: Column) -> Column:
    """The template with each ``<name>`` replaced by a column."""
    parts = re.split(r"<(\w+)>", template)
    return F.concat(*[values[p].cast("string") if k % 2 else F.lit(p) for k, p in enumerate(parts)])


def filled_sql(template: str, **values: str) -> str:
    """The same as SQL."""
    parts = re.split(r"<(\w+)>", template)
    return " || ".join(f"CAST({values[p]} AS VARCHAR)" if k % 2 else f"'{p}'" for k, p in enumerate(parts) if p)


def folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/moraine/{uuid.uuid4().hex}"


# Games in two lots of arrivals

FAMILY_BODIES = {
    E.LANDING: "{" + GAME + "}",
    E.BOXSCORE: "{" + GAME + ',"playerByGameStats":{},"gameOutcome":{}}',
    E.PLAY_BY_PLAY: "{" + GAME + ',"plays":[],"rosterSpots":[]}',
}


def _games(spark: SparkSession, sf: str) -> DataFrame:
    """Stored, as every lot, family and list of units is made from them."""
    y = F.year("o_orderdate").cast("bigint")
    games = spread(table(spark, sf, "orders")).select((y * 1_000_000 + F.col("o_orderkey") % 1_000_000).alias("g"), y.alias("y")).distinct()
    day = F.make_date(F.col("y").cast("int"), (F.col("g") % 12 + 1).cast("int"), (F.col("g") % 28 + 1).cast("int"))
    return stored(games.select("g", cal.season_id(F.col("y")).alias("s"), day.alias("day")), "games")


def _arrivals(games: DataFrame, lot: int) -> DataFrame:
    """What arrives first and second. One game in 17 never does; one boxscore in 11 is cut short and
    comes again whole in the second lot; one play-by-play in 13 is reported missing."""
    g = F.col("g")
    mine = (g % 17 != 0) & ((g % 3 != 0) if lot == 1 else (g % 3 == 0))
    values = {c: F.col(c) for c in ("g", "s", "day")}
    parts = []
    for family, template in FAMILY_BODIES.items():
        whole = filled(template, **values)
        short = (g % 11 == 0) & F.lit(family == E.BOXSCORE)
        body = F.when(short, F.substring(whole, F.lit(1), F.length(whole) - 5)).otherwise(whole)
        status = F.when((g % 13 == 0) & F.lit(family == E.PLAY_BY_PLAY), 404).otherwise(200)
        rows = [(games.where(mine), body, F.lit(0))]
        if family == E.BOXSCORE and lot == 2:
            rows.append((games.where((g % 17 != 0) & (g % 11 == 0)), whole, F.lit(3_600_000_000)))
        for some, text, later in rows:
            fetched = F.timestamp_micros(F.lit(1_700_000_000_000_000) + g + later)
            parts.append(
                some.select(
                    g.cast("string").alias("scope_key"), status.cast("int").alias("status"), fetched.alias("fetched_at_utc"),
                    text.alias("response_json"), F.lit(family).alias("family"),
                )
            )
    return union_facts(*parts)


def land(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("family").parquet(path)


def _runs(spark: SparkSession, sf: str, runs: int = 2) -> tuple[str, list]:
    """Load the first lot, then both, and then again what is there."""
    base, landing = folder(spark), folder(spark)
    games = _games(spark, sf)
    units = games.select(F.col("g").cast("string").alias("scope_key"))
    results = []
    for run, name in enumerate(("one", "two", "three")[:runs]):
        if run < 2:
            land(_arrivals(games, run + 1), landing)
        load = Load(spark, landing, base, name, DAY, "parquet", "parquet")
        results.append((name, run_phase(load, "games", units)))
    return base, results


_GAMES = f"""WITH games AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) * 1000000 + o_orderkey % 1000000 AS g, CAST(year(o_orderdate) AS BIGINT) AS y FROM orders),
dated AS (SELECT g, CAST(y AS VARCHAR) || (y + 1) AS s, make_date(y, g % 12 + 1, g % 28 + 1) AS day FROM games),
stored AS (SELECT *, '{E.LANDING}' AS family, '{E.TEMPLATES[E.LANDING]}' AS endpoint, CASE WHEN g % 3 <> 0 THEN 'one' ELSE 'two' END AS run,
    {filled_sql(FAMILY_BODIES[E.LANDING], g="g", s="s", day="day")} AS body FROM dated WHERE g % 17 <> 0
  UNION ALL SELECT *, '{E.BOXSCORE}', '{E.TEMPLATES[E.BOXSCORE]}', CASE WHEN g % 3 <> 0 AND g % 11 <> 0 THEN 'one' ELSE 'two' END,
    {filled_sql(FAMILY_BODIES[E.BOXSCORE], g="g", s="s", day="day")} FROM dated WHERE g % 17 <> 0
  UNION ALL SELECT *, '{E.PLAY_BY_PLAY}', '{E.TEMPLATES[E.PLAY_BY_PLAY]}', CASE WHEN g % 3 <> 0 THEN 'one' ELSE 'two' END,
    {filled_sql(FAMILY_BODIES[E.PLAY_BY_PLAY], g="g", s="s", day="day")} FROM dated WHERE g % 17 <> 0 AND g % 13 <> 0)
"""


@case(_GAMES + f"""SELECT family, CAST(g AS VARCHAR) AS entity_id, s AS season, day AS event_date, endpoint, sha256(body) AS response_sha256,
  DATE '{DAY}' AS ingest_date FROM stored""")
def loaded_bronze(spark, sf):
    """Bronze after two loads: every body once, as it was fetched."""
    base, _ = _runs(spark, sf)
    columns = ("entity_id", "season", "event_date", "endpoint", "response_sha256", "ingest_date")
    return union_facts(*[read_bronze(spark, base, f, since=DAY).select(F.lit(f).alias("family"), *columns) for f in E.GAME_FAMILIES])


@case(_GAMES + "SELECT run AS run_id, endpoint, CAST(g AS VARCHAR) AS scope_key, CAST(1 AS BIGINT) AS \"rows\", 'ok' AS status FROM stored")
def loaded_manifest(spark, sf):
    """The log after two loads."""
    base, _ = _runs(spark, sf)
    log = read_manifest(spark, E.LakePaths(base).manifest, "parquet")
    return log.select("run_id", "endpoint", "scope_key", "rows", "status")


_COUNTED = """SELECT '{0}' AS run, count(*) AS attempted, count(*) FILTER (WHERE {1}) AS skipped, count(*) FILTER (WHERE {2}) AS loaded,
  count(*) FILTER (WHERE {3}) AS rejected, (SELECT count(*) FROM stored WHERE run = '{0}') AS appended, count(*) FILTER (WHERE {4}) AS refused FROM games"""


@case(_GAMES + "SELECT *, attempted - skipped - loaded - refused AS waiting FROM (" + " UNION ALL ".join([
    _COUNTED.format("one", "false", "g % 17 <> 0 AND g % 3 <> 0", "g % 17 <> 0 AND g % 3 <> 0 AND g % 11 = 0", "false"),
    _COUNTED.format("two", "g % 17 <> 0 AND g % 3 <> 0 AND g % 11 <> 0 AND g % 13 <> 0", "g % 17 <> 0 AND (g % 3 = 0 OR g % 11 = 0)", "g % 17 <> 0 AND g % 11 = 0", "false"),
    _COUNTED.format("three", "g % 17 <> 0 AND g % 13 <> 0", "false", "g % 17 <> 0 AND g % 13 = 0 AND g % 11 = 0", "g % 17 <> 0 AND g % 13 = 0 AND g % 11 = 0"),
]) + ")")
def load_counters(spark, sf):
    """What three loads report; the third finds nothing new."""
    _, results = _runs(spark, sf, 3)
    names = ("attempted", "skipped", "loaded", "rejected", "appended", "refused", "waiting")
    rows = [(run, *[getattr(r, n) for n in names]) for run, r in results]
    return spark.createDataFrame(rows, "run string, " + ", ".join(f"{n} bigint" for n in names))


@case(_GAMES + "SELECT CASE run WHEN 'one' THEN 0 ELSE 1 END AS batch, endpoint, CAST(g AS VARCHAR) AS scope_key, CAST(1 AS BIGINT) AS \"rows\" FROM stored")
def stream_manifest(spark, sf):
    """The log of a stream that is started after each lot of arrivals."""
    base, landing = folder(spark), folder(spark)
    games = _games(spark, sf)
    for lot in (1, 2):
        land(_arrivals(games, lot), landing)
        query = ingest_stream(spark, landing, base, f"{base}_checkpoint", "parquet", manifest_format="parquet", ingest_date=DAY)
        query.awaitTermination()
    log = read_manifest(spark, E.LakePaths(base).manifest, "parquet")
    batch = F.regexp_extract("run_id", "-([0-9]+)$", 1).cast("int")
    return log.select(batch.alias("batch"), "endpoint", "scope_key", "rows")


# The backfill over all phases

ROSTER_BODY = '{"forwards":[],"defensemen":[],"goalies":[]}'
CLUB_BODY = '{"previousSeason":1,"currentSeason":<s>,"nextSeason":2,"games":[]}'
SUMMARY_BODY = {
    E.SKATER_SUMMARY: '{"total":1,"data":[{"seasonId":<s>,"playerId":<n>,"gamesPlayed":1,"goals":1,"assists":1,"points":2}]}',
    E.GOALIE_SUMMARY: '{"total":1,"data":[{"seasonId":<s>,"playerId":<n>,"gamesPlayed":1}]}',
    E.TEAM_SUMMARY: '{"total":1,"data":[{"seasonId":<s>,"teamId":<n>,"gamesPlayed":1}]}',
}


def _saved(rows: DataFrame, family: str, scope: Column, body: Column) -> DataFrame:
    fetched = F.lit("2024-05-01 10:00:00").cast("timestamp")
    return rows.select(
        scope.cast("string").alias("scope_key"), F.lit(200).alias("status"), fetched.alias("fetched_at_utc"),
        body.alias("response_json"), F.lit(family).alias("family"),
    )


def _calendar_games(spark: SparkSession, sf: str) -> DataFrame:
    """At most eight games a day, numbered by season and day."""
    day = F.add_months(F.to_date("o_orderdate"), 22 * 12)
    rows = table(spark, sf, "orders").select(day.alias("day"), (F.col("o_custkey") % 8).alias("slot")).distinct()
    start = F.year("day") - F.when(F.month("day") >= 9, 0).otherwise(1)
    # The months up to August count on from December: Aug 31 and Sep 1 may be the same day of their years.
    number = F.dayofyear("day") + F.when(F.month("day") >= 9, 0).otherwise(400)
    g = start.cast("bigint") * 1_000_000 + number * 8 + F.col("slot")
    return rows.select("day", g.alias("g"), cal.season_id(start).alias("s"))


def _backfill_landing(spark: SparkSession, sf: str, landing: str, years: DataFrame) -> None:
    seasons = years.select(cal.season_id(F.col("y")).alias("season"), "y", "n")
    units = team_season_units(seasons.select("season")).withColumns({"s": F.col("season"), "two": F.ascii(F.substring("team", 2, 1)), "three": F.ascii(F.substring("team", 3, 1))})
    units = units.where("two % 4 <> 0")
    land(_saved(units, E.ROSTER, F.col("scope_key"), F.lit(ROSTER_BODY)), landing)
    land(_saved(units.where("three % 3 <> 0"), E.CLUB_SCHEDULE, F.col("scope_key"), filled(CLUB_BODY, s=F.col("s"))), landing)
    for family, template in SUMMARY_BODY.items():
        here = seasons.where("y % 2 = 0") if family == E.TEAM_SUMMARY else seasons
        land(_saved(here, family, F.col("season"), filled(template, s=F.col("season"), n=F.col("n"))), landing)
    games = _calendar_games(spark, sf)
    values = {c: F.col(c) for c in ("g", "s", "day")}
    state = F.when(F.col("g") % 5 == 0, "LIVE").otherwise("OFF")
    listed = F.concat(F.lit("{"), F.replace(filled(GAME, **values), F.lit("OFF"), state), F.lit("}"))
    days = games.withColumn("game", listed).groupBy("day").agg(F.array_join(F.sort_array(F.collect_list("game")), ",").alias("games"))
    land(_saved(days, E.SCHEDULE, F.col("day"), filled('{"gameWeek":[{"date":"<day>","games":[<games>]}]}', day=F.col("day"), games=F.col("games"))), landing)
    arrived = games.where("g % 7 <> 0")
    for family, template in FAMILY_BODIES.items():
        whole = filled(template, **values)
        cut = (F.col("g") % 11 == 0) & F.lit(family == E.BOXSCORE)
        land(_saved(arrived, family, F.col("g"), F.when(cut, F.substring(whole, F.lit(1), F.length(whole) - 5)).otherwise(whole)), landing)


_BACKFILL = f"""WITH years AS (SELECT DISTINCT CAST(year(o_orderdate) + 22 AS BIGINT) AS y FROM orders), seasons AS (SELECT y, CAST(y AS VARCHAR) || (y + 1) AS s FROM years),
{TEAMS_SQL},
units AS (SELECT s || '|' || team AS scope_key, ascii(substr(team, 2, 1)) % 4 <> 0 AS roster, ascii(substr(team, 2, 1)) % 4 <> 0 AND ascii(substr(team, 3, 1)) % 3 <> 0 AS club
  FROM seasons JOIN teams ON y >= from_year AND (to_year IS NULL OR y < to_year)),
days AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) + INTERVAL 22 YEAR AS DATE) AS day, o_custkey % 8 AS slot FROM orders),
placed AS (SELECT *, year(day) - CASE WHEN month(day) >= 9 THEN 0 ELSE 1 END AS start FROM days),
games AS (SELECT CAST(start AS BIGINT) * 1000000 + (dayofyear(day) + CASE WHEN month(day) >= 9 THEN 0 ELSE 400 END) * 8 + slot AS g FROM placed JOIN years ON start = y
  WHERE month(day) NOT IN (7, 8)),
finished AS (SELECT g FROM games WHERE g % 5 <> 0),
counted AS (SELECT 'team-season' AS phase, count(*) AS attempted, count(*) FILTER (WHERE roster) AS loaded, 0 AS rejected FROM units
  UNION ALL SELECT 'season-summaries', count(*), count(*), 0 FROM seasons
  UNION ALL SELECT 'games', count(*), count(*) FILTER (WHERE g % 7 <> 0), count(*) FILTER (WHERE g % 7 <> 0 AND g % 11 = 0) FROM finished),
logged AS (SELECT 'team-season' AS phase, '{E.TEMPLATES[E.ROSTER]}' AS endpoint, scope_key FROM units WHERE roster
  UNION ALL SELECT 'team-season', '{E.TEMPLATES[E.CLUB_SCHEDULE]}', scope_key FROM units WHERE club
  UNION ALL SELECT 'season-summaries', '{E.TEMPLATES[E.SKATER_SUMMARY]}', s FROM seasons
  UNION ALL SELECT 'season-summaries', '{E.TEMPLATES[E.GOALIE_SUMMARY]}', s FROM seasons
  UNION ALL SELECT 'season-summaries', '{E.TEMPLATES[E.TEAM_SUMMARY]}', s FROM seasons WHERE y % 2 = 0
  UNION ALL SELECT 'games', '{E.TEMPLATES[E.LANDING]}', CAST(g AS VARCHAR) FROM finished WHERE g % 7 <> 0
  UNION ALL SELECT 'games', '{E.TEMPLATES[E.BOXSCORE]}', CAST(g AS VARCHAR) FROM finished WHERE g % 7 <> 0 AND g % 11 <> 0
  UNION ALL SELECT 'games', '{E.TEMPLATES[E.PLAY_BY_PLAY]}', CAST(g AS VARCHAR) FROM finished WHERE g % 7 <> 0)
SELECT phase, endpoint, scope_key, CAST(1 AS BIGINT) AS "rows", attempted, loaded, CAST(rejected AS BIGINT) AS rejected,
  attempted - loaded AS waiting FROM logged JOIN counted USING (phase)"""


@case(_BACKFILL)
def backfill_end_to_end(spark, sf):
    """Log and counters of a backfill of all phases and seasons."""
    landing, base = folder(spark), folder(spark)
    # One row per season of the table.
    years = table(spark, sf, "orders").groupBy((F.year("o_orderdate") + 22).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    _backfill_landing(spark, sf, landing, years)
    seasons = sorted(r.season for r in years.select(cal.season_id(F.col("y")).alias("season")).collect())
    result = run_backfill(
        spark, landing, base, seasons, cost_check="warn", ingest_date=DAY, run_id="run", landing_format="parquet", manifest_format="parquet"
    )
    names = ("attempted", "loaded", "rejected", "waiting")
    counted = spark.createDataFrame(
        [(p.phase, *[getattr(p, n) for n in names]) for p in result.phases], "phase string, " + ", ".join(f"{n} bigint" for n in names)
    )
    pairs = [(E.TEMPLATES[f], phase) for phase, families in E.PHASE_FAMILIES.items() for f in families]
    phases = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    log = read_manifest(spark, E.LakePaths(base).manifest, "parquet").where("run_id = 'run' and status = 'ok'")
    return log.select(phases[F.col("endpoint")].alias("phase"), "endpoint", "scope_key", "rows").join(counted, "phase")


# Body checks of the families that the other queries do not judge

_DAY_OF = '{"gameWeek":[{"date":"<day>","games":[{' + GAME + "}]}]}"
_OTHER_SEASON = GAME.replace("<s>", "<next>")
# Family: scope key, body, and by the key's remainder (of 7) another body with its reason.
BODY_CASES = {
    E.BOXSCORE: ("<g>", FAMILY_BODIES[E.BOXSCORE], {
        1: ("{" + GAME + ',"playerByGameStats":"none","gameOutcome":{}}', "missing:playerByGameStats"),
        2: ("{" + GAME + ',"playerByGameStats":{}}', "missing:gameOutcome"),
        3: (FAMILY_BODIES[E.BOXSCORE] + " {}", "malformed_json"),
        4: ("{" + _OTHER_SEASON + ',"playerByGameStats":{},"gameOutcome":{}}', "id_season_mismatch"),
        5: ("{" + GAME.replace("<g>", "<other>") + ',"playerByGameStats":{},"gameOutcome":{}}', "id_not_requested"),
    }),
    E.PLAY_BY_PLAY: ("<g>", FAMILY_BODIES[E.PLAY_BY_PLAY], {
        1: ("{" + GAME + ',"plays":{},"rosterSpots":[]}', "missing:plays"),
        2: ("{" + GAME + ',"plays":[],"rosterSpots":[<k>]}', "missing:rosterSpots"),
        3: ("{" + GAME.replace('"OFF"', "1") + ',"plays":[],"rosterSpots":[]}', "missing:gameState"),
        4: ("{" + GAME + ',"plays":[{"n":<k>}],"rosterSpots":[{}]}', None),
    }),
    E.ROSTER: ("<s>|TOR", '{"forwards":[{"id":<k>,"positionCode":"C"}],"defensemen":[],"goalies":[]}', {
        1: ('{"forwards":[],"defensemen":[]}', "missing:goalies"),
        2: ('{"forwards":[{"id":<k>}],"defensemen":[],"goalies":[]}', "incomplete:forwards"),
        3: ('{"forwards":[],"defensemen":[{"id":"x","positionCode":"D"}],"goalies":[]}', "incomplete:defensemen"),
        4: ('{"forwards":{},"defensemen":[],"goalies":[]}', "missing:forwards"),
    }),
    E.CLUB_SCHEDULE: ("<s>|TOR", '{"previousSeason":1,"currentSeason":<s>,"nextSeason":2,"games":[{"id":<k>}]}', {
        1: ('{"previousSeason":1,"currentSeason":<s>,"nextSeason":2}', "missing:games"),
        2: ('{"previousSeason":1,"currentSeason":<next>,"nextSeason":2,"games":[]}', "season_not_requested"),
        3: ('{"previousSeason":1,"currentSeason":<s>,"nextSeason":"soon","games":[]}', "missing:nextSeason"),
        4: ('{"previousSeason":1,"currentSeason":<s>,"nextSeason":2,"games":[<k>]}', "missing:games"),
        5: ('{"previousSeason":1,"currentSeason":"<s>","nextSeason":2,"games":[]}', None),
    }),
    E.GOALIE_SUMMARY: ("<s>", '{"total":1,"data":[{"seasonId":<s>,"playerId":<k>,"gamesPlayed":1}]}', {
        1: ('{"total":2,"data":[{"seasonId":<s>,"playerId":<k>,"gamesPlayed":1}]}', "total_mismatch"),
        2: ('{"total":1,"data":[{"seasonId":<s>,"playerId":<k>}]}', "incomplete:data"),
        3: ('{"total":1.5,"data":[]}', "missing:total"),
        4: ('{"total":"1","data":[{"seasonId":<s>,"playerId":<k>,"gamesPlayed":1}]}', None),
    }),
    E.TEAM_SUMMARY: ("<s>", '{"total":1,"data":[{"seasonId":<s>,"teamId":<k>,"gamesPlayed":1}]}', {
        1: ('{"total":1,"data":{}}', "missing:data"),
        2: ('{"total":1,"data":[{"seasonId":<s>,"teamId":1.5,"gamesPlayed":1}]}', "incomplete:data"),
        3: ('{"total":0,"data":[]}', None),
        4: ('{"total":1,"data":[', "malformed_json"),
    }),
    E.SCHEDULE: ("<day>", _DAY_OF, {
        1: ('{"gameWeek":{}}', "missing:gameWeek"),
        2: ('{"gameWeek":[{"games":[]}]}', "incomplete:gameWeek"),
        3: (_DAY_OF.replace('"gameState":"OFF",', ""), "incomplete:games"),
        4: (_DAY_OF.replace("<s>", "<next>"), "id_season_mismatch"),
        5: (_DAY_OF.replace('"gameDate":"<day>",', ""), None),
        6: (_DAY_OF.replace('"gameDate":"<day>"', '"gameDate":"soon"'), "incomplete:games"),
    }),
}
_REASONS = ", ".join(
    f"('{family}', {d}, " + (f"'{reason}')" if reason else "NULL)") for family, (_, _, bad) in BODY_CASES.items() for d, (_, reason) in bad.items()
)


@case(f"""SELECT family, reason, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders CROSS JOIN (SELECT unnest([{", ".join(f"'{f}'" for f in BODY_CASES)}]) AS family)
LEFT JOIN (VALUES {_REASONS}) AS r(of_family, d, reason) ON of_family = family AND d = o_orderkey % 7 GROUP BY 1, 2""")
def body_checks_by_family(spark, sf):
    """Every check on a body that is not a landing's or a skater summary's."""
    k, y = F.col("o_orderkey"), F.year("o_orderdate").cast("bigint")
    values = {
        "k": k,
        "g": y * 1_000_000 + k % 1_000_000,
        "other": y * 1_000_000 + (k + 1) % 1_000_000,
        "s": y * 10_000 + y + 1,
        "next": (y + 1) * 10_000 + y + 2,
        "day": F.date_format("o_orderdate", "yyyy-MM-dd"),
    }
    orders = spread(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"))
    judged = []
    for family, (scope, valid, bad) in BODY_CASES.items():
        body = filled(valid, **values)
        for d, (template, _) in bad.items():
            body = F.when(k % 7 == d, filled(template, **values)).otherwise(body)
        rows = orders.select(k, filled(scope, **values).alias("scope_key"), F.lit(200).alias("status"), body.alias("response_json"))
        judged.append(with_reason(rows, family).select(F.lit(family).alias("family"), "reason", "o_orderkey"))
    return union_facts(*judged).groupBy("family", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


# Stored layouts, season ranges, assertions


@case("""SELECT lang AS family, CAST(count(*) AS BIGINT) AS "rows", CAST(sum(strlen(text)) AS BIGINT) AS body_bytes,
  true AS smaller, CAST(count(*) AS BIGINT) AS read_again FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY 1""")
def bronze_write_result(spark, sf):
    """What each write reports, and how many rows are found again; one dataset per language."""
    base = folder(spark)
    docs = table(spark, sf, "documents").where("lang is not null and text is not null")
    rows = []
    # At most a few languages.
    for r in sorted(docs.select("lang").distinct().collect()):
        some = docs.where(F.col("lang") == r.lang).select(
            F.col("doc_id").cast("string").alias("entity_id"),
            F.lit(None).cast("string").alias("season"),
            F.lit(None).cast("date").alias("event_date"),
            F.lit("/v1/documents/{id}").alias("endpoint"),
            F.lit("{}").alias("endpoint_params_json"),
            F.lit("2024-05-01 10:00:00").cast("timestamp").alias("fetched_at_utc"),
            F.col("text").alias("response_json"),
            F.sha2("text", 256).alias("response_sha256"),
        )
        for _ in range(2):  # the same file id replaces what it wrote
            got = write_bronze(some, base, r.lang, DAY, "file")
        found = read_bronze(spark, base, r.lang, DAY, DAY).count()
        rows.append((r.lang, got.rows, got.body_bytes, got.bytes > 0 and got.compression < 1, found))
    return spark.createDataFrame(rows, "family string, rows bigint, body_bytes bigint, smaller boolean, read_again bigint")


@case("SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer")
def seed_csv(spark, sf):
    """A table written as headed CSV and read with a declared schema."""
    path = folder(spark)
    columns = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents")
    rows = table(spark, sf, "customer").select(*columns, cents)
    rows.write.csv(path, header=True)
    return read_seed(spark, path, rows.schema)


@case("""SELECT strftime(o_orderdate, '%Y-%m') AS billing_period, o_orderpriority AS category, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders GROUP BY 1, 2""")
def expense_csv(spark, sf):
    """Expenses written as CSV and read as such, summed per period and category."""
    path = folder(spark)
    table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        F.lit("vendor").alias("vendor"),
        F.col("o_orderpriority").alias("category"),
        F.round(F.col("o_totalprice").cast("decimal(18,6)"), 2).cast("decimal(12,2)").alias("amount_usd"),
        F.date_format("o_orderdate", "yyyy-MM").alias("billing_period"),
        F.col("o_orderkey").cast("string").alias("invoice_ref"),
        F.lit(None).cast("string").alias("notes"),
    ).write.csv(path, header=True)
    totals = reports.period_totals(read_expenses(spark, path), ["billing_period", "category"], "amount_usd")
    return totals.select("billing_period", "category", (F.col("total") * 100).cast("bigint").alias("cents"))


@case("""WITH bounds AS (SELECT min(year(o_orderdate)) - 1 AS a, max(year(o_orderdate)) + 1 AS b FROM orders),
years AS (SELECT CAST(unnest(generate_series(a, b)) AS INTEGER) AS y FROM bounds)
SELECT CAST(y AS VARCHAR) || (y + 1) AS season, y AS start_year, CAST(count(o_orderkey) AS BIGINT) AS n FROM years LEFT JOIN orders ON year(o_orderdate) = y GROUP BY 1, 2""")
def season_range_counts(spark, sf):
    """All seasons from one before the first order to one after the last, with their orders."""
    orders = table(spark, sf, "orders")
    a, b = orders.agg(F.min(F.year("o_orderdate")) - 1, F.max(F.year("o_orderdate")) + 1).first()
    counts = orders.groupBy(F.year("o_orderdate").alias("start_year")).agg(F.count(F.lit(1)).alias("n"))
    seasons = cal.season_range(spark, f"{a}{a + 1}", f"{b}-{(b + 1) % 100:02d}")
    return seasons.join(counts, "start_year", "left").select("season", "start_year", F.coalesce("n", F.lit(0)).alias("n"))


@case("""SELECT 'no empty order' AS assertion, count(*) = 0 AS holds FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
UNION ALL SELECT 'every order has a customer', count(*) = 0 FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'no discount over a tenth', count(*) = 0 FROM lineitem WHERE l_discount > 0.1
UNION ALL SELECT 'no order over 1000', count(*) = 0 FROM orders WHERE o_totalprice > 1000""")
def singular_assertions(spark, sf):
    """Queries that must return nothing, over whole tables, and whether they do."""
    orders, lines, customer = (table(spark, sf, n) for n in ("orders", "lineitem", "customer"))
    queries = {
        "no empty order": orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"),
        "every order has a customer": orders.join(customer, F.col("c_custkey") == F.col("o_custkey"), "left_anti"),
        "no discount over a tenth": lines.where("l_discount > 0.1"),
        "no order over 1000": orders.where("o_totalprice > 1000"),
    }
    rows = []
    for name, rejected in queries.items():
        try:
            assert_no_rows(rejected, name)
            rows.append((name, True))
        except AssertionError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "assertion string, holds boolean")
