"""Bronze responses packed from the given tables.

The given tables hold no API responses, so each row of a table is packed into
one JSON body of the family's shape, row by row. Nothing is grouped or
collected: an array in a body is built from its own row, its text or a count
in it. Consecutive keys (2k, 2k+1) are two fetches of the same thing, so every
dedup has work to do. The oracle states the same rows relationally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.operators.bodies import envelopes
from moraine.session import prepare
from moraine.sources import endpoints as E
from moraine.sources.bronze import to_envelope
from moraine.sources.shared import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Stored bytes of a given table that one task packs: the bodies are many times as long.
PACK_BYTES = 3 << 20


def spread(scan: DataFrame) -> DataFrame:
    """Deal rows over all cores for the per-row packing, and into more tasks the larger the table is.

    The given tables are single files, which one task would read and pack. A
    task that packs more has to sort more bodies at once, and spills them.
    """
    spark = scan.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)) for f in scan.inputFiles()]
    size = sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)
    return scan.repartition(max(spark.sparkContext.defaultParallelism, -(-size // PACK_BYTES)))


def div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def micros_after(day: Column, n: Column) -> Column:
    """``n`` microseconds after an instant; makes fetch times unique."""
    return F.timestamp_micros(F.unix_micros(day.cast("timestamp")) + n)


def upto(n: Column) -> Column:
    """Array 1..n; empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))


def pad2(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def clock(minutes: Column, seconds: Column) -> Column:
    return F.concat(pad2(minutes % 60), F.lit(":"), pad2(seconds % 60))


def obj(**members: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in members.items()])


def with_ingest(envelope: DataFrame) -> DataFrame:
    return envelope.withColumn("ingest_date", F.to_date("fetched_at_utc"))


def ok() -> Column:
    return F.col("o_orderkey")


def cust() -> Column:
    return F.col("o_custkey")


def cents(col: str = "o_totalprice") -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def year() -> Column:
    return F.year("o_orderdate")


def order_type() -> Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", 1)
        .when(priority == "3-MEDIUM", 3)
        .when(priority == "5-LOW", 4)
        .otherwise(2)
    )


def order_state() -> Column:
    status = F.col("o_orderstatus")
    return F.when(status == "F", "FINAL").when(status == "O", "OFF").otherwise("LIVE")


def period_type() -> Column:
    kinds = F.array(*map(F.lit, ("REG", "OT", "SO")))
    return F.element_at(kinds, (cents() % 3 + 1).cast("int"))


def _order_game() -> dict[str, Column]:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    away, home = cust() % 32, div(ok(), 2) % 32
    return {
        "id": div(ok(), 2),
        "season": year() * 10000 + year() + 1,
        "gameType": order_type(),
        "gameDate": day,
        "gameState": order_state(),
        "startTimeUTC": F.concat(day, F.lit("T"), pad2(ok() % 24), F.lit(":30:00Z")),
        "awayTeam": obj(
            id=away,
            abbrev=F.concat_ws("_", F.lit("T"), away, year()),
            score=F.when(cust() % 11 != 0, cents() % 7),
        ),
        "homeTeam": obj(
            id=home,
            abbrev=F.concat_ws("_", F.lit("T"), home, year()),
            score=div(cents(), 7) % 7,
        ),
    }


def _order_envelope(orders: DataFrame, family: str, body: Column) -> DataFrame:
    rows = orders.select(
        div(ok(), 2).cast("string").alias("entity"),
        (year() * 10000 + year() + 1).cast("string").alias("s"),
        F.to_date("o_orderdate").alias("d"),
        micros_after(F.col("o_orderdate"), ok()).alias("t"),
        F.to_json(body).alias("response_json"),
    )
    return with_ingest(
        to_envelope(
            rows,
            E.TEMPLATES[family],
            F.col("entity"),
            {"gameId": F.col("entity").cast("bigint")},
            F.col("t"),
            season=F.col("s"),
            event_date=F.col("d"),
        )
    )


def landing(orders: DataFrame) -> DataFrame:
    """One landing response per order."""
    home = div(ok(), 2) % 32
    body = obj(
        **_order_game(),
        venue=obj(default=F.concat(F.lit("Venue "), home)),
        venueTimezone=F.concat(F.lit("Zone/"), home),
        periodDescriptor=obj(periodType=period_type()),
        regPeriods=F.lit(3),
        otInUse=ok() % 2 == 0,
        shootoutInUse=ok() % 3 == 0,
    )
    return _order_envelope(orders, E.LANDING, body)


# Array, players in it, for the away side; the home side uses the next key.
_BOX = (("forwards", 4), ("defense", 3), ("goalies", 2))


def boxscore(orders: DataFrame) -> DataFrame:
    """One boxscore response per order; some lack an array altogether."""

    def players(slot: int, count: Column, goalie: bool) -> Column:
        def player(i: Column) -> Column:
            common = {
                "playerId": cust() * 100 + slot * 10 + i,
                "toi": clock(ok() + i, ok() * 7 + i),
            }
            if goalie:
                return obj(**common, goalsAgainst=(ok() + i) % 6, saves=(ok() * 3 + i) % 40)
            return obj(**common, goals=i % 3, assists=(ok() + i) % 4, sog=(ok() * 5 + i) % 9)

        return F.transform(upto(count), player)

    def side(shift: int) -> Column:
        arrays = {}
        for g, (name, mod) in enumerate(_BOX):
            rows = players(shift * 3 + g, (ok() + shift) % mod, name == "goalies")
            arrays[name] = F.when(ok() % 10 != 0, rows) if name == "defense" else rows
        return obj(**arrays)

    body = obj(
        **_order_game(),
        playerByGameStats=obj(awayTeam=side(0), homeTeam=side(1)),
        gameOutcome=obj(
            lastPeriodType=period_type(),
            otPeriods=F.when(cents() % 3 == 1, F.concat((ok() % 4).cast("string"), F.when(ok() % 5 == 0, "?").otherwise(""))),
        ),
    )
    return _order_envelope(orders, E.BOXSCORE, body)


# Kind of play, member that names its first participant, and its second.
PLAYS = [
    ("period-start", None, None),
    ("goal", "scoringPlayerId", "assist1PlayerId"),
    ("shot-on-goal", "shootingPlayerId", "goalieInNetId"),
    ("hit", "hittingPlayerId", "hitteePlayerId"),
    ("blocked-shot", "blockingPlayerId", None),
    ("faceoff", "winningPlayerId", "losingPlayerId"),
    ("penalty", "committedByPlayerId", "drawnByPlayerId"),
    ("give-away-late", "playerId", None),
]


def play_by_play(documents: DataFrame) -> DataFrame:
    """One response per document: every line of its text is a play."""
    doc, n = F.col("doc_id"), F.col("n_chars")

    def play(line: Column, i: Column) -> Column:
        kind = (n + i) % len(PLAYS)
        names = F.array(*[F.lit(p[0]) for p in PLAYS])
        first = {p[1]: (doc + i) % 500 for p in PLAYS if p[1]}
        second = {p[2]: (doc * 3 + i) % 500 for p in PLAYS if p[2]}
        kinds = {m: k for k, p in enumerate(PLAYS) for m in p[1:] if m}
        members = {m: F.when(kind == kinds[m], v) for m, v in {**first, **second}.items()}
        details = obj(
            eventOwnerTeamId=doc % 32,
            xCoord=(n + i) % 200 - 100,
            yCoord=F.when(i % 4 != 0, (n * 3 + i) % 84 - 42),
            **members,
            line=line,
        )
        return obj(
            eventId=i + 1,
            typeDescKey=F.element_at(names, (kind + 1).cast("int")),
            timeInPeriod=clock(n + i, doc + i),
            periodDescriptor=obj(number=i % 3 + 1, periodType=F.lit("REG")),
            details=F.when(kind != 0, details),
        )

    body = obj(
        id=div(doc, 2),
        season=F.lit(20232024),
        gameType=(doc * 7 + 1) % 4 + 1,
        gameDate=F.lit("2024-01-15"),
        gameState=F.lit("OFF"),
        startTimeUTC=F.lit("2024-01-15T19:00:00Z"),
        awayTeam=obj(id=doc % 32, abbrev=F.col("lang")),
        homeTeam=obj(id=(doc + 1) % 32, abbrev=F.col("source")),
        plays=F.transform(F.split("text", "\n"), play),
        rosterSpots=F.array(obj(playerId=doc)),
    )
    rows = documents.select(
        div(doc, 2).cast("string").alias("scope_key"),
        micros_after(F.lit("2024-01-16"), doc).alias("fetched_at_utc"),
        F.to_json(body).alias("response_json"),
    )
    return with_ingest(envelopes(rows, E.PLAY_BY_PLAY))


def _season_bodies(rows: DataFrame, family: str, key: Column, fetched: Column, elements: Column) -> DataFrame:
    packed = rows.select(
        key.cast("string").alias("entity"),
        fetched.alias("t"),
        F.to_json(obj(data=elements, total=F.size(elements))).alias("response_json"),
    )
    return with_ingest(
        to_envelope(
            packed,
            E.TEMPLATES[family],
            F.col("entity"),
            {"cayenneExp": F.concat(F.lit("seasonId="), "entity"), "limit": F.lit(-1)},
            F.col("t"),
            season=F.col("entity"),
        )
    )


def skater_summary(orders: DataFrame) -> DataFrame:
    """One response per order; its customer stands for the requested season."""

    def row(j: Column) -> Column:
        player = cust() % 50 * 10 + (ok() + j) % 4
        return obj(
            seasonId=year() * 10000 + year() + 1,
            playerId=player,
            skaterFullName=F.concat_ws(" ", F.lit("Skater"), player, ok(), j),
            teamAbbrevs=F.concat_ws(",", F.lit("ANA"), F.when(ok() % 2 == 0, "BUF")),
            positionCode=F.element_at(
                F.array(*map(F.lit, ("C", "L", "R", "D", "X"))), ((ok() + j) % 5 + 1).cast("int")
            ),
            gamesPlayed=ok() % 82,
            goals=(ok() + j) % 60,
            assists=(ok() * 3 + j) % 70,
            points=(ok() + j) % 60 + (ok() * 3 + j) % 70,
            shots=(cents() % 3000) / 10,
            plusMinus=ok() % 41 - 20,
            faceoffWinPct=F.when(ok() % 3 != 0, (cents() % 1000) / 1000),
            timeOnIcePerGame=(cents() % 15000) / 10,
        )

    return _season_bodies(
        orders, E.SKATER_SUMMARY, cust(), micros_after(F.col("o_orderdate"), ok()), F.transform(upto(ok() % 5 + 1), row)
    )


def goalie_summary(orders: DataFrame) -> DataFrame:
    """One response per order; players overlap with the skaters' in part."""

    def row(j: Column) -> Column:
        player = cust() % 40 * 10 + 2 + (ok() + j) % 5
        return obj(
            seasonId=year() * 10000 + year() + 1,
            playerId=player,
            goalieFullName=F.concat_ws(" ", F.lit("Goalie"), player, ok(), j),
            teamAbbrevs=F.lit("TOR"),
            gamesPlayed=ok() % 60,
            wins=F.when(ok() % 4 != 0, ok() % 40),
            losses=(ok() + j) % 30,
            otLosses=F.lit("n/a"),
            savePct=F.when(ok() % 6 != 0, (cents() % 1000) / 1000),
            goalsAgainstAverage=(cents() % 400) / 100,
            shutouts=j,
        )

    return _season_bodies(
        orders, E.GOALIE_SUMMARY, cust(), micros_after(F.col("o_orderdate"), ok()), F.transform(upto(ok() % 3), row)
    )


def team_summary(supplier: DataFrame) -> DataFrame:
    """One response per supplier, with one to three teams."""
    s = F.col("s_suppkey")
    balance = cents("s_acctbal")

    def row(j: Column) -> Column:
        return obj(
            seasonId=F.lit(20202021) + s % 3 * 10001,
            teamId=(s + j * 7) % 40,
            teamFullName=F.concat_ws(" ", F.lit("Team"), s, j),
            gamesPlayed=s % 82,
            wins=s % 50,
            losses=s % 30,
            otLosses=s % 12,
            points=(s % 50) * 2,
            pointPct=F.when(s % 4 != 0, F.abs(balance) % 1000 / 1000),
            regulationAndOtWins=F.when(s % 5 != 0, s % 45),
            goalsForPerGame=F.abs(balance) % 500 / 100,
            goalsAgainstPerGame=F.abs(balance) % 400 / 100,
        )

    return _season_bodies(
        supplier, E.TEAM_SUMMARY, div(s, 2), micros_after(F.lit("2024-02-01"), s), F.transform(upto(s % 3 + 1), row)
    )


def _customer_scope() -> Column:
    return F.concat(F.lit("20002001|K"), div(F.col("c_custkey"), 2))


def roster(customer: DataFrame) -> DataFrame:
    """One response per customer."""
    c = F.col("c_custkey")
    balance = cents("c_acctbal")

    def group(g: int, code: str, count: Column) -> Column:
        def player(j: Column) -> Column:
            player_id = c % 90 * 10 + (j + g) % 5
            return obj(
                id=player_id,
                positionCode=F.lit(code),
                firstName=obj(default=F.concat(F.lit("First"), player_id)),
                lastName=obj(default=F.when((c + j) % 6 != 0, F.concat(F.lit("Last"), c))),
                sweaterNumber=F.when(c % 4 != 0, (c + j) % 99),
                shootsCatches=F.when(c % 2 == 0, "L").otherwise("R"),
                heightInInches=F.lit(66) + (c + j) % 14,
                weightInPounds=F.when(c % 7 != 0, F.concat(F.lit("1"), pad2(c % 90))),
                birthDate=F.when(c % 5 == 0, "unknown").otherwise(
                    F.date_format(F.date_add(F.lit("1980-01-01").cast("date"), (F.abs(balance) % 9000).cast("int")), "yyyy-MM-dd")
                ),
                birthCountry=F.substring("c_mktsegment", 1, 3),
            )

        return F.transform(upto(count), player)

    body = obj(
        forwards=group(0, "C", c % 4),
        defensemen=F.when(c % 6 != 0, group(1, "D", (c + 1) % 3)),
        goalies=group(2, "G", c % 2 + 1),
    )
    rows = customer.select(
        _customer_scope().alias("scope_key"),
        micros_after(F.lit("2024-03-01"), c).alias("fetched_at_utc"),
        F.to_json(body).alias("response_json"),
    )
    return with_ingest(envelopes(rows, E.ROSTER))


def club_schedule(customer: DataFrame) -> DataFrame:
    """One response per customer."""
    c = F.col("c_custkey")
    games = F.transform(upto(c % 7), lambda i: obj(id=c * 10 + i, gameType=i % 3 + 1))
    body = obj(
        previousSeason=F.lit(19992000),
        currentSeason=F.lit(20002001),
        nextSeason=F.lit(20012002),
        clubTimezone=F.concat(F.lit("Zone/"), F.col("c_mktsegment")),
        clubUTCOffset=F.lit("-04:00"),
        games=F.when(c % 9 != 0, games),
    )
    rows = customer.select(
        _customer_scope().alias("scope_key"),
        micros_after(F.lit("2024-03-02"), c).alias("fetched_at_utc"),
        F.to_json(body).alias("response_json"),
    )
    return with_ingest(envelopes(rows, E.CLUB_SCHEDULE))


def schedule_weeks(events: DataFrame) -> DataFrame:
    """One schedule week per event: the day before, its own day, the day after."""
    e = F.col("event_id")
    day = F.to_date("ts")
    states = F.create_map(
        *[F.lit(x) for pair in (("click", "OFF"), ("view", "FINAL"), ("purchase", "LIVE"), ("signup", "FUT")) for x in pair]
    )

    def games(first: int, count: int) -> Column:
        return F.array(
            *[
                obj(
                    id=F.lit(2023_000000) + e * 10 + k,
                    season=F.lit(20232024),
                    gameType=F.lit(k % 4 + 1),
                    gameState=states[F.col("event_type")] if k % 2 else F.lit("OFF"),
                    startTimeUTC=F.lit("2024-01-01T00:00:00Z"),
                    awayTeam=obj(id=F.lit(1), abbrev=F.lit("A")),
                    homeTeam=obj(id=F.lit(2), abbrev=F.lit("B")),
                )
                for k in range(first, first + count)
            ]
        )

    iso = lambda d: F.date_format(d, "yyyy-MM-dd")
    week = F.array(
        obj(date=iso(F.date_sub(day, 1)), games=games(0, 1)),
        obj(date=iso(day), games=games(1, 3)),
        obj(date=iso(F.date_add(day, 1)), games=games(4, 2)),
    )
    return events.select("event_id", iso(day).alias("scope_key"), F.to_json(obj(gameWeek=week)).alias("response_json"))


# Family, the function that packs it, the table it is packed from.
PACKED = {
    E.LANDING: (landing, "orders"),
    E.BOXSCORE: (boxscore, "orders"),
    E.PLAY_BY_PLAY: (play_by_play, "documents"),
    E.SKATER_SUMMARY: (skater_summary, "orders"),
    E.GOALIE_SUMMARY: (goalie_summary, "orders"),
    E.TEAM_SUMMARY: (team_summary, "supplier"),
    E.ROSTER: (roster, "customer"),
    E.CLUB_SCHEDULE: (club_schedule, "customer"),
}


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def unstored_bronze(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """One family's bronze, packed from a whole table as it is read; for jobs that read it once."""
    pack, source = PACKED[family]
    return pack(spread(table(spark, sf_dir, source)))


def bronze(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """One family's bronze, packed from a whole table and stored once.

    The models read a stored layer, as they do in a lake: the first query that
    needs a family writes it to the shared folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir, family)
    if key not in _STORED:
        _STORED[key] = stored(unstored_bronze(spark, sf_dir, family), family)
    return _STORED[key]
