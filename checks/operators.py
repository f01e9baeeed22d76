"""Each operator on its own, run over whole given tables, beside its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.functions import calendar as cal
from moraine.functions.json import json_fields, json_len, json_object, json_text
from moraine.functions.text import (
    alias_or_replace,
    clock_to_seconds,
    first_non_null,
    joined_name,
    surrogate_key,
    winner,
)
from moraine.operators import joins
from moraine.operators.bodies import found, split_bodies, with_reason
from moraine.operators.dedup import duplicate_keys, latest_by
from moraine.operators.quality import table_tests
from moraine.operators.unnest import explode_groups, union_facts, unnest_json, unpivot
from moraine.plans import reports, worklists
from moraine.plans.costs import project_cost
from moraine.plans.schedule import schedule_games
from moraine.sources import endpoints as E
from moraine.sources.bronze import to_envelope
from moraine.sources.manifest import manifest_rows
from moraine.sources.shared import stored

from .packed import cents, div, obj, schedule_weeks, spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def case(sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        name = query.__name__.removeprefix("q_")  # the prefix avoids a clash with what it calls
        QUERIES[name], SQL[name] = query, sql
        return query

    return register


# Latest row per key


@case("""SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_event_per_user(spark, sf):
    return latest_by(table(spark, sf, "events"), ["user_id"], "ts", [F.col("event_id").desc()])


@case("""SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_after_type_filter(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    wanted = events.where(F.col("event_type").isin("click", "purchase"))
    return latest_by(wanted, ["user_id"], "ts", [F.col("event_id").desc()]).drop("ts")


@case("""SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_composite_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return latest_by(events, ["user_id", "event_type"], "ts", [F.col("event_id").desc()]).drop("ts")


@case("""WITH fetched AS (
  SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY source, doc_id // 4 ORDER BY doc_id DESC) = 1
), rows AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM fetched
)
SELECT sha256(line) AS line_sha, doc_id, i AS position FROM rows
QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id DESC, i) = 1""")
def two_stage_dedup(spark, sf):
    body = F.to_json(F.split("text", "\n"))
    docs = spread(table(spark, sf, "documents")).select(
        "source", div(F.col("doc_id"), 4).alias("unit"), "doc_id", body.alias("lines")
    )
    fetched = latest_by(docs, ["source", "unit"], "doc_id")
    rows = unnest_json(fetched, "lines", "line", position="position", keep=["doc_id"])
    keyed = rows.select(F.sha2("line", 256).alias("line_sha"), "doc_id", F.col("position").cast("bigint").alias("position"))
    return latest_by(keyed, ["line_sha"], "doc_id", ["position"])


# JSON


@case("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.none') AS missing FROM events""")
def json_typed_extract(spark, sf):
    fields = {"k": ("k", "int", True), "missing": ("none", "string", True)}
    return json_fields(table(spark, sf, "events"), "props", fields, ["event_id"])


@case("""WITH p AS (SELECT event_id, value, CASE event_id % 5 WHEN 0 THEN '2024-02-30' WHEN 1 THEN '2024-02-03'
    WHEN 2 THEN CAST(value AS VARCHAR) WHEN 3 THEN 'abc' END AS t FROM events)
SELECT event_id, TRY_CAST(t AS INTEGER) AS as_int, TRY_CAST(t AS DOUBLE) AS as_double, TRY_CAST(t AS DATE) AS as_date FROM p""")
def json_try_cast(spark, sf):
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, "2024-02-30")
        .when(kind == 1, "2024-02-03")
        .when(kind == 2, F.col("value").cast("string"))
        .when(kind == 3, "abc")
    )
    body = table(spark, sf, "events").select("event_id", F.to_json(obj(t=text)).alias("body"))
    fields = {"as_int": ("t", "int", False), "as_double": ("t", "double", False), "as_date": ("t", "date", False)}
    # One path read three ways: three members of the same parsed text.
    return json_fields(body, "body", fields, ["event_id"])


@case("""SELECT event_id, CAST(json_extract(props, '$') AS VARCHAR) AS whole,
  CAST(json_extract('{"a":{"z":1,"b":[' || event_id || ',2]},"c":' || props || '}', '$.a') AS VARCHAR) AS sub FROM events""")
def json_subtree_text(spark, sf):
    wrapped = F.concat(F.lit('{"a":{"z": 1, "b":['), F.col("event_id"), F.lit(',2]},"c":'), F.col("props"), F.lit("}"))
    events = table(spark, sf, "events").select("event_id", "props", wrapped.alias("wrapped"))
    return events.select("event_id", json_text("props", "").alias("whole"), json_text("wrapped", "a").alias("sub"))


@case("""SELECT doc_id, i AS position, line, CAST(length(line) AS BIGINT) AS n FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)""")
def json_array_unnest(spark, sf):
    rows = F.transform(F.split("text", "\n"), lambda x: obj(line=x, n=F.length(x)))
    docs = spread(table(spark, sf, "documents")).select("doc_id", F.to_json(rows).alias("lines"))
    out = unnest_json(docs, "lines", {"line": "line", "n": "n"}, position="position")
    return out.select("doc_id", F.col("position").cast("bigint").alias("position"), "line", F.col("n").cast("bigint").alias("n"))


@case("""SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_words,
  CASE WHEN doc_id % 3 <> 0 THEN CAST(0 AS BIGINT) END AS n_other FROM documents""")
def json_array_count(spark, sf):
    body = F.to_json(obj(words=F.split("text", " "), other=F.when(F.col("doc_id") % 3 != 0, obj(n=F.lit(1)))))
    docs = spread(table(spark, sf, "documents")).select("doc_id", body.alias("body"))
    return docs.select("doc_id", json_len("body", "words").alias("n_words"), json_len("body", "other").alias("n_other"))


@case("""SELECT c_custkey, CAST(json_object('c_custkey', c_custkey) AS VARCHAR) AS ids,
  CAST(json_object('id', c_custkey, 'segment', CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END) AS VARCHAR) AS more FROM customer""")
def json_object_ids(spark, sf):
    segment = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        json_object(c_custkey=F.col("c_custkey")).alias("ids"),
        json_object(id=F.col("c_custkey"), segment=segment).alias("more"),
    )


# Unions and unpivots


@case("""SELECT 'X' AS position_group, l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT 'Y', l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT 'Z', l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'Z', l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_returnflag = 'R'""")
def group_explode_union(spark, sf):
    flag = F.col("l_returnflag")
    part, supp = obj(key=F.col("l_partkey")), obj(key=F.col("l_suppkey"))
    body = obj(
        a=F.when(flag == "A", F.array(part)), n=F.when(flag == "N", F.array(part)), r=F.when(flag == "R", F.array(part, supp))
    )
    items = spread(table(spark, sf, "lineitem")).select(
        "l_orderkey", "l_linenumber", F.to_json(obj(g=body)).alias("body")
    )
    groups = [(f"g.{k}", {"position_group": F.lit(v)}) for k, v in (("a", "X"), ("n", "Y"), ("r", "Z"))]
    rows = explode_groups(items, "body", groups, {"l_partkey": "key"})
    return rows.withColumn("l_partkey", F.col("l_partkey").cast("bigint"))


@case("""SELECT l_orderkey, 'part' AS side, l_partkey AS entity FROM lineitem
UNION ALL SELECT l_orderkey, 'supplier', l_suppkey FROM lineitem""")
def unpivot_sides(spark, sf):
    return unpivot(
        table(spark, sf, "lineitem"),
        [
            {"side": F.lit("part"), "entity": F.col("l_partkey")},
            {"side": F.lit("supplier"), "entity": F.col("l_suppkey")},
        ],
        keep=["l_orderkey"],
    )


@case("""SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier
UNION SELECT n_nationkey FROM nation UNION SELECT l_suppkey + 0 FROM lineitem""")
def union_distinct_keys(spark, sf):
    keys = [
        table(spark, sf, name).select(F.col(col).cast("bigint").alias("nationkey"))
        for name, col in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"), ("lineitem", "l_suppkey"))
    ]
    return joins.key_spine("nationkey", keys)


@case("""SELECT 'customer_' || c_custkey AS fact_id, c_custkey AS party, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT 'supplier_' || s_suppkey, s_suppkey, NULL, s_acctbal FROM supplier""")
def fact_union_typed_null(spark, sf):
    customers = table(spark, sf, "customer").select(
        surrogate_key(F.lit("customer"), F.col("c_custkey")).alias("fact_id"),
        F.col("c_custkey").alias("party"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        surrogate_key(F.lit("supplier"), F.col("s_suppkey")).alias("fact_id"),
        F.col("s_suppkey").alias("party"),
        F.col("s_acctbal").alias("balance"),
    )
    return union_facts(customers, suppliers)


# Joins


@case("""WITH c AS (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey ELSE -c_custkey END AS k, c_name, c_mktsegment FROM customer),
o AS (SELECT o_custkey AS k, o_orderkey, o_orderpriority FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
s AS (SELECT s_suppkey AS k, s_name FROM supplier),
ids AS (SELECT k FROM c UNION SELECT k FROM o UNION SELECT k FROM s)
SELECT ids.k AS party, coalesce(c_name, s_name, 'order ' || o_orderkey) AS name, o_orderkey AS last_order,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'works' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'home'
    WHEN s.k IS NOT NULL THEN 'supply' END AS role
FROM ids LEFT JOIN c USING (k) LEFT JOIN o USING (k) LEFT JOIN s USING (k)""")
def spine_left_join(spark, sf):
    # Every third customer gets a key that nothing else has.
    own_key = F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
    customers = table(spark, sf, "customer").select(own_key.alias("k"), "c_name", "c_mktsegment")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_orderdate")
    last = latest_by(orders, ["k"], "o_orderdate", [F.col("o_orderkey").desc()])
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), "s_name")
    spine = joins.spine_left_join("k", {"c": customers, "o": last, "s": suppliers})
    role = (
        F.when(F.col("c.c_mktsegment").isin("BUILDING", "MACHINERY"), "works")
        .when(F.col("c.c_mktsegment") == "HOUSEHOLD", "home")
        .when(F.col("s.k").isNotNull(), "supply")
    )
    fallback = F.concat(F.lit("order "), F.col("o.o_orderkey"))
    return spine.select(
        F.col("k").alias("party"),
        first_non_null(F.col("c.c_name"), F.col("s.s_name"), fallback).alias("name"),
        F.col("o.o_orderkey").alias("last_order"),
        role.alias("role"),
    )


@case("""SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = CASE WHEN n_nationkey % 5 <> 0 THEN n_nationkey END""")
def enrich_left_join(spark, sf):
    known = F.when(F.col("n_nationkey") % 5 != 0, F.col("n_nationkey"))
    nations = table(spark, sf, "nation").select(known.alias("c_nationkey"), "n_name")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    named = joins.enrich_left(customers, nations, "c_nationkey")
    return joins.enrich_left(orders, named, "o_custkey").select("o_orderkey", "c_name", "n_name")


@case("""WITH spans(member, from_year, to_year) AS (VALUES ('base', 0, NULL), ('early', 0, 1997), ('mid', 1997, 2000), ('late', 2000, NULL))
SELECT member, year(o_orderdate) AS y, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
JOIN spans ON year(o_orderdate) >= from_year AND (to_year IS NULL OR year(o_orderdate) < to_year) GROUP BY ALL""")
def membership_range_join(spark, sf):
    spans = [("base", 0, None), ("early", 0, 1997), ("mid", 1997, 2000), ("late", 2000, None)]
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("y"))
    active = cal.active_members(orders, F.col("y"), spans, out="member")
    return active.groupBy("member", "y").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@case("""WITH e AS (SELECT *, user_id || '|' || strftime(ts, '%Y-%m-%d') AS scope_key FROM events)
SELECT DISTINCT user_id, scope_key FROM e u
WHERE NOT (EXISTS (SELECT 1 FROM e WHERE e.scope_key = u.scope_key AND event_type = 'purchase' AND value > 2)
  AND EXISTS (SELECT 1 FROM e WHERE e.scope_key = u.scope_key AND event_type = 'signup' AND value > 2))""")
def manifest_gate(spark, sf):
    scope = F.concat_ws("|", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("scope_key")
    status = F.when(F.col("value") > 2, "ok").otherwise("failed").alias("status")
    events = table(spark, sf, "events").select("user_id", scope, F.col("event_type").alias("endpoint"), status)
    units = events.select("user_id", "scope_key").distinct()
    return joins.pending_units(units, events, ["purchase", "signup"])


@case("""SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_rows FROM orders WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer WHERE o_custkey = CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END) GROUP BY 1""")
def fk_violations(spark, sf):
    known = F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey"))
    parents = table(spark, sf, "customer").withColumn("c_custkey", known)
    return joins.orphans(table(spark, sf, "orders"), "o_custkey", parents, "c_custkey")


# Column expressions


@case("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' ELSE replace(o_orderpriority, '-', '_') END AS kind FROM orders""")
def q_alias_or_replace(spark, sf):
    kind = alias_or_replace(F.col("o_orderpriority"), {"1-URGENT": "now"}, "-", "_")
    return table(spark, sf, "orders").select("o_orderkey", kind.alias("kind"))


@case("""SELECT l_orderkey, l_partkey, l_suppkey, concat(CAST(l_orderkey AS VARCHAR), '_', CAST(n AS VARCHAR)) AS skipping,
  CAST(l_orderkey AS VARCHAR) || ' ' || CAST(n AS VARCHAR) AS propagating
FROM (SELECT *, CASE WHEN l_partkey % 4 <> 0 THEN l_linenumber END AS n FROM lineitem)""")
def q_surrogate_key(spark, sf):
    line = F.when(F.col("l_partkey") % 4 != 0, F.col("l_linenumber"))
    key = F.col("l_orderkey")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        surrogate_key(key, line).alias("skipping"),
        joined_name(key.cast("string"), line.cast("string")).alias("propagating"),
    )


@case("SELECT event_id, CAST(minute(ts) * 60 + second(ts) AS INTEGER) AS seconds FROM events")
def clock_seconds(spark, sf):
    text = F.date_format("ts", "mm:ss")
    return table(spark, sf, "events").select("event_id", clock_to_seconds(text).alias("seconds"))


@case("""SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN h > a THEN l_partkey ELSE l_suppkey END AS winner, h > a AS home_win
FROM (SELECT *, CASE WHEN l_partkey % 9 <> 0 THEN l_quantity END AS h, CAST(l_linenumber * 7 AS DOUBLE) AS a FROM lineitem)""")
def winner_flag(spark, sf):
    home = F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity"))
    who, home_win = winner(home, F.col("l_linenumber") * 7.0, F.col("l_partkey"), F.col("l_suppkey"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", who.alias("winner"), home_win.alias("home_win")
    )


@case("""SELECT c_custkey AS team_id, 1 AS league_id, n_name AS team_full_name, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS INTEGER) AS capacity
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def dim_constant_nulls(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.enrich_left(table(spark, sf, "customer"), nations, "c_nationkey").select(
        F.col("c_custkey").alias("team_id"),
        F.lit(1).alias("league_id"),
        F.col("n_name").alias("team_full_name"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("int").alias("capacity"),
    )


@case("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderdate + to_hours(o_orderkey % 24) AS t FROM orders""")
def date_parse(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    start = F.concat(day, F.lit("T"), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00:00Z"))
    body = table(spark, sf, "orders").select("o_orderkey", F.to_json(obj(d=day, t=start)).alias("body"))
    out = json_fields(body, "body", {"d": ("d", "date", True), "t": ("t", "timestamp", True)}, ["o_orderkey"])
    return out.withColumn("t", F.col("t").cast("timestamp_ntz"))


@case("""SELECT CAST(doc_id AS VARCHAR) AS entity_id, sha256(text) AS response_sha256,
  '{"lang": "' || lang || '", "n": ' || n_chars || '}' AS endpoint_params_json, CAST('2024-05-01' AS DATE) AS event_date,
  CAST('2024-05-01 10:00:00' AS TIMESTAMP) AS fetched_at_utc, CAST(strlen(text) AS BIGINT) AS bytes FROM documents""")
def envelope_hash(spark, sf):
    rows = to_envelope(
        table(spark, sf, "documents"),
        "/v1/documents/{id}",
        F.col("doc_id"),
        {"n": F.col("n_chars"), "lang": F.col("lang")},
        F.lit("2024-05-01 10:00:00").cast("timestamp"),
        body="text",
        event_date=F.lit("2024-05-01"),
    )
    return rows.select(
        "entity_id",
        "response_sha256",
        "endpoint_params_json",
        "event_date",
        F.col("fetched_at_utc").cast("timestamp_ntz").alias("fetched_at_utc"),
        F.octet_length("response_json").cast("bigint").alias("bytes"),
    )


@case("""SELECT event_id, CAST(timezone('America/Toronto', timezone('UTC', ts)) AS DATE) - 1 AS d FROM events""")
def previous_local_day(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", cal.previous_local_day(F.col("ts").cast("timestamp")).alias("d")
    )


# Seasons


@case("""WITH t AS (SELECT o_orderkey, year(o_orderdate) AS y, upper(trim(substring(o_orderpriority, 3, CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE 3 END))) AS team,
  CASE o_orderkey % 6 WHEN 0 THEN y || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') WHEN 1 THEN CAST(y AS VARCHAR) || (y + 1)
    WHEN 2 THEN y || '-' || lpad(CAST((y + 2) % 100 AS VARCHAR), 2, '0') WHEN 3 THEN CAST(y AS VARCHAR) || (y - 1) WHEN 4 THEN 'season ' || y END AS raw FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1) THEN CAST(y AS VARCHAR) || (y + 1) END AS season,
  CASE o_orderkey % 6 WHEN 2 THEN 'non_consecutive_years' WHEN 3 THEN 'non_consecutive_years' WHEN 0 THEN NULL WHEN 1 THEN NULL
    ELSE 'malformed_season' END AS reason,
  CASE WHEN regexp_full_match(team, '[A-Z]{3}') THEN team END AS team FROM t""")
def season_normalize(spark, sf):
    y, kind = F.year("o_orderdate"), F.col("o_orderkey") % 6
    dashed = lambda n: F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + n) % 100).cast("string"), 2, "0"))
    raw = (
        F.when(kind == 0, F.concat(F.lit(" "), dashed(1)))
        .when(kind == 1, F.concat(y.cast("string"), (y + 1).cast("string")))
        .when(kind == 2, dashed(2))
        .when(kind == 3, F.concat(y.cast("string"), (y - 1).cast("string")))
        .when(kind == 4, F.concat(F.lit("season "), y))
    )
    width = F.when(F.col("o_orderkey") % 3 == 0, 4).otherwise(3)
    team = F.concat(F.lower(F.substring("o_orderpriority", F.lit(3), width)), F.lit("  "))
    rows = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"), team.alias("raw_team"))
    return rows.select(
        "o_orderkey",
        cal.normalize_season(F.col("raw")).alias("season"),
        cal.season_reject_reason(F.col("raw")).alias("reason"),
        cal.normalize_team(F.col("raw_team")).alias("team"),
    )


@case("""WITH seasons AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
days AS (SELECT y, CAST(unnest(generate_series(make_date(y, 9, 1), make_date(y + 1, 6, 30), INTERVAL 1 DAY)) AS DATE) AS d FROM seasons)
SELECT CAST(y AS VARCHAR) || (y + 1) AS season, d AS game_date, make_date(y, 10, 1) AS event_date, CAST(count(o_orderkey) AS BIGINT) AS n
FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY ALL""")
def season_calendar(spark, sf):
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("game_date")).agg(F.count(F.lit(1)).alias("n"))
    years = daily.select(F.year("game_date").alias("y")).distinct()
    seasons = years.select(cal.season_id(F.col("y")).alias("season"))
    days = cal.season_dates(seasons).withColumn("event_date", cal.season_start(F.col("season")))
    counted = joins.enrich_left(days, daily, "game_date")
    return counted.withColumn("n", F.coalesce("n", F.lit(0)))


# Quality


@case("""SELECT 'o_custkey' AS "column", 'not_null' AS test, CAST(count(*) FILTER (WHERE o_custkey % 10 = 0) AS BIGINT) AS failures FROM orders
UNION ALL SELECT 'o_orderdate', 'not_null', CAST(count(*) FILTER (WHERE o_orderdate IS NULL) AS BIGINT) FROM orders
UNION ALL SELECT 'o_orderpriority', 'accepted_values', CAST(count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS BIGINT) FROM orders
UNION ALL SELECT 'o_orderkey', 'unique', CAST(count(*) AS BIGINT) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'o_custkey', 'relationships', CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey % 10 <> 0
  AND NOT EXISTS (SELECT 1 FROM customer WHERE o_custkey = CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END)""")
def table_tests_long(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_custkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")))
    known = F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey"))
    customers = table(spark, sf, "customer").withColumn("c_custkey", known)
    return table_tests(
        orders,
        not_null=["o_custkey", "o_orderdate"],
        unique=["o_orderkey"],
        accepted={"o_orderpriority": ["1-URGENT", "2-HIGH"]},
        relationships={"o_custkey": (customers, "c_custkey")},
    )


@case("""SELECT 'doc_id' AS "column", 'not_null' AS test, CAST(count(*) FILTER (WHERE doc_id IS NULL) AS BIGINT) AS failures FROM documents
UNION ALL SELECT 'text', 'not_null', CAST(count(*) FILTER (WHERE text IS NULL) AS BIGINT) FROM documents
UNION ALL SELECT 'lang', 'not_null', CAST(count(*) FILTER (WHERE lang = 'en') AS BIGINT) FROM documents""")
def not_null_counts(spark, sf):
    docs = table(spark, sf, "documents").withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")))
    return table_tests(docs, not_null=["doc_id", "text", "lang"])


@case("""SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@case("""SELECT 'l_returnflag' AS "column", 'accepted_values' AS test, CAST(count(*) AS BIGINT) AS failures FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
UNION ALL SELECT 'l_linenumber', 'accepted_values', CAST(count(*) AS BIGINT) FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3)""")
def accepted_value_violations(spark, sf):
    accepted = {"l_returnflag": ["A", "N"], "l_linenumber": [1, 2, 3]}
    return table_tests(table(spark, sf, "lineitem"), accepted=accepted)


@case("""SELECT o_orderkey, CAST(year(o_orderdate) + o_orderkey % 5 // 4 AS BIGINT) * 1000000 + o_orderkey % 1000000 AS game_id,
  o_orderkey % 5 <> 4 AS matches FROM orders""")
def id_encoding_check(spark, sf):
    y = F.year("o_orderdate")
    shifted = y + div(F.col("o_orderkey") % 5, 4)
    game = shifted.cast("bigint") * 1_000_000 + F.col("o_orderkey") % 1_000_000
    rows = table(spark, sf, "orders").select("o_orderkey", game.alias("game_id"), (y * 10000 + y + 1).alias("season"))
    return rows.select("o_orderkey", "game_id", cal.game_id_matches_season(F.col("game_id"), F.col("season")).alias("matches"))


@case("""SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'total_mismatch' WHEN o_orderkey % 17 = 0 THEN 'missing:total'
  WHEN o_orderkey % 19 = 0 THEN 'malformed_json' END AS reason, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders GROUP BY 1""")
def declared_total_check(spark, sf):
    key = F.col("o_orderkey")
    rows = F.transform(
        F.sequence(F.lit(1), (key % 4 + 1).cast("int")),
        lambda j: obj(seasonId=F.lit(20202021), playerId=j, gamesPlayed=j, goals=j, assists=j, points=j),
    )
    total = F.when(key % 13 == 0, F.size(rows) + 1).when(key % 17 != 0, F.size(rows))
    text = F.to_json(obj(data=rows, total=total))
    broken = F.when((key % 19 == 0) & (key % 13 != 0) & (key % 17 != 0), F.substring(text, F.lit(1), F.length(text) - 3)).otherwise(text)
    bodies = spread(table(spark, sf, "orders")).select(key, F.lit("20202021").alias("scope_key"), F.lit(200).alias("status"), broken.alias("response_json"))
    judged = with_reason(bodies, E.SKATER_SUMMARY)
    return judged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


_REJECTS = """CASE WHEN o_orderkey % 11 = 0 THEN 'malformed_json' WHEN o_orderkey % 13 = 0 THEN 'missing:gameDate'
  WHEN o_orderkey % 7 = 0 THEN 'missing:homeTeam.abbrev' WHEN o_orderkey % 5 = 4 THEN 'id_season_mismatch'
  WHEN o_orderkey % 17 = 0 THEN 'id_not_requested' END"""


def _game_bodies(spark, sf):
    key, y = F.col("o_orderkey"), F.year("o_orderdate")
    shifted = y + div(key % 5, 4)
    game = shifted.cast("bigint") * 1_000_000 + key % 1_000_000
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    body = obj(
        id=game,
        season=y * 10000 + y + 1,
        gameType=F.lit(2),
        gameDate=F.when(key % 13 == 0, F.lit("2024-13-45")).otherwise(day),
        gameState=F.lit("OFF"),
        startTimeUTC=F.concat(day, F.lit("T19:00:00Z")),
        awayTeam=obj(id=F.lit(1), abbrev=F.lit("A")),
        homeTeam=obj(id=F.lit(2), abbrev=F.when(key % 7 != 0, "B")),
        extra=obj(kept=key),
    )
    text = F.to_json(body)
    broken = F.when(key % 11 == 0, F.substring(text, F.lit(1), F.length(text) - 9)).otherwise(text)
    asked = F.when(key % 17 == 0, game + 1).otherwise(game)
    return spread(table(spark, sf, "orders")).select(
        "o_orderkey", asked.cast("string").alias("scope_key"), F.lit(200).alias("status"), broken.alias("response_json")
    )


@case(f"SELECT o_orderkey, {_REJECTS} AS reason FROM orders WHERE {_REJECTS} IS NOT NULL")
def body_reject_split(spark, sf):
    _, rejects = split_bodies(with_reason(_game_bodies(spark, sf), E.LANDING))
    return rejects.select("o_orderkey", "reason")


@case(f"SELECT o_orderkey FROM orders WHERE {_REJECTS} IS NULL")
def body_accepts(spark, sf):
    valid, _ = split_bodies(with_reason(_game_bodies(spark, sf), E.LANDING))
    return valid.select("o_orderkey")


@case(f"""SELECT reason, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM (SELECT *, {_REJECTS} AS reason FROM orders WHERE o_orderkey % 4 <> 0) GROUP BY 1""")
def missing_resource_skip(spark, sf):
    status = F.when(F.col("o_orderkey") % 4 == 0, 404).when(F.col("o_orderkey") % 4 == 1, 200)
    judged = with_reason(found(_game_bodies(spark, sf).withColumn("status", status)), E.LANDING)
    return judged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


# Work lists, costs, reports


@case("""SELECT event_id, CAST(ts AS DATE) AS schedule_date, k - 1 AS position, 2023000000 + event_id * 10 + k AS game_id, k % 4 + 1 AS game_type, state AS game_state
FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 'OFF' ELSE CASE event_type WHEN 'click' THEN 'OFF' WHEN 'view' THEN 'FINAL' WHEN 'purchase' THEN 'LIVE' WHEN 'signup' THEN 'FUT' END END AS state
  FROM (SELECT *, unnest([1, 2, 3]) AS k FROM events)) WHERE state IN ('FINAL', 'OFF')""")
def schedule_work_list(spark, sf):
    weeks = schedule_weeks(spread(table(spark, sf, "events")))
    games = schedule_games(weeks, F.to_date("scope_key"), keep=["event_id", "scope_key"])
    return games.select("event_id", "schedule_date", "position", "game_id", "game_type", "game_state")


@case("""SELECT CAST(ts AS DATE) AS schedule_date, CAST(count(*) AS BIGINT) AS in_schedule,
  CAST(count(*) FILTER (WHERE state IN ('FINAL', 'OFF')) AS BIGINT) AS eligible
FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 'OFF' ELSE CASE event_type WHEN 'click' THEN 'OFF' WHEN 'view' THEN 'FINAL' WHEN 'purchase' THEN 'LIVE' WHEN 'signup' THEN 'FUT' END END AS state
  FROM (SELECT *, unnest([1, 2, 3]) AS k FROM events)) GROUP BY 1""")
def daily_summary(spark, sf):
    weeks = schedule_weeks(spread(table(spark, sf, "events")))
    games = schedule_games(weeks, F.to_date("scope_key"), states=None, keep=["scope_key"])
    return games.groupBy("schedule_date").agg(
        F.count(F.lit(1)).alias("in_schedule"),
        F.count_if(F.col("game_state").isin(*E.FINISHED_STATES)).alias("eligible"),
    )


def _planned(spark, sf):
    """Season-by-team units against a manifest and arrivals read off orders."""
    orders = table(spark, sf, "orders")
    codes = F.array(*[F.lit(t[0]) for t in cal.TEAM_INTERVALS])
    team = F.element_at(codes, (F.col("o_custkey") % len(cal.TEAM_INTERVALS) + 1).cast("int"))
    season = cal.season_id(F.year("o_orderdate") + 22)
    logged = orders.select(
        season.alias("season"),
        F.concat_ws("|", season, team).alias("scope_key"),
        F.when(F.col("o_orderkey") % 2 == 0, E.TEMPLATES[E.ROSTER]).otherwise(E.TEMPLATES[E.CLUB_SCHEDULE]).alias("endpoint"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "ok").otherwise("failed").alias("status"),
        F.col("o_orderstatus"),
    )
    units = worklists.team_season_units(logged.select("season").distinct())
    arrived = logged.where(F.col("o_orderstatus") == "F")
    return worklists.plan_units(units, logged, E.templates_of(E.TEAM_SEASON_FAMILIES), arrived)


# Team codes with their first season's year and the year after the last, as the oracle states them.
TEAMS_SQL = """teams(i, team, from_year, to_year) AS (VALUES
  (0, 'ANA', 0, NULL), (1, 'ARI', 0, 2024), (2, 'BOS', 0, NULL), (3, 'BUF', 0, NULL), (4, 'CAR', 0, NULL),
  (5, 'CBJ', 0, NULL), (6, 'CGY', 0, NULL), (7, 'CHI', 0, NULL), (8, 'COL', 0, NULL), (9, 'DAL', 0, NULL),
  (10, 'DET', 0, NULL), (11, 'EDM', 0, NULL), (12, 'FLA', 0, NULL), (13, 'LAK', 0, NULL), (14, 'MIN', 0, NULL),
  (15, 'MTL', 0, NULL), (16, 'NJD', 0, NULL), (17, 'NSH', 0, NULL), (18, 'NYI', 0, NULL), (19, 'NYR', 0, NULL),
  (20, 'OTT', 0, NULL), (21, 'PHI', 0, NULL), (22, 'PIT', 0, NULL), (23, 'SEA', 2021, NULL), (24, 'SJS', 0, NULL),
  (25, 'STL', 0, NULL), (26, 'TBL', 0, NULL), (27, 'TOR', 0, NULL), (28, 'UTA', 2024, NULL), (29, 'VAN', 0, NULL),
  (30, 'VGK', 2017, NULL), (31, 'WPG', 0, NULL), (32, 'WSH', 0, NULL))"""
_PLAN = f"""WITH {TEAMS_SQL},
logged AS (SELECT *, year(o_orderdate) + 22 AS y, CAST(y AS VARCHAR) || (y + 1) AS season,
  season || '|' || team AS scope_key FROM orders JOIN teams ON i = o_custkey % 33),
units AS (SELECT season, team, season || '|' || team AS scope_key FROM (SELECT DISTINCT y, season FROM logged)
  JOIN teams ON y >= from_year AND (to_year IS NULL OR y < to_year)),
planned AS (SELECT season, team, scope_key, CASE
  WHEN EXISTS (SELECT 1 FROM logged l WHERE l.scope_key = u.scope_key AND o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0)
   AND EXISTS (SELECT 1 FROM logged l WHERE l.scope_key = u.scope_key AND o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 1) THEN 'skipped'
  WHEN EXISTS (SELECT 1 FROM logged l WHERE l.scope_key = u.scope_key AND o_orderstatus = 'F') THEN 'loaded' ELSE 'waiting' END AS state
  FROM units u)
"""


@case(_PLAN + "SELECT season, team, scope_key, state FROM planned ORDER BY season, team")
def backfill_plan(spark, sf):
    return worklists.in_work_order(_planned(spark, sf), "season", "team")


@case(_PLAN + """SELECT season, CAST(count(*) AS BIGINT) AS attempted, CAST(count(*) FILTER (WHERE state = 'skipped') AS BIGINT) AS skipped,
  CAST(count(*) FILTER (WHERE state = 'loaded') AS BIGINT) AS loaded, CAST(count(*) FILTER (WHERE state = 'waiting') AS BIGINT) AS waiting FROM planned GROUP BY 1""")
def phase_counts(spark, sf):
    return worklists.phase_counts(_planned(spark, sf), ["season"])


def _finished(spark, sf):
    """Finished games of the schedule weeks, and a manifest that lacks some endpoints."""
    weeks = schedule_weeks(spread(table(spark, sf, "events")))
    games = schedule_games(weeks, F.to_date("scope_key"), keep=["scope_key"]).select(
        "schedule_date", "game_id", F.col("game_id").cast("string").alias("scope_key")
    )
    games = stored(games, "games")  # read as units and as the manifest
    logged = games.select(
        "scope_key",
        "game_id",
        F.posexplode(F.array(*map(F.lit, E.templates_of(E.GAME_FAMILIES)))).alias("i", "endpoint"),
    )
    status = F.when((F.col("game_id") * 7 + F.col("i")) % 5 != 0, "ok").otherwise("failed")
    return games, logged.withColumn("status", status)


_FINISHED = """SELECT CAST(ts AS DATE) AS schedule_date, 2023000000 + event_id * 10 + k AS game_id
FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 'OFF' ELSE CASE event_type WHEN 'click' THEN 'OFF' WHEN 'view' THEN 'FINAL' END END AS state
  FROM (SELECT *, unnest([1, 2, 3]) AS k FROM events)) WHERE state IN ('FINAL', 'OFF')"""


@case(f"""SELECT schedule_date, game_id FROM ({_FINISHED})
WHERE (game_id * 7) % 5 = 0 OR (game_id * 7 + 1) % 5 = 0 OR (game_id * 7 + 2) % 5 = 0""")
def daily_pending_games(spark, sf):
    games, manifest = _finished(spark, sf)
    pending = joins.pending_units(games, manifest, E.templates_of(E.GAME_FAMILIES))
    return pending.select("schedule_date", "game_id")


def _summaries(spark, sf):
    """Season units against a manifest in which a season lacks an endpoint."""
    orders = table(spark, sf, "orders")
    endpoints = F.array(*map(F.lit, E.templates_of(E.SUMMARY_FAMILIES)))
    kept = F.when(F.year("o_orderdate") % 2 == 0, 3).otherwise(2)
    logged = orders.select(
        cal.season_id(F.year("o_orderdate")).alias("scope_key"),
        F.element_at(endpoints, (F.col("o_orderkey") % kept + 1).cast("int")).alias("endpoint"),
        F.lit("ok").alias("status"),
    )
    units = worklists.summary_units(logged.select(F.col("scope_key").alias("season")).distinct())
    return worklists.plan_units(units, logged, E.templates_of(E.SUMMARY_FAMILIES))


_SEASONS = """SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || (year(o_orderdate) + 1) AS season,
  CASE WHEN year(o_orderdate) % 2 = 0 THEN 'skipped' ELSE 'loaded' END AS state FROM orders"""


@case(f"SELECT season, season AS scope_key, state FROM ({_SEASONS})")
def summary_plan(spark, sf):
    return _summaries(spark, sf)


@case(_PLAN + f""", phases AS (SELECT 'team-season' AS phase, state FROM planned
  UNION ALL SELECT 'season-summaries', state FROM ({_SEASONS})
  UNION ALL SELECT 'games', CASE WHEN (game_id * 7) % 5 = 0 OR (game_id * 7 + 1) % 5 = 0 OR (game_id * 7 + 2) % 5 = 0 THEN 'loaded' ELSE 'skipped' END FROM ({_FINISHED}))
SELECT phase, CAST(count(*) AS BIGINT) AS attempted, CAST(count(*) FILTER (WHERE state = 'skipped') AS BIGINT) AS skipped,
  CAST(count(*) FILTER (WHERE state = 'loaded') AS BIGINT) AS loaded, CAST(count(*) FILTER (WHERE state = 'waiting') AS BIGINT) AS waiting FROM phases GROUP BY 1""")
def backfill_phases(spark, sf):
    games, manifest = _finished(spark, sf)
    planned = {
        "team-season": _planned(spark, sf),
        "season-summaries": _summaries(spark, sf),
        "games": worklists.plan_units(games, manifest, E.templates_of(E.GAME_FAMILIES)),
    }
    states = [plan.select(F.lit(phase).alias("phase"), "state") for phase, plan in planned.items()]
    return worklists.phase_counts(union_facts(*states))


@case("""SELECT lang AS endpoint, CAST(doc_id // 3 AS VARCHAR) AS scope_key, CAST(count(*) AS BIGINT) AS rows,
  CAST(sum(strlen(text)) AS BIGINT) AS bytes, 'run' AS run_id, 'ok' AS status FROM documents GROUP BY 1, 2""")
def manifest_build(spark, sf):
    written = table(spark, sf, "documents").select(
        F.col("lang").alias("endpoint"), F.col("text").alias("response_json"), div(F.col("doc_id"), 3).cast("string").alias("entity_id")
    )
    return manifest_rows(written, "run", F.col("entity_id")).drop("fetched_at_utc")


@case("""SELECT b AS bytes_cumulative, b / 1073741824.0::DOUBLE AS gigabytes_cumulative, b / 1073741824.0::DOUBLE * 0.015::DOUBLE AS monthly_cost_usd,
  0.00001::DOUBLE AS threshold_usd, b / 1073741824.0::DOUBLE * 0.015::DOUBLE > 0.00001::DOUBLE AS tripped
FROM (SELECT CAST(sum(strlen(text)) AS BIGINT) AS b FROM documents)""")
def cost_projection(spark, sf):
    manifest = table(spark, sf, "documents").select(F.octet_length("text").alias("bytes"))
    return project_cost(manifest, threshold=0.00001)


_PERIODS = """(SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m') END AS period,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"""


def _expenses(spark, sf):
    period = F.when(F.col("o_orderkey") % 10 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM")
    )
    return table(spark, sf, "orders").select(period.alias("period"), F.col("o_orderpriority").alias("category"), cents().alias("cents"))


@case(f"""SELECT period, o_orderpriority AS category, CAST(sum(cents) AS BIGINT) AS total FROM {_PERIODS}
GROUP BY 1, 2 ORDER BY period DESC, total DESC""")
def period_totals(spark, sf):
    return reports.period_totals(_expenses(spark, sf), ["period", "category"], "cents")


@case(f"""WITH monthly AS (SELECT period, CAST(sum(cents) AS BIGINT) AS total FROM {_PERIODS} WHERE length(period) = 7 GROUP BY 1)
SELECT period, total, avg(total) OVER (ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_mean
FROM monthly ORDER BY period DESC""")
def rolling_mean(spark, sf):
    recurring = reports.recurring(_expenses(spark, sf), "period")
    monthly = recurring.groupBy("period").agg(F.sum("cents").alias("total"))
    return reports.rolling_mean(monthly, "period", "total").orderBy(F.col("period").desc())


@case(f"SELECT CAST(sum(cents) AS BIGINT) AS ytd FROM {_PERIODS} WHERE period LIKE '1997-%'")
def year_to_date(spark, sf):
    return reports.total_like(_expenses(spark, sf), "period", "1997-%", "cents", out="ytd")
