from datetime import date

import pytest
from pyspark.sql import functions as F

from moraine.functions import calendar as cal
from moraine.functions import text as tx
from moraine.functions.json import (
    canonical_json,
    json_fields,
    json_len,
    json_object,
    json_text,
    path_schema,
    to_integer,
)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, want", [("12", 12), ("12.7", 13), ("12.5", 13), ("-12.5", -13), (" 7 ", 7), ("1e3", 1000), (None, None)]
)
def test_integer_from_text_rounds_half_away(spark, text, want):
    assert one(spark, to_integer(F.lit(text).cast("string"))) == want
    assert one(spark, to_integer(F.lit(text).cast("string"), strict=False)) == want


def test_large_integers_stay_exact(spark):
    assert one(spark, to_integer(F.lit("9007199254740993"), "bigint")) == 9007199254740993


@pytest.mark.parametrize("text", ["abc", "", "1-2"])
def test_integer_from_other_text(spark, text):
    assert one(spark, to_integer(F.lit(text), strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, to_integer(F.lit(text)))


def test_json_fields_types_missing_and_null(spark):
    body = '{"a": {"b": "5", "c": null}, "d": true, "e": 1.5, "f": "2024-01-02", "g": [1, {"h": 2}]}'
    df = spark.createDataFrame([(1, body), (2, "{}"), (3, None)], "k int, body string")
    fields = {
        "b": ("a.b", "int", True),
        "c": ("a.c", "string", True),
        "d": ("d", "boolean", True),
        "e": ("e", "double", True),
        "f": ("f", "date", True),
        "g": ("g", "string", True),
        "none": ("x.y.z", "bigint", True),
    }
    rows = {r.k: r for r in json_fields(df, "body", fields, ["k"]).collect()}
    assert rows[1].asDict() == {
        "k": 1, "b": 5, "c": None, "d": True, "e": 1.5, "f": date(2024, 1, 2), "g": '[1,{"h":2}]', "none": None
    }
    assert all(rows[k][f] is None for k in (2, 3) for f in fields)


def test_one_parse_even_under_a_filter(spark):
    df = spark.createDataFrame([("{}",)], "body string")
    out = json_fields(df, "body", {"a": ("a", "int", True), "b": ("b", "int", True)}).where("a in (2, 3)")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_paths_may_not_cross():
    with pytest.raises(ValueError):
        path_schema(["a", "a.b"])
    with pytest.raises(ValueError):
        path_schema(["a.b", "a"])


def test_json_text_and_length(spark):
    df = spark.createDataFrame([('{"a": [ {"z": 1, "b": 2} ], "n": 5}',)], "body string")
    row = df.select(
        json_text("body", "a").alias("a"),
        json_len("body", "a").alias("len"),
        json_len("body", "n").alias("other"),
        json_len("body", "x").alias("absent"),
    ).first()
    assert tuple(row) == ('[{"z":1,"b":2}]', 1, 0, None)


def test_json_objects(spark):
    assert one(spark, json_object(a=F.lit(1), b=F.lit(None).cast("string"))) == '{"a":1,"b":null}'
    made = canonical_json(team=F.lit("TOR"), season=F.lit("20242025"), limit=F.lit(-1))
    assert one(spark, made) == '{"limit": -1, "season": "20242025", "team": "TOR"}'


@pytest.mark.parametrize("text, want", [("00:00", 0), ("19:59", 1199), ("60:05", 3605), (None, None)])
def test_clock(spark, text, want):
    assert one(spark, tx.clock_to_seconds(F.lit(text).cast("string"))) == want


def test_keys_and_names(spark):
    null = F.lit(None).cast("string")
    assert one(spark, tx.surrogate_key(F.lit(5), F.lit(7))) == "5_7"
    assert one(spark, tx.surrogate_key(F.lit(5), null)) == "5_"
    assert one(spark, tx.joined_name(F.lit("a"), null)) is None
    kind = lambda t: tx.alias_or_replace(F.lit(t), {"shot-on-goal": "shot"}, "-", "_")
    assert [one(spark, kind(t)) for t in ("shot-on-goal", "a-b-c", "goal")] == ["shot", "a_b_c", "goal"]


@pytest.mark.parametrize("home, away, who, won", [(3, 2, 8, True), (2, 3, 14, False), (2, 2, 14, False), (None, 1, 14, None)])
def test_winner(spark, home, away, who, won):
    value, flag = tx.winner(F.lit(home).cast("int"), F.lit(away).cast("int"), F.lit(8), F.lit(14))
    assert (one(spark, value), one(spark, flag)) == (who, won)


SEASONS = [
    ("2024-25", "20242025"), ("20242025", "20242025"), (" 2015-16 ", "20152016"), ("1999-00", "19992000"),
    ("2009-10", "20092010"), ("2024-26", None), ("20241999", None), ("2024", None), ("2024_25", None),
    ("abcd-ef", None), ("", None), ("202425", None), ("20242024", None),
]


@pytest.mark.parametrize("text, want", SEASONS)
def test_season_forms(spark, text, want):
    assert one(spark, cal.normalize_season(F.lit(text))) == want
    assert (one(spark, cal.season_reject_reason(F.lit(text))) is None) == (want is not None)
    if want is None:
        with pytest.raises(ValueError):
            cal.checked_season(text)
    else:
        assert cal.checked_season(text) == want


def test_season_from_integer(spark):
    assert one(spark, cal.normalize_season(F.lit(20242025))) == "20242025"
    assert cal.checked_season(20242025) == "20242025"


def test_season_range(spark):
    rows = cal.season_range(spark, "2015-16", 20172018).orderBy("season").collect()
    assert [r.season for r in rows] == ["20152016", "20162017", "20172018"]
    assert cal.season_range(spark, "1999-00", "1999-00").count() == 1
    with pytest.raises(ValueError):
        cal.season_range(spark, "2017-18", "2015-16")


def test_season_calendar(spark):
    seasons = spark.createDataFrame([("20222023",), ("20232024",)], "season string")
    days = cal.season_dates(seasons).groupBy("season").agg(F.count("*"), F.min("game_date"), F.max("game_date"))
    got = {r[0]: tuple(r)[1:] for r in days.collect()}
    assert got["20222023"] == (303, date(2022, 9, 1), date(2023, 6, 30))
    assert got["20232024"] == (304, date(2023, 9, 1), date(2024, 6, 30))
    assert one(spark, cal.season_start(F.lit("20242025"))) == date(2024, 10, 1)


def test_team_membership(spark):
    years = spark.createDataFrame([(y,) for y in (2015, 2016, 2017, 2021, 2023, 2024)], "y int")
    members = {}
    for r in cal.active_members(years, F.col("y")).collect():
        members.setdefault(r.y, set()).add(r.team)
    assert {y: len(m) for y, m in members.items()} == {2015: 30, 2016: 30, 2017: 31, 2021: 32, 2023: 32, 2024: 32}
    assert "ARI" in members[2023] and "UTA" not in members[2023]
    assert "UTA" in members[2024] and "ARI" not in members[2024]


@pytest.mark.parametrize("text, want", [(" tor ", "TOR"), ("MTL", "MTL"), ("TORO", None), ("T1R", None), ("", None)])
def test_team_codes(spark, text, want):
    assert one(spark, cal.normalize_team(F.lit(text))) == want


@pytest.mark.parametrize(
    "instant, want",
    [
        ("2026-05-12T12:00:00Z", date(2026, 5, 11)),
        ("2026-05-12T03:59:00Z", date(2026, 5, 10)),
        ("2026-01-15T04:59:00Z", date(2026, 1, 13)),
        ("2026-01-15T05:00:00Z", date(2026, 1, 14)),
    ],
)
def test_previous_local_day(spark, instant, want):
    assert one(spark, cal.previous_local_day(F.lit(instant).cast("timestamp"))) == want


def test_game_id_encoding(spark):
    ok = lambda g, s: one(spark, cal.game_id_matches_season(F.lit(g).cast("bigint"), F.lit(s)))
    assert ok(2025030457, "20252026") and not ok(2024030123, "20252026")
