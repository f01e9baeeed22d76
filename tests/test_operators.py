import math
import random

import pytest
from pyspark.sql import functions as F

from moraine.operators import joins
from moraine.operators.dedup import duplicate_keys, latest_by
from moraine.operators.quality import Contract, assert_no_rows, run_tests, table_tests
from moraine.operators.unnest import explode_groups, union_facts, unnest_json, unpivot
from moraine.plans import reports


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect() if columns else df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_latest_by_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    # One key holds a third of the rows; keys, order and ties may be NULL.
    data = [
        (rng.choice([1, 1, None, *range(2, 6)]), rng.choice([None, *range(8)]), rng.randrange(4), i)
        for i in range(600)
    ]
    best = {}
    for k, o, t, i in data:
        rank = (o is not None, o if o is not None else 0, -t, i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, o, t, i))
    df = spark.createDataFrame(data, "k int, o int, t int, i int").repartition(4)
    got = latest_by(df, ["k"], "o", ["t", F.col("i").desc()])
    assert rows(got) == sorted((b[1] for b in best.values()), key=str)


def test_latest_by_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(latest_by(df, ["k"], "id"))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_duplicate_keys_ignore_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "k int, v string")
    assert rows(duplicate_keys(df, ["k", "v"])) == [(1, "a", 2)]


def test_unnest_json(spark):
    df = spark.createDataFrame([(1, '[{"a":1},{"a":"x","b":{"c":2}}]'), (2, "[]"), (3, None), (4, "{}")], "k int, j string")
    assert rows(unnest_json(df.where("k < 4"), "j", "e", position="i")) == [
        (1, 0, '{"a":1}'),
        (1, 1, '{"a":"x","b":{"c":2}}'),
    ]
    assert rows(unnest_json(df.where("k < 4"), "j", {"a": "a", "c": "b.c"})) == [(1, "1", None), (1, "x", "2")]


def test_explode_groups_equals_union_all(spark):
    body = '{"p":{"f":[{"n":1},{"n":2}],"g":[]},"q":{"f":[{"n":3}]}}'
    df = spark.createDataFrame([(10, 20, body), (11, 21, "{}")], "left int, right int, j string")
    groups = [
        ("p.f", {"side": F.col("left"), "role": F.lit("F")}),
        ("p.g", {"side": F.col("left"), "role": F.lit("G")}),
        ("q.f", {"side": F.col("right"), "role": F.lit("F")}),
        ("q.g", {"side": F.col("right"), "role": F.lit("G")}),
    ]
    got = explode_groups(df, "j", groups, {"n": "n"}, position="i", keep=["left"])
    assert rows(got) == [(10, 0, 10, "F", "1"), (10, 1, 10, "F", "2"), (10, 2, 20, "F", "3")]
    as_text = explode_groups(df, "j", groups, "e", keep=[])
    assert rows(as_text, "side", "e") == [(10, '{"n":1}'), (10, '{"n":2}'), (20, '{"n":3}')]
    # One scan and one parse, whatever the number of groups.
    assert plan_of(got).count("from_json") == 1 and plan_of(got).count("Scan") == 1


def test_unpivot_scans_once(spark):
    df = spark.createDataFrame([(1, 2, "x")], "home int, away int, d string")
    got = unpivot(df, [{"t": F.col("home")}, {"t": F.col("away")}], keep=["d"])
    assert rows(got) == [("x", 1), ("x", 2)]
    assert plan_of(got).count("Scan") == 1


def test_union_facts_fills_typed_nulls(spark):
    a = spark.createDataFrame([(1, 2)], "k int, goals int")
    b = spark.createDataFrame([(1, 9)], "k int, saves int")
    got = union_facts(a, b)
    assert got.dtypes == [("k", "int"), ("goals", "int"), ("saves", "int")]
    assert set(map(tuple, got.collect())) == {(1, 2, None), (1, None, 9)}


def test_spine_equals_distinct_union_and_left_joins(spark):
    rng = random.Random(1)
    frames = {
        name: spark.createDataFrame([(k, f"{name}{k}") for k in rng.sample(range(30), 12)], "k int, v string")
        for name in "rsg"
    }
    got = joins.spine_left_join("k", frames).select("k", "r.v", "s.v", "g.v")
    want = joins.key_spine("k", list(frames.values()))
    for name, frame in frames.items():
        want = want.join(frame.withColumnRenamed("v", name), "k", "left")
    assert rows(got) == rows(want)


def test_spine_shuffles_once_per_source_only(spark):
    src = lambda n: latest_by(spark.range(n).select((F.col("id") % 7).alias("k"), "id"), ["k"], "id")
    plan = plan_of(joins.spine_left_join("k", {"a": src(50), "b": src(60), "c": src(70)}))
    assert plan.count("Exchange") == 3


def test_orphans_reduce_before_joining(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,), (None,), (3,), (3,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk int")
    assert rows(joins.orphans(child, "fk", parent, "pk")) == [(3, 2)]


def test_pending_units_need_every_endpoint_ok(spark):
    manifest = spark.createDataFrame(
        [("a", "1", "ok"), ("b", "1", "ok"), ("a", "2", "ok"), ("a", "3", "ok"), ("b", "3", "failed"),
         ("a", "4", "ok"), ("a", "4", "ok"), ("c", "4", "ok")],
        "endpoint string, scope_key string, status string",
    )
    units = spark.createDataFrame([(str(i),) for i in range(1, 6)], "scope_key string")
    assert rows(joins.pending_units(units, manifest, ["a", "b"])) == [("2",), ("3",), ("4",), ("5",)]


def test_table_tests(spark):
    df = spark.createDataFrame(
        [(1, "a", 10), (1, "x", 11), (2, None, 99), (None, "b", None), (3, "x", 99)], "k int, v string, fk int"
    )
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    got = table_tests(df, ["k", "v", "fk"], ["k", "fk"], {"v": ["a", "b"]}, {"fk": (parent, "pk")})
    assert {(r["column"], r["test"]): r["failures"] for r in got.collect()} == {
        ("k", "not_null"): 1,
        ("v", "not_null"): 1,
        ("fk", "not_null"): 1,
        ("v", "accepted_values"): 2,
        ("k", "unique"): 1,
        ("fk", "unique"): 1,
        ("fk", "relationships"): 2,
    }
    empty = table_tests(df.limit(0), ["k"], ["k"], {"v": ["a"]}, {"fk": (parent, "pk")})
    assert {r["failures"] for r in empty.collect()} == {0}
    with pytest.raises(ValueError):
        table_tests(df)


def test_tests_of_several_tables_scan_each_once(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (2,), (None,)], "pk int").write.parquet(f"{tmp_path}/p")
    child = [(i, i % 4, None if i % 5 == 0 else i % 4, "x") for i in range(40)]
    spark.createDataFrame(child, "id int, a long, b int, v string").write.parquet(f"{tmp_path}/c")
    frames = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in "pc"}
    contracts = {
        "p": Contract(["pk"], ["pk"]),
        "c": Contract(["b"], ["id", "a"], {"v": ["y"]}, {"a": ("p", "pk"), "b": ("p", "pk")}),
    }
    found = run_tests(frames, contracts)
    assert {(r.model, r.column, r.test): r.failures for r in found.collect()} == {
        ("p", "pk", "not_null"): 1,
        ("p", "pk", "unique"): 1,
        ("c", "b", "not_null"): 8,
        ("c", "v", "accepted_values"): 40,
        ("c", "id", "unique"): 0,
        ("c", "a", "unique"): 4,
        ("c", "a", "relationships"): 20,
        ("c", "b", "relationships"): 16,
    }
    assert plan_of(run_tests(frames, {"c": Contract(["b"], ["id"], {"v": ["y"]})})).count("Scan parquet") == 1
    # The parent's key of another type is counted apart from the one tested as unique.
    assert plan_of(run_tests(frames, contracts)).count("Scan parquet") == 2


def test_more_checks_than_one_mask_holds(spark):
    df = spark.range(3).select(*[F.when(F.col("id") >= i % 4, 1).alias(f"c{i}") for i in range(130)])
    found = {r["column"]: r["failures"] for r in table_tests(df, not_null=df.columns).collect()}
    assert found == {f"c{i}": i % 4 for i in range(130)}


def test_singular_assertion(spark):
    assert_no_rows(spark.range(0), "none")
    with pytest.raises(AssertionError, match="too many"):
        assert_no_rows(spark.range(1), "too many")


@pytest.mark.parametrize("kind", ["long", "double"])
@pytest.mark.parametrize("size, n, rows", [(1, 3, 4), (2, 3, 4), (50, 3, 8), (50, 1, 8), (40, 5, 30), (7, 4, 2), (100, 30, 1)])
def test_rolling_mean_matches_brute_force(spark, size, n, rows, kind):
    rng = random.Random(size)
    data = [(f"{2000 + i // 12}-{i % 12 + 1:02d}", rng.randrange(1000)) for i in range(size)]
    df = spark.createDataFrame(rng.sample(data, size), "period string, total long").withColumn("total", F.col("total").cast(kind))
    got = [(r.period, r.total, r.rolling_mean) for r in reports.rolling_mean(df, "period", "total", n, rows=rows).orderBy("period").collect()]
    values = [v for _, v in data]
    want = [
        (p, v, sum(values[max(0, i - n + 1) : i + 1]) / len(values[max(0, i - n + 1) : i + 1]))
        for i, (p, v) in enumerate(data)
    ]
    assert got == want


@pytest.mark.parametrize("n,rows", [(1, 4), (3, 10), (7, 5), (50, 64), (2000, 300)])
def test_rolling_mean_of_doubles_only_adds(spark, n, rows):
    """Large values beside small ones, nulls and infinities: a frame without them is as if they had never been."""
    rng = random.Random(n)
    values = [rng.choice([None, rng.uniform(-1, 1), rng.uniform(-1e15, 1e15)]) for _ in range(300)]
    values[120] = float("inf")
    df = spark.createDataFrame(list(enumerate(values)), "period long, total double")
    got = {r.period: r.rolling_mean for r in reports.rolling_mean(df, "period", "total", n, rows=rows).collect()}
    for k in range(300):
        held = [v for v in values[max(0, k - n + 1) : k + 1] if v is not None]
        if not held:
            assert got[k] is None
        elif float("inf") in held:
            assert got[k] == float("inf")
        else:
            assert abs(got[k] - math.fsum(held) / len(held)) <= 1e-12 * sum(map(abs, held)) / len(held)


def test_expense_reports(spark, tmp_path):
    from decimal import Decimal

    from moraine.sources.tables import read_expenses

    file = tmp_path / "expenses.csv"
    file.write_text(
        "date,vendor,category,amount_usd,billing_period,invoice_ref,notes\n"
        "2026-01-02,A,Infra,10.00,2026-01,,\n"
        "2026-01-03,B,AI/Tools,20.50,2026-01,r1,\"a, b\"\n"
        "2026-02-02,A,Infra,30.00,2026-02,,\n"
        "2026-02-20,C,Domain,5.25,2026-02-20,,once\n"
        "2025-12-02,A,Infra,40.00,2025-12,,\n"
    )
    df = read_expenses(spark, str(file))
    totals = [tuple(r) for r in reports.period_totals(df, ["billing_period", "category"], "amount_usd").collect()]
    assert totals == [
        ("2026-02-20", "Domain", Decimal("5.25")),
        ("2026-02", "Infra", Decimal("30.00")),
        ("2026-01", "AI/Tools", Decimal("20.50")),
        ("2026-01", "Infra", Decimal("10.00")),
        ("2025-12", "Infra", Decimal("40.00")),
    ]
    monthly = reports.recurring(df, "billing_period").groupBy("billing_period").agg(F.sum("amount_usd").alias("total"))
    mean = reports.rolling_mean(monthly, "billing_period", "total").orderBy(F.col("billing_period").desc()).collect()
    assert [(r.billing_period, float(r.total), round(float(r.rolling_mean), 2)) for r in mean] == [
        ("2026-02", 30.0, 33.5),
        ("2026-01", 30.5, 35.25),
        ("2025-12", 40.0, 40.0),
    ]
    assert reports.total_like(df, "billing_period", "2026-%", "amount_usd", "ytd").first().ytd == Decimal("65.75")


def test_stored_goes_to_the_shared_folder(spark):
    from moraine.sources.shared import shared_folder, stored

    folder = shared_folder(spark)
    assert folder == shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", folder).rstrip("/")
    kept = stored(spark.range(5), "five")
    assert kept.count() == 5 and f"{folder}/moraine/" in kept.inputFiles()[0]
