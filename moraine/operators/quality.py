"""Declarative table tests: not null, unique, accepted values, relationships."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Checks of single rows that one bit mask holds.
_BITS = 62
_NESTED = (T.ArrayType, T.MapType, T.StructType)


@dataclass(frozen=True)
class Contract:
    """Declared tests of a table; ``relationships`` maps a column to (parent table, its key)."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def _key_text(name: str, kind: T.DataType) -> Column:
    value = F.col(name).cast(kind)
    text = F.to_json(F.struct(value.alias("k"))) if isinstance(kind, _NESTED) else value.cast("string")
    return F.when(F.col(name).isNotNull(), text)


def _row_checks(contract: Contract) -> list[tuple[str, str, Column]]:
    nulls = [(c, "not_null", F.col(c).isNull()) for c in contract.not_null]
    others = [
        (c, "accepted_values", F.coalesce(~F.col(c).isin(list(values)), F.lit(False)))
        for c, values in contract.accepted.items()
    ]
    return nulls + others


class _Lanes:
    """What each table's rows add to the shared count, and which test each counter stands for."""

    def __init__(self, frames):
        self.frames = frames
        self.lanes: dict[str, list[Column]] = {}
        self.masks: list[int] = []
        self.tests: list[tuple[int, int, str, str, str]] = []
        self._keys: dict[tuple[str, str, str], int] = {}
        self._children: dict[int, int] = {}
        self._groups = 0

    def _add(self, table: str, group: int, slot: int, key: Column) -> None:
        lane = F.struct(F.lit(group).alias("grp"), F.lit(slot).alias("slot"), key.alias("key"))
        self.lanes.setdefault(table, []).append(lane)

    def _new_group(self) -> int:
        self._groups += 1
        return self._groups

    def _key_group(self, table: str, column: str, kind: T.DataType) -> int:
        """The counters of a key column's values; slot 0 is the table that owns the column."""
        known = (table, column, kind.simpleString())
        if known not in self._keys:
            self._keys[known] = group = self._new_group()
            self._add(table, group, 0, _key_text(column, kind))
        return self._keys[known]

    def declare(self, table: str, contract: Contract) -> None:
        checks = _row_checks(contract)
        for start in range(0, len(checks), _BITS):
            group, some = self._new_group(), checks[start : start + _BITS]
            bits = [F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, _, fails) in enumerate(some)]
            mask = reduce(Column.__add__, bits)
            self._add(table, group, 0, F.when(mask != 0, mask.cast("string")))
            self.masks.append(group)
            self.tests += [(group, i, table, column, test) for i, (column, test, _) in enumerate(some)]
        for column in contract.unique:
            group = self._key_group(table, column, self.frames[table].schema[column].dataType)
            self.tests.append((group, 0, table, column, "unique"))
        for column, (parent, pk) in contract.relationships.items():
            sides = [self.frames[parent].select(F.col(pk).alias("k")), self.frames[table].select(F.col(column).alias("k"))]
            kind = reduce(DataFrame.union, sides).schema["k"].dataType
            group = self._key_group(parent, pk, kind)
            slot = self._children[group] = self._children.get(group, 0) + 1
            self._add(table, group, slot, _key_text(column, kind))
            self.tests.append((group, slot, table, column, "relationships"))

    @property
    def slots(self) -> int:
        return 1 + max(self._children.values(), default=0)


def run_tests(frames, contracts: Mapping[str, Contract]) -> DataFrame:
    """Tests of several tables as ``(model, column, test, failures)``; 0 means passed.

    ``frames`` gives a frame by table name, also for parents without a contract
    here. ``failures`` counts rows, except for ``unique``, which counts key
    values that occur more than once. NULLs pass every test but ``not_null``.

    Each table is scanned once. A row that fails checks of single values adds
    one entry for them, keyed by their bit mask, and every row one for each key
    that it owns or refers to. Entries are counted by (key column, value) in
    one shuffle with map-side counts, where a parent's key and all columns that
    refer to it meet: a hot key is one row per task. Only values that fail a
    test are split up by test.
    """
    lanes = _Lanes(frames)
    for name, contract in contracts.items():
        lanes.declare(name, contract)
    if not lanes.tests:
        raise ValueError("no tests given")
    entries = [frames[t].select(F.inline(F.array(*some))).where(F.col("key").isNotNull()) for t, some in lanes.lanes.items()]
    count = [F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(lanes.slots)]
    counted = reduce(DataFrame.union, entries).groupBy("grp", "key").agg(*count)

    result = lambda slot, n: F.struct(slot.cast("int").alias("slot"), n.cast("long").alias("failures"))
    mask = F.col("key").try_cast("bigint")
    bits = F.filter(F.sequence(F.lit(0), F.lit(_BITS - 1)), lambda b: F.getbit(mask, b) == 1)
    of_mask = F.transform(bits, lambda b: result(b, F.col("n0")))
    lost = [F.when(F.col("n0") == 0, F.col(f"n{i}")).otherwise(F.lit(0)) for i in range(1, lanes.slots)]
    of_key = F.array(*[result(F.lit(i), n) for i, n in enumerate([F.col("n0") > 1, *lost])])
    each = F.when(F.col("grp").isin(lanes.masks), of_mask).otherwise(of_key) if lanes.masks else of_key
    suspect = F.col("n0") != 1
    if lanes.masks:
        suspect = suspect | F.col("grp").isin(lanes.masks)
    failed = counted.where(suspect).select("grp", F.inline(each)).where("failures > 0").groupBy("grp", "slot").agg(F.sum("failures").alias("n"))

    labels = ("grp", "slot", "model", "column", "test")
    rows = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(labels, test)]) for test in lanes.tests])
    declared = failed.sparkSession.range(1).select(F.inline(rows))
    return declared.join(failed, ["grp", "slot"], "left").select(
        "model", "column", "test", F.coalesce("n", F.lit(0)).alias("failures")
    )


def table_tests(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    relationships: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Tests of one table as ``(column, test, failures)``; see ``run_tests``.

    A frame that is the parent of several columns is scanned once.
    """
    parents = {f"parent {id(parent)}": parent for parent, _ in (relationships or {}).values()}
    keys = {c: (f"parent {id(parent)}", pk) for c, (parent, pk) in (relationships or {}).items()}
    contract = Contract(not_null, unique, accepted or {}, keys)
    return run_tests({"": df, **parents}, {"": contract}).drop("model")


def assert_no_rows(df: DataFrame, message: str) -> None:
    """Singular assertion: a query that must return nothing."""
    if not df.isEmpty():
        raise AssertionError(message)
