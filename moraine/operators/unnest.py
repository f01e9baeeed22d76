"""Arrays to rows, sides to rows, and fact unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import path_schema


def unnest_json(
    df: DataFrame,
    json_col: str,
    out: str | Mapping[str, str],
    position: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per element of the JSON array in ``json_col``.

    ``out`` is either a column name, and elements stay JSON text, or
    ``{column: dotted path}``, and those members of each element come out as
    text columns of the same single parse. An empty, missing or NULL array
    gives no rows. ``position`` names an optional zero-based element index.
    ``keep`` limits the carried columns; by default all but the array text.
    """
    carried = [c for c in df.columns if c != json_col] if keep is None else list(keep)
    elements = F.from_json(F.col(json_col), T.ArrayType(element_type(out)))
    if position is None:
        rows = df.select(*carried, F.explode(elements).alias("__element"))
    else:
        rows = df.select(*carried, F.posexplode(elements).alias(position, "__element"))
        carried = [*carried, position]
    return rows.select(*carried, *element_columns("__element", out))


def explode_groups(
    df: DataFrame,
    json_col: str,
    groups: Sequence[tuple[str, Mapping[str, Column]]],
    out: str | Mapping[str, str],
    position: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per element of several JSON arrays of the same document.

    ``groups`` lists ``(dotted path, {discriminator column: value})``. Equal to
    a ``UNION ALL`` with one branch per array, in one pass: the document is
    parsed once and the input is scanned once. A missing array adds no rows.
    ``out``, ``position`` and ``keep`` are as for ``unnest_json``; positions
    run over the groups in the order listed.
    """
    carried = [c for c in df.columns if c != json_col] if keep is None else list(keep)
    schema = path_schema([path for path, _ in groups], T.ArrayType(element_type(out)))
    parsed = df.withColumn("__doc", F.from_json(F.col(json_col), schema))
    arrays = [(F.col(f"__doc.{path}"), tags) for path, tags in groups]
    return explode_arrays(parsed, arrays, out, position, carried)


def explode_arrays(
    df: DataFrame,
    arrays: Sequence[tuple[Column, Mapping[str, Column]]],
    out: str | Mapping[str, str],
    position: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``explode_groups`` for arrays that are parsed already, with elements of
    ``element_type(out)``."""
    kind = T.ArrayType(element_type(out))

    def tagged(array: Column, tags: Mapping[str, Column]) -> Column:
        labels = [value.alias(name) for name, value in tags.items()]
        members = F.coalesce(array, F.array().cast(kind))
        return F.transform(members, lambda e: F.struct(*labels, e.alias("__element")))

    rows = F.flatten(F.array(*[tagged(array, tags) for array, tags in arrays]))
    carried = list(keep)
    if position is None:
        exploded = df.select(*carried, F.explode(rows).alias("__row"))
    else:
        exploded = df.select(*carried, F.posexplode(rows).alias(position, "__row"))
        carried = [*carried, position]
    labels = [F.col(f"__row.{name}").alias(name) for name in arrays[0][1]]
    return exploded.select(*carried, *labels, *element_columns("__row.__element", out))


def element_type(out: str | Mapping[str, str]) -> T.DataType:
    """Text, or a struct that covers the paths of ``{column: dotted path}``."""
    return T.StringType() if isinstance(out, str) else path_schema(out.values())


def element_columns(element: str, out: str | Mapping[str, str]) -> list[Column]:
    """The output columns of one element."""
    if isinstance(out, str):
        return [F.col(element).alias(out)]
    return [F.col(f"{element}.{path}").alias(name) for name, path in out.items()]


def unpivot(df: DataFrame, rows: Sequence[Mapping[str, Column]], keep: Sequence[str] = ()) -> DataFrame:
    """Several output rows per input row, each ``{output name: value}``.

    Home and away sides become two rows with one scan of the input.
    """
    shaped = F.array(*[F.struct(*[v.alias(k) for k, v in row.items()]) for row in rows])
    return df.select(*keep, F.inline(shaped))


def union_facts(*facts: DataFrame) -> DataFrame:
    """``UNION ALL`` by name; a column one fact lacks is a typed NULL there."""
    merged, *rest = facts
    for fact in rest:
        merged = merged.unionByName(fact, allowMissingColumns=True)
    return merged
