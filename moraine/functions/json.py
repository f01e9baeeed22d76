"""Typed reads from JSON text held in a string column.

The rule throughout is *one parse per document*: every scalar a caller asks for
is pulled by a single ``from_json`` with an all-text schema, and casts happen
afterwards on the small extracted texts. Casting late also means that a row
which a later step drops can never fail a cast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wide enough for any 64-bit integer plus a fraction to round away.
_ROUNDING = "decimal(38,10)"


def to_integer(text: Column, kind: str = "int", strict: bool = True) -> Column:
    """Integer from text; a fraction is rounded half away from zero.

    Spark's own cast refuses ``'12.7'``. ``strict`` text that is no number
    raises, otherwise it gives NULL.
    """
    rounded = text.cast(_ROUNDING) if strict else text.try_cast(_ROUNDING)
    rounded = F.round(rounded, 0)
    wide = rounded.cast(kind) if strict else rounded.try_cast(kind)
    return F.coalesce(text.try_cast(kind), wide)


def cast_text(text: Column, kind: str, strict: bool = True) -> Column:
    """Cast extracted JSON text to ``kind`` (a Spark type name)."""
    if kind == "string":
        return text
    if kind in ("int", "bigint"):
        return to_integer(text, kind, strict)
    if kind == "date" and strict:
        return F.to_date(text, "yyyy-MM-dd")
    return text.cast(kind) if strict else text.try_cast(kind)


def path_schema(
    paths: Iterable[str], leaf: T.DataType | None = None, types: Mapping[str, T.DataType] | None = None
) -> T.StructType:
    """Nested schema whose leaves sit at the dotted ``paths``.

    Leaves are text, or ``leaf``, or what ``types`` says for a path. A path may
    not run through another path's leaf.
    """
    given = types or {}
    tree: dict = {}
    for path in dict.fromkeys(paths):
        *parents, last = path.split(".")
        node = tree
        for name in parents:
            node = node.setdefault(name, {})
            if not isinstance(node, dict):
                raise ValueError(f"{path!r} runs through a leaf")
        if last in node:
            raise ValueError(f"{path!r} is also a parent")
        node[last] = given.get(path) or leaf or T.StringType()

    def build(node: dict | T.DataType) -> T.DataType:
        if not isinstance(node, dict):
            return node
        return T.StructType([T.StructField(k, build(v)) for k, v in node.items()])

    return build(tree)


def json_texts(
    df: DataFrame,
    json_col: str,
    paths: Mapping[str, str],
    keep: Iterable[str] = (),
    types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Pull ``{output name: dotted path}`` as text columns with one parse.

    ``keep`` names the input columns to carry along. A missing path and a JSON
    null both give NULL. ``types`` names outputs that the same parse should
    give as another type, such as an array of structs.
    """
    kinds = {paths[name]: kind for name, kind in (types or {}).items()}
    schema = path_schema(paths.values(), types=kinds)
    # explode() keeps the parse in one place: filters on the extracted columns
    # stay above it, so Catalyst cannot copy the parse into a pushed-down filter.
    body = F.explode(F.array(F.from_json(F.col(json_col), schema))).alias("__parsed")
    carried = [F.col(c) for c in keep]
    return df.select(*carried, body).select(
        *carried, *[F.col(f"__parsed.{path}").alias(name) for name, path in paths.items()]
    )


def json_fields(
    df: DataFrame,
    json_col: str,
    fields: Mapping[str, tuple[str, str, bool]],
    keep: Iterable[str] = (),
) -> DataFrame:
    """Typed extraction: ``{output name: (dotted path, type, strict)}``."""
    keep = list(keep)
    texts = json_texts(df, json_col, {name: spec[0] for name, spec in fields.items()}, keep)
    return texts.select(
        *keep,
        *[cast_text(F.col(name), kind, strict).alias(name) for name, (_, kind, strict) in fields.items()],
    )


def json_text(col: Column | str, path: str) -> Column:
    """Subtree at ``path`` as compact JSON text, keys in source order."""
    return F.get_json_object(col, "$" if not path else f"$.{path}")


def json_len(col: Column | str, path: str = "") -> Column:
    """Length of the JSON array at ``path``: 0 for another kind, NULL if absent."""
    found = json_text(col, path) if path else (F.col(col) if isinstance(col, str) else col)
    other = F.when(found.isNotNull(), F.lit(0))
    return F.coalesce(F.json_array_length(found), other).cast("bigint")


def json_object(**values: Column) -> Column:
    """JSON object text with the given keys in order; NULLs stay as JSON null."""
    return F.to_json(
        F.struct(*[v.alias(k) for k, v in values.items()]), {"ignoreNullFields": "false"}
    )


def canonical_json(**values: Column) -> Column:
    """JSON object text with sorted keys and ``", "`` / ``": "`` separators.

    Equal parameters always give equal bytes.
    """
    parts: list[Column] = []
    for name in sorted(values):
        packed = F.to_json(F.array(values[name]), {"ignoreNullFields": "false"})
        value = F.substring(packed, F.lit(2), F.length(packed) - 2)  # without the brackets
        parts.append(F.concat(F.lit(f'"{name}": '), value))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
