"""Small column expressions shared by the models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .json import to_integer


def clock_to_seconds(clock: Column) -> Column:
    """``MM:SS`` text to seconds."""
    minutes = to_integer(F.split_part(clock, F.lit(":"), F.lit(1)))
    seconds = to_integer(F.split_part(clock, F.lit(":"), F.lit(2)))
    return minutes * 60 + seconds


def surrogate_key(*parts: Column) -> Column:
    """Text key ``a_b``; a NULL part counts as empty text."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat_ws("_", *texts)


def digest_bytes(digest: Column | str) -> Column:
    """A SHA-256 in lower-case hex as its 32 bytes, which sort as the text does; other text as UTF-8."""
    text = F.col(digest) if isinstance(digest, str) else digest
    return F.when(text.rlike("^[0-9a-f]{64}$"), F.unhex(text)).otherwise(F.encode(text, "UTF-8"))


def joined_name(first: Column, last: Column) -> Column:
    """``first last``, NULL if either is NULL."""
    return F.concat(first, F.lit(" "), last)


def alias_or_replace(col: Column, aliases: Mapping[str, str], old: str, new: str) -> Column:
    """Mapped value where ``aliases`` has one, else ``old`` replaced by ``new``."""
    otherwise = F.replace(col, F.lit(old), F.lit(new))
    chosen = None
    for value, alias in aliases.items():
        chosen = (chosen or F).when(col == value, F.lit(alias))
    return otherwise if chosen is None else chosen.otherwise(otherwise)


def first_non_null(*cols: Column) -> Column:
    return F.coalesce(*cols)


def winner(home_score: Column, away_score: Column, home: Column, away: Column) -> tuple[Column, Column]:
    """(winning side's value, home-win flag).

    The value is the home side's only on a strictly greater score; equal or
    NULL scores give the away side's. The flag is NULL when a score is.
    """
    home_win = home_score > away_score
    return F.when(home_win, home).otherwise(away), home_win
