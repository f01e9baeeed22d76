"""Line dedup: lines whose normalised key is found in many documents go.

Native DataFrame work only. Lines are exploded as 16-byte digests of their
keys, distinct documents are counted per digest, and frequent digests are
joined back as line positions, so the text itself is moved once, to its own
positions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_DOCS = 10
MIN_CHARS = 1
SALTS = 32  # parts a very common line's places are dealt into
_SPACE = " \t\n\x0b\x0c\r"


def text_lines(text: Column) -> Column:
    """Every line of the whole text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    key = F.btrim(line, F.lit(_SPACE))
    ascii_only = F.octet_length(key) == F.char_length(key)
    return F.when(ascii_only, F.lower(key)).otherwise(
        F.translate(key, string.ascii_uppercase, string.ascii_lowercase)
    )


def _digests(text: Column, min_chars: int) -> Column:
    keys = F.transform(text_lines(text), line_key)
    return F.transform(keys, lambda k: F.when(F.char_length(k) >= min_chars, F.md5(k)))


def frequent_lines(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(digest) of each key found in at least ``min_docs`` rows.

    A row counts once for a key however often it repeats the line, so counts
    combine before the shuffle and a very common line costs one row per task.
    """
    once = F.array_distinct(F.filter(_digests(F.col(text), min_chars), lambda h: h.isNotNull()))
    return (
        docs.select(F.explode(once).alias("h"))
        .groupBy(F.unhex("h").alias("digest"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_docs)
        .select("digest")
    )


def dropped_positions(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """(id, text_hash, positions): sorted places of the lines that go, for documents that lose any."""
    lines = docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(_digests(F.col(text), min_chars)).alias("pos", "h"),
    ).where("h is not null")
    salted = lines.select(
        "id", "text_hash", "pos", F.unhex("h").alias("digest"), F.pmod(F.xxhash64("id", "pos"), F.lit(SALTS)).cast("int").alias("salt")
    )
    frequent = frequent_lines(docs, text, min_docs, min_chars).select(
        "digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    hits = salted.join(frequent, ["digest", "salt"])
    return hits.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("positions"))


def _without(lines: Column, positions: Column) -> Column:
    """The lines between dropped positions, in order; linear in the document."""
    starts = F.concat(F.array(F.lit(0)), F.transform(positions, lambda p: p + 1))
    ends = F.concat(positions, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(lines, s + 1, e - s)))


def line_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """One row per input row: (doc struct, n_lines, n_dropped, kept_text).

    ``doc`` holds every input column, so no name can clash. Each row counts as
    one document, also where ids repeat; a null id is an id like any other.
    Null and empty texts are one empty line; keys under ``min_chars`` code
    points always stay. A document that loses all lines keeps an empty text.
    """
    hits = dropped_positions(docs, doc_id, text, min_docs, min_chars)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(doc_id).alias("own_id"),
        F.xxhash64(text).alias("own_hash"),
    )
    same = rows.own_id.eqNullSafe(hits.id) & (rows.own_hash == hits.text_hash)
    lines = text_lines(F.col("doc").getField(text))
    kept = F.when(F.col("positions").isNull(), F.coalesce(F.col("doc").getField(text), F.lit(""))).otherwise(
        F.array_join(_without(lines, F.col("positions")), "\n")
    )
    return rows.join(hits, same, "left").select(
        "doc",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )


ORACLE = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )
