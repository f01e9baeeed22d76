"""Importance resampling of documents towards a target: lines are the unit of work.

Newlines part words, so a text's runs of words fall into those inside a line
and those that cross lines. Distinct lines of the corpus are counted first;
each one's features are hashed once and multiplied by its occurrences, and the
runs that cross lines are added from the texts. Buckets of features in the
corpus and in the target give each bucket a gain, a document's mean gain is its
weight, and seeded Gumbel noise turns the largest scores into a draw without
replacement.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.sources.shared import stored

from .batches import LOWER, slices, utf8
from .ranks import numbered

BUCKETS = 10_000
MAX_RUN = 1  # words in a run, at most
SHARE = (10, 100)  # of the eligible documents are drawn
LEAST_WORDS = 20
SEED = 2024
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
_LOWER = LOWER.tobytes()
_MEMO = 1 << 18  # words or lines a worker remembers before it starts anew


class _Buckets(dict):
    """Bucket of each feature, remembered."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def line_words(line: bytes) -> list[bytes]:
    return _WORD.findall(line.translate(_LOWER))


def runs(words: list[bytes], most: int) -> list[bytes]:
    """All runs of 1 to ``most`` consecutive words, joined by one space."""
    out = list(words)
    for n in range(2, most + 1):
        out += map(b" ".join, zip(*(words[k:] for k in range(n))))
    return out


def crossing(tail: list[bytes], words: list[bytes], most: int) -> list[bytes]:
    """Runs that begin in ``tail`` (the words before the line) and end in the line."""
    out = []
    for n in range(2, most + 1):
        for first in range(max(0, len(tail) - n + 1), len(tail)):
            rest = n - (len(tail) - first)
            if rest <= len(words):
                out.append(b" ".join(tail[first:] + words[:rest]))
    return out


def _tail(tail: list[bytes], words: list[bytes], most: int) -> list[bytes]:
    keep = most - 1
    return (tail + words[-keep:])[-keep:] if keep else []


def _texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, last row, bytes, offsets) of a batch's texts in slices."""
    body, offsets = utf8(batch.column(column))
    for a, b in slices(offsets):
        yield a, b, body[offsets[a] : offsets[b]].tobytes(), offsets[a : b + 1] - offsets[a]


def _sums(counts: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["bucket", "n"])


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, most: int = MAX_RUN) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    A line that many texts repeat costs one row per task in the shuffle, and
    its features are hashed once. Null and empty texts have no features.
    """

    def of_lines(batches):
        counts, bucket = np.zeros(buckets, np.int64), _Buckets(buckets)
        for batch in batches:
            times = np.asarray(batch.column("n"), np.int64)
            for a, b, raw, offsets in _texts(batch, "line"):
                found = [runs(line_words(raw[x:y]), most) for x, y in zip(offsets, offsets[1:])]
                sizes = np.array([len(f) for f in found], np.int64)
                at = np.fromiter(map(bucket.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
                np.add.at(counts, at, np.repeat(times[a:b], sizes))
        yield _sums(counts)

    def over_lines(batches):
        counts, bucket = np.zeros(buckets, np.int64), _Buckets(buckets)
        for batch in batches:
            for _, _, raw, offsets in _texts(batch):
                for x, y in zip(offsets, offsets[1:]):
                    tail: list[bytes] = []
                    for line in raw[x:y].split(b"\n"):
                        words = line_words(line)
                        for feature in crossing(tail, words, most):
                            counts[bucket[feature]] += 1
                        tail = _tail(tail, words, most)
        yield _sums(counts)

    texts = docs.select(F.col(text).alias("text"))
    lines = texts.select(F.explode(F.split("text", "\n", -1)).alias("line")).where("line != ''")
    found = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).mapInArrow(of_lines, "bucket long, n long")
    if most > 1:
        found = found.unionAll(texts.mapInArrow(over_lines, "bucket long, n long"))
    counts = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of a bucket's smoothed share in the target over that in the corpus, floored."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    out = np.zeros(buckets, np.int64)
    for k, (s, t) in enumerate(zip(corpus.tolist(), target.tolist())):
        ratio = float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))
        out[k] = math.floor(1000 * math.log(ratio))
    return out


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", most: int = MAX_RUN, carry: list[str] | None = None) -> DataFrame:
    """(doc, n_words, n_features, weight): the floored mean gain of each row's features.

    ``doc`` holds the columns named in ``carry``, or all. A line met again is
    not hashed again. A row without features weighs 0.
    """
    names = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col(text).alias("text"))
    sent = gain.tolist()

    def run(batches):
        bucket, lines = _Buckets(len(sent)), {}

        def seen(line: bytes):
            words = line_words(line)
            found = runs(words, most)
            return len(found), sum(sent[bucket[f]] for f in found), words[: most - 1], words[-(most - 1) :] if most > 1 else [], len(words)

        for batch in batches:
            n_words, n_features, weight = [], [], []
            for _, _, raw, offsets in _texts(batch):
                for x, y in zip(offsets, offsets[1:]):
                    n = total = w = 0
                    tail: list[bytes] = []
                    for line in raw[x:y].split(b"\n"):
                        known = lines.get(line)
                        if known is None:
                            known = seen(line)
                            if len(line) < 4096:  # longer ones seldom come again
                                if len(lines) >= _MEMO // 8:
                                    lines.clear()
                                lines[line] = known
                        n, total, w = n + known[0], total + known[1], w + known[4]
                        if most > 1:
                            over = crossing(tail, known[2], most)
                            n, total = n + len(over), total + sum(sent[bucket[f]] for f in over)
                            tail = _tail(tail, known[3], most)
                    n_words.append(w)
                    n_features.append(n)
                    weight.append(total // n if n else 0)
            numbers = [pa.array(v, pa.int64()) for v in (n_words, n_features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *numbers], names=["doc", "n_words", "n_features", "weight"])

    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, n_words long, n_features long, weight long"
    return rows.mapInArrow(run, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    most: int = MAX_RUN,
    share: tuple[int, int] = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    carry: list[str] | None = None,
) -> DataFrame:
    """(doc, n_words, n_features, weight, score, rank) of every row; undrawn rows have no rank.

    Of the N rows with ``least_words`` words or more, floor(N * share) are
    drawn: those of the highest scores, ties to the smaller id, then to the
    smaller weight's and text's order, identical rows in any order. A null id
    takes part under the seed alone and comes after all ids of its score. Null
    and empty texts have no features and weight 0. An empty target leaves the
    smoothed shares of the corpus; an empty table gives no rows. Input columns
    travel in ``doc``, so no name can clash.
    """
    gain = gains(bucket_counts(docs, text, buckets, most), bucket_counts(target, target_text, buckets, most))
    names = docs.columns if carry is None else carry
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        F.col(doc_id).alias("own_id"),
        F.xxhash64(text).alias("own_hash"),
        F.col(text).alias("text"),
    )
    rated = weigh(keyed, gain, most=most, carry=["doc", "own_id", "own_hash"]).select("doc.*", "n_words", "n_features", "weight")
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("own_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")
    scored = stored(rated.withColumn("score", F.col("weight") + noise).withColumn("eligible", F.col("n_words") >= least_words), "scored")
    n = scored.where("eligible").count()
    drawn = n * share[0] // share[1]
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("own_id"), F.asc("weight"), F.asc("own_hash")]
    ranked = numbered(scored, order)
    rank = F.when(F.col("nr") <= drawn, F.col("nr"))
    return ranked.select("doc", "n_words", "n_features", "weight", "score", rank.alias("rank"))


# DuckDB has no crc32: its table and the sum over a word's bytes are stated here.
ORACLE = """
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), words AS (
  SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM documents
  UNION ALL
  SELECT 'b', NULL, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))
  FROM benchmark
), distinct_words AS (SELECT DISTINCT word FROM words),
bytes AS (
  SELECT word, list_transform(range(length(hex(word)) // 2),
    lambda i: (instr('0123456789ABCDEF', hex(word)[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', hex(word)[2 * i + 2]) - 1) AS b
  FROM distinct_words
), bucketed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, b::BIGINT[]),
    lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc_table
), features AS (SELECT side, doc_id, bucket FROM words JOIN bucketed USING (word)),
counts AS (
  SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t FROM features GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts
), weights AS (
  SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM features JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features,
    CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
    list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: instr('0123456789abcdef', sha256('2024:' || d.doc_id)[i + 1]) - 1)),
      lambda a, x: a * 16 + x) AS h
  FROM documents d LEFT JOIN weights USING (doc_id)
), noisy AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
    count(*) FILTER (WHERE n_features >= 20) OVER () AS n
  FROM noisy
)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r::BIGINT END AS rank
FROM ranked
"""


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Every document's weight, score and rank against the benchmark's texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return resample(docs, target, carry=["doc_id"]).select("doc.doc_id", "n_features", "weight", "score", "rank")
