"""Substring dedup: words under a long window that starts in an earlier document go.

A window of 50 words is an edge of a De Bruijn graph of words, from its first
49 words to its last 49. Neighbouring windows whose least 10-word gram (by
hash) is the same one, their anchor, travel as one chain, so the shuffle sees a
chain for each 21 windows or so; equal windows always have equal anchors.

1. Anchors found in one document only are dropped: nothing there repeats.
2. Chains are reduced to distinct ones. Where an anchor has a single chain, all
   of it repeats. A join of each such chain to the one before it in its source
   document compacts the nonbranching paths: a link holds if all occurrences of
   either chain have the other one as their neighbour, so a path has the same
   occurrences from end to end and only its first chain is looked up again.
3. Where an anchor has several chains, the paths branch. The windows of the
   distinct chains are read at their source coordinates, and equal ones share
   the least document.
4. Every occurrence of a path or chain is compared with its source, by a digest
   of the words between the coordinates, before anything is cut.

An anchor of very many chains is dealt out over salts wherever its chains meet.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.sources.shared import shared_folder, stored

from .batches import mix, slices, utf8

WINDOW = 50
PIECE = 1 << 20  # words of a text that are held at once; longer texts are cut into pieces that overlap
_NO_ID = np.iinfo(np.int64).max
_MEMO = 1 << 20
HOT_LEAST = 4096  # chains of an anchor before it may be dealt out over salts
HOT_KEYS = 1 << 16  # anchors dealt out over salts, at most: those with more than 1/HOT_KEYS of all chains
SALTS = 64
BUCKET_BYTES = 64 << 20  # of text in one bucket of the texts, about
_PLACE = np.uint64((1 << 22) - 1)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    """A 64-bit hash of each word, remembered."""

    def __init__(self, seed: int):
        self.key = seed.to_bytes(8, "little")

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=self.key).digest(), "little")
        return found


def rolled(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` values from each place on; every doubling is mixed, so no sum can be undone."""
    out, covered, power, span = None, 0, values, 1
    n = len(values) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    while True:
        if length & span:
            out = power[:n].copy() if out is None else mix(out * _C1 + power[covered : covered + n])
            covered += span
        if covered == length:
            return out
        power = mix(power[:-span] * _C2 + power[span:])
        span *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def chains(hashes: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
    """(text, start, windows, anchor, digest, digest before, digest after) of the chains of some texts.

    ``hashes`` are the texts' words in a row, ``offsets`` where each begins.
    The digests of neighbours are 30 bits wide, 0 where there is none.
    """
    none = np.zeros(0, np.int64)
    n = len(hashes) - window + 1
    size = np.diff(offsets)
    long = np.flatnonzero(size >= window)
    if n < 1 or not len(long):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none, none
    gram = max(1, window // 5)
    grams = rolled(hashes, gram)
    # The place settles ties: the first of equal grams is the anchor.
    place = np.arange(len(grams), dtype=np.uint64)
    anchor = _least((grams & ~_PLACE) | place, window - gram + 1)
    good = np.zeros(n + 1, np.int64)
    np.add.at(good, offsets[long], 1)
    np.add.at(good, offsets[long] + size[long] - window + 1, -1)
    good = np.cumsum(good[:-1]).astype(bool)
    new = good.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~good[:-1]
    new[offsets[long]] = True
    first = np.flatnonzero(new)
    stop = np.flatnonzero(good & ~np.append(good[1:] & ~new[1:], False)) + 1
    count = stop - first
    row = np.searchsorted(offsets, first, side="right") - 1
    whole = rolled(hashes, window)
    digest = mix(whole[first] * _C1 + whole[stop - 1] + count.astype(np.uint64) * _C2)
    short = (digest >> np.uint64(34)).astype(np.int64) + 1
    same = np.append(row[1:] == row[:-1], False)
    after = np.where(same, np.append(short[1:], 0), 0)
    before = np.where(np.append(False, same[:-1]), np.append(0, short[:-1]), 0)
    key = grams[(anchor[first] & _PLACE).astype(np.int64)]
    return row, first - offsets[row], count, key, digest, before, after


def _short(digest: str):
    """The 30-bit form of a digest as neighbours carry it."""
    return F.shiftrightunsigned(digest, 34) + 1


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(row, words) of a batch's texts: [^\\x20\\x09-\\x0D]+, which is what bytes.split() leaves."""
    body, offsets = utf8(batch.column("text"))
    for row in range(len(offsets) - 1):
        yield row, body[offsets[row] : offsets[row + 1]].tobytes().split()


def _pieces(batch: pa.RecordBatch, window: int):
    """(rows, first word, words, offsets): texts in slices; a long one in pieces that share a window less a word."""
    _, offsets = utf8(batch.column("text"))
    texts = _texts(batch)
    for a, b in slices(offsets):
        held = [next(texts)[1] for _ in range(a, b)]
        if b - a == 1 and len(held[0]) > PIECE + window:
            for first in range(0, len(held[0]) - window + 1, PIECE):
                part = held[0][first : first + PIECE + window - 1]
                yield np.array([a]), first, part, np.array([0, len(part)])
            continue
        sizes = np.array([len(h) for h in held], np.int64)
        yield np.arange(a, b), 0, [w for h in held for w in h], np.append(0, np.cumsum(sizes))


# ``place`` is the start above 16 bits of the count; ``beside`` the digest before above the one after.
_CHAIN = "anchor long, digest long, id long, tie long, place long, beside long"


def _chain_rows(rows: DataFrame, window: int, seed: int) -> DataFrame:
    def run(batches):
        known = _Hashes(seed)
        for batch in batches:
            ids, ties = (np.asarray(batch.column(c), dtype=np.int64) for c in ("id", "tie"))
            for own, shift, words, offsets in _pieces(batch, window):
                hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                row, start, count, anchor, digest, before, after = chains(hashes, offsets, window)
                at = own[row]
                place, beside = ((start + shift) << 16) | count, (before << 32) | after
                columns = [anchor.view(np.int64), digest.view(np.int64), ids[at], ties[at], place, beside]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["anchor", "digest", "id", "tie", "place", "beside"]
                )

    return rows.select("id", "tie", "text").mapInArrow(run, _CHAIN)


def _span_digest(words: list[bytes]) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)


def _read_sources(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(id, anchor, digest, off, key): digests of words at source coordinates. ``off`` is -1 for all of a
    path or chain, else one of a chain's windows."""

    def run(batches):
        for batch in batches:
            asked, ids = batch.column("asked").to_pylist(), batch.column("id").to_pylist()
            out: list[tuple] = []
            for row, words in _texts(batch):
                for want in asked[row]:
                    key, start, n = (ids[row], want["anchor"], want["digest"]), want["start"], want["n"]
                    out.append((*key, -1, _span_digest(words[start : start + n + window - 1])))
                    if not want["whole"]:
                        out += [(*key, k, _span_digest(words[start + k : start + k + window])) for k in range(n)]
            columns = zip(*out) if out else ((),) * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ["id", "anchor", "digest", "off", "key"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    asked = wanted.groupBy("id", "tie").agg(F.collect_list(F.struct("whole", "anchor", "digest", "start", "n")).alias("asked"))
    found = texts.join(asked, ["id", "tie"]).select("id", "text", "asked")
    return found.mapInArrow(run, "id long, anchor long, digest long, off int, key long")


def _paths(settled: DataFrame) -> DataFrame:
    """(anchor, digest, id, tie, start, n): the first chain of each nonbranching path, its source and windows."""
    only = settled.select(
        "anchor",
        "digest",
        "id",
        "tie",
        "start",
        "count",
        F.when(F.col("before_lo") == F.col("before_hi"), F.col("before_lo")).alias("before"),
        F.when(F.col("after_lo") == F.col("after_hi"), F.col("after_lo")).alias("after"),
    )
    earlier = only.select(
        "id", "tie", (F.col("start") + F.col("count")).alias("start"), F.col("after").alias("leads_to"), _short("digest").alias("came_from")
    )
    linked = (F.col("leads_to") == _short("digest")) & (F.col("before") == F.col("came_from"))
    joined = only.join(earlier, ["id", "tie", "start"], "left").withColumn("head", F.when(linked, 0).otherwise(1))
    # A path lies in one piece in its source, so its chains follow its head there.
    numbered = joined.selectExpr("*", "sum(head) OVER (PARTITION BY id, tie ORDER BY start) AS path")
    ends = numbered.groupBy("id", "tie", "path").agg(F.sum("count").alias("n"))
    return numbered.where("head = 1").join(ends, ["id", "tie", "path"]).select("anchor", "digest", "id", "tie", "start", "n")


def repeated_spans(texts: DataFrame, window: int = WINDOW, seed: int = 0) -> DataFrame:
    """(id, tie, start, n, first, last, key): the windows from ``start`` + ``first`` to ``start`` + ``last``
    repeat a text of a smaller id, if the words of the n windows from ``start`` on have the digest ``key``.

    ``texts`` have columns id, tie and text. Windows between two of one chain
    are covered by these.
    """
    found = stored(_chain_rows(texts, window, seed), "chains")
    anchors = found.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
    anchors = stored(anchors.where("lo < hi").select("anchor", "n"), "anchors")
    least_hot = max(HOT_LEAST, found.count() // HOT_KEYS)
    # At most HOT_KEYS rows.
    hot = F.broadcast(anchors.where(F.col("n") > least_hot).select("anchor", F.lit(True).alias("hot")))
    own_salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "place"), F.lit(SALTS)).cast("int")).otherwise(0)
    all_salts = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))

    def salted(df: DataFrame) -> DataFrame:
        """A row for each salt of the row's anchor."""
        return df.join(hot, "anchor", "left").withColumn("salt", all_salts).drop("hot")

    shared = found.join(hot, "anchor", "left").withColumn("salt", own_salt).drop("hot")
    shared = stored(shared.join(salted(anchors.select("anchor")), ["anchor", "salt"], "left_semi"), "shared")
    start, count = F.shiftright("place", 16), F.col("place").bitwiseAND(0xFFFF)
    before, after = F.shiftright("beside", 32), F.col("beside").bitwiseAND(0xFFFFFFFF)
    distinct = shared.groupBy("anchor", "digest").agg(
        F.min(F.struct("id", "tie", "place")).alias("source"),
        F.min(before).alias("before_lo"),
        F.max(before).alias("before_hi"),
        F.min(after).alias("after_lo"),
        F.max(after).alias("after_hi"),
    )
    distinct = distinct.select("*", "source.*").drop("source").withColumns({"start": start, "count": count}).drop("place")
    distinct = stored(distinct, "distinct")
    branching = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    paths = stored(_paths(distinct.join(branching, "anchor", "left_anti")), "paths")
    several = distinct.join(branching, "anchor", "left_semi").select("anchor", "digest", "id", "tie", "start", F.col("count").alias("n"))
    several = stored(several, "several")

    wanted = paths.withColumn("whole", F.lit(True)).unionByName(several.withColumn("whole", F.lit(False)))
    read = stored(_read_sources(texts, wanted, window), "read")
    # A text that is there several times gives the same digests.
    key = read.where("off < 0").groupBy("anchor", "digest").agg(F.min("key").alias("key"))
    whole = paths.select("anchor", "digest", F.col("id").alias("lo"), "n").join(key, ["anchor", "digest"])

    # ``id`` is the least of all texts that hold the chain.
    windows = read.where("off >= 0").select("anchor", "digest", "off", F.col("key").alias("at"), "id")
    least = windows.groupBy("anchor", "at").agg(F.min("id").alias("least"))
    least = windows.select("anchor", "digest", "off", "at").join(least, ["anchor", "at"])
    least = least.groupBy("anchor", "digest").agg(F.collect_set(F.struct("off", "least")).alias("least"))
    chain = several.select("anchor", "digest", "n").join(key, ["anchor", "digest"]).join(least, ["anchor", "digest"])

    place = shared.select("anchor", "digest", "salt", "id", "tie", start.alias("start"))
    by_path = place.join(salted(whole), ["anchor", "digest", "salt"]).where("id > lo")
    by_path = by_path.select("id", "tie", "start", "n", F.lit(0).alias("first"), (F.col("n") - 1).alias("last"), "key")
    offs = F.transform(F.filter("least", lambda w: w["least"] < F.col("id")), lambda w: w["off"])
    by_window = place.join(salted(chain), ["anchor", "digest", "salt"]).withColumn("offs", offs).where(F.size("offs") > 0)
    by_window = by_window.select("id", "tie", "start", "n", F.array_min("offs").alias("first"), F.array_max("offs").cast("long").alias("last"), "key")
    return by_path.unionByName(by_window)


def _bucketed(rows: DataFrame):
    """(texts by doc_id, id, tie, text; what takes their name away): written in buckets of (id, tie).

    The texts move once; the joins that read them in place and cut them move
    the other side alone. ``tie`` tells texts of one id apart and is 0 where
    no id repeats.
    """
    spark = rows.sparkSession
    repeated = rows.groupBy("doc_id").count().where("count > 1").limit(1).count()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + total // BUCKET_BYTES)
    keyed = rows.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(int(_NO_ID))).alias("id"),
        (F.xxhash64("text") if repeated else F.lit(0).cast("long")).alias("tie"),
        "text",
    )
    name = f"moraine_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/moraine/{name}"
    written = keyed.repartition(n, "id", "tie").write.bucketBy(n, "id", "tie").option("compression", "zstd")
    written.option("path", path).saveAsTable(name)
    return spark.table(name), lambda: spark.sql(f"DROP TABLE IF EXISTS {name}")


_OUT = [
    ("n_words", pa.int64()),
    ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ("kept", pa.string()),
    ("kept_sha256", pa.string()),
    ("differing", pa.int64()),
]


def _cut(words: list[bytes], ranges: list[dict] | None, window: int) -> tuple:
    gone = np.zeros(len(words) + 1, np.int64)
    differing = 0
    for r in ranges or ():
        start = r["start"]
        if _span_digest(words[start : start + r["n"] + window - 1]) != r["key"]:
            differing += 1
            continue
        gone[start + r["first"]] += 1
        gone[start + r["last"] + window] -= 1
    held = np.cumsum(gone[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], held.astype(np.int8), [0]])))
    spans = edges.reshape(-1, 2).tolist()
    kept, at = [], 0
    for a, b in spans:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), int(held.sum()), [{"start": a, "stop": b} for a, b in spans], b" ".join(kept), differing


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, spans[, kept], kept_sha256) for each input row.

    ``spans`` are the removed words, [start, stop) and maximal; ``kept`` are
    the other words, joined by one space. Of equal windows those in texts of
    the least id stay, so a text never loses a window to itself or to a text
    of the same id; all judged on the input. Ids are integers; texts without an
    id come after all others. Null and empty texts have no words; texts under
    ``window`` words keep all; identical rows are cut alike. An empty table
    gives no rows. Other columns are not read.
    """
    texts, drop = _bucketed(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    types = [t for t in _OUT if with_text or t[0] != "kept"]
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, "
    schema += "kept string, " * with_text + "kept_sha256 string, differing long"

    def run(batches):
        for batch in batches:
            ranges = batch.column("ranges").to_pylist()
            out: dict[str, list] = {n: [] for n, _ in _OUT}
            for row, words in _texts(batch):
                n_words, n_removed, spans, kept, differing = _cut(words, ranges[row], window)
                body = kept.decode() if with_text else None
                for name, value in zip(out, (n_words, n_removed, spans, body, hashlib.sha256(kept).hexdigest(), differing)):
                    out[name].append(value)
            arrays = [pa.array(out[n], t) for n, t in types]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *arrays], names=["doc_id", *(n for n, _ in types)])

    for seed in range(8):
        spans = repeated_spans(texts.select("id", "tie", "text"), window, seed)
        # A set, since identical rows post the same spans.
        spans = spans.groupBy("id", "tie").agg(F.collect_set(F.struct("start", "n", "first", "last", "key")).alias("ranges"))
        cut = texts.join(spans, ["id", "tie"], "left").select("doc_id", "text", "ranges").mapInArrow(run, schema)
        cut = stored(cut, "cut")
        # Words that differ under equal hashes: other hashes are taken.
        if not cut.where("differing > 0").limit(1).count():
            drop()
            return cut.drop("differing")
    raise RuntimeError("eight hash functions gave equal hashes to different words")


ORACLE = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 49), ' ')) AS h FROM words, unnest(range(1, len(w) - 48)) AS ps(p)
), least AS (SELECT h, min(doc_id) AS lo FROM windows GROUP BY h),
late AS (SELECT doc_id, p FROM windows JOIN least USING (h) WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, p + k AS pos FROM late, unnest(range(50)) AS ks(k)),
each_word AS (SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM words),
marked AS (SELECT e.*, g.pos IS NOT NULL AS removed FROM each_word e LEFT JOIN gone g USING (doc_id, pos)),
cut AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT removed), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN cut USING (doc_id)
"""


def op11_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's words and how many of them repeat an earlier document."""
    found = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")
