"""Benchmark decontamination by SimHash windows and exact verification.

Each benchmark item has fingerprints of its head and its tail, windows of
about its own size. Every window of that size in every text is fingerprinted
from running sums of word bits. A multi-index over four 16-bit blocks returns
all fingerprints within the Hamming radius (of 7 differing bits one block has
at most one), and each candidate is then verified at full item length by the
exact similarity of weighted five-word shingles.

Edited passages may lie outside the radius, so an exact complement finds the
rest: a passage as similar as asked shares a shingle with any part of the
item's shingles that outweighs what it may lack. The rarest such part is
looked up in every text, and all places of the item around a hit are compared.

The benchmark is the query set: it is read in blocks of bounded size, each
sent to the tasks whole, and all documents pass each block.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from moraine.sources.shared import stored

from .batches import LOWER, NOT_SPACE, PIECE, mix, slices, span_hashes, utf8, word_spans

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 7
BLOCKS = 4
BLOCK_BYTES = 16 << 20  # benchmark text sent to the tasks at once, on average
_CHUNK = 8192
_STEP = 1.3
_COVER = 0.8


def window_size(n: int) -> int:
    """The greatest size of a geometric ladder that is at most 0.8 of ``n``, 1 at least."""
    size = 1
    while (longer := max(size + 1, int(size * _STEP))) <= max(1, _COVER * n):
        size = longer
    return size


def _words(body: np.ndarray, offsets: np.ndarray):
    """(hash, byte length, row) of each word, A-Z lower-cased."""
    lower = LOWER[body]
    starts, ends, row = word_spans(lower, offsets, NOT_SPACE)
    return span_hashes(lower, starts, ends), ends - starts, row


def _prints(words: np.ndarray, size: int, sums: np.ndarray | None = None) -> np.ndarray:
    """Fingerprint of every window of ``size`` words: the sign of each bit's sum."""
    sums = _sums(words) if sums is None else sums
    return np.packbits(sums[size:] > sums[:-size], axis=1).view(np.uint64).ravel()


def _sums(words: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1).view(np.int8) * np.int8(2) - np.int8(1)
    kind = np.int16 if len(words) < 32_000 else np.int32
    out = np.zeros((len(words) + 1, 64), kind)
    np.cumsum(bits, axis=0, dtype=kind, out=out[1:])
    return out


def shingles(words: np.ndarray, lengths: np.ndarray) -> dict[int, int]:
    """Distinct five-word shingles and their weights, the bytes of their words.

    A shorter text is one shingle; a text without words has none.
    """
    n = min(SHINGLE, len(words))
    if not n:
        return {}
    h, w = _rolled(words, lengths, n)
    return dict(zip(h.tolist(), w.tolist()))


def _rolled(words: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight of the ``n`` words from each place on."""
    h = np.zeros(len(words) - n + 1, np.uint64)
    w = np.zeros(len(h), np.int64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(h)]
        w += lengths[k : k + len(h)]
    return mix(h + np.uint64(n)), w


def similarity(a: dict[int, int], b: dict[int, int]) -> float:
    """Weighted Jaccard similarity of two shingle sets."""
    common = sum(w for h, w in a.items() if h in b)
    whole = sum(a.values()) + sum(b.values()) - common
    return common / whole if whole else 0.0


class Index:
    """Items and the multi-index over their windows' fingerprints."""

    def __init__(self, items: list[tuple], least: float = SIMILARITY):
        self.ids, self.sets, self.sizes, self.least = [], [], [], least
        windows: dict[int, list[tuple[int, int, int]]] = {}
        for item_id, text in items:
            body = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
            words, lengths, _ = _words(body, np.array([0, len(body)]))
            if not len(words):
                continue
            k, size = len(self.ids), window_size(len(words))
            self.ids.append(item_id)
            self.sets.append(shingles(words, lengths))
            self.sizes.append(len(words))
            prints = _prints(words, size)
            for at in {0, len(words) - size}:
                windows.setdefault(size, []).append((int(prints[at]), k, at))
        self.windows = {size: self._blocks(rows) for size, rows in windows.items()}
        self.weights = [sum(s.values()) for s in self.sets]
        self.hashes = [np.sort(np.fromiter(s, np.uint64, len(s))) for s in self.sets]
        self.keys = self._keys()

    def _keys(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per shingle length a filter by low bits, and (shingle, item) of each item's rarest shingles.

        They weigh more than a share of 1 - ``least`` of the item: a passage
        without any of them holds less than ``least`` of the item.
        """
        holders = Counter(h for s in self.sets for h in s)
        found: dict[int, list[tuple[int, int]]] = {}
        for k, own in enumerate(self.sets):
            spare = (1 - self.least) * self.weights[k] + 1e-6 * self.weights[k]
            for h in sorted(own, key=lambda h: (holders[h], h)):
                found.setdefault(min(SHINGLE, self.sizes[k]), []).append((h, k))
                spare -= own[h]
                if spare < 0:
                    break
        out = {}
        for n, rows in found.items():
            rows.sort()
            shingle = np.array([h for h, _ in rows], np.uint64)
            low = np.zeros(1 << max(16, (16 * len(rows)).bit_length()), bool)
            low[shingle & np.uint64(len(low) - 1)] = True
            out[n] = low, shingle, np.array([k for _, k in rows])
        return out

    def _places(self, words: np.ndarray, lengths: np.ndarray, row: np.ndarray, cuts: np.ndarray):
        """(text, item, first word, similarity) of the best place around the hits of each item in each text."""
        for n, (low, shingle, item_of) in self.keys.items():
            if len(words) < n:
                continue
            h, w = _rolled(words, lengths, n)
            inside = row[: len(h)] == row[n - 1 :]
            at = np.flatnonzero(low[h & np.uint64(len(low) - 1)] & inside)
            first = np.searchsorted(shingle, h[at], "left")
            count = np.searchsorted(shingle, h[at], "right") - first
            owner = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            item, at = item_of[owner], np.repeat(at, count)
            order = np.lexsort((at, item, row[at]))
            item, at = item[order], at[order]
            if not len(at):
                continue
            reach = np.array(self.sizes)[item] - n
            new = (np.diff(item) != 0) | (np.diff(row[at]) != 0) | (np.diff(at) > reach[1:])
            firsts = np.concatenate([[0], np.flatnonzero(new) + 1])
            lasts = np.append(firsts[1:], len(at)) - 1
            for a, b in zip(firsts.tolist(), lasts.tolist()):
                text, k, reach_k = int(row[at[a]]), int(item[a]), int(reach[a])
                start = max(int(at[a]) - reach_k, int(cuts[text]))
                stop = min(int(at[b]) + reach_k + 1, int(cuts[text + 1]) - n + 1)
                score = self._scores(h[start:stop], w[start:stop], k, reach_k)[: int(at[b]) + 1 - start]
                best = int(score.argmax())
                yield text, k, start + best, float(score[best])

    def _scores(self, h: np.ndarray, w: np.ndarray, item: int, reach: int) -> np.ndarray:
        """Similarity to the item of each window of ``reach`` + 1 shingles, or of those left at the end.

        A shingle counts once in a window: in those that start after its
        previous place and hold its own.
        """
        place = np.arange(len(h))
        order = np.argsort(h, kind="stable")
        since = np.maximum(place - reach, 0)
        again = np.flatnonzero(h[order][1:] == h[order][:-1])
        since[order[again + 1]] = np.maximum(since[order[again + 1]], order[again] + 1)
        own = self.hashes[item]
        shared = own[np.minimum(np.searchsorted(own, h), len(own) - 1)] == h
        whole, common = np.zeros(len(h) + 1, np.int64), np.zeros(len(h) + 1, np.int64)
        for out, weight in ((whole, w), (common, w * shared)):
            np.add.at(out, since, weight)
            np.subtract.at(out, place + 1, weight)
        whole, common = np.cumsum(whole[:-1]), np.cumsum(common[:-1])
        return common / (self.weights[item] + whole - common)

    @staticmethod
    def _blocks(rows):
        """Per block a table from each 16-bit value to the rows within one bit of it."""
        prints = np.array([r[0] for r in rows], np.uint64)
        flips = np.concatenate([[0], 1 << np.arange(16)]).astype(np.uint16)
        tables = []
        for block in prints.view(np.uint16).reshape(-1, BLOCKS).T:
            near = (block[:, None] ^ flips).ravel().astype(np.int64)
            owner = np.repeat(np.arange(len(rows)), len(flips))
            order = np.argsort(near, kind="stable")
            tables.append((np.searchsorted(near[order], np.arange((1 << 16) + 1)), owner[order]))
        return prints, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), tables

    def candidates(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, row) for all pairs of fingerprints at most RADIUS bits apart."""
        own, _, _, tables = self.windows[size]
        windows, rows = [], []
        for block, (cuts, owner) in zip(prints.view(np.uint16).reshape(-1, BLOCKS).T, tables):
            block = np.ascontiguousarray(block).astype(np.intp)
            first = cuts[block]
            count = cuts[block + 1] - first
            hit = np.flatnonzero(count)
            count = count[hit]
            at = np.repeat(first[hit] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            window, row = np.repeat(hit, count), owner[at]
            close = np.bitwise_count(prints[window] ^ own[row]) <= RADIUS
            windows.append(window[close]), rows.append(row[close])
        pairs = np.unique(np.concatenate(windows) * len(own) + np.concatenate(rows))
        return pairs // len(own), pairs % len(own)

    def matches(self, body: np.ndarray, offsets: np.ndarray, least: float) -> list[tuple[int, int, int, float]]:
        """(text, item, first word, similarity): the best place of each item in each text."""
        words, lengths, row = _words(body, offsets)
        cuts = np.searchsorted(row, np.arange(len(offsets)))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        done = set()
        widest = max(self.windows, default=0)
        step = max(_CHUNK, 3 * widest)
        for first in range(0, len(words), step):
            part = words[first : first + step + widest]
            sums = _sums(part)
            for size, (_, item_of, offset_of, _) in self.windows.items():
                if len(part) < size:
                    continue
                prints = _prints(part, size, sums)
                window, found = self.candidates(prints, size)
                window = window + first
                inside = row[window] == row[window + size - 1]
                for at, r in zip(window[inside].tolist(), found[inside].tolist()):
                    text, item = int(row[at]), int(item_of[r])
                    start = max(at - int(offset_of[r]), int(cuts[text]))
                    if (start, item) in done:
                        continue
                    done.add((start, item))
                    stop = min(start + self.sizes[item], int(cuts[text + 1]))
                    score = similarity(shingles(words[start:stop], lengths[start:stop]), self.sets[item])
                    start -= int(cuts[text])
                    if score >= least and (score, -start) > best.get((text, item), (0.0, 0)):
                        best[text, item] = (score, -start)
        for text, item, start, score in self._places(words, lengths, row, cuts):
            start -= int(cuts[text])
            if score >= least and (score, -start) > best.get((text, item), (0.0, 0)):
                best[text, item] = (score, -start)
        return sorted((text, item, -at, score) for (text, item), (score, at) in best.items())


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    """Blocks of distinct (id, text) rows, dealt by hash to hold about ``block_bytes`` each."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    used = sorted(r.block for r in items.select("block").distinct().collect()) or [0]
    for k in used:
        part = items.where(F.col("block") == k).select("item_id", "text")
        yield k == used[-1], sorted(map(tuple, part.collect()), key=lambda r: (r[0] is None, r[0], r[1]))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: float = SIMILARITY,
    carry: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per input row: (doc struct, matches).

    ``doc`` holds every input column, or those in ``carry``; ``matches`` has
    (item_id, start_word, n_words, similarity) for each item found, at its most
    similar place and the first of equal places; texts without a match have an
    empty list. Null and empty texts match nothing, nor do items without
    words; repeated items count once, repeated documents each for themselves.
    An item longer than the text is compared with the whole text.
    """
    id_type = benchmark.schema[item_id].dataType
    match = (
        StructType().add("item_id", id_type).add("start_word", LongType()).add("n_words", LongType()).add("similarity", DoubleType())
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("doc"), F.col(text).alias("text")
    )
    for k, (last, items) in enumerate(item_blocks(benchmark, item_id, item_text, block_bytes)):
        index = Index(items, least)
        if k and k % 8 == 0:
            rows = stored(rows, "decontaminated")  # keeps the plan of many blocks short
        rows = rows.mapInArrow(_scan(index, least, match, last), _schema(rows, match, last))
    return rows


def _schema(rows: DataFrame, match: StructType, last: bool) -> StructType:
    out = StructType().add("doc", rows.schema["doc"].dataType).add("matches", ArrayType(match))
    return out if last else out.add("text", rows.schema["text"].dataType)


def _scan(index: Index, least: float, match: StructType, last: bool):


    kind = to_arrow_type(ArrayType(match))

    def run(batches):
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets, PIECE):
                found: list[list] = [[] for _ in range(b - a)]
                for text, item, start, score in index.matches(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], least):
                    found[text].append(
                        {"item_id": index.ids[item], "start_word": start, "n_words": index.sizes[item], "similarity": score}
                    )
                if "matches" in batch.schema.names:
                    found = [x + y for x, y in zip(batch.column("matches")[a:b].to_pylist(), found)]
                columns = [batch.column("doc")[a:b], pa.array(found, kind)] + ([] if last else [batch.column("text")[a:b]])
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "matches", "text"][: len(columns)])

    return run


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=["doc_id"])
    return found.select("doc.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
