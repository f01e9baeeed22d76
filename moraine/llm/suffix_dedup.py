"""Suffix-array dedup: every byte under a 100-byte string that starts earlier goes.

All windows of 100 bytes are dealt to tasks by content. The least 24-byte gram
of a window (by hash) is its anchor; neighbouring windows with one anchor form
a segment, and equal windows always lie in segments of the same anchor. So:

1. Each segment posts its anchor, a digest and its place. Of equal segments all
   but the earliest are duplicates from end to end, which settles copies before
   any text is moved. Copies inside a slice of texts are settled in the slice.
2. Where an anchor has several different segments, their bytes are fetched and
   sent to the anchor's task.
3. The task builds the Burrows-Wheeler transform of its segments and extends
   intervals backwards, breadth first: round after round it derives common
   prefixes of increasing length, and stops at 100. Suffixes not told apart by
   then start equal windows; all but the earliest are duplicates.

An anchor that very many different segments share is dealt out by whole
windows instead, so that no task holds them all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import BYTE, mix, slices, utf8

WINDOW = 100
GRAM = 24
_PER_WINDOW = WINDOW - GRAM + 1
TASK_BYTES = 4 << 20  # text, or text behind the postings, that one task holds, about
HOT_LEAST = 4096  # different segments of an anchor class before it may be dealt out by windows
HOT_KEYS = 1 << 16  # anchor classes dealt out by windows, at most
ANCHOR_CLASSES = 1 << 17  # anchors are counted by so many classes of their hashes
_CLASS = np.uint64(ANCHOR_CLASSES - 1)
_NO_ID = np.iinfo(np.int64).max
_START_BITS, _COUNT_BITS = 40, 8

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _grams(body: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each place."""
    h1 = BYTE[body]
    h2 = h1[:-1] * _C1 + h1[1:]
    h4 = h2[:-2] * _C2 + h2[2:]
    h4 ^= h4 >> np.uint64(29)
    h8 = h4[:-4] * _C3 + h4[4:]
    h16 = h8[:-8] * _C1 + h8[8:]
    h16 ^= h16 >> np.uint64(31)
    return mix(h16[:-8] * _C2 + h8[16:])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


class Segments:
    """Segments of a slice of texts: anchor, digest, text, start and number of windows."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray):
        self.key = self.digest = np.zeros(0, np.uint64)
        self.row = self.start = self.count = np.zeros(0, np.int64)
        n = len(body) - WINDOW + 1
        if n < 1:
            return
        grams = _grams(body)
        place = np.arange(len(grams), dtype=np.uint64)
        anchor = _sliding_least((grams & ~np.uint64((1 << 24) - 1)) | (place & np.uint64((1 << 24) - 1)), _PER_WINDOW)
        size = np.diff(offsets)
        long = np.flatnonzero(size >= WINDOW)
        good = np.zeros(n + 1, np.int8)
        np.add.at(good, offsets[long], 1)
        np.add.at(good, offsets[long] + size[long] - WINDOW + 1, -1)
        good = np.cumsum(good[:-1], dtype=np.int8).astype(bool)
        new = good.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | ~good[:-1]
        new[offsets[long]] = True
        first = np.flatnonzero(new)
        stops = np.flatnonzero(good & ~np.append(good[1:] & ~new[1:], False)) + 1
        self.count = stops - first
        self.row = np.searchsorted(offsets, first, side="right") - 1
        self.start = first - offsets[self.row]
        at = (anchor[first] & np.uint64((1 << 24) - 1)).astype(np.int64)
        # The place is kept modulo 2^24; slices that are longer are cut before.
        self.key = grams[at]
        self.digest = mix(_window(grams, first) * _C1 + _window(grams, stops - 1) + self.count.astype(np.uint64) * _C2)
        self._grams, self._first = grams, first

    def windows(self, chosen: np.ndarray):
        """The chosen segments cut into windows: (segment, start in it, key, digest)."""
        owner = np.repeat(chosen, self.count[chosen])
        within = np.arange(len(owner)) - np.repeat(np.cumsum(self.count[chosen]) - self.count[chosen], self.count[chosen])
        h = _window(self._grams, self._first[owner] + within)
        return owner, within, h, mix(h * _C3 + self._grams[self._first[owner] + within])


def _window(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for k in (0, GRAM, 2 * GRAM, 3 * GRAM, WINDOW - GRAM):
        h = h * _C2 + grams[at + k]
    return mix(h)


def _pieces(body: np.ndarray, offsets: np.ndarray, most: int = 1 << 23):
    """(first row, offset in its text, bytes, offsets): slices; a text longer than ``most``
    is cut into pieces that overlap by a window less one byte."""
    for a, b in slices(offsets):
        size = int(offsets[b] - offsets[a])
        if b - a > 1 or size <= most:
            yield a, 0, body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            continue
        for first in range(0, size - WINDOW + 1, most):
            part = body[offsets[a] + first : min(offsets[a] + first + most + WINDOW - 1, offsets[b])]
            yield a, first, part, np.array([0, len(part)])


def _ids(batch) -> tuple[np.ndarray, np.ndarray]:
    """Order of the texts: (id, a few bits of the text's hash for ids that repeat)."""
    return (np.asarray(batch.column(c), dtype=np.int64) for c in ("id", "tie"))


def _packed(tie: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Tie, start and number of windows in one number that orders like them."""
    return (tie << (_START_BITS + _COUNT_BITS)) | (start << _COUNT_BITS) | count


def _unpacked(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return p >> (_START_BITS + _COUNT_BITS), (p >> _COUNT_BITS) & ((1 << _START_BITS) - 1), p & ((1 << _COUNT_BITS) - 1)


def _earliest(key, digest, ids, place):
    """(order, whether it is the first of its (key, digest)), by key, digest, id and place."""
    order = np.lexsort((place, ids, digest, key))
    k, d = key[order], digest[order]
    first = np.ones(len(order), bool)
    first[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return order, first


def _join_ranges(ids, tie, start, stop):
    """Ranges of each text united: (id, tie, start, stop), sorted."""
    order = np.lexsort((start, tie, ids))
    ids, tie, start, stop = ids[order], tie[order], start[order], stop[order]
    if not len(ids):
        return ids, tie, start, stop
    same = np.zeros(len(ids), bool)
    same[1:] = (ids[1:] == ids[:-1]) & (tie[1:] == tie[:-1])
    # The furthest stop so far in the text: texts are lifted apart, then one running maximum serves all.
    group = np.cumsum(~same) - 1
    lift = group * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift)
    new = np.ones(len(ids), bool)
    new[1:] = ~same[1:] | (start[1:] + lift[1:] > reach[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(ids)) - 1
    return ids[at], tie[at], start[at], reach[last] - lift[at]


_DEALT = "dest int, kind int, data binary"
# Kinds of rows: postings of segments, ranges to remove, segments wanted, segments' bytes.
POSTED, RANGES, WANTED, BYTES = range(4)


def _deal(dest: np.ndarray, kind: int, columns: list[np.ndarray]) -> list[tuple[int, int, bytes]]:
    """Rows of numbers dealt by destination, each packed as one binary."""
    if not len(dest):
        return []
    table = np.stack([c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64) for c in columns])
    order = np.argsort(dest, kind="stable")
    table, dest = table[:, order], dest[order]
    own, first = np.unique(dest, return_index=True)
    return [(int(d), kind, np.ascontiguousarray(t).tobytes()) for d, t in zip(own, np.split(table, first[1:], axis=1))]


def _numbers(blobs: list[bytes], width: int) -> np.ndarray:
    parts = [np.frombuffer(b, np.int64).reshape(width, -1) for b in blobs]
    return np.concatenate(parts, axis=1) if parts else np.zeros((width, 0), np.int64)


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    dest, kind, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(dest, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], names=["dest", "kind", "data"]
    )


def _chunk_of(ids: np.ndarray, tie: np.ndarray, chunks: int) -> np.ndarray:
    """The destination of a text's rows, below zero; texts of one id are spread by their tie."""
    return -1 - (ids % chunks + tie) % chunks


def _range_rows(ids, tie, start, stop, chunks: int):
    """Ranges go to their text's chunk."""
    return _deal(_chunk_of(ids, tie, chunks), RANGES, [ids, tie, start, stop])


def _hot_anchors(docs: DataFrame, n_bytes: int) -> np.ndarray:
    """Which classes of anchors, by their low bits, have postings enough to crowd a task.

    Counted as they are posted, once per slice and content, over all slices. A
    class of more than 1/HOT_KEYS of all segments is dealt out by windows, with
    the few other anchors that fall into it.
    """

    def run(batches):
        count = np.zeros(ANCHOR_CLASSES, np.int64)
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            for _, _, part, cuts in _pieces(body, offsets):
                s = Segments(part, cuts)
                if len(s.key):
                    _, first = np.unique(mix(s.key * _C1 ^ s.digest), return_index=True)
                    count += np.bincount((s.key[first] & _CLASS).astype(np.int64), minlength=ANCHOR_CLASSES)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used])], names=["anchors", "n"])

    counts = docs.select("text").mapInArrow(run, "anchors int, n bigint").groupBy("anchors").agg(F.sum("n").alias("n"))
    # A segment takes about 39 bytes, so fewer than HOT_KEYS classes can have as many.
    least = max(HOT_LEAST, n_bytes // 20 // HOT_KEYS)
    hot = np.zeros(ANCHOR_CLASSES, bool)
    hot[[r.anchors for r in counts.where(F.col("n") > least).select("anchors").collect()]] = True
    return hot


def _post(docs: DataFrame, hot: np.ndarray, buckets: int, chunks: int) -> DataFrame:
    """Postings of the segments of all texts, and ranges settled inside slices."""

    def run(batches):
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            all_ids, all_ties = _ids(batch)
            for first, shift, part, cuts in _pieces(body, offsets):
                s = Segments(part, cuts)
                key, digest, row, start, count = s.key, s.digest, s.row, s.start, s.count
                split = hot[(key & _CLASS).astype(np.int64)]
                if split.any():
                    owner, within, k, d = s.windows(np.flatnonzero(split))
                    keep = ~split
                    key, digest = np.concatenate([key[keep], k]), np.concatenate([digest[keep], d])
                    row = np.concatenate([row[keep], row[owner]])
                    start = np.concatenate([start[keep], start[owner] + within])
                    count = np.concatenate([count[keep], np.ones(len(owner), np.int64)])
                start = start + shift
                ids, tie = all_ids[first + row], all_ties[first + row]
                place = _packed(tie, start, count)
                order, earliest = _earliest(key, digest, ids, place)
                # A text that is in the slice twice has the same places: it is one text.
                again = np.zeros(len(order), bool)
                o = order
                again[1:] = ~earliest[1:] & (ids[o[1:]] == ids[o[:-1]]) & (place[o[1:]] == place[o[:-1]])
                late = o[~earliest & ~again]
                rows = _range_rows(*_join_ranges(ids[late], tie[late], start[late], start[late] + count[late] + WINDOW - 1), chunks)
                o = o[earliest]
                rows += _deal((key[o] % np.uint64(buckets)).astype(np.int64), POSTED, [key[o], digest[o], ids[o], place[o]])
                yield _batch(rows)

    return docs.select("id", "tie", "text").mapInArrow(run, _DEALT)


def _settle(table: pa.Table, buckets: int, chunks: int) -> pa.Table:
    """Ranges of segments that occur earlier; segments wanted where an anchor has several."""
    kinds, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
    dest = table.column("dest")[0].as_py()
    if dest < 0:
        united = _join_ranges(*_numbers(data, 4))
        return pa.Table.from_batches([_batch(_range_rows(*united, chunks))])
    key, digest, ids, place = _numbers(data, 4)
    key, digest = key.view(np.uint64), digest.view(np.uint64)
    order, first = _earliest(key, digest, ids, place)
    key, digest, ids, place = key[order], digest[order], ids[order], place[order]
    # A text given twice posts the same places: they are one occurrence.
    same = np.zeros(len(key), bool)
    same[1:] = ~first[1:] & (ids[1:] == ids[:-1]) & (place[1:] == place[:-1])
    late = ~first & ~same
    tie, start, count = _unpacked(place[late])
    rows = _range_rows(*_join_ranges(ids[late], tie, start, start + count + WINDOW - 1), chunks)
    key, ids, place = key[first], ids[first], place[first]
    shared = np.zeros(len(key) + 1, bool)
    shared[1:-1] = key[1:] == key[:-1]
    shared = shared[1:] | shared[:-1]
    tie, _, _ = _unpacked(place[shared])
    rows += _deal(_chunk_of(ids[shared], tie, chunks), WANTED, [key[shared], ids[shared], place[shared]])
    return pa.Table.from_batches([_batch(rows)])


def _chunk_texts(table: pa.Table):
    """Sorted (id, tie) of a chunk's texts, its bytes and offsets in that order."""
    body, offsets = utf8(table.column("text"))
    ids, tie = (np.asarray(table.column(c), dtype=np.int64) for c in ("id", "tie"))
    order = np.lexsort((tie, ids))
    return body, offsets, ids, tie, order


def _locate(ids, tie, order, want_ids, want_tie) -> np.ndarray:
    """The row of each wanted text."""
    both = np.stack([np.concatenate([ids[order], want_ids]), np.concatenate([tie[order], want_tie])])
    _, group = np.unique(both, axis=1, return_inverse=True)
    group = group.ravel()
    known, asked = group[: len(order)], group[len(order) :]
    return order[np.searchsorted(known, asked)]


def _fetch(texts: pa.Table, dealt: pa.Table, buckets: int, chunks: int) -> pa.Table:
    """The bytes of the wanted segments, for their anchors' tasks; ranges are handed on."""
    kinds, data = dealt.column("kind").to_pylist(), dealt.column("data").to_pylist()
    united = _join_ranges(*_numbers([d for k, d in zip(kinds, data) if k == RANGES], 4))
    rows = _range_rows(*united, chunks)
    key, ids, place = _numbers([d for k, d in zip(kinds, data) if k == WANTED], 3)
    if len(key):
        body, offsets, own, ties, order = _chunk_texts(texts)
        tie, start, count = _unpacked(place)
        row = _locate(own, ties, order, ids, tie)
        first = offsets[row] + start
        bucket = (key.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by])) + 1
        for part in np.split(by, cuts):
            head = np.stack([ids[part], place[part]])
            size = count[part] + WINDOW - 1
            at = np.repeat(first[part] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            rows.append((int(bucket[part[0]]), BYTES, np.array([len(part)]).tobytes() + head.tobytes() + body[at].tobytes()))
    return pa.Table.from_batches([_batch(rows)])


def equal_windows(texts: list[np.ndarray] | np.ndarray, sizes: np.ndarray, length: int = WINDOW):
    """(places, group) of the suffixes whose first ``length`` bytes occur more than once.

    ``texts`` is the texts' bytes in a row, ``sizes`` their lengths. The
    transform is sorted deep enough for ``length``; intervals are then extended
    backwards, breadth first. A round derives all common prefixes of one
    length: it marks the end of each interval not yet ended, and keeps those
    for the next round. Ends not marked after ``length`` rounds separate
    nothing, so what lies between two marks agrees in ``length`` bytes.
    """
    n_texts = len(sizes)
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.zeros(int(sizes.sum()) + n_texts, np.int64)
    real = np.ones(len(symbols), bool)
    real[ends] = False
    symbols[real] = texts.astype(np.int64) + 1  # 0 closes each text
    n = len(symbols)
    # Suffixes by their first symbols, seven at once and then doubling. Suffixes that agree in
    # ``length`` symbols may lie in any order: no interval that is looked at parts them.
    wide = np.concatenate([symbols, np.zeros(8, np.int64)])
    rank = np.zeros(n, np.int64)
    for k in range(7):
        rank = rank * 257 + wide[k : k + n]
    depth = 7
    order = np.argsort(rank)
    while True:
        ordered = rank[order]
        step = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if depth > length or step[-1] == n - 1:
            break
        later = np.concatenate([rank[depth:] + 1, np.zeros(min(depth, n), np.int64)])[:n]
        rank = rank * (n + 1) + later
        order = np.argsort(rank)
        depth *= 2
    # The transform, and where each symbol of it goes one place to the left.
    last = symbols[order - 1]
    back = np.empty(n, np.int64)
    back[np.argsort(last.astype(np.int16), kind="stable")] = np.arange(n)
    marked = np.zeros(n + 1, bool)
    marked[[0, n]] = True
    left, right = np.array([0]), np.array([n])
    for found in range(length):
        width = right - left
        one = width == 1
        single = left[one]
        single = back[single[last[single] > 0]]
        wide_left, wide = left[~one], width[~one]
        at = np.repeat(wide_left - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
        owner = np.repeat(np.arange(len(wide)), wide)
        # No string reaches over the end of a text, though one may begin there.
        keep = (last[at] > 0) | (found == 0)
        at, owner = at[keep], owner[keep]
        # Rows of one interval with one symbol go to neighbouring rows.
        to = back[at]
        by = np.lexsort((to, owner)) if len(to) else np.zeros(0, np.int64)
        to, owner, symbol = to[by], owner[by], last[at[by]]
        new = np.ones(len(to), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(to))[: len(start)] - 1
        new_left = np.concatenate([single, to[start]])
        new_right = np.concatenate([single, to[stop]]) + 1
        if not len(new_left):
            break
        fresh = ~marked[new_right]
        left, right = new_left[fresh], new_right[fresh]
        marked[right] = True
        if not len(left):
            break
    group = np.cumsum(marked[:-1]) - 1
    owner = np.searchsorted(ends, order, side="left")
    long = ends[owner] - order >= length
    order, group, owner = order[long], group[long], owner[long]
    size = np.bincount(group, minlength=1)
    often = size[group] > 1
    order, group, owner = order[often], group[often], owner[often]
    return owner, order - (ends[owner] - sizes[owner]), group


def _transform(table: pa.Table, chunks: int) -> pa.Table:
    """Ranges of windows that segments of one anchor share; other ranges are handed on."""
    data = table.column("data").to_pylist()
    if table.column("dest")[0].as_py() < 0:
        return pa.Table.from_batches([_batch(_range_rows(*_join_ranges(*_numbers(data, 4)), chunks))])
    ids, place, texts = [], [], []
    for blob in data:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        head = np.frombuffer(blob, np.int64, 2 * n, 8).reshape(2, n)
        ids.append(head[0]), place.append(head[1])
        texts.append(np.frombuffer(blob, np.uint8, offset=8 + 16 * n))
    ids, place, texts = np.concatenate(ids), np.concatenate(place), np.concatenate(texts)
    tie, start, count = _unpacked(place)
    owner, at, group = equal_windows(texts, count + WINDOW - 1)
    i, t, s = ids[owner], tie[owner], start[owner] + at
    order = np.lexsort((s, t, i, group))
    late = np.zeros(len(order), bool)
    o = order
    late[1:] = (group[o[1:]] == group[o[:-1]]) & ((i[o[1:]] != i[o[:-1]]) | (t[o[1:]] != t[o[:-1]]) | (s[o[1:]] != s[o[:-1]]))
    # One window may lie in two segments of its text; it is no repeat of itself.
    late = _after_first(group[o], late)
    i, t, s = i[o][late], t[o][late], s[o][late]
    return pa.Table.from_batches([_batch(_range_rows(*_join_ranges(i, t, s, s + WINDOW), chunks))])


def _after_first(group: np.ndarray, differs: np.ndarray) -> np.ndarray:
    """Rows of a group from the first one on that differs from the group's first place."""
    total = np.cumsum(differs)
    first = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    base = np.repeat(total[at], np.diff(np.append(at, len(group))))
    return total > base


def _cut(texts: pa.Table, dealt: pa.Table) -> dict:
    body, offsets, ids, tie, order = _chunk_texts(texts)
    r_ids, r_tie, start, stop = _join_ranges(*_numbers(dealt.column("data").to_pylist(), 4))
    both = np.stack([np.concatenate([ids, r_ids]), np.concatenate([tie, r_tie])])
    _, group = np.unique(both, axis=1, return_inverse=True)
    group = group.ravel()
    of_text, of_range = group[: len(ids)], group[len(ids) :]
    first, last = np.searchsorted(of_range, of_text, side="left"), np.searchsorted(of_range, of_text, side="right")
    raw = body.tobytes()
    n_removed, spans, kept, digest = [], [], [], []
    for k in range(len(ids)):
        a, b = int(offsets[k]), int(offsets[k + 1])
        cuts = list(zip(start[first[k] : last[k]].tolist(), stop[first[k] : last[k]].tolist()))
        at, parts = a, []
        for x, y in cuts:
            parts.append(raw[at : a + x])
            at = a + y
        parts.append(raw[at:b])
        rest = b"".join(parts)
        n_removed.append(b - a - len(rest))
        spans.append(cuts)
        digest.append(hashlib.sha256(rest).hexdigest())
        kept.append(rest)
    return {"n_bytes": np.diff(offsets), "n_removed": n_removed, "spans": spans, "kept": kept, "kept_sha256": digest}


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans[, kept], kept_sha256) for each input row.

    ``spans`` are the removed byte ranges, [start, stop) and maximal; ``kept``
    is what remains, in bytes, as a cut may part a character. Ids are integers.
    Of equal 100-byte strings the one in the text of the least id counts, in
    one text the first; all judged on the input. Null texts are empty. Texts
    that share an id are ordered by a hash of the text; rows that repeat id
    and text are one text and cut alike; null ids come last. An empty table
    gives no rows; texts under 100 bytes keep all.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(int(_NO_ID))).alias("id"),
        F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(1 << 15)).alias("tie"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = 1 + total // TASK_BYTES
    chunks = buckets | 1
    hot = _hot_anchors(rows, total)
    chunk = F.pmod(F.pmod("id", F.lit(chunks)) + F.col("tie"), F.lit(chunks))
    placed = rows.withColumn("chunk", (-1 - chunk).cast("int"))

    def settle(table: pa.Table) -> pa.Table:
        return _settle(table, buckets, chunks)

    def fetch(texts: pa.Table, dealt: pa.Table) -> pa.Table:
        return _fetch(texts, dealt, buckets, chunks)

    def transform(table: pa.Table) -> pa.Table:
        return _transform(table, chunks)

    types = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
    types += [("kept", pa.binary())] * with_bytes + [("kept_sha256", pa.string())]

    def cut(texts: pa.Table, dealt: pa.Table) -> pa.Table:
        if not len(texts):
            return pa.table({n: pa.array([], t) for n, t in types})
        out = _cut(texts, dealt)
        out["doc_id"] = texts.column("doc_id").combine_chunks()
        out["spans"] = [[{"start": a, "stop": b} for a, b in s] for s in out["spans"]]
        return pa.table({n: out[n] if n == "doc_id" else pa.array(out[n], t) for n, t in types})

    settled = _post(rows, hot, buckets, chunks).groupBy("dest").applyInArrow(settle, _DEALT)
    fetched = placed.groupBy("chunk").cogroup(settled.groupBy("dest")).applyInArrow(fetch, _DEALT)
    ranges = fetched.groupBy("dest").applyInArrow(transform, _DEALT)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,stop:bigint>>, "
    schema += "kept binary, kept_sha256 string" if with_bytes else "kept_sha256 string"
    return placed.groupBy("chunk").cogroup(ranges.groupBy("dest")).applyInArrow(cut, schema)


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    found = suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_bytes=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
