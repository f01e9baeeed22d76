"""Quality rules by line sequence labelling.

A linear-chain conditional random field marks each line of a text as content
or boilerplate; Viterbi decoding gives the best marking of the whole text, and
the share of its words on content lines decides retention. Texts that fail the
base rules are refused whatever the marking says.

The field is fitted on a bounded sample of rows with a quality label. Texts of
both classes are joined for that, so that it sees where content turns into
boilerplate and back. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructType

from .batches import NOT_SPACE, mix, slices, span_hashes, utf8, word_spans

MAX_ROWS = 6_000  # labelled rows the field is fitted on, at most
TRAIN_LINES = 100  # lines a labelled text gives to training, at most
JOINED = 8  # texts in one training sequence, at most
CONTENT_SHARE = 0.5
MIN_WORDS = 50
SEED = 7

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_POINT = np.ones(256, bool)
_POINT[0x80:0xC0] = False  # every byte that begins a code point
_MARKS = {
    "symbol": _SYMBOL,
    "digit": np.isin(np.arange(256), list(range(0x30, 0x3A))),
    "upper": np.isin(np.arange(256), list(range(0x41, 0x5B))),
    "shout": np.arange(256) == ord("!"),
    "link": np.isin(np.arange(256), list(b"/@=_{}[]\\^~`")),
    "stop": np.isin(np.arange(256), list(b".,;:?")),
}
N_FEATURES = 16


class Texts:
    """Word, line and repeat statistics of a slice of texts."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        starts, ends, row = word_spans(body, offsets, NOT_SPACE)
        points = _running(_POINT[body])
        self.n_words = np.bincount(row, minlength=n)
        self.word_chars = np.bincount(row, points[ends] - points[starts], n).astype(np.int64)
        symbols = _running(_SYMBOL[body])
        self.n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]
        words = span_hashes(body, starts, ends)

        # Words in three-word windows that the text holds at least twice.
        inside = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
        window = words[inside] * np.uint64(0x9E3779B97F4A7C15) + words[inside + 1]
        window = mix(window * np.uint64(0xC2B2AE3D27D4EB4F) + words[inside + 2])
        often = inside[_repeated(window, row[inside])]
        covered = np.zeros(len(row) + 1, np.int32)
        np.add.at(covered, often, 1)
        np.add.at(covered, np.minimum(often + 3, len(row)), -1)
        repeat = np.cumsum(covered[:-1]) > 0
        self.n_repeat_words = np.bincount(row, repeat, n).astype(np.int64)

        # Lines: every text has one more than it has line feeds.
        feeds = np.flatnonzero(body == 10)
        owner = np.searchsorted(offsets, feeds, side="right") - 1
        self.line_start = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
        self.line_row = np.sort(np.concatenate([np.arange(n), owner]), kind="stable")
        self.line_end = np.empty_like(self.line_start)
        self.line_end[:-1] = self.line_start[1:]
        if n:
            self.line_end[-1] = len(body)
        more = np.zeros(len(self.line_row), bool)
        more[:-1] = self.line_row[1:] == self.line_row[:-1]
        self.line_end[more] -= 1
        self.lines_of = np.searchsorted(self.line_row, np.arange(n + 1))

        self.first_word = np.searchsorted(starts, self.line_start)
        self.last_word = np.searchsorted(starts, self.line_end)
        self.line_words = self.last_word - self.first_word
        worded = np.flatnonzero(self.line_words)
        key = mix(span_hashes(body, self.line_start[worded], self.line_end[worded]) ^ mix(self.line_row[worded].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(worded), bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        self.dup_line = np.zeros(len(self.line_row), bool)
        self.dup_line[worded[again]] = True
        self.n_dup_lines = np.bincount(self.line_row, self.dup_line, n).astype(np.int64)

        self._features(body, points, words, repeat)

    def _features(self, body, points, words, repeat) -> None:
        a, b, count = self.line_start, self.line_end, np.maximum(self.line_words, 1)
        size = np.maximum(b - a, 1)
        columns = [np.ones(len(a)), np.log1p(self.line_words) / 4]
        for member in _MARKS.values():
            total = _running(member[body])
            columns.append((total[b] - total[a]) / size)
        symbols = _running(_SYMBOL[body])
        columns.append(np.minimum((symbols[b] - symbols[a]) / count, 3))
        bars = _running(body == ord("|"))
        columns.append((bars[b] - bars[a]) / count)
        total = _running(repeat)
        columns.append((total[self.last_word] - total[self.first_word]) / count)
        same = np.zeros(len(words), bool)
        same[1:] = words[1:] == words[:-1]
        total = _running(same)
        columns.append((total[self.last_word] - total[np.minimum(self.first_word + 1, self.last_word)]) / count)
        columns.append((points[b] - points[a]) / count / 10)
        columns.append(self.dup_line.astype(float))
        columns.append((self.line_words == 0).astype(float))
        last = np.where(b > a, body[np.maximum(b - 1, 0)] if len(body) else 0, 0)
        columns.append(np.isin(last, list(b".?!:;")).astype(float))
        self.x = np.stack(columns, axis=1)


def _running(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeated(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which values occur at least twice in their row."""
    key = mix(values ^ mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    ordered = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    out = np.zeros(len(key), bool)
    out[order] = same[1:] | same[:-1]
    return out


class Field:
    """Linear-chain CRF with labels 0 boilerplate and 1 content.

    ``weights`` score a line as content against boilerplate, ``link`` the
    change from one line's label to the next.
    """

    def __init__(self, weights: np.ndarray | None = None, link: np.ndarray | None = None):
        self.weights = np.zeros(N_FEATURES) if weights is None else weights
        self.link = np.zeros((2, 2)) if link is None else link

    def decode(self, x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The best label of each line; texts of like length step together. Ties go to content."""
        score = x @ self.weights
        out = np.ones(len(score), bool)
        lengths = np.diff(cuts)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        if not len(order):
            return out
        first, left = cuts[:-1][order], lengths[order]
        live = np.searchsorted(-left, -np.arange(1, left[0] + 1), side="right")
        # gain: best score ending in content less that ending in boilerplate.
        gain = score[first]
        from_bad, from_good = np.zeros(len(score), bool), np.zeros(len(score), bool)
        t00, t01, t10, t11 = self.link.ravel()
        for t in range(1, int(left[0])):
            k = live[t]
            at, g = first[:k] + t, gain[:k]
            good, bad = np.maximum(g + t11, t01), np.maximum(g + t10, t00)
            from_good[at], from_bad[at] = g + t11 >= t01, g + t10 > t00
            gain[:k] = good - bad + score[at]
        label = gain >= 0
        for t in range(int(left[0]) - 1, -1, -1):
            k = live[t]
            at = first[:k] + t
            ending = left[:k] == t + 1
            own = np.where(ending, gain[:k] >= 0, label[:k])
            out[at] = own
            if t:
                label[:k] = np.where(own, from_good[at], from_bad[at])
        return out

    def fit(self, x: np.ndarray, cuts: np.ndarray, y: np.ndarray, rounds: int = 150, penalty: float = 1e-3) -> None:
        """Gradient ascent on the conditional likelihood; ``y`` is each line's label.

        Features are scaled to like spread first, so that rare marks learn as fast as common ones.
        """
        spread = x.std(axis=0)
        spread[spread < 1e-6] = 1
        x = x / spread
        lengths = np.diff(cuts)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        first, left = cuts[:-1][order], lengths[order]
        live = np.searchsorted(-left, -np.arange(1, left[0] + 1), side="right")
        wanted = x.T @ y
        inner = np.ones(len(y), bool)
        inner[cuts[:-1][lengths > 0]] = False
        now = np.flatnonzero(inner)
        pairs = np.bincount((y[now - 1] * 2 + y[now]).astype(int), minlength=4).reshape(2, 2)
        theta = np.zeros(N_FEATURES + 4)
        moment, square = np.zeros_like(theta), np.zeros_like(theta)
        for turn in range(1, rounds + 1):
            w, link = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
            score = x @ w
            emit = np.stack([np.zeros_like(score), score], axis=1)
            forward, backward = np.zeros_like(emit), np.zeros_like(emit)
            forward[first] = emit[first]
            for t in range(1, int(left[0])):
                at = first[: live[t]] + t
                forward[at] = emit[at] + np.logaddexp(forward[at - 1, :1] + link[0], forward[at - 1, 1:] + link[1])
            for t in range(int(left[0]) - 2, -1, -1):
                at = first[: live[t + 1]] + t
                after = emit[at + 1] + backward[at + 1]
                backward[at] = np.logaddexp(after[:, :1] + link[:, 0], after[:, 1:] + link[:, 1])
            both = forward + backward
            total = np.logaddexp(both[:, 0], both[:, 1])
            p = np.exp(both - total[:, None])
            edge = forward[now - 1][:, :, None] + link + (emit[now] + backward[now])[:, None, :]
            expected = np.exp(edge - total[now][:, None, None]).sum(0)
            slope = np.concatenate([wanted - x.T @ p[:, 1], (pairs - expected).ravel()]) / len(y) - penalty * theta
            moment = 0.9 * moment + 0.1 * slope
            square = 0.99 * square + 0.01 * slope * slope
            theta = theta + 0.15 * moment / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        self.weights, self.link = theta[:N_FEATURES] / spread, theta[N_FEATURES:].reshape(2, 2)


def join_pieces(sizes: np.ndarray, most: int = JOINED) -> np.ndarray:
    """Where training sequences begin and end: they take 1, 2, .. ``most`` pieces in turn.

    Pieces alone show whole texts of one class, joined ones the changes.
    """
    ends = np.cumsum(np.resize(np.arange(1, most + 1), len(sizes)))
    ends = np.append(ends[ends < len(sizes)], len(sizes))
    return np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])]


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str,
    text: str,
    max_rows: int = MAX_ROWS,
    train_lines: int = TRAIN_LINES,
) -> Field:
    """Fit on at most ``max_rows`` rows with a quality label, ``train_lines`` lines of each.

    A line's label is its text's. A text of more lines gives one run of them,
    chosen by its hash, so that no text crowds out others. Texts are joined in
    the order of their hashes. Without rows of both classes the field is even,
    and marks all as content.
    """
    chosen = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
        .limit(max_rows)
    )
    # At most max_rows pairs of numbers are broadcast.
    sample = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")

    def lines(batches):
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets):
                texts = Texts(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                good = np.asarray(batch.column("quality"))[a:b]
                pieces = []
                for k, (c, d) in enumerate(zip(texts.lines_of[:-1].tolist(), texts.lines_of[1:].tolist())):
                    runs = -(-(d - c) // train_lines)
                    e = c + train_lines * (zlib.crc32(body[offsets[a + k] : offsets[a + k + 1]]) % runs)
                    pieces.append(texts.x[e : min(e + train_lines, d)].astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(good, pa.int32()), pa.array(pieces, pa.binary())], names=["y", "x"])

    # Where ids repeat there are more rows than ids; as many as rows are kept, by hash.
    rows = (
        sample.mapInArrow(lines, "y int, x binary").orderBy(F.xxhash64("x"), "y", "x").limit(max_rows).collect()
    )
    field = Field()
    if len({r.y for r in rows}) < 2:
        return field
    parts = [np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in rows]
    sizes = np.array([len(p) for p in parts])
    field.fit(np.concatenate(parts).astype(np.float64), join_pieces(sizes), np.repeat([float(r.y) for r in rows], sizes))
    return field


def rate(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    content_share: float = CONTENT_SHARE,
    max_rows: int = MAX_ROWS,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: (doc struct, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, content_share, kept).

    ``doc`` holds every input column, or those in ``carry``. A null or empty
    text has no words and fails the base rules; a text without words has a
    content share of 0. Repeated rows are rated alike.
    """
    field = train(docs, labels, doc_id, text, max_rows)

    def run(batches):
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets):
                t = Texts(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                content = field.decode(t.x, t.lines_of)
                words = np.bincount(t.line_row, t.line_words * content, b - a)
                share = words / np.maximum(t.n_words, 1)
                failed = (t.n_words < MIN_WORDS) | (100 * t.n_repeat_words > 50 * t.n_words)
                numbers = (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc")[a:b]]
                    + [pa.array(v.astype(np.int64)) for v in numbers]
                    + [pa.array(failed), pa.array(share), pa.array(~failed & (share >= content_share))],
                    names=schema.names,
                )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("doc"), F.col(text).alias("text")
    )
    schema = StructType().add("doc", rows.schema["doc"].dataType)
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        schema = schema.add(name, LongType())
    schema = schema.add("base_failed", BooleanType()).add("content_share", DoubleType()).add("kept", BooleanType())
    return rows.mapInArrow(run, schema)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return rate(docs, labels, carry=["doc_id"]).select("doc.doc_id", "*").drop("doc")
