"""Byte-level BPE encoding and decoding over vectorised pre-tokens.

Pre-tokens are found without a regular expression. Every character becomes a
symbol (its class, with what little must be known of the next characters), and
a small automaton over those symbols says where a pre-token starts. A text is
cut into blocks; each block's transition function, a table from state to
state, is built for all blocks at once, the functions are composed by a
doubling scan, and a second sweep from the known states marks the starts.

Distinct pre-tokens of a slice are merged together, all words in each round,
by the ranks of their neighbouring pairs; results stay in a bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from .batches import PIECE, slices, span_hashes, utf8

# Symbols.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_RUN, SPACE_LAST, BLANK_LAST, END = range(9)
# States: nothing open, inside a run, one blank that opens a run, letters of a contraction to come.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, OPEN, ONE_MORE, TWO_MORE = range(8)
_STATES = 8


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a pre-token) for symbol * 8 + state."""
    to = np.zeros((9, _STATES), np.uint8)
    starts = np.ones((9, _STATES), bool)
    for symbol, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHER)):
        to[symbol] = run
        starts[symbol, [run, OPEN]] = False
    to[LETTER, ONE_MORE], to[LETTER, TWO_MORE] = FREE, ONE_MORE
    starts[LETTER, [ONE_MORE, TWO_MORE]] = False
    for symbol, state in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):
        to[symbol] = state
        to[symbol, [IN_OTHER, OPEN]] = IN_OTHER
        starts[symbol, [IN_OTHER, OPEN]] = False
    to[SPACE_RUN] = IN_SPACE
    starts[SPACE_RUN, IN_SPACE] = False
    to[SPACE_LAST], to[BLANK_LAST], to[END] = FREE, OPEN, FREE
    return to.ravel(), starts.ravel()


_TO, _STARTS = _automaton()
_BLANKS = (0x20, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, *range(0x09, 0x0E), *range(0x2000, 0x200B))
_classes: np.ndarray | None = None


def _class_table() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACE_RUN of every code point."""
    global _classes
    if _classes is None:
        kind = {"L": LETTER, "N": NUMBER}
        category = unicodedata.category
        table = np.fromiter(
            (kind.get(category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1
        )
        table[list(_BLANKS)] = SPACE_RUN
        _classes = table
    return _classes


def _symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of a slice; ``ends`` holds where a separator closes each text."""
    symbols = _class_table()[points]
    symbols[ends] = END
    blank = symbols == SPACE_RUN
    last = np.zeros(len(points), bool)
    last[:-1] = blank[:-1] & ~blank[1:] & (symbols[1:] != END)
    symbols[last] = np.where(points[last] == 0x20, BLANK_LAST, SPACE_LAST)
    at = np.flatnonzero(points == ord("'"))
    if len(at):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        a, b = padded[at + 1], padded[at + 2]
        o = ord
        symbols[at[np.isin(a, [o("s"), o("t"), o("m"), o("d")])]] = SHORT
        two = ((a == o("r")) | (a == o("v"))) & (b == o("e")) | (a == o("l")) & (b == o("l"))
        symbols[at[two]] = LONG
    return symbols


def token_starts(symbols: np.ndarray, block: int = 1024) -> np.ndarray:
    """Whether each character starts a pre-token."""
    n = len(symbols)
    blocks = -(-n // block)
    padded = np.full(blocks * block, END, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(blocks, block).T).astype(np.intp) * _STATES
    # Each block's function, from every state at its start.
    functions = np.tile(np.arange(_STATES, dtype=np.uint8), (blocks, 1))
    for column in columns:
        functions = _TO[column[:, None] + functions]
    # Compose the functions of all blocks before each one.
    before = np.vstack([np.arange(_STATES, dtype=np.uint8), functions[:-1]])
    step = 1
    while step < blocks:
        before[step:] = np.take_along_axis(before[step:], before[:-step].astype(np.intp), axis=1)
        step *= 2
    state = before[:, FREE]
    out = np.empty((block, blocks), bool)
    for i, column in enumerate(columns):
        code = column + state
        out[i] = _STARTS[code]
        state = _TO[code]
    return out.T.ravel()[:n]


def pre_tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, text index) of the pre-tokens of some texts, in order."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    first = token_starts(_symbols(points, ends))
    body = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    # Byte offset of each character, from the bytes that begin one.
    at = np.flatnonzero((body & 0xC0) != 0x80)
    starts = np.flatnonzero(first)
    spans = np.append(at[starts], len(body))
    real = np.ones(len(starts), bool)
    real[np.searchsorted(starts, ends)] = False
    return body, spans[:-1][real], spans[1:][real], np.searchsorted(ends, starts[real], side="right")


class Ranks:
    """A rank file: bytes of every token, and the rank of every pair that may merge."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.sizes = np.array([len(t) for t in self.token], np.int64)
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        left, right, made = [], [], []
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(rank)
        keys = (np.array(left, np.int64) << 20) | np.array(right, np.int64)
        self._table(keys, np.array(made, np.int64))

    def _table(self, keys: np.ndarray, made: np.ndarray, bits: int = 20) -> None:
        """One probe for most pairs; pairs whose slot is taken stay in a sorted rest."""
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.made = np.full(1 << bits, _NONE, np.int64)
        slot = self._slot(keys)
        _, first = np.unique(slot, return_index=True)
        self.keys[slot[first]], self.made[slot[first]] = keys[first], made[first]
        rest = np.setdiff1d(np.arange(len(keys)), first)
        order = rest[np.argsort(keys[rest])]
        self.rest, self.rest_made = keys[order], made[order]
        self.more = np.zeros(1 << bits, bool)
        self.more[slot[rest]] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.intp)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, _NONE where it may not merge."""
        keys = (left << 20) | right
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.made[slot], _NONE)
        again = np.flatnonzero(self.more[slot] & (out == _NONE))
        if len(again):
            at = np.minimum(np.searchsorted(self.rest, keys[again]), len(self.rest) - 1)
            out[again] = np.where(self.rest[at] == keys[again], self.rest_made[at], _NONE)
        return out

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; words of like length are merged together."""
        out: list = [None] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        by_length = np.argsort(lengths, kind="stable")
        first = 0
        while first < len(words):
            width = int(lengths[by_length[first]])
            last = int(np.searchsorted(lengths[by_length], width, side="right"))
            most = max(1, (1 << 21) // max(width, 1))
            for a in range(first, last, most):
                chosen = by_length[a : min(a + most, last)]
                if width <= 64:
                    ids, count = self._merge_wide([words[i] for i in chosen], width)
                    for row, n, i in zip(ids, count, chosen):
                        out[i] = row[:n]
                else:
                    for i in chosen:
                        out[i] = self._merge_long(words[i])
            first = last
        return out

    def _merge_wide(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), width)
        ids = self.byte[raw]
        count = np.full(len(words), width)
        alive = np.arange(len(words))
        rank = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), width - 1)
        while len(alive) and width > 1:
            rows = np.arange(len(alive))
            best = rank.argmin(axis=1)
            low = rank[rows, best]
            going = low < _NONE
            if not going.all():
                alive, rank, best, low = alive[going], rank[going], best[going], low[going]
                rows = np.arange(len(alive))
            if not len(alive):
                break
            # Close the gap to the right of the merged pair, then rate its new neighbours.
            own = ids[alive]
            column = np.arange(width)
            take = np.minimum(column + (column > best[:, None]), width - 1)
            own = np.take_along_axis(own, take, 1)
            own[rows, best] = low
            count[alive] -= 1
            ids[alive] = own
            column = np.arange(width - 1)
            take = np.minimum(column + (column > best[:, None]), width - 2)
            rank = np.take_along_axis(rank, take, 1)
            n = count[alive]
            rank[column >= (n - 1)[:, None]] = _NONE
            for at, ok in ((best - 1, best > 0), (best, best < n - 1)):
                r = rows[ok]
                c = at[ok]
                rank[r, c] = self.pairs(own[r, c], own[r, c + 1])
        return ids, count

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word: a heap of pairs over a linked list."""
        import heapq

        ids = self.byte[np.frombuffer(word, np.uint8)]
        n = len(ids)
        rank = self.pairs(ids[:-1], ids[1:])
        heap = [(int(r), i) for i, r in enumerate(rank) if r < _NONE]
        heapq.heapify(heap)
        ids = ids.tolist()
        ranks = rank.tolist() + [_NONE]
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        table = self._pair_of
        while heap:
            r, i = heapq.heappop(heap)
            if ranks[i] != r:
                continue
            j = after[i]
            ids[i], ids[j] = r, -1
            ranks[j] = -1
            after[i] = after[j]
            if after[j] < n:
                ahead[after[j]] = i
                ranks[i] = table(r, ids[after[j]])
                if ranks[i] < _NONE:
                    heapq.heappush(heap, (ranks[i], i))
            else:
                ranks[i] = _NONE
            if ahead[i] >= 0:
                k = ahead[i]
                ranks[k] = table(ids[k], r)
                if ranks[k] < _NONE:
                    heapq.heappush(heap, (ranks[k], k))
        return np.array([x for x in ids if x >= 0], np.int64)

    def _pair_of(self, a: int, b: int) -> int:
        return self.rank.get(self.token[a] + self.token[b], _NONE)


_NONE = 1 << 40
_loaded: dict[str, Ranks] = {}


def ranks(path: str) -> Ranks:
    """The rank file, read once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = Ranks(path)
    return _loaded[path]


class Encoder:
    """Encodes slices of texts; remembers up to ``keep`` pre-tokens by their hash."""

    def __init__(self, path: str, keep: int = 400_000):
        self.ranks, self.keep, self.known = ranks(path), keep, {}

    def pieces(self, texts: list[str]):
        """(distinct ids arrays, distinct index of each pre-token, text of each, byte starts in the slice)."""
        body, starts, ends, owner = pre_tokens(texts)
        distinct, first, which = np.unique(span_hashes(body, starts, ends), return_index=True, return_inverse=True)
        known, raw = self.known, body.tobytes()
        found = [known.get(h) for h in distinct.tolist()]
        missing = [i for i, ids in enumerate(found) if ids is None]
        words = [raw[a:b] for a, b in zip(starts[first[missing]].tolist(), ends[first[missing]].tolist())]
        if len(known) + len(words) > self.keep:
            known.clear()
        for i, ids in zip(missing, self.ranks.merge(words)):
            found[i] = ids = ids.astype(np.int32)
            if len(known) < self.keep:
                known[int(distinct[i])] = ids
        return found, which, owner, starts

    def arrays(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cuts, ids, offsets): the ids of all texts in a row, where each text's begin,
        and the byte of its text that each id starts at."""
        found, which, owner, _ = self.pieces(texts)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        values = np.concatenate([*found, np.zeros(0, np.int32)])
        size = counts[which]
        stop = np.cumsum(size)
        first = (np.cumsum(counts) - counts)[which]
        ids = values[np.repeat(first - (stop - size), size) + np.arange(size.sum())]
        cuts = np.concatenate([[0], stop])[np.searchsorted(owner, np.arange(len(texts) + 1))]
        ends = np.cumsum(self.ranks.sizes[ids])
        starts = np.concatenate([[0], ends])
        return cuts, ids, starts[:-1] - np.repeat(starts[cuts[:-1]], np.diff(cuts))

    def encode(self, texts: list[str]):
        """For each text (ids, byte offset of each id)."""
        cuts, ids, offsets = self.arrays(texts)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield ids[a:b], offsets[a:b]

    def decode(self, ids) -> bytes:
        token = self.ranks.token
        return b"".join([token[i] for i in ids])


def _text_slices(batch: pa.RecordBatch, column: str):
    """(rows, texts) of a batch, in slices."""
    strings = batch.column(column).cast(pa.large_string())
    _, offsets = utf8(strings)
    for a, b in slices(offsets, PIECE):
        yield slice(a, b), [t or "" for t in strings.slice(a, b - a).to_pylist()]


def encode(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """(doc struct, n_tokens, ids, offsets): token ids of each whole text and the byte each starts at.

    ``doc`` holds every input column, or those in ``carry``. One row per input row, in place; repeated rows repeat. A null or empty
    text has no ids. Special tokens are ordinary text. Texts of any length are
    read whole; a text longer than a slice makes a slice of its own.
    """

    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            for rows, texts in _text_slices(batch, "text"):
                cuts, ids, offsets = encoder.arrays(texts)
                counts, cuts = pa.array(np.diff(cuts)), pa.array(cuts, pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (ids, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc")[rows], counts, *lists], names=schema.names
                )

    chosen = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("doc"), F.col(text).alias("text")
    )
    schema = StructType().add("doc", chosen.schema["doc"].dataType).add("n_tokens", LongType())
    schema = schema.add("ids", ArrayType(IntegerType())).add("offsets", ArrayType(LongType()))
    return chosen.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc struct, bytes) from ``encode``'s rows."""

    def run(batches):
        token = ranks(path).token
        for batch in batches:
            bodies = [b"".join([token[i] for i in ids or ()]) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(bodies, pa.binary())], names=["doc", "bytes"]
            )

    schema = StructType().add("doc", encoded.schema["doc"].dataType).add("bytes", BinaryType())
    return encoded.select("doc", "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_bytes, ids_sha256, decoded_sha256): what ``encode`` and
    ``decode`` give, digested where it is made, so that ids need not be moved."""

    def run(batches):
        encoder = Encoder(path)
        token = encoder.ranks.token
        for batch in batches:
            for rows, texts in _text_slices(batch, "text"):
                found, which, owner, _ = encoder.pieces(texts)
                counts = np.fromiter(map(len, found), np.int64, len(found))
                written = np.array([b",".join([b"%d" % i for i in ids.tolist()]) for ids in found] + [None], object)
                decoded = np.array([b"".join([token[i] for i in ids.tolist()]) for ids in found] + [None], object)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                total = np.concatenate([[0], np.cumsum(counts[which])])
                ids_sha, body_sha, n_bytes = [], [], []
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    own = which[a:b]
                    ids_sha.append(hashlib.sha256(b",".join(written[own].tolist())).hexdigest())
                    body = b"".join(decoded[own].tolist())
                    n_bytes.append(len(body))
                    body_sha.append(hashlib.sha256(body).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[rows],
                        pa.array(total[cuts[1:]] - total[cuts[:-1]], pa.int64()),
                        pa.array(n_bytes, pa.int64()),
                        pa.array(ids_sha, pa.string()),
                        pa.array(body_sha, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "n_bytes", "ids_sha256", "decoded_sha256"],
                )

    chosen = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, n_bytes bigint, ids_sha256 string, decoded_sha256 string"
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary())
