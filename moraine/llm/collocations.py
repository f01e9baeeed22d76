"""Phrase collocations: double-array tries of candidates walked over all positions at once.

Words of at least the least count get numbers, and the texts are written as
runs of numbers, parted where a piece ends or a rarer word stands. Level by
level, from two words up:

1. Candidates are the extensions seen in the texts whose two parts, without
   the last and without the first word, are accepted phrases of the level
   below, and that are seen often enough: no frequent phrase is missing.
2. They are built into double-array tries of bounded size and broadcast. A task
   moves the states of all its positions one digit of a word's number further at
   a time, counts the accepting states with one bincount, and the tasks' counts
   are summed.
   The same walk gives the extensions that the next level's candidates are
   taken from.

A phrase's cuts, the phrases it lies in, and the ranking are joins and
aggregations of the counted phrases.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moraine.sources.shared import stored

from .batches import mix, slices, utf8
from .ranks import numbered

LEAST = 30  # occurrences of a phrase
LONGEST = 4  # words of a phrase
TOP = 2000  # phrases reported for each language
COVERED = (80, 100)  # share of a phrase inside a longer one from which it is dropped
VOCABULARY = 1 << 20  # words of one broadcast vocabulary; more words take more passes
TRIE = 1 << 19  # phrases of one broadcast trie; more phrases take more passes
DIGIT = 6  # bits of a word's number that one step in a trie takes
WIDE = 8  # children of a state from which its cells are not shared out at random
ROUNDS = 16  # random places tried for the children of a state
SLICE = 1 << 20  # bytes of text numbered at once, about
ROW = 1 << 9  # numbers in one row, about; rows end where a piece does
HELD = 2 << 20  # bytes of numbers walked at once, about
SUMS = 1 << 20  # keys that a task sums before it sends them on
SENT = 1 << 17  # keys packed at once; several times as much memory

# Ends of pieces become full stops, which no word holds; tabs part words like spaces.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_SIGNS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _BREAKS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(_BREAKS))
_KEY = ["w1", "w2", "w3", "w4"]
_DEALT = "bucket int, data binary"
BUCKET = 1 << 24  # bytes of counts that one task sums, at most about


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """(language, normalised text) of a batch: the texts of one language, a full stop between two."""
    body, offsets = utf8(batch.column("text"))
    by: dict[str, list[int]] = {}
    for row, lang in enumerate(batch.column("lang").to_pylist()):
        by.setdefault(lang, []).append(row)
    for lang, rows in by.items():
        held, size = [], 0
        for row in rows:
            held.append(body[offsets[row] : offsets[row + 1]].tobytes())
            size += len(held[-1])
            if size >= SLICE:
                yield lang, b".".join(held).translate(_SIGNS)
                held, size = [], 0
        if held:
            yield lang, b".".join(held).translate(_SIGNS)


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words, counted by slice before the shuffle."""

    def run(batches):
        for batch in batches:
            for lang, text in _tokens(batch):
                # No word holds a full stop; bytes.split() parts at spaces, since nothing else is left of its white space.
                found = Counter(text.replace(b".", b" ").split())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                    names=["lang", "word", "n"],
                )

    return docs.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _numbers(docs: DataFrame, words: DataFrame, n_words: int) -> DataFrame:
    """(ids binary) rows: numbers of the words in a row, -1 once for whatever parts them.

    One pass for each vocabulary of ``VOCABULARY`` words; the texts travel with
    the numbers until the last one.
    """
    spark = docs.sparkSession
    rows = docs
    passes = max(1, -(-n_words // VOCABULARY))
    for k in range(passes):
        own = words.where(F.col("id").between(k * VOCABULARY, (k + 1) * VOCABULARY - 1)).select("lang", "word", "id")
        vocabulary: dict[str, dict[bytes, int]] = {}
        for row in own.toLocalIterator():  # at most VOCABULARY rows
            vocabulary.setdefault(row["lang"], {})[bytes(row["word"])] = row["id"]
        sent, first, last = spark.sparkContext.broadcast(vocabulary), k == 0, k == passes - 1

        def run(batches, sent=sent, first=first, last=last):
            def numbered_text(lang, text, before):
                known = sent.value.get(lang, {})
                parts = text.replace(b".", b" . ").split()
                ids = np.fromiter((known.get(p, -1) for p in parts), np.int32, len(parts))
                if before is not None:
                    ids = np.where(ids < 0, before, ids)
                return ids

            for batch in batches:
                if first:
                    texts = [(lang, text, None) for lang, text in _tokens(batch)]
                else:
                    texts = [
                        (lang, text, np.frombuffer(ids, np.int32))
                        for lang, text, ids in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "ids")))
                    ]
                for lang, text, before in texts:
                    ids = numbered_text(lang, text, before)
                    rows = _cut(ids) if last else [ids.tobytes()]
                    columns = ([lang] * len(rows), [None if last else text] * len(rows), rows)
                    types = (pa.string(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "text", "ids"])

        rows = stored(rows.mapInArrow(run, "lang string, text binary, ids binary"), "numbers")
        sent.destroy()
    return rows.select("ids")


def _cut(ids: np.ndarray) -> list[bytes]:
    """Rows of numbers that end with -1, which is there once only between two runs."""
    ids = np.append(ids, np.int32(-1))
    ids = ids[(ids >= 0) | np.append(True, ids[:-1] >= 0)]
    ends = np.flatnonzero(ids < 0) + 1
    own = np.searchsorted(ends, np.arange(ROW, len(ids) + ROW, ROW))
    cuts = np.unique(ends[np.minimum(own, len(ends) - 1)])
    return [part.tobytes() for part in np.split(ids, cuts) if len(part)]


def _held(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The numbers of a batch's rows, one after the other, in slices."""
    body, offsets = utf8(batch.column("ids"))
    for a, b in slices(offsets, HELD):
        yield np.frombuffer(body[offsets[a] : offsets[b]].tobytes(), np.int32)


class Trie:
    """Double-array trie over digits of numbers: from state s, digit d leads to base[s] + d if check there is s.

    A word is ``digits`` digits of ``DIGIT`` bits, so the children of a state
    lie close together however many words there are, and an edge takes a few
    cells at most. The first cells are the children of the root: a phrase's
    first word is its state. ``phrases`` is an array of one phrase of equal
    length a row, distinct and sorted; the base of a phrase's last state is its row.
    """

    def __init__(self, phrases: np.ndarray, n_words: int):
        n, self.depth = phrases.shape
        self.digits = max(1, -(-int(phrases[:, 1:].max(initial=0)).bit_length() // DIGIT))
        # With a digit's cells in front and behind, no step leaves the arrays.
        state, start = phrases[:, 0].astype(np.int64), max(n_words, 1 << DIGIT)
        bases, checks, above = [np.zeros(start, np.int32)], [np.full(start, -1, np.int32)], 0
        for level in range(1, self.depth):
            for digit in reversed(range(self.digits)):
                symbol = phrases[:, level] >> (DIGIT * digit) & (1 << DIGIT) - 1
                edge = np.ones(n, bool)
                edge[1:] = (state[1:] != state[:-1]) | (symbol[1:] != symbol[:-1])
                parent, symbol = state[edge], symbol[edge]
                cell, size = _placed(parent, symbol)
                bases[-1][parent - above] = start + cell - symbol
                bases.append(np.zeros(size, np.int32)), checks.append(np.full(size, -1, np.int32))
                checks[-1][cell] = parent
                state = (start + cell)[np.cumsum(edge) - 1]
                above, start = start, start + size
        bases[-1][state - above] = np.arange(n)
        self.base = np.concatenate(bases)
        self.check = np.concatenate([*checks, np.full(1 << DIGIT, -1, np.int32)])
        self.accepting = state

    def states(self, symbols: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
        """The state of each position after ``depth`` symbols from there on, -1 where there is none.

        ``first`` has the positions' numbers as first words where these are not ``symbols``.
        """
        first = symbols if first is None else first
        at = np.flatnonzero(first >= 0)
        state = first[at]
        for k in range(1, self.depth):
            near = at[: np.searchsorted(at, len(symbols) - k)]
            symbol = symbols[near + k]
            live = (symbol >= 0) & (symbol >> DIGIT * self.digits == 0)
            at, state, symbol = near[live], state[: len(near)][live], symbol[live]
            for digit in reversed(range(self.digits)):
                to = self.base[state] + (symbol >> DIGIT * digit & (1 << DIGIT) - 1)
                live = self.check[to] == state
                at, state, symbol = at[live], to[live], symbol[live]
        out = np.full(len(symbols), -1, np.int32)
        out[at] = state
        return out


def _placed(parent: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, int]:
    """(cell of each edge, number of cells): no two edges share a cell, and the edges of a parent
    lie as their symbols do. Edges come by parent and symbol.

    Parents of over ``WIDE`` children lie one behind the other; those of fewer
    are tried at random places, all at once, and go behind the others if none
    fits; single children fill what is left. So an edge takes 3 cells, or its
    share of a digit's, and those that fit nowhere are few.
    """
    first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
    count = np.diff(np.append(first, len(parent)))
    span = symbol[first + count - 1] - symbol[first] + 1
    offset = symbol - np.repeat(symbol[first], count)
    place = np.zeros(len(first), np.int64)
    many = count > WIDE
    place[many] = np.cumsum(span[many]) - span[many]
    start = int(span[many].sum())
    few = (count > 1) & ~many
    room = 3 * int(count[few].sum()) + 1
    free = np.ones(start + room + (1 << DIGIT), bool)
    owner = np.zeros(len(free), np.int32)
    free[(np.repeat(place, count) + offset)[np.repeat(many, count)]] = False
    rng, rest = np.random.default_rng(len(parent)), []
    for least, most in ((WIDE // 2, WIDE), (1, WIDE // 2)):
        left = np.flatnonzero((count > least) & (count <= most))
        for _ in range(ROUNDS):
            if not len(left):
                break
            heads = np.cumsum(count[left]) - count[left]
            who = np.repeat(np.arange(len(left), dtype=np.int32), count[left])
            tried = start + rng.integers(0, room, len(left))
            at = tried[who] + offset[first[left][who] + np.arange(len(who)) - heads[who]]
            fits = np.logical_and.reduceat(free[at], heads)[who]
            owner[at[fits]] = who[fits]  # of several parents the last has the cell
            fits = np.logical_and.reduceat(fits & (owner[at] == who), heads)
            place[left[fits]] = tried[fits]
            free[at[fits[who]]] = False
            left = left[~fits]
        rest.append(left)
    left = np.concatenate(rest)
    place[left] = len(free) + np.cumsum(span[left]) - span[left]
    one = np.flatnonzero(count == 1)
    gaps = np.flatnonzero(free)[: len(one)]
    end = len(free) + int(span[left].sum())
    place[one] = np.append(gaps, np.arange(end, end + len(one) - len(gaps)))
    cell = np.repeat(place, count) + offset
    return cell, int(cell.max(initial=-1)) + 1


class _Sums:
    """Counts by key, summed in the task before they are sent on; a bounded number of keys is held."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes one occurrence for each of ``keys``; gives sums when there are too many to hold."""
        keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys), self.counts.append(counts)
        self.size += len(keys)
        if self.size >= 2 * SUMS:
            self._join()
            if self.size >= SUMS:
                yield from self.rest()

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.size:
            self._join()
            for at in range(0, self.size, SENT):
                yield self.keys[0][at : at + SENT], self.counts[0][at : at + SENT]
        self.keys, self.counts, self.size = [], [], 0

    def _join(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys, self.counts, self.size = [keys[first]], [np.add.reduceat(counts, first)], len(first)


def _dealt(words: list, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Counts of phrases, given as columns of numbers, packed by bucket: one row for each bucket met."""
    n = len(counts)
    w = [np.asarray(c, np.int64) for c in words] + [np.full(n, -1, np.int64)] * (LONGEST - len(words))
    # Numbers from 1, two in one value; the counts behind them.
    table = np.stack([(w[0] + 1) << 32 | (w[1] + 1), (w[2] + 1) << 32 | (w[3] + 1), counts.astype(np.int64)])
    dest = (mix(table[0].view(np.uint64) * np.uint64(3) + table[1].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(dest, kind="stable")
    table, dest = table[:, order], dest[order]
    own, first = np.unique(dest, return_index=True)
    parts = np.split(table, first[1:], axis=1) if n else []
    data = [np.ascontiguousarray(t).tobytes() for t in parts]
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "data"])


def _enough(dealt: DataFrame, least: int) -> DataFrame:
    """(w1..w4, n) of what is counted ``least`` times or more in all tasks together."""

    def total(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(d, np.int64).reshape(3, -1) for d in table.column("data").to_pylist()]
        one, two, n = np.concatenate(parts, axis=1)
        order = np.lexsort((two, one))
        one, two, n = one[order], two[order], n[order]
        first = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
        n = np.add.reduceat(n, first)
        one, two, n = one[first][n >= least], two[first][n >= least], n[n >= least]
        words = [half - 1 for pair in (one, two) for half in (pair >> 32, pair & 0xFFFFFFFF)]
        return pa.table([*(pa.array(w, pa.int32()) for w in words), pa.array(n, pa.int64())], names=[*_KEY, "n"])

    return dealt.groupBy("bucket").applyInArrow(total, "w1 int, w2 int, w3 int, w4 int, n long")


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    return np.append(x[by:], np.full(min(by, len(x)), -1, x.dtype))


def _pairs(numbers: DataFrame, buckets: int, least: int) -> DataFrame:
    """Candidates of two words: neighbours seen ``least`` times; both are words with a number."""

    def run(batches):
        sums = _Sums()

        def found():
            for batch in batches:
                for x in _held(batch):
                    both = np.flatnonzero((x[:-1] >= 0) & (x[1:] >= 0))
                    yield from sums.add((x[both].astype(np.int64) << 32) | x[both + 1])
            yield from sums.rest()

        for key, n in found():
            yield _dealt([key >> 32, key & 0xFFFFFFFF], n, buckets)

    return _enough(numbers.mapInArrow(run, _DEALT), least)


def _walk(numbers: DataFrame, candidates: DataFrame, n_candidates: int, length: int, n_words: int, buckets: int, least: int, last: bool) -> DataFrame:
    """(w1..w4, n): candidates with their counts, and the next level's, which are a word longer."""
    spark = numbers.sparkSession
    blocks = max(1, -(-n_candidates // TRIE))
    # By order, so that a place in the texts concerns few of the blocks.
    dealt = numbered(candidates, [F.col(c) for c in _KEY]) if blocks > 1 else candidates.withColumn("nr", F.lit(1))
    out = None
    for block in range(blocks):
        own = dealt.where(F.col("nr").between(block * TRIE + 1, (block + 1) * TRIE)).select(*_KEY[:length]).toArrow()  # TRIE rows at most
        phrases = np.stack([np.asarray(own.column(c), dtype=np.int32) for c in _KEY[:length]], axis=1)
        if not len(phrases):
            continue
        phrases = phrases[np.lexsort(phrases.T[::-1])]
        # Only words of its phrases have a number in the trie.
        heads, words = np.unique(phrases[:, 0]), np.unique(phrases[:, 1:])
        within = np.concatenate([np.searchsorted(heads, phrases[:, :1]), np.searchsorted(words, phrases[:, 1:])], axis=1).astype(np.int32)
        sent = spark.sparkContext.broadcast((Trie(within, len(heads)), phrases, heads, words))
        del own, phrases, heads, words, within

        def run(batches, sent=sent):
            trie, phrases, heads, words = sent.value
            held, sums = np.zeros(len(phrases), np.int64), _Sums()
            head, other = np.full((2, n_words + 1), -1, np.int32)  # the last of each is for what parts the words
            head[heads], other[words] = np.arange(len(heads)), np.arange(len(words))

            def extended():
                for batch in batches:
                    for x in _held(batch):
                        state = trie.states(other[x], head[x])
                        at = np.flatnonzero(state >= 0)
                        phrase = trie.base[state[at]]
                        held[:] += np.bincount(phrase, minlength=len(held))
                        if last:
                            continue
                        word = _ahead(x, length)[at]
                        grows = word >= 0
                        if blocks == 1:  # else the phrase without its first word may be in another trie
                            grows &= _ahead(state, 1)[at] >= 0
                        yield from sums.add((phrase[grows].astype(np.int64) << 32) | word[grows])
                yield from sums.rest()

            for key, n in extended():
                yield _dealt([*phrases[key >> 32].T, key & 0xFFFFFFFF], n, buckets)
            met = np.flatnonzero(held)
            for at in range(0, len(met), SENT):
                some = met[at : at + SENT]
                yield _dealt([*phrases[some].T], held[some], buckets)

        found = stored(_enough(numbers.mapInArrow(run, _DEALT), least), "phrases")
        sent.destroy()
        out = found if out is None else out.unionAll(found)
    return out if out is not None else spark.createDataFrame([], "w1 int, w2 int, w3 int, w4 int, n long")


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, phrases) of texts in columns lang and text.

    ``words`` (lang, word, n, id) are those of at least ``least`` occurrences,
    ``totals`` (lang, n_all) the languages' word counts, ``phrases`` (w1..w4
    with -1 behind the last, n) all phrases of 2 to ``longest`` words with at
    least ``least`` occurrences inside pieces.
    """
    counts = stored(_word_counts(docs), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n_all"))
    words = numbered(counts.where(F.col("n") >= least), [F.col("lang"), F.desc("n"), F.col("word")])
    words = stored(words.select("lang", "word", "n", (F.col("nr") - 1).cast("int").alias("id")), "vocabulary")
    n_words = words.count()
    numbers = _numbers(docs, words, n_words)
    # Each place gives 16 bytes of counts at most, before they are summed.
    buckets = 1 + 16 * (totals.agg(F.sum("n_all")).first()[0] or 0) // BUCKET
    candidates, phrases = stored(_pairs(numbers, buckets, least), "candidates"), None
    for length in range(2, longest + 1):
        n = candidates.count()
        if not n and phrases is not None:
            break
        found = _walk(numbers, candidates, n, length, n_words, buckets, least, length == longest)
        longer = F.col(_KEY[length]) >= 0 if length < LONGEST else F.lit(False)
        level = found.where(~longer).select(*_KEY, "n")
        phrases = level if phrases is None else phrases.unionAll(level)
        # A candidate is counted by the one trie that holds its first words, so no sum is parted.
        candidates = found.where(longer).select(*_KEY)
    return words, totals, phrases


def _part(start: int, length: int) -> list:
    """Columns of the words [start, start + length) as a key of their own."""
    return [F.col(_KEY[start + k]) if k < length else F.lit(-1) for k in range(LONGEST)]


def _parts(phrases: DataFrame, choose, *keep) -> DataFrame:
    """One row for each part that ``choose`` names by (length): (start, length of the part, tag)."""
    rows = []
    for length in range(2, LONGEST + 1):
        for start, size, tag in choose(length):
            key = [c.alias(f"p{k}") for k, c in enumerate(_part(start, size))]
            rows.append(F.when(F.col("length") == length, F.struct(F.lit(tag).alias("tag"), *key)))
    return phrases.select(*keep, F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("part")).select(*keep, "part.*")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language.

    Phrases of 2 to ``longest`` (at most 4) words inside pieces, found at least
    ``least`` times; the lowest-scoring cut counts, ties to the shortest first
    part. A phrase is left out if a longer one that holds it is found at least
    0.8 times as often. Ordered by score, count and phrase, which leaves no
    ties. A null language is ``und``; null and empty texts hold no words;
    every row counts, also where rows repeat; other columns are not read. An
    empty table, or one without phrases, gives no rows.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words, totals, phrases = phrase_counts(texts, least, longest)
    length = sum((F.col(c) >= 0).cast("int") for c in _KEY)
    phrases = stored(phrases.withColumn("length", length), "counted")
    known = phrases.select(*_KEY, "n").unionAll(words.select("id", *[F.lit(-1)] * 3, "n"))
    key = [f"p{k}" for k in range(LONGEST)]
    known = known.toDF(*key, "part_n")

    # Both parts of each cut are known, as they are at least as frequent as the phrase.
    cuts = _parts(phrases, lambda m: [(s, k, 2 * c + side) for c in range(1, m) for side, s, k in ((0, 0, c), (1, c, m - c))], *_KEY, "n")
    cuts = cuts.join(known, key).withColumn("cut", F.expr("tag div 2")).groupBy(*_KEY, "n", "cut").agg(
        F.sum(F.when(F.col("tag") % 2 == 0, F.col("part_n"))).alias("l"), F.sum(F.when(F.col("tag") % 2 == 1, F.col("part_n"))).alias("r")
    )
    both = F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)")
    score = F.call_function("div", F.col("n").cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(7,0)"), both)
    best = cuts.withColumn("score", score.cast("long")).groupBy(*_KEY, "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    inside = _parts(phrases.where("length > 2"), lambda m: [(s, k, 0) for k in range(2, m) for s in range(m - k + 1)], "n")
    inside = inside.groupBy(*key).agg(F.max("n").alias("longer"))
    same = [F.col(a) == F.col(b) for a, b in zip(_KEY, key)]
    covered = F.col("longer").cast("decimal(19,0)") * COVERED[1] >= F.col("n").cast("decimal(19,0)") * COVERED[0]
    kept = best.join(inside, same, "left").where(F.col("longer").isNull() | ~covered).select(*_KEY, "n", "best.*")

    # Words back in place of numbers.
    numbers = F.filter(F.array(*_KEY), lambda w: w >= 0)
    placed = kept.select(*_KEY, "n", "score", "l", "r", F.posexplode(numbers).alias("pos", "id")).join(
        words.select("id", "lang", F.decode("word", "UTF-8").alias("word")), "id"
    )
    spelled = placed.groupBy(*_KEY, "n", "score", "l", "r", "lang").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("ws"))
    spelled = spelled.select(
        "lang", F.array_join(F.transform("ws", lambda w: w["word"]), " ").alias("phrase"), F.col("n").alias("a"), "l", "r", "score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("n_all").alias("n"), "score")


ORACLE = """
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
          FROM documents))
), grams AS (
  SELECT lang, list_slice(words, p, p + k - 1) AS g
  FROM pieces, unnest([1, 2, 3, 4]) AS ks(k), unnest(range(1, len(words) - k + 2)) AS ps(p)
), f AS (SELECT lang, g, count(*) AS n FROM grams GROUP BY lang, g HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
candidates AS (SELECT * FROM f WHERE len(g) >= 2),
cuts AS (
  SELECT c.lang, c.g, c.n AS a, k, x.n AS l, y.n AS r, ((2000000::HUGEINT * c.n) // (x.n::HUGEINT + y.n))::BIGINT AS score
  FROM candidates c, unnest(range(1, len(c.g))) AS ks(k)
  JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
  JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, len(c.g))
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, list_slice(g, s, s + m - 1) AS part, max(n) AS longer
  FROM candidates, unnest([2, 3]) AS ms(m), unnest(range(1, len(g) - m + 2)) AS ss(s)
  WHERE len(g) > m GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.part = b.g
  WHERE i.longer IS NULL OR 100 * i.longer::HUGEINT < 80 * b.a::HUGEINT
), ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language of ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))
