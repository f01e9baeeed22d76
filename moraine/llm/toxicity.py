"""Toxicity by weak supervision.

Many weak voters look at a text: each word of an insult lexicon in four
languages, patterns (several insults, an insult beside a word for "you",
shouting), and stems that the labelled rows suggest. A generative model of
their votes given an unseen class estimates each voter's accuracy and the
correlations between voters (a dependency tree, so that near-identical voters
do not count twice). The given label is one more voter, whose errors are
estimated like the others'. The posterior labels train the linear classifier
that scores every text.

Given labels come from a bounded sample of labelled rows outside the held-out
remainder; scoring is one pass over all texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from moraine.sources.shared import stored

from .batches import LOWER, PIECE, slices, span_hashes, utf8, word_spans

MAX_ROWS = 20_000  # labelled rows the classifier is fitted on, at most
MAX_STEMS = 256  # stems that may vote
LEAST_GAIN = 6.0  # log likelihood ratio from which a stem may vote
MIN_ROWS = 4  # labelled rows a stem must occur in
THRESHOLD = 0.3
SEED = 11
HELD = 1 << 19  # counts of stems that a task holds before it sums them up

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True
# Prefix lengths in bytes; 0 stands for the whole word.
_LENGTHS = (0, 4, 5, 6, 7)
# Common insults in English, German, French and Spanish, and words for "you".
INSULTS = (
    "idiot moron stupid loser clown trash scum worthless pathetic disgusting dumb fool jerk creep filth garbage "
    "vermin coward freak liar ugly hate shut "
    "trottel dumm dummkopf abschaum wertlos erbärmlich ekelhaft feigling lügner versager hässlich drecksack "
    "imbécile crétin débile ordure déchet minable pathétique dégoûtant lâche menteur "
    "idiota imbécil estúpido basura escoria inútil patético asqueroso cobarde mentiroso payaso"
).split()
YOU = "you your you're u du dich tu toi vous usted".split()


def _features(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, word index) of each word's stems, and of the whole word."""
    lower = LOWER[body]
    starts, ends, row = word_spans(lower, offsets, _LETTER)
    rows, hashes, words = [], [], []
    for length in _LENGTHS:
        long = np.flatnonzero(ends - starts >= max(length, 2))
        a = starts[long]
        b = ends[long] if length == 0 else a + length
        h = span_hashes(lower, a, b)
        rows.append(row[long]), words.append(long)
        hashes.append(h ^ np.uint64(0x5851F42D4C957F2D) if length == 0 else h)
    return np.concatenate(rows), np.concatenate(hashes), np.concatenate(words)


def _stem_counts(body: np.ndarray, offsets: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """(stem, rows, toxic rows) of each distinct stem of a slice of texts, as columns."""
    rows, hashes, _ = _features(body, offsets)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return _summed(np.stack([hashes[new].view(np.int64), np.ones(int(new.sum()), np.int64), toxic[rows[new]].astype(np.int64)]))


def _summed(counts: np.ndarray) -> np.ndarray:
    """One column for each distinct stem, its numbers added up."""
    counts = counts[:, np.argsort(counts[0])]
    first = np.flatnonzero(np.append(True, counts[0, 1:] != counts[0, :-1])) if counts.shape[1] else np.zeros(0, int)
    return np.vstack([counts[:1, first], np.add.reduceat(counts[1:], first, axis=1)]) if len(first) else counts


def _word_hash(word: str) -> int:
    body = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(body, np.array([0]), np.array([len(body)]))[0] ^ np.uint64(0x5851F42D4C957F2D))


class Lookup:
    """Finds which of some hashes occur; a bit table turns most others away."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.intp)] = True

    def __call__(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``found``, index of the hash) of the hits."""
        at = np.flatnonzero(self.bits[(found & np.uint64((1 << 20) - 1)).astype(np.intp)])
        if not len(self.hashes) or not len(at):
            return at[:0], at[:0]
        near = np.minimum(np.searchsorted(self.hashes, found[at]), len(self.hashes) - 1)
        same = self.hashes[near] == found[at]
        return at[same], self.order[near[same]]


class Voters:
    """Votes of stems, lexicon words and patterns: a column each, 1 where a voter speaks."""

    PATTERNS = ("lexicon", "two insults", "insult beside you", "shouting", "many marks")

    def __init__(self, stems: np.ndarray):
        insults, you = [np.array([_word_hash(w) for w in ws], np.uint64) for ws in (INSULTS, YOU)]
        self.stems = stems = stems[~np.isin(stems, np.concatenate([insults, you]))]
        self.kinds = np.concatenate([np.zeros(len(stems), int), np.ones(len(insults), int), np.full(len(you), 2)])
        self.lookup = Lookup(np.concatenate([stems, insults, you]))
        self.patterns = len(stems) + len(insults)  # the column of the first pattern
        self.size = self.patterns + len(self.PATTERNS)

    def __call__(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, voter) pairs of a slice of texts."""
        rows, hashes, words = _features(body, offsets)
        first = self.patterns
        at, index = self.lookup(hashes)
        kind = self.kinds[index]
        irow, iword, yword = rows[at[kind == 1]], words[at[kind == 1]], words[at[kind == 2]]
        voting = kind < 2
        out = [(rows[at[voting]], index[voting]), (irow, np.full(len(irow), first))]
        order = np.argsort(iword, kind="stable")
        pairs = np.flatnonzero(np.diff(irow[order]) == 0)
        out.append((irow[order][pairs], np.full(len(pairs), first + 1)))
        beside = np.isin(iword, np.concatenate([yword + d for d in (-2, -1, 1, 2)])) if len(yword) else np.zeros(len(iword), bool)
        out.append((irow[beside], np.full(int(beside.sum()), first + 2)))
        size = np.maximum(np.diff(offsets), 1)
        upper = (body >= ord("A")) & (body <= ord("Z"))
        marks = body == ord("!")
        for k, flag in ((3, upper), (4, marks)):
            total = np.concatenate([[0], np.cumsum(flag)])
            share = (total[offsets[1:]] - total[offsets[:-1]]) / size
            loud = np.flatnonzero(share > (0.5 if k == 3 else 0.02))
            out.append((loud, np.full(len(loud), first + k)))
        row, voter = (np.concatenate(x).astype(np.int64) for x in zip(*out))
        distinct = np.unique(row * self.size + voter)
        return distinct // self.size, distinct % self.size


class LabelModel:
    """Votes given an unseen class: a tree of dependencies per class, fitted by EM.

    ``guess`` holds the class probabilities EM starts from, ``times`` how often
    each row of votes occurs, ``given`` a label of each row, a voter whose
    accuracies ``right`` are estimated too. ``accuracy`` is each voter's P(vote | class);
    ``pair`` holds P(vote | class, parent's vote), which carries the
    correlations; ``posterior`` is P(class 1 | votes).
    """

    def __init__(
        self,
        votes: np.ndarray,
        guess: np.ndarray,
        times: np.ndarray | None = None,
        given: np.ndarray | None = None,
        rounds: int = 60,
        smooth: float = 0.5,
    ):
        n, k = votes.shape
        votes = votes.astype(np.float32)
        times = np.ones(n) if times is None else times.astype(np.float64)
        q = np.asarray(guess, np.float64)
        self.parent = np.full(k, -1)
        for turn in range(rounds):
            weight = np.stack([1 - q, q]) * times
            if k > 1 and turn % 10 == 0:
                self._tree(votes, weight, times.sum())
            mother = votes[:, np.maximum(self.parent, 0)] * (self.parent >= 0)
            seen = np.empty((2, 2, k))
            for y in range(2):
                for v in range(2):
                    w = weight[y][:, None] * (mother == v)
                    seen[y, v] = ((w * votes).sum(0) + smooth * 0.1) / (w.sum(0) + smooth)
            self.pair, self.prior = np.clip(seen, 1e-4, 1 - 1e-4), np.clip(weight.sum(1) / times.sum(), 1e-4, 1 - 1e-4)
            self.accuracy = (weight @ votes + smooth * 0.1) / (weight.sum(1)[:, None] + smooth)
            before, logit = q, self.evidence(votes)
            if given is not None:
                self.right = np.clip([weight[y][given == y].sum() / weight[y].sum() for y in range(2)], 0.55, 0.99)
                yes, no = self.right[1] / (1 - self.right[0]), (1 - self.right[1]) / self.right[0]
                logit = logit + np.log(np.where(given == 1, yes, no))
            q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            if np.abs(q - before) @ times < 1e-5 * times.sum():
                break
        self.posterior = q

    def evidence(self, votes: np.ndarray) -> np.ndarray:
        mother = votes[:, np.maximum(self.parent, 0)] * (self.parent >= 0)
        logit = np.full(len(votes), np.log(self.prior[1] / self.prior[0]))
        for v in range(2):
            said = np.log(self.pair[1, v] / self.pair[0, v])
            silent = np.log((1 - self.pair[1, v]) / (1 - self.pair[0, v]))
            logit += ((mother == v) * np.where(votes > 0, said, silent)).sum(1)
        return logit

    def _tree(self, votes: np.ndarray, weight: np.ndarray, n: float) -> None:
        """Maximum spanning tree over the voters' mutual information given the class."""
        k = votes.shape[1]
        info = np.zeros((k, k))
        for y in range(2):
            w = (weight[y] / n).astype(np.float32)
            both = ((votes * w[:, None]).T @ votes).astype(np.float64)
            one, total = (votes * w[:, None]).sum(0), w.sum()
            cells = (both, one[:, None] - both, one[None, :] - both, total - one[:, None] - one[None, :] + both)
            sides = ((one, one), (one, total - one), (total - one, one), (total - one, total - one))
            for cell, (a, b) in zip(cells, sides):
                cell = np.maximum(cell, 1e-12)
                info += cell * np.log(cell * total / np.maximum(a[:, None] * b[None, :], 1e-15))
        self.parent = np.full(k, -1)
        best, link = info[0].copy(), np.zeros(k, int)
        free = np.ones(k, bool)
        free[0] = False
        for _ in range(k - 1):
            j = int(np.argmax(np.where(free, best, -np.inf)))
            # A voter that shares next to nothing with the others stands alone.
            self.parent[j] = link[j] if best[j] > 1e-5 else -1
            free[j] = False
            closer = info[j] > best
            best[closer], link[closer] = info[j][closer], j


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float, rounds: int = 400) -> np.ndarray:
    """Weights and bias by accelerated gradient steps; ``y`` may be a probability."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    step = 4.0 / (np.square(x).sum(1).max() + 4 * penalty)
    share = times / times.sum()
    w = u = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 0
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ u, -30, 30)))
        new = u - step * (x.T @ ((p - y) * share) + ridge * u)
        u = new + t / (t + 3) * (new - w)
        w = new
    return w


class Model:
    """Voters, their classifier weights, and the calibration of its score."""

    def __init__(self, stems: np.ndarray):
        self.voters = Voters(stems)
        self.weights = np.zeros(self.voters.size)
        self.bias = -2.0

    def score(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, voter = self.voters(body, offsets)
        z = np.bincount(row, self.weights[voter], len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, votes: np.ndarray, labels: np.ndarray, times: np.ndarray) -> None:
        self.label_model = model = LabelModel(votes, labels * 0.9 + 0.05, times, labels)
        w = _logistic(votes, model.posterior, times, 1e-4)
        z = votes @ w[:-1] + w[-1]
        scale, shift = _logistic(z[:, None], labels.astype(np.float64), times, 1e-6)
        self.weights, self.bias = w[:-1] * scale, w[-1] * scale + shift


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str,
    text: str,
    max_rows: int = MAX_ROWS,
    max_stems: int = MAX_STEMS,
    least_gain: float = LEAST_GAIN,
) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out remainder.

    Rows without a label or id are left out; of labels that repeat an id the
    greatest counts. At most ``max_stems`` stems vote beside the lexicon, those
    of the greatest gain from ``least_gain`` on. Where documents repeat an id,
    equal votes are counted together and the ``max_rows`` commonest are taken.
    Where one class is missing the model gives one score.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
        .limit(max_rows)
    )
    # At most max_rows pairs of numbers are broadcast.
    sample = stored(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id"),
        "toxicity_sample",
    )

    def stems_of(batches):
        held = np.zeros((3, 0), np.int64)
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            toxic = np.asarray(batch.column("toxic"))
            for a, b in slices(offsets, PIECE):
                found = _stem_counts(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], toxic[a:b])
                held = np.hstack([held, found])
                if held.shape[1] >= HELD:
                    held = _summed(held)
                    if held.shape[1] >= HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=["stem", "n", "bad"])
                        held = held[:, :0]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _summed(held)], names=["stem", "n", "bad"])

    n_rows, n_bad = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_bad < n_rows:
        model = Model(np.zeros(0, np.uint64))
        model.bias = 2.0 if n_bad else -2.0
        return model
    rate = n_bad / n_rows
    share = (F.col("bad") + rate) / (F.col("n") + 1)
    # How surprising the toxic rows of a stem are: its likelihood ratio against the base rate.
    gain = F.col("n") * (share * F.log(share / rate) + (1 - share) * F.log(F.greatest(1 - share, F.lit(1e-9)) / (1 - rate)))
    stems = (
        sample.mapInArrow(stems_of, "stem bigint, n bigint, bad bigint")
        .groupBy("stem")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .where((F.col("n") >= MIN_ROWS) & (share > 3 * rate))
        .withColumn("gain", gain)
        .orderBy(F.desc("gain"), "stem")
        .limit(max_stems)
        .where(F.col("gain") > least_gain)
        .select("stem")
    )
    found = np.array([r.stem for r in stems.collect()], np.int64).view(np.uint64)
    model = Model(found)
    voters = model.voters

    def votes_of(batches):
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets, PIECE):
                row, voter = voters(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                cuts = np.searchsorted(row, np.arange(b - a + 1))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(voter, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("toxic")[a:b], lists], names=["toxic", "votes"])

    # In one order, so that equal tables give equal models; at most max_rows rows reach the driver.
    counted = sample.mapInArrow(votes_of, "toxic int, votes array<int>").groupBy("toxic", "votes").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.orderBy(F.desc("n"), "toxic", "votes").limit(max_rows).collect()
    votes = np.zeros((len(rows), voters.size), np.float32)
    for i, r in enumerate(rows):
        votes[i, r.votes] = 1
    model.fit(votes, np.array([r.toxic for r in rows]), np.array([r.n for r in rows], np.float64))
    return model


def score(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    max_rows: int = MAX_ROWS,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: (doc struct, held_out, score, predicted).

    ``doc`` holds every input column, or those in ``carry``. Null and empty texts have no votes and
    get the score of a text without any; so does every text where the labels
    teach nothing. Equal texts have equal scores.
    """
    model = train(docs, labels, doc_id, text, max_rows)
    columns = carry or docs.columns
    inside = text in columns  # then the text is not sent a second time

    def run(batches):
        for batch in batches:
            body, offsets = utf8(batch.column("doc").field(text) if inside else batch.column("text"))
            for a, b in slices(offsets, PIECE):
                scores = model.score(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc")[a:b], batch.column("held_out")[a:b], pa.array(scores)],
                    names=["doc", "held_out", "score"],
                )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        held_out(F.col(doc_id)).alias("held_out"),
        *([] if inside else [F.col(text).alias("text")]),
    )
    schema = StructType().add("doc", rows.schema["doc"].dataType).add("held_out", BooleanType()).add("score", DoubleType())
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return score(docs, labels, carry=["doc_id"]).select("doc.doc_id", "held_out", "score", "predicted")
