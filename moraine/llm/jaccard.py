"""N-gram Jaccard join: documents that share three quarters of their shingles.

Texts of the same shingle set are one class, so copies cost one row. Shingles
are ordered by hash. Each class posts its shingles below a share THETA of the
hash range, and classes meet in the groups of shingles they share:

* In a group of at most GROUP classes every pair is a candidate. The number of
  shared shingles bounds the overlap, and few pairs pass the bound.
* A shingle of a larger group is hot. A class with enough posted shingles that
  are not hot must meet each of its partners in a small group (it may miss
  fewer than that many), so hot groups need not be paired at all.
* The few classes left, made of hot shingles mostly, post all their shingles
  among themselves. Those that are still hot after that are clusters of near
  copies: each hot group is compared with its least edited class of about the
  same size, and pairs are compared only where that leaves them in doubt: in different components, near
  enough by the triangle inequality of the Jaccard distance, and similar enough
  if they share all hot shingles of the poorer one (pairs that share others have
  met in a small group).

Candidates are verified on whole sets with a prefix tree: the partners of a
class go into a trie in shingle order, one traversal counts overlaps on shared
prefixes once, and subtrees are pruned by what can still be shared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.sources.shared import stored

from .batches import LOWER, NOT_SPACE, PIECE, mix, slices, span_hashes, utf8, word_spans
from .graph import components

SHINGLE = 5
PERCENT = 75
THETA = 0.34  # share of the hash range that every class posts
GROUP = 32  # classes of a shingle that are paired; more make it hot
BUCKET_ENTRIES = 400_000  # postings that one task sorts, about
PART = 256  # partners of one class that one trie holds, about


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; fewer words are one shingle."""
    n = min(size, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    h = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(h)]
    mix(h).sort()
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    return h[keep]


def text_sets(column: pa.Array):
    """(first row, sets) for slices of a column of texts."""
    body, offsets = utf8(column)
    for a, b in slices(offsets):
        own, sets = offsets[a : b + 1], []
        for first, last in slices(own, PIECE):
            lower = LOWER[body[own[first] : own[last]]]
            starts, ends, row = word_spans(lower, own[first : last + 1] - own[first], NOT_SPACE)
            words = span_hashes(lower, starts, ends)
            cuts = np.searchsorted(row, np.arange(last - first + 1)).tolist()
            sets += [shingle_hashes(words[c:d]) for c, d in zip(cuts[:-1], cuts[1:])]
        yield a, sets


def _digest(s: np.ndarray) -> tuple[int, int, int]:
    """Two sums that name a set, and its class number made of them."""
    one = s.sum(dtype=np.uint64)
    two = mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    whole = mix(np.array([one], np.uint64) * np.uint64(3) + two + np.uint64(len(s)))
    return tuple(np.array([one, two, whole[0]], np.uint64).view(np.int64).tolist())


def _limit(theta: float) -> np.uint64:
    return np.uint64(min(int(theta * 2.0**64), 2**64 - 1))


def members(docs: DataFrame, theta: float) -> DataFrame:
    """(doc_id, one, two, cls, n, posted) for each row."""
    limit = _limit(theta)

    def run(batches):
        for batch in batches:
            rows = []
            for _, sets in text_sets(batch.column("text")):
                rows += [(*_digest(s), len(s), int(np.searchsorted(s, limit, side="right"))) for s in sets]
            columns = [pa.array(np.array(c, np.int64)) for c in zip(*rows)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "one", "two", "cls", "n", "posted"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, one bigint, two bigint, cls bigint, n bigint, posted bigint")


def _blobs(tokens: list[np.ndarray], owners: list[int], buckets: int) -> pa.RecordBatch:
    """Postings dealt to buckets, a row for each bucket."""
    sizes = [len(t) for t in tokens]
    token = np.concatenate([*tokens, np.zeros(0, np.uint64)])
    owner = np.repeat(np.array(owners, np.int64), sizes)
    bucket = (token & np.uint64(0xFFFFFFFF)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    token, owner, bucket = token[order], owner[order], bucket[order]
    own, first = np.unique(bucket, return_index=True)
    cuts = [*first.tolist(), len(bucket)]
    spans = list(zip(cuts[:-1], cuts[1:]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(own.astype(np.int32)),
            pa.array([token[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([owner[a:b].tobytes() for a, b in spans], pa.binary()),
        ],
        names=["bucket", "tokens", "owners"],
    )


_POSTINGS = "bucket int, tokens binary, owners binary"


def post_texts(docs: DataFrame, theta: float, buckets: int) -> DataFrame:
    """Postings of each class's shingles below ``theta``; a class posts once per slice."""
    limit = _limit(theta)

    def run(batches):
        for batch in batches:
            for _, sets in text_sets(batch.column("text")):
                own = {_digest(s)[2]: s[: np.searchsorted(s, limit, side="right")] for s in sets if len(s)}
                yield _blobs(list(own.values()), list(own), buckets)

    return docs.select("text").mapInArrow(run, _POSTINGS)


def post_sets(sets: DataFrame, buckets: int) -> DataFrame:
    """Postings of all shingles of stored sets."""

    def run(batches):
        for batch in batches:
            tokens = [np.frombuffer(s, np.uint64) for s in batch.column("shingles").to_pylist()]
            yield _blobs(tokens, batch.column("cls").to_pylist(), buckets)

    return sets.select("cls", "shingles").mapInArrow(run, _POSTINGS)


def meet(postings: DataFrame, most: int) -> DataFrame:
    """(hot, a, b, n): pairs of classes with the shingles they share here, n of them;
    for a hot shingle b, its classes a."""

    def run(table: pa.Table) -> pa.Table:
        token, owner = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("tokens", np.uint64), ("owners", np.int64))
        )
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner = token[new], owner[new]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(token)))
        a, b = [], []
        for width in np.unique(size[(size > 1) & (size <= most)]).tolist():
            group = owner[first[size == width][:, None] + np.arange(width)]
            x, y = np.triu_indices(width, 1)
            a.append(group[:, x].ravel()), b.append(group[:, y].ravel())
        a, b = (np.concatenate([*v, np.zeros(0, np.int64)]) for v in (a, b))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(a)))
        hot = np.repeat(size > most, size)
        return pa.table(
            {
                "hot": np.concatenate([np.zeros(len(at), bool), np.ones(int(hot.sum()), bool)]),
                "a": np.concatenate([a[at], owner[hot]]),
                "b": np.concatenate([b[at], token[hot].view(np.int64)]),
                "n": np.concatenate([n, np.ones(int(hot.sum()), np.int64)]),
            }
        )

    return postings.groupBy("bucket").applyInArrow(run, "hot boolean, a bigint, b bigint, n bigint")


def bounded(met: DataFrame, info: DataFrame) -> DataFrame:
    """(a, b): pairs whose sizes and shared shingles leave the similarity open.

    ``info`` has (cls, n, posted, hot). What two classes share is at most what
    they were seen to share, the hot shingles of either, and those not posted.
    """
    side = lambda s: info.select(*[F.col(c).alias(f"{c}_{s}") for c in ("cls", "n", "posted", "hot")])
    pairs = met.where("not hot").groupBy("a", "b").agg(F.sum("n").alias("seen"))
    pairs = pairs.join(side("a"), F.col("a") == F.col("cls_a")).join(side("b"), F.col("b") == F.col("cls_b"))
    shared = F.col("seen") + F.least("hot_a", "hot_b") + F.least(F.expr("n_a - posted_a"), F.expr("n_b - posted_b"))
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    return pairs.where(sizes & (shared * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT)).select("a", "b")


def _with_hot(classes: DataFrame, met: DataFrame) -> DataFrame:
    hot = met.where("hot").groupBy(F.col("a").alias("cls")).agg(F.count(F.lit(1)).alias("hot"))
    return classes.join(hot, "cls", "left").withColumn("hot", F.coalesce("hot", F.lit(0)))


# Shingles a class may lack of a partner's, and one: with so many at least one is shared.
_PREFIX = f"n - cast(ceil(n * {PERCENT} / 100.0) as bigint) + 1"


class Trie:
    """Sorted sets as a prefix tree with whole runs of shingles in a node."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.root = self._node(0)
        path = [self.root]
        previous = np.zeros(0, np.uint64)
        for i in order:
            s = sets[i]
            m = min(len(previous), len(s))
            differ = np.flatnonzero(previous[:m] != s[:m])
            common = int(differ[0]) if len(differ) else m
            while path[-1]["depth"] > common:
                top = path.pop()
                if path[-1]["depth"] < common:
                    # Split the run at the shared prefix.
                    upper = self._node(common)
                    cut = common - path[-1]["depth"]
                    upper["run"], top["run"] = top["run"][:cut], top["run"][cut:]
                    upper["children"] = [top]
                    path[-1]["children"][-1] = upper
                    path.append(upper)
            leaf = self._node(len(s))
            leaf["run"] = s[common:]
            if len(leaf["run"]):
                path[-1]["children"].append(leaf)
                path.append(leaf)
            path[-1]["sets"].append(i)
            previous = s
        stack, seen = [self.root], []
        while stack:
            node = stack.pop()
            seen.append(node)
            stack.extend(node["children"])
        for node in reversed(seen):
            own = [node["depth"]] * bool(node["sets"])
            node["longest"] = max(own + [c["longest"] for c in node["children"]], default=0)
            node["shortest"] = min(own + [c["shortest"] for c in node["children"]], default=0)

    @staticmethod
    def _node(depth: int) -> dict:
        return {"depth": depth, "run": np.zeros(0, np.uint64), "children": [], "sets": []}

    def join(self, query: np.ndarray):
        """(set, overlap or a bound of it, whether it is exact) for every set in the tree."""
        size = len(query)
        stack = [(self.root, 0, 0)]
        while stack:
            node, shared, used = stack.pop()
            run = node["run"]
            if len(run):
                at = np.searchsorted(query, run)
                shared += int((query[np.minimum(at, size - 1)] == run).sum())
                used = int(np.searchsorted(query, run[-1], side="right"))
            for i in node["sets"]:
                yield i, shared, True
            for child in node["children"]:
                most = shared + min(child["longest"] - node["depth"], size - used)
                if most * (100 + PERCENT) >= PERCENT * (size + child["shortest"]):
                    stack.append((child, shared, used))
                else:
                    below = [child]
                    while below:
                        skipped = below.pop()
                        below.extend(skipped["children"])
                        for i in skipped["sets"]:
                            yield i, min(most, skipped["depth"]), False


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, exact, n_a, n_b): whole sets compared, the partners of a class in tries.

    A class with many partners has several tries, so that no task holds them all.
    """
    pairs = stored(pairs.distinct(), "pairs")
    buckets = max(1, pairs.count() // PART)
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    own = sets.select("cls", "shingles")
    query = dealt.select("a", "part").distinct().join(own, F.col("a") == F.col("cls")).select("a", "part", F.lit(None).cast("bigint").alias("b"), "shingles")
    partner = dealt.join(own, F.col("b") == F.col("cls")).select("a", "part", "b", "shingles")
    rows = query.unionAll(partner).withColumn("bucket", F.pmod(F.xxhash64("a", "part"), F.lit(buckets)))

    def run(table: pa.Table) -> pa.Table:
        groups: dict[tuple, list] = {}
        for a, part, b, s in zip(*(table.column(c).to_pylist() for c in ("a", "part", "b", "shingles"))):
            groups.setdefault((a, part), []).append((b, np.frombuffer(s, np.uint64)))
        out = []
        for (a, _), held in groups.items():
            asked = next(s for b, s in held if b is None)
            partners = [(b, s) for b, s in held if b is not None]
            for i, shared, exact in Trie([s for _, s in partners]).join(asked):
                out.append((a, partners[i][0], shared, exact, len(asked), len(partners[i][1])))
        columns = list(zip(*out)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("a", "b", "shared", "exact", "n_a", "n_b"), columns, kinds)})

    return stored(
        rows.groupBy("bucket").applyInArrow(run, "a bigint, b bigint, shared bigint, exact boolean, n_a bigint, n_b bigint"),
        "verified",
    )


def linked(verified: DataFrame) -> DataFrame:
    similar = F.col("shared") * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT
    return verified.where(F.col("exact") & similar).select("a", "b")


def fetch_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, shingles) of the classes in ``wanted`` (cls, rep), read from the texts again.

    A bit table over the wanted ids, at most 8 MB, spares most texts their
    shingles; what it lets through is joined exactly.
    """
    bits = 1 << min(26, max(16, (16 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64("rep"), F.lit(bits))
    words = wanted.select(place.alias("p")).groupBy(F.expr("p div 64").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("v")
    )
    words = words.toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[np.asarray(words.column("w"))] = np.asarray(words.column("v")).view(np.uint64)

    def run(batches):
        for batch in batches:
            place = np.asarray(batch.column("place"))
            hit = (table[place // 64] >> (place % 64).astype(np.uint64)) & np.uint64(1)
            own = {}
            for _, sets in text_sets(batch.column("text").filter(pa.array(hit.astype(bool)))):
                own.update((_digest(s)[2], s) for s in sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(own), pa.int64()), pa.array([s.tobytes() for s in own.values()], pa.binary())],
                names=["cls", "shingles"],
            )

    read = docs.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("place"))
    found = read.mapInArrow(run, "cls bigint, shingles binary")
    return stored(found.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "sets")


def _dense_links(dense: DataFrame, met: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """Links among classes of hot shingles, from the groups of the hot shingles in their prefixes."""
    # A class's hot shingles in hash order, as many as its prefix lacks.
    flipped = F.expr("b ^ (-9223372036854775807L - 1)")  # unsigned order
    own = met.where("hot").select(F.col("a").alias("cls"), "b").join(dense, "cls")
    own = own.groupBy("cls", "n", "hot").agg(F.sort_array(F.collect_set(flipped)).alias("tokens"))
    lacking = F.expr(f"cast(({_PREFIX}) - (n - hot) as int)")
    # `left` counts a class's hot shingles from the group's on: all that a pair can share
    # if this shingle is the first that it shares.
    groups = own.select("cls", "n", "hot", F.posexplode(F.slice("tokens", 1, lacking)).alias("place", "token"))
    groups = groups.withColumn("left", F.col("hot") - F.col("place"))
    # Classes that can link are of one band of sizes or of neighbours, so each band of a group has a leader.
    groups = groups.withColumn("band", F.floor(F.log("n") / F.log(F.lit(100 / PERCENT))))
    # The class with the largest share of hot shingles is the least edited: the others are likest to it.
    least_edited = F.max(F.struct((F.col("hot") / F.col("n")).alias("share"), "cls", "n", "left")).alias("leader")
    groups = stored(groups, "groups")
    groups = groups.join(groups.groupBy("token", "band").agg(least_edited), ["token", "band"])
    groups = stored(groups.select("token", "cls", "n", "left", *[F.col(f"leader.{c}").alias(f"leader_{c}") for c in ("cls", "n", "left")]), "led")
    # Pairs that share other shingles met in small groups; here they can share hot ones at most.
    star = groups.where("cls != leader_cls").where(_may_link("left", "leader_left", "n", "leader_n"))
    seen = verify(star.select(F.col("leader_cls").alias("a"), F.col("cls").alias("b")), sets)
    links = links.unionAll(linked(seen))
    roots = components(links)

    # Members of groups that still are in several components, with their distance from the leader:
    # exact, or at least so much, or nothing known.
    near = seen.select(
        F.col("a").alias("leader_cls"),
        F.col("b").alias("cls"),
        (1 - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("far"),
        "exact",
    )
    leads = F.col("cls") == F.col("leader_cls")
    placed = (
        groups.join(near, ["leader_cls", "cls"], "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select(
            "token", "cls", "n", "left", "leader_cls",
            F.coalesce("root", "cls").alias("root"),
            F.coalesce("far", F.lit(0.0)).alias("far"),
            F.coalesce("exact", leads).alias("exact"),
        )
    )
    split = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("token")
    placed = stored(placed.join(split, "token"), "placed")
    gap = (100 - PERCENT) / 100 + 1e-9
    apart = f"(x.exact and y.far - x.far > {gap}) or (y.exact and x.far - y.far > {gap})"
    open_pairs = placed.alias("x").join(placed.alias("y"), "token").where(
        (F.col("x.root") < F.col("y.root"))
        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * PERCENT)
        & _may_link("x.left", "y.left", "x.n", "y.n")
        & ~((F.col("x.leader_cls") == F.col("y.leader_cls")) & F.expr(apart))
    )
    pairs = open_pairs.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))
    return links.unionAll(linked(verify(pairs, sets)))


def _may_link(left_a: str, left_b: str, n_a: str, n_b: str):
    """Whether two classes that share at most so many shingles can be similar enough."""
    return F.least(left_a, left_b) * (100 + PERCENT) >= (F.col(n_a) + F.col(n_b)) * PERCENT


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each input row.

    Words are runs without ASCII white space, A-Z lower-cased; a text's set
    holds its distinct five-word shingles, or all its words as one where there
    are fewer. Two texts link when their sets share 75 of 100 of their union;
    a component is all that links reach, named by its least id. A null, empty
    or blank text has no shingle and no link, and is its own component.
    Repeated rows and equal texts are in one component; ids that are all null
    give a null component. An empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(members(docs, THETA), "members")
    classes = stored(
        rows.where("n > 0").groupBy("one", "two", "cls", "n", "posted").agg(F.min("doc_id").alias("rep")).drop("one", "two"), "classes"
    )
    entries = classes.agg(F.coalesce(F.sum("posted"), F.lit(0))).first()[0]
    met = stored(meet(post_texts(docs, THETA, 1 + entries // BUCKET_ENTRIES), GROUP), "met")
    info = _with_hot(classes, met)
    first = stored(bounded(met, info), "candidates")
    sparse = info.where(f"posted - hot < {_PREFIX}").select("cls", "rep", "n")
    wanted = first.select(F.col("a").alias("cls")).unionAll(first.select("b")).distinct().join(classes, "cls").select("cls", "rep")
    wanted = stored(wanted.unionAll(sparse.select("cls", "rep")).distinct(), "wanted")
    sets = fetch_sets(docs, wanted)
    links = linked(verify(first, sets))

    # Classes that hot shingles leave open post all their shingles among themselves.
    sparse = stored(sparse, "sparse")
    entries = sparse.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    met = stored(meet(post_sets(sets.join(sparse.select("cls"), "cls", "left_semi"), 1 + entries // BUCKET_ENTRIES), GROUP), "met")
    info = _with_hot(sparse.withColumn("posted", F.col("n")), met)
    links = links.unionAll(linked(verify(bounded(met, info), sets)))
    dense = info.where(f"n - hot < {_PREFIX}").select("cls", "n", "hot")
    links = _dense_links(stored(dense, "dense"), met, sets, links)

    roots = components(links)
    placed = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", F.coalesce("root", "cls").alias("root"))
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = placed.join(least, "root").select("cls", "component_id")
    return rows.join(named, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def op6_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
