"""Operators against plain versions over whole small tables."""

import collections
import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from checks.compare import TABLES, compare
from moraine.llm import batches, bpe, chat, decontamination, graph, html_text, jaccard, quality, sharding, suffix_dedup, toxicity
from moraine.llm.queries import QUERIES, SQL

from . import plain


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(SQL))
def test_oracle(spark, con, sf_dir, name):
    good, note, _ = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
    assert good, note


# ---- suffix-array dedup


@pytest.mark.parametrize("length", [3, 5, 20])
def test_transform_finds_all_equal_windows(length):
    rng = random.Random(length)
    for turn in range(60):
        texts = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(length, 40))) for _ in range(rng.randint(1, 6))]
        if turn % 2:
            texts.append(texts[0][1:] + b"a")
        body = np.frombuffer(b"".join(texts), np.uint8)
        owner, at, group = suffix_dedup.equal_windows(body, np.array([len(t) for t in texts]), length)
        got, want = collections.defaultdict(set), collections.defaultdict(set)
        for o, a, g in zip(owner.tolist(), at.tolist(), group.tolist()):
            got[g].add((o, a))
        for i, t in enumerate(texts):
            for p in range(len(t) - length + 1):
                want[t[p : p + length]].add((i, p))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


@pytest.mark.parametrize("hot,task", [(4096, 4 << 20), (2, 60_000)])
def test_suffix_dedup_matches_plain(spark, sf_dir, documents, monkeypatch, hot, task):
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", hot)
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", task)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op2_suffix_array_dedup(spark, sf_dir).collect()}
    assert got == plain.suffix_dedup(documents)


def test_suffix_dedup_of_texts_without_ids(spark, monkeypatch):
    """All ids null: texts are spread by their hash, and a passage of every slice is dealt out by windows."""
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 2)
    monkeypatch.setattr(suffix_dedup, "HOT_KEYS", 16)
    rng = random.Random(12)
    passage = "".join(rng.choices("abcdefgh", k=150))
    texts = ["".join(rng.choices("ijklmnop", k=120)) + chr(0x4E00 + k) + passage for k in range(40)]
    rows = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(8)
    got = suffix_dedup.suffix_dedup(rows).collect()
    assert len(got) == 40 and sorted(r.n_removed for r in got) == [0] + [150] * 39
    hot = suffix_dedup._hot_anchors(rows, sum(map(len, texts)))
    assert hot.any() and hot.sum() < 100


def test_long_text_in_pieces():
    rng = random.Random(4)
    body = bytes(rng.choice(b"abc ") for _ in range(3000))
    whole = suffix_dedup.Segments(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
    starts = set()
    for _, first, part, cuts in suffix_dedup._pieces(np.frombuffer(body, np.uint8), np.array([0, len(body)]), 700):
        s = suffix_dedup.Segments(part, cuts)
        for a, n in zip(s.start.tolist(), s.count.tolist()):
            starts |= set(range(first + a, first + a + n))
    assert starts == set(range(len(body) - 99)) and whole.count.sum() == len(body) - 99


# ---- n-gram Jaccard join


def test_jaccard_matches_all_pairs(spark, sf_dir, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op6_ngram_jaccard_join(spark, sf_dir).collect()}
    assert got == plain.components(documents)


@pytest.mark.parametrize("group", [2, 4])
def test_jaccard_with_hot_shingles(spark, monkeypatch, group):
    """Clusters of near copies, and texts made of passages that all share."""
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "PART", 3)
    rng = random.Random(group)
    base = [[f"w{rng.randint(0, 9999)}" for _ in range(60)] for _ in range(3)]
    docs = {}
    for i in range(70):
        words = list(base[i % 3])
        if i % 5 == 0:
            words = words[:30] + base[(i + 1) % 3][:25]
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9999)}"
        docs[i] = " ".join(words[: rng.choice([20, 50, 60])])
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(df).collect()}
    assert got == plain.components(docs)


def test_trie_counts_and_prunes():
    rng = np.random.default_rng(3)
    for _ in range(50):
        pool = rng.integers(0, 60, 200).astype(np.uint64)
        sets = [np.unique(rng.choice(pool, rng.integers(1, 25))) for _ in range(12)]
        query = np.unique(rng.choice(pool, 15))
        seen = {}
        for i, shared, exact in jaccard.Trie(sets).join(query):
            true = len(np.intersect1d(sets[i], query))
            assert shared == true if exact else shared >= true
            if not exact:
                assert 100 * true < 75 * (len(sets[i]) + len(query) - true)
            seen[i] = True
        assert len(seen) == len(sets)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, k) for k in range(2, 60)] + [(7, 7), (500, 499)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {k: 1 for k in range(1, 60)} | {499: 499, 500: 499}
    assert got == want


# ---- byte-level BPE


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers

    encoder = bpe.Encoder(bpe.vocabulary())
    ranks = encoder.ranks.rank
    return encoder, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_on_random_texts(reference):
    own, other = reference
    rng = random.Random(3)
    letters = "aAbs tmdrevl'’  \n\t\r12٣é中　!?.,-_😀́ß\x1c\x85\xa0"
    for _ in range(150):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(20)]
        texts += ["", "'s", "'re a'll ''s !'s  'd", "   ", "a   ", " 's", "x" * 300]
        for text, (ids, offsets) in zip(texts, own.encode(texts)):
            assert ids.tolist() == other.encode_ordinary(text)
            assert own.decode(ids.tolist()) == text.encode()
            at = 0
            for i, o in zip(ids.tolist(), offsets.tolist()):
                assert o == at
                at += len(own.ranks.token[i])


def test_bpe_matches_on_documents(spark, sf_dir, documents, reference):
    _, other = reference
    for r in bpe.op9_bpe(spark, sf_dir).collect():
        ids = other.encode_ordinary(documents[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == plain.sha(",".join(map(str, ids)))
        assert r.decoded_sha256 == plain.sha(documents[r.doc_id] or "")


# ---- benchmark decontamination


def test_decontamination_matches_every_window(spark, sf_dir, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.op10_decontamination(spark, sf_dir).collect()}
    weigh = lambda s: sum(len(w.encode()) for w in s)
    want = {}
    for d, text in documents.items():
        words = plain.WORD.findall((text or "").translate(plain.LOWER))
        whole = set(zip(*(words[k:] for k in range(5))))
        for i, item in items:
            own = plain.shingle_set(item)
            if not own & whole:
                continue
            n = len(plain.WORD.findall(item))
            for a in range(len(words)):
                part = plain.shingle_set(" ".join(words[a : a + n]))
                both = sum(map(weigh, own & part))
                share = both / (sum(map(weigh, own | part)))
                if share >= 0.75:
                    want[d, i] = max(share, want.get((d, i), 0))
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_decontamination_finds_changed_passages():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(40, 80)))) for i in range(100)]
    index = decontamination.Index(items)
    found = due = 0
    for i, text in items:
        changed = text.split()
        changed[rng.randrange(len(changed))] = "changed"
        doc = " ".join(rng.choices(words, k=200) + changed + rng.choices(words, k=200))
        a, b = plain.shingle_set(text), plain.shingle_set(" ".join(changed))
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        due += 1
        body = np.frombuffer(doc.encode(), np.uint8)
        found += any(m[1] == i for m in index.matches(body, np.array([0, len(body)]), 0.75))
    assert due > 50 and found >= 0.95 * due


def test_decontamination_finds_every_passage_from_the_bound_up():
    rng = random.Random(18)
    words = [f"w{k}" for k in range(3000)]
    weigh = lambda shingles: sum(len(w) for s in shingles for w in s)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(5, 120)))) for i in range(150)]
    items += [(150, "w1 w2 w3"), (151, " ".join(["w4 w5"] * 30))]
    index = decontamination.Index(items)
    due = 0
    for i, text in items:
        n = len(text.split())
        changed = text.split() + (["w6"] if n > 9 else [])
        for _ in range(rng.randint(0, max(1, n // 40)) if n > 20 else 0):
            changed[rng.randrange(len(changed))] = "changed"
        doc = rng.choices(words, k=rng.randint(0, 50)) + changed + rng.choices(words, k=rng.randint(0, 50))
        own = plain.shingle_set(text)
        want = (0, 0)
        for a in range(len(doc)):
            part = plain.shingle_set(" ".join(doc[a : a + n]))
            want = max(want, (weigh(own & part) / weigh(own | part), -a))
        body = np.frombuffer(" ".join(doc).encode(), np.uint8)
        got = {m[1]: (m[3], -m[2]) for m in index.matches(body, np.array([0, len(body)]), 0.75)}
        due += 0.75 <= want[0] < 0.8
        assert got.get(i) == (want if want[0] >= 0.75 else None)
    assert due > 10


def test_fingerprints_alone_find_edited_passages():
    """The SimHash path by itself, without the exact complement: recall at least 0.9 from 0.75 up."""
    rng = random.Random(28)
    words = [f"w{k}" for k in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(20, 120)))) for i in range(300)]
    index = decontamination.Index(items)
    index._places = lambda *_: iter(())
    weigh = lambda shingles: sum(len(w) for s in shingles for w in s)
    due = found = 0
    for i, text in items:
        changed = text.split()
        for _ in range(rng.randint(1, max(1, len(changed) // 30))):
            changed[rng.randrange(len(changed))] = "changed"
        own, part = plain.shingle_set(text), plain.shingle_set(" ".join(changed))
        if weigh(own & part) < 0.75 * weigh(own | part):
            continue
        due += 1
        doc = " ".join(rng.choices(words, k=60) + changed + rng.choices(words, k=60)).encode()
        body = np.frombuffer(doc, np.uint8)
        found += any(m[1] == i for m in index.matches(body, np.array([0, len(body)]), 0.75))
    assert due > 100 and found >= 0.9 * due


def test_index_returns_all_within_the_radius():
    rng = random.Random(2)
    items = [(i, " ".join(f"v{rng.randint(0, 400)}" for _ in range(30))) for i in range(200)]
    index = decontamination.Index(items)
    for size, (own, *_) in index.windows.items():
        prints = own.copy()
        for _ in range(7):
            prints ^= np.uint64(1) << np.array([rng.randrange(64) for _ in prints], np.uint64)
        window, row = index.candidates(prints, size)
        got = set(zip(window.tolist(), row.tolist()))
        want = {(a, b) for a in range(len(prints)) for b in range(len(own)) if bin(int(prints[a] ^ own[b])).count("1") <= 7}
        assert got == want


# ---- sharding


@pytest.mark.parametrize("n_shards,buckets", [(24, 16384), (7, 3)])
def test_sharding_matches_plain(spark, sf_dir, n_shards, buckets):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    digest = lambda *parts: hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source["n" if r.source is None else "s" + r.source].append((digest(sharding.SEED, r.doc_id), r.doc_id, r))
    placed = []
    for source, own in by_source.items():
        own.sort(key=lambda x: x[:2])
        shift = int(digest(sharding.SEED, source)[:8], 16) / 2**32
        placed += [((k + shift) / len(own), source, h, i, r) for k, (h, i, r) in enumerate(own)]
    placed.sort(key=lambda x: x[:4])
    want, slots = {}, collections.Counter()
    for at, (*_, r) in enumerate(placed):
        shard = at * n_shards // len(rows)
        want[r.doc_id] = (shard, slots[shard], len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()))
        slots[shard] += 1
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sharding.shard(docs, n_shards=n_shards, buckets=buckets).collect()
    assert {r.doc_id: (r.shard, r.slot, r.size, r.text_crc32) for r in got} == want
    # Every shard has its part of every source.
    for source, own in by_source.items():
        held = collections.Counter(want[i][0] for _, i, _ in own)
        assert all(abs(held[s] - len(own) / n_shards) <= 2 for s in range(n_shards))


# ---- trained models


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = toxicity.op5_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.toxic for r in held)
    assert right >= 0.9 * len(held)
    toxic = [r for r in held if r.toxic]
    assert len(toxic) >= 100 and sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in held if not r.toxic) <= 0.02 * len(held)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    votes = np.stack([np.where(y, rng.random(4000) < a, rng.random(4000) < b) for a, b in ((0.8, 0.1), (0.6, 0.05), (0.7, 0.2))], 1)
    votes = np.hstack([votes, votes[:, :1] ^ (rng.random((4000, 1)) < 0.02)])  # a near copy of the first voter
    labels = np.where(rng.random(4000) < 0.1, ~y, y).astype(int)
    model = toxicity.LabelModel(votes.astype(float), labels * 0.9 + 0.05, None, labels)
    assert abs(model.accuracy[1, 0] - 0.8) < 0.06 and abs(model.accuracy[0, 0] - 0.1) < 0.05
    assert np.all(np.abs(model.right - 0.9) < 0.05)
    assert model.parent[3] == 0 or model.parent[0] == 3
    assert ((model.posterior > 0.5) == y).mean() > (labels == y).mean()
    # Rows counted together give the same model.
    rows, times = np.unique(np.hstack([votes, labels[:, None]]), axis=0, return_counts=True)
    again = toxicity.LabelModel(rows[:, :-1].astype(float), rows[:, -1] * 0.9 + 0.05, times, rows[:, -1])
    assert np.allclose(again.accuracy, model.accuracy, atol=1e-3)


def test_posterior_is_that_of_all_enumerated_votes():
    rng = np.random.default_rng(4)
    y = rng.random(3000) < 0.4
    votes = np.stack([rng.random(3000) < np.where(y, a, b) for a, b in ((0.7, 0.1), (0.6, 0.2), (0.5, 0.05), (0.3, 0.1))], 1)
    votes[:, 3] |= votes[:, 1] & (rng.random(3000) < 0.8)
    model = toxicity.LabelModel(votes.astype(float), np.where(votes.sum(1) > 1, 0.9, 0.1))
    total = 0
    for row in itertools.product((0, 1), repeat=4):
        joint = []
        for c in (0, 1):
            p = model.prior[c]
            for k, vote in enumerate(row):
                mother = row[model.parent[k]] if model.parent[k] >= 0 else 0
                said = model.pair[c, mother, k]
                p *= said if vote else 1 - said
            joint.append(p)
        total += sum(joint)
        logit = model.evidence(np.array([row], np.float32))[0]
        assert abs(1 / (1 + np.exp(-logit)) - joint[1] / sum(joint)) < 1e-6
    assert abs(total - 1) < 1e-6  # every voter's parent is decided before it: a tree


def test_equal_tables_give_equal_toxicity_scores(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    one, two = (
        sorted((r.doc.doc_id, r.score) for r in toxicity.score(d, labels, carry=["doc_id"]).collect())
        for d in (docs.repartition(3), docs.repartition(7, "text"))
    )
    assert one == two
    # One id that every row repeats.
    again = docs.withColumn("doc_id", F.lit(1).cast("long"))
    known = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(again, known).count() == docs.count()


def test_quality_matches_plain_and_labels(spark, documents, sf_dir):
    got = {r.doc_id: r for r in quality.op7_quality_rules(spark, sf_dir).collect()}
    for i, text in documents.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain.quality_base(text)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    bad = [got[r.doc_id] for r in labels if r.quality == 0 and not got[r.doc_id].base_failed]
    assert len(bad) >= 2 and sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_quality_field_finds_where_content_ends(spark):
    """Fitted on even ids; 200 joins of a good and a bad text of odd ids are told apart line by line."""
    rows = (
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        .join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
        .where("text is not null and quality is not null")
        .select("doc_id", "text", "quality")
        .orderBy("doc_id")
        .collect()
    )
    good, bad = ([r.text for r in rows if r.doc_id % 2 and r.quality == q and r.text.split()] for q in (1, 0))
    rng = random.Random(9)
    joined, truth = [], {}
    for k in range(200):
        a, b = rng.choice(good), rng.choice(bad)
        joined.append((-1 - k, a + "\n" + b if k % 2 else b + "\n" + a))
        truth[-1 - k] = len(plain.WORD.findall(a)) / len(plain.WORD.findall(a + " " + b))
    even = [r for r in rows if r.doc_id % 2 == 0]
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in even] + joined, "doc_id long, text string")
    labels = spark.createDataFrame([(r.doc_id, r.quality) for r in even], "doc_id long, quality int")
    got = {r.doc.doc_id: r.content_share for r in quality.rate(docs, labels).collect()}
    assert sum(0 < got[k] < 1 for k in truth) >= 180
    assert sum(abs(got[k] - share) <= 0.1 for k, share in truth.items()) >= 180


def test_training_sequences_hold_every_piece_once():
    sizes = np.array([3, 1, 4, 1, 5, 9, 2])
    assert quality.join_pieces(sizes, 3).tolist() == [0, 3, 8, 23, 25]
    assert quality.join_pieces(sizes, 1).tolist() == [0, 3, 4, 8, 9, 14, 23, 25]
    assert quality.join_pieces(sizes[:1]).tolist() == [0, 3]


def test_viterbi_is_the_best_of_all_markings():
    rng = np.random.default_rng(5)
    field = quality.Field(rng.normal(size=quality.N_FEATURES), rng.normal(size=(2, 2)))
    sizes = [1, 4, 7, 2, 0, 5]
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    x = rng.normal(size=(cuts[-1], quality.N_FEATURES))
    got = field.decode(x, cuts)
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a == b:
            continue
        score = x[a:b] @ field.weights
        best = max(
            itertools.product((0, 1), repeat=b - a),
            key=lambda m: sum(s * v for s, v in zip(score, m)) + sum(field.link[p, q] for p, q in zip(m, m[1:])),
        )
        assert got[a:b].astype(int).tolist() == list(best)


def test_chat_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(6)
    model = chat.Model(rng.integers(1, 50, 3), rng.integers(1, 50, (3, 3)), rng.integers(1, 50, (3, chat.N_EVIDENCE)))
    rows = [(3, [(3, 1, 21)]), (1, [(3, 2, 22), (2, 3, 23)]), (3, [(3, 4, 24), (0, 5, 25)])]
    flat = [(named, k, *line) for named, lines in rows for k, line in enumerate(lines)]

    def value(path):
        total = model.start[path[0]]
        for at, (s, (named, k, mark, a, b)) in enumerate(zip(path, flat)):
            total += model.seen[s, a] + model.seen[s, b]
            total += model.marked[s, mark] if mark != 3 else 0
            total += model.marked[s, named] if named != 3 and k == 0 else 0
            if at:
                p = path[at - 1]
                move = model.move[p, s]
                total += move if k == 0 else max(move, np.log(0.1)) if mark != 3 else chat._STAY if p == s else chat._MOVE
        return total

    best = max(itertools.product(range(3), repeat=len(flat)), key=value)
    assert [s for row in model.decode(rows) for s in row] == list(best)


def test_chat_blocks_are_decoded_as_one_conversation(spark):
    rng = random.Random(12)
    lines = ["Hello there.", "What now?", "- a list", "", "Assistant: yes.", "User: no?", "Some words, and more:", "x" * 300]
    texts = [(k - 3, "\n".join(rng.choices(lines, k=rng.randint(1, 3)))) for k in range(300)] + [(None, "first\nof all")]
    named = [(t, rng.choice([None, None, "user", "assistant", "system"]), x) for t, x in texts]
    plan = [(1, *r) for r in named] + [(2, t + 200, r, x) for t, r, x in named[:100]] + [(3, 5, "user", "Hi?"), (None, 5, "user", "Hi?")]
    talks = spark.createDataFrame(plan, "conv_id long, turn long, role string, text string")
    start, move = np.zeros(3), np.zeros((3, 3))
    whole = {}
    for conv in (1, 2, 3, None):
        rows = sorted((r[1:] for r in plan if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0))
        whole[conv] = rows
        roles = [chat.role_of(r[1]) for r in rows]
        if roles[0] < 3:
            start[roles[0]] += 1
        for a, b in zip(roles, roles[1:]):
            if a < 3 and b < 3:
                move[a, b] += 1
    model = chat.train(talks)
    want = chat.Model(start, move, np.zeros((3, chat.N_EVIDENCE)))
    assert np.allclose(model.start, want.start) and np.allclose(model.move, want.move)
    model = chat.Model(np.array([9, 1, 1]), np.array([[50, 1, 1], [1, 1, 50], [1, 50, 1]]), np.random.default_rng(3).integers(1, 50, (3, chat.N_EVIDENCE)))
    got = {(r.conv_id, r.turn, r.part): (r.role, r.recovered_role) for r in chat.format_chat(talks, model).collect()}
    for conv, rows in whole.items():
        seen = [[(m, a, b) for m, _, a, b in chat._views(r[2])] for r in rows]
        role = model.decode(list(zip([chat.role_of(r[1]) for r in rows], seen)))
        blind = model.decode([(3, s) for s in seen])
        for r, p, q in zip(rows, role, blind):
            assert got[conv, r[0], 0] == (chat.ROLES[p[0]], chat.ROLES[q[0]])


def test_chat_spreads_rows_without_a_turn_number(spark):
    rows = [(1, None, "user" if k % 2 else "assistant", f"line {k}?") for k in range(3000)] + [(1, 1, "user", "hello"), (1, -70, None, "thanks.")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    sizes = chat._rows(conversations).groupBy("block").count().collect()
    assert max(r["count"] for r in sizes) < 30 and min(r.block for r in sizes if r.block > -(1 << 59)) == -2
    got = chat.format_chat(conversations).collect()
    assert len(got) == len(rows)
    assert sum(r.role == ("user" if int(r.text[5:-1]) % 2 else "assistant") for r in got if r.text.startswith("line")) >= 2900


def test_chat_recovers_roles(spark, sf_dir):
    roles = {(r.conv_id, r.turn): r.role for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()}
    rows = chat.op1_chat_formatting(spark, sf_dir).collect()
    assert all(r.role == roles[r.conv_id, r.turn] for r in rows)
    assert sum(r.recovered_role == roles[r.conv_id, r.turn] for r in rows) >= 0.9 * len(rows)


# ---- HTML extraction


def test_minimum_cut_is_the_least_of_all_cuts():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randint(1, 8)
        costs = [rng.uniform(-3, 3) for _ in range(n)]
        edges = {(a, b): rng.uniform(0, 2) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5}

        def cost(sides):
            own = sum(max(c, 0) if not s else max(-c, 0) for c, s in zip(costs, sides))
            return own + sum(c for (a, b), c in edges.items() if sides[a] != sides[b])

        best = min(cost(s) for s in itertools.product((False, True), repeat=n))
        assert abs(cost(html_text.minimum_cut(costs, edges)) - best) < 1e-6


def test_html_takes_the_article(spark, sf_dir):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in html_text.op8_html_extraction(spark, sf_dir).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert r.n_chars == len(r.text)


def test_html_without_an_article_element():
    page = """<html><head><title>T</title></head><body class="with-sidebar"><header class="site-header"><h1>Site</h1></header>
    <div id="cookie-notice">We use cookies.</div><div class="content"><h2>Title</h2>
    <p>First   paragraph, with a <a href="#">link</a> &amp; more <b>words</b>.<p>Second&nbsp;paragraph.
    <div class="ad">Buy now</div><p>Third.</p><script>var x = "</p>";</script></div>
    <div class="sidebar"><p>Other story that is long enough to look like text. Yes.</p></div>
    <section id="comments"><p>Nice post, thank you very much. I liked it.</p></section>
    <form><p>Name</p><input></form><footer>c</footer></body></html>"""
    want = "Title First paragraph, with a link & more words. Second paragraph. Third."
    assert html_text.extract(page, html_text._PRIOR) == want


# ---- helpers


@pytest.mark.parametrize(
    "page,want",
    [
        *[(f"<p>a</p><{x}/><p>b</p>", ["a", "b"]) for x in ("svg", "math", "object", "video", "canvas", "button")],
        *[(f"<div><p>a</p><{x} id=k></div><p>b</p>", ["a", "b"]) for x in ("svg", "object", "video", "canvas", "button")],
        ("<p>a</p><video-player src=x><p>b</p></video-player><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><button-group>b</button-group>c", ["a", "b", "c"]),
        ("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>", ["if x=2 holds"]),
        ("<p>a <button><div>menu</div></button> b</p>", ["a b"]),
        ("<p>a <svg><title/><text>t</text></svg> b</p><p>c", ["a b", "c"]),
        ("<p>a <object>x<object>y</object>z</object>b", ["a", "b"]),
        ("<div>a <select>b <button><div>c</div></button> d</div>e", ["a", "b d", "e"]),
        ("<p>a<script-x>b</script-x><script>if (a<b) c</script>d</p>", ["a", "b", "d"]),
        ("<p>a</p><textarea>b</p><p>c", ["a"]),
    ],
)
def test_html_leaves_out_only_what_is_closed(page, want):
    assert [b.text for b in html_text.blocks_of(page)] == want


def test_html_keeps_the_context_below_a_deep_subtree():
    page = "<nav>" + "<div>" * 1000 + "<section>deep</section>" + "</div>" * 1000 + "menu</nav><article>" + "<div>" * 500 + "text"
    blocks = html_text.blocks_of(page)
    assert [b.text for b in blocks] == ["deep", "menu", "text"]
    assert [bool(b.bits & html_text.NAV) for b in blocks] == [True, True, False]
    assert blocks[2].bits & html_text.ARTICLE and [b.depth for b in blocks] == [1003, 2, 502]


def test_word_spans_end_with_their_row():
    import pyarrow as pa

    texts = ["", "ab cd", "ef", None, " g\n", ""]
    body, offsets = batches.utf8(pa.array(texts))
    starts, ends, row = batches.word_spans(body, offsets, batches.NOT_SPACE)
    raw = body.tobytes()
    assert [(raw[a:b].decode(), r) for a, b, r in zip(starts, ends, row.tolist())] == [("ab", 1), ("cd", 1), ("ef", 2), ("g", 4)]
