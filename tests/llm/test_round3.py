"""Substring dedup, importance resampling and collocations against plain versions, and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from moraine.llm import batches, bpe, collocations, debruijn, html_text, importance, jaccard, quality, ranks

from .conftest import AWKWARD, COPY
from .plain import LOWER, WORD, sha

# ---- substring dedup


def plain_substring(docs, window):
    """docs: [(id, text)]; gives [(n_words, n_removed, sha256 of the words kept)] in order."""
    words = [WORD.findall(t or "") for _, t in docs]
    late = lambda i: (i is None, i or 0)  # noqa: E731  texts without an id come last
    least = {}
    for (i, _), w in zip(docs, words):
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            least[key] = min(least.get(key, late(i)), late(i))
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        for p in range(len(w) - window + 1):
            if least[tuple(w[p : p + window])] < late(i):
                gone.update(range(p, p + window))
        out.append((len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def found_substrings(spark, rows, window, schema="doc_id long, text string"):
    got = debruijn.substring_dedup(spark.createDataFrame(rows, schema), window=window).collect()
    for r in got:
        assert r.n_words - r.n_removed == len(r.kept.split()) and sha(r.kept) == r.kept_sha256
        assert r.n_removed == sum(s.stop - s.start for s in r.spans)
    return collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got)


@pytest.mark.parametrize("seed,window,piece", [(1, 3, 1 << 20), (2, 6, 40), (3, 12, 1 << 20), (4, 50, 60)])
def test_substring_dedup(spark, monkeypatch, seed, window, piece):
    monkeypatch.setattr(debruijn, "PIECE", piece)
    rng = random.Random(seed)
    text = lambda n: [rng.choice("abcd") if seed < 3 else f"w{rng.randint(0, 400)}" for _ in range(n)]
    shared = [text(window * 3) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(1, 3)):
            own = list(rng.choice(shared))
            if rng.random() < 0.6:
                own[rng.randrange(len(own))] = "edit"
            parts += text(rng.randint(0, 2 * window)) + own[rng.randint(0, window) :]
        rows.append((rng.choice([i, i, i, 7, None]), rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [rows[3], rows[5], (50, None), (51, ""), (52, " \n"), (53, rows[0][1])]
    want = collections.Counter((r[0], *w) for r, w in zip(rows, plain_substring(rows, window)))
    assert found_substrings(spark, rows, window) == want


def test_substring_dedup_deals_out_hot_anchors(spark, monkeypatch):
    """One passage in all texts, next to other words in each."""
    monkeypatch.setattr(debruijn, "HOT_LEAST", 5)
    monkeypatch.setattr(debruijn, "SALTS", 4)
    rng = random.Random(9)
    passage = [f"p{k}" for k in range(14)]
    rows = [(i, " ".join([f"a{rng.randint(0, 9)}", *passage, f"b{i}", *passage[: rng.randint(3, 14)]])) for i in range(60)]
    want = collections.Counter((r[0], *w) for r, w in zip(rows, plain_substring(rows, 8)))
    assert found_substrings(spark, rows, 8) == want


def test_substring_dedup_awkward(spark, awkward, empty):
    rows = [(r[0], r[1]) for r in AWKWARD]
    got = debruijn.substring_dedup(awkward, window=10).collect()
    want = collections.Counter((r[0], *w) for r, w in zip(rows, plain_substring(rows, 10)))
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert debruijn.substring_dedup(empty).count() == 0


def test_other_hashes_when_words_collide(spark, monkeypatch):
    """A hash that takes all words for one is found out at the source coordinates, and another one is taken."""

    class Bad(debruijn._Hashes):
        def __missing__(self, word):
            return 1 if self.key == bytes(8) and word[:1] == b"x" else super().__missing__(word)

    monkeypatch.setattr(debruijn, "_Hashes", Bad)
    words = [f"w{k}" for k in range(30)]
    rows = [(1, " ".join(["x1", *words, "x2"])), (2, " ".join(["x3", *words, "x4"]))]
    want = collections.Counter((r[0], *w) for r, w in zip(rows, plain_substring(rows, 5)))
    assert found_substrings(spark, rows, 5) == want


def test_hashes_of_alternating_words():
    """Strings that a plain polynomial modulo 2^64 cannot tell apart."""
    a, b = [0], [1]
    for _ in range(11):
        a, b = a + b, b + a
    values = np.array([3, 5], np.uint64)
    assert debruijn.rolled(values[a], 2048)[0] != debruijn.rolled(values[b], 2048)[0]


# ---- importance resampling


def plain_resample(docs, target, buckets, most, share, least, seed):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        w = word.findall((text or "").translate(LOWER))
        return w, [" ".join(w[k : k + n]) for n in range(1, most + 1) for k in range(len(w) - n + 1)]

    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(at(f) for x in texts for f in features(x)[1]) for texts in ([d[1] for d in docs], target))
    total, t_total = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (t_total + buckets))))
    out = []
    for i, x in docs:
        w, f = features(x)
        weight = sum(gain(at(y)) for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[: len(able) * share[0] // share[1]]
    return out, [(r[0], r[4]) for r in drawn]


@pytest.mark.parametrize("most", [1, 3])
def test_resample(spark, awkward, empty, most):
    rng = random.Random(most)
    line = lambda: " ".join(rng.choice(["alpha", "Beta", "gámma", "x1", "-", "Ünï"]) for _ in range(rng.randint(0, 4)))
    docs = [(i, "\n".join(line() for _ in range(rng.randint(0, 6)))) for i in range(60)] + [(r[0], r[1]) for r in AWKWARD]
    target = ["alpha beta\ngámma", None, "", "one two three four five"]
    args = dict(buckets=97, most=most, share=(1, 3), least_words=4, seed=11)
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'own' AS doc", "'own' AS rank", "'own' AS weight")
    items = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(frame, items, **args).select("doc.doc_id", "doc.rank", "n_words", "n_features", "weight", "score", "rank").collect()
    want, drawn = plain_resample(docs, target, 97, most, (1, 3), 4, 11)
    assert collections.Counter((r[0], *r[2:6]) for r in got) == collections.Counter(want)
    assert {r[1] for r in got} == {"own"}
    ranked = sorted((r for r in got if r[6] is not None), key=lambda r: r[6])
    assert [r[6] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r[0], r[5]) for r in ranked] == drawn
    if most == 1:
        assert importance.resample(empty, items).count() == 0
        assert importance.resample(awkward, items.where("false")).count() == len(AWKWARD)


def test_numbers_follow_the_order(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 5000, 1, 7).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(900)))
    got = ranks.numbered(rows, [F.desc("k"), F.col("id")]).orderBy("nr").collect()
    assert [r.nr for r in got] == list(range(1, 5001))
    assert [(r.k, r.id) for r in got] == sorted(((r.k, r.id) for r in got), key=lambda r: (-r[0], r[1]))


# ---- collocations


def plain_collocations(docs, least, longest, top):
    """docs: [(lang, text)]."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                for k in range(len(w) - size + 1):
                    f[lang][tuple(w[k : k + size])] += 1
    out = []
    for lang, counts in f.items():
        often = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in often.items():
            inside = lambda h: any(h[k : k + len(g)] == g for k in range(len(h) - len(g) + 1))  # noqa: B023, E731
            if any(len(h) > len(g) and 100 * b >= 80 * a and inside(h) for h, b in often.items()):
                continue
            score, _, left, right = min((2000000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("vocabulary,trie,held", [(1 << 20, 1 << 19, 2 << 20), (7, 40, 256)])
def test_collocations(spark, monkeypatch, vocabulary, trie, held):
    for name, value in (("VOCABULARY", vocabulary), ("TRIE", trie), ("HELD", held), ("ROW", 8), ("SUMS", 16), ("SLICE", 500), ("BUCKET", 4000)):
        monkeypatch.setattr(collocations, name, value)
    rng = random.Random(trie)
    vocabulary = ["New", "york", "city", "hall", "ünï", "de", "la", "\x00", "\x1f", "a", "b", "日本", "x\xa0y"]
    docs = []
    for _ in range(150):
        words = [rng.choice(vocabulary) if rng.random() < 0.5 else "New York city" for _ in range(rng.randint(0, 12))]
        docs.append((rng.choice(["en", "de", None]), "".join(w + rng.choice([" ", " ", "\t", ". ", "\n", ","]) for w in words)))
    docs += [("en", None), (None, ""), ("fr", " \t\n")]
    frame = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "'own' AS id", "'own' AS n")
    got = sorted(tuple(r) for r in collocations.collocations(frame, least=4, top=25).collect())
    assert got == plain_collocations(docs, 4, 4, 25)
    assert len(got) > 20


def test_collocations_edges(spark, awkward, empty):
    docs = [(r[2], r[1]) for r in AWKWARD]
    got = sorted(tuple(r) for r in collocations.collocations(awkward, least=2).collect())
    assert got == plain_collocations(docs, 2, 4, 2000)
    assert collocations.collocations(empty).count() == 0
    assert "one two" in COPY


def test_trie_holds_its_phrases_and_no_others():
    rng = np.random.default_rng(1)
    phrases = np.unique(rng.integers(0, 30, (4000, 3)), axis=0).astype(np.int32)
    phrases = phrases[rng.random(len(phrases)) < 0.4]
    trie = collocations.Trie(phrases, 30)
    text = rng.integers(-1, 30, 60_000).astype(np.int32)
    state = trie.states(text)
    held = {tuple(p) for p in phrases.tolist()}
    want = [tuple(text[k : k + 3].tolist()) in held for k in range(len(text) - 2)]
    assert (state[:-2] >= 0).tolist() == want and (state[-2:] < 0).all()
    named = {int(s): tuple(p) for s, p in zip(trie.accepting, phrases.tolist())}
    assert all(named[int(s)] == tuple(text[k : k + 3].tolist()) for k, s in enumerate(state) if s >= 0)


# ---- texts that a plain polynomial modulo 2^64 cannot tell apart


def alternating(length):
    a, b = "a", "b"
    while len(a) < length:
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("length", [1024, 2048])
def test_alternating_texts_are_told_apart(spark, length):
    a, b = alternating(length)
    body = np.frombuffer((a + b).encode(), np.uint8)
    one, two = batches.span_hashes(body, np.array([0, length]), np.array([length, 2 * length]))
    assert one != two
    rows = spark.createDataFrame([(1, a), (2, b), (3, f"{a}\n{b}")], "doc_id long, text string").coalesce(1)
    encoded = bpe.digests(rows, bpe.vocabulary()).collect()
    assert {r.decoded_sha256 for r in encoded} == {sha(a), sha(b), sha(f"{a}\n{b}")}
    linked = {r.doc_id: r.component_id for r in jaccard.link_documents(rows).collect()}
    assert linked == {1: 1, 2: 2, 3: 3}
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rated = quality.rate(rows, labels).select("doc.doc_id", "n_dup_lines").collect()
    assert {tuple(r) for r in rated} == {(1, 0), (2, 0), (3, 0)}


# ---- an article inside a wrapper whose name speaks against it

ARTICLE = "<article><h1>A heading</h1><p>" + "One long sentence of the article, with words in it. " * 5 + "</p><p>" + "Another paragraph follows here. " * 4 + "</p></article>"
MENU = "<nav><a href=/>Home</a> <a href=/x>News</a></nav>"


@pytest.mark.parametrize(
    "wrapper",
    ["form id=aspnetForm", "div class=page-with-sidebar", "div class=layout-sidebar-right", "div id=comments-page", "main class=search-page", "div class=legal-news"],
)
def test_a_wrapper_does_not_hide_the_article(wrapper):
    tag = wrapper.split()[0]
    weights = html_text._PRIOR
    alone = html_text.extract(f"<body>{MENU}{ARTICLE}<footer>Imprint</footer></body>", weights)
    wrapped = html_text.extract(f"<body><{wrapper}>{MENU}{ARTICLE}<footer>Imprint</footer></{tag}></body>", weights)
    assert "Another paragraph" in alone and wrapped == alone


def test_comments_beside_the_article_stay_out():
    comments = "<div id=comments>" + "<article><p>I liked this very much, thank you all.</p></article>" * 3 + "</div>"
    with_article = html_text.extract(f"<body>{ARTICLE}{comments}</body>", html_text._PRIOR)
    plain_page = html_text.extract(f"<body><div class=post><p>{'Some words of the text. ' * 20}</p></div>{comments}</body>", html_text._PRIOR)
    assert "thank you" not in with_article + plain_page and "Some words" in plain_page
