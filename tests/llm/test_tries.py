"""What tries of phrases take where many words are followed by many others."""

import tracemalloc

import numpy as np

from moraine.llm import collocations


def _wide(rng, parents, children, n_words):
    """Phrases of two words: each first word is followed by as many others, anywhere among ``n_words``."""
    pairs = np.stack([np.repeat(np.arange(parents), children), rng.integers(0, n_words, parents * children)], axis=1)
    return np.unique(pairs, axis=0).astype(np.int32)


def test_a_trie_takes_a_few_cells_for_each_phrase():
    rng = np.random.default_rng(2)
    phrases = _wide(rng, 200, 150, 100_000)
    tracemalloc.start()
    trie = collocations.Trie(phrases, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(trie.check) < 20 * len(phrases) and peak < 1000 * len(phrases)
    second = np.where(rng.random(40_000) < 0.5, phrases[rng.integers(0, len(phrases), 40_000), 1], rng.integers(-1, 110_000, 40_000))
    text = np.stack([rng.integers(0, 200, 40_000), second], axis=1).astype(np.int32).reshape(-1)
    first = np.where(text < 200, text, -1)
    text[::2] = -1  # first words have numbers of their own
    state = trie.states(text, first)
    row = {tuple(p): k for k, p in enumerate(phrases.tolist())}
    want = [row.get((f, s), -1) for f, s in zip(first[:-1].tolist(), text[1:].tolist())]
    got = np.where(state >= 0, trie.base[state], -1)
    assert got[:-1].tolist() == want and got[-1] == -1
    assert sum(k >= 0 for k in want) > 100 and (trie.base[trie.accepting] == np.arange(len(phrases))).all()


def test_places_of_children_are_distinct_and_few(monkeypatch):
    rng = np.random.default_rng(3)
    for rounds in (16, 1):  # with one round many parents go behind the others
        monkeypatch.setattr(collocations, "ROUNDS", rounds)
        for children in (1, 2, 5, 8, 9, 40):
            parent = np.repeat(np.arange(500), rng.integers(1, children + 1, 500))
            edges = np.unique(np.stack([parent, rng.integers(0, 64, len(parent))], axis=1), axis=0)
            cell, size = collocations._placed(edges[:, 0], edges[:, 1])
            assert len(np.unique(cell)) == len(cell) and cell.min() >= 0 and cell.max() < size
            base = cell - edges[:, 1]
            same = edges[1:, 0] == edges[:-1, 0]
            assert (base[1:][same] == base[:-1][same]).all()
            assert rounds == 1 or size < 8 * len(edges) + 64


def test_blocks_of_candidates_give_the_counts_of_one(spark, monkeypatch):
    """A first word with more followers than one block holds is in several of them."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 30) % 60) for _ in range(120)]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    found = []
    for trie in (1 << 19, 9):
        monkeypatch.setattr(collocations, "TRIE", trie)
        found.append(sorted(map(tuple, collocations.phrase_counts(docs, 12, 3)[2].collect())))
    assert found[0] == found[1] and len(found[0]) > 30 and max(sum(r[0] == w for r in found[0]) for w in {r[0] for r in found[0]}) > 9
