"""Near copies that share all their hot shingles with shorter texts."""

from moraine.llm import jaccard

from . import plain


def test_near_copies_of_a_long_text_have_a_leader_of_their_size(spark, monkeypatch):
    words = [f"w{k}" for k in range(150)]
    texts = [" ".join(words[a : a + 87]) for a in (0, 32, 63)]  # unedited, but too short to link with the copies
    for k in range(60):
        texts.append(" ".join([*words[: 2 * k + 5], f"edit{k}", *words[2 * k + 6 :]]))
    pairs, keep = [], jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda p, sets: pairs.append(p.distinct().count()) or keep(p, sets))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(docs).collect()}
    assert got == plain.components(dict(enumerate(texts)))
    assert len({got[k][1] for k in range(3, 63)}) == 1
    assert sum(pairs) < 500, pairs  # of 1,770 pairs of copies
