"""What the tasks of the pipeline's stages hold at once."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from moraine.llm import batches, decontamination, jaccard, toxicity


def _peak(code, batch):
    """MB that a task's code has at once on top of its batch."""
    tracemalloc.start()
    try:
        for _ in code(iter([batch])):
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_tasks_hold_few_texts_at_once(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(3200)]  # over 8 MB
    docs = spark.createDataFrame([(i, f"{t[:60]} {'idiot scum' if i % 4 == 0 else 'fine'}") for i, t in enumerate(texts[:40])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([(1, " ".join(words[:40]))], "item_id long, text string")
    codes, kind = [], type(docs)
    keep = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a, **k: codes.append(f) or keep(self, f, *a, **k))
    toxicity.score(docs, labels)
    assert len(codes) == 3  # stems, votes, scores
    decontamination.decontaminate(docs, benchmark)
    jaccard.members(docs, 0.3)
    text = pa.array(texts)
    doc = pa.StructArray.from_arrays([pa.array(range(len(texts))), text], names=["doc_id", "text"])
    columns = {"doc": doc, "doc_id": doc.field(0), "text": text, "toxic": pa.array([0, 1] * 1600, pa.int32()), "held_out": pa.array([False] * 3200)}
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    peaks = [round(_peak(code, batch)) for code in codes]
    assert max(peaks) < 100, peaks


def test_stems_summed_over_slices(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("stupid dumm idiota walk house garden".split(), k=rng.randint(0, 9))) for _ in range(300)]
    toxic = np.array([rng.randint(0, 1) for _ in texts])
    whole = toxicity._stem_counts(*batches.utf8(pa.array(texts)), toxic)
    parts = [toxicity._stem_counts(*batches.utf8(pa.array(texts[a : a + 7])), toxic[a : a + 7]) for a in range(0, 300, 7)]
    assert np.array_equal(toxicity._summed(np.hstack(parts)), whole)
    for word in ("stupid", "garden"):
        at = np.flatnonzero(whole[0] == np.array([toxicity._word_hash(word)], np.uint64).view(np.int64)[0])[0]
        own = np.array([word in t.split() for t in texts])
        assert whole[1:, at].tolist() == [own.sum(), toxic[own].sum()]
    assert toxicity._summed(np.zeros((3, 0), np.int64)).shape == (3, 0)
