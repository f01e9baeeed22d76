"""Each stage of the pipeline against its rule, stated plainly over the stage's own input."""

import pytest

import corpus_pipeline as pipeline
from moraine.llm import bpe, decontamination, toxicity

from . import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output rows of every stage, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(folder / str(k)))
        after = spark.read.parquet(str(folder / str(k)))
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(steps):
    for before, after in steps[:-1]:
        assert set(after.columns) == set(before.columns)


def test_toxicity_stage(spark, steps):
    before, after = steps[0]
    rated = toxicity.score(before, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"))
    assert set(rows(after)) == {r.doc_id for r in rated.where("predicted = 0").select("doc.doc_id").collect()}


def test_line_stage(steps):
    before, after = map(rows, steps[1])
    ids = list(before)
    want = plain.line_dedup([(i, before[i].text) for i in ids])
    for i, (_, _, text) in zip(ids, want):
        assert after[i].text == text and after[i].n_chars == len(text)
    assert len(after) == len(before)


def test_near_duplicate_stage(steps):
    before, after = map(rows, steps[2])
    want = plain.components({i: r.text for i, r in before.items()})
    assert set(after) == {c for _, c in want.values()}


def test_decontamination_stage(spark, steps):
    before, after = map(rows, steps[3])
    found = decontamination.decontaminate(steps[3][0], spark.read.parquet(f"{SF}/benchmark.parquet"))
    bad = {r.doc_id for r in found.where("size(matches) > 0").select("doc.doc_id").collect()}
    assert set(after) == set(before) - bad
    items = [plain.WORD.findall(r.text.translate(plain.LOWER)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, r in before.items():
        words = " ".join(plain.WORD.findall((r.text or "").translate(plain.LOWER)))
        if any(f" {' '.join(w)} " in f" {words} " for w in items):
            assert i in bad


def test_encoding_stage(steps):
    before, after = map(rows, steps[4])
    token = bpe.ranks(bpe.vocabulary()).token
    assert set(before) == set(after)
    for i, r in after.items():
        assert b"".join(token[t] for t in r.ids) == (before[i].text or "").encode() and r.n_tokens == len(r.ids)


def test_run_gives_the_last_stage(spark, steps):
    got = {r.doc_id: r.ids for r in pipeline.run(spark, SF).collect()}
    assert got == {i: r.ids for i, r in rows(steps[-1][1]).items()}


def test_stages_on_awkward_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs.collect()


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(30))
    other = " ".join(f"v{k}" for k in range(30))
    plan = [
        (1, text), (1, text), (1, text + " more"), (None, text), (2, text),
        (None, other), (None, other), (None, other + " more"), (3, "alone"), (None, "by itself"), (4, ""), (4, ""), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in plan], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, (r.text or "")[:2]) for r in pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(1, "w0"), (None, "v0"), (3, "al"), (None, "by"), (4, ""), (4, ""), (None, "")], key=str)
