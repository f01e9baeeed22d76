"""Every operator on nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import collections

import pytest
from pyspark.sql import functions as F

from moraine.llm import bpe, chat, decontamination, html_text, jaccard, line_dedup, quality, sharding, suffix_dedup, toxicity

from . import plain
from .conftest import AWKWARD, COPY

N = len(AWKWARD)


def test_line_dedup(awkward, empty):
    rows = line_dedup.line_dedup(awkward, min_docs=3).select("doc.doc_id", "doc.text", "doc.h", "n_lines", "n_dropped", "kept_text").collect()
    want = plain.line_dedup([(r[0], r[1]) for r in AWKWARD], 3)
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped, r.kept_text) for r in rows)
    assert got == collections.Counter((r[0], r[1], *w) for r, w in zip(AWKWARD, want))
    assert {r.h for r in rows} == {"own"}
    assert line_dedup.line_dedup(empty).count() == 0


def test_sharding(awkward, empty):
    rows = sharding.shard(awkward, n_shards=4).collect()
    assert len(rows) == N
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(empty).count() == 0


def test_suffix_dedup(awkward, empty):
    rows = suffix_dedup.suffix_dedup(awkward).collect()
    assert len(rows) == N
    for r in rows:
        assert r.n_bytes - r.n_removed == len(r.kept) and r.kept_sha256 == plain.sha(bytes(r.kept))
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [r.n_removed for r in by[5]] == [0, 0]  # one text given twice
    assert by[6][0].n_removed == len(COPY)  # a copy of it
    assert by[4][0].n_bytes - by[4][0].n_removed == plain.suffix_dedup({4: AWKWARD[3][1]})[4][0] - plain.suffix_dedup({4: AWKWARD[3][1]})[4][1]
    assert all(r.n_removed == 0 for r in by[1] + by[2] + by[3])
    copied = next(r for r in by[None] if r.n_bytes == len(COPY) + 5)
    assert copied.n_removed == len(COPY)  # texts without an id come last
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_jaccard(awkward, empty):
    rows = jaccard.link_documents(awkward).collect()
    assert len(rows) == N
    got = collections.defaultdict(set)
    for r in rows:
        got[r.doc_id].add((r.n_shingles, r.component_id))
    assert got[1] == {(0, 1)} and got[2] == {(0, 2)} and got[3] == {(0, 3)}
    assert got[5] == got[6] == {(13, 5)}
    assert got[8] == {(1, 8)} and got[9] == {(1, 9)}
    assert {c for n, c in got[None]} == {None, 5}  # alone, and linked with the copies
    assert jaccard.link_documents(empty).count() == 0


def test_toxicity(awkward, empty, labels):
    rows = toxicity.score(awkward, labels).select("doc.*", F.col("score").alias("s"), "predicted", "held_out").collect()
    assert len(rows) == N and all(0 <= r.s <= 1 and r.predicted == (r.s >= 0.3) for r in rows)
    assert toxicity.score(empty, labels).count() == 0
    assert toxicity.score(awkward, labels.where("false")).count() == N


def test_quality(awkward, empty, labels):
    rows = quality.rate(awkward, labels).select(
        "doc.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("kept").alias("k")
    ).collect()
    assert len(rows) == N
    for r in rows:
        assert tuple(r)[1:7] == plain.quality_base(r.text)
        assert not (r.base_failed and r.k)
    assert quality.rate(empty, labels).count() == 0
    assert quality.rate(awkward, labels.where("false")).count() == N


def test_html(spark, empty):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>" + "w " * 200_000), (3, "u", "<article><p>a &amp; b</article><footer>c"), (None, "u", "<<>&#0;<a b='")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("page", F.lit("own")).withColumn("text", F.lit("own"))
    got = html_text.extract_pages(pages).select("page.page_id", "page.html", "text", "n_chars").collect()
    assert len(got) == 5 and all(len(r.text) == r.n_chars for r in got)
    texts = {(r.page_id, r.html): r.text for r in got}
    assert texts[1, None] == texts[2, ""] == "" and texts[rows[3][0], rows[3][2]] == "a & b"
    assert html_text.extract_pages(pages.where("false")).count() == 0


def test_bpe(awkward, empty):
    encoded = bpe.encode(awkward, bpe.vocabulary())
    bodies = [bytes(r.bytes) for r in bpe.decode(encoded, bpe.vocabulary()).collect()]
    assert collections.Counter(bodies) == collections.Counter((r[1] or "").encode() for r in AWKWARD)
    rows = bpe.digests(awkward, bpe.vocabulary()).collect()
    assert collections.Counter(r.decoded_sha256 for r in rows) == collections.Counter(plain.sha(r[1] or "") for r in AWKWARD)
    assert bpe.encode(empty, bpe.vocabulary()).count() == bpe.digests(empty, bpe.vocabulary()).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 24, 200])
def test_decontamination(awkward, empty, benchmark_items, block_bytes):
    rows = decontamination.decontaminate(awkward, benchmark_items, block_bytes=block_bytes).select(
        F.col("doc.doc_id").alias("i"), "doc.text", F.expr("`matches`").alias("m")
    ).collect()
    assert len(rows) == N
    for r in rows:
        items = {m.item_id for m in r.m}
        assert (1 in items) == (COPY in (r.text or "")), r.text
        assert len(items) == len(r.m)
        if r.i == 4:
            assert 5 in items
    assert decontamination.decontaminate(empty, benchmark_items).count() == 0
    assert decontamination.decontaminate(awkward, benchmark_items.where("false")).count() == N


def test_chat(spark):
    rows = [
        (1, 0, "user", "Hello?"), (1, 0, "user", "Hello?"), (1, 1, None, "Assistant: Hi.\nUser: What now?\nAssistant: Go on."),
        (1, 200, "tool", None), (None, 3, "user", "x"), (None, None, None, ""), (2, None, "system", "line\n" * 5000),
    ]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit("own")).withColumn("part", F.lit("own"))
    got = chat.format_chat(talks).collect()
    first = sorted((r.turn, r.part, r.role, r.text) for r in got if r.conv_id == 1 and r.turn < 2)
    assert first == [(0, 0, "user", "Hello?"), (1, 0, "assistant", "Hi."), (1, 1, "user", "What now?"), (1, 2, "assistant", "Go on.")]
    assert {r.text for r in got if r.conv_id is None} == {"x", ""}
    assert next(r.n_lines for r in got if r.conv_id == 2) == 5001
    assert all(r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>\n" for r in got)
    assert chat.format_chat(talks.where("false")).count() == 0
