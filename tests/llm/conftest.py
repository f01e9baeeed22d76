import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


LONG = "word " * 60_000 + "end"
COPY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
# Nulls, empty, blank, very long, repeated rows, ids that repeat, no id at all.
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n \n", "en", None, 5),
    (4, LONG, "en", "a", len(LONG)),
    (5, COPY, "en", "b", len(COPY)),
    (5, COPY, "en", "b", len(COPY)),
    (6, COPY, None, "b", len(COPY)),
    (7, "\n".join([COPY, "Ünïcode 'tis 日本語 \U0001f600 x", "", COPY]), "de", "b", 1),
    (7, "another text under the same id", "de", "b", 1),
    (None, "a text without an id", "en", "b", 1),
    (None, "a text without an id", "en", "b", 1),
    (None, COPY + " more", "en", None, None),
    (8, "x" * 5000, "en", "c", 5000),
    (9, "ab" * 2500, "en", "c", 5000),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves.
CLASHING = ("doc", "id", "tie", "cls", "chunk", "digest", "h", "hb", "fb", "at", "positions", "matches", "score", "kept", "n", "pos", "shard_no")


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(AWKWARD, COLUMNS).withColumns({c: F.lit("own") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 0, 1), (None, 1, 1), (4, None, None), (5, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture(scope="session")
def benchmark_items(spark):
    return spark.createDataFrame(
        [(1, COPY), (1, COPY), (2, None), (3, ""), (None, "five words are just enough"), (4, "two words"), (5, LONG)],
        "item_id long, text string",
    )
