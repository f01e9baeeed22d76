"""Corpus pipeline over ``documents``: five stages, each written and read again.

Toxic documents go; lines found in ten documents or more go; of each group of
near-duplicates the document of the least id stays; documents that hold a
benchmark item go; what is left is encoded. Each stage works on all that its
predecessor kept. A text that changes gets its new length in ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm.bpe import encode, vocabulary
from moraine.llm.decontamination import decontaminate
from moraine.llm.jaccard import link_documents
from moraine.llm.line_dedup import line_dedup
from moraine.llm.toxicity import score
from moraine.sources.shared import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the classifier is trained on these documents' labels."""
    rated = score(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return rated.where("predicted = 0").select("doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without its lines that ten documents or more hold."""
    cut = line_dedup(docs.select(*COLUMNS)).select("doc.*", "kept_text")
    return cut.withColumns({"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays, by least id, text and other columns; texts without words all stay."""
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("t"), F.xxhash64(*COLUMNS).alias("r"))
    keyed = docs.select(*COLUMNS, key.alias("key"))
    linked = link_documents(keyed.select("key", "text"), "key")
    least = linked.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = least.groupBy(F.col("doc_id").alias("kept"), (F.col("n_shingles") > 0).alias("words")).count()
    own = F.col("key").eqNullSafe(F.col("kept"))
    # A row that is there several times stays once.
    once = keyed.join(kept.where("count = 1 or not words"), own, "left_semi")
    again = keyed.join(kept.where("count > 1 and words"), own, "left_semi").dropDuplicates(["key"])
    return once.unionAll(again).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a passage much like one, go."""
    found = decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("matches") == 0).select("doc.*")


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids) of each document left."""
    encoded = encode(docs, vocabulary(), carry=["doc_id", "lang", "source"])
    return encoded.select("doc.*", "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode_bpe),
]

# A trained classifier, a rank file and fuzzy matching are beyond SQL; tests/llm compares
# every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
