"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes the documents that the one before it kept, written as Parquet and read again. All but the last return
the columns of ``documents``.

1. Quality classifier: documents predicted as bad go.
2. Exact dedup: of equal texts the row with the largest id stays.
3. N-gram Jaccard join: of each group of linked documents the one with the smallest id stays.
4. Mixing: documents occur as often as their rates say, so that the expected share of toxic words falls to TARGETS.
   TOTAL is large enough that documents that are clean beyond doubt have a rate above one and all stay.
5. SentencePiece: token ids of every document, with the proof that they decode to its text.

The second stage alone could be SQL; the others cannot, so there is no ORACLE_SQL. ``tests/llm/test_pipeline.py`` holds
each stage against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing, queries, ranking, signature_tree, viterbi
from tidemark.llm.shared import written

DOMAINS = ["clean", "toxic"]
TARGETS = {"clean": 0.96, "toxic": 0.04}
TOTAL = 1.25  # expected words after mixing, relative to those before

ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ranking.keep_good(docs, _labels(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return signature_tree.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = _labels(spark, sf_dir).where("toxic is not null")
    labels = labels.select("doc_id", (F.col("toxic") > 0).cast("int").alias("domain"))
    return mixing.mixed(docs, mixing.train(docs, labels, DOMAINS, F.lit(True)), TARGETS, TOTAL)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids (little-endian, 4 bytes each) and round_trip of every document."""
    given = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    encoded = viterbi.encode(docs.select("doc_id", "text", given.alias("given")), queries.PIECE_MODEL, carry=("given",))
    back = viterbi.decode(encoded, queries.PIECE_MODEL)
    return back.select("doc_id", "n_pieces", "ids", (F.md5(F.col("text").cast("binary")) == F.col("given")).alias("round_trip"))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix),
    ("SentencePiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
