"""From raw documents to a mix of token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and all documents that its predecessor
kept; its result is written to the session's shared folder and read again as
the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressio.llm import bpe, line_dedup, minhash, mixing, quality
from pressio.llm._common import shared_folder, table


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, keeps."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that occur alike at an earlier place."""
    return line_dedup.drop_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 over 5-word shingles."""
    return minhash.distinct_documents(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes from each document, a row per pass."""
    return mixing.mix_texts(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and whether they decode to its text."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.decode(bpe.encode(docs.select("doc_id", "source", "text"), vocabulary), vocabulary)
    return done.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("BPE encoding", tokenise),
]

# A fitted classifier decides what the first stage keeps: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = shared_folder(spark, f"corpus-stage-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
