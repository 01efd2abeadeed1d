"""The training-data pipeline: five stages, each one of the operators over all that the one before kept.

For every stage: columns other than those of documents are dropped, so clashing names
don't matter; an empty table stays empty; texts are taken whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.llm import linededup, mixing, neardup, neighbours, queries, spm
from samplewright.llm.shared import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Columns of documents; a stage that changes the text counts its characters again.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score of 0.7 or more); every row of them.

    Null and empty texts score the share of good ones among the labelled texts, so they
    stay if that is 0.7 or more; repeated rows and null ids are judged by their texts alike.
    """
    scored = neighbours.predict(docs, queries.quality_labels(spark, sf_dir))
    return scored.where("predicted = 1").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier runs of 50 words or more; one goes if none of its words are left.

    Earlier: of smaller doc_id, null last. Null and empty texts stay; repeated rows are one
    document, treated alike. n_chars is counted again where lines went.
    """
    rest = linededup.dedup_lines(docs)
    left = (F.col("n_deleted") == 0) | F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    return rest.where(left).withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): that of the smallest doc_id.

    Of several texts of that id one stays, and of repeated rows one. Texts without words,
    null and empty ones too, are no duplicates of others. Null ids come last.
    """
    return neardup.drop_near_duplicates(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target takes them, three times at most; a document taken twice is two rows.

    Sources by code point, null last, weigh 5, 2, 1, repeating. Repeated rows are taken
    alike. Texts without words weigh nothing and go with the hash of their row.
    """
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, round_trip of each row, repeated rows included; null texts have null ids, empty ones none."""
    return spm.encode_texts(docs, queries.PIECE_MODEL)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("SentencePiece encoding", encode),
]

#: SQL can express neither the classifier nor the encoder; tests/llm/test_pipeline.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again, and its own tables dropped."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
