"""The corpus pipeline: each stage's rows are written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litwire.llm import jaccard, langid, lines, mixing, pieces
from litwire.llm.queries import PIECE_MODEL, TARGETS, label_domains
from litwire.session import cut, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text whose n-grams are nearer to no language than this is none's.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without letters, or too far from all, go."""
    ship_package(spark)
    rows = langid.train_and_identify(docs)
    return rows.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; a document that loses all its lines goes."""
    ship_package(spark)
    rows = lines.dedup_lines(docs)
    left = (F.col("n_dropped") == 0) | (F.trim("text", F.lit(" \t\n\x0b\x0c\r")) != "")
    return rows.where(left).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return jaccard.one_per_component(docs).select(*COLUMNS)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say."""
    ship_package(spark)
    labelled = label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.mixed_documents(docs, labelled, TARGETS).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as piece ids, with the number of pieces and whether they decode to the text."""
    ship_package(spark)
    rows = pieces.encode_and_decode(docs, PIECE_MODEL)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "lang", "source", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), same.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", dedup_documents),
    ("source_mixing", mix_domains),
    ("sentencepiece", encode_pieces),
]
#: Profiles, mixing and pieces are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
