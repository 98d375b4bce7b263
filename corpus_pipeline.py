"""The training-data pipeline: documents in, a mix of clean, distinct documents out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdelta.llm import decontam, lines, mixing, neardup, toxicity
from rankdelta.llm.common import written
from rankdelta.llm.queries import read


def _free(docs: DataFrame, name: str) -> str:
    """``name``, longer if ``docs`` has such a column."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores under 0.5."""
    columns = docs.columns
    score = _free(docs, "toxicity_score")
    scored = toxicity.with_scores(docs, read(spark, sf_dir, "labels"), column=score)
    return scored.filter(F.col(score) < 0.5).select(*columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; n_chars follows the text."""
    columns = docs.columns
    # columns of the names that the operator gives keep their values
    aside = {c: _free(docs, f"own_{c}") for c in ("n_lines", "n_dropped") if c in columns}
    out = lines.drop_shared_lines(docs.withColumnsRenamed(aside))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id."""
    return neardup.keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document that is left."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "n_copies", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

#: the first and the last stage have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
