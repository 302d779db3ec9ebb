"""A corpus pipeline over `documents`: toxic texts go, one text of each group of near
duplicates stays, strings that repeat across the rest are cut out, texts that hold
benchmark items go, and what is left is packed into training sequences.

Every stage takes an empty table, and columns named like its own.  Every stage reads all that the stage before it kept.  All but the last return the
columns of `documents`, whatever they are.  n_chars follows the text where a stage
changes it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import decontaminate, packing, simhash, suffix_dedup, toxicity
from cairn.llm.common import shared_path

#: Over 50 words, of whatever length: shorter repeats are common phrases.
REPEAT_WORDS = 51


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score 0.7 or more go (`toxicity.not_toxic`).  Null texts count as empty and stay; equal texts score alike, so repeats stay or go together; without labels of both kinds a list of insults decides."""
    return toxicity.not_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 the row of the smallest id stays (`simhash.one_of_each`).  Null and empty texts are one group; of rows equal in id and text one stays; rows without an id are in no group, and stay once for each text."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of REPEAT_WORDS words that stand twice or more are cut wherever they stand (`suffix_dedup.without_repeated_words`); no row goes.  Null texts stay null, and a text of nothing else becomes empty."""
    out = suffix_dedup.without_repeated_words(docs, REPEAT_WORDS)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose texts hold an item go (`decontaminate.without_leaks`).  Null and empty texts hold none, null and empty items are held by none; with an empty benchmark all rows stay."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each text (`packing.packed_pieces`).  Null texts are packed as empty ones, of one id; rows of equal text are packed each for itself."""
    return packing.packed_pieces(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack_sequences),
]

#: Trained trees, fingerprints and alignment have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
