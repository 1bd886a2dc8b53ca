"""From raw documents to tokens: five stages over the ``documents`` table.

Each stage takes what its predecessor kept, whole, and all but the last return the columns of ``documents``. ``run``
writes each stage's rows to the shared folder and reads them again. A null or empty text fails the quality rules; null
ids, languages and sources, repeated rows, extra columns and empty tables go through as the operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardline.llm.bpe import encode_and_decode
from yardline.llm.common import settle
from yardline.llm.decontaminate import find_leaks
from yardline.llm.quality_rules import judge
from yardline.llm.simhash import drop_near_duplicates
from yardline.llm.suffix_trees import remove_repeated_words

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")  # the file's place on every executor


def _held(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``; others, which may have names that operators use, travel as one."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in COLUMNS]
    return docs.select(*COLUMNS, *([F.struct(*others).alias("other_columns")] if others else []))


def _given_back(out: DataFrame, *more: str) -> DataFrame:
    others = ["other_columns.*"] if "other_columns" in out.columns else []
    return out.select(*COLUMNS, *others, *more)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or their group's fences reject go."""
    return _given_back(judge(_held(docs)).filter("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, with the fingerprints and the distance of the operator's contract."""
    return _given_back(drop_near_duplicates(_held(docs), shingle=3, distance=3))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that a 50-word window of an earlier document covers go. A text that loses none stays as it is."""
    out = remove_repeated_words(_held(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    size = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return _given_back(out.withColumns({"text": text, "n_chars": size}))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a near copy of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _given_back(find_leaks(_held(docs), benchmark).filter(F.size("leaks") == 0))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their number, and the text that they decode to."""
    out = encode_and_decode(_held(docs), VOCABULARY)
    return _given_back(out.withColumn("n_tokens", F.size("token_ids").cast("long")), "token_ids", "n_tokens", "decoded")


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontaminate),
    ("bpe", tokenize),
]

#: The byte-pair merges of the last stage are not SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs, _ = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
