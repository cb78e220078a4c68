"""From raw documents to packed sequences: five stages, each written and read again.

Stages before the last return the columns of ``documents``. Each takes all rows that the one
before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import jaccard_join, language, line_runs, mixing, packing
from riskloom.llm.common import keep, scratch_path
from riskloom.llm.queries import WEIGHTS, domain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A text whose leading language has less than this share is rejected, like one without letters.
# At 0 none is: texts in several languages stay.
LEAST_SHARE = 0.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, and a leading language of at least ``LEAST_SHARE``; ``lang`` names it.

    The label teaches the model only: a null one is filled, and one that most words contradict is
    replaced, so the mix weighs a document by the language of its text.
    """
    found = language.identify(docs, language.learn(docs), keep=[c for c in COLUMNS if c != "lang"])
    known = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return known.withColumnRenamed("lang_pred", "lang").select(COLUMNS)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occur earlier; those with nothing left go."""
    done = line_runs.without_repeated_lines(docs)
    shorter = F.col("n_removed") > 0
    return done.filter(~shorter | (F.trim("text") != "")).select(
        "doc.doc_id", "text", "doc.lang", "doc.source",
        F.when(shorter, F.length("text").cast("long")).otherwise(F.col("doc.n_chars")).alias("n_chars"),
    )


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of every group of near duplicates; rows without an id come last."""
    # Rows are told apart by a number that is stored, so that every read finds the same one.
    rows = keep(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered-rows")
    groups = jaccard_join.near_duplicates(rows, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")
    least = rows.join(groups, "_row").groupBy("component_id").agg(F.min(order).alias("_least"))
    return rows.join(least.select("_least._row"), "_row", "left_semi").select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of whole documents whose tokens follow the target weights."""
    return mixing.mixed_rows(docs, domain(), WEIGHTS, budget_share=0.6, max_epochs=1).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with a checksum of their ids."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("lines", new_lines),
    ("near_duplicates", one_of_each),
    ("mix", mixed),
    ("pack", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a stored table between one and the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


# Language shares, tokens and hash orders are not expressible in SQL.
ORACLE_SQL = None
