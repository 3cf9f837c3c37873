"""From raw documents to token ids: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``; every stage works on all rows its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffline.llm import op2_language_id as op2
from staffline.llm import op3_decontamination as op3
from staffline.llm import op4_jaccard_join as op4
from staffline.llm import op7_sentencepiece as op7
from staffline.llm import op10_toxicity as op10
from staffline.llm.common import materialize, prepare, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return op10.drop_toxic(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learnt language; texts without a letter go."""
    prepare(spark)
    return op2.drop_unknown(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents."""
    prepare(spark)
    return op4.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget."""
    return op3.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, and the text those decode to."""
    prepare(spark)
    coded = op7.encode_decode(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    return coded.select("doc_id", F.col("decoded").alias("text"), "lang", "source", "n_chars",
                        F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: the stages are not expressible in SQL; tests compare them with brute-force versions
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
