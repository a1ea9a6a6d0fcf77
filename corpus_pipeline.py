"""A training corpus from raw documents, stage by stage; each stage is one operator of cuelake.llm.

Every stage but the last returns the columns of its input. Languages: texts without a letter go, and
those of which no language holds half. Near duplicates: the smallest doc_id of a group stays.
Benchmark: documents that hold a test item go. Secrets: their characters are replaced, the
document stays. Mixing: the result is the mix, as word ranges of documents by output shard and slot.

Rows with a null doc_id pass the second and third stage (they cannot be named, nor compared by id)
unless they hold a test item; each is judged by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm import decontaminate, language, mixing, secrets, simhash
from cuelake.llm.common import fresh, read, stage

LEAST_SHARE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    label, share, languages = added = tuple(fresh(docs, x) for x in ("label", "share", "languages"))
    named = language.identify(docs, *language.train(docs), names=added)
    return named.where((F.col(label) != "und") & (F.col(share) >= LEAST_SHARE)).drop(*added)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_groups(docs)


def no_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = fresh(docs, "row")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    named = rows.select(F.col(row).alias("doc_id"), "text")
    leaked = decontaminate.leaks(named, read(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(leaked, row, "left_anti").select(*docs.columns)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return clean.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(spark, docs)


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_each),
    ("benchmark", no_test_items),
    ("secrets", no_secrets),
    ("mix", mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
