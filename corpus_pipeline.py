"""The corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept, reread from Parquet. The first four
return the columns of documents: the first drops rejected documents, the second keeps one document of each group, the
third removes repeated passages from the texts, the fourth replaces personal data; the last returns the pieces of
packed sequences. Quality rules are fitted on labels below sf_dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from asofia.llm import hilbert_pack, pii, prefix_free, quality_rules, simhash_forest
from asofia.llm.common import made, materialise, remove_dirs, table
from asofia.session import ready


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, rules)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_forest.drop_near_duplicates(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return prefix_free.drop_repeats(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hilbert_pack.pack(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeats),
    ("personal_data", redact),
    ("packing", pack),
]

#: SQL can't express the learned rules, the fingerprints or the packing; tests/llm compares with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage left in the shared folder goes as soon as its result is written."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = set(made())
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        remove_dirs(u for u in made()[:-1] if u not in before or "/stage-" in u)
    return STAGES[-1][1](spark, docs, sf_dir)
