"""Corpus pipeline: five stages over the documents table, each calling one
operator of ``learnscope.llm`` on everything its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All stages but the last
return the columns of documents; the last returns one row per document with the
words the mix takes of it (0: none).

Defined cases: nulls, empty and very long texts, ties, repeated rows and empty
tables are handled as the operators' docstrings say; ``n_chars`` follows the
text where a stage changes it; columns beyond those of documents are kept by the
stages that return documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnscope.llm import decontaminate, line_templates, nbsvm, queries, simhash_vptree, source_mix
from learnscope.llm.common import discard, fresh, materialize, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more."""
    model = queries.quality_model(spark, docs, sf_dir)
    return nbsvm.keep(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines out of every document but the first that has them."""
    counts = fresh(docs, "_n_lines", "_n_removed")
    out = line_templates.drop_recurring(docs, counts=tuple(counts))
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(counts[1]) > 0, changed).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within two bits."""
    return simhash_vptree.keep_first(docs, shingle=3, radius=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: words taken of every document."""
    return queries.mixed(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mix),
]

#: XXH64 fingerprints and the fitted classifier have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
        if before is not None:
            discard(before)
        before = docs
    return docs
