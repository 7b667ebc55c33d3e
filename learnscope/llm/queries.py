"""Registered queries of the corpus operators and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole
table and returns the full result; the digest columns a query must return are
derived here from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bwt_dedup, credentials, decontaminate, importance, license_scan, line_templates, nbsvm, quality_cascade, recompression, simhash_vptree, source_mix, sql, token_alignment, token_counts
from .common import WORDS, materialize, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    if found := getattr(sql, fn.__name__, None):
        ORACLES[fn.__name__] = found
    return fn


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """The classifier fitted on the rows that are not held out."""
    labels = nbsvm.one_label(read(spark, sf_dir, "labels").filter(~held_out()))
    return nbsvm.fit(docs, labels)


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = nbsvm.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = license_scan.known_digests(spark)
    table = materialize(license_scan.digests(read(spark, sf_dir, "documents"), known), "license-digests")
    lines = license_scan.license_lines(table, known).groupBy("doc_id").agg(
        F.sum("n_lines").alias("n_license_lines"), F.array_join(F.array_sort(F.collect_set("license")), ", ").alias("line_licenses")
    )  # a document's set is bounded by the known licences
    return license_scan.known_licenses(table, known).join(lines, "doc_id", "left").select(
        "doc_id", "canonical_sha256", "canonical_length", "license", F.coalesce("n_license_lines", F.lit(0)).alias("n_license_lines"), "line_licenses"
    )


@query
def op3_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.dedup(read(spark, sf_dir, "documents"), window=13)


@query
def op4_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.dedup(read(spark, sf_dir, "documents"), length=50)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix of a documents table, each document with its own source."""
    docs = docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).alias("size"), F.array(F.col("source").cast("string")).alias("sources"))
    taken, sources = source_mix.mix(docs)
    out = taken.withColumn("source", F.col("sources")[0]).drop("sources")
    sources = sources.withColumnRenamed("source", "_s")  # one row per source, at most as many as patterns
    return out.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_cascade.cascade(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_templates.drop_recurring(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = token_counts.length_histogram(read(spark, sf_dir, "documents"), token_counts.rank_file_encoder(spark))
    return token_counts.suffix_sums(materialize(hist, "token-lengths"))  # it is read twice


@query
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.scan(read(spark, sf_dir, "documents"))
    counts = (F.size(F.filter("base", lambda s: s["kind"] == credentials.KINDS.index(k))).cast("long").alias(f"n_{k}") for k in credentials.BASE)  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(credentials.spelled(F.col("base")), 256).alias("base_sha256"), credentials.spelled(F.col("spans")).alias("spans"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(read(spark, sf_dir, "documents"))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = importance.score(docs, read(spark, sf_dir, "benchmark")).drop("text")
    return importance.ranked(scored, 25, F.col("n_words") >= 20).select("doc_id", "n_features", "weight", "score", "rank")
