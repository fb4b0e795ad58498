"""From documents to a training mix: five stages, each one written and reread as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.llm import decontaminate, jaccard, mixing, quality, secrets
from pressroom.llm.session import SMALL_BATCH_ROWS, free_name, ready
from pressroom.session import settle


def _with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number for each row, so that equal and null ids don't mix rows up, and the name of that column, which no other has.

    ``docs`` is a written table, and the numbers are written here with it, so a lost executor can't change them.
    """
    name = free_name(docs, "_row")
    return settle(docs.withColumn(name, F.monotonically_increasing_id())), name


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. It learns from the labels of the documents that are here; without
    labels of both kinds all stay."""
    ready(spark, SMALL_BATCH_ROWS)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, directly or over others, the one with the smallest id stays.

    Documents without words link with nothing and stay. The groups are found over row numbers in the order of the ids (null last), so rows with equal
    ids are told apart.
    """
    ready(spark, SMALL_BATCH_ROWS)
    numbered, number = _with_rows(docs)
    groups = settle(jaccard.jaccard_components(numbered.select(F.col(number).alias("doc_id"), "text")))
    ids = numbered.select(F.col(number).alias("row"), "doc_id")
    members = groups.join(ids.withColumnRenamed("doc_id", "id"), F.col("doc_id") == F.col("row"))
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first"))
    gone = settle(members.join(first, "component_id").filter("row <> first.row").select(F.col("row").alias(number)))
    return numbered.join(gone, number, "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    ready(spark, SMALL_BATCH_ROWS)
    numbered, number = _with_rows(docs)
    found = decontaminate.decontaminate(numbered.select(F.col(number).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), reach=0)
    hit = settle(found.filter("contaminated").select(F.col("doc_id").alias(number)))
    return numbered.join(hit, number, "left_anti").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced; ``n_chars`` is counted again where a text changed."""
    ready(spark, SMALL_BATCH_ROWS)
    before = free_name(docs, "_text")
    clean = secrets.redact(docs.withColumn(before, F.xxhash64("text")))
    if "n_chars" in docs.columns:
        changed = F.col(before) != F.xxhash64("text")
        clean = clean.withColumn("n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target weight asks for, shuffled; with ``copy`` and ``place``."""
    ready(spark, SMALL_BATCH_ROWS)
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
]
#: Trained models decide in two stages, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = ready(spark, SMALL_BATCH_ROWS).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
