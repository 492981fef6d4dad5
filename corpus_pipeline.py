"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefold.llm import decontaminate, language, minhash, packing, secrets
from tablefold.llm.common import id_remainder, stored, table
from tablefold.operators.joins import sized_join
from tablefold.session import shared_folder

#: A document goes if no learned language explains at least this share of it.
MIN_LANGUAGE_SHARE = 0.5
#: Most of a task's rows on their way to or from Python at once; both sides hold a batch several times over.
BATCH_BYTES = "4m"


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage that has its session send whole texts to Python in batches of ``BATCH_BYTES``."""

    @functools.wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return limited


@in_small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without letters, or mostly in no learned language, go. Columns stay as they are, whatever their names."""
    learned = docs.filter(F.coalesce(id_remainder("doc_id", 4) != 2, F.lit(True)))
    found = language.identify(docs, language.learn(learned), [F.struct("*").alias("document")])
    kept = found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("other") <= 1 - MIN_LANGUAGE_SHARE))
    return kept.select("document.*")


@in_small_batches
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest identifier, null last; of repeated rows the first read.

    Rows are told apart by their place in the stored table, so that rows which
    repeat an identifier, or have none, are judged by their own texts.
    """
    place = "_place"
    while place in docs.columns:
        place += "_"
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    found = minhash.near_duplicates(placed.select(place, "text"), threshold=0.8, id_col=place).select(F.col("doc_id").alias(place), "component_id")
    members = stored(found.join(placed.select(place, "doc_id"), place))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", place)
    first = members.groupBy("component_id").agg(F.min(order)[place].alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    gone = members.join(first, "component_id").filter(F.col(place) != F.col("_first")).select(place)
    return sized_join(placed, gone, [place], "left_anti").select(*docs.columns)


@in_small_batches
def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by the kind of secret."""
    return secrets.masked(docs, secrets.learn(docs)).withColumn("n_chars", F.length("text").cast("bigint"))


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the tokenised documents in sequences of 1024 tokens."""
    pieces = packing.token_pieces(docs)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmarks),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Language proportions and packing have no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes Parquet that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    name, stage = STAGES[-1]
    stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")
