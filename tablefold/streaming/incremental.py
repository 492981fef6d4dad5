"""Take up newly landed topics, or newly landed files of topics, only.

Landed manifests are read as a stream that ends when it has caught up, so the
checkpoint remembers what it has seen. ``process_pending`` hands each batch of
unfinished topics to the caller, whole; ``count_landed`` counts the new files of a
topic alone and adds their counts to those of earlier batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefold import sinks
from tablefold.operators.names import pending_topics
from tablefold.plans import topic_counts
from tablefold.plans.corpus import Corpus
from tablefold.session import cut_lineage

MANIFEST = "topic string, url_pos bigint, url string, file_name string"


def process_pending(
    spark: SparkSession, landing: str, finished: str, checkpoint: str, handle: Callable[[DataFrame], None]
) -> None:
    """Call ``handle`` with all landed URL rows of each topic that has new ones and is not finished.

    A topic is finished when its statistics count as many files as have landed; one
    that goes on landing is handled again as a whole. ``handle`` must write the
    topic statistics last, as they mark a topic finished.
    """
    def run(batch: DataFrame, _batch_id: int) -> None:
        landed = spark.read.schema(MANIFEST).parquet(landing).filter(F.col("url").isNotNull())
        counts = landed.groupBy("topic").agg(F.count("*").alias("landed"))
        done = sinks.read_finished(spark, finished).join(counts, "topic").filter(F.col("files") >= F.col("landed"))
        todo = pending_topics(batch.select("topic").distinct(), landed, done)
        handle(landed.join(todo, "topic", "left_semi"))

    (
        spark.readStream.schema(MANIFEST)
        .parquet(landing)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def count_landed(
    spark: SparkSession, landing: str, out: str, checkpoint: str, make: Callable[[DataFrame, DataFrame, int], Corpus]
) -> None:
    """Count newly landed URLs of all topics and keep their counts by batch below ``out``.

    ``make(manifest, batch, number)`` returns the ``Corpus`` of a batch: ``manifest``
    holds all URLs landed so far of the batch's topics, which names need, and
    ``batch`` the new ones, to be its ``only``. Its ``files`` need to hold the batch's
    content alone. A URL is ``(topic, url_pos)``; one that an earlier batch has
    counted is left out, so landing it again changes nothing, and neither does a
    batch that Spark repeats after a failure: it writes the same partitions again,
    its list of URLs last. Content has to have landed when its URL does. ``topic_counts.read_counts`` adds the batches up.
    """

    def run(batch: DataFrame, number: int) -> None:
        new = batch.filter(F.col("url").isNotNull()).dropDuplicates(["topic", "url_pos"])
        try:
            seen = spark.read.schema("topic string, url_pos bigint, batch bigint").parquet(f"{out}/urls")
            new = new.join(seen.filter(F.col("batch") != number), ["topic", "url_pos"], "left_anti")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        new = cut_lineage(new)
        if new.isEmpty():
            return
        landed = spark.read.schema(MANIFEST).parquet(landing).filter(F.col("url").isNotNull())
        landed = landed.join(new.select("topic").distinct(), "topic", "left_semi").dropDuplicates(["topic", "url_pos"])
        topic_counts.write_counts(topic_counts.topic_counts(make(landed, new, number)), f"{out}/counts", number)
        listed = new.select("topic", "url_pos", F.lit(number).cast("bigint").alias("batch"))
        listed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/urls")

    (
        spark.readStream.schema(MANIFEST)
        .parquet(landing)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
