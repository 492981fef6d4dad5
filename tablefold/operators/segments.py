"""Cutting a search into file-size ranges that stay below a result limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_LIMIT = 1000  # fixed value
# Quartiles of file size in bytes.
SIZE_BOUNDS = [256, 2750, 4756, 23459, 53531]


def needs_segmenting(df: DataFrame, limit: int = RESULT_LIMIT) -> DataFrame:
    return df.withColumn("segmented", F.col("total_count") > limit)


def _ranges(bounds: list[int]) -> Column:
    pairs = [
        F.struct(F.lit(i).alias("range_pos"), F.lit(lo).alias("range_lo"), F.lit(hi).alias("range_hi"))
        for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))
    ]
    return F.explode(F.array(*pairs))


def size_steps(topic_counts: DataFrame, bounds: list[int] = SIZE_BOUNDS) -> DataFrame:
    """Per topic and size range: the step, its whole part and the number of points."""
    span = F.col("range_hi") - F.col("range_lo")
    step = F.greatest(span / (F.lit(0.25) * F.col("total_count") / F.lit(1000)), F.lit(5.0))
    return (
        topic_counts.select("topic", "total_count", _ranges(bounds).alias("r"))
        .select("topic", "total_count", "r.*")
        .withColumn("step", step)
        .withColumn("whole_step", F.floor("step"))
        .withColumn("n_points", F.ceil(span / F.col("step")))
    )


def segment_sizes(topic_counts: DataFrame, bounds: list[int] = SIZE_BOUNDS, mode: str = "cover") -> DataFrame:
    """``(topic, range_pos, segment_pos, lo, hi)`` of the size ranges to ask for.

    Neighbouring points form a segment. ``reference`` leaves the stretch from the
    last point to the end of the range unasked; ``cover`` adds it.
    """
    steps = size_steps(topic_counts, bounds)
    last = F.col("n_points") - (1 if mode == "cover" else 2)
    start = lambda i: F.col("range_lo") + i * F.col("whole_step")
    segments = steps.filter(last >= 0).withColumn("segment_pos", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    pos = F.col("segment_pos")
    hi = F.when(pos == F.col("n_points") - 1, F.col("range_hi").cast("bigint")).otherwise(start(pos + 1))
    return segments.select("topic", "range_pos", "segment_pos", start(pos).alias("lo"), hi.alias("hi"))


def assign_segments(
    files: DataFrame, topic_counts: DataFrame, bounds: list[int] = SIZE_BOUNDS, mode: str = "cover"
) -> DataFrame:
    """Rows of ``files(topic, size, ...)`` with each segment they fall in, ends included.

    The segments of a range are evenly spaced, so a size gives its segment by
    arithmetic; only the few numbers per topic are joined, not the segments.
    """
    steps = size_steps(topic_counts, bounds).drop("total_count", "step")
    per_topic = steps.groupBy("topic").agg(
        F.collect_list(F.struct("range_pos", "range_lo", "range_hi", "whole_step", "n_points")).alias("ranges")
    )
    joined = files.join(per_topic, "topic")
    inside = joined.select(*files.columns, F.explode("ranges").alias("r")).filter(
        F.col("size").between(F.col("r.range_lo"), F.col("r.range_hi"))
    )
    offset = F.col("size") - F.col("r.range_lo")
    last = F.col("r.n_points") - (1 if mode == "cover" else 2)
    own = F.least(F.floor(offset / F.col("r.whole_step")), F.col("r.n_points") - 1)
    on_point = (own >= 1) & (offset == own * F.col("r.whole_step"))
    picked = F.when(on_point, F.array(own - 1, own)).otherwise(F.array(own))
    start = lambda i: F.col("r.range_lo") + i * F.col("r.whole_step")
    pos = F.col("segment_pos")
    hi = F.when(pos == F.col("r.n_points") - 1, F.col("r.range_hi").cast("bigint")).otherwise(start(pos + 1))
    return (
        inside.withColumn("segment_pos", F.explode(picked))
        .filter((pos <= last) & (F.col("size") <= hi))
        .select(*files.columns, F.col("r.range_pos").alias("range_pos"), "segment_pos", start(pos).alias("lo"), hi.alias("hi"))
    )


def segment_stats(
    files: DataFrame, topic_counts: DataFrame, bounds: list[int] = SIZE_BOUNDS, mode: str = "cover"
) -> DataFrame:
    """Per topic: number of points, mean and population deviation of results per segment, steps."""
    segments = segment_sizes(topic_counts, bounds, mode)
    found = (
        assign_segments(files, topic_counts, bounds, mode)
        .groupBy("topic", "range_pos", "segment_pos")
        .agg(F.count("*").alias("n"))
    )
    results = segments.join(found, ["topic", "range_pos", "segment_pos"], "left").fillna(0, ["n"])
    sizes = results.groupBy("topic").agg(
        F.count("*").alias("n_segments"),
        F.avg("n").alias("mean_results"),
        F.stddev_pop("n").alias("std_results"),
    )
    steps = size_steps(topic_counts, bounds).groupBy("topic").agg(
        F.sum("n_points").alias("n_queries"),
        F.transform(F.sort_array(F.collect_list(F.struct("range_pos", "step"))), lambda s: s["step"]).alias("steps"),
    )
    return steps.join(sizes, "topic", "left")
