"""File names, samples and counts of a URL manifest.

A manifest is ``(topic, url_pos, url, file_name)`` with ``url_pos`` unique per topic.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold.functions import text
from tablefold.operators.numbering import places, row_index, running_total, top_k


def dedup_file_names(manifest: DataFrame, mode: str = "exact", base: str = "cut") -> DataFrame:
    """Adds ``unique_name``: repeats of a name get a numeric suffix in URL order.

    ``exact`` numbers the repeats 1, 2, ... ``prefix`` uses the number of earlier
    names that start with the same base, whatever follows. The base is the name
    without its last four characters (``cut``) or up to the first ``.csv``
    (``split``). A made-up name that some URL really has gets its position too.
    """
    name = F.col("file_name")
    base_of = text.strip_extension(name) if base == "cut" else F.get(F.split(name, "\\.csv"), 0)
    numbered = row_index(manifest.withColumn("_base", base_of), ["topic", "file_name"], "url_pos", "_nth")
    repeats = numbered.filter(F.col("_nth") > 0)
    if mode == "prefix":
        repeats = _prefix_numbers(numbered, repeats)
    made_up = F.concat("_base", F.lit("_"), "_nth", F.lit(".csv"))
    repeats = repeats.withColumn("_made", made_up)
    taken = manifest.select("topic", F.col("file_name").alias("_made")).distinct().withColumn("_taken", F.lit(True))
    placed = F.concat("_base", F.lit("_"), "_nth", F.lit("_"), "url_pos", F.lit(".csv"))
    repeats = repeats.join(taken, ["topic", "_made"], "left").withColumn(
        "unique_name", F.when(F.col("_taken"), placed).otherwise(F.col("_made"))
    )
    firsts = numbered.filter(F.col("_nth") == 0).withColumn("unique_name", name)
    return firsts.select(*manifest.columns, "unique_name").unionByName(repeats.select(*manifest.columns, "unique_name"))


def _prefix_numbers(numbered: DataFrame, repeats: DataFrame) -> DataFrame:
    """``repeats`` with ``_nth`` = number of earlier names starting with the base."""
    ranges = prefix_ranges(numbered, repeats.select("topic", "_base").distinct())
    points = numbered.select("topic", "file_name", "url_pos").join(ranges.names, ["topic", "file_name"])
    asked = repeats.select("topic", "_base", "url_pos").join(ranges.bases, ["topic", "_base"])
    counted = earlier_in_range(points, asked, "topic", "url_pos").withColumnRenamed("n", "_earlier")
    return repeats.join(counted, ["topic", "url_pos"]).withColumn("_nth", F.col("_earlier")).drop("_earlier")


class PrefixRanges(NamedTuple):
    """``names (topic, file_name, rank)`` and ``bases (topic, _base, low, high)``."""

    names: DataFrame
    bases: DataFrame


def prefix_ranges(names: DataFrame, bases: DataFrame) -> PrefixRanges:
    """Ranks of the different names of a topic by their bytes; a base's names are the ranks from ``low`` to below ``high``.

    Names and both ends of each base's range are placed in one order. An end is the
    base, or the base and a byte that no UTF-8 text has; ranks count the names before.
    """
    key = lambda c: F.col(c).cast("binary")
    row = lambda df, text, key, kind: df.select("topic", F.col(text).alias("_text"), key.alias("_key"), F.lit(kind).alias("_kind"))
    past = F.concat(key("_base"), F.lit(bytearray([255])))
    every = row(names.select("topic", "file_name").distinct(), "file_name", key("file_name"), 1)
    every = every.unionByName(row(bases, "_base", key("_base"), 0)).unionByName(row(bases, "_base", past, 2))
    placed = places(every.filter(F.col("_key").isNotNull()), ["topic", "_key", "_kind"], "_place").drop("_key")
    ranked = running_total(placed, ["topic"], "_place", (F.col("_kind") == 1).cast("bigint"), "rank")
    ends = ranked.filter(F.col("_kind") != 1).groupBy("topic", F.col("_text").alias("_base"))
    return PrefixRanges(
        ranked.filter(F.col("_kind") == 1).select("topic", F.col("_text").alias("file_name"), "rank"),
        ends.agg(F.min("rank").alias("low"), F.max("rank").alias("high")),
    )


# Blocks of ranks that make up a range: per level, one at its lower end and one at its upper end at most.
_BLOCKS = """flatten(transform(sequence(0, length(bin(high - low)) - 1), l -> transform(
    array(named_struct('a', shiftright(low + shiftleft(1L, l) - 1, l), 'z', shiftright(high, l))), r -> array(
        named_struct('level', l, 'block', CASE WHEN r.a < r.z AND r.a % 2 = 1 THEN r.a END),
        named_struct('level', l, 'block', CASE WHEN r.a < r.z AND r.z % 2 = 1 THEN r.z - 1 END)))))"""


def earlier_in_range(points: DataFrame, asked: DataFrame, key: str, pos: str) -> DataFrame:
    """``(key, pos, n)``: how many points ``(key, rank, pos)`` lie before ``pos`` with a rank from ``low`` to below ``high``.

    ``asked`` is ``(key, low, high, pos)``, at most one row per key and position; points
    have one position each. A range is cut into dyadic blocks of ranks, two per
    power of two at most, and a point lies in one block per power up to the widest range of its key, so the
    effort grows with the logarithm of that range whatever the length of a name. Only
    blocks that some range uses are counted, by running totals over positions that
    cut a hot block into buckets.
    """
    widest = asked.groupBy(key).agg(F.max(F.col("high") - F.col("low")).alias("_widest")).filter(F.col("_widest") > 0)
    blocks = asked.filter(F.col("high") > F.col("low")).select(key, pos, F.explode(F.flatten(F.expr(_BLOCKS))).alias("b"))
    blocks = blocks.select(key, pos, "b.level", "b.block").filter(F.col("block").isNotNull())
    used = blocks.select(key, "level", "block").distinct()
    levels = F.sequence(F.lit(0), F.length(F.bin("_widest")) - 1)
    inside = points.join(widest, key).select(key, pos, "rank", F.explode(levels).alias("level"))
    inside = inside.select(key, pos, "level", F.expr("shiftright(rank, level)").alias("block")).join(used, [key, "level", "block"], "left_semi")
    events = inside.withColumn("_point", F.lit(1)).unionByName(blocks.withColumn("_point", F.lit(0)))
    events = events.withColumn("_turn", F.col(pos) * 2 + F.col("_point"))
    counted = running_total(events, [key, "level", "block"], "_turn", F.col("_point").cast("bigint"), "_before")
    found = counted.filter(F.col("_point") == 0).groupBy(key, pos).agg(F.sum("_before").alias("n"))
    return asked.select(key, pos).join(found, [key, pos], "left").fillna(0, ["n"])


def seeded_hash(seed: int, *parts: Column) -> Column:
    """Hex digest of the seed and the parts; the same on every run and cluster."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def sample_urls(manifest: DataFrame, k: int, seed: int = 0, keys: tuple[str, ...] = ("topic",)) -> DataFrame:
    """At most ``k`` URLs per topic in seeded order; topics with fewer keep all."""
    order = [seeded_hash(seed, F.col("url")).asc(), F.col("url_pos").asc()]
    return top_k(manifest, list(keys), order, k)


def manifest_from_fetches(fetches: DataFrame) -> DataFrame:
    """URLs that were fetched: status 200."""
    return fetches.filter(F.col("status") == 200).drop("status")


def pending_topics(topics: DataFrame, manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Topics with URLs that are not finished yet."""
    return topics.join(done.select("topic").distinct(), "topic", "left_anti").join(
        manifest.select("topic").distinct(), "topic", "left_semi"
    )


def extraction_metrics(topics: DataFrame, manifest: DataFrame) -> DataFrame:
    """``(topic, topic_pos, n_files, running_files)`` in processing order, last topic first."""
    counts = manifest.groupBy("topic").agg(F.count("*").alias("n_files"))
    counted = topics.select("topic", "topic_pos").join(counts, "topic", "left").fillna(0, ["n_files"])
    turned = counted.withColumn("_all", F.lit(0)).withColumn("_turn", -F.col("topic_pos"))
    totals = running_total(turned, ["_all"], "_turn", F.col("n_files"), "_before")
    return totals.select(
        "topic", "topic_pos", "n_files", (F.col("_before") + F.col("n_files")).alias("running_files")
    )
