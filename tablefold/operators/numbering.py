"""Running aggregates and top-k that never sort a whole group in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefold.session import cut_lineage

BUCKET_ROWS = 500_000


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    out: str,
    fold: Callable[[Column], Column] = F.sum,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Adds ``out``: sum or maximum (``fold``) of ``value`` over the earlier rows of the group.

    ``order`` is a whole number, unique per key; ``keys`` are not null. The order
    is cut into buckets of ``bucket_rows`` positions: one pass folds each bucket,
    the bucket results are folded along (one row per bucket), and a window
    sorts inside a bucket only. A key that holds a third of all rows is thus
    spread over all its buckets. Null where no earlier value exists.
    """
    keys = list(keys)
    bucketed = df.withColumn("_bucket", F.floor(F.col(order) / bucket_rows)).withColumn("_value", value)
    folded = bucketed.groupBy(*keys, "_bucket").agg(fold("_value").alias("_fold"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = folded.select(*keys, "_bucket", fold("_fold").over(before).alias("_offset"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = bucketed.withColumn("_local", fold("_value").over(inside))
    if fold is F.sum:
        either = F.coalesce(F.col("_offset") + F.col("_local"), F.col("_offset"), F.col("_local"))
    else:
        either = F.greatest("_offset", "_local")
    return local.join(offsets, [*keys, "_bucket"]).withColumn(out, either).select(*df.columns, out)


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group, zero for the first."""
    return running(df, keys, order, value, out, F.sum, bucket_rows).withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def row_index(df: DataFrame, keys: Sequence[str], order: str, out: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Zero-based position of each row inside its group."""
    return running_total(df, keys, order, F.lit(1).cast("bigint"), out, bucket_rows)


def places(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Adds ``out``: a whole number per row, ascending in ``order``, with gaps.

    Spark samples splitters and deals the rows into ranges of about equal size, so
    keys that begin alike spread like others; only rows that are equal in ``order``
    stay together. The result is stored, as ranges need not come out alike twice.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(dealt.withColumn(out, F.monotonically_increasing_id()))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, salts: int = 64) -> DataFrame:
    """The first ``k`` rows of each group under a total order.

    Spark prunes a rank filter before the shuffle only for small ``k``; a first
    cut inside hashed slices of the group keeps every task small for any ``k``.
    """
    keys = list(keys)
    slice_of = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c not in keys]), F.lit(salts))
    sliced = df.withColumn("_slice", slice_of)
    first = Window.partitionBy(*keys, "_slice").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= k)
        .withColumn("_rank", F.row_number().over(final))
        .filter(F.col("_rank") <= k)
        .drop("_slice", "_rank")
    )
