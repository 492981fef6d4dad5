"""Joins of heavy tables.

Most joins here are plain: Spark broadcasts a side it measures as small, before
or while the query runs, and splits hot keys of the shuffled side. Where the left
side holds file content, even one shuffle is worth avoiding, so the right side
is stored and its bytes are measured first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefold.session import cut_lineage

# A side of at most this many bytes, counted as JSON text, may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def sized_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast ``right`` if its measured size allows, so that ``left`` stays in place; else shuffle.

    ``right`` is computed once: it is stored, measured, and joined as stored.
    """
    right = cut_lineage(right)
    size = right.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return left.join(F.broadcast(right) if size <= max_bytes else right, list(on), how)
