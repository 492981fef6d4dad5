"""Delimited files to rows, columns and cells.

A file that fits in one value is read inside its row: no shuffle, no window.
A file too big for that comes as lines (``operators.long_files``); both give
the tables described in ``Parsed``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold.functions import delimited as d

UNREADABLE = "not UTF-8"

# Delimiters tried by the consistency count.
CONSISTENT_CANDIDATES = [",", "\t", ";", "|", ":", " "]


@dataclass
class Parsed:
    """Views of a parsed corpus, all keyed by ``file_id``.

    files: file_id, delimiter, n_rows, n_columns, n_bad
    columns: file_id, col_idx, header
    rows: file_id, row_idx, fields
    rejects: file_id, stage, reason
    """

    files: DataFrame
    columns: DataFrame
    rows: DataFrame
    rejects: DataFrame


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions take as they are.

    A plain projection would be merged into the next one and computed again for
    every array member that a lambda visits; a one-row generator is not.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def sniff_delimiters(files: DataFrame, mode: str = "header") -> DataFrame:
    """``(file_id, delimiter)``; null where no delimiter can be told.

    ``header`` reads the first line only. ``consistent`` counts the candidates
    on every line and takes the one whose most common count covers most lines.
    """
    if mode == "header":
        heads = settle(files.select("file_id", "content"), _head=d.first_line(F.col("content")))
        return heads.select("file_id", d.sniff_delimiter(F.col("_head")).alias("delimiter"))
    lines = files.select("file_id", F.explode(F.split("content", d.LINE_END)).alias("line"))
    counts = (
        lines.select("file_id", F.explode(d.line_delimiter_counts(F.col("line"), CONSISTENT_CANDIDATES)).alias("c"))
        .groupBy("file_id", "c.delimiter", "c.n")
        .agg(F.count("*").alias("lines"))
    )
    preference = F.array_position(F.array(*[F.lit(c) for c in CONSISTENT_CANDIDATES]), F.col("delimiter"))
    best = counts.groupBy("file_id").agg(
        F.max(F.struct("lines", (-preference).alias("preference"), "n", "delimiter"))["delimiter"].alias("delimiter")
    )
    return files.select("file_id").join(best, "file_id", "left")


def file_heads(files: DataFrame) -> DataFrame:
    """``files`` with ``delimiter``, ``header`` (names), ``readable`` and ``body`` in place of ``content``."""
    files = files.withColumn("readable", F.col("content").isNotNull())
    heads = settle(files, _parts=F.split("content", d.LINE_END, 2))
    heads = settle(heads, _head=F.get("_parts", F.lit(0)))
    heads = settle(heads, delimiter=d.sniff_delimiter(F.col("_head")))
    fields = F.transform(d.split_fields(F.col("_head"), F.col("delimiter")), d.unquote)
    body = F.get("_parts", F.lit(1))
    return heads.withColumn("header", d.name_columns(fields)).withColumn("body", body).drop("content", "_parts", "_head")


def file_records(heads: DataFrame, longest_field: int | None = None) -> DataFrame:
    """``heads`` with ``n_index`` (leading columns without a header), the kept ``records`` and ``n_bad``.

    Files without a delimiter have no records and null counts.
    """
    delimiter, width = F.col("delimiter"), F.col("_width")
    split = settle(heads, _width=F.size("header"))
    records = F.transform(d.split_records(F.col("body"), delimiter), lambda r: d.split_fields(r, delimiter))
    present = F.filter(records, lambda r: ~d.blank_record(r))
    split = settle(split, _present=F.coalesce(present, F.array().cast("array<array<string>>")))
    split = settle(split, _sound=F.filter("_present", lambda r: ~F.exists(r, lambda f: d.spoiled_field(f, longest_field))))
    sizes = [F.when(F.size("_sound") > i, F.size(F.get("_sound", F.lit(i)))) for i in (0, 1)]
    split = settle(split, _first=sizes[0], _second=sizes[1])
    # The first record names the index columns when the second is as wide as both together.
    named_index = F.coalesce(F.col("_second") == F.col("_first") + width, F.lit(False))
    split = settle(
        split, n_index=d.index_width(width, F.col("_first"), F.col("_second")), _skipped=named_index.cast("int")
    )
    kept = F.filter(
        "_sound", lambda r, i: (i >= F.col("_skipped")) & (F.size(r) <= width + F.col("n_index"))
    )
    split = settle(split, records=kept)
    return split.withColumn("n_bad", F.size("_present") - F.col("_skipped") - F.size("records")).drop(
        "body", "_present", "_sound", "_first", "_second", "_skipped"
    )


def trimmed_fields(record: Column, n_index: Column, width: Column) -> Column:
    """Raw fields under the header: index columns cut off, short records padded with null."""
    picked = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.get(record, n_index + i))
    return F.when((n_index == 0) & (F.size(record) == width), record).otherwise(picked)


def parse_files(
    files: DataFrame, keep: list[str] | None = None, cut: Callable[[DataFrame], DataFrame] | None = None,
    longest_field: int | None = None,
) -> Parsed:
    """The four tables of ``files(file_id, content)``; ``keep`` columns travel along.

    Each table reads only what it needs: columns come from first lines alone. With
    ``cut``, which stores a table, content is read once: the parsed files are
    stored, and all four tables come from there.
    """
    keys = ["file_id", *(keep or [])]
    heads = file_heads(files.select(*keys, "content"))
    every = file_records(heads, longest_field)
    if cut is not None:
        every = heads = cut(every)
    sound = heads.filter(F.col("delimiter").isNotNull())
    read = every.filter(F.col("delimiter").isNotNull())
    rows = read.select(*keys, "n_index", "_width", F.posexplode("records").alias("row_idx", "_record"))
    fields = F.transform(trimmed_fields(F.col("_record"), F.col("n_index"), F.col("_width")), d.unquote)
    return Parsed(
        files=read.select(
            *keys,
            "delimiter",
            F.size("records").cast("bigint").alias("n_rows"),
            F.col("_width").alias("n_columns"),
            F.col("n_bad").cast("bigint").alias("n_bad"),
        ),
        columns=sound.select(*keys, F.posexplode("header").alias("col_idx", "header")),
        rows=rows.select(*keys, F.col("row_idx").cast("bigint").alias("row_idx"), fields.alias("fields")),
        rejects=heads.filter(F.col("delimiter").isNull()).select(
            *keys, F.lit("parse").alias("stage"), F.when(F.col("readable"), "no delimiter").otherwise(UNREADABLE).alias("reason")
        ),
    )


def cells_of(rows: DataFrame) -> DataFrame:
    """Long form: one row per cell, null tokens as null."""
    keys = [c for c in rows.columns if c != "fields"]
    value = F.col("value")
    return rows.select(*keys, F.posexplode("fields").alias("col_idx", "value")).withColumn(
        "value", F.when(~d.null_value(value), value)
    )


def infer_dtypes(columns: DataFrame, cells: DataFrame, key: str = "file_id") -> DataFrame:
    """``columns`` with ``dtype``, from counts of value kinds.

    The counts combine before the shuffle, so what moves is one small row per
    column and task. A column without rows is ``object``.
    """
    kind = d.value_kind(F.col("value"))
    counted = (
        cells.select(key, "col_idx", kind.alias("_kind"))
        .groupBy(key, "col_idx")
        .agg(
            F.count("*").alias("n"),
            *[
                F.count_if(F.col("_kind") == k).alias(f"n_{k}")
                for k in ("null", "int", "negative", "uint", "wide", "float", "bool")
            ],
        )
    )
    joined = columns.join(counted, [key, "col_idx"], "left")
    return joined.withColumn("dtype", dtype_of_counts()).select(*columns.columns, "dtype")


def dtype_of_counts() -> Column:
    """The type name that counts of value kinds amount to."""
    n, nulls = F.col("n"), F.col("n_null")
    whole = F.col("n_int") + F.col("n_negative")
    numeric = whole + F.col("n_uint") + F.col("n_float")
    uint_clash = (F.col("n_uint") > 0) & ((nulls > 0) | (F.col("n_negative") > 0))
    return (
        F.when(n.isNull(), "object")
        .when(nulls == n, "float64")
        .when((F.col("n_wide") > 0) | uint_clash, "object")
        .when((numeric == n) & (F.col("n_float") == 0), F.when(F.col("n_uint") > 0, "uint64").otherwise("int64"))
        .when(numeric + nulls == n, "float64")
        .when(F.col("n_bool") == n, "bool")
        .otherwise("object")
    )


def table_shapes(cells: DataFrame, key: str = "file_id") -> DataFrame:
    """Rows and columns of each table, from its cells."""
    per_column = cells.groupBy(key, "col_idx").agg(F.count("*").alias("n"))
    return per_column.groupBy(key).agg(
        F.max("n").alias("n_rows"), (F.max("col_idx") + 1).alias("n_columns")
    )
