"""Writers: corpus tables, single wide tables with metadata, topic statistics, manifests."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tablefold.functions import text
from tablefold.functions.delimited import null_value

METADATA_KEY = "table_annotations"
HEADER_KEY = "header"
# Spark types of the inferred column types.
SPARK_TYPES = {"int64": "bigint", "float64": "double", "bool": "boolean", "uint64": "decimal(20,0)", "object": "string"}


def _by_topic(df: DataFrame, topic: str = "topic") -> DataFrameWriter:
    """Written by topic; topics that are written again are replaced, others stay.

    The rebalance hint sizes the files and splits large topics over tasks.
    """
    keyed = df.withColumn("topic_key", text.topic_key(F.col(topic)))
    writer = keyed.hint("rebalance", F.col("topic_key")).write.mode("overwrite")
    return writer.option("partitionOverwriteMode", "dynamic").partitionBy("topic_key")


def write_partitioned(df: DataFrame, path: str, topic: str = "topic") -> None:
    """Parquet by topic."""
    _by_topic(df, topic).parquet(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """File name to URL, one JSON object per line under each topic."""
    _by_topic(manifest.select("topic", "url_pos", F.col("unique_name").alias("file_name"), "url")).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Extraction counts, one JSON object per topic."""
    _by_topic(metrics).json(path)


def write_topic_stats(stats: DataFrame, path: str) -> None:
    """One JSON object per topic. Written last: a topic found here is finished."""
    _by_topic(stats).json(path)


def read_finished(spark: SparkSession, path: str) -> DataFrame:
    """``(topic, files)``: topics with statistics and how many files they count; none before the first run."""
    schema = "topic string, files bigint"
    try:
        return spark.read.schema(schema).json(path).groupBy("topic").agg(F.max("files").alias("files"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def with_table_metadata(df: DataFrame, metadata: dict) -> DataFrame:
    """Attach a JSON text to every column of ``df``; a text that is there already stays."""
    described = []
    for field in df.schema.fields:
        merged = {METADATA_KEY: json.dumps(metadata), **field.metadata}
        described.append(_named(field.name).alias(field.name, metadata=merged))
    return df.select(*described)


def read_table_metadata(df: DataFrame) -> dict:
    """The metadata that ``with_table_metadata`` attached."""
    return json.loads(df.schema.fields[0].metadata[METADATA_KEY])


def typed_value(field: Column, dtype: str) -> Column:
    """A cell text as its column's type; null tokens are null."""
    value = F.when(~null_value(field), field)
    if dtype == "float64":
        return F.trim(value).try_cast("double")
    return value if dtype == "object" else F.trim(value).try_cast(SPARK_TYPES[dtype])


def physical_names(headers: Sequence[str]) -> list[str]:
    """Column names that differ in more than case: a header that an earlier one equals gets its place as a suffix."""
    taken: set[str] = set()
    out = []
    for i, name in enumerate(headers):
        while name.lower() in taken:
            name = f"{name}_{i}"
        taken.add(name.lower())
        out.append(name)
    return out


def typed_columns(fields: Column, headers: Sequence[str], dtypes: Sequence[str]) -> list[Column]:
    """Typed columns of a row's fields; each keeps its header in the field's metadata."""
    named = zip(physical_names(headers), headers, dtypes, strict=True)
    return [
        typed_value(F.get(fields, F.lit(i)), dtype).alias(name, metadata={HEADER_KEY: header})
        for i, (name, header, dtype) in enumerate(named)
    ]


def wide_table(rows: DataFrame, columns: DataFrame, file_id) -> DataFrame:
    """One table of the corpus as a DataFrame of its own, typed and in row order.

    Only the headers of that one table come to the driver.
    """
    heads = columns.filter(F.col("file_id") == F.lit(file_id)).orderBy("col_idx").select("header", "dtype").collect()
    mine = rows.filter(F.col("file_id") == F.lit(file_id)).orderBy("row_idx")
    return mine.select(*typed_columns(F.col("fields"), [h["header"] for h in heads], [h["dtype"] for h in heads]))


def write_wide(rows: DataFrame, columns: DataFrame, file_id, path: str, metadata: dict | None = None) -> None:
    """``wide_table`` as Parquet with its metadata in the schema."""
    table = wide_table(rows, columns, file_id)
    (with_table_metadata(table, metadata) if metadata else table).write.mode("overwrite").parquet(path)
