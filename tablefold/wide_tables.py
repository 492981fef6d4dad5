"""All tables of a corpus as typed Parquet files of their own, written by one job.

The writer is a data source. A task gets rows in order of table and place, keeps one
Parquet file open at a time, with that table's own columns, types and metadata, and
leaves its files in a folder of its attempt. Only the folders of attempts that Spark
accepted are moved to their places when the job ends; those of killed, repeated or
failed attempts go with the temporary folder. A table is a folder of parts of at most
``PART_ROWS`` rows, so that a very long one is spread over many tasks.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tablefold import sinks
from tablefold.functions import delimited

# Executors need not have this package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sinks)

PART_ROWS = 500_000
#: Rows and bytes of text after which the open file gets a row group.
GROUP_ROWS, GROUP_BYTES = 50_000, 32_000_000
MOVES_AT_ONCE = 32
FORMAT = "tablefold_wide_tables"
SCHEMA = "folder string, part int, row_idx bigint, heads array<struct<header:string,dtype:string>>, metadata string, fields array<string>"

_NULLS = pa.array(delimited.NULL_TOKENS)
#: Texts that a cast to boolean takes, in lower case.
_YES, _NO = ["t", "true", "y", "yes", "1"], ["f", "false", "n", "no", "0"]
_INTEGER, _FLOAT = (re.compile(x) for x in (delimited.INTEGER, f"{delimited.FLOAT}|{delimited.INFINITE}"))
_TYPES = {"int64": pa.int64(), "float64": pa.float64(), "bool": pa.bool_(), "uint64": pa.decimal128(20, 0), "object": pa.string()}
_SPARK_NAMES = {"int64": "long", "float64": "double", "bool": "boolean", "uint64": "decimal(20,0)", "object": "string"}
#: Fixed value: the key under which Spark keeps its own schema in a Parquet file.
_SPARK_KEY = b"org.apache.spark.sql.parquet.row.metadata"


def _number(value: str | None, dtype: str) -> int | float | Decimal | None:
    if value is None or not (_FLOAT if dtype == "float64" else _INTEGER).match(value):
        return None
    if dtype == "float64":
        return float(value)
    whole = int(value)
    if dtype == "int64":
        return whole if -(2**63) <= whole < 2**63 else None
    return Decimal(whole) if abs(whole) < 10**20 else None


def typed_array(values: pa.Array, dtype: str) -> pa.Array:
    """Cell texts as their column's type; null tokens, and texts that are no value of the type, are null."""
    values = pc.if_else(pc.is_in(values, _NULLS), pa.scalar(None, pa.string()), values)
    if dtype == "object":
        return values
    if dtype == "bool":
        lower = pc.ascii_lower(pc.ascii_trim_whitespace(values))
        yes = pc.is_in(lower, pa.array(_YES))
        return pc.if_else(pc.or_(yes, pc.is_in(lower, pa.array(_NO))), yes, pa.scalar(None, pa.bool_()))
    if dtype != "uint64":
        try:
            return pc.cast(pc.ascii_trim_whitespace(values), _TYPES[dtype])
        except pa.ArrowInvalid:  # signs and shapes that Arrow does not read
            pass
    return pa.array([_number(x, dtype) for x in values.to_pylist()], _TYPES[dtype])


class _OpenTable:
    """The Parquet file of one part, filled by row groups."""

    def __init__(self, files: pa.fs.FileSystem, path: str, heads: list[dict], metadata: str | None):
        self.dtypes = [h["dtype"] for h in heads]
        headers = [h["header"] for h in heads]
        described = [{"header": h} | ({sinks.METADATA_KEY: metadata} if metadata else {}) for h in headers]
        named = list(zip(sinks.physical_names(headers), self.dtypes, described, strict=True))
        spark_schema = {"type": "struct", "fields": [{"name": n, "type": _SPARK_NAMES[t], "nullable": True, "metadata": m} for n, t, m in named]}
        own = {_SPARK_KEY: json.dumps(spark_schema)} | ({sinks.METADATA_KEY: metadata} if metadata else {})
        self.schema = pa.schema([pa.field(n, _TYPES[t], metadata={sinks.HEADER_KEY: m["header"]}) for n, t, m in named], metadata=own)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.writer = pq.ParquetWriter(path, self.schema, filesystem=files, compression="zstd")
        self.held: list[pa.Array] = []
        self.rows = self.size = 0

    def add(self, fields: pa.ListArray) -> None:
        self.held.append(fields)
        self.rows += len(fields)
        self.size += fields.nbytes
        if self.rows >= GROUP_ROWS or self.size >= GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.rows:
            return
        fields = pa.concat_arrays(self.held)
        lengths = pc.fill_null(pc.list_value_length(fields), 0).to_numpy(zero_copy_only=False)
        begins, values = np.cumsum(lengths) - lengths, fields.flatten()
        columns = []
        for i, dtype in enumerate(self.dtypes):
            cells = values.take(pa.array(begins + i, mask=lengths <= i))  # rows may be short
            columns.append(typed_array(cells, dtype))
        self.writer.write_table(pa.Table.from_arrays(columns, schema=self.schema))
        self.held, self.rows, self.size = [], 0, 0

    def close(self) -> None:
        self.flush()
        self.writer.close()


@dataclass
class _Attempt(WriterCommitMessage):
    folder: str


class TableWriter(DataSourceArrowWriter):
    """Writes the tables of one job below ``path``; tables that are there already are replaced, others stay."""

    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def _root(self) -> tuple[pa.fs.FileSystem, str]:
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if ":" in self.path.split("/")[0] else (fs.LocalFileSystem(), self.path.rstrip("/"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Attempt:
        files, root = self._root()
        attempt = f"{root}/_temporary/{self.job}/{uuid.uuid4().hex}"
        open_table, key = None, None
        for batch in iterator:
            folder, part, row = (batch.column(batch.schema.get_field_index(n)) for n in ("folder", "part", "row_idx"))
            heads = np.flatnonzero(row.to_numpy() < 0).tolist()
            if not heads or heads[0]:  # goes on with the open table
                open_table.add(_fields(batch, 0, heads[0] if heads else batch.num_rows))
            for at, past in zip(heads, [*heads[1:], batch.num_rows], strict=True):
                if open_table:
                    open_table.close()
                key = f"{folder[at].as_py()}/part-{part[at].as_py():05d}.parquet"
                head, metadata = (batch.column(batch.schema.get_field_index(n))[at].as_py() for n in ("heads", "metadata"))
                open_table = _OpenTable(files, f"{attempt}/{key}", head, metadata)
                open_table.add(_fields(batch, at + 1, past))
        if open_table:
            open_table.close()
        return _Attempt(attempt)

    def commit(self, messages: list[_Attempt | None]) -> None:
        from pyarrow import fs

        files, root = self._root()
        folders = [m.folder for m in messages if m is not None]

        def of(folder: str) -> list[str]:
            found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True))
            return [x.path[len(folder) + 1 :] for x in found if x.is_file]

        def move(one: tuple[str, str]) -> None:
            files.move(f"{one[0]}/{one[1]}", f"{root}/{one[1]}")

        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            listed = list(zip(folders, pool.map(of, folders), strict=True))
            tables = {name.rpartition("/")[0] for _, names in listed for name in names}
            for table, info in zip(tables, files.get_file_info([f"{root}/{t}" for t in tables]), strict=True):
                if info.type == fs.FileType.Directory:
                    files.delete_dir(f"{root}/{table}")
            list(pool.map(lambda t: files.create_dir(f"{root}/{t}", recursive=True), tables))
            list(pool.map(move, [(folder, name) for folder, names in listed for name in names]))
        self._clean(files, root)

    def abort(self, messages: list[_Attempt | None]) -> None:
        self._clean(*self._root())

    def _clean(self, files: pa.fs.FileSystem, root: str) -> None:
        from pyarrow import fs

        files.delete_dir_contents(f"{root}/_temporary/{self.job}", missing_dir_ok=True)
        if files.get_file_info(f"{root}/_temporary/{self.job}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/_temporary/{self.job}")


def _fields(batch: pa.RecordBatch, at: int, past: int) -> pa.ListArray:
    return batch.column(batch.schema.get_field_index("fields")).slice(at, past - at)


class WideTables(DataSource):
    """Sink of rows as ``write_tables`` arranges them."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> TableWriter:
        return TableWriter(self.options["path"])


def _name(value: Column) -> Column:
    """A name as a folder: other characters than letters and digits escaped, at the start all signs that hide a file."""
    escaped = F.replace(F.url_encode(value), F.lit("+"), F.lit(" "))
    shown = F.regexp_replace(F.regexp_replace(escaped, "^_", "%5F"), "^\\.", "%2E")
    return F.when(value == "", "-").otherwise(F.when(value == "-", "%2D").otherwise(shown))


def write_tables(
    rows: DataFrame, columns: DataFrame, tables: DataFrame, path: str, metadata: DataFrame | None = None, part_rows: int = PART_ROWS
) -> None:
    """Every table as typed Parquet in ``<path>/<topic>/<name>/``, names escaped, in one job; a null topic is ``-``.

    ``rows`` has ``file_id, row_idx, fields``, ``columns`` has ``file_id, col_idx, header,
    dtype``, ``tables`` the ``file_id, topic, name`` of the tables to write, each name once per
    topic, ``metadata`` a JSON text per ``file_id``. Short rows end with nulls; a table
    without rows becomes a file without rows. One row per part carries what the file
    needs to know; it comes first in the part. Only rows move, once.
    """
    spark = rows.sparkSession
    spark.dataSource.register(WideTables)
    heads = columns.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct("col_idx", "header", "dtype"))).alias("heads"))
    heads = heads.withColumn("heads", F.transform("heads", lambda h: F.struct(h["header"].alias("header"), h["dtype"].alias("dtype"))))
    last = rows.groupBy("file_id").agg(F.max("row_idx").alias("last"))
    named = tables.select("file_id", F.concat_ws("/", _name(F.coalesce("topic", F.lit(""))), _name(F.col("name"))).alias("folder"))
    part = lambda row: F.floor(row / part_rows).cast("int")
    described = named.join(heads, "file_id").join(last, "file_id", "left")
    if metadata is None:
        described = described.withColumn("metadata", F.lit(None).cast("string"))
    else:
        described = described.join(metadata.select("file_id", "metadata"), "file_id", "left")
    first = described.select(
        "folder", F.explode(F.sequence(F.lit(0), part(F.coalesce("last", F.lit(0))))).alias("part"), F.lit(-1).cast("bigint").alias("row_idx"),
        "heads", "metadata", F.lit(None).cast("array<string>").alias("fields"),
    )
    filled = rows.join(named, "file_id").select(
        "folder", part(F.col("row_idx")).alias("part"), F.col("row_idx").cast("bigint").alias("row_idx"),
        F.lit(None).cast(first.schema["heads"].dataType).alias("heads"), F.lit(None).cast("string").alias("metadata"), "fields",
    )
    ordered = first.unionByName(filled).repartition("folder", "part").sortWithinPartitions("folder", "part", "row_idx")
    ordered.write.format(FORMAT).mode("append").option("path", path).save()


def _texts(values: pa.Array) -> pa.Array:
    if pa.types.is_string(values.type):
        return values
    return pa.array([None if v is None else json.dumps(int(v) if isinstance(v, Decimal) else v) for v in values.to_pylist()], pa.string())


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """``topic, name, part, place, col_idx, header, kind, value`` of all tables below ``path``: a row per cell, other values than texts as in JSON, ``place`` inside the part."""

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                topic, name, part = path_.split("/")[-3:]
                source = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                schema, done = source.schema_arrow, 0
                headers = [(f.metadata or {}).get(sinks.HEADER_KEY.encode(), f.name.encode()).decode() for f in schema]
                for group in source.iter_batches(10_000):
                    n = group.num_rows
                    columns = [_texts(group.column(i)) for i in range(len(schema))]
                    each = pa.array(np.repeat(np.arange(len(schema), dtype=np.int32), n))
                    arrays = [pa.array([x], t).take(pa.array(np.zeros(len(each), np.int8))) for x, t in ((topic, pa.string()), (name, pa.string()), (int(part[5:10]), pa.int32()))]
                    arrays += [pa.array(np.tile(np.arange(done, done + n), len(schema))), each]
                    arrays += [pa.array(x, pa.string()).take(each) for x in (headers, [str(f.type) for f in schema])]
                    yield pa.record_batch([*arrays, pa.concat_arrays(columns)], names)
                    done += n

    names = ["topic", "name", "part", "place", "col_idx", "header", "kind", "value"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.parquet").load(path)
    found = files.select("path", "content").mapInArrow(cells, "topic string, name string, part int, place bigint, col_idx int, header string, kind string, value string")
    own = lambda c: F.when(F.col(c) == "-", "").otherwise(F.url_decode(c)).alias(c)
    return found.select(own("topic"), own("name"), *names[2:])


def columns_as_written(columns: DataFrame, replaced: DataFrame) -> DataFrame:
    """Columns with the types they have in the written tables: replaced values are texts."""
    texts = replaced.select("file_id", "col_idx").distinct().withColumn("_text", F.lit(True))
    kind = F.when(F.col("_text"), "object").otherwise(F.col("dtype"))
    return columns.join(texts, ["file_id", "col_idx"], "left").withColumn("dtype", kind).drop("_text")
