"""All wide tables in one job: equal to each table by itself, whole files only."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablefold import sinks, wide_tables

KINDS = {
    "int64": ["1", " -22 ", "+3", "NA", "", "9223372036854775807", "9223372036854775808", "x"],
    "float64": ["1.5", "+2", ".5", "3.", "inf", "-Infinity", "NAN", "nan", "1e3", " 7 ", "1_0", "12x"],
    "bool": ["True", "false", "TRUE", "NA", "no"],
    "uint64": ["18446744073709551615", "0", "NULL", "+5"],
    "object": ["a", "null", "x,y", "é", " ", "n/a"],
}


def inputs(spark, n_tables, seed=3):
    rng = random.Random(seed)
    rows, columns, tables, notes = [], [], [], []
    for t in range(n_tables):
        dtypes = [rng.choice(list(KINDS)) for _ in range(rng.randint(1, 4))]
        heads = [rng.choice(["a", "A", "id", "é x", "a.b", "`"]) + rng.choice(["", str(i)]) for i in range(len(dtypes))]
        columns += [(t, i, h, d) for i, (h, d) in enumerate(zip(heads, dtypes))]
        for r in range(rng.choice([0, 1, 2, 9])):
            rows.append((t, r, [rng.choice(KINDS[d]) for d in dtypes][: rng.choice([len(dtypes)] * 3 + [len(dtypes) - 1])]))
        tables.append((t, rng.choice(["thing", "a/b c", "_x", "50%+", ".y", "", None]), f"t {t}.parquet"))
        notes.append((t, f'{{"table_id": {t}}}'))
    return (
        spark.createDataFrame(rows, "file_id bigint, row_idx bigint, fields array<string>").repartition(3),
        spark.createDataFrame(columns, "file_id bigint, col_idx int, header string, dtype string"),
        spark.createDataFrame(tables, "file_id bigint, topic string, name string"),
        spark.createDataFrame(notes, "file_id bigint, metadata string"),
        tables,
    )


def as_text(v):
    return str(v)


@pytest.mark.parametrize("part_rows", [4, 1000])
def test_each_file_equals_the_table_by_itself(spark, tmp_path, part_rows):
    rows, columns, tables, notes, listed = inputs(spark, 14)
    wide_tables.write_tables(rows, columns, tables, str(tmp_path), notes, part_rows)
    folders = {r.file_id: r.folder for r in tables.select("file_id", F.concat_ws("/", wide_tables._name(F.coalesce("topic", F.lit(""))), wide_tables._name(F.col("name"))).alias("folder")).collect()}
    for t, _, _ in listed:
        folder = tmp_path / folders[t]
        back = spark.read.parquet(str(folder))
        want = sinks.wide_table(rows, columns, t)
        assert back.dtypes == want.dtypes
        assert [f.metadata[sinks.HEADER_KEY] for f in back.schema] == [f.metadata[sinks.HEADER_KEY] for f in want.schema]
        assert sinks.read_table_metadata(back) == f'{{"table_id": {t}}}' or sinks.read_table_metadata(back) == {"table_id": t}
        parts = sorted(os.listdir(folder))
        got = [r for p in parts if not p.startswith(".") for r in spark.read.parquet(str(folder / p)).collect()]
        assert [as_text(tuple(r)) for r in got] == [as_text(tuple(r)) for r in want.collect()]
    assert not (tmp_path / "_temporary").exists() or not os.listdir(tmp_path / "_temporary")


def test_many_tables_in_one_action_and_again(spark, tmp_path):
    n = 2000
    rows = spark.range(n * 3).select((F.col("id") % n).alias("file_id"), F.floor(F.col("id") / n).alias("row_idx"), F.array(F.col("id").cast("string"), F.lit("x")).alias("fields"))
    columns = spark.range(n).select(F.col("id").alias("file_id"), F.explode(F.array(F.struct(F.lit(0).alias("col_idx"), F.lit("n").alias("header"), F.lit("int64").alias("dtype")),
        F.struct(F.lit(1).alias("col_idx"), F.lit("s").alias("header"), F.lit("object").alias("dtype")))).alias("c")).select("file_id", "c.*")
    tables = spark.range(n).select(F.col("id").alias("file_id"), F.concat(F.lit("topic"), F.col("id") % 5).alias("topic"), F.concat(F.col("id").cast("string"), F.lit(".parquet")).alias("name"))
    for shift in (0, 1):  # a second run replaces the tables
        wide_tables.write_tables(rows.withColumn("fields", F.array((F.get("fields", F.lit(0)).cast("bigint") + shift).cast("string"), F.lit("x"))), columns, tables, str(tmp_path))
        cells = wide_tables.read_cells(spark, str(tmp_path))
        numbers = cells.filter("header = 'n' and kind = 'int64'").agg(F.count("*"), F.sum("value"), F.countDistinct("topic", "name")).first()
        assert tuple(numbers) == (3 * n, sum(range(3 * n)) + shift * 3 * n, n)


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    rows, columns, tables, notes, _ = inputs(spark, 6)
    bad = columns.withColumn("dtype", F.when((F.col("file_id") == 4) & (F.col("col_idx") == 0), "no such type").otherwise(F.col("dtype")))
    with pytest.raises(Exception, match="no such type"):
        wide_tables.write_tables(rows, bad, tables, str(tmp_path))
    assert [f for _, _, found in os.walk(tmp_path) for f in found] == []


def test_files_of_attempts_that_were_not_accepted_go(tmp_path):
    heads = [{"header": "a", "dtype": "int64"}]
    schema = pa.schema([
        ("folder", pa.string()), ("part", pa.int32()), ("row_idx", pa.int64()), ("heads", pa.list_(pa.struct([("header", pa.string()), ("dtype", pa.string())]))),
        ("metadata", pa.string()), ("fields", pa.list_(pa.string())),
    ])

    def batches():
        yield pa.RecordBatch.from_pylist([{"folder": "t/x", "part": 0, "row_idx": -1, "heads": heads}, {"folder": "t/x", "part": 0, "row_idx": 0, "fields": ["1"]}], schema)
        yield pa.RecordBatch.from_pylist([{"folder": "t/x", "part": 0, "row_idx": 1, "fields": ["2"]}, {"folder": "t/y", "part": 0, "row_idx": -1, "heads": heads}], schema)

    def killed():
        yield next(batches())
        raise RuntimeError("the executor is gone")

    writer = wide_tables.TableWriter(str(tmp_path))
    with pytest.raises(RuntimeError):
        writer.write(killed())
    once, again = writer.write(batches()), writer.write(batches())
    assert not (tmp_path / "t").exists()
    writer.commit([again, None])
    assert once.folder != again.folder
    assert sorted(os.path.relpath(os.path.join(d, f), tmp_path) for d, _, found in os.walk(tmp_path) for f in found) == ["t/x/part-00000.parquet", "t/y/part-00000.parquet"]
    import pyarrow.parquet as pq

    assert pq.read_table(tmp_path / "t/x").to_pydict() == {"a": [1, 2]} and pq.read_table(tmp_path / "t/y").num_rows == 0
