"""Tables that are written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablefold import sinks, wide_tables
from tablefold.functions import text
from tablefold.operators import filters, parse
from tablefold.queries import common as c
from tablefold.queries import extraction, parsing
from tablefold.session import cut_lineage, shared_folder
from tablefold.sources import landed


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def wide_files(spark, sf_dir):
    """Every document with a header as a typed Parquet file of its own, written by one job; sizes of the columns read back."""
    path = _folder(spark, "wide")
    views = c.parsed(spark, sf_dir, ["topic"])
    rows = cut_lineage(views.rows.drop("topic"))
    columns = cut_lineage(parse.infer_dtypes(views.columns.drop("topic"), parse.cells_of(rows)))
    tables = views.files.select("file_id", "topic", F.concat("file_id", F.lit(".parquet")).alias("name"))
    wide_tables.write_tables(rows, columns, tables, path)
    kinds = {"int64": "int64", "double": "float64", "bool": "bool", "decimal128(20, 0)": "uint64", "string": "object"}
    dtype = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("kind")]
    number = F.when(F.col("kind") == "string", F.length("value")).when(F.col("kind") == "bool", (F.col("value") == "true").cast("int"))
    size = F.round(F.sum(number.otherwise(F.expr("try_cast(value AS double)"))), 3)
    file_id = F.regexp_extract("name", "^(.*)[.]parquet$", 1).cast("bigint")
    return wide_tables.read_cells(spark, path).groupBy(file_id.alias("file_id"), "col_idx", "header", dtype.alias("dtype")).agg(
        F.count("*").alias("n_rows"), F.count("value").alias("n_values"), F.coalesce(size, F.lit(0.0)).alias("size")
    )


def licensed_content(spark, sf_dir):
    """Documents landed by owner and repository; only content of licensed repositories is read."""
    path = _folder(spark, "landed")
    docs = c.load(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"), F.col("source").alias("owner"), F.col("lang").alias("repo"))
    docs.repartition("owner", "repo").write.partitionBy("owner", "repo").parquet(path)
    files = spark.read.parquet(path)
    kept = filters.prune_licensed(files, extraction._licenses(spark, sf_dir))
    return kept.select("doc_id", F.md5("content").alias("content_md5"), F.col("license.name").alias("license"))


def manifest_written(spark, sf_dir):
    """File names and URLs per topic as JSON, read back; a topic that is written again is replaced."""
    path = _folder(spark, "manifest")
    manifest = extraction._doc_manifest(spark, sf_dir).withColumn("unique_name", text.url_file_name(F.col("url")))
    sinks.write_manifest(manifest.withColumn("url", F.lit("https://old")).filter("topic in ('src0', 'src1')"), path)
    sinks.write_manifest(manifest, path)
    return spark.read.schema("topic string, url_pos bigint, file_name string, url string").json(path).select("topic", "url_pos", "file_name", "url")


def metrics_written(spark, sf_dir):
    """Extraction counts as JSON per topic, read back, and which topics they mark as finished."""
    path = _folder(spark, "metrics")
    sinks.write_metrics(c.load(spark, sf_dir, "documents").groupBy(F.col("source").alias("topic")).agg(F.count("*").alias("files")), path)
    return sinks.read_finished(spark, path)


def manifest_lists(spark, sf_dir):
    """URL lists of topics written as text and read by the manifest reader; place in the topic."""
    path = _folder(spark, "lists")
    extraction._doc_manifest(spark, sf_dir).repartition(3, "url_pos").select("topic", "url").withColumn("folder", F.col("topic")).select("url", "folder").write.partitionBy("folder").text(path)
    found = landed.read_manifest(spark, path)
    per = found.groupBy(F.replace("topic", F.lit("folder="), F.lit("")).alias("topic"))
    return per.agg(F.count("*").alias("n_urls"), F.countDistinct("url_pos").alias("n_places"), F.countDistinct("url").alias("n_different"))


QUERIES = {f.__name__: f for f in (wide_files, licensed_content, manifest_written, metrics_written, manifest_lists)}

_SIZE = """CASE WHEN dtype = 'object' THEN length(value) WHEN dtype = 'bool' THEN (lower(value) = 'true')::INT
  ELSE try_cast(trim(value) AS DOUBLE) END"""
_URL = "'https://host/' || source || '/' || lang || '/blob/main/' || doc_id || '.csv'"

ORACLE = {
    "wide_files": f"""{parsing._DOC_TYPES}
SELECT t.file_id, t.col_idx, t.header, t.dtype, count(*) AS n_rows, count(value) AS n_values, coalesce(round(sum({_SIZE}), 3), 0.0) AS size
FROM typed t JOIN doc_cells d ON t.file_id = d.file_id AND t.col_idx = d.col_idx GROUP BY ALL""",
    "licensed_content": f"""WITH {extraction._LICENSES}
SELECT doc_id, md5(text) AS content_md5, license FROM kept JOIN documents ON doc_id = url_pos""",
    "manifest_written": f"SELECT source AS topic, doc_id AS url_pos, doc_id || '.csv' AS file_name, {_URL} AS url FROM documents",
    "metrics_written": "SELECT source AS topic, count(*) AS files FROM documents GROUP BY ALL",
    "manifest_lists": f"SELECT source AS topic, count(*) AS n_urls, count(*) AS n_places, count(DISTINCT {_URL}) AS n_different FROM documents GROUP BY ALL",
}
