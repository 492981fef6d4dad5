"""Readers of landed files: topics, search responses, manifests, licenses, raw files, vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablefold.functions import text
from tablefold.operators.filters import prune_licensed

SEARCH_SCHEMA = "total_count bigint, items array<struct<html_url:string>>"
LICENSE_SCHEMA = (
    "owner string, repo string, status int, license struct<key:string,name:string,spdx_id:string,url:string>"
)
BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
BYTE_ORDER_MARK = b"\xef\xbb\xbf"
# Files up to this size are parsed inside one row; larger ones as lines.
WHOLE_FILE_BYTES = 64 * 1024 * 1024


def parse_topics(df: DataFrame, col: str, *keep: str) -> DataFrame:
    """``(topic_pos, topic)`` from a column of JSON arrays of strings."""
    listed = F.from_json(F.col(col), "array<string>")
    return df.select(*keep, F.posexplode(listed).alias("topic_pos", "topic"))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """Topics of a file that is one JSON array, in file order."""
    return parse_topics(spark.read.text(path, wholetext=True), "value")


def topics_from(df: DataFrame, col: str, pos: str) -> DataFrame:
    """Custom topics from a column, in the order of ``pos``."""
    return df.select(F.col(pos).alias("topic_pos"), F.col(col).alias("topic"))


def write_topics(topics: DataFrame, path: str) -> None:
    topics.write.mode("overwrite").json(path)


def normalize_topics(synsets: DataFrame) -> DataFrame:
    """``(synset, topic_pos, topic, topic_key)`` from ``(synset, pos, lemmas)``: one topic per synset.

    Topics may repeat, as uniqueness is on synsets. ``topic_pos`` is where the
    synset comes first.
    """
    first = synsets.groupBy("synset").agg(F.min(F.struct("pos", "lemmas")).alias("f"))
    topic = text.lemma_topic(F.element_at("f.lemmas", 1))
    return first.select("synset", F.col("f.pos").alias("topic_pos"), topic.alias("topic")).withColumn(
        "topic_key", text.topic_key(F.col("topic"))
    )


def processing_order(topics: DataFrame) -> DataFrame:
    """Topics last first."""
    return topics.orderBy(F.col("topic_pos").desc())


def flatten_search(responses: DataFrame, *keep: str) -> DataFrame:
    """One row per hit with ``url`` and ``raw_url``; order inside the page in ``item_pos``, repeats kept."""
    hits = responses.select(*keep, F.posexplode("items").alias("item_pos", "item"))
    url = F.col("item.html_url")
    return hits.select(*keep, "item_pos", url.alias("url"), text.raw_url(url).alias("raw_url"))


def read_search(spark: SparkSession, path: str) -> DataFrame:
    """Landed search responses, one JSON document per file, with the topic folder they lie in."""
    pages = spark.read.schema(SEARCH_SCHEMA).json(path, multiLine=True, recursiveFileLookup=True)
    return pages.withColumn("page", F.col("_metadata.file_path")).withColumn("topic", _folder(F.col("page")))


def union_pages(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All pages and segments together, repeats kept."""
    for other in others:
        first = first.unionByName(other)
    return first


def _folder(path: Column) -> Column:
    return F.url_decode(F.element_at(F.split(path, "/"), -2))


def manifest_rows(lines: DataFrame) -> DataFrame:
    """``(topic, url_pos, url, file_name, raw_url)`` from ``(topic, url_pos, url)``."""
    return lines.withColumn("file_name", text.url_file_name(F.col("url"))).withColumn("raw_url", text.raw_url(F.col("url")))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """URL lists of all topics: ``<path>/<topic>/<file>.txt``, one URL per line.

    ``url_pos`` is unique in a topic and grows along its files in order of their names,
    without being dense: the bytes of the files before, the split of the file a
    line lies in, then its place there. Only the files' names and sizes, one row each,
    are put in order, by topic.
    """
    lines = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter="*.txt")
    lines = lines.select(
        F.col("value").alias("url"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"),
    ).withColumn("place", F.monotonically_increasing_id())
    inside = Window.partitionBy("path", "block").orderBy("place")
    numbered = lines.withColumn("at", F.col("block") + F.row_number().over(inside) - 1).withColumn("topic", _folder(F.col("path")))
    # a line takes a byte of its file at least, but for an empty last one, which is no URL
    before = Window.partitionBy("topic").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = numbered.select("topic", "path", "size").distinct()
    begins = files.select("path", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    placed = numbered.filter(F.col("url") != "").join(begins, "path")
    return manifest_rows(placed.select("topic", (F.col("begin") + F.col("at")).alias("url_pos"), "url"))


def read_licenses(spark: SparkSession, path: str) -> DataFrame:
    """Landed license look-ups, one JSON object per line."""
    return spark.read.schema(LICENSE_SCHEMA).json(path)


def read_files(spark: SparkSession, path: str, max_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """``(topic, file_name, file_id, n_bytes, content)`` of files small enough for one row.

    Bytes that are not UTF-8 give a null content, which the parser rejects; a
    byte-order mark is dropped.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.url_decode(F.element_at(F.split("path", "/"), -1))
    return files.filter(F.col("length") <= max_bytes).select(
        _folder(F.col("path")).alias("topic"), name.alias("file_name"), F.col("path").alias("file_id"),
        F.col("length").alias("n_bytes"), _text("content").alias("content"),
    )


def _text(content: str) -> Column:
    """Bytes as text without a byte-order mark; null if they are not UTF-8."""
    bare = F.when(F.substring(content, 1, 3) == BYTE_ORDER_MARK, F.expr(f"substring({content}, 4)")).otherwise(F.col(content))
    decoded = bare.cast("string")
    return F.when(F.is_valid_utf8(decoded), decoded)


def read_repository_files(spark: SparkSession, path: str, licenses: DataFrame, max_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """``read_files`` of licensed repositories only, from files landed in ``owner=.../repo=.../topic=.../``.

    Content of other repositories is not read (``filters.prune_licensed``).
    """
    files = spark.read.format("binaryFile").schema(f"{BINARY_SCHEMA}, owner string, repo string, topic string").load(path)
    kept = prune_licensed(files.filter(F.col("length") <= max_bytes), licenses)
    name = F.url_decode(F.element_at(F.split("path", "/"), -1))
    return kept.select("topic", name.alias("file_name"), F.col("path").alias("file_id"), F.col("length").alias("n_bytes"), _text("content").alias("content"))


def read_long_files(spark: SparkSession, path: str, max_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """``(topic, file_name, file_id, line_pos, line, line_end, readable)`` of the files ``read_files`` leaves out.

    A file is read in splits by many tasks. Each line starts at its own byte, and
    a split at a multiple of many bytes, so split start plus place in the split
    grows along the file. Lines are cut at line feeds and then at carriage returns;
    ``line_end`` keeps what ended a line, as quoted fields may hold it; ``readable`` is
    false for bytes that are not UTF-8.
    """
    lines = spark.read.text(path, recursiveFileLookup=True, lineSep="\n").filter(F.col("_metadata.file_size") > max_bytes)
    lines = lines.select(
        F.split("value", "\r", -1).alias("parts"), F.is_valid_utf8("value").alias("readable"), F.col("_metadata.file_path").alias("file_id"),
        F.col("_metadata.file_block_start").alias("block"),
    ).withColumn("place", F.monotonically_increasing_id())
    last = F.size("parts") - 1
    returned = (last > 0) & (F.element_at("parts", -1) == "")  # the line feed followed a carriage return
    cut = lines.select(
        "file_id", "block", "place", "readable", (last - returned.cast("int")).alias("last"), returned.alias("returned"),
        F.posexplode("parts").alias("part", "line"),
    ).filter(F.col("part") <= F.col("last"))
    ended = F.when(F.col("part") < F.col("last"), "\r").when(F.col("returned"), "\r\n").otherwise("\n")
    # a part takes a byte at least, so numbers stay below the start of the next split
    inside = Window.partitionBy("file_id", "block").orderBy("place", "part")
    numbered = cut.withColumn("line_end", ended).withColumn("line_pos", F.col("block") + F.row_number().over(inside) - 1)
    marked = (F.col("line_pos") == 0) & F.startswith("line", F.lit("\ufeff"))
    bare = F.when(marked, F.substring("line", F.lit(2), F.length("line"))).otherwise(F.col("line"))
    name = F.url_decode(F.element_at(F.split("file_id", "/"), -1))
    return numbered.select(
        _folder(F.col("file_id")).alias("topic"), name.alias("file_name"), "file_id", "line_pos", bare.alias("line"), "line_end", "readable"
    )


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(word, vec)`` from a text file of a word and its numbers per line; the size line is skipped."""
    parts = F.split("value", " ")
    vectors = spark.read.text(path).select(
        F.get(parts, 0).alias("word"),
        F.transform(F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda x: x != ""), lambda x: x.cast("float")).alias("vec"),
    )
    return vectors.filter(F.size("vec") > 1)
