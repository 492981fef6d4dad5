"""Inputs that several queries share, as DataFrames and as DuckDB SQL.

The given tables stand in for a landed corpus: each document is a raw file of
its source's topic, benchmark and conversation words are ontology labels, and
embeddings are word vectors by a hash of the word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefold.functions import delimited, text
from tablefold.operators import ontology as onto
from tablefold.operators.parse import Parsed, parse_files

DIM = 64


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, share: float = 1.0) -> DataFrame:
    """Over all cores, if the input has splits for less than that ``share`` of them; a no-op on large inputs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < share * cores else df


def files(spark: SparkSession, sf_dir: str, share: float = 1.0) -> DataFrame:
    return spread(load(spark, sf_dir, "documents"), share).select(
        F.col("doc_id").alias("file_id"), F.col("source").alias("topic"), F.col("text").alias("content")
    )


def parsed(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> Parsed:
    return parse_files(files(spark, sf_dir), keep)


def read_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of all files; texts move only where half of the cores would be idle, as columns come from first lines alone."""
    return parse_files(files(spark, sf_dir, 0.5)).columns


def label_rows(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """``(cleaned_label, domain, row_pos)``: the words of a table with an attribute of their row."""
    if source == "schema":
        rows = load(spark, sf_dir, "benchmark").select(
            F.concat(F.lit("Topic"), F.col("item_id") % 7).alias("domain"), F.col("item_id").alias("row_pos"), "text"
        )
    else:
        rows = load(spark, sf_dir, "conversations").select(
            F.col("role").alias("domain"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_pos"), "text"
        )
    worded = rows.select("domain", "row_pos", F.explode(text.words(F.col("text"))).alias("word"))
    label = text.clean_header(F.col("word"))
    return worded.select(label.alias("cleaned_label"), "domain", "row_pos").filter(F.col("cleaned_label") != "")


def ontology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ontology, type_pos, cleaned_label)`` of both ontologies."""
    one = lambda name: onto.label_positions(
        label_rows(spark, sf_dir, name).select("cleaned_label").distinct()
    ).select(F.lit(name).alias("ontology"), "type_pos", "cleaned_label")
    return one("schema").unionByName(one("dbpedia"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain votes per type."""
    one = lambda name: onto.collapse_attribute(label_rows(spark, sf_dir, name), "domain").select(
        F.lit(name).alias("ontology"), "cleaned_label", F.col("value").alias("domain"), "votes", "first_pos"
    )
    return one("schema").unionByName(one("dbpedia"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, vec)``: the embeddings, which words point to."""
    return load(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))


def word_ids(spark: SparkSession, sf_dir: str, words: DataFrame) -> DataFrame:
    """``(word, vec_id)``: for each distinct ``word`` the embedding its hash points to."""
    digest = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint")
    return words.distinct().withColumn("vec_id", F.pmod(digest, F.lit(vectors(spark, sf_dir).count())))


def vocabulary(*texts: DataFrame) -> DataFrame:
    """Words of one-column text tables."""
    union = None
    for df in texts:
        part = df.select(F.explode(text.words(F.col(df.columns[0]))).alias("word"))
        union = part if union is None else union.unionByName(part)
    return union.distinct()


# --- DuckDB ---------------------------------------------------------------------------

TOKEN_SQL = "[A-Z][a-z]+|[A-Z]+|[\\p{Nd}a-z,.\"#!$%^&*;:{}=\\-_`~()\\n\\t]+"
NULLS_SQL = ", ".join(f"'{t}'" for t in delimited.NULL_TOKENS)


def split_case_sql(x: str) -> str:
    spaced = f"regexp_replace({x}, '([A-Z])([A-Z][a-z])', '\\1 \\2', 'g')"
    return f"lower(array_to_string(regexp_extract_all({spaced}, '{TOKEN_SQL}'), ' '))"


def clean_sql(x: str) -> str:
    return f"regexp_replace({split_case_sql(x)}, '[_-]', ' ', 'g')"


def words_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def hash_sql(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT"


# Delimiter, header names, sound records and kept rows of the documents.
PARSE_SQL = f"""
doc_lines AS (
  SELECT doc_id AS file_id, source AS topic, string_split(text, chr(10)) AS lines FROM documents),
char_counts AS (
  SELECT file_id, c, count(*) AS n
  FROM (SELECT file_id, unnest(string_split(lines[1], '')) AS c FROM doc_lines)
  WHERE c <> '' AND ascii(c) < 127 GROUP BY ALL),
frequent AS (SELECT file_id, arg_max(c, (n, c)) AS c FROM char_counts GROUP BY file_id),
sniffed AS (
  SELECT d.*, CASE
    WHEN regexp_matches(lines[1], ' "[^"]*" ') THEN ' '
    WHEN contains(lines[1], ',') THEN ',' WHEN contains(lines[1], chr(9)) THEN chr(9)
    WHEN contains(lines[1], ';') THEN ';' WHEN contains(lines[1], ' ') THEN ' '
    WHEN contains(lines[1], ':') THEN ':' ELSE f.c END AS delimiter
  FROM doc_lines d LEFT JOIN frequent f USING (file_id)),
head_fields AS (
  SELECT file_id, topic, generate_subscripts(h, 1) - 1 AS col_idx, unnest(h) AS raw
  FROM (SELECT file_id, topic, string_split(lines[1], delimiter) AS h FROM sniffed WHERE delimiter IS NOT NULL)),
named0 AS (
  SELECT file_id, topic, col_idx, CASE WHEN u = '' THEN 'Unnamed: ' || col_idx ELSE u END AS name
  FROM (SELECT *, CASE WHEN raw LIKE '"%' THEN replace(raw[2:-2], '""', '"') ELSE raw END AS u FROM head_fields)),
doc_columns AS (
  SELECT file_id, topic, col_idx, CASE WHEN k > 0 THEN name || '.' || k ELSE name END AS header
  FROM (SELECT *, row_number() OVER (PARTITION BY file_id, name ORDER BY col_idx) - 1 AS k FROM named0)),
body AS (
  SELECT file_id, delimiter, len(string_split(lines[1], delimiter)) AS w,
    generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM sniffed WHERE delimiter IS NOT NULL),
recs0 AS (
  SELECT file_id, w, pos, string_split(line, delimiter) AS fields FROM body WHERE pos > 1),
recs1 AS (
  SELECT *, len(list_filter(fields, lambda f: f LIKE '"%' AND NOT regexp_full_match(f, '"[^"]*(""[^"]*)*"'))) > 0 AS spoiled
  FROM recs0 WHERE NOT (len(fields) = 1 AND trim(regexp_replace(fields[1], '\\s', ' ', 'g')) = '')),
sound AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY pos) AS rn FROM recs1 WHERE NOT spoiled),
shape0 AS (
  SELECT file_id, max(w) AS w, max(CASE WHEN rn = 1 THEN len(fields) END) AS s1,
    max(CASE WHEN rn = 2 THEN len(fields) END) AS s2 FROM sound GROUP BY file_id),
shape AS (
  SELECT file_id, CASE WHEN s2 = s1 + w THEN s1 ELSE greatest(s1 - w, 0) END AS n_index,
    coalesce(s2 = s1 + w, false) AS named FROM shape0),
kept AS (
  SELECT s.file_id, s.w, s.fields, n_index, row_number() OVER (PARTITION BY s.file_id ORDER BY pos) - 1 AS row_idx
  FROM sound s JOIN shape USING (file_id)
  WHERE NOT (named AND rn = 1) AND len(fields) <= s.w + n_index),
doc_cells AS (
  SELECT file_id, row_idx, col_idx, CASE WHEN v IN ({NULLS_SQL}) THEN NULL ELSE v END AS value
  FROM (SELECT file_id, row_idx, col_idx,
      CASE WHEN v0 LIKE '"%' THEN replace(v0[2:-2], '""', '"') ELSE v0 END AS v
    FROM (SELECT file_id, row_idx, c AS col_idx, fields[n_index + c + 1] AS v0
      FROM kept, unnest(generate_series(0, w - 1)) AS g(c))))
"""

COLUMNS_SQL = PARSE_SQL[: PARSE_SQL.index(",\nbody AS (")]

LABELS_SQL = f"""
label_rows AS (
  SELECT ontology, {clean_sql('word')} AS cleaned_label, domain, row_pos FROM (
    SELECT 'schema' AS ontology, 'Topic' || (item_id % 7) AS domain, item_id AS row_pos, unnest({words_sql('text')}) AS word FROM benchmark
    UNION ALL
    SELECT 'dbpedia', role, conv_id * 1000 + turn, unnest({words_sql('text')}) FROM conversations)
  WHERE {clean_sql('word')} <> ''),
types AS (
  SELECT ontology, cleaned_label, row_number() OVER (PARTITION BY ontology ORDER BY cleaned_label) - 1 AS type_pos
  FROM (SELECT DISTINCT ontology, cleaned_label FROM label_rows)),
domain_counts AS (
  SELECT ontology, cleaned_label, domain, count(*) AS n, min(row_pos) AS first_pos FROM label_rows GROUP BY ALL),
type_domains AS (
  SELECT ontology, cleaned_label, domain, first_pos,
    CASE WHEN count(*) OVER (PARTITION BY ontology, cleaned_label) = 1 THEN 1 ELSE n END AS votes FROM domain_counts)
"""
