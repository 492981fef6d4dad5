"""The whole job on the documents: tables, stages, lists and JSON per table and topic."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablefold import sinks
from tablefold.functions import text
from tablefold.operators import privacy, stats
from tablefold.operators.numbering import row_index
from tablefold.plans import corpus as plan
from tablefold.plans import topic_counts
from tablefold.queries import common as c
from tablefold.queries import extraction
from tablefold.session import cut_lineage, shared_folder

CHUNK = 16
LANDED_CHARS = 1000


def _inputs(spark, sf_dir, stored=cut_lineage):
    """Ontology and words, which jobs on the same documents may share."""
    ontology = stored(c.ontology(spark, sf_dir))
    headers = c.read_columns(spark, sf_dir).select(text.clean_header(F.col("header")).alias("text"))
    return ontology, stored(c.word_ids(spark, sf_dir, c.vocabulary(headers, ontology.select("cleaned_label"))))


def _corpus(spark, sf_dir, cut=cut_lineage, files=None, annotated=True, inputs=None) -> plan.Corpus:
    """The job on the documents; what only annotations read is planned but not stored where none are asked for."""
    docs = c.files(spark, sf_dir) if files is None else files
    name = F.concat("file_id", F.lit(".csv"))
    files = docs.select("topic", name.alias("file_name"), "file_id", "content")
    manifest = extraction._doc_manifest(spark, sf_dir)
    manifest = manifest.withColumn("file_name", text.url_file_name(F.col("url")))
    ontology, words = inputs or _inputs(spark, sf_dir, cut if annotated else lambda df: df)
    return plan.Corpus(
        files=files, manifest=manifest, licenses=extraction._licenses(spark, sf_dir), ontology=ontology,
        word_vectors=words, dim=c.DIM, domain_votes=c.domains(spark, sf_dir), cut=cut, vectors=c.vectors(spark, sf_dir),
    )


def corpus_tables(spark, sf_dir):
    tables = _corpus(spark, sf_dir).tables
    return tables.select("topic", "table_id", "file_id", "n_rows", "n_columns", F.col("license.name").alias("license"), "output_name")


def _faulty(spark, sf_dir, cut=cut_lineage) -> plan.Corpus:
    """Short documents have not landed, Spanish ones have a social header, French ones no header line."""
    docs = c.load(spark, sf_dir, "documents").filter(F.length("text") >= LANDED_CHARS)
    content = F.when(F.col("lang") == "es", F.concat(F.lit("tweet "), "text")).when(F.col("lang") == "fr", F.concat(F.lit("\n"), "text"))
    files = c.spread(docs).select(
        F.col("doc_id").alias("file_id"), F.col("source").alias("topic"), F.coalesce(content, "text").alias("content")
    )
    return _corpus(spark, sf_dir, cut, files, annotated=False)


def funnel(spark, sf_dir):
    return stats.funnel(_faulty(spark, sf_dir).staged)


def corpus_rejects(spark, sf_dir):
    """Licensed files that are not there or cannot be parsed, with their URLs."""
    return _faulty(spark, sf_dir).rejects


def table_ids(spark, sf_dir):
    """Documents numbered per source."""
    docs = c.load(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("topic"), F.col("doc_id").alias("url_pos"))
    return stats.assign_table_ids(docs).drop("url_pos")


def event_ids(spark, sf_dir):
    """Events numbered per type: few groups, each a large share of all rows."""
    events = c.load(spark, sf_dir, "events").select("event_type", "event_id")
    return row_index(events, ["event_type"], "event_id", "place", bucket_rows=1000)


def shape_lists(spark, sf_dir):
    """Row counts per topic, listed in chunks of table ids."""
    tables = _corpus(spark, sf_dir).tables
    listed = stats.chunked_list(tables, ["topic"], "table_id", F.col("n_rows"), "row_counts", chunk_tables=CHUNK)
    return listed.select("topic", "chunk", F.to_json("row_counts").alias("row_counts"))


def dtype_share_lists(spark, sf_dir):
    job = _corpus(spark, sf_dir)
    shares = stats.dtype_shares(job.columns).join(job.tables.select("file_id", "topic", "table_id"), "file_id")
    listed = stats.chunked_list(shares, ["topic", "dtype"], "table_id", F.round(F.col("share") * 1000).cast("bigint"), "shares", chunk_tables=CHUNK)
    return listed.select("topic", "dtype", "chunk", F.to_json("shares").alias("shares"))


def domain_lists(spark, sf_dir):
    """Domain of every table and kind of annotation, null where there is none."""
    job = _corpus(spark, sf_dir, cut=cut_lineage)
    ids = job.tables.select("file_id", "topic", "table_id")
    return stats.table_domains_or_none(ids, job.domains).drop("file_id")


def table_metadata_json(spark, sf_dir):
    """The JSON of each table, read back: a row per header with the table's own entries."""
    schema = "table_id bigint, table_csv_url string, number_rows bigint, number_columns int, dtypes map<string,string>, license struct<name:string>"
    read = plan.table_metadata(_corpus(spark, sf_dir)).select("file_id", F.from_json("metadata", schema).alias("m"))
    return read.select(
        "file_id", "m.table_id", F.col("m.table_csv_url").alias("url"), F.col("m.number_rows").alias("n_rows"),
        F.col("m.number_columns").alias("n_columns"), F.col("m.license.name").alias("license"), F.explode("m.dtypes").alias("header", "dtype"),
    )


def _entries(stat: str, counts, *outer):
    """Members of a map as ``stat, name, n``; names are led by the key of the map around it."""
    entry = lambda e: F.struct(F.lit(stat).alias("stat"), F.concat_ws(":", *outer, e["key"]).alias("name"), e["value"].alias("n"))
    return F.transform(F.map_entries(counts), entry)


def _flat(name: str, kind: str):
    if kind.startswith("map<string,map"):
        return F.flatten(F.transform(F.map_entries(name), lambda e: _entries(name, e["value"], e["key"])))
    if kind.startswith("map"):
        return _entries(name, F.col(name))
    return F.array(F.struct(F.lit(name).alias("stat"), F.lit("").alias("name"), F.col(name).alias("n")))


def topic_stats(spark, sf_dir):
    """All counts per topic, one per row; entries of nested counts are named by both keys."""
    return _listed(plan.topic_stats(_corpus(spark, sf_dir)))


def _listed(stats_rows):
    out = cut_lineage(stats_rows)
    parts = [out.select("topic", F.explode(_flat(name, kind)).alias("e")) for name, kind in out.dtypes if name != "topic"]
    listed = parts[0]
    for part in parts[1:]:
        listed = listed.unionByName(part)
    return listed.select("topic", "e.*")


def topic_stats_batches(spark, sf_dir):
    """``topic_stats`` from counts of two batches of every topic, one of them written twice, that are added up."""
    path = f"{shared_folder(spark)}/counts-{uuid.uuid4().hex}"
    inputs = _inputs(spark, sf_dir)
    for odd in (1, 0):
        job = _corpus(spark, sf_dir, files=c.files(spark, sf_dir).filter(F.col("file_id") % 2 == odd), inputs=inputs)
        job.only = job.manifest.filter(F.col("url_pos") % 2 == odd)
        counts = topic_counts.topic_counts(job)
        counts = cut_lineage(counts) if odd else counts  # one batch is written twice, but counted once
        for _ in range(1 + odd):
            topic_counts.write_counts(counts, path, odd)
    return _listed(topic_counts.stats_of(topic_counts.read_counts(spark, path)))


def topic_series(spark, sf_dir):
    """All lists per topic, one member per row: a number or a domain."""
    out = plan.topic_series(_corpus(spark, sf_dir), CHUNK)
    member = out.select("topic", "series", "name", "chunk", F.posexplode(F.from_json("values", "array<string>")).alias("pos", "v"))
    is_domain = F.col("series") == "table_domains"
    return member.select(
        "topic", "series", "name", "chunk", "pos", F.when(~is_domain, F.round(F.expr("try_cast(v AS double)"), 4)).alias("number"),
        F.when(is_domain, F.get_json_object("v", "$.domain")).alias("domain"),
    )


def typed_table(spark, sf_dir):
    """Customers from cells back to a typed wide table."""
    cols = {"c_custkey": "int64", "c_name": "object", "c_nationkey": "int64", "c_acctbal": "float64", "c_mktsegment": "object"}
    fields = F.array(*[F.col(x).cast("string") for x in cols])
    rows = c.load(spark, sf_dir, "customer").select(fields.alias("fields"))
    return rows.select(*sinks.typed_columns(F.col("fields"), list(cols), list(cols.values())))


QUERIES = {
    f.__name__: f
    for f in (
        corpus_tables, funnel, corpus_rejects, table_ids, event_ids, shape_lists, dtype_share_lists, domain_lists, table_metadata_json,
        topic_stats, topic_stats_batches, topic_series, typed_table,
    )
}

_TABLES = f"""{extraction._LICENSES},
k AS (SELECT file_id, count(*) AS n FROM kept_rows GROUP BY ALL),
w AS (SELECT file_id, topic, count(*) AS n_columns, bool_or(regexp_matches(header, 'twitter|tweet|facebook|reddit')) AS social FROM doc_columns GROUP BY ALL),
tables AS (SELECT w.topic, row_number() OVER (PARTITION BY w.topic ORDER BY w.file_id) - 1 AS table_id, w.file_id, coalesce(k.n, 0) AS n_rows,
  n_columns::INT AS n_columns, license FROM w JOIN kept ON kept.url_pos = w.file_id LEFT JOIN k ON k.file_id = w.file_id WHERE NOT social)"""
_PARSE = c.PARSE_SQL.replace("kept AS (", "kept_rows AS (").replace("FROM kept,", "FROM kept_rows,")


def _typed() -> str:
    from tablefold.queries.parsing import _dtypes_sql

    return _dtypes_sql("doc_cells", "doc_columns", "file_id")


def _domains() -> str:
    from tablefold.queries import annotation as a

    return f"""{a._SYN.replace(c.COLUMNS_SQL + ',', '')}, {a._SEM},
ann AS (SELECT * FROM syn UNION ALL BY NAME SELECT * FROM sem),
{a._domain_sql('ann').replace(')' + chr(10) + 'SELECT file_id', '),' + chr(10) + 'voted AS (SELECT file_id')})"""


_LISTS = f"""listed AS (
  SELECT topic, 'row_counts' AS series, '' AS name, table_id, 0 AS tie, n_rows::DOUBLE AS number, NULL::VARCHAR AS domain FROM tables
  UNION ALL SELECT topic, 'column_counts', '', table_id, 0, n_columns, NULL FROM tables
  UNION ALL SELECT t.topic, 'dtypes_percentages', dtype, table_id, 0, round(n / n_columns, 4), NULL
    FROM (SELECT file_id, dtype, count(*) AS n FROM typed GROUP BY ALL) JOIN tables t USING (file_id)
  UNION ALL SELECT topic, 'table_domains', o.ontology || '_' || m.method, table_id, 0, NULL, domain FROM tables t,
    (VALUES ('dbpedia'), ('schema')) o(ontology), (VALUES ('syntactic'), ('semantic')) m(method)
    LEFT JOIN voted v ON v.file_id = t.file_id AND v.ontology = o.ontology AND v.method = m.method
  UNION ALL SELECT topic, 'number_of_annotated_columns', o.ontology || '_' || m.method, table_id, 0, coalesce(a.n, 0), NULL FROM tables t,
    (VALUES ('dbpedia'), ('schema')) o(ontology), (VALUES ('syntactic'), ('semantic')) m(method)
    LEFT JOIN (SELECT file_id, ontology, method, count(*) AS n FROM ann GROUP BY ALL) a
      ON a.file_id = t.file_id AND a.ontology = o.ontology AND a.method = m.method
  UNION ALL SELECT t.topic, 'annotation_type_similarities', ontology || '_semantic.' || cleaned_label, table_id, col_idx, similarity, NULL
    FROM sem JOIN tables t USING (file_id))"""

ORACLE = {
    "table_metadata_json": f"""WITH {_PARSE}, {_TABLES}, {_typed()}
SELECT t.file_id, table_id, 'https://host/' || source || '/' || lang || '/blob/main/' || doc_id || '.csv' AS url, n_rows, n_columns, license, header, dtype
FROM tables t JOIN typed USING (file_id) JOIN documents ON doc_id = t.file_id""",
    "topic_stats": f"""WITH {_PARSE}, {_TABLES}, {_typed()}, {_domains()},
l AS (SELECT d.source AS topic, kept.license, w.social, kept.url_pos IS NOT NULL AS ok
  FROM documents d LEFT JOIN kept ON kept.url_pos = doc_id LEFT JOIN w ON w.file_id = doc_id)
SELECT topic, 'files' AS stat, '' AS name, count(*) AS n FROM l GROUP BY topic
UNION ALL SELECT topic, 'licensed_files', '', count(*) FILTER (ok) FROM l GROUP BY topic
UNION ALL SELECT topic, 'landed_files', '', count(*) FILTER (ok) FROM l GROUP BY topic
UNION ALL SELECT topic, 'removed_social_tables', '', count(*) FILTER (ok AND social) FROM l GROUP BY topic
UNION ALL SELECT topic, 'written_tables', '', count(*) FILTER (ok AND NOT social) FROM l GROUP BY topic
UNION ALL SELECT topic, 'licenses', license, count(*) FROM l WHERE ok GROUP BY ALL
UNION ALL SELECT t.topic, 'dtype_counts', dtype, count(*) FROM typed JOIN tables t USING (file_id) GROUP BY ALL
UNION ALL SELECT DISTINCT topic, 'pii_column_counts', unnest([{', '.join(f"'{x}'" for x in privacy.PERSONAL_TYPES)}]), 0 FROM l
UNION ALL SELECT DISTINCT topic, 'dbpedia_bias_column_count', unnest([{', '.join(f"'{x}'" for x in privacy.BIAS_TYPES)}]), 0 FROM l
UNION ALL SELECT t.topic, 'annotation_type_counts', ontology || '_' || method || ':' || cleaned_label, count(*) FROM ann JOIN tables t USING (file_id) GROUP BY ALL""",
    "topic_series": f"""WITH {_PARSE}, {_TABLES}, {_typed()}, {_domains()}, {_LISTS}
SELECT topic, series, name, (table_id // {CHUNK})::BIGINT AS chunk,
  (row_number() OVER (PARTITION BY topic, series, name, table_id // {CHUNK} ORDER BY table_id, tie) - 1)::INT AS pos, number, domain FROM listed""",
    "corpus_tables": f"WITH {_PARSE}, {_TABLES} SELECT *, file_id || '.parquet' AS output_name FROM tables",
    "funnel": f"""WITH {extraction._LICENSES},
l AS (SELECT source, lang, url_pos IS NOT NULL AS licensed, url_pos IS NOT NULL AND length(text) >= {LANDED_CHARS} AS landed
  FROM documents LEFT JOIN kept ON kept.url_pos = doc_id)
SELECT source AS topic, count(*) AS files, count(*) FILTER (licensed) AS licensed_files, count(*) FILTER (landed) AS landed_files,
  count(*) FILTER (landed AND lang = 'es') AS removed_social_tables,
  count(*) FILTER (landed AND lang NOT IN ('es', 'fr')) AS written_tables
FROM l GROUP BY source""",
    "corpus_rejects": f"""WITH {extraction._LICENSES},
l AS (SELECT d.*, 'https://host/' || source || '/' || lang || '/blob/main/' || doc_id || '.csv' AS url FROM documents d JOIN kept ON url_pos = doc_id)
SELECT source AS topic, url, NULL::BIGINT AS file_id, 'missing' AS stage, 'not landed' AS reason FROM l WHERE length(text) < {LANDED_CHARS}
UNION ALL SELECT source, url, doc_id, 'parse', 'no delimiter' FROM l WHERE length(text) >= {LANDED_CHARS} AND lang = 'fr'""",
    "table_ids": "SELECT doc_id, source AS topic, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS table_id FROM documents",
    "event_ids": "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS place FROM events",
    "shape_lists": f"""WITH {_PARSE}, {_TABLES} SELECT topic, (table_id // {CHUNK})::BIGINT AS chunk,
'[' || string_agg(n_rows::VARCHAR, ',' ORDER BY table_id) || ']' AS row_counts FROM tables GROUP BY ALL""",
    "dtype_share_lists": f"""WITH {_PARSE}, {_TABLES}, {_typed()},
s AS (SELECT *, round(n * 1000 / sum(n) OVER (PARTITION BY file_id))::BIGINT AS v FROM (SELECT file_id, dtype, count(*) AS n FROM typed GROUP BY ALL))
SELECT topic, dtype, (table_id // {CHUNK})::BIGINT AS chunk, '[' || string_agg(v::VARCHAR, ',' ORDER BY table_id) || ']' AS shares
FROM s JOIN tables USING (file_id) GROUP BY ALL""",
    "domain_lists": f"""WITH {_PARSE}, {_TABLES}, {_domains()}
SELECT topic, table_id, o.ontology, m.method, domain FROM tables t, (VALUES ('dbpedia'), ('schema')) o(ontology),
(VALUES ('syntactic'), ('semantic')) m(method)
LEFT JOIN voted v ON v.file_id = t.file_id AND v.ontology = o.ontology AND v.method = m.method""",
    "typed_table": "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
}
ORACLE["topic_stats_batches"] = ORACLE["topic_stats"]
