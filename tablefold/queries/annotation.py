"""Headers to types: exact, by similarity; domains; annotation counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefold.functions import text
from tablefold.operators import domain, filters, match, stats
from tablefold.operators import ontology as onto
from tablefold.queries import common as c
from tablefold.session import cut_lineage

THRESHOLD = match.SIMILARITY_THRESHOLD


def _columns(spark, sf_dir):
    return c.parsed(spark, sf_dir).columns


def _syntactic(spark, sf_dir):
    return match.match_syntactic(_columns(spark, sf_dir), c.ontology(spark, sf_dir))


def syntactic_types(spark, sf_dir):
    return _syntactic(spark, sf_dir).drop("similarity")


def _word_ids(spark, sf_dir, labels, columns):
    heads = columns.select(text.clean_header(F.col("header")).alias("text"))
    return c.word_ids(spark, sf_dir, c.vocabulary(heads, labels.select("cleaned_label")))


def text_vectors(spark, sf_dir):
    """Vectors of the distinct clean headers."""
    heads = _columns(spark, sf_dir).select(text.clean_header(F.col("header")).alias("text")).distinct()
    words = c.word_ids(spark, sf_dir, c.vocabulary(heads))
    embedded = match.embed_text(heads, words, c.DIM, vectors=c.vectors(spark, sf_dir))
    return embedded.select("text", F.posexplode("vec").alias("k", "x")).withColumn("x", F.round("x", 6))


def _semantic(spark, sf_dir):
    # In use, columns, ontology and words are stored tables; here they are stored once derived.
    columns, ontology = cut_lineage(c.read_columns(spark, sf_dir).select("file_id", "col_idx", "header")), cut_lineage(c.ontology(spark, sf_dir))
    words, vectors = cut_lineage(_word_ids(spark, sf_dir, ontology, columns)), c.vectors(spark, sf_dir)
    types = match.embed_types(ontology, words, c.DIM, vectors, firsts=True)
    return match.match_semantic(columns, ontology, types, words, c.DIM, THRESHOLD, vectors=vectors)


def semantic_types(spark, sf_dir):
    return _semantic(spark, sf_dir)


def similarity_pairs(spark, sf_dir):
    """All pairs of embeddings above a threshold, the lower id as header and the other as type."""
    rows = c.load(spark, sf_dir, "embeddings")
    heads = rows.select(F.col("vec_id").cast("string").alias("header"), F.col("embedding").alias("vec"))
    types = rows.select(F.lit("embeddings").alias("ontology"), F.col("vec_id").alias("type_pos"), F.col("embedding").alias("vec"))
    pairs = match.similar_types(c.spread(heads), types, c.DIM, 0.3).filter(F.col("header").cast("bigint") < F.col("type_pos"))
    return pairs.select(F.col("header").cast("bigint").alias("vec_id"), F.col("type_pos").alias("other_id"),
                        F.round("similarity", 4).alias("similarity"))


def nearest_label(spark, sf_dir):
    """For each embedding, read backwards, the best one of every label by similarity; labels act as ontologies."""
    rows = c.load(spark, sf_dir, "embeddings")
    heads = rows.select(F.col("vec_id").cast("string").alias("header"), F.reverse("embedding").alias("vec"))
    types = rows.select(F.col("label").cast("string").alias("ontology"), F.col("vec_id").alias("type_pos"), F.col("embedding").alias("vec"))
    best = match.best_types(c.spread(heads), types, c.DIM, 0.3)
    return best.select(F.col("header").cast("bigint").alias("vec_id"), F.col("ontology").cast("int").alias("label"),
                       F.col("type_pos").alias("other_id"), F.round("similarity", 4).alias("similarity"))


def _both(spark, sf_dir):
    return _syntactic(spark, sf_dir).unionByName(_semantic(spark, sf_dir))


def column_types(spark, sf_dir):
    return filters.column_types(_semantic(spark, sf_dir))


def annotation_entries(spark, sf_dir):
    """Exact annotations with the entry of their type: its first row as id, its domains as a list."""
    rows = c.label_rows(spark, sf_dir, "schema")
    entry = onto.collapse_labels(rows.withColumn("id", F.col("row_pos").cast("string")), ["id", "domain"])
    ontology = c.ontology(spark, sf_dir).join(entry.withColumn("ontology", F.lit("schema")), ["ontology", "cleaned_label"])
    found = match.with_entries(_syntactic(spark, sf_dir).filter(F.col("ontology") == "schema"), ontology)
    return found.select("file_id", "col_idx", "header", "type_pos", F.size("id").alias("n_ids"), F.array_join("domain", ",").alias("domains"),
                        F.col("description").isNull().alias("undescribed"))


def type_domains(spark, sf_dir):
    return c.domains(spark, sf_dir)


def table_domains(spark, sf_dir):
    """Domain by exact matches."""
    return domain.table_domain(_syntactic(spark, sf_dir), c.domains(spark, sf_dir))


def table_domains_semantic(spark, sf_dir):
    return domain.table_domain(_semantic(spark, sf_dir), c.domains(spark, sf_dir))


def type_counts(spark, sf_dir):
    topics = c.files(spark, sf_dir).select("file_id", "topic")
    return stats.type_counts(_both(spark, sf_dir).join(topics, "file_id"), "topic")


def type_similarities(spark, sf_dir):
    out = stats.type_similarities(_semantic(spark, sf_dir))
    total = F.round(F.col("mean_similarity") * F.col("n"), 4)
    return out.select("ontology", "cleaned_label", "n", total.alias("total_similarity"),
                      F.round("std_similarity", 6).alias("std_similarity"), "min_similarity", "max_similarity")


def type_quantiles(spark, sf_dir):
    """Exact quantiles of each type's similarities, from counts per different similarity."""
    counted = _semantic(spark, sf_dir).groupBy("ontology", "cleaned_label", "similarity").agg(F.count("*").alias("n"))
    out = stats.spread_of_counts(counted, ["ontology", "cleaned_label"], "similarity")
    return out.select("ontology", "cleaned_label", "n", "min_similarity", "max_similarity", *[f"p{q}" for q in stats.QUANTILES])


def annotated_columns(spark, sf_dir):
    tables = c.files(spark, sf_dir).select("file_id")
    return stats.annotated_columns(tables, _both(spark, sf_dir))


def label_uniqueness(spark, sf_dir):
    """Labels per ontology and domain, and how many of them repeat over domains."""
    types = c.domains(spark, sf_dir).select("ontology", "cleaned_label")
    repeated = onto.assert_unique_labels(types)
    return types.groupBy("ontology").agg(F.count("*").alias("n_labels")).join(
        repeated.groupBy("ontology").agg(F.count("*").alias("n_repeated")), "ontology", "left"
    ).fillna(0, ["n_repeated"])


QUERIES = {
    f.__name__: f
    for f in (
        syntactic_types, text_vectors, semantic_types, similarity_pairs, nearest_label, column_types, annotation_entries, type_domains,
        table_domains, table_domains_semantic, type_counts, type_similarities, type_quantiles, annotated_columns, label_uniqueness,
    )
}

_SYN = f"""{c.COLUMNS_SQL}, {c.LABELS_SQL},
syn AS (
  SELECT file_id, arg_min(header, col_idx) AS header, min(col_idx) AS col_idx, ontology, 'syntactic' AS method, type_pos,
    cleaned_label, NULL::DOUBLE AS similarity
  FROM (SELECT file_id, col_idx, header, {c.clean_sql('header')} AS cleaned_label FROM doc_columns) JOIN types USING (cleaned_label)
  GROUP BY file_id, ontology, type_pos, cleaned_label)"""

_VECS = f"""
uv AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS u FROM embeddings),
texts AS (SELECT DISTINCT text FROM (SELECT {{heads}} AS text FROM doc_columns {{where}} {{labels}})),
tok AS (SELECT text, unnest({c.words_sql('text')}) AS word FROM texts),
dims AS (SELECT text, unnest(u) AS x, generate_subscripts(u, 1) AS k
  FROM tok JOIN uv ON vec_id = {c.hash_sql('word')} % (SELECT count(*) FROM embeddings)),
means AS (SELECT text, k, avg(x) AS x FROM dims GROUP BY ALL)"""
_HEADS_VECS = _VECS.format(heads=c.clean_sql("header"), where="", labels="")
_ALL_VECS = _VECS.format(heads=c.clean_sql("header"), where="", labels="UNION ALL SELECT cleaned_label FROM types")

_SEM = f"""{_ALL_VECS},
vecs AS (SELECT text, list(x ORDER BY k) AS v FROM means GROUP BY text),
usable AS (SELECT file_id, col_idx, header, {c.clean_sql('header')} AS text FROM doc_columns
  WHERE NOT starts_with(header, 'Unnamed:') AND NOT regexp_matches(header, '\\p{{N}}')),
heads AS (SELECT DISTINCT text, v FROM usable JOIN vecs USING (text)),
tv AS (SELECT ontology, type_pos, cleaned_label, v FROM types JOIN vecs ON vecs.text = cleaned_label),
sims AS (SELECT h.text, ontology, type_pos, cleaned_label, round(list_cosine_similarity(h.v, tv.v), 12) AS sim FROM heads h, tv),
best AS (SELECT text, ontology, arg_max(struct_pack(type_pos := type_pos, cleaned_label := cleaned_label, sim := sim), (sim, -type_pos)) AS b
  FROM sims WHERE sim > {THRESHOLD} GROUP BY text, ontology),
sem AS (SELECT file_id, header, col_idx, ontology, 'semantic' AS method, b.type_pos AS type_pos, b.cleaned_label AS cleaned_label,
  round(b.sim, 4) AS similarity FROM usable JOIN best USING (text))"""

_ANN = f"WITH {_SYN}, {_SEM}"


def _domain_sql(ann: str) -> str:
    return f"""votes AS (SELECT file_id, ontology, method, domain, sum(votes) AS votes,
  min((CASE WHEN method = 'syntactic' THEN type_pos ELSE col_idx END, first_pos)) AS first
  FROM {ann} JOIN type_domains USING (ontology, cleaned_label) GROUP BY ALL)
SELECT file_id, ontology, method, domain, votes::BIGINT AS votes FROM votes
QUALIFY row_number() OVER (PARTITION BY file_id, ontology, method ORDER BY votes DESC, first, domain) = 1"""


_COS = "list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"
ORACLE = {
    "syntactic_types": f"WITH {_SYN} SELECT * EXCLUDE (similarity) FROM syn",
    "text_vectors": f"WITH {c.COLUMNS_SQL}, {_HEADS_VECS} SELECT text, (k - 1)::INT AS k, round(x, 6) AS x FROM means",
    "semantic_types": f"{_ANN} SELECT * FROM sem",
    "similarity_pairs": f"""SELECT a.vec_id, b.vec_id AS other_id, round({_COS}, 4) AS similarity
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_COS} > 0.3""",
    "nearest_label": f"""WITH s AS (SELECT a.vec_id, b.label, b.vec_id AS other_id, round({_COS.replace('a.embedding', 'list_reverse(a.embedding)')}, 12) AS sim FROM embeddings a, embeddings b)
SELECT vec_id, label, other_id, round(sim, 4) AS similarity FROM s WHERE sim > 0.3
QUALIFY row_number() OVER (PARTITION BY vec_id, label ORDER BY sim DESC, other_id) = 1""",
    "annotation_entries": f"""WITH {_SYN},
ids AS (SELECT cleaned_label, count(DISTINCT row_pos) AS k, count(*) AS n FROM label_rows WHERE ontology = 'schema' GROUP BY ALL),
doms AS (SELECT cleaned_label, string_agg(array_to_string(list_transform(range(votes), lambda i: domain), ','), ',' ORDER BY first_pos, domain) AS domains
  FROM type_domains WHERE ontology = 'schema' GROUP BY ALL)
SELECT file_id, col_idx, header, type_pos, CASE WHEN k = 1 THEN 1 ELSE n END::INT AS n_ids, domains, true AS undescribed
FROM syn JOIN ids USING (cleaned_label) JOIN doms USING (cleaned_label) WHERE ontology = 'schema'""",
    "column_types": f"""{_ANN} SELECT file_id, col_idx, min(header) AS header,
max(cleaned_label) FILTER (ontology = 'dbpedia') AS dbpedia_type, max(cleaned_label) FILTER (ontology = 'schema') AS schema_type
FROM sem GROUP BY file_id, col_idx""",
    "type_domains": f"WITH {c.LABELS_SQL} SELECT ontology, cleaned_label, domain, votes, first_pos FROM type_domains",
    "table_domains": f"WITH {_SYN}, {_domain_sql('syn')}",
    "table_domains_semantic": f"{_ANN}, {_domain_sql('sem')}",
    "type_counts": f"""{_ANN}, a AS (SELECT * FROM syn UNION ALL BY NAME SELECT * FROM sem)
SELECT source AS topic, ontology, method, cleaned_label, count(*) AS n_columns
FROM a JOIN documents ON doc_id = file_id GROUP BY ALL""",
    "type_similarities": f"""{_ANN} SELECT ontology, cleaned_label, count(*) AS n, round(sum(similarity), 4) AS total_similarity,
round(stddev_pop(similarity), 6) AS std_similarity, min(similarity) AS min_similarity, max(similarity) AS max_similarity FROM sem GROUP BY ALL""",
    "type_quantiles": f"""{_ANN} SELECT ontology, cleaned_label, count(*) AS n, min(similarity) AS min_similarity, max(similarity) AS max_similarity,
{', '.join(f"quantile_disc(similarity, {q / 1000}) AS p{q}" for q in stats.QUANTILES)} FROM sem GROUP BY ALL""",
    "annotated_columns": f"""{_ANN}, a AS (SELECT * FROM syn UNION ALL BY NAME SELECT * FROM sem),
n AS (SELECT file_id, ontology, method, count(*) AS n FROM a GROUP BY ALL)
SELECT d.doc_id AS file_id, o.ontology, m.method, coalesce(n.n, 0) AS n_columns FROM documents d,
(VALUES ('dbpedia'), ('schema')) o(ontology), (VALUES ('syntactic'), ('semantic')) m(method)
LEFT JOIN n ON n.file_id = d.doc_id AND n.ontology = o.ontology AND n.method = m.method""",
    "label_uniqueness": f"""WITH {c.LABELS_SQL},
n AS (SELECT ontology, cleaned_label, count(*) AS n FROM type_domains WHERE domain IS NOT NULL GROUP BY ALL)
SELECT ontology, sum(n)::BIGINT AS n_labels, count(*) FILTER (n > 1) AS n_repeated FROM n GROUP BY ontology""",
}
