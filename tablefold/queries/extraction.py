"""Topics, search hits, size segments, file names, samples, repositories, licenses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefold.functions import text
from tablefold.operators import filters, names, segments, stats
from tablefold.queries import common as c
from tablefold.sources import landed

SCALE = 1000  # documents of a source stand for this many search results
SAMPLE = 5
SEED = 7


def topics_normalized(spark, sf_dir):
    """Parts as synsets: name and brand identify one, the words of the name are lemmas."""
    synsets = c.load(spark, sf_dir, "part").select(
        F.concat_ws(".", "p_name", "p_brand").alias("synset"), F.col("p_partkey").alias("pos"),
        F.array(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.col("p_brand")).alias("lemmas"),
    )
    return landed.normalize_topics(synsets)


def topics_from_json(spark, sf_dir):
    """JSON arrays of part attributes as topic lists."""
    lists = c.load(spark, sf_dir, "part").select("p_partkey", F.to_json(F.array("p_name", "p_brand", "p_type")).alias("json"))
    return landed.parse_topics(lists, "json", "p_partkey")


def topics_in_order(spark, sf_dir):
    """Custom topics from a column with their keys; larger positions go first."""
    topics = landed.topics_from(c.load(spark, sf_dir, "part"), "p_name", "p_partkey")
    first = topics.groupBy("topic").agg(F.max("topic_pos").alias("topic_pos"))
    return landed.processing_order(first.withColumn("topic_key", text.topic_key(F.col("topic"))))


def _responses(spark, sf_dir):
    """Pages as search responses of up to 100 hits, and a second round that repeats them by language."""
    pages = c.load(spark, sf_dir, "pages").withColumn("page", F.floor(F.col("page_id") / 100))
    hit = F.struct("page_id", F.col("url").alias("html_url"))
    listed = pages.groupBy("page").agg(F.sort_array(F.collect_list(hit)).alias("items"))
    body = F.to_json(F.struct(F.size("items").alias("total_count"), "items"))
    return listed.select("page", F.from_json(body, landed.SEARCH_SCHEMA).alias("r")).select("page", "r.*")


def search_urls(spark, sf_dir):
    one = landed.flatten_search(_responses(spark, sf_dir), "page").withColumn("round", F.lit(1))
    return landed.union_pages(one, one.withColumn("round", F.lit(2)))


def _totals(spark, sf_dir):
    docs = c.load(spark, sf_dir, "documents").groupBy(F.col("source").alias("topic")).agg(F.count("*").alias("n"))
    return docs.select("topic", (F.col("n") * SCALE).alias("total_count"))


def segmenting(spark, sf_dir):
    """Results per source and language, and whether they exceed the limit."""
    per = c.load(spark, sf_dir, "documents").groupBy("source", "lang").agg((F.count("*") * 100).alias("total_count"))
    return segments.needs_segmenting(per)


def size_segments(spark, sf_dir):
    return segments.segment_sizes(_totals(spark, sf_dir))


def size_segments_reference(spark, sf_dir):
    return segments.segment_sizes(_totals(spark, sf_dir), mode="reference")


def _sized(spark, sf_dir):
    return c.load(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("topic"), F.col("n_chars").alias("size"))


def segment_assignment(spark, sf_dir):
    return segments.assign_segments(_sized(spark, sf_dir), _totals(spark, sf_dir))


def segment_stats(spark, sf_dir):
    out = segments.segment_stats(_sized(spark, sf_dir), _totals(spark, sf_dir), mode="reference")
    return out.select(
        "topic", "n_queries", "n_segments", F.round("mean_results", 8).alias("mean_results"),
        F.round("std_results", 8).alias("std_results"), F.round(F.get("steps", F.lit(0)), 6).alias("first_step"),
        F.round(F.get("steps", F.lit(3)), 6).alias("last_step"),
    )


def _manifest(spark, sf_dir):
    """Pages as a manifest; the language in the URL is the topic."""
    url = F.col("url")
    lines = c.load(spark, sf_dir, "pages").select(
        F.get(F.split(url, "/"), F.lit(3)).alias("topic"), F.col("page_id").alias("url_pos"), "url"
    )
    return landed.manifest_rows(lines)


def _named_manifest(spark, sf_dir):
    """The language's first page numbers as file names, so that names collide."""
    name = F.concat(F.regexp_extract(F.col("url"), "/([0-9]{1,2})[0-9]*[^/]*/?$", 1), F.lit(".csv"))
    return _manifest(spark, sf_dir).withColumn("file_name", name)


def url_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)


def file_names_unique(spark, sf_dir):
    return names.dedup_file_names(_named_manifest(spark, sf_dir)).select("topic", "url_pos", "file_name", "unique_name")


def file_names_prefix(spark, sf_dir):
    named = names.dedup_file_names(_named_manifest(spark, sf_dir), mode="prefix")
    return named.select("topic", "url_pos", "file_name", "unique_name")


def file_names_split(spark, sf_dir):
    """Packed files: the base of their names ends where ``.csv`` begins."""
    packed = _named_manifest(spark, sf_dir).withColumn("file_name", F.concat("file_name", F.lit(".gz")))
    return names.dedup_file_names(packed, base="split").select("topic", "url_pos", "file_name", "unique_name")


def fetched_manifest(spark, sf_dir):
    """Labels as fetches: good documents came with status 200."""
    fetches = c.load(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, 200).otherwise(404).alias("status"))
    docs = c.load(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("topic"))
    return names.manifest_from_fetches(fetches.join(docs, "doc_id"))


def extraction_metrics(spark, sf_dir):
    docs = c.load(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "source", "lang").alias("topic"))
    topics = docs.groupBy("topic").agg(F.min("doc_id").alias("topic_pos"))
    return names.extraction_metrics(topics, docs)


def pending_topics(spark, sf_dir):
    docs = c.load(spark, sf_dir, "documents").select(F.col("doc_id").alias("topic"), "n_chars")
    done = c.load(spark, sf_dir, "labels").select(F.col("doc_id").alias("topic"))
    return names.pending_topics(docs.select("topic"), docs.filter(F.col("n_chars") > 0), done)


def url_sample(spark, sf_dir):
    docs = c.load(spark, sf_dir, "documents").select(
        F.col("source").alias("topic"), F.col("doc_id").alias("url_pos"), F.concat_ws("/", "source", "doc_id").alias("url")
    )
    return names.sample_urls(docs, SAMPLE, SEED)


def repo_keys(spark, sf_dir):
    """Page URLs as files in a repository named by host and language."""
    part = lambda i: F.get(F.split("url", "/"), F.lit(i))
    url = F.concat(F.lit("https://host/"), part(2), F.lit("/"), part(3), F.lit("/blob/main/"), part(4), F.lit(".csv"))
    return c.load(spark, sf_dir, "pages").select("page_id", text.repo_key(url).alias("k")).select("page_id", "k.owner", "k.repo")


LICENSE_LINE = "(MIT License|Apache License|CC BY-NC 4|GNU General Public License)"


def _licenses(spark, sf_dir):
    """One license per source and language: the first, by name, that its documents mention."""
    found = F.nullif(F.regexp_extract("text", LICENSE_LINE, 1), F.lit(""))
    per = c.load(spark, sf_dir, "documents").groupBy(F.col("source").alias("owner"), F.col("lang").alias("repo")).agg(
        F.min(found).alias("name")
    )
    name = F.coalesce("name", F.lit("Other"))
    status = F.when(F.col("repo") == "de", 404).otherwise(200)
    return per.select("owner", "repo", status.alias("status"), F.struct(name.alias("name")).alias("license"))


def _doc_manifest(spark, sf_dir):
    docs = c.load(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://host/"), F.concat_ws("/", "source", "lang"), F.lit("/blob/main/"), "doc_id", F.lit(".csv"))
    return docs.select(F.col("source").alias("topic"), F.col("doc_id").alias("url_pos"), url.alias("url"))


def licensed_documents(spark, sf_dir):
    kept = filters.filter_licensed(_doc_manifest(spark, sf_dir), _licenses(spark, sf_dir))
    return kept.select("topic", "url_pos", F.col("license.name").alias("license"))


def license_counts(spark, sf_dir):
    return stats.license_counts(filters.filter_licensed(_doc_manifest(spark, sf_dir), _licenses(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        topics_normalized, topics_from_json, topics_in_order, search_urls, segmenting, size_segments,
        size_segments_reference, segment_assignment, segment_stats, url_manifest, file_names_unique, file_names_prefix, file_names_split,
        fetched_manifest, extraction_metrics, pending_topics, url_sample, repo_keys, licensed_documents, license_counts,
    )
}

_BOUNDS = "(VALUES (0, 256, 2750), (1, 2750, 4756), (2, 4756, 23459), (3, 23459, 53531)) b(range_pos, lo0, hi0)"
_STEPS = f"""totals AS (SELECT source AS topic, count(*) * {SCALE} AS total_count FROM documents GROUP BY source),
steps0 AS (SELECT topic, range_pos, lo0, hi0, greatest((hi0 - lo0) / (0.25::DOUBLE * total_count / 1000), 5) AS step FROM totals, {_BOUNDS}),
steps AS (SELECT *, floor(step)::BIGINT AS fs, ceil((hi0 - lo0) / step)::BIGINT AS n FROM steps0)"""


def _segments(mode: str) -> str:
    last = 1 if mode == "cover" else 2
    return f"""{_STEPS}, segs AS (SELECT topic, range_pos, i AS segment_pos, lo0 + i * fs AS lo,
  CASE WHEN i = n - 1 THEN hi0 ELSE lo0 + (i + 1) * fs END AS hi
  FROM steps, unnest(generate_series(0::BIGINT, n - {last})) AS g(i))"""


_MANIFEST = """man AS (SELECT string_split(url, '/')[4] AS topic, page_id AS url_pos, url,
  regexp_extract(url, '/([0-9]{1,2})[0-9]*[^/]*/?$', 1) || '.csv' AS file_name FROM pages),
base AS (SELECT *, file_name[:-5] AS base, row_number() OVER (PARTITION BY topic, file_name ORDER BY url_pos) - 1 AS nth FROM man)"""
_RENAME = """named AS (SELECT *, base || '_' || k || '.csv' AS made FROM numbered)
SELECT topic, url_pos, file_name, CASE WHEN nth = 0 THEN file_name
  WHEN EXISTS (SELECT 1 FROM man m WHERE m.topic = named.topic AND m.file_name = named.made) THEN base || '_' || k || '_' || url_pos || '.csv'
  ELSE made END AS unique_name FROM named"""
_LICENSES = f"""lic AS (SELECT source AS owner, lang AS repo, coalesce(min(nullif(regexp_extract(text, '{LICENSE_LINE}', 1), '')), 'Other') AS name
  FROM documents WHERE lang <> 'de' GROUP BY ALL),
kept AS (SELECT source AS topic, doc_id AS url_pos, name AS license FROM documents JOIN lic ON owner = source AND repo = lang WHERE name <> 'Other')"""

ORACLE = {
    "topics_normalized": """SELECT p_name || '.' || p_brand AS synset, min(p_partkey) AS topic_pos, lower(p_name) AS topic,
replace(lower(p_name), ' ', '_') AS topic_key FROM part GROUP BY p_name, p_brand""",
    "topics_from_json": """SELECT p_partkey, 0 AS topic_pos, p_name AS topic FROM part UNION ALL SELECT p_partkey, 1, p_brand FROM part
UNION ALL SELECT p_partkey, 2, p_type FROM part""",
    "topics_in_order": "SELECT max(p_partkey) AS topic_pos, p_name AS topic, replace(p_name, ' ', '_') AS topic_key FROM part GROUP BY p_name ORDER BY 1 DESC",
    "search_urls": """SELECT (page_id // 100)::BIGINT AS page, item_pos, url, url || '?raw=true' AS raw_url, r AS round
FROM (SELECT *, (row_number() OVER (PARTITION BY page_id // 100 ORDER BY page_id) - 1)::INT AS item_pos FROM pages), (VALUES (1), (2)) v(r)""",
    "segmenting": "SELECT source, lang, count(*) * 100 AS total_count, count(*) * 100 > 1000 AS segmented FROM documents GROUP BY ALL",
    "size_segments": f"WITH {_segments('cover')} SELECT topic, range_pos, segment_pos, lo, hi FROM segs",
    "size_segments_reference": f"WITH {_segments('reference')} SELECT topic, range_pos, segment_pos, lo, hi FROM segs",
    "segment_assignment": f"""WITH {_segments('cover')} SELECT doc_id, topic, n_chars AS size, range_pos, segment_pos, lo, hi
FROM documents JOIN segs ON topic = source AND n_chars BETWEEN lo AND hi""",
    "segment_stats": f"""WITH {_segments('reference')}, n AS (SELECT s.topic, range_pos, segment_pos, count(doc_id) AS n
  FROM segs s LEFT JOIN documents ON topic = source AND n_chars BETWEEN lo AND hi GROUP BY ALL),
a AS (SELECT topic, count(*) AS n_segments, round(avg(n), 8) AS mean_results, round(stddev_pop(n), 8) AS std_results FROM n GROUP BY topic),
b AS (SELECT topic, sum(n)::BIGINT AS n_queries, round(max(step) FILTER (range_pos = 0), 6) AS first_step,
  round(max(step) FILTER (range_pos = 3), 6) AS last_step FROM steps GROUP BY topic)
SELECT * FROM b JOIN a USING (topic)""",
    "url_manifest": """SELECT string_split(url, '/')[4] AS topic, page_id AS url_pos, url, string_split(url, '/')[-1] AS file_name,
url || '?raw=true' AS raw_url FROM pages""",
    "file_names_unique": f"WITH {_MANIFEST}, numbered AS (SELECT *, nth AS k FROM base), {_RENAME}",
    "file_names_split": f"""WITH {_MANIFEST.replace("|| '.csv' AS file_name", "|| '.csv.gz' AS file_name").replace("file_name[:-5] AS base", "split_part(file_name, '.csv', 1) AS base")},
numbered AS (SELECT *, nth AS k FROM base), {_RENAME}""",
    "file_names_prefix": f"""WITH {_MANIFEST}, numbered AS (SELECT *, (SELECT count(*) FROM man m
  WHERE m.topic = base.topic AND m.url_pos < base.url_pos AND starts_with(m.file_name, base.base)) AS k FROM base), {_RENAME}""",
    "fetched_manifest": "SELECT doc_id, source AS topic FROM labels JOIN documents USING (doc_id) WHERE quality = 1",
    "extraction_metrics": """WITH t AS (SELECT source || '/' || lang AS topic, min(doc_id) AS topic_pos, count(*) AS n_files FROM documents GROUP BY ALL)
SELECT *, (sum(n_files) OVER (ORDER BY topic_pos DESC))::BIGINT AS running_files FROM t""",
    "pending_topics": "SELECT doc_id AS topic FROM documents WHERE n_chars > 0 AND doc_id NOT IN (SELECT doc_id FROM labels)",
    "url_sample": f"""SELECT source AS topic, doc_id AS url_pos, source || '/' || doc_id AS url FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}|' || source || '/' || doc_id), doc_id) <= {SAMPLE}""",
    "repo_keys": "SELECT page_id, string_split(url, '/')[3] AS owner, string_split(url, '/')[4] AS repo FROM pages",
    "licensed_documents": f"WITH {_LICENSES} SELECT * FROM kept",
    "license_counts": f"WITH {_LICENSES} SELECT topic, license, count(*) AS n_files FROM kept GROUP BY ALL",
}
