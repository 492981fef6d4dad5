"""Ontology preparation on the part table: graphs, bindings, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefold.operators import ontology as onto
from tablefold.queries import common as c
from tablefold.sources import ontologies

NAMESPACE = "http://dbpedia.org/ontology"


def _nodes(spark, sf_dir):
    """Parts as JSON-LD nodes: links as one object or a list, labels as text or object."""
    part = c.load(spark, sf_dir, "part")
    link = lambda col: F.struct(col.alias("@id"))
    brand, kind = link(F.concat(F.lit("schema:"), "p_brand")), link(F.concat(F.lit("schema:"), "p_type"))
    big = F.col("p_size") > 25
    label = F.concat(F.lower("p_type"), F.initcap(F.replace(F.col("p_name"), F.lit(" "), F.lit(""))), F.lit("X"), "p_size")
    ident = F.concat(F.lit("schema:p"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    listed, single = F.to_json(F.array(kind, brand)), F.to_json(brand)
    node = F.struct(
        ident.alias("@id"), F.lit("rdf:Property").alias("@type"), F.col("p_name").alias("rdfs:comment"),
        F.when(big, F.to_json(F.struct(label.alias("@value")))).otherwise(label).alias("rdfs:label"),
        F.lit(None).cast("string").alias("rdfs:subClassOf"), F.when(big, listed).otherwise(single).alias("schema:domainIncludes"),
        F.to_json(kind).alias("schema:rangeIncludes"), F.lit(None).cast("string").alias("rdfs:subPropertyOf"),
    )
    return ontologies.explode_graph(part.select(F.array(node).alias("@graph")))


def graph_flattened(spark, sf_dir):
    flat = onto.flatten_graph(_nodes(spark, sf_dir))
    return flat.select("id", "cleaned_label", "description", "kind", F.array_join("domain", ",").alias("domains"),
                       F.array_join("range", ",").alias("ranges"), F.size("domain").alias("n_domains"))


def ontology_deduped(spark, sf_dir):
    built = onto.alias_identifier(onto.dedup_labels(onto.flatten_graph(_nodes(spark, sf_dir))))
    return built.select("type_pos", "cleaned_label", "id")


def graph_ontology(spark, sf_dir):
    built = onto.build_graph_ontology(_nodes(spark, sf_dir))
    return built.select("ontology", "type_pos", "cleaned_label", F.get("id", F.lit(0)).alias("id"),
                        F.array_join("domain", ",").alias("domains"))


def _bindings(spark, sf_dir):
    """Parts as result pages of property bindings; small parts have no domain, other namespaces occur."""
    part = c.load(spark, sf_dir, "part")
    space = F.when(F.col("p_type") == "PROMO", F.lit("http://example.org/")).otherwise(F.lit(NAMESPACE + "/"))
    value = lambda col: F.struct(col.alias("value"))
    name = F.replace(F.initcap("p_name"), F.lit(" "), F.lit(""))
    binding = F.struct(
        value(F.concat(space, name)).alias("property"), value(F.col("p_type")).alias("range"),
        value(F.when(F.col("p_size") > 5, F.col("p_brand"))).alias("domain"), value(F.col("p_name")).alias("description"),
        value(F.lit(None).cast("string")).alias("superproperty"),
    )
    body = F.to_json(F.struct(F.struct(F.array(binding).alias("bindings")).alias("results")))
    pages = part.select("p_partkey", F.from_json(body, ontologies.PAGE_SCHEMA).alias("p")).select("p_partkey", "p.results")
    return ontologies.explode_bindings(pages, "p_partkey").withColumnRenamed("p_partkey", "row_pos").drop("binding_pos")


def bindings_flattened(spark, sf_dir):
    return _bindings(spark, sf_dir)


def property_labels(spark, sf_dir):
    rows = onto.property_rows(_bindings(spark, sf_dir))
    return rows.select("row_pos", "id", "cleaned_label")


def ontology_collapsed(spark, sf_dir):
    """Domains per label in counted form."""
    return onto.collapse_attribute(onto.property_rows(_bindings(spark, sf_dir)), "domain")


def properties_outer(spark, sf_dir):
    """Part names as properties with optional attributes from distinct part columns."""
    part = c.load(spark, sf_dir, "part")
    pairs = lambda col, keep: part.filter(keep).select(F.col("p_name").alias("property"), F.col(col).alias("value")).distinct()
    none = F.lit(False)
    comments = pairs("p_type", F.col("p_size") > 45).withColumn(
        "lang", F.when(F.col("value") == "SMALL", "de").otherwise("en-GB")
    )
    return onto.properties_outer(
        part.select(F.col("p_name").alias("property")).distinct(), pairs("p_brand", F.col("p_size") > 40), comments,
        pairs("p_type", F.col("p_size") == 50), pairs("p_brand", none),
    )


def outer_votes(spark, sf_dir):
    """Votes of attribute values per label: brands as properties with many values of each attribute, their combinations counted only."""
    part = c.load(spark, sf_dir, "part")
    name = F.replace(F.initcap("p_name"), F.lit(" "), F.lit(""))
    prop = F.concat(F.lit(NAMESPACE + "/"), F.when(F.col("p_size") % 2 == 0, F.lit("deep/")).otherwise(F.lit("")), name)
    pairs = lambda value, keep: part.filter(keep).select(prop.alias("property"), value.cast("string").alias("value"))
    size = F.col("p_size")
    comments = pairs(F.col("p_retailprice"), size > 20).withColumn("lang", F.when(F.col("value").endswith("1"), "de").otherwise("en"))
    return onto.outer_votes(
        part.select(prop.alias("property")), pairs(F.col("p_brand"), size > 10), comments, pairs(F.col("p_type"), size > 5), pairs(size, size > 30)
    )


QUERIES = {
    f.__name__: f
    for f in (
        graph_flattened, ontology_deduped, graph_ontology, bindings_flattened, property_labels, ontology_collapsed, properties_outer, outer_votes,
    )
}

_NODES = f"""nodes AS (SELECT 'schema:p' || lpad(p_partkey::VARCHAR, 9, '0') AS id,
  {c.split_case_sql("lower(p_type) || upper(p_name[1]) || replace(p_name[2:], ' ', '') || 'X' || p_size")} AS raw,
  p_name AS description, 'rdf:Property' AS kind,
  CASE WHEN p_size > 25 THEN 'schema:' || p_type || ',schema:' || p_brand ELSE 'schema:' || p_brand END AS domains,
  'schema:' || p_type AS ranges, CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS n_domains FROM part),
labelled AS (SELECT * EXCLUDE (raw), nullif(raw, '') AS cleaned_label FROM nodes),
firsts AS (SELECT cleaned_label, min(id) AS id, arg_min(domains, id) AS domains FROM labelled GROUP BY cleaned_label)"""
_INITCAP = "upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:]"
_BINDINGS = f"""binds AS (SELECT p_partkey AS row_pos,
  CASE WHEN p_type = 'PROMO' THEN 'http://example.org/' ELSE '{NAMESPACE}/' END || {_INITCAP} AS property,
  p_type AS range, CASE WHEN p_size > 5 THEN p_brand END AS domain, p_name AS description, NULL::VARCHAR AS superproperty FROM part),
props AS (SELECT *, {c.split_case_sql("string_split(property, '/')[-1]")} AS cleaned_label FROM binds WHERE starts_with(property, '{NAMESPACE}'))"""
ORACLE = {
    "graph_flattened": f"WITH {_NODES} SELECT id, cleaned_label, description, kind, domains, ranges, n_domains FROM labelled",
    "ontology_deduped": f"WITH {_NODES} SELECT row_number() OVER (ORDER BY cleaned_label) - 1 AS type_pos, cleaned_label, id FROM firsts",
    "graph_ontology": f"""WITH {_NODES} SELECT 'schema' AS ontology, row_number() OVER (ORDER BY cleaned_label) - 1 AS type_pos,
cleaned_label, id, domains FROM firsts""",
    "bindings_flattened": f"WITH {_BINDINGS} SELECT * FROM binds",
    "property_labels": f"WITH {_BINDINGS} SELECT row_pos, property AS id, cleaned_label FROM props",
    "ontology_collapsed": f"""WITH {_BINDINGS}, n AS (SELECT cleaned_label, domain AS value, count(*) AS n, min(row_pos) AS first_pos FROM props GROUP BY ALL),
k AS (SELECT *, count(*) OVER (PARTITION BY cleaned_label) AS kinds FROM n)
SELECT cleaned_label, value, CASE WHEN kinds = 1 THEN 1 ELSE n END AS votes, first_pos FROM k WHERE value IS NOT NULL""",
    "properties_outer": """WITH p AS (SELECT DISTINCT p_name AS property FROM part),
d AS (SELECT DISTINCT p_name AS property, p_brand AS domain FROM part WHERE p_size > 40),
k AS (SELECT DISTINCT p_name AS property, p_type AS description FROM part WHERE p_size > 45 AND p_type <> 'SMALL'),
r AS (SELECT DISTINCT p_name AS property, p_type AS range FROM part WHERE p_size = 50)
SELECT DISTINCT property, domain, description, range, NULL::VARCHAR AS superproperty
FROM p LEFT JOIN d USING (property) LEFT JOIN k USING (property) LEFT JOIN r USING (property)""",
    "outer_votes": f"""WITH m AS (SELECT *, '{NAMESPACE}/' || CASE WHEN p_size % 2 = 0 THEN 'deep/' ELSE '' END || {_INITCAP} AS property FROM part),
p AS (SELECT DISTINCT property FROM m),
r AS (SELECT DISTINCT property, p_type AS range FROM m WHERE p_size > 5),
d AS (SELECT DISTINCT property, p_brand AS domain FROM m WHERE p_size > 10),
k AS (SELECT DISTINCT property, p_retailprice::VARCHAR AS description FROM m WHERE p_size > 20 AND p_retailprice::VARCHAR NOT LIKE '%1'),
s AS (SELECT DISTINCT property, p_size::VARCHAR AS superproperties FROM m WHERE p_size > 30),
combos AS (SELECT {c.split_case_sql("string_split(property, '/')[-1]")} AS cleaned_label, * RENAME (property AS id)
  FROM p LEFT JOIN r USING (property) LEFT JOIN d USING (property) LEFT JOIN k USING (property) LEFT JOIN s USING (property)),
long AS (SELECT cleaned_label, id, unnest(['range', 'domain', 'description', 'superproperties', 'id']) AS attribute, unnest([range, domain, description, superproperties, id]) AS value FROM combos),
n AS (SELECT attribute, cleaned_label, value, count(*) AS n, min(id) AS first_property FROM long GROUP BY ALL),
t AS (SELECT *, count(*) OVER (PARTITION BY attribute, cleaned_label) AS kinds FROM n)
SELECT attribute, cleaned_label, value, CASE WHEN kinds = 1 THEN 1 ELSE n END AS votes, first_property FROM t WHERE value IS NOT NULL""",
}
