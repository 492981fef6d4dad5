"""Ontology preparation.

An ontology is ``(ontology, type_pos, cleaned_label, id, description, kind,
domain, range, superclasses, superproperties)``; list attributes are arrays of
strings. ``type_pos`` is the place in label order and breaks ties in matching.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold.functions import text
from tablefold.operators.numbering import places

IDENTIFIER_ID = "schema:identifier"  # fixed value
IDENTIFIER_LABEL = "id"  # fixed value
PROPERTY_NAMESPACE = "http://dbpedia.org/ontology"  # fixed value
LIST_ATTRIBUTES = ["domain", "range", "superclasses", "superproperties"]


def as_id_list(raw: Column) -> Column:
    """``@id`` values of a JSON text holding one link object or a list of them."""
    many = F.transform(F.from_json(raw, "array<struct<`@id`:string>>"), lambda x: x["@id"])
    one = F.array(F.get_json_object(raw, "$.@id"))
    return F.when(raw.isNull(), None).when(raw.startswith("["), many).otherwise(one)


def plain_label(raw: Column) -> Column:
    """A label given as text or as an object with ``@value``."""
    return F.when(raw.startswith("{"), F.get_json_object(raw, "$.@value")).otherwise(raw)


def null_text(col: Column) -> Column:
    """Null for an empty text or the word ``nan``."""
    return F.nullif(F.nullif(col, F.lit("")), F.lit("nan"))


def flatten_graph(nodes: DataFrame) -> DataFrame:
    """Rows of JSON-LD nodes (link fields as JSON text) with id lists and cleaned labels."""
    return nodes.select(
        F.col("@id").alias("id"),
        null_text(text.split_case(plain_label(F.col("rdfs:label")))).alias("cleaned_label"),
        plain_label(F.col("rdfs:comment")).alias("description"),
        F.col("@type").alias("kind"),
        as_id_list(F.col("schema:domainIncludes")).alias("domain"),
        as_id_list(F.col("schema:rangeIncludes")).alias("range"),
        as_id_list(F.col("rdfs:subClassOf")).alias("superclasses"),
        as_id_list(F.col("rdfs:subPropertyOf")).alias("superproperties"),
    )


def label_positions(df: DataFrame, label: str = "cleaned_label", out: str = "type_pos") -> DataFrame:
    """Adds the zero-based place of each (distinct) label in label order; a null label comes first.

    Spark deals the labels into ranges of about equal size by sampled splitters, so
    labels that begin alike spread like others. A label's place is its place in its
    range and the sizes of the ranges before; one row per range reaches the driver.
    """
    dealt = places(df, [label], "_place")
    sizes = dict(dealt.groupBy(F.shiftright("_place", 33).cast("int")).count().collect())
    ranges = sorted(sizes)
    offsets = list(zip(ranges, accumulate((sizes[r] for r in ranges), initial=0), strict=False))
    smaller = df.sparkSession.createDataFrame(offsets, "_range int, _offset bigint")
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        dealt.withColumn("_range", F.shiftright("_place", 33).cast("int"))
        .join(F.broadcast(smaller), "_range")
        .withColumn(out, F.col("_offset") + inside)
        .select(*df.columns, out)
    )


def dedup_labels(df: DataFrame) -> DataFrame:
    """One row per label, the one with the smallest id, with ``type_pos``."""
    others = [c for c in df.columns if c not in ("cleaned_label", "id")]
    first = (
        df.filter(F.col("cleaned_label").isNotNull())
        .groupBy("cleaned_label")
        .agg(F.min(F.struct("id", *others)).alias("_first"))
        .select("cleaned_label", "_first.*")
    )
    return label_positions(first.select(*df.columns))


def alias_identifier(df: DataFrame) -> DataFrame:
    """The identifier property is also known as ``id``; its place stays."""
    label = F.when(F.col("id") == IDENTIFIER_ID, F.lit(IDENTIFIER_LABEL)).otherwise(F.col("cleaned_label"))
    return df.withColumn("cleaned_label", label)


def assert_unique_labels(df: DataFrame) -> DataFrame:
    """Labels that occur more than once within an ontology; empty when all is well."""
    return df.groupBy("ontology", "cleaned_label").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def lowest_per_label(df: DataFrame) -> DataFrame:
    """Of types that share a label after renaming, the one that comes first."""
    others = [c for c in df.columns if c not in ("ontology", "cleaned_label", "type_pos")]
    first = df.groupBy("ontology", "cleaned_label").agg(F.min(F.struct("type_pos", *others)).alias("_first"))
    return first.select("ontology", "cleaned_label", "_first.*").select(*df.columns)


def build_graph_ontology(nodes: DataFrame, name: str = "schema") -> DataFrame:
    """The ontology of JSON-LD nodes."""
    built = alias_identifier(dedup_labels(flatten_graph(nodes)))
    listed = built.select(
        F.lit(name).alias("ontology"), "type_pos", "cleaned_label",
        *[F.when(F.col(c).isNotNull(), F.array(c)).alias(c) for c in ("id", "description", "kind")],
        *LIST_ATTRIBUTES,
    )
    return lowest_per_label(listed)


def properties_outer(
    properties: DataFrame,
    domains: DataFrame,
    comments: DataFrame,
    ranges: DataFrame,
    superproperties: DataFrame,
    language: str = "en",
) -> DataFrame:
    """Distinct combinations of the optional attributes of each property.

    Inputs are ``(property, value)``; comments also carry ``lang``.
    """
    spoken = comments.filter(F.lower("lang").startswith(language)).select("property", F.col("value").alias("description"))
    joined = (
        properties.select("property")
        .join(ranges.withColumnRenamed("value", "range"), "property", "left")
        .join(domains.withColumnRenamed("value", "domain"), "property", "left")
        .join(spoken, "property", "left")
        .join(superproperties.withColumnRenamed("value", "superproperty"), "property", "left")
    )
    return joined.distinct()


def outer_votes(
    properties: DataFrame,
    domains: DataFrame,
    comments: DataFrame,
    ranges: DataFrame,
    superproperties: DataFrame,
    language: str = "en",
    namespace: str = PROPERTY_NAMESPACE,
) -> DataFrame:
    """``(attribute, cleaned_label, value, votes, first_property)``: what ``properties_outer`` collapses to, its rows never formed.

    Inputs are those of ``properties_outer``. A property has as many combinations as
    the product of its attributes' numbers of values (one where it has none), and
    a value is in the product of the *other* attributes' numbers. Summed over the
    properties of a label this gives the votes of ``collapse_attribute``, with work
    in proportion to the values given. ``first_property`` is the first property, in
    order of names, that has the value. More combinations of a property than a
    64-bit number holds are an error.
    """
    spoken = comments.filter(F.lower("lang").startswith(language)).select("property", "value")
    sources = {"range": ranges, "domain": domains, "description": spoken, "superproperties": superproperties}
    own = properties.select("property").distinct()
    labelled = property_rows(own).select(F.col("id").alias("property"), "cleaned_label").filter(F.col("cleaned_label").isNotNull())
    given = None
    for name, values in sources.items():
        part = values.select("property", F.lit(name).alias("attribute"), "value").distinct()
        given = part if given is None else given.unionByName(part)
    widths = given.groupBy("property").agg(*[F.count_if(F.col("attribute") == a).alias(a) for a in sources])
    known = labelled.join(widths, "property", "left").fillna(0, list(sources))
    wide = {a: F.greatest(F.col(a), F.lit(1)) for a in sources}
    whole = reduce(lambda x, y: x * y, wide.values())
    shares = F.create_map(*[x for a in sources for x in (F.lit(a), reduce(lambda x, y: x * y, [w for b, w in wide.items() if b != a]))])
    sized = known.select("property", "cleaned_label", whole.alias("_whole"), shares.alias("_shares"), *sources)
    valued = sized.join(given, "property").select("property", "cleaned_label", "attribute", "value", F.element_at("_shares", F.col("attribute")).alias("n"))
    absent = sized.select(
        "property", "cleaned_label", F.explode(F.filter(F.array(*[F.when(F.col(a) == 0, F.lit(a)) for a in sources]), lambda a: a.isNotNull())).alias("attribute"),
        F.lit(None).cast("string").alias("value"), F.col("_whole").alias("n"),
    )
    ids = sized.select("property", "cleaned_label", F.lit("id").alias("attribute"), F.col("property").alias("value"), F.col("_whole").alias("n"))
    counted = valued.unionByName(absent).unionByName(ids).groupBy("attribute", "cleaned_label", "value").agg(
        F.sum("n").alias("n"), F.min("property").alias("first_property")
    )
    kinds = counted.groupBy("attribute", "cleaned_label").agg(F.count("*").alias("_kinds"))
    joined = counted.join(kinds, ["attribute", "cleaned_label"]).filter(F.col("value").isNotNull())
    votes = F.when(F.col("_kinds") == 1, F.lit(1).cast("bigint")).otherwise(F.col("n"))
    return joined.select("attribute", "cleaned_label", "value", votes.alias("votes"), "first_property")


def domain_votes(votes: DataFrame, name: str = "dbpedia") -> DataFrame:
    """``(ontology, cleaned_label, domain, votes, first_pos)`` for the vote on tables, from ``outer_votes``.

    Places ascend in the order of the properties that have a domain first.
    """
    mine = votes.filter(F.col("attribute") == "domain").select("cleaned_label", F.col("value").alias("domain"), "votes", "first_property")
    placed = places(mine, ["cleaned_label", "first_property", "domain"], "first_pos").drop("first_property")
    return placed.select(F.lit(name).alias("ontology"), "cleaned_label", "domain", "votes", "first_pos")


def property_rows(bindings: DataFrame, namespace: str = PROPERTY_NAMESPACE) -> DataFrame:
    """Rows of the namespace with cleaned labels and the ontology's column names."""
    kept = bindings.filter(text.in_namespace(F.col("property"), namespace))
    label = text.split_case(text.last_segment(F.col("property")))
    return kept.withColumn("cleaned_label", null_text(label)).withColumnsRenamed(
        {"property": "id", "superproperty": "superproperties"}
    )


def collapse_attribute(rows: DataFrame, attribute: str, label: str = "cleaned_label", pos: str = "row_pos") -> DataFrame:
    """``(label, value, votes, first_pos)``: the values an attribute takes per label, with multiplicity.

    This is the list of a label's values in counted form: it holds one row per
    distinct value, however many rows share the label. Where all rows of a
    label agree the list shrinks to one vote; a null among them prevents that,
    and carries no vote itself.
    """
    counted = rows.groupBy(label, F.col(attribute).alias("value")).agg(
        F.count("*").alias("n"), F.min(pos).alias("first_pos")
    )
    spread = counted.groupBy(label).agg(F.count("*").alias("_kinds"))
    joined = counted.join(spread, label).filter(F.col("value").isNotNull())
    votes = F.when(F.col("_kinds") == 1, F.lit(1).cast("bigint")).otherwise(F.col("n"))
    return joined.select(label, "value", votes.alias("votes"), "first_pos")


def collapse_labels(
    rows: DataFrame, attributes: Sequence[str], label: str = "cleaned_label", pos: str = "row_pos"
) -> DataFrame:
    """One row per label with every attribute as a list.

    A list holds each value as often as rows have it, values in the order they
    come first; one value that all rows agree on is there once. Rows are counted
    per value before they are gathered.
    """
    out = rows.groupBy(label).agg(F.count("*").alias("_n")).drop("_n")
    for attribute in attributes:
        counted = collapse_attribute(rows, attribute, label, pos)
        entries = F.sort_array(F.collect_list(F.struct("first_pos", "value", F.col("votes").cast("int").alias("votes"))))
        repeated = F.flatten(F.transform(entries, lambda e: F.array_repeat(e["value"], e["votes"])))
        out = out.join(counted.groupBy(label).agg(repeated.alias(attribute)), label, "left")
        out = out.withColumn(attribute, F.coalesce(attribute, F.array().cast("array<string>")))
    return out


def build_property_ontology(bindings: DataFrame, name: str = "dbpedia") -> DataFrame:
    """The ontology of property bindings ``(property, range, domain, description, superproperty, row_pos)``."""
    rows = property_rows(bindings).filter(F.col("cleaned_label").isNotNull())
    attributes = ["id", "description", "domain", "range", "superproperties"]
    built = label_positions(collapse_labels(rows, attributes))
    none = F.lit(None).cast("array<string>")
    return built.select(
        F.lit(name).alias("ontology"), "type_pos", "cleaned_label", "id", "description",
        none.alias("kind"), "domain", "range", none.alias("superclasses"), "superproperties",
    )
