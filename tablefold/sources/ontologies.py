"""Ontology sources: JSON-LD graphs, SPARQL result pages, dated snapshots."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields of a node. Link fields hold one object or a list, so they are read as JSON text.
_NODE_FIELDS = [
    "@id", "@type", "rdfs:comment", "rdfs:label", "rdfs:subClassOf", "schema:domainIncludes",
    "schema:rangeIncludes", "rdfs:subPropertyOf",
]
NODE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in _NODE_FIELDS])
GRAPH_SCHEMA = T.StructType([T.StructField("@graph", T.ArrayType(NODE_SCHEMA))])

# Variables of the property query.
BINDING_FIELDS = ["property", "range", "domain", "description", "superproperty"]
_VALUE = T.StructType([T.StructField("value", T.StringType())])
BINDING_SCHEMA = T.StructType([T.StructField(name, _VALUE) for name in BINDING_FIELDS])
PAGE_SCHEMA = T.StructType(
    [T.StructField("results", T.StructType([T.StructField("bindings", T.ArrayType(BINDING_SCHEMA))]))]
)


def explode_graph(documents: DataFrame) -> DataFrame:
    """Nodes of documents read with ``GRAPH_SCHEMA``."""
    return documents.select(F.explode("@graph").alias("n")).select("n.*")


def read_jsonld(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of a JSON-LD graph; link fields as JSON text."""
    return explode_graph(spark.read.schema(GRAPH_SCHEMA).json(path, multiLine=True))


def explode_bindings(pages: DataFrame, *keep: str) -> DataFrame:
    """``(property, range, domain, description, superproperty, binding_pos)`` of result pages."""
    rows = pages.select(*keep, F.posexplode("results.bindings").alias("binding_pos", "b"))
    return rows.select(*keep, "binding_pos", *[F.col(f"b.{f}.value").alias(f) for f in BINDING_FIELDS])


def read_sparql_json(spark: SparkSession, path: str) -> DataFrame:
    """All rows of landed result pages; ``row_pos`` orders them by page number, page file name and place."""
    pages = spark.read.schema(PAGE_SCHEMA).json(path, multiLine=True)
    pages = pages.withColumn("page", F.col("_metadata.file_name"))
    rows = explode_bindings(pages, "page")
    number = F.coalesce(F.regexp_extract("page", "([0-9]+)", 1).try_cast("bigint"), F.lit(0))
    return rows.withColumn("row_pos", F.struct(number.alias("number"), "page", "binding_pos")).drop("page", "binding_pos")


def snapshot_stamp(date: str | None = None) -> str:
    """``YYYYMMDD``, today unless given; read once on the driver."""
    return date or datetime.date.today().strftime("%Y%m%d")


def write_ontology(ontology: DataFrame, path: str, date: str | None = None) -> None:
    """Store one snapshot; other dates and ontologies stay."""
    stamped = ontology.withColumn("snapshot_date", F.lit(snapshot_stamp(date)))
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ontology", "snapshot_date")
        .parquet(path)
    )


def read_ontology(
    spark: SparkSession, path: str, date: str | None = None, build: Callable[[], DataFrame] | None = None
) -> DataFrame:
    """The snapshot of a date; only its folders are read.

    One that is absent is built, stored and read back; without ``build`` it is an error.
    """
    stamp = snapshot_stamp(date)

    def stored() -> DataFrame | None:
        try:
            table = spark.read.option("basePath", path).parquet(path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        found = table.filter(F.col("snapshot_date").cast("string") == stamp).drop("snapshot_date")
        return None if found.isEmpty() else found

    found = stored()
    if found is None and build is not None:
        write_ontology(build(), path, stamp)
        found = stored()
    if found is None:
        raise ValueError(f"no ontology of {stamp} in {path}")
    return found
