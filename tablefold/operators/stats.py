"""Statistics of tables and topics.

Lists that grow with the number of tables come in chunks of consecutive table
ids, so no group is gathered whole; chunk after chunk gives the full list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefold.operators.numbering import row_index

CHUNK_TABLES = 10_000
METHODS = ["syntactic", "semantic"]  # fixed values
ONTOLOGIES = ["dbpedia", "schema"]  # fixed values
#: Quantiles that are listed, per mille.
QUANTILES = (10, 100, 250, 500, 750, 900, 990)


def assign_table_ids(tables: DataFrame, topic: str = "topic", order: str = "url_pos") -> DataFrame:
    """Adds ``table_id``: 0, 1, ... per topic in URL order over the tables given."""
    return row_index(tables, [topic], order, "table_id")


def dtype_shares(columns: DataFrame, key: str = "file_id") -> DataFrame:
    """``(key, dtype, n_columns, share)``; a table has a handful of types once counted."""
    counted = columns.groupBy(key, "dtype").agg(F.count("*").alias("n_columns"))
    total = F.sum("n_columns").over(Window.partitionBy(key))
    return counted.withColumn("share", F.col("n_columns") / total)


def count_by(df: DataFrame, *by: str, out: str = "n") -> DataFrame:
    """Row count per group; combines before the shuffle."""
    return df.groupBy(*by).agg(F.count("*").alias(out))


def dtype_counts(columns: DataFrame, topic: str = "topic") -> DataFrame:
    return count_by(columns, topic, "dtype", out="n_columns")


def license_counts(licensed: DataFrame, topic: str = "topic") -> DataFrame:
    """Files per topic and license name, whether or not they are kept later."""
    named = licensed.select(topic, F.col("license.name").alias("license"))
    return count_by(named, topic, "license", out="n_files")


def type_counts(annotations: DataFrame, *by: str) -> DataFrame:
    """Annotated columns per ontology, method and type."""
    return count_by(annotations, *by, "ontology", "method", "cleaned_label", out="n_columns")


def type_similarities(annotations: DataFrame, *by: str) -> DataFrame:
    """Spread of the similarities of each type, semantic annotations only."""
    return (
        annotations.filter(F.col("method") == "semantic")
        .groupBy(*by, "ontology", "cleaned_label")
        .agg(
            F.count("*").alias("n"),
            F.avg("similarity").alias("mean_similarity"),
            F.stddev_pop("similarity").alias("std_similarity"),
            F.min("similarity").alias("min_similarity"),
            F.max("similarity").alias("max_similarity"),
        )
    )


def spread_of_counts(counted: DataFrame, by: Sequence[str], value: str, count: str = "n", per_mille: Sequence[int] = QUANTILES) -> DataFrame:
    """Spread and exact quantiles of values given in counted form, for all groups at once.

    ``counted`` has one row per group and value. The quantile at ``q`` per mille
    (``p<q>``) is the smallest value with at least that share of the rows at or
    below it. The window goes over a group's different values, not its rows:
    similarities have four decimals, so those are 20,001 at most.
    """
    upto = Window.partitionBy(*by).orderBy(value)
    placed = counted.withColumn("_upto", F.sum(count).over(upto)).withColumn("_all", F.sum(count).over(Window.partitionBy(*by)))
    n, v = F.col(count), F.col(value)
    quantile = lambda q: F.min(F.when(F.col("_upto") * 1000 >= F.col("_all") * q, v)).alias(f"p{q}")
    mean = F.sum(n * v) / F.sum(n)
    return placed.withColumn("_mean", F.sum(n * v).over(Window.partitionBy(*by)) / F.col("_all")).groupBy(*by).agg(
        F.sum(n).alias("n"), mean.alias(f"mean_{value}"), F.sqrt(F.sum(n * (v - F.col("_mean")) * (v - F.col("_mean"))) / F.sum(n)).alias(f"std_{value}"),
        F.min(v).alias(f"min_{value}"), F.max(v).alias(f"max_{value}"), *[quantile(q) for q in per_mille],
    )


def chunked_list(
    df: DataFrame, by: Sequence[str], position: str, value: Column, out: str, ties: Sequence[str] = (),
    chunk_tables: int = CHUNK_TABLES,
) -> DataFrame:
    """``(by, chunk, out)``: values listed by position, one list per run of positions."""
    chunk = F.floor(F.col(position) / chunk_tables)
    keyed = df.withColumn("chunk", chunk).withColumn("_item", F.struct(position, *ties, value.alias("_v")))
    listed = F.sort_array(F.collect_list("_item"))
    return keyed.groupBy(*by, "chunk").agg(F.transform(listed, lambda s: s["_v"]).alias(out))


def annotated_columns(tables: DataFrame, annotations: DataFrame, key: str = "file_id") -> DataFrame:
    """``(key, ontology, method, n_columns)`` for every table and kind of annotation, zero where none."""
    kinds = F.array(*[F.struct(F.lit(o).alias("ontology"), F.lit(m).alias("method")) for o in ONTOLOGIES for m in METHODS])
    every = tables.select(key, F.explode(kinds).alias("k")).select(key, "k.*")
    counts = count_by(annotations, key, "ontology", "method", out="n_columns")
    return every.join(counts, [key, "ontology", "method"], "left").fillna(0, ["n_columns"])


def table_domains_or_none(tables: DataFrame, domains: DataFrame, key: str = "file_id") -> DataFrame:
    """The domain of every table and kind of annotation, null where there is none."""
    kinds = F.array(*[F.struct(F.lit(o).alias("ontology"), F.lit(m).alias("method")) for o in ONTOLOGIES for m in METHODS])
    every = tables.select("*", F.explode(kinds).alias("k")).select(*tables.columns, "k.*")
    return every.join(domains.select(key, "ontology", "method", "domain"), [key, "ontology", "method"], "left")


def funnel(staged: DataFrame, topic: str = "topic") -> DataFrame:
    """Files per topic that reach each stage.

    ``staged`` has one row per URL with the flags ``licensed``, ``landed``, ``parsed`` and ``social``.
    """
    parsed = F.col("licensed") & F.col("parsed")
    return staged.groupBy(topic).agg(
        F.count("*").alias("files"),
        F.count_if("licensed").alias("licensed_files"),
        F.count_if(F.col("licensed") & F.col("landed")).alias("landed_files"),
        F.count_if(parsed & F.col("social")).alias("removed_social_tables"),
        F.count_if(parsed & ~F.col("social")).alias("written_tables"),
    )
