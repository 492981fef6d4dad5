"""Personal-data columns: find them, replace their values, count them; values of bias columns.

Works on ``column_types`` rows ``(key, col_idx, header, dbpedia_type, schema_type)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold.functions.delimited import null_value
from tablefold.operators.joins import sized_join
from tablefold.operators.names import seeded_hash
from tablefold.operators.numbering import top_k

# Types whose columns are always replaced.
DBPEDIA_PERSONAL = ["address", "person", "birth date", "birth place", "postal code", "street"]
SCHEMA_PERSONAL = ["email", "telephone", "home location"]
# Fixed value: replaced only beside another personal type.
NAME_TYPE = "name"
PERSONAL_TYPES = [*DBPEDIA_PERSONAL, *SCHEMA_PERSONAL, NAME_TYPE]
# Types whose value counts are kept.
BIAS_TYPES = [
    "city", "country", "continent", "gender", "religion", "race", "skin color", "nationality", "ethnicity",
]
TOP_VALUES = 100  # fixed value

# Made-up values by the kind of thing they stand for.
_PEOPLE = ["Ada Moss", "Ben Hale", "Cleo Park", "Dan Rowe", "Eve Lind", "Finn Ash", "Gia Holt", "Hal Quist"]
_CITIES = ["Aldham", "Birkwick", "Calder Bay", "Dunmere", "Eastholm", "Farrowby", "Glenford", "Hartsea"]
_STREETS = ["Acorn Way", "Bridge Lane", "Canal Row", "Dale Street", "Elm Court", "Ferry Road", "Grove Hill", "Hazel Close"]
REPLACEMENTS = {
    "address": [f"{12 * (i + 1)} {s}, {c}" for i, (s, c) in enumerate(zip(_STREETS, _CITIES))],
    "person": _PEOPLE,
    "birth date": [f"{1950 + 7 * i}-0{i + 1}-1{i}" for i in range(8)],
    "birth place": _CITIES,
    "postal code": [f"{10417 + 9871 * i}" for i in range(8)],
    "street": _STREETS,
    "email": [p.lower().replace(" ", ".") + "@example.org" for p in _PEOPLE],
    "telephone": [f"555-01{i}{i + 1}" for i in range(8)],
    "home location": _CITIES,
    "name": _PEOPLE,
}


def replaced_columns(types: DataFrame, key: str = "file_id") -> DataFrame:
    """``(key, col_idx, header, step, personal_type)``: each replacement of a column.

    Step 1 follows the DBpedia type, else the schema.org type. Step 2 replaces
    ``name`` columns of tables that have some other personal type; a column can
    go through both, and the later value stays.
    """
    dbpedia, schema = F.col("dbpedia_type"), F.col("schema_type")
    by_type = F.when(dbpedia.isin(DBPEDIA_PERSONAL), dbpedia).when(schema.isin(SCHEMA_PERSONAL), schema)
    first = types.withColumn("personal_type", by_type).filter(F.col("personal_type").isNotNull())
    others = [*DBPEDIA_PERSONAL, *SCHEMA_PERSONAL]
    beside = types.filter(dbpedia.isin(others) | schema.isin(others)).select(key).distinct()
    names = types.filter((dbpedia == NAME_TYPE) | (schema == NAME_TYPE))
    second = names.join(beside, key, "left_semi").withColumn("personal_type", F.lit(NAME_TYPE))
    out = lambda df, step: df.select(key, "col_idx", "header", F.lit(step).alias("step"), "personal_type")
    return out(first, 1).unionByName(out(second, 2))


def final_types(replaced: DataFrame, key: str = "file_id") -> DataFrame:
    """``(key, col_idx, personal_type)``: what each replaced column ends up as."""
    return replaced.groupBy(key, "col_idx").agg(F.max_by("personal_type", "step").alias("personal_type"))


def stand_in(personal_type: Column, seed: int, key: Column, col_idx: Column, row_idx: Column) -> Column:
    """A made-up value that depends on the place of the cell, not on what it holds."""
    digest = F.conv(F.substring(seeded_hash(seed, key, col_idx, row_idx), 1, 8), 16, 10).cast("bigint")
    known = F.create_map(*[x for name, values in REPLACEMENTS.items() for x in (F.lit(name), F.array(*map(F.lit, values)))])
    sizes = {len(values) for values in REPLACEMENTS.values()}
    assert len(sizes) == 1  # one size, so one remainder serves every type
    return F.get(F.element_at(known, personal_type), F.pmod(digest, F.lit(sizes.pop())).cast("int"))


def anonymize_cells(cells: DataFrame, replaced: DataFrame, seed: int = 0, key: str = "file_id") -> DataFrame:
    """Cells ``(key, col_idx, row_idx, value)`` with every value of replaced columns made up."""
    marked = sized_join(cells, final_types(replaced, key), [key, "col_idx"], "left")
    value = F.when(
        F.col("personal_type").isNotNull(),
        stand_in(F.col("personal_type"), seed, F.col(key), F.col("col_idx"), F.col("row_idx")),
    ).otherwise(F.col("value"))
    return marked.withColumn("value", value).select(*cells.columns)


def anonymize_rows(rows: DataFrame, replaced: DataFrame, seed: int = 0, key: str = "file_id") -> DataFrame:
    """Rows ``(key, row_idx, fields)`` with every value of replaced columns made up.

    The join carries one small map per table; rows stay whole.
    """
    per_table = (
        final_types(replaced, key)
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("col_idx", "personal_type"))).alias("_types"))
    )
    marked = sized_join(rows, per_table, [key], "left")
    made = F.transform(
        "fields",
        lambda v, i: F.when(
            F.col("_types")[i].isNotNull(), stand_in(F.col("_types")[i], seed, F.col(key), i, F.col("row_idx"))
        ).otherwise(v),
    )
    fields = F.when(F.col("_types").isNull(), F.col("fields")).otherwise(made)
    return marked.withColumn("fields", fields).select(*rows.columns)


def anonymized_headers(replaced: DataFrame, key: str = "file_id") -> DataFrame:
    """``(key, anonymized_columns)``: replaced headers in column order; a twice replaced one is there twice."""
    listed = F.sort_array(F.collect_list(F.struct("col_idx", "step", "header")))
    return replaced.groupBy(key).agg(F.transform(listed, lambda s: s["header"]).alias("anonymized_columns"))


def _zero_filled(counts: DataFrame, names: list[str], name_col: str, groups: DataFrame | None) -> DataFrame:
    every = F.explode(F.array(*[F.lit(n) for n in names])).alias(name_col)
    spark = counts.sparkSession
    base = spark.range(1).select(every) if groups is None else groups.select("*", every)
    on = base.columns
    return base.join(counts, on, "left").fillna(0, ["n_columns"])


def personal_counts(replaced: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Replacements per personal type (and per group column of ``groups``), zero where none."""
    by = [] if groups is None else groups.columns
    counts = replaced.groupBy(*by, "personal_type").agg(F.count("*").alias("n_columns"))
    return _zero_filled(counts, PERSONAL_TYPES, "personal_type", groups)


def bias_columns(types: DataFrame) -> DataFrame:
    return types.filter(F.col("dbpedia_type").isin(BIAS_TYPES)).withColumnRenamed("dbpedia_type", "bias_type")


def bias_counts(types: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Columns per bias type (and per group), zero where none."""
    by = [] if groups is None else groups.columns
    counts = bias_columns(types).groupBy(*by, "bias_type").agg(F.count("*").alias("n_columns"))
    return _zero_filled(counts, BIAS_TYPES, "bias_type", groups)


def bias_values(cells: DataFrame, types: DataFrame, key: str = "file_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Cells of bias columns with their type; run it on anonymised cells."""
    marked = bias_columns(types).select(key, "col_idx", "bias_type")
    joined = sized_join(cells, marked, [key, "col_idx"])
    return joined.filter(F.col("value").isNotNull()).select(*carry, key, "col_idx", "row_idx", "bias_type", "value")


def bias_values_of_rows(rows: DataFrame, types: DataFrame, key: str = "file_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``bias_values`` from rows ``(key, row_idx, fields)``: only the bias columns of a row are taken out."""
    marked = bias_columns(types).groupBy(key).agg(F.collect_list(F.struct("col_idx", "bias_type")).alias("_columns"))
    joined = sized_join(rows, marked, [key]).select(*carry, key, "row_idx", "fields", F.explode("_columns").alias("_c"))
    value = F.get("fields", F.col("_c.col_idx"))
    taken = joined.select(*carry, key, "_c.col_idx", "row_idx", "_c.bias_type", F.when(~null_value(value), value).alias("value"))
    return taken.filter(F.col("value").isNotNull())


def bias_top_values(values: DataFrame, order: list[str], k: int = TOP_VALUES, groups: tuple[str, ...] = ()) -> DataFrame:
    """The ``k`` most frequent values per bias type; ties go to the value seen first in ``order``."""
    counted = values.groupBy(*groups, "bias_type", "value").agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("_first")
    )
    return top_counted_values(counted, k, groups)


def top_counted_values(counted: DataFrame, k: int = TOP_VALUES, groups: tuple[str, ...] = ()) -> DataFrame:
    """``bias_top_values`` from values counted before: ``n`` and ``_first``, where each is seen first."""
    best = top_k(counted, [*groups, "bias_type"], [F.col("n").desc(), F.col("_first").asc(), F.col("value").asc()], k)
    return best.drop("_first")
