"""Every query against its DuckDB counterpart on the smallest data; slow ones are left to the driver."""

import pytest

import __spark_entry__ as entry_points
import compare

SF_DIR = "/root/testdata/sf0.001"
QUICK = [
    "topics_normalized", "search_urls", "size_segments", "segment_assignment", "file_names_unique", "file_names_prefix",
    "extraction_metrics", "pending_topics", "url_sample", "license_counts", "graph_flattened", "ontology_collapsed",
    "delimiters", "column_names", "parsed_cells", "column_dtypes", "social_flags", "clean_headers", "syntactic_types",
    "similarity_pairs", "nearest_label", "table_domains", "sensitive_columns", "anonymized_cells", "table_ids", "event_ids",
]


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    got = compare.spark_rows(entry_points.queries()[name](spark, SF_DIR))
    assert got == compare.duck_rows(duck, entry_points.oracle_sql()[name])


def test_names():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUICK) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["file_id", "ontology", "method", "domain", "votes"]
