"""The pipeline against its stages by brute force, on the smallest table; oracles of this package; the guard of the entry."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import compare
import corpus_pipeline
from tablefold.llm import decontaminate, language, packing, secrets
from test_near import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_minhash", "op8_neighbours"])
def test_query_equals_sql(spark, name):
    got = compare.spark_rows(entry_points.queries()[name](spark, SF_DIR))
    assert got == compare.duck_rows(compare.connect(SF_DIR), entry_points.oracle_sql()[name])


def test_every_operator_is_registered_once():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_points.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = [(r.item_id, decontaminate.words(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    grams = language.Grams()
    texts = {i: t for i, t in texts.items() if len(grams.count(t)[0])}  # no document here is in an unknown language
    first = brute(list(texts.items()), 80)
    texts = {i: t for i, t in texts.items() if first[i][1] == i}
    known = decontaminate.Benchmark(bench, decontaminate.MIN_MATCH)

    def leaked(text):
        codes = known.codes(text)
        return any(
            sum(k for k, _, _ in decontaminate.tiles(item, codes)) >= decontaminate.MIN_COVERAGE * len(item) for _, item in known.items if len(item)
        )

    texts = {i: t for i, t in texts.items() if not leaked(t)}
    model = secrets.learn(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    encoder = packing.Encoder(packing.tokenizer_path())
    want = {}
    for i, t in texts.items():
        masked = secrets._mask(t, secrets.all_spans(t, model, secrets.MIN_RATIO))
        want[i] = len(encoder.whole.encode(masked, add_special_tokens=False).ids) + 1
    got, rooms = {}, {}
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        rooms[r.sequence_id] = rooms.get(r.sequence_id, 0) + r.length
    assert got == want and max(rooms.values()) <= 1024
    assert len(rooms) <= 1.05 * sum(want.values()) / 1024 + 1


def test_stages_take_odd_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the house", "en", "s", 9), (3, "the house and garden", "en", "s", 20), (3, "the house and garden", "en", "s", 20)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            n = out.count()
            if name != "packing":
                assert out.columns == docs.columns, name
                docs = out
            # rows without a language go, then one of the two equal rows
            assert n == (0 if not data else 3 if name == "language" else 2), name


def test_stages_keep_columns_and_one_row_of_a_group(spark):
    text = "the old house and the garden behind it are for sale since the spring of last year "
    rows = [(2, text, 0.123, "mine"), (None, text, 0.5, "x"), (None, text, 0.6, "y"), (2, "a quite different text about birds that sing in the morning and rest at night", 0.7, "z"), (9, text + "now", 0.8, "w")]
    docs = spark.createDataFrame([(i, t, "en", s, o, 1) for i, t, s, o in rows], "doc_id bigint, text string, lang string, score double, other string, _place int")
    kept = corpus_pipeline.known_language(spark, docs, SF_DIR)
    assert kept.dtypes == docs.dtypes and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    left = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
    assert left.columns == docs.columns and sorted((r.doc_id, r.score) for r in left.collect()) == [(2, 0.123), (2, 0.7)]


def test_stages_send_texts_in_small_batches(spark):
    key, docs = "spark.sql.execution.arrow.maxBytesPerBatch", spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    large = spark.range(24, numPartitions=1).select("id", F.repeat(F.lit("x"), 1_000_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(key)
            stage(spark, docs, SF_DIR)
            got = [r.n for r in large.mapInArrow(sizes, "n long").collect()]
            assert len(got) > 1 and max(got) <= 6_000_000, name
    finally:
        spark.conf.unset(key)
