import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefold.functions import delimited
from tablefold.operators import domain, match, names, ontology, privacy, segments, stats
from tablefold.operators.numbering import places, row_index, running_total, top_k


def test_running_total_in_buckets(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), i * 3, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, pos bigint, v bigint")
    got = {(r.k, r.pos): r.t for r in running_total(df, ["k"], "pos", F.col("v"), "t", bucket_rows=50).collect()}
    sums = {}
    for k, pos, v in rows:
        assert got[k, pos] == sums.get(k, 0)
        sums[k] = sums.get(k, 0) + v


def test_row_index_with_negative_order(spark):
    df = spark.range(100).select(F.lit("x").alias("k"), (-F.col("id")).alias("pos"))
    got = row_index(df, ["k"], "pos", "i", bucket_rows=7).collect()
    assert all(r.i == 99 + r.pos for r in got)


def test_top_k(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    got = top_k(df, ["k"], [F.col("v").desc()], 4, salts=5).collect()
    assert sorted((r.k, r.v) for r in got) == sorted((v % 3, v) for v in range(988, 1000))


@pytest.mark.parametrize("mode, last", [("prefix", "a_2.csv"), ("exact", "a_1.csv")])
def test_file_names(spark, mode, last):
    rows = [("t", i, "u", n) for i, n in enumerate(["ab.csv", "a.csv", "a.csv"])]
    df = spark.createDataFrame(rows, "topic string, url_pos bigint, url string, file_name string")
    got = names.dedup_file_names(df, mode).orderBy("url_pos").collect()
    assert [r.unique_name for r in got] == ["ab.csv", "a.csv", last]


def test_made_up_name_does_not_hide_a_real_one(spark):
    rows = [("t", i, "u", n) for i, n in enumerate(["a.csv", "a.csv", "a_1.csv"])]
    df = spark.createDataFrame(rows, "topic string, url_pos bigint, url string, file_name string")
    got = [r.unique_name for r in names.dedup_file_names(df).collect()]
    assert len(set(got)) == 3 and "a_1.csv" in got


def test_sample_is_repeatable_and_whole_for_small_topics(spark):
    df = spark.range(50).select((F.col("id") % 10 == 0).alias("topic"), F.col("id").alias("url_pos"), F.col("id").cast("string").alias("url"))
    one = {r.url for r in names.sample_urls(df, 8, seed=3).collect()}
    assert one == {r.url for r in names.sample_urls(df.repartition(7), 8, seed=3).collect()}
    assert len(one) == 13


def test_segments_reference_points(spark):
    totals = spark.createDataFrame([("t", 50000)], "topic string, total_count bigint")
    got = segments.segment_sizes(totals, mode="reference").groupBy("range_pos").agg(
        F.count("*").alias("n"), F.max("hi").alias("last")
    ).orderBy("range_pos").collect()
    assert [(r.n, r["last"]) for r in got] == [(12, 2644), (12, 4670), (12, 22708), (12, 52319)]


def test_cover_segments_have_no_gap(spark):
    totals = spark.createDataFrame([("t", 1_312_000)], "topic string, total_count bigint")
    sizes = spark.range(256, 53532).select(F.lit("t").alias("topic"), F.col("id").alias("size"))
    assigned = segments.assign_segments(sizes, totals)
    assert assigned.select("size").distinct().count() == 53532 - 256
    joined = sizes.join(segments.segment_sizes(totals), "topic").filter("size between lo and hi")
    assert joined.count() == assigned.count()


def vectors(spark, rng, n, dim, **cols):
    rows = [(*[f(i) for f in cols.values()], [float(x) for x in rng.normal(size=dim)]) for i in range(n)]
    rows.append((*[f(n) for f in cols.values()], [0.0] * dim))
    return rows


@pytest.mark.parametrize("max_numbers", [10**6, 8])
def test_best_types_against_numpy(spark, max_numbers, monkeypatch):
    monkeypatch.setattr(match, "BLOCK_TYPES", 16)
    monkeypatch.setattr(match, "BLOCK_HEADERS", 20)
    rng = np.random.default_rng(0)
    heads = vectors(spark, rng, 50, 8, header=str)
    types = vectors(spark, rng, 60, 8, ontology=lambda i: "x" if i < 40 else "y", type_pos=int)
    types.append(("x", 100, types[3][2]))  # a tie: the earlier type wins
    h = spark.createDataFrame(heads, "header string, vec array<double>")
    t = spark.createDataFrame(types, "ontology string, type_pos bigint, vec array<double>")
    got = {(r.header, r.ontology): (r.type_pos, round(r.similarity, 9)) for r in match.best_types(h, t, 8, 0.3, max_numbers).collect()}
    want = {}
    for name, vec in heads:
        for onto, pos, other in types:
            size = np.linalg.norm(vec) * np.linalg.norm(other)
            sim = round(float(np.dot(vec, other) / size), 9) if size else -2
            if sim > 0.3 and (sim, -pos) > want.get((name, onto), (0.3, 0)):
                want[name, onto] = (sim, -pos)
    assert got == {k: (-p, s) for k, (s, p) in want.items()}


def grouped_vectors(rng, groups, each, dim):
    """Unit vectors in narrow groups, a zero row and a repeated row among them."""
    middle = rng.normal(size=(groups, dim))
    rows = np.repeat(middle, each, axis=0) + 0.15 * rng.normal(size=(groups * each, dim))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    rows[7], rows[each + 3] = 0.0, rows[2]
    return rows


@pytest.mark.parametrize("threshold", [0.56, -0.5])
def test_index_of_types_takes_few_products(threshold):
    rng = np.random.default_rng(5)
    types = grouped_vectors(rng, 40, 100, 16)
    heads = np.concatenate([types[::9], np.zeros((1, 16)), grouped_vectors(rng, 5, 20, 16)])
    positions = np.arange(len(types)) * 3
    kept, found, score, products = match.best_in_index(heads, match.index_types(positions, types), threshold)
    every = np.round(heads @ types.T, match.DECIMALS)
    best = every.max(axis=1)
    assert kept.tolist() == np.nonzero(best > threshold)[0].tolist()
    assert (score == best[kept]).all() and (found == positions[every.argmax(axis=1)][kept]).all()
    assert products < every.size / 3
    nothing = match.best_in_index(heads, match.index_types(positions[:0], types[:0]), threshold)
    assert len(nothing[0]) == 0 and nothing[3] == 0


@pytest.mark.parametrize("max_numbers", [10**6, 8])
def test_all_similar_types_through_the_index(spark, max_numbers, monkeypatch):
    monkeypatch.setattr(match, "BLOCK_TYPES", 16)
    monkeypatch.setattr(match, "INDEX_TYPES", 8)
    rng = np.random.default_rng(6)
    types, heads = grouped_vectors(rng, 6, 20, 8), grouped_vectors(rng, 3, 10, 8)
    h = spark.createDataFrame([(str(i), x.tolist()) for i, x in enumerate(heads)], "header string, vec array<double>")
    t = spark.createDataFrame([("xy"[i % 2], i, x.tolist()) for i, x in enumerate(types)], "ontology string, type_pos bigint, vec array<double>")
    got = sorted((int(r.header), r.type_pos) for r in match.similar_types(h, t, 8, 0.4, max_numbers).collect())
    assert got == sorted(zip(*(x.tolist() for x in np.nonzero(heads @ types.T > 0.4)), strict=True))


@pytest.mark.parametrize("find", [match.best_types, match.similar_types])
def test_too_many_types_are_met_without_moving_vectors_once_per_block(spark, find, monkeypatch):
    monkeypatch.setattr(match, "BLOCK_TYPES", 4)
    monkeypatch.setattr(match, "BLOCK_HEADERS", 5)
    rng = np.random.default_rng(8)
    h = spark.createDataFrame(vectors(spark, rng, 20, 4, header=str), "header string, vec array<double>")
    t = spark.createDataFrame(vectors(spark, rng, 40, 4, ontology=lambda i: "x", type_pos=int), "ontology string, type_pos bigint, vec array<double>")
    few, many = find(h, t, 4, 0.3, 10**6), find(h, t, 4, 0.3, 40)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan[plan.index("MapInArrow"):]
    flat = lambda df: sorted((r.header, r.type_pos, round(r.similarity, 9)) for r in df.collect())
    assert flat(few) == flat(many) and flat(many)


@pytest.mark.parametrize("max_numbers", [10**6, 8])
def test_near_ties_go_to_the_first_type_in_every_path(spark, max_numbers, monkeypatch):
    monkeypatch.setattr(match, "BLOCK_TYPES", 16)
    heads = spark.createDataFrame([("h", [1.0, 0.0])], "header string, vec array<double>")
    near = [1.0, 1e-6 * (1 + 2.5e-7)]  # similarity 5e-19 below the other's
    types = spark.createDataFrame([("x", 0, near), ("x", 5000, [1.0, 1e-6])], "ontology string, type_pos bigint, vec array<double>")
    assert match.best_types(heads, types, 2, 0.3, max_numbers).first().type_pos == 0


def test_names_are_numbered_apart(spark):
    # as observed with the data frame library whose header names are to be matched
    cases = {
        ("a", "a", "a"): ["a", "a.1", "a.2"], ("a", "a", "a.1"): ["a", "a.1", "a.1.1"],
        ("a", "a", "a.1", "a.1"): ["a", "a.1", "a.1.1", "a.1.2"], ("a.1", "a", "a"): ["a.1", "a", "a.1.1"],
        ("a", "a.1", "a.1.1", "a", "a"): ["a", "a.1", "a.1.1", "a.1.1.1", "a.2"],
    }
    for names_, want in cases.items():
        got = spark.createDataFrame([(list(names_),)], "f array<string>").select(delimited.numbered(F.col("f")).alias("n")).first().n
        assert got == want and len(set(got)) == len(got)


def test_embed_text(spark):
    words = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [0.0, 2.0]), ("z", [0.0, 0.0])], "word string, vec array<float>")
    texts = spark.createDataFrame([("a b b",), ("z q",), ("a  z",)], "text string")
    got = {r.text: [round(x, 6) for x in r.vec] for r in match.embed_text(texts, words, 2).collect()}
    assert got == {"a b b": [0.2, round(2.8 / 3, 6)], "a  z": [0.6, 0.8]}


@pytest.mark.parametrize("max_numbers", [0, 100])
@pytest.mark.parametrize("shared", [False, True])
def test_embed_text_by_vectors_that_words_share(spark, max_numbers, shared):
    texts = spark.createDataFrame([("a b b c",), ("z q",), ("a  z",), ("c",), ("c",), (None,), ("q",)], "text string")
    if shared:
        words = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1), ("z", 3), ("q", 4), ("q", None)], "word string, vec_id bigint")
        vectors = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0]), (5, [1.0, 1.0]), (None, [1.0, 0.0])], "vec_id bigint, vec array<float>")
    else:
        vectors = None
        words = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [0.0, 2.0]), ("c", [3.0, 4.0]), ("z", [0.0, 0.0])], "word string, vec array<float>")
    found = match.embed_text(texts, words, 2, vectors=vectors, max_numbers=max_numbers)
    got = sorted((r.text, [round(x, 6) for x in r.vec]) for r in found.collect())
    assert got == [("a  z", [0.6, 0.8]), ("a b b c", [0.3, 0.9]), ("c", [0.6, 0.8])]


def test_vectors_sent_to_the_tasks_are_neither_shuffled_nor_stored(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(match, "cut_lineage", lambda df: stored.append(df) or df)
    texts = spark.createDataFrame([("a b",), ("b",)], "text string")
    words = spark.createDataFrame([("a", 1), ("b", 2)], "word string, vec_id bigint")
    vectors = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 2.0])], "vec_id bigint, vec array<float>")
    found = match.embed_text(texts, words, 2, vectors=vectors)
    assert all(kind != "array<float>" for df in stored for _, kind in df.dtypes)
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    joins = [i for i, line in enumerate(plan) if "BroadcastHashJoin [vec_id" in line]
    assert len(joins) == 1 and not any("Exchange" in line for line in plan[: joins[0]])


@pytest.mark.parametrize("max_numbers", [8, 10**6])
def test_no_vector_is_shuffled_or_stored_by_semantic_matching(spark, max_numbers, monkeypatch):
    monkeypatch.setattr(match, "BLOCK_TYPES", 2)
    stored, cut = [], match.cut_lineage
    monkeypatch.setattr(match, "cut_lineage", lambda df: stored.append(df) or cut(df))
    words = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1), ("d", 2), ("z", 3), ("e", 4)], "word string, vec_id bigint")
    vectors = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0]), (4, [5.0, -1.0])], "vec_id bigint, vec array<float>")
    labels = ["a b", "b c", "c", "a", "d", "z", "z a", "e", "b"]
    ontology = spark.createDataFrame([(o, i, x) for o in "xy" for i, x in enumerate(labels)], "ontology string, type_pos bigint, cleaned_label string")
    columns = spark.createDataFrame([(1, 0, "a"), (1, 1, "d c"), (2, 0, "e"), (2, 1, "z"), (3, 0, "b b")], "file_id int, col_idx int, header string")
    known = match._known
    monkeypatch.setattr(match, "_known", lambda w, d, v, m: known(w, d, v, 10**6))  # vectors fit, types may not
    types = match.embed_types(ontology, words, 2, vectors, firsts=True)
    assert sorted((r.ontology, r.type_pos) for r in types.collect()) == [(o, i) for o in "xy" for i in (0, 2, 4, 6, 7)]
    found = match.match_semantic(columns, ontology, types, words, 2, 0.5, vectors=vectors, max_numbers=max_numbers)
    assert all(name != "vec" or kind != "binary" for df in stored for name, kind in df.dtypes)
    got = sorted((r.file_id, r.col_idx, r.ontology, r.type_pos) for r in found.collect())
    assert got == [(f, c, o, t) for f, c, t in ((1, 0, 2), (1, 1, 0), (2, 0, 7), (3, 0, 4)) for o in "xy"]
    for df in [*stored, found]:
        for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
            assert "Exchange hashpartitioning" not in line or "vec#" not in line


def test_types_far_from_each_other_are_met_in_one_block():
    rng = np.random.default_rng(9)
    types, heads = rng.normal(size=(3000, 64)), rng.normal(size=(500, 64))
    types, heads = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (types, heads))
    types[5], types[2900], heads[7] = 0.0, types[1], types[1]
    positions = np.arange(len(types)) * 2
    index = match.index_types(positions, types)
    assert len(index[2]) == 1
    every = np.round(heads @ types.T, match.DECIMALS)
    for threshold in (0.3, -0.5):
        kept, found, score, _ = match.best_in_index(heads, index, threshold)
        assert kept.tolist() == np.nonzero(every.max(axis=1) > threshold)[0].tolist()
        assert (found == positions[every.argmax(axis=1)][kept]).all() and np.allclose(score, every.max(axis=1)[kept], atol=1e-11)


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("max_numbers", [1, 70, 120])
def test_many_vectors_go_to_the_tasks_by_dimensions_and_are_not_shuffled(spark, kind, max_numbers, monkeypatch):
    monkeypatch.setattr(match, "BLOCK_TEXTS", 7)
    monkeypatch.setattr(match, "BLOCK_WORDS", 5)
    rng = np.random.default_rng(10)
    numbers = [[float(np.float32(x)) for x in rng.normal(size=5)] for _ in range(30)]
    numbers[4] = [0.0] * 5
    vectors = spark.createDataFrame([(i * 10, x) for i, x in enumerate(numbers)] + [(70, numbers[3]), (None, numbers[0])], f"vec_id bigint, vec array<{kind}>").repartition(4)
    ids = {f"w{i}": i % 32 * 10 for i in range(60)}  # two of the identifiers have no vector, one has two
    words = spark.createDataFrame([*ids.items(), ("n", None)], "word string, vec_id bigint")
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 64, size=rng.integers(1, 9))) for _ in range(60)] + ["w4", "n", "", "w3 w3 w35"]
    found = match.embed_text(spark.createDataFrame([(x,) for x in [*texts, None, texts[0]]], "text string"), words, 5, vectors=vectors, max_numbers=max_numbers)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan[: plan.index("MapInArrow")]  # nothing moves once there are vectors
    want = {}
    for text_ in texts:
        given = [numbers[n] for w in text_.split() if w in ids for n in ([7, 3] if ids[w] == 70 else [ids[w] // 10]) if n < 30 and n != 4]
        if given:
            want[text_] = np.mean([np.asarray(v) / np.linalg.norm(v) for v in given], axis=0)
    got = {r.text: r.vec for r in found.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-12) for k in want)


def test_types_of_many_vectors_are_embedded_alike(spark):
    words = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1), ("d", 2), ("z", 3), ("e", 4)], "word string, vec_id bigint")
    vectors = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0]), (4, [5.0, -1.0])], "vec_id bigint, vec array<float>")
    labels = ["a b", "b c", "c", "a", "d", "z", "z a", "e", "b"]
    ontology = spark.createDataFrame([(o, i, x) for o in "xy" for i, x in enumerate(labels)], "ontology string, type_pos bigint, cleaned_label string")
    types = match.embed_types(ontology, words, 2, vectors, firsts=True, max_numbers=1)
    plan = types._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan[: plan.index("MapInArrow")]
    got = {(r.ontology, r.type_pos): [round(x, 6) for x in r.vec] for r in types.collect()}
    assert got == {(o, i): x for o in "xy" for i, x in ((0, [0.3, 0.9]), (2, [0.6, 0.8]), (4, [0.0, 1.0]), (7, [round(5 / 26**0.5, 6), round(-1 / 26**0.5, 6)]))}


def test_first_column_wins_exact_match(spark):
    columns = spark.createDataFrame([(1, 0, "First-name"), (1, 1, "firstName"), (2, 0, "x")], "file_id int, col_idx int, header string")
    types = spark.createDataFrame([("schema", 5, "first name")], "ontology string, type_pos bigint, cleaned_label string")
    got = match.match_syntactic(columns, types).collect()
    assert [(r.file_id, r.col_idx, r.header) for r in got] == [(1, 1, "firstName")]


def test_domain_tie_goes_to_first_vote(spark):
    types = spark.createDataFrame(
        [("schema", "a", ["P", "Q"]), ("schema", "b", ["Q", "P"]), ("schema", "c", [None, "R"])],
        "ontology string, cleaned_label string, domain array<string>",
    )
    found = spark.createDataFrame(
        [(1, 0, 9, "b", "semantic"), (1, 1, 2, "a", "semantic"), (2, 0, 9, "b", "syntactic"), (2, 1, 2, "a", "syntactic"), (3, 0, 0, "c", "semantic")],
        "file_id int, col_idx int, type_pos bigint, cleaned_label string, method string",
    ).withColumn("ontology", F.lit("schema"))
    got = {r.file_id: r.domain for r in domain.table_domain(found, domain.type_domains(types)).collect()}
    assert got == {1: "Q", 2: "P", 3: "R"}


def test_collapse(spark):
    rows = [("l", 1, "X"), ("l", 2, "X"), ("m", 3, None), ("m", 4, "X"), ("m", 5, "X"), ("n", 6, None)]
    df = spark.createDataFrame(rows, "cleaned_label string, row_pos bigint, domain string")
    got = {r.cleaned_label: r.domain for r in ontology.collapse_labels(df, ["domain"]).collect()}
    assert got == {"l": ["X"], "m": ["X", "X"], "n": []}
    counted = {r.cleaned_label: r.votes for r in ontology.collapse_attribute(df, "domain").collect()}
    assert counted == {"l": 1, "m": 2}


def test_replaced_columns_and_values(spark):
    types = spark.createDataFrame(
        [("t", 0, "who", "person", "name"), ("t", 1, "n", None, "name"), ("u", 0, "name", "name", None), ("t", 2, "mail", None, "email")],
        "file_id string, col_idx int, header string, dbpedia_type string, schema_type string",
    )
    replaced = privacy.replaced_columns(types)
    got = sorted((r.file_id, r.col_idx, r.step, r.personal_type) for r in replaced.collect())
    assert got == [("t", 0, 1, "person"), ("t", 0, 2, "name"), ("t", 1, 2, "name"), ("t", 2, 1, "email")]
    heads = privacy.anonymized_headers(replaced).first().anonymized_columns
    assert heads == ["who", "who", "n", "mail"]
    rows = spark.createDataFrame([("t", 0, ["a", None, "c", "d"]), ("u", 0, ["a"])], "file_id string, row_idx bigint, fields array<string>")
    out = {r.file_id: r.fields for r in privacy.anonymize_rows(rows, replaced).collect()}
    assert out["u"] == ["a"] and out["t"][3] == "d"
    assert out["t"][0] in privacy.REPLACEMENTS["name"] and out["t"][1] in privacy.REPLACEMENTS["name"]
    assert out["t"][2] in privacy.REPLACEMENTS["email"]
    counts = {r.personal_type: r.n_columns for r in privacy.personal_counts(replaced).collect()}
    assert counts["name"] == 2 and counts["street"] == 0 and len(counts) == 10


def test_chunked_list_keeps_order(spark):
    df = spark.range(25).select(F.lit("t").alias("topic"), F.col("id").alias("table_id"))
    got = stats.chunked_list(df, ["topic"], "table_id", F.col("table_id") * 2, "v", chunk_tables=10).orderBy("chunk").collect()
    assert [x for r in got for x in r.v] == [2 * i for i in range(25)]


def test_spread_of_counts(spark):
    rng = random.Random(4)
    rows = [(g, round(rng.random() ** 2, 2), rng.randint(1, 9)) for g in "ab" for _ in range(60)]
    rows.append(("one", 0.5, 1))
    counted = spark.createDataFrame(rows, "g string, v double, n bigint").groupBy("g", "v").agg(F.sum("n").alias("n"))
    for r in stats.spread_of_counts(counted, ["g"], "v").collect():
        values = sorted(v for g, v, n in rows if g == r.g for _ in range(n))
        assert r.n == len(values) and r.mean_v == pytest.approx(np.mean(values)) and r.std_v == pytest.approx(np.std(values), abs=1e-12)
        for q in stats.QUANTILES:
            assert r[f"p{q}"] == values[-(-len(values) * q // 1000) - 1]


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_numbers_against_a_plain_count(spark, seed):
    rng = random.Random(seed)
    long = "x" * 200
    made = [(t, "".join(rng.choice(["a", "b", "\u00e9", "\U0001f600", long]) for _ in range(rng.randint(0, 3))) + ".csv") for t in "tu" for _ in range(120)]
    rows = [(t, i * 3, "u", n) for i, (t, n) in enumerate(made)]
    df = spark.createDataFrame(rows, "topic string, url_pos bigint, url string, file_name string")
    got = {(r.topic, r.url_pos): r.unique_name for r in names.dedup_file_names(df, "prefix").collect()}
    assert len(got) == len(rows)
    real = {(t, n) for t, _, _, n in rows}
    for t, pos, _, name in rows:
        earlier = [n for t2, p, _, n in rows if t2 == t and p < pos]
        expected = name
        if name in earlier:
            base = name[:-4]
            k = sum(n.startswith(base) for n in earlier)
            expected = f"{base}_{k}.csv" if (t, f"{base}_{k}.csv") not in real else f"{base}_{k}_{pos}.csv"
        assert got[t, pos] == expected


def test_places_are_in_order(spark):
    df = spark.range(1000).select(F.concat(F.lit("same start "), F.sha2(F.col("id").cast("string"), 256)).alias("k"))
    got = places(df, ["k"], "p").collect()
    assert [r.k for r in sorted(got, key=lambda r: r.p)] == sorted(r.k for r in got) and len({r.p for r in got}) == 1000


def test_label_positions_of_labels_that_begin_alike(spark):
    labels = [f"same start {i * 7919 % 5000:05d}" for i in range(5000)] + ["", "é", "Z", "same start"]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(labels)], "cleaned_label string, row int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ontology.label_positions(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.columns == ["cleaned_label", "row", "type_pos"]
    ordered = sorted(labels, key=lambda x: x.encode())
    assert {r.cleaned_label: r.type_pos for r in placed.collect()} == {x: i for i, x in enumerate(ordered)}
    assert placed.groupBy(F.spark_partition_id()).count().count() > 1
    assert "Window" not in placed._jdf.queryExecution().optimizedPlan().toString()
    assert ontology.label_positions(df.limit(0)).collect() == []


def test_outer_votes_equal_the_collapsed_combinations(spark):
    rng = random.Random(7)
    space = ontology.PROPERTY_NAMESPACE + "/"
    props = [space + p for p in ("birthPlace", "x/birthPlace", "city", "a/city", "b/city", "lone")] + ["http://other/city"]
    pick = lambda values: [(p, rng.choice(values)) for p in props[:-2] for _ in range(rng.randint(0, 6))]
    frame_of = lambda rows: spark.createDataFrame(rows, "property string, value string")
    comments = spark.createDataFrame([(p, v, rng.choice(["en", "de", "EN-us"])) for p, v in pick(["c1", "c2", "c3"])], "property string, value string, lang string")
    args = (frame_of([(p, None) for p in props * 2]), frame_of(pick(["D1", "D2", None])), comments, frame_of(pick(["R1", "R2", "R3"])), frame_of(pick(["S"])))
    rows = ontology.property_rows(ontology.properties_outer(*args)).withColumn("row_pos", F.lit(0))
    got = {(r.attribute, r.cleaned_label, r.value): r.votes for r in ontology.outer_votes(*args).collect()}
    expected = {}
    for attribute in ("id", "range", "domain", "description", "superproperties"):
        for r in ontology.collapse_attribute(rows, attribute).collect():
            expected[attribute, r.cleaned_label, r.value] = r.votes
    assert got == expected and ("id", "lone", space + "lone") in got


def test_outer_votes_of_wide_properties(spark):
    """A million combinations per pair of attributes are counted, not formed; their domains vote."""
    prop = ontology.PROPERTY_NAMESPACE + "/wide"
    values = lambda n: spark.range(n).select(F.lit(prop).alias("property"), F.col("id").cast("string").alias("value"))
    comments = values(1000).withColumn("lang", F.lit("en"))
    votes = ontology.outer_votes(values(1).select("property"), values(1000), comments, values(1000), values(1000))
    got = {(r.attribute, r.votes): r.n for r in votes.groupBy("attribute", "votes").agg(F.count("*").alias("n")).collect()}
    assert got == {(a, 10**9): 1000 for a in ("range", "domain", "description", "superproperties")} | {("id", 1): 1}
    placed = ontology.domain_votes(votes).collect()
    assert len(placed) == 1000 and len({r.first_pos for r in placed}) == 1000


def test_funnel_stores_nothing_that_only_annotations_read(spark, tmp_path):
    from tablefold.queries import statistics

    tables = {
        "documents": ("doc_id bigint, source string, lang string, text string", [
            (1, "s", "en", "License: MIT\na,b\n" + "1,2\n" * 300), (2, "s", "en", "a,b\n1,2"), (3, "s", "es", "a,b\n" + "1,2\n" * 300),
            (4, "s", "fr", "a,b\n" + "1,2\n" * 300),
        ]),
        "benchmark": ("item_id bigint, text string", [(1, "a b")]),
        "conversations": ("conv_id bigint, turn int, role string, text string", [(1, 0, "user", "a b")]),
        "embeddings": ("vec_id bigint, embedding array<float>, label int", [(0, [0.5] * 64, 1)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    kept = []
    job = statistics._faulty(spark, str(tmp_path), lambda df: kept.append(df) or df)
    assert not kept
    assert job.staged.filter("landed").count() + job.missing.count() == job.licensed.count() and kept
