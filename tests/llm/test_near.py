"""Near duplicates and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefold.llm import minhash
from tablefold.llm.common import WordHashes, mixed, shingle_set
from tablefold.llm.components import components


def word_sets(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent):
    """doc_id -> (set size, smallest identifier reachable)."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, word_sets(t))
    ids, low = sorted(sets), {i: i for i in sets}
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    for _ in ids:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return {i: (len(sets[i]), low[i]) for i in ids}


def family(rng, n, words, edits):
    """Copies of one text, each with its own edits."""
    base = [f"w{rng.randrange(900)}" for _ in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = f"x{k}y{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = family(rng, 30, 120, 6) + family(rng, 25, 60, 4) + family(rng, 20, 200, 3)
    texts += [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 30))) for _ in range(40)]
    texts += [None, "", " \t\n", "a b", "A  B", "a b", "one", "One", "x " * 3000, "x " * 3001]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, texts[3])]  # a repeated row
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id bigint, text string, component_id string, n int")
    got = minhash.near_duplicates(df, percent / 100).collect()
    want = brute(rows, percent)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)


def test_nulls_and_empty_tables(spark):
    schema = "doc_id bigint, text string"
    df = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (7, "A b c d e f"), (9, None)], schema)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == {(None, 2, None, False), (5, 2, 5, True), (7, 2, 5, False), (9, 0, 9, True)}
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.9):
        common, left, right = (mixed(rng.integers(1, 2**62, n, dtype=np.uint64)) for n in (int(1000 * share), int(500 * (1 - share)), int(500 * (1 - share))))
        a, b = np.concatenate((common, left)), np.concatenate((common, right))
        one, two, both = minhash.sketch([a, b, np.union1d(a, b)])
        assert (np.maximum(one, two) == both).all()
        got = minhash.estimated(one[None], two[None], np.array([len(a)], float), np.array([len(b)], float))[0]
        assert abs(got - len(common) / len(np.union1d(a, b))) < 0.1


def test_sketch_of_one_element_and_none():
    assert (minhash.sketch([np.empty(0, np.uint64)]) == 0).all()
    assert minhash.sketch([np.array([7], np.uint64)]).shape == (1, minhash.REGISTERS)


def test_prefixes_meet_all_similar_sets(spark):
    rng = random.Random(2)
    texts = family(rng, 40, 100, 5)
    known = WordHashes()
    sets = spark.createDataFrame([(i, bytearray(shingle_set(t, known).tobytes())) for i, t in enumerate(texts)], "id bigint, members binary")
    labels = spark.range(len(texts)).select("id", F.col("id").alias("c"))
    met = {(r.a, r.b) for r in minhash._sharing_prefix(sets, labels, 0.85).collect()}
    alike = {
        (a, b) for a in range(40) for b in range(a + 1, 40)
        if 100 * len(word_sets(texts[a]) & word_sets(texts[b])) >= 85 * len(word_sets(texts[a]) | word_sets(texts[b]))
    }
    assert alike and alike <= met


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (301, 300)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}


def test_members_of_a_bucket_meet_the_one_in_the_most_crowded_buckets(spark):
    bands = spark.createDataFrame([(1, 1), (1, 5), (2, 5), (2, 7), (2, 8), (3, 7), (3, 5), (4, 9), (6, 3), (6, 2)], "key bigint, id bigint")
    got = sorted(map(tuple, minhash._centred(bands).select("key", "a", "b").collect()))
    assert got == [(1, 5, 1), (1, 5, 5), (2, 5, 5), (2, 5, 7), (2, 5, 8), (3, 5, 5), (3, 5, 7), (6, 2, 2), (6, 2, 3)]


def test_copies_with_changes_of_their_own_are_compared_with_what_they_have_in_common(spark, monkeypatch):
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(w if i not in (at, 119 - at) else f"x{at}" for i, w in enumerate(base)) for at in range(5, 60, 5)] + [" ".join(base)]
    met, real = [], minhash._sharing_prefix
    monkeypatch.setattr(minhash, "_sharing_prefix", lambda s, labels, t: met.append(labels.count()) or real(s, labels, t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 0.84).collect()}
    assert got == dict.fromkeys(range(len(texts)), 0) and met == [0]
