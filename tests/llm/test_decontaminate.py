"""String tiling of benchmark texts."""

import random

import numpy as np
import pytest

from tablefold.llm import decontaminate as d


def test_window_hashes_are_equal_for_equal_windows():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 4, 200).astype(np.uint64)
    for width in (1, 2, 5, 7, 12):
        found = {}
        for i, h in enumerate(d.window_hashes(codes, width).tolist()):
            found.setdefault(tuple(codes[i : i + width].tolist()), set()).add(h)
        assert all(len(h) == 1 for h in found.values()) and len({h for (h,) in found.values()}) == len(found)


def greedy(item, doc, least):
    """Longest unmarked common runs first, by trying all places."""
    a, b, total = [False] * len(item), [False] * len(doc), 0
    while True:
        best = 0
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k > best:
                    best, at = k, (i, j)
        if best < least:
            return total
        for x in range(best):
            a[at[0] + x] = b[at[1] + x] = True
        total += best


def test_tiles_cover_as_much_as_a_greedy_search():
    rng = random.Random(1)
    for _ in range(25):
        item = [rng.randint(1, 30) for _ in range(rng.randint(5, 40))]
        parts = [item[:12], [rng.randint(31, 60) for _ in range(5)], item[20:], item[12:20]]
        rng.shuffle(parts)
        doc = [x for p in parts for x in p]
        tiles = d.tiles(np.array(item, np.uint64), np.array(doc, np.uint64), 5)
        for k, i, j in tiles:
            assert k >= 5 and item[i : i + k] == doc[j : j + k]
        covered = [i + x for k, i, _ in tiles for x in range(k)]
        assert len(covered) == len(set(covered)) and abs(len(covered) - greedy(item, doc, 5)) <= 4


def test_rest_of_an_overlapped_match_is_marked():
    item = np.arange(1, 19, dtype=np.uint64)
    doc = np.concatenate((item[:8], [99], item[6:14], [98, 97])).astype(np.uint64)
    assert d.tiles(item, doc, 5) == [(8, 0, 0), (6, 8, 11)]


def test_no_common_run_of_free_words_is_left():
    rng = random.Random(2)
    for n in range(150):
        words = 3 if n % 3 == 0 else 400
        item = [rng.randint(1, words) for _ in range(rng.randint(12, 30))]
        doc = []
        for _ in range(rng.randint(2, 6)):  # parts of the item that overlap
            start = rng.randrange(len(item))
            doc += item[start : start + rng.randint(5, 9)] + [rng.randint(1, words + 5) for _ in range(rng.randint(0, 4))]
        a, b = np.array(item, np.uint64), np.array(doc, np.uint64)
        for k, i, j in d.tiles(a, b, 5):
            assert k >= 5 and (a[i : i + k] == b[j : j + k]).all() and a[i : i + k].all() and b[j : j + k].all()
            a[i : i + k] = b[j : j + k] = 0
        runs = {tuple(x) for x in np.lib.stride_tricks.sliding_window_view(a, 5).tolist() if 0 not in x} if len(a) >= 5 else set()
        assert not any(tuple(doc_run) in runs for doc_run in (np.lib.stride_tricks.sliding_window_view(b, 5).tolist() if len(b) >= 5 else []))


def test_document_with_overlapping_passages_is_found(spark):
    item = " ".join(f"w{i}" for i in range(18))
    doc = " ".join([f"w{i}" for i in range(8)] + ["x"] + [f"w{i}" for i in range(6, 14)] + ["and", "more"])
    docs, items = spark.createDataFrame([(1, doc)], "doc_id bigint, text string"), spark.createDataFrame([(2, item)], "item_id bigint, text string")
    for sent_words in (10**6, 0):
        (row,) = d.matches(docs, items, sent_words=sent_words).collect()
        assert (row.doc_id, row.item_id, round(row.coverage, 6)) == (1, 2, round(14 / 18, 6))


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"), (2, "one two three"), (3, None), (4, ""),
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"),
]
DOCS = [
    (10, "so: ALPHA beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi!"),  # whole
    (11, "theta iota kappa lambda mu nu xi and then alpha beta gamma delta epsilon zeta eta"),  # reordered
    (12, "alpha beta gamma delta then epsilon zeta eta theta but iota kappa lambda mu or nu xi"),  # only short runs
    (13, "alpha beta gamma delta epsilon"),  # too little
    (14, "count one two three"), (15, None), (16, ""), (17, "word " * 5000 + "one, two; three"), (None, "one two three"), (14, "count one two three"),
]


@pytest.mark.parametrize("sent_words", [10**6, 0])
def test_matches(spark, sent_words):
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in DOCS], "doc_id bigint, text string, coverage double")
    items = spark.createDataFrame([(i, t, 0.0) for i, t in ITEMS], "item_id bigint, text string, tiles double")
    got = sorted((r.doc_id or -1, r.item_id, round(r.coverage, 6), len(r.tiles)) for r in d.matches(docs, items, sent_words=sent_words).collect())
    want = [(-1, 2, 1.0, 1)] * (sent_words > 0) + [(10, 1, 1.0, 1)] * 2 + [(11, 1, 1.0, 2)] * 2 + [(14, 2, 1.0, 1)] * 2 + [(17, 2, 1.0, 1)]
    if not sent_words:  # the join takes each pair of identifiers once per pair of rows
        got, want = sorted(set(got)), sorted(set(want))
    assert got == want
    assert {r.doc_id for r in d.clean(docs, items, sent_words=sent_words).collect()} == {12, 13, 15, 16, None}


def test_benchmark_rows_without_identifier_count_both_ways(spark):
    docs = spark.createDataFrame([(1, "so one two three"), (2, "alpha beta gamma delta epsilon zeta"), (3, "nothing here")], "doc_id bigint, text string")
    items = spark.createDataFrame([(None, "one two three"), (None, "alpha beta gamma delta epsilon zeta"), (7, "alpha beta gamma delta epsilon")], "item_id bigint, text string")
    for sent_words in (10**6, 0):
        got = sorted((r.doc_id, r.item_id or -1, r.coverage) for r in d.matches(docs, items, sent_words=sent_words).collect())
        assert got == [(1, -1, 1.0), (2, -1, 1.0), (2, 7, 1.0)]
        assert [r.doc_id for r in d.clean(docs, items, sent_words=sent_words).collect()] == [3]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    full = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    assert d.matches(docs, items).count() == 0 and d.matches(full, items).count() == 0
