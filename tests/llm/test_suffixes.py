"""Removal of repeated byte strings against brute force."""

import random

import numpy as np
import pytest

from tablefold.llm import suffixes
from tablefold.llm.keyfilter import SLICES, KeyFilter


def brute(rows, window):
    """Rows of (n_bytes, spans, kept), in order."""
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        for p in range(len(data) - window + 1) if i is not None else ():
            w = data[p : p + window]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - window + 1) if i is not None else ():
            if first[data[p : p + window]] < i:
                gone[p : p + window] = b"\1" * window
        edges = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(bytes(gone), np.uint8), [0])).astype(int)))
        out.append((i, len(data), list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(c for c, g in zip(data, gone) if not g)))
    return out


def test_spans_equal_brute_force(spark):
    rng = random.Random(3)
    passages = ["".join(rng.choice("abcdé \x00") for _ in range(rng.randint(40, 160))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefg ") for _ in range(rng.randint(0, 80))) for _ in range(4)]
        text = "".join(parts)
        cut = rng.randint(0, 30)
        rows.append((rng.randrange(40), text[cut:]))
    rows += [(50, None), (51, ""), (52, "short"), (None, passages[0]), (53, "ab" * 5000), (54, "ab" * 5000 + "c"), (55, rows[0][1]), (55, rows[0][1])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, spans string, kept int")
    got = suffixes.remove_repeats(df, bucket_bytes=2000).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[3])
    found = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got), key=key)
    assert found == sorted(brute(rows, suffixes.WINDOW), key=key)


def test_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("depth", [1, 3, 4, 9, 17])
def test_suffix_ranks(depth):
    rng = np.random.default_rng(depth)
    for _ in range(30):
        n, k = int(rng.integers(1, 90)), int(rng.integers(1, 5))
        text = rng.integers(1, k + 1, n)
        rank = suffixes.suffix_ranks(text, depth)
        prefixes = [tuple(text[i : i + depth]) for i in range(n)]
        assert all(rank[i] < rank[j] for i in range(n) for j in range(n) if prefixes[i] < prefixes[j])
        some = np.sort(rng.choice(n, int(rng.integers(1, n + 1)), replace=False))
        part = suffixes.suffix_ranks(text, depth, some)
        assert all(part[i] < part[j] for i in range(len(some)) for j in range(len(some)) if prefixes[some[i]] < prefixes[some[j]])


def test_equal_windows():
    rng = np.random.default_rng(0)
    for window in (2, 7, 50):
        text = rng.integers(1, 3, 300)
        starts = np.arange(0, 300 - window + 1, 2)
        kind = suffixes.equal_windows(text, starts, window)
        strings = [tuple(text[s : s + window]) for s in starts]
        assert all((strings[i] == strings[j]) == (kind[i] == kind[j]) for i in range(len(starts)) for j in range(len(starts)))


def test_filter_holds_its_keys():
    keys = np.arange(1, 500, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    slice_bits = 1024
    bits = np.zeros((SLICES, slice_bits), bool)
    from tablefold.llm.keyfilter import _slice

    for place in KeyFilter.places(keys, slice_bits):
        bits[_slice(keys).astype(int), place] = True
    known = KeyFilter(np.packbits(bits, axis=1, bitorder="little").ravel())
    assert known.passes(keys).all()
    assert known.passes(np.arange(10**6, 10**6 + 2000, dtype=np.uint64)).mean() < 0.05
