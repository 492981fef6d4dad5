"""Runs of repeated words against all periods of all stretches, and the query against a plain loop."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tablefold.llm import periodic, queries

SF_DIR = "/root/testdata/sf0.001"


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def plain_runs(words, min_length=6):
    """Every maximal stretch of each period by scanning, kept if that period is its smallest one."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(min_length, 4 * q) and smallest_period(words[start : start + length]) == q:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]


def made(rng):
    """Random words with repeated parts inside repeated parts."""
    parts = []
    for _ in range(rng.randint(1, 4)):
        block = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.4:
            block = block * rng.randint(3, 6) + [rng.choice("abcdxyz")]
        parts += block * rng.randint(1, 7)
        parts += [rng.choice("abxyz") for _ in range(rng.randint(0, 5))]
    return parts


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_all_stretches(seed):
    rng = random.Random(seed)
    texts = [made(rng) if rng.random() < 0.8 else [rng.choice("ab") for _ in range(rng.randint(0, 80))] for _ in range(12)]
    number = {w: i for i, w in enumerate("abcdxyz")}
    got = periodic.runs_of(np.array([number[w] for t in texts for w in t], np.int64), np.cumsum([len(t) for t in texts]))
    for i, words in enumerate(texts):
        assert [r for r in got.get(i, []) if r[1] >= 6] == plain_runs(words), words


def test_long_texts_of_one_word_and_of_long_periods():
    rng = np.random.default_rng(1)
    long = np.tile(rng.integers(0, 50, 3001), 5)[:14000]
    words = np.concatenate((np.zeros(40_000, np.int64), long, np.tile([1, 2], 5000)))
    got = periodic.runs_of(words, np.array([40_000, 54_000, 64_000]))
    assert got[0] == [(0, 40_000, 1)] and (0, 14_000, 3001) in got[1] and got[2] == [(0, 10_000, 2)]


def test_rows(spark):
    texts = [None, "", " \n", "a", "a a a a a", "a a a a a a", "x a b a b a b a b y", "A a A a A a A a", "é é é é é é\tz", " ".join(["p q r"] * 5000), "w " * 7 + "v " * 6]
    rows = [(i, t, [1]) for i, t in enumerate(texts)] + [(None, "c c c c c c", [2]), (5, "a a a a a a", [3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs array<int>").repartition(3)
    got = {(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed, r.strongest and tuple(r.strongest)) for r in periodic.find_runs(docs).collect()}
    want = set()
    for i, t, _ in rows:
        words = (t or "").split()
        runs = plain_runs(words) if len(words) < 1000 else [(0, 15000, 3)]
        strongest = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
        want.add((i, len(words), tuple(runs), " ".join(collapsed(words, runs)) if len(words) < 1000 else "p q r", strongest))
    assert got == want
    assert periodic.find_runs(docs.filter("doc_id = 5")).count() == 2
    assert periodic.find_runs(docs.limit(0)).collect() == []


def test_query_equals_a_plain_loop(spark):
    got = {r.doc_id: r for r in queries.op12_periodic(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words) if n < 4000 else None
        if runs is None:
            continue
        planted += h % 10 == 0
        r = got[doc_id]
        best = None
        for x in runs:
            if best is None or x[1] * best[2] > best[1] * x[2]:
                best = x
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
                hashlib.sha256(" ".join(collapsed(words, runs)).encode()).hexdigest())
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want, doc_id
    assert planted > 5
