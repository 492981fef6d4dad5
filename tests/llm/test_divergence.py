"""The audit against exact arithmetic by a plain loop, and the query against SQL."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import compare
from tablefold.llm import divergence, queries

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    out, word = [], ""
    for c in text + " ":
        if c.isascii() and not c.isalpha():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def plain(rows, min_docs, top):
    rows = [tuple("" if x is None else x for x in r) for r in rows]
    in_docs, by_group = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        by_group[lang, source].update(words_of(text))
        in_docs[lang].update(set(words_of(text)))
    out = set()
    for lang in {r[1] for r in rows}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)
        groups = {s: by_group[g, s] for g, s in by_group if g == lang}
        everything = sum(groups.values(), Counter())

        def prices(counts):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        q = prices(everything)
        for s, counts in groups.items():
            p = prices(counts)
            pairs = []
            for o, others in groups.items():
                if o != s:
                    r = prices(others)
                    pairs.append((o, sum(f(p[t], r[t]) for t in kept)))
            terms = [(t, f(p[t], q[t])) for t in kept if counts[t] and p[t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found) if part == "pair" or k < top}
    return out


def rows_of(df):
    return {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_plain_loop(spark, seed, monkeypatch):
    rng = random.Random(seed)
    words = ["a", "B", "b", "É", "é", "ß1x", "don't", "日本", "x_y", *(f"w{c}" for c in "abcdefghij")]
    rows = []
    for _ in range(150):
        lang = rng.choice(["de", "de", "en", None, ""])
        rows.append((" ".join(rng.choices(words, k=rng.randint(0, 20))), lang, rng.choice(["s1", "s2", "s2", "S", "é", "", None])))
    rows += [(None, "fr", "one"), ("x", "fr", "two"), ("1 2", "zz", None), (" ".join(["deep"] * 3000), "de", "s9"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "text string, lang string, source string, item int")
    monkeypatch.setattr(divergence, "HELD_TERMS", 30)
    assert rows_of(divergence.audit(docs, min_docs=4, top_terms=3)) == plain(rows, 4, 3)


def test_slices_and_blocks_do_not_change_values(spark):
    rng = random.Random(5)
    rows = [(" ".join(f"t{chr(97 + rng.randint(0, 25))}" for _ in range(rng.choice([0, 3, 30]))), "l", f"s{s % 9}") for s in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert rows_of(divergence.audit(docs, min_docs=2, slice_terms=7, block_groups=2)) == plain(rows, 2, 10)


def test_price_is_exact_for_large_counts():
    for n, total in ((0, 2), (10**15, 3 * 10**15 + 7), (123456789012, 987654321098765), (5, 6)):
        assert int(divergence.price(np.array([n]), total + 2)[0]) == 1 + 10**9 * (n + 2) // (total + 2)


@pytest.mark.parametrize("seed", range(5))
def test_gallop_finds_places(seed):
    rng = np.random.default_rng(seed)
    long = np.unique(rng.integers(0, 5000, rng.integers(0, 3000)))
    short = np.unique(rng.integers(-5, 5100, rng.integers(0, 600)))
    assert divergence.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_query_equals_sql(spark):
    want = compare.duck_rows(compare.connect(SF_DIR), queries.ORACLE["op11_divergence"])
    assert compare.spark_rows(queries.op11_divergence(spark, SF_DIR)) == want
