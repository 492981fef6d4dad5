"""How far the word use of the sources of a language lies apart, by a sparse merge per pair of sources.

Words are counted inside tasks, then summed. The kept words of a language are cut into
slices of bounded size and numbered inside their slice, so a source is one sorted array of
(word number, count) per slice. Sources are cut into blocks; one task merges two blocks of
one slice, pair by pair: a galloping search finds the common words, which are priced by both
counts, words of one source are priced against the other one's price of an absent word, and
words of neither are counted and priced once at the end. A price is the same both ways,
so an unordered pair gives two rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefold.llm.common import pieces_of, stored

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Words in one slice, sources in one block, distinct words counted in a task before they are sent on, bytes of text at once.
SLICE_TERMS = 50_000
BLOCK_GROUPS = 64
HELD_TERMS = 300_000
CHUNK_BYTES = 4_000_000

#: Everything but letters of ASCII and bytes of other characters separates; A-Z become lower case.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, lang_n, found`` of rows ``text, lang, source``: words of at least ``min_docs`` rows of the language, with occurrences in all and by source.

    Tasks send a row per language and word. Only these move, once, by language and
    word; a word that is too seldom goes there, before its sources are told apart.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Counter, dict[str, Counter]]] = {}
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, (in_docs, by_source) in held.items():
                place = dict(zip(in_docs, range(len(in_docs)), strict=True))
                at = np.fromiter((place[t] for n in by_source.values() for t in n), np.int64, sum(map(len, by_source.values())))
                n = np.fromiter((x for n in by_source.values() for x in n.values()), np.int64, len(at))
                source = np.repeat(np.arange(len(by_source)), [len(n) for n in by_source.values()])
                order = np.argsort(at, kind="stable")
                offsets = pa.array(np.searchsorted(at[order], np.arange(len(place) + 1)), pa.int32())
                found = pa.StructArray.from_arrays([pa.array(list(by_source), pa.string()).take(pa.array(source[order])), pa.array(n[order])], ["source", "n"])
                terms = pa.array([t.decode("utf-8", "surrogatepass") for t in in_docs], pa.string())
                columns = [pa.array([lang] * len(place), pa.string()), terms, pa.array(in_docs.values(), pa.int64()), pa.ListArray.from_arrays(offsets, found)]
                yield pa.record_batch(columns, ["lang", "term", "docs", "found"])

        for batch in pieces_of(batches, "text", CHUNK_BYTES):
            for text, lang, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()
                if own:
                    in_docs, by_source = held.setdefault(lang, (Counter(), {}))
                    n = by_source.setdefault(source, Counter())
                    before = len(n)
                    n.update(own)
                    in_docs.update(set(own))
                    size += len(n) - before
            if size > HELD_TERMS:
                yield from sent()
                held, size = {}, 0
        yield from sent()

    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    rows = given.mapInArrow(counted, "lang string, term string, docs bigint, found array<struct<source:string,n:bigint>>")
    everywhere = Window.partitionBy("lang", "term")
    often = rows.withColumn("all_docs", F.sum("docs").over(everywhere)).filter(F.col("all_docs") >= min_docs)
    # all of this stays where the window has put it
    summed = often.select("lang", "term", F.inline("found")).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    return summed.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("found"))


def _price(n: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / total)`` by long division, exact below 9 * 10 ** 15 occurrences."""
    rest, out = n + 2, F.lit(0).cast("bigint")
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + _div(rest, total)
        rest = rest % total
    return out + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def price(n: np.ndarray, total: int) -> np.ndarray:
    """The same for an array of counts."""
    rest, out = np.asarray(n, np.int64) + 2, 0
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Place in ``long`` of the first number not below each of ``short``; both rise.

    Every 64th number is searched in the whole array; the others start at the place
    of the one before them and double their stride until they have passed.
    """
    n, m = len(short), len(long)
    if not n or not m:
        return np.zeros(n, np.int64)
    low = np.repeat(np.searchsorted(long, short[::64]), 64)[:n]
    stride = np.ones(n, np.int64)
    high = low.copy()
    going = np.flatnonzero(long[np.minimum(high, m - 1)] < short)
    going = going[high[going] < m]
    while len(going):
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + stride[going], m)
        stride[going] *= 2
        going = going[(high[going] < m) & (long[np.minimum(high[going], m - 1)] < short[going])]
    while True:  # halve what lies between
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        below = long[middle] < short[open_]
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)


def merged(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int]) -> tuple[int, int]:
    """Value over the words that either source has, and their number; a source is its word numbers, their prices and its price of an absent word."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (ids, p, p0), (others, q, q0) = a, b
    at = gallop(ids, others)
    both = np.zeros(len(ids), bool)
    inside = at < len(others)
    both[inside] = others[at[inside]] == ids[inside]
    alone = np.ones(len(others), bool)
    alone[at[both]] = False
    value = int(apart(p[both], q[at[both]]).sum()) + int(apart(p[~both], q0).sum()) + int(apart(q[alone], p0).sum())
    return value, len(ids) + int(alone.sum())


def sparse_arrays(found: DataFrame, langs: DataFrame, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """``lang, source, slice, ids, counts``: each source's words of a slice by their number in it, which follows from all words of the slice."""
    most = langs.agg(F.max("terms")).first()[0] or 0
    sliced = found.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(most // slice_terms + 1)).cast("int"))
    numbered = sliced.withColumn("id", F.row_number().over(Window.partitionBy("lang", "slice").orderBy("term")))
    by_source = numbered.select("lang", "slice", "id", F.inline("found")).groupBy("lang", "source", "slice").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("found"))
    return stored(by_source.select("lang", "source", "slice", F.col("found.id").alias("ids"), F.col("found.n").alias("counts")))


def pair_values(kept: DataFrame, groups: DataFrame, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """``lang, a, b, value`` for every unordered pair of sources of a language.

    ``kept`` has ``lang, source, slice, ids, counts``: a source's words of a slice by rising
    number. ``groups`` has ``lang, source, total`` (occurrences of kept words and twice
    their number) and ``terms`` (their number).
    """
    blocked = stored(groups.withColumn("block", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("bigint")).withColumn("block", _div(F.col("block"), F.lit(block_groups)).cast("int")))
    # sources without a word of a slice take part in it too, without arrays
    every = kept.select("lang", "slice").distinct().join(blocked.select("lang", "source", "total", "block"), "lang")
    full = every.join(kept, ["lang", "source", "slice"], "left")
    blocks = blocked.groupBy("lang").agg((F.max("block") + 1).alias("blocks"))
    dealt = stored(full.join(blocks, "lang"))
    task = ["lang", "slice", "i", "j"]
    left = dealt.withColumn("i", F.col("block")).withColumn("j", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
    right = dealt.withColumn("j", F.col("block")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("block"))))

    def sources(table: pa.Table) -> list[tuple]:
        out = []
        for source, ids, n, total in zip(*(table.column(c) for c in ("source", "ids", "counts", "total")), strict=True):
            total, none = total.as_py(), np.zeros(0, np.int64)
            ids, n = (np.asarray(x.values, np.int64) if x.is_valid else none for x in (ids, n))
            out.append((source.as_py(), (ids, price(n, total), int(price(np.zeros(1), total)[0]))))
        return sorted(out, key=lambda x: x[0].encode("utf-8", "surrogatepass"))

    def priced(one: pa.Table, two: pa.Table) -> pa.Table:
        lang = (one if one.num_rows else two).column("lang")[0].as_py()
        rows = [(lang, a, b, *merged(x, y)) for a, x in sources(one) for b, y in sources(two) if a.encode("utf-8", "surrogatepass") < b.encode("utf-8", "surrogatepass")]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 5, [pa.string()] * 3 + [pa.int64()] * 2, strict=True)], ["lang", "a", "b", "value", "seen"])

    columns = [*task, "source", "ids", "counts", "total"]
    parts = left.select(*columns).groupBy(*task).cogroup(right.select(*columns).groupBy(*task)).applyInArrow(priced, "lang string, a string, b string, value bigint, seen bigint")
    total = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    own = groups.select("lang", F.col("source").alias("a"), "terms", _price(F.lit(0).cast("bigint"), F.col("total")).alias("p"))
    other = groups.select("lang", F.col("source").alias("b"), _price(F.lit(0).cast("bigint"), F.col("total")).alias("q"))
    absent = total.join(own, ["lang", "a"]).join(other, ["lang", "b"])
    return absent.select("lang", "a", "b", (F.col("value") + (F.col("terms") - F.col("seen")) * _apart(F.col("p"), F.col("q"))).alias("value"))


def _apart(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
    slice_terms: int = SLICE_TERMS, block_groups: int = BLOCK_GROUPS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source lies from the others of its language, and by which words from all of it.

    Words are runs of ASCII letters and non-ASCII characters, A-Z in lower case; a
    language keeps those of at least ``min_docs`` of its rows. The price of a word in a
    source is ``1 + floor(10^9 (n + 2) / (N + 2 V))``, with its ``n`` occurrences there, N of
    all V kept words; two prices lie ``floor((p - q)^2 / (p + q))`` apart. Part ``pair``
    has every other source of the language with the sum over its kept words (0 without
    any), part ``term`` the ``top_terms`` words that the source prices above its language,
    each with its value. Ranks go by value, the highest first, then by item in UTF-8
    order. Null text, language and source count as empty; every row counts, repeated ones
    too; a language with one source has no pair; an empty table gives no row.
    """
    given = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    found = stored(kept_terms(given, min_docs))
    langs = found.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    kept = sparse_arrays(found, langs, slice_terms)
    occurring = given.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda total, n: total + n)).alias("total"))
    zero = F.lit(0).cast("bigint")
    groups = occurring.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("terms", zero).alias("terms"), (F.coalesce("total", zero) + 2 * F.coalesce("terms", zero)).alias("total"),
        (F.coalesce("lang_total", zero) + 2 * F.coalesce("terms", zero)).alias("lang_total"),
    )
    groups = stored(groups)
    values = pair_values(kept, groups.filter("terms > 0"), block_groups)
    both = values.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(values.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    bare = groups.filter("terms = 0").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item").withColumn("value", zero)
    pairs = both.unionByName(none.select(*both.columns))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    priced = found.select("lang", "term", "lang_n", F.inline("found")).join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _price(F.col("n"), F.col("total")).alias("p"), _price(F.col("lang_n"), F.col("lang_total")).alias("q")
    )
    above = priced.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", _apart(F.col("p"), F.col("q")).alias("value"))
    top = above.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top_terms)
    return pairs.unionByName(top)
