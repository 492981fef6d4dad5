"""Benchmark passages in documents, found by greedy string tiling."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import WordHashes, mixed, rows, stored
from tablefold.operators.joins import sized_join

#: Shortest match, in words, and how much of a benchmark text the matches must cover.
MIN_MATCH = 5
MIN_COVERAGE = 0.5
#: Most benchmark words sent to every task; larger benchmarks are joined by shuffle instead.
SENT_WORDS = 4_000_000

_BASE = 0x9E3779B97F4A7C15
_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Words in lower case; ASCII characters other than letters and digits separate them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split() if text else []


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every window, by Horner's rule; one pass per doubling of the width."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # step[i] is the hash of the span words from i on; total[i] that of the first done words from i on
    total, done, power, step, span = np.zeros(len(codes), np.uint64), 0, _BASE, codes.astype(np.uint64), 1
    while True:
        if width & span:
            valid = len(codes) - done - span + 1
            total = total[:valid] * np.uint64(power) + step[done : done + valid]
            done += span
        if done == width:
            return mixed(total[:n])
        step = step[:-span] * np.uint64(power) + step[span:]
        power = power * power % 2**64
        span *= 2


def _free_windows(marked: np.ndarray, width: int) -> np.ndarray:
    taken = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(taken[width:] == taken[:-width])


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiling of ``item`` by parts of ``doc``: (length, place in item, place in doc).

    Runs a Karp-Rabin scan with a search length that starts at the item's and
    halves down to ``min_match``. Each scan extends the hash matches among
    unmarked words and marks the longest ones first; what marked words leave of
    a match stands in line again with its own length. A match much longer than
    the search length restarts the scan with its own length. In the end no common
    run of ``min_match`` unmarked words is left.
    """
    taken_item, taken_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    out: list[tuple[int, int, int]] = []
    width = max(min_match, min(len(item), len(doc)) // 2)
    while True:
        found = _scan(item, doc, taken_item, taken_doc, width)
        longest = max((k for k, _, _ in found), default=0)
        if longest > 2 * width:
            width = longest
            continue
        queue = [(-k, i, j) for k, i, j in found]
        heapify(queue)
        while queue:
            k, i, j = heappop(queue)
            taken = taken_item[i : i - k] | taken_doc[j : j - k]
            if not taken.any():
                taken_item[i : i - k] = taken_doc[j : j - k] = True
                out.append((-k, i, j))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])))).tolist()
            for start, end in zip(edges[::2], edges[1::2], strict=True):
                if end - start >= width:
                    heappush(queue, (start - end, i + start, j + start))
        if width <= min_match:
            return out
        width = max(min_match, width // 2)


def _scan(item: np.ndarray, doc: np.ndarray, taken_item: np.ndarray, taken_doc: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    if min(len(item), len(doc)) < width:
        return []
    places = defaultdict(list)
    hashes = window_hashes(item, width)
    for i in _free_windows(taken_item, width).tolist():
        places[hashes[i].item()].append(i)
    free = _free_windows(taken_doc, width)
    hashes = window_hashes(doc, width)[free]
    hit = np.isin(hashes, np.fromiter(places, np.uint64, len(places)))
    found, past = [], {}
    for j, h in zip(free[hit].tolist(), hashes[hit].tolist(), strict=True):
        for i in places[h]:
            if past.get(i - j, -1) > i:
                continue  # inside a match already extended on this diagonal
            room = min(len(item) - i, len(doc) - j)
            differs = np.flatnonzero((item[i : i + room] != doc[j : j + room]) | taken_item[i : i + room] | taken_doc[j : j + room])
            k = int(differs[0]) if len(differs) else room
            if k >= width:
                found.append((k, i, j))
                past[i - j] = i + k
    return found


class Benchmark:
    """Benchmark texts as numbered words, with the hashes of their windows of ``min_match`` words."""

    def __init__(self, items: list[tuple[object, list[bytes]]], min_match: int):
        self.numbers: dict[bytes, int] = {}
        self.items, seeds = [], defaultdict(set)
        for item, found in items:
            codes = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in found], np.uint64)
            width = min(min_match, len(codes))
            for h in window_hashes(codes, width).tolist() if width else ():
                seeds[width, h].add(len(self.items))
            self.items.append((item, codes))
        self.seeds = {w: {h: s for (v, h), s in seeds.items() if v == w} for w in {w for w, _ in seeds}}
        self.sorted = {w: np.sort(np.fromiter(s, np.uint64, len(s))) for w, s in self.seeds.items()}

    def codes(self, text: str | None) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.numbers.get, found, repeat(0)), np.int64, len(found)).view(np.uint64)

    def candidates(self, codes: np.ndarray) -> set[int]:
        """Items that share a window with the words of a document."""
        found: set[int] = set()
        for width, known in self.sorted.items():
            hashes = window_hashes(codes, width)
            if not len(hashes):
                continue
            known_run = np.concatenate(([0], np.cumsum(codes == 0)))
            hashes = hashes[known_run[width:] == known_run[:-width]]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for h in set(hashes[known[at] == hashes].tolist()):
                found |= self.seeds[width][h]
        return found


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE, sent_words: int = SENT_WORDS,
) -> DataFrame:
    """Documents that hold a benchmark text, in one piece or in several in any order.

    One row per document row and benchmark row with ``doc_id, item_id, coverage, tiles``:
    ``coverage`` is the share of the benchmark text's words under tiles of at
    least ``min_match`` words (shorter texts: their length), ``tiles`` their
    ``length, item_start, doc_start`` in words. Pairs must share one such window;
    coverage must reach ``min_coverage``. Null or empty texts match nothing. A
    benchmark of up to ``sent_words`` words is sent to every task, and documents
    do not move; a larger one is joined by window hashes in a shuffle, with equal
    results but for documents with a null identifier, which take no part in that
    join. Benchmark rows meet it by a number, so a null ``item_id`` is one like others.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = {"doc_id": dict(docs.dtypes)[id_col], "item_id": dict(benchmark.dtypes)[item_col]}
    out = f"doc_id {ids['doc_id']}, item_id {ids['item_id']}, coverage double, tiles array<struct<length:int,item_start:int,doc_start:int>>"
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= 2 * sent_words:  # a word and its gap take two characters at least
        found = [(r["item_id"], words(r["text"])) for r in items.toLocalIterator()]
        shared = docs.sparkSession.sparkContext.broadcast(found)

        def tiled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Benchmark(shared.value, min_match)
            for batch in batches:
                done = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    codes = known.codes(text)
                    done += [(doc, known.items[k][0], *x) for k in sorted(known.candidates(codes)) if (x := _covered(known.items[k][1], codes, min_match, min_coverage))]
                yield _batch(done, batch.schema.field(0).type, item_type)

        item_type = items.select("item_id").limit(0).toArrow().schema.field(0).type
        return source.mapInArrow(tiled, out)
    # stored, so that a row keeps its number
    numbered = stored(items.withColumn("item", F.monotonically_increasing_id()))
    pairs = (
        _windows(source, "doc_id", min_match, True).join(_windows(numbered.select("item", "text"), "item", min_match, False), ["width", "hash"])
        .select("doc_id", "item").distinct()
    )
    both = pairs.join(source.filter("doc_id is not null"), "doc_id").join(numbered.toDF("item_id", "item_text", "item"), "item").select("doc_id", "text", "item_id", "item_text")

    def paired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for doc, text, item, item_text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                known = Benchmark([(item, words(item_text))], min_match)
                if x := _covered(known.items[0][1], known.codes(text), min_match, min_coverage):
                    done.append((doc, item, *x))
            yield _batch(done, batch.schema.field(0).type, batch.schema.field(2).type)

    return both.mapInArrow(paired, out)


def _windows(texts: DataFrame, key: str, min_match: int, is_doc: bool) -> DataFrame:
    """Distinct window hashes of each text; documents also at widths below ``min_match``, for short benchmark texts."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(text)
                codes = np.fromiter((known[w] for w in found), np.uint64, len(found))
                for width in range(1, min_match + 1) if is_doc else [min(min_match, len(codes))]:
                    if width and (is_doc or len(codes)):
                        h = np.unique(window_hashes(codes, width)).astype(np.int64)
                        yield pa.record_batch([pa.array([k] * len(h), batch.schema.field(0).type), pa.array(np.full(len(h), width, np.int32)), pa.array(h)], [key, "width", "hash"])

    kind = dict(texts.dtypes)[key]
    return texts.filter(F.col(key).isNotNull()).mapInArrow(hashed, f"{key} {kind}, width int, hash bigint")


def _covered(item: np.ndarray, doc: np.ndarray, min_match: int, min_coverage: float) -> tuple[float, list[dict]] | None:
    found = tiles(item, doc, min(min_match, len(item))) if len(item) else []
    coverage = sum(k for k, _, _ in found) / max(1, len(item))
    if not found or coverage < min_coverage:
        return None
    return coverage, [{"length": k, "item_start": i, "doc_start": j} for k, i, j in found]


def _batch(done: list[tuple], doc_type: pa.DataType, item_type: pa.DataType) -> pa.RecordBatch:
    tile = pa.list_(pa.struct([("length", pa.int32()), ("item_start", pa.int32()), ("doc_start", pa.int32())]))
    columns = list(zip(*done, strict=True)) or [[], [], [], []]
    arrays = [pa.array(c, t) for c, t in zip(columns, (doc_type, item_type, pa.float64(), tile), strict=True)]
    return pa.record_batch(arrays, ["doc_id", "item_id", "coverage", "tiles"])


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Rows of ``docs`` whose document holds no benchmark text; rows with a null identifier stay."""
    found = matches(docs, benchmark, id_col, **options).select(F.col("doc_id").alias(id_col)).distinct()
    return sized_join(docs, found, [id_col], "left_anti").select(*docs.columns)
