"""Removal of byte strings that an earlier document holds too, by difference-cover suffix sorting.

Texts are spread so that equal strings meet: every window of ``WINDOW`` bytes goes, in a
string with its neighbours, to the bucket of its minimizer, the smallest hash among its
``GRAM``-byte parts. Equal windows have equal minimizers. Minimizers that occur in one
document only cannot belong to a repeated window and are left out beforehand by
counting them. A bucket holds about ``BUCKET_BYTES`` of strings; inside it the suffixes of all strings are
sorted by a difference cover (sampled triples are sorted, their names sorted by
recursion, the remaining suffixes merged), and adjacent prefixes are compared.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import give_back, mixed, stored
from tablefold.llm.keyfilter import KeyFilter, key_filter

WINDOW = 50
GRAM = 20
#: Bytes of text worked on at once, kept together before sending, and meant for one bucket.
CHUNK_BYTES = 1_000_000
SEND_BYTES = 16_000_000
BUCKET_BYTES = 1_000_000
#: Windows of occurrences compared at once.
COMPARED_WINDOWS = 1_000_000
SENT_COPIES = 1_000_000


def suffix_ranks(text: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """A rank for every suffix of ``text`` (positive integers, 0 as separator) that orders them by ``depth`` symbols at least.

    Suffixes that differ within ``depth`` symbols get ranks in their order;
    those that do not may tie or differ, but nothing else comes between them. With
    ``wanted`` (places in rising order) only their ranks are returned.
    """
    n = len(text)
    padded = np.concatenate((text.astype(np.int64), np.zeros(3, np.int64)))
    size = int(padded.max(initial=0)) + 1
    places = np.arange(n) if wanted is None else wanted
    if depth <= 3:
        return _names(padded[:n], padded[1 : n + 1], padded[2 : n + 2], size)[places]
    sampled = np.concatenate((np.arange(1, n, 3), np.arange(2, n, 3)))
    names = _names(padded[sampled], padded[sampled + 1], padded[sampled + 2], size) + 1
    ones = len(range(1, n, 3))
    shorter = np.concatenate((names[:ones], [0], names[ones:]))
    below = suffix_ranks(shorter, -(-depth // 3)) if len(sampled) and names.max() < len(sampled) else shorter
    rank = np.zeros(n + 3, np.int64)  # of sampled suffixes; 0 behind the end
    rank[sampled] = np.delete(below, ones) + 1
    big = int(rank.max()) + 1
    zeros, first, second = (places[places % 3 == k] for k in range(3))
    first_rank, second_rank = rank[first], rank[second]
    next_zero, next_first = (padded[x] * big + rank[x + 1] for x in (zeros, first))
    both = np.concatenate((zeros, second))
    two = _names(padded[both], padded[both + 1], rank[both + 2], max(size, big))  # on one scale
    two_zero, two_second = two[: len(zeros)], two[len(zeros) :]
    # a suffix's rank is the number of wanted ones before it, of its own and of the other two kinds
    out = np.empty(n if wanted is None else len(places), np.int64)
    kind = places % 3
    out[kind == 0] = _before(next_zero, next_zero) + _before(next_first, next_zero) + _before(two_second, two_zero)
    out[kind == 1] = _before(first_rank, first_rank) + _before(second_rank, first_rank) + _before(next_zero, next_first)
    out[kind == 2] = _before(first_rank, second_rank) + _before(second_rank, second_rank) + _before(two_zero, two_second)
    return out


def _before(others: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many of ``others`` are smaller than each value."""
    order = np.argsort(values)  # neighbouring searches stay in the same part of memory
    out = np.empty(len(values), np.int64)
    out[order] = np.searchsorted(np.sort(others), values[order])
    return out


def _names(a: np.ndarray, b: np.ndarray, c: np.ndarray, size: int) -> np.ndarray:
    """Dense ranks of triples of numbers below ``size``."""
    if size < 1 << 20:
        return _dense((a * size + b) * size + c)
    return _dense(_dense(a * size + b) * size + c)  # numbers of one bucket, so products stay below 2 ** 63


def _dense(keys: np.ndarray) -> np.ndarray:
    found, distinct = pd.factorize(keys)
    rank = np.empty(len(distinct), np.int64)
    rank[np.argsort(distinct)] = np.arange(len(distinct))
    return rank[found]


def equal_windows(text: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A class for each start: equal for starts with equal ``window`` symbols behind them, none of which may pass the end; starts rise."""
    rank = suffix_ranks(text, window, starts)
    order = np.argsort(rank, kind="stable")
    at = np.lib.stride_tricks.sliding_window_view(text, window)
    new = np.ones(len(starts), bool)
    for i in range(1, len(order), 100_000):
        here = starts[order[i : i + 100_000]]
        new[i : i + 100_000] = (at[here] != at[starts[order[i - 1 : i - 1 + len(here)]]]).any(1)
    out = np.empty(len(starts), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes, by doubling."""
    total, done, span, power, step = np.zeros(len(data), np.uint64), 0, 1, 0x9E3779B97F4A7C15, data.astype(np.uint64) + np.uint64(1)
    while True:
        if gram & span:
            valid = len(data) - done - span + 1
            total = total[:valid] * np.uint64(power) + step[done : done + valid]
            done += span
        if done == gram:
            return mixed(total[: len(data) - gram + 1])
        step = step[:-span] * np.uint64(power) + step[span:]
        power = power * power % 2**64
        span *= 2


def _lowest(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest hash in every ``width`` neighbours."""
    at, span = np.arange(len(hashes)), 1

    def lower(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(hashes[left] <= hashes[right], left, right)

    while span * 2 <= width:
        at = lower(at[:-span], at[span:])
        span *= 2
    rest = width - span
    return lower(at[: len(at) - rest], at[rest:]) if rest else at


class Chunk:
    """Some whole texts as one run of bytes, with the minimizer of every window that lies inside a text."""

    def __init__(self, ids: list[int], texts: list[bytes], window: int, gram: int):
        self.ids = np.array(ids, np.int64)
        #: Tells apart texts of rows that repeat an identifier.
        self.tags = np.array([zlib.crc32(t) for t in texts], np.int64)
        sizes = np.array([len(t) for t in texts])
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        hashes = _gram_hashes(self.data, gram)
        lowest = _lowest(hashes, window - gram + 1)
        inside = np.arange(len(lowest)) + window <= np.repeat(self.ends, sizes)[: len(lowest)]
        change = np.flatnonzero((lowest[1:] != lowest[:-1]) | (inside[1:] != inside[:-1])) + 1
        first = np.concatenate(([0], change))
        past = np.concatenate((change, [len(lowest)]))
        use = inside[first]
        #: Runs of windows with one minimizer: first window, past the last, text, and 48 bits of the minimizer's hash.
        self.first, self.past = first[use], past[use]
        self.text = np.searchsorted(self.ends, self.first, side="right")
        self.key = hashes[lowest[self.first]] >> np.uint64(16)


def _chunks(batches: Iterable[pa.RecordBatch], window: int, gram: int) -> Iterator[Chunk]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in enumerate(batch.column(1)):
            text = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if len(text) >= window:
                ids.append(batch.column(0)[i].as_py())
                texts.append(text)
                size += len(text)
                if size > CHUNK_BYTES:
                    yield Chunk(ids, texts, window, gram)
                    ids, texts, size = [], [], 0
    if ids:
        yield Chunk(ids, texts, window, gram)


def _repeated_keys(texts: DataFrame, window: int, gram: int, buckets: int) -> DataFrame:
    """``key``: minimizers that occur in more than one text.

    A text is sent in one piece, so a key that comes from two pieces is in two
    texts; inside a piece only one text's occurrence counts. Keys travel as 6 bytes.
    """

    def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, texts_before = [], 0, 0
        for chunk in _chunks(batches, window, gram):
            held.append((chunk.key, chunk.text + texts_before))
            texts_before += len(chunk.ids)
            size += len(chunk.data)
            if size > SEND_BYTES:
                yield pieces(held)
                held, size = [], 0
        if held:
            yield pieces(held)
        del held
        give_back()

    def pieces(held: list) -> pa.RecordBatch:
        key, text = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        twice = np.add.reduceat(np.concatenate(([False], (key[1:] == key[:-1]) & (text[1:] != text[:-1]))).astype(np.int64), start) > 0
        key = key[start]
        bucket = (mixed(key) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.record_batch(
            [pa.array(np.arange(buckets, dtype=np.int32)), pa.array([_six(key[r]) for r in rows], pa.binary()), pa.array([_six(key[r[twice[r]]]) for r in rows], pa.binary())],
            ["bucket", "keys", "twice"],
        )

    def counted(table: pa.Table) -> pa.Table:
        give_back()
        lists = [_from_six(x.as_py()) for name in ("keys", "twice") for x in table.column(name)]
        found, n = np.unique(np.concatenate(lists), return_counts=True)
        return pa.table({"key": found[n > 1].view(np.int64)})

    return texts.mapInArrow(sent, "bucket int, keys binary, twice binary").groupBy("bucket").applyInArrow(counted, "key bigint")


def _six(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _repeats(texts: DataFrame, wanted: Broadcast, window: int, gram: int, buckets: int) -> DataFrame:
    """``doc_id, tag, start, end``: bytes covered by windows that a text with a smaller identifier holds too."""

    def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[dict[bytes, int], list]] = {}
        known, size = KeyFilter(wanted.value), 0
        for chunk in _chunks(batches, window, gram):
            use = np.flatnonzero(known.passes(chunk.key))
            data = chunk.data.tobytes()
            bucket = (mixed(chunk.key[use]) % np.uint64(buckets)).tolist()
            first, past, text = chunk.first[use], chunk.past[use] - 1 + window, chunk.text[use]
            rows = zip(chunk.ids[text].tolist(), chunk.tags[text].tolist(), (first - chunk.begins[text]).tolist(), strict=True)
            for b, a, z, row in zip(bucket, first.tolist(), past.tolist(), rows, strict=True):
                strings, found = held.setdefault(b, ({}, []))
                found.append((strings.setdefault(data[a:z], len(strings)), *row))
                size += z - a
            if size > SEND_BYTES // 2:
                yield pieces(held)
                held, size = {}, 0
        if held:
            yield pieces(held)
        del held
        give_back()

    def pieces(held: dict) -> pa.RecordBatch:
        out: dict[str, list] = {"bucket": list(held), "lengths": [], "strings": [], "string": [], "doc": [], "tag": [], "place": []}
        for strings, found in held.values():
            out["lengths"].append(np.array([len(s) for s in strings], "<u4").tobytes())
            out["strings"].append(b"".join(strings))
            string, doc, tag, place = zip(*found, strict=True)
            out["string"].append(np.array(string, "<u4").tobytes())
            out["doc"].append(np.array(doc, "<i8").tobytes())
            out["tag"].append(np.array(tag, "<u4").tobytes())
            out["place"].append(np.array(place, "<u4").tobytes())
        return pa.record_batch([pa.array(v, pa.int32() if k == "bucket" else pa.binary()) for k, v in out.items()], list(out))

    def judged(table: pa.Table) -> pa.Table:
        give_back()  # what the bucket before has left
        known: dict[bytes, int] = {}
        string, doc, tag, place = [], [], [], []
        for lengths, strings, *found in zip(*(table.column(c) for c in ("lengths", "strings", "string", "doc", "tag", "place")), strict=True):
            row = dict(zip(("string", "doc", "tag", "place"), (x.as_py() for x in found), strict=True))
            ends, data = np.cumsum(np.frombuffer(lengths.as_py(), "<u4")).tolist(), strings.as_py()
            here = [known.setdefault(data[a:b], len(known)) for a, b in zip([0, *ends], ends, strict=False)]
            string.append(np.array(here)[np.frombuffer(row["string"], "<u4")])
            doc.append(np.frombuffer(row["doc"], "<i8"))
            tag.append(np.frombuffer(row["tag"], "<u4").astype(np.int64))
            place.append(np.frombuffer(row["place"], "<u4").astype(np.int64))
        string, doc, tag, place = map(np.concatenate, (string, doc, tag, place))
        sizes = np.array([len(s) for s in known])
        begins = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int((sizes + 1).sum()), np.int16)
        text[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = np.frombuffer(b"".join(known), np.uint8).astype(np.int16) + 1
        earliest = np.full(len(sizes), np.iinfo(np.int64).max)
        np.minimum.at(earliest, string, doc)
        n = sizes - window + 1
        before = np.cumsum(n) - n
        starts = np.arange(int(n.sum())) + np.repeat(begins - before, n)
        kind = equal_windows(text, starts, window)
        least = np.full(int(kind.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, kind, np.repeat(earliest, n))
        least = least[kind]
        # every occurrence, window by window, in parts of bounded size
        spans = [np.zeros((0, 4), np.int64)]
        done = np.cumsum(n[string])
        at = 0
        while at < len(string):
            past = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + COMPARED_WINDOWS, side="right")))
            own, m = string[at:past], n[string[at:past]]
            row = np.repeat(np.arange(at, past), m)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m)
            gone = least[np.repeat(before[own], m) + offset] < doc[row]
            row, offset = row[gone], offset[gone]
            if len(row):
                new = np.concatenate(([True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)))
                last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(row) - 1]))
                spans.append(np.stack((doc[row[new]], tag[row[new]], place[row[new]] + offset[new], place[row[last]] + offset[last] + window), 1))
            at = past
        return pa.table(dict(zip(("doc_id", "tag", "start", "end"), map(pa.array, np.ascontiguousarray(np.concatenate(spans).T)), strict=True)))

    strings = texts.mapInArrow(sent, "bucket int, lengths binary, strings binary, string binary, doc binary, tag binary, place binary")
    return strings.groupBy("bucket").applyInArrow(judged, "doc_id bigint, tag bigint, start bigint, end bigint")


def _kept(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """From ``doc_id, text, copy, spans`` to ``doc_id, n_bytes, spans, kept``."""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sizes, spans, kept = [], [], []
            for text, copy, found in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                runs: list[list[int]] = [[0, len(data)]] if copy and len(data) >= window else []
                for x in sorted(((x["start"], x["end"]) for x in found or ()) if not runs else ()):
                    if runs and x[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], x[1])
                    else:
                        runs.append(list(x))
                cuts = [0, *(c for r in runs for c in r), len(data)]
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
            yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span_type), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: what is left of a text without the bytes an earlier document has.

    A byte goes if any ``window`` bytes that cover it also start in a document with a
    smaller identifier (a whole number), judged on the texts as given, in UTF-8.
    ``spans`` are the maximal removed runs (``start``, ``end`` in bytes), ``kept`` the
    bytes left. Whole copies of an earlier text meet by a hash of the text and skip the
    sorting. A null text is empty; texts shorter than ``window`` stay whole; rows with a
    null identifier neither lose bytes nor cost others any; rows that repeat an
    identifier, with one text or several, count as one document to each other. An empty
    table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    hashed = source.filter("doc_id is not null").select("doc_id", digest.alias("digest"))
    copied = stored(hashed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    if copied.count() <= SENT_COPIES:
        copied = F.broadcast(copied)
    given = source.withColumn("digest", digest).join(copied, "digest", "left").select("doc_id", "text", F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)).alias("copy"))
    texts = given.filter("doc_id is not null and not copy").select("doc_id", "text")
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, total // bucket_bytes)
    wanted = key_filter(stored(_repeated_keys(texts, window, gram, buckets)))
    found = stored(_repeats(texts, wanted, window, gram, buckets).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    # only texts that may have spans move to meet them
    marks = key_filter(found.select(F.xxhash64("doc_id", "tag").alias("key")))

    names = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    nothing = F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    maybe = _maybe(given, marks)
    still = maybe.filter("not maybe").select("doc_id", "text", "copy", nothing)
    moved = maybe.filter("maybe").withColumn("tag", _tag()).join(found, ["doc_id", "tag"], "left").select("doc_id", "text", "copy", "spans")
    return still.mapInArrow(lambda b: _kept(b, window), names).unionByName(moved.mapInArrow(lambda b: _kept(b, window), names))


def _tag() -> Column:
    return F.crc32(F.coalesce("text", F.lit("")).cast("binary"))


def _maybe(given: DataFrame, marks: Broadcast) -> DataFrame:
    """Adds ``maybe``: whether the filter may hold the identifier; never for copies and null identifiers."""

    def marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KeyFilter(marks.value)
        for batch in batches:
            keys = batch.column(3).to_numpy(zero_copy_only=False)
            hit = known.passes(keys) & ~np.array(batch.column(2).to_pylist(), bool) & np.array(batch.column(0).is_valid())
            yield pa.record_batch([*batch.columns[:3], pa.array(hit)], ["doc_id", "text", "copy", "maybe"])

    return given.withColumn("key", F.xxhash64(F.col("doc_id"), _tag())).mapInArrow(marked, "doc_id bigint, text string, copy boolean, maybe boolean")
