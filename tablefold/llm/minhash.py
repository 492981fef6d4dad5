"""Near-duplicate documents by SetSketch registers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import WordHashes, mixed, shingle_set, stored
from tablefold.llm.components import components
from tablefold.llm.keyfilter import KeyFilter, key_filter

WIDTH = 5
REGISTERS = 256
BAND_ROWS = 6
#: Base of the register scale, rate of the register minima, and the largest register value.
BASE = 1.02
RATE = 20.0
TOP = 65535
#: How far an estimate may fall short of the threshold before a pair is left unverified: over six standard deviations.
MARGIN = 0.15
#: In how many sets a shingle must be, more than, for each step of the order from seldom to frequent.
OFTEN = (1, 4, 16, 64, 256)
#: Most identifiers sent to every task.
SENT_IDS = 2_000_000


def sketch(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Register values (uint16) of each set of element hashes, one row per set.

    Every element runs a Poisson process over the registers: its arrivals come at
    exponentially distributed steps and pick a register each, so each register
    sees the minimum of independent exponentials of rate ``RATE`` per element.
    An element stops once its next arrival exceeds all minima of its set. A
    register holds the minimum on a logarithmic scale, truncated to 0..``TOP``;
    the sketch of a union is the larger value in each register.
    """
    n = len(sets)
    low = np.full(n * registers, np.inf)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    state = np.concatenate(sets) if n else np.empty(0, np.uint64)
    at = np.zeros(len(state))
    turn = 0
    while len(state):
        turn += 1
        draw = mixed(state + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64))
        at = at - np.log1p(-((draw >> np.uint64(11)).astype(np.float64)) * 2.0**-53) / (RATE * registers)
        np.minimum.at(low, rows * registers + (mixed(draw) % np.uint64(registers)).astype(np.int64), at)
        alive = at < np.minimum(low.reshape(n, registers).max(1), 1.0)[rows]
        state, at, rows = state[alive], at[alive], rows[alive]
    with np.errstate(divide="ignore"):
        value = np.floor(1.0 - np.log(low) / np.log(BASE))
    return np.clip(value, 0, TOP).astype(np.uint16).reshape(n, registers)


def estimated(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity that makes the register comparisons of each pair likeliest, given the set sizes.

    ``a``, ``b``: register rows. The chance that one register exceeds the other
    follows from the part of the union only its set covers; the log-likelihood
    of the three counts (larger, smaller, equal) is concave enough for a golden
    section search, run for all pairs at once.
    """
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - larger - smaller
    u = size_a / (size_a + size_b)
    v = 1 - u

    def exceeds(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def fit(j: np.ndarray) -> np.ndarray:
        p, q = exceeds(u - v * j), exceeds(v - u * j)
        tiny = 1e-300
        return larger * np.log(p + tiny) + smaller * np.log(q + tiny) + equal * np.log(np.maximum(1 - p - q, tiny))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    g = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        x, y = hi - g * (hi - lo), lo + g * (hi - lo)
        right = fit(x) < fit(y)
        lo, hi = np.where(right, x, lo), np.where(right, hi, y)
    return (lo + hi) / 2


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, set_key, registers``: set size, a 128-bit hash of the set, and its register bytes."""

    def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            start, held = 0, []
            size = 0
            for i in range(len(texts)):
                held.append(shingle_set(texts[i].as_py(), known, width))
                size += len(held[-1])
                if size > 300_000 or len(held) == 2_000 or i == len(texts) - 1:
                    keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in held]
                    arrays = [ids.slice(start, len(held)), pa.array([len(s) for s in held], pa.int64()), pa.array(keys, pa.binary()), pa.array([r.tobytes() for r in sketch(held)], pa.binary())]
                    yield pa.record_batch(arrays, ["doc_id", "n_shingles", "set_key", "registers"])
                    start, held, size = i + 1, [], 0

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(sketched, f"doc_id {dict(docs.dtypes)[id_col]}, n_shingles bigint, set_key binary, registers binary")


def _bands(reps: DataFrame) -> DataFrame:
    """A 64-bit key for each band of registers of each row."""
    bands = REGISTERS // BAND_ROWS
    factors = mixed(np.arange(1, BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    seeds = mixed(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32))

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                rows = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                values = rows[:, : bands * BAND_ROWS].reshape(len(rows), bands, BAND_ROWS).astype(np.uint64)
                keys = mixed((values * factors).sum(2, dtype=np.uint64) + seeds)
                yield pa.record_batch([pa.array(keys.ravel().view(np.int64)), part.column(0).take(pa.array(np.repeat(np.arange(len(rows)), bands)))], ["key", "id"])

    return reps.select("id", "registers").mapInArrow(keyed, f"key bigint, id {dict(reps.dtypes)['id']}")


def _centred(bands: DataFrame) -> DataFrame:
    """``key, a, b``: the members ``b`` of each bucket of more than one, and the member ``a`` all are compared with.

    That is the member whose buckets hold most texts in all, of equal ones the
    smallest identifier: among copies with changes of their own, the one closest
    to what they have in common, so that few members are left unlike it.
    """
    sizes = bands.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    members = stored(bands.join(sizes, "key"))
    crowd = members.groupBy("id").agg(F.sum("m").alias("crowd"))
    order = F.struct(-F.col("crowd"), F.col("id"))
    centres = members.select("key", "id").join(crowd, "id").groupBy("key").agg(F.min(order)["id"].alias("a"))
    return members.join(centres, "key").select("key", "a", F.col("id").alias("b"))


def _likely(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """``a, b, similarity`` of the pairs whose set sizes allow the threshold and whose estimate comes near it."""
    left = reps.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    right = reps.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    # compares whole numbers, so that rounding cannot drop a pair at the threshold
    sized = pairs.join(left, "a").join(right, "b").filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * round(threshold * 100))
    kind = dict(reps.dtypes)["id"]

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                x, y = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
                j = estimated(x, y, *(part.column(i).to_numpy().astype(float) for i in (2, 3)))
                keep = pa.array(j >= threshold - MARGIN)
                yield pa.record_batch([part.column(0).filter(keep), part.column(1).filter(keep), pa.array(j).filter(keep)], ["a", "b", "similarity"])

    return sized.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(judged, f"a {kind}, b {kind}, similarity double")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    both = pairs.select("a", "b").join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")
    percent = round(threshold * 100)
    kind = dict(pairs.dtypes)["a"]

    def checked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return both.mapInArrow(checked, f"a {kind}, b {kind}")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, members``: full shingle sets of the wanted documents, as bytes.

    Up to ``SENT_IDS`` identifiers are sent to the texts; only beyond that do texts move.
    """
    wanted = stored(wanted.select("id").distinct())
    if wanted.count() <= SENT_IDS:
        wanted = F.broadcast(wanted)

    def full(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.record_batch([part.column(0), pa.array([shingle_set(t, known, width).tobytes() for t in part.column(1).to_pylist()], pa.binary())], ["id", "members"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = source.join(wanted, "id", "left_semi").mapInArrow(full, f"id {dict(docs.dtypes)[id_col]}, members binary")
    return found.dropDuplicates(["id"])


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are not known to be connected."""
    left, right = found.toDF("a", "c_a"), found.toDF("b", "c_b")
    labelled = pairs.select("a", "b").join(left, "a", "left").join(right, "b", "left")
    return labelled.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def _split_buckets(members: DataFrame, found: DataFrame) -> DataFrame:
    """``key, id, c``: the members of buckets that hold more than one component."""
    labelled = members.join(found, members["id"] == found["node"], "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    several = labelled.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low < high").select("key")
    return labelled.join(several, "key", "left_semi")


def _sharing_prefix(sets: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """``a, b`` of all pairs in different components (``labels``: ``id, c``) that can reach the threshold.

    The members of a set are put in one order for all sets, seldom ones first.
    Sets that are similar enough share a member within short prefixes of that
    order: the smaller set within its first n - 2tn / (1 + t) + 1, the larger
    within its first n - tn + 1. The first member they share also leaves room for
    the overlap they need: it cannot lie further behind in either set. So texts
    that differ in parts of their own, be they ever so many copies of one text, do
    not meet.
    """
    percent = round(threshold * 100)
    kind = dict(sets.dtypes)["id"]

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column(0):
                yield pa.record_batch([pa.array(np.frombuffer(members.as_buffer(), np.int64))], ["key"])

    repeated = sets.select("members").mapInArrow(keys, "key bigint").groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = stored(repeated)
    # filters pass a few other keys, the same ones for all sets, so the order stays one order
    levels = [key_filter(repeated.filter(F.col("n") > often).select("key")) for often in OFTEN]

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [KeyFilter(level.value) for level in levels]
        for batch in batches:
            ids, labels = batch.column(0), batch.column(2)
            for i, members in enumerate(batch.column(1)):
                own = np.frombuffer(members.as_buffer(), np.uint64)
                level = sum(k.passes(own).astype(np.int64) for k in known)
                n, order = len(own), np.lexsort((own, level))
                probe, index = (n - -(-p * n // q) + 1 for p, q in ((percent, 100), (2 * percent, 100 + percent)))
                place = np.flatnonzero(level[order[:probe]])  # a member of one set only meets nothing
                at = pa.array(np.full(len(place), i))
                columns = [pa.array(own[order[place]].view(np.int64)), ids.take(at), labels.take(at), pa.array(np.full(len(place), n, np.int64)), pa.array(place), pa.array(place < index)]
                yield pa.record_batch(columns, ["key", "id", "c", "n", "place", "indexed"])

    rows = stored(sets.join(labels, "id").select("id", "members", "c").mapInArrow(prefixes, f"key bigint, id {kind}, c {kind}, n bigint, place bigint, indexed boolean"))
    smaller = rows.filter("indexed").select("key", F.col("id").alias("t"), F.col("c").alias("t_c"), F.col("n").alias("t_n"), F.col("place").alias("t_place"))
    fits = (F.col("t_n") <= F.col("n")) & (F.col("t_n") * 100 >= F.col("n") * percent) & (F.col("c") != F.col("t_c"))
    # the overlap a pair needs is t / (1 + t) of both sizes together
    fits &= (F.col("n") + F.col("t_n")) * percent <= F.least(F.col("n") - F.col("place"), F.col("t_n") - F.col("t_place")) * (100 + percent)
    pairs = rows.join(smaller, (rows["key"] == smaller["key"]) & fits)
    return pairs.select(F.least("t", "id").alias("a"), F.greatest("t", "id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked if the Jaccard similarity of their sets of distinct
    ``width``-word shingles reaches ``threshold`` (in whole hundredths);
    ``component_id`` is the smallest identifier reachable, ``kept`` marks it.

    Rows with equal sets meet by a hash of the set and go on as one. The others
    meet where a band of registers agrees; a pair at 0.8 misses all bands with
    probability below 3e-6, at 0.85 below 3e-9. A bucket is not expanded into
    all its pairs: members pair with one of them, candidates pass the joint
    estimate, and full sets decide. Members of a bucket that are then still in
    different components meet by shared members of short prefixes of their sets,
    which misses no pair and spares those that are not similar enough.

    Null or empty texts have no shingles and are linked with nothing. A row with a
    null identifier keeps its null ``component_id`` and is not kept; rows that
    repeat an identifier share its component (give such rows one text). An empty
    table gives an empty result.
    """
    marked = stored(sketches(docs, id_col, text_col, width))
    linked = marked.filter("doc_id is not null and n_shingles > 0")
    groups = stored(linked.groupBy("set_key").agg(F.min("doc_id").alias("id")))
    smallest = linked.select("set_key", F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "registers").join(groups, ["set_key", "id"], "left_semi")
    reps = stored(smallest.select("id", "n", "registers").dropDuplicates(["id"]))

    rows = stored(_centred(_bands(reps)))
    tried = stored(_likely(rows.filter("a <> b").select("a", "b").distinct(), reps, threshold))
    sets = stored(_sets(docs, _ends(tried), id_col, text_col, width))
    best = tried.groupBy("b").agg(F.max_by("a", F.struct("similarity", "a")).alias("a")).select("a", "b")
    links = stored(_verified(best, sets, threshold))
    found = components(links)
    more = stored(_verified(_across(tried.join(best, ["a", "b"], "left_anti"), found), sets, threshold))
    if not more.isEmpty():
        links = stored(links.unionByName(more))
        found = components(links)
    # members of a bucket that are unlike its centre may still be like each other
    active = stored(_split_buckets(rows.select("key", F.col("b").alias("id")), found).select("id", "c").distinct())
    sets = stored(_sets(docs, active, id_col, text_col, width))
    pairs = _sharing_prefix(sets, active, threshold).join(tried.select("a", "b"), ["a", "b"], "left_anti")
    more = stored(_verified(_likely(pairs, reps, threshold), sets, threshold))
    if not more.isEmpty():
        found = components(links.unionByName(more))
    of_set = groups.join(found, groups["id"] == found["node"], "left").select("set_key", F.coalesce("component", "id").alias("_component"))
    keyed = F.when(F.col("n_shingles") > 0, F.col("set_key"))
    every = marked.select("doc_id", "n_shingles", keyed.alias("set_key")).join(of_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return every.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
