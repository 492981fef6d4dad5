"""Runs of repeated words in a text, by string synchronising sets at dyadic scales.

Texts are sequences of words, told apart exactly by numbers. At scale ``s`` (1, 2, 4, ...)
every stretch of ``s`` words has a name, built from the names of its two halves. The
synchronising set holds a place if, among the stretches that start at it and up to ``s``
words behind it, the smallest hash of a name is the first or the last one; stretches
inside a region whose period is at most ``s / 4`` do not count. Whether a place belongs to
the set depends on the ``2 s`` words from it on only. A run with a period ``q`` from ``s`` up
to ``2 s`` and at least four periods has a place of the set among its first ``s`` ones, and
the next place with the same ``2 s`` words lies exactly ``q`` behind it. So neighbouring
places with equal words propose all such periods; each proposal is extended both ways word
by word. Regions found at smaller scales are the ones left out at the larger scales: they
supply the small periods there. The work is about linear in the words per scale, and only
texts of at least ``4 s`` words take part in scale ``s``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import mixed, pieces_of

MIN_EXPONENT = 4
MIN_LENGTH = 6
#: Bytes of text worked on at once.
CHUNK_BYTES = 2_000_000


class _Numbers(dict):
    """A number for each distinct word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _windows_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _extended(words: np.ndarray, at: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around ``at`` inside ``low`` to ``high`` in which words ``q`` apart are equal."""
    start, end, step = at, at + q, 64
    while end < high:
        part = words[end : min(high, end + step)]
        differ = np.flatnonzero(part != words[end - q : end - q + len(part)])
        if len(differ):
            end += int(differ[0])
            break
        end, step = end + len(part), step * 2
    step = 64
    while start > low:
        part = words[max(low, start - step) : start]
        differ = np.flatnonzero(part != words[start - len(part) + q : start + q])
        if len(differ):
            start -= len(part) - 1 - int(differ[-1])
            break
        start, step = start - len(part), step * 2
    return start, end


def runs_of(words: np.ndarray, ends: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) by text, for texts that end at ``ends`` in one sequence of word numbers.

    All maximal stretches with at least ``MIN_EXPONENT`` of their smallest period,
    starts counted inside the text, in order of start, then period.
    """
    sizes = np.diff(np.concatenate(([0], ends)))
    found: dict[tuple[int, int], tuple[int, int]] = {}  # (start, end) -> (smallest period, text)
    use = np.flatnonzero(sizes >= MIN_EXPONENT)
    scale, names = 1, None
    while len(use):
        # the texts that are long enough, one behind the other
        begins, lengths = ends[use] - sizes[use], sizes[use]
        offset = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) + np.repeat(begins - offset, lengths)
        left = np.repeat(offset + lengths, lengths) - np.arange(len(place))  # words to the text's end
        if scale == 1:
            names = words[place]
            full = words.copy()
        else:  # names of stretches from those of their halves; stretches over an end get a name, but no part
            kept = full[place]
            half = scale // 2
            other = np.concatenate((kept[half:], np.full(min(half, len(kept)), -1)))
            names = pd.factorize(kept * (int(full.max()) + 2) + other + 1)[0]
            full = np.full(len(words), -1)
            full[place] = names
        hashes = mixed(names.astype(np.uint64) + np.uint64(scale))
        hashes[left < scale] = np.iinfo(np.uint64).max
        taken = np.zeros(len(place) + 1, np.int64)
        slot = {int(b): int(o) for b, o in zip(begins, offset, strict=True)} if found else {}
        for (start, end), (q, text) in found.items():
            if 4 * q <= scale <= end - start and sizes[text] >= MIN_EXPONENT * scale:
                first = start - int(ends[text] - sizes[text]) + slot[int(ends[text] - sizes[text])]
                taken[first] += 1
                taken[first + end - start - scale + 1] -= 1
        counts = np.cumsum(taken[:-1]) == 0
        hashes[~counts] = np.iinfo(np.uint64).max
        n = len(place) - scale
        if n > 0:
            least = _windows_min(hashes, scale + 1)
            first, last = hashes[:n], hashes[scale:]
            sync = np.flatnonzero(((first == least) & counts[:n] | (last == least) & counts[scale:]) & (left[:n] >= 2 * scale))
            # neighbouring places with the same 2 * scale words, in one text
            context = names[sync] * np.int64(int(names.max(initial=0)) + 1) + names[sync + scale]
            order = np.argsort(context, kind="stable")
            a, b = sync[order[:-1]], sync[order[1:]]
            near = (context[order[:-1]] == context[order[1:]]) & (b - a >= scale) & (b - a < 2 * scale) & (b - a < left[a])
            a, q = place[a[near]], (b - a)[near]
            reached: dict[int, int] = {}
            by_place = np.lexsort((a, q))
            for at, period in zip(a[by_place].tolist(), q[by_place].tolist(), strict=True):
                if at + period <= reached.get(period, -1):
                    continue
                text = int(np.searchsorted(ends, at, side="right"))
                start, end = _extended(words, at, period, int(ends[text] - sizes[text]), int(ends[text]))
                reached[period] = end
                if end - start >= MIN_EXPONENT * period and (start, end) not in found:
                    found[start, end] = (period, text)
        scale *= 2
        use = use[sizes[use] >= MIN_EXPONENT * scale]
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (start, end), (q, text) in found.items():
        out.setdefault(text, []).append((start - int(ends[text] - sizes[text]), end - start, q))
    return {text: sorted(runs, key=lambda r: (r[0], r[2])) for text, runs in out.items()}


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, n_words, runs, strongest, collapsed`` of every row.

    Words are what ASCII white space separates, as they stand. ``runs`` holds every
    stretch (``start``, ``length``, ``period``, in words from 0) of at least ``min_length``
    words and four times its smallest period that no neighbouring word continues, by
    start, then period. ``strongest`` is the one with the greatest length in
    periods, the first by start, then period, of equal ones; null without a run.
    ``collapsed`` joins by one space the words that remain when each run keeps its
    first period only; a word goes if any run drops it. A null text has no words;
    nulls as identifier and repeated rows stay as they are. A single text has to
    fit a task, with some 100 bytes for each of its words.
    """
    fields = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
    run_type = pa.struct(fields)

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", CHUNK_BYTES):
            split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in batch.column(1).to_pylist()]
            sizes = np.array([len(x) for x in split], np.int64)
            numbers = _Numbers()
            words = np.fromiter((numbers[w] for x in split for w in x), np.int64, int(sizes.sum()))
            found = runs_of(words, np.cumsum(sizes))
            runs, strongest, collapsed = [], [], []
            for i, own in enumerate(split):
                here = [r for r in found.get(i, ()) if r[1] >= min_length]
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in here])
                best = None
                for r in here:  # exact: lengths times the other one's period
                    if best is None or r[1] * best[2] > best[1] * r[2]:
                        best = r
                strongest.append(best and dict(zip(("start", "length", "period"), best, strict=True)))
                if here:
                    gone = np.zeros(len(own) + 1, np.int64)
                    for start, length, period in here:
                        gone[start + period] += 1
                        gone[start + length] -= 1
                    own = [own[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                collapsed.append(b" ".join(own).decode("utf-8", "surrogatepass"))
            columns = [batch.column(0), pa.array(sizes), pa.array(runs, pa.list_(run_type)), pa.array(strongest, run_type), pa.array(collapsed, pa.string())]
            yield pa.record_batch(columns, ["doc_id", "n_words", "runs", "strongest", "collapsed"])

    run = "struct<start:bigint,length:bigint,period:bigint>"
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(searched, f"doc_id {dict(docs.dtypes)[id_col]}, n_words bigint, runs array<{run}>, strongest {run}, collapsed string")
