"""Secrets in texts: fixed patterns, and strings that look random to character Markov models."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import rows

#: Patterns of known kinds, in this order, and the shortest match that counts.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS = 6
ACCESS_CHARS = 20
RANDOM = "random"

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
#: Natural logarithm of how much likelier a string must be under the random model.
MIN_RATIO = 14.0
#: Share of ordinary identifiers' pairs that the corpus need not show.
UNSEEN = 0.05
#: Weight of a symbol's frequency by itself, as a number of pairs with the symbol before.
BACKOFF = 5.0
_HINTS = ("passw", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, place of the kind, kind, end, start of the value) of all pattern matches, in order."""
    found, lower = [], text.lower()
    if any(h in lower for h in _HINTS):
        found += [(m.start(), 0, "assign", m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(m.start(), 2, "hex", m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def _numbers(text: str) -> np.ndarray:
    """Number of the symbol at each code point, 0 for others; a dot is a symbol between two others only."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _PLACE[np.minimum(codes, len(_PLACE) - 1)]
    dots = np.flatnonzero(out == _DOT)
    if len(dots):
        inner = np.zeros(len(dots), bool)
        both = dots[(dots > 0) & (dots < len(out) - 1)]
        inner[(dots > 0) & (dots < len(out) - 1)] = (out[both - 1] % _DOT > 0) & (out[both + 1] % _DOT > 0)
        out[dots[~inner]] = 0
    return out


_PLACE = np.zeros(129, np.uint8)
_PLACE[[ord(c) for c in SYMBOLS]] = np.arange(1, len(SYMBOLS) + 1)
_SIZE = len(SYMBOLS) + 1
_DOT = len(SYMBOLS)


@dataclass
class Markov:
    """Log-likelihood ratio (random over ordinary) of each pair of symbols; 0 stands for an end."""

    ratio: np.ndarray

    def runs(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and log-likelihood ratio of every run of symbols."""
        codes = np.concatenate(([0], _numbers(text), [0]))
        inside = codes > 0
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        sums = np.add.reduceat(self.ratio[codes[:-1], codes[1:]], starts) if len(starts) else np.zeros(0)
        return starts, ends, sums


def all_spans(text: str, model: Markov, min_ratio: float) -> list[tuple[int, int, str, int, int]]:
    """Pattern matches and the strings the models add, in order of start, then kind."""
    found = base_spans(text)
    base = [(s, e) for s, _, _, e, _ in found]
    starts, ends, sums = model.runs(text)
    likely = np.flatnonzero(sums >= min_ratio)
    for a, b in zip(starts[likely].tolist(), ends[likely].tolist(), strict=True):
        if all(e <= a or b <= s for s, e in base):
            found.append((a, 3, RANDOM, b, a))
    return sorted(found)


def learn(docs: DataFrame, text_col: str = "text") -> Markov:
    """Pair models of random strings and of ordinary identifiers, from the whole texts of ``docs``.

    The labels are the fixed patterns': values they match are samples of random
    strings, all other runs of symbols samples of ordinary identifiers. Each task
    sums its counts, so one table of fixed size per task is shuffled. The random
    model is mixed with an even spread over letters and digits, so that other
    alphabets of random strings are covered, the other with an even spread over all
    symbols, so that no single unseen pair decides; without any text nothing is likelier.
    """

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, _SIZE * _SIZE), np.int64)
        for (texts,) in rows(batches, "text"):
            for text in texts:
                if not text:
                    continue
                spans = base_spans(text)
                values = [text[v:end] for _, _, _, end, v in spans]
                if spans:
                    parts, at = [], 0
                    for start, _, _, end, _ in spans:
                        parts.append(text[at:start])
                        at = max(at, end)
                    text = " ".join((*parts, text[at:]))
                for k, x in enumerate((text, " ".join(values))):
                    codes = _numbers(x).astype(np.int32)
                    sums[k] += np.bincount(codes[:-1] * _SIZE + codes[1:], minlength=_SIZE * _SIZE) if len(codes) else 0
        label, pair = np.nonzero(sums)
        yield pa.record_batch([pa.array(label.astype(np.int32)), pa.array(pair.astype(np.int32)), pa.array(sums[label, pair])], ["label", "pair", "n"])

    source = docs.select(F.col(text_col).cast("string").alias("text"))
    found = source.mapInArrow(counts, "label int, pair int, n bigint").groupBy("label", "pair").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros((2, _SIZE * _SIZE))
    np.add.at(sums, (found.column("label").to_numpy(), found.column("pair").to_numpy()), found.column("n").to_numpy())
    sums = sums.reshape(2, _SIZE, _SIZE)
    sums[:, :, 0] = 0  # what follows a token is no evidence
    even = np.zeros(_SIZE)
    even[1:63] = 1 / 62
    even[63:] = 0.001
    even[1:] /= even[1:].sum()
    alone = sums[:, :, 1:].sum(1) + 1 / len(SYMBOLS)
    alone /= alone.sum(1, keepdims=True)
    ordinary, random = ((s[:, 1:] + BACKOFF * a) / (s[:, 1:].sum(1, keepdims=True) + BACKOFF) for s, a in zip(sums, alone, strict=True))
    ordinary = (1 - UNSEEN) * ordinary + UNSEEN / len(SYMBOLS)
    ratio = np.zeros((_SIZE, _SIZE))
    ratio[:, 1:] = np.log(0.5 * random + 0.5 * even[1:]) - np.log(ordinary)
    return Markov(ratio)


def find(docs: DataFrame, model: Markov, id_col: str = "doc_id", text_col: str = "text", min_ratio: float = MIN_RATIO) -> DataFrame:
    """Spans of secrets in each whole text: ``doc_id, spans`` (array of kind, start, end in code points).

    Pattern matches come as they are; every run of symbols that
    overlaps none of them and is likelier random by
    ``min_ratio`` is added as kind ``random``, whatever its length and symbols. Order: start, then kind. A null or
    empty text has no spans; null identifiers and repeated rows are kept as they are.
    """
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model.ratio)
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markov = Markov(shared.value)
        for batch in batches:
            found = (all_spans(text or "", markov, min_ratio) for text in batch.column(1).to_pylist())
            out = [[{"kind": k, "start": s, "end": e} for s, _, k, e, _ in x] for x in found]
            yield pa.record_batch([batch.column(0), pa.array(out, span_type)], ["doc_id", "spans"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(spans, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def masked(docs: DataFrame, model: Markov, text_col: str = "text", min_ratio: float = MIN_RATIO) -> DataFrame:
    """``docs`` with every span of a secret replaced by its kind in angle brackets; overlapping spans go as one.

    Columns and rows stay as they are; a null text stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.ratio)
    at = docs.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cleaned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markov = Markov(shared.value)
        for batch in batches:
            texts = [t if not t else _mask(t, all_spans(t, markov, min_ratio)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(cleaned, fields)


def _mask(text: str, spans: list[tuple[int, int, str, int, int]]) -> str:
    parts, at = [], 0
    for start, _, kind, end, _ in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join((*parts, text[at:]))
