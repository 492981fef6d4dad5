"""Language proportions of documents by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import rows

UNDETERMINED = "und"
BITS = 17
ROUNDS = 12
PENALTY = 3.0


class Grams:
    """Letter trigrams of a text as numbers below ``2 ** BITS``; other characters count as one boundary."""

    def __init__(self) -> None:
        self.letters = np.zeros(sys.maxunicode + 1, np.uint32)
        known = [c for c in range(sys.maxunicode + 1) if chr(c).isalpha()]
        self.letters[known] = known

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams and how often each occurs; none without a letter."""
        codes = self.letters[np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not codes.any():
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        codes = np.concatenate(([0], codes, [0])).astype(np.uint32)
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        grams = (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)
        return np.unique(grams[b > 0], return_counts=True)


@dataclass
class Model:
    """Probability of each trigram number by language; the last column is an even spread, for other languages."""

    languages: list[str]
    table: np.ndarray


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram probabilities of each language over the whole texts of ``docs``.

    Counts are summed inside each task, then by a shuffle; what reaches the driver
    is one number per language and trigram number, so ``2 ** BITS`` per language.
    Rows with a null language or without letters teach nothing.
    """

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = Grams(), {}
        for texts, langs in rows(batches, "text", "lang"):
            for text, lang in zip(texts, langs, strict=True):
                found, n = grams.count(text)
                if lang not in sums:
                    sums[lang] = np.zeros(1 << BITS, np.int64)
                sums[lang][found] += n
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "gram", "n"])

    source = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null")
    found = source.mapInArrow(counts, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs, grams, n = (found.column(c) for c in ("lang", "gram", "n"))
    names = sorted(set(langs.to_pylist()))
    table = np.full((1 << BITS, len(names) + 1), 0.5)
    place = {name: i for i, name in enumerate(names)}
    np.add.at(table, (grams.to_numpy(), [place[x] for x in langs.to_pylist()]), n.to_numpy())
    return Model(names, table / table.sum(0))


def mixture(p: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``p`` and the log-likelihood of counts ``n``."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    total = n.sum()
    for _ in range(rounds):
        each = p @ share
        share = share * ((n / each) @ p) / total
    return share, float(n @ np.log(p @ share))


def choose(p: np.ndarray, n: np.ndarray, penalty: float = PENALTY) -> dict[int, float]:
    """Proportions by column, over the set of columns with the best penalised log-likelihood.

    Every column of the set costs ``penalty`` times half the logarithm of the
    number of trigrams. The best single column stands unless the whole mixture,
    which no smaller set can beat, gains more than one column costs; else
    columns leave one by one, the smallest first, as long as that pays.
    """
    cost = penalty * np.log(n.sum() + 1) / 2
    single = n @ np.log(p)
    best = int(np.argmax(single))
    share, fit = mixture(p, n)
    if fit - single[best] <= cost:
        return {best: 1.0}
    kept = list(range(p.shape[1]))
    while len(kept) > 1:
        out = int(np.argmin(share))
        fewer = kept[:out] + kept[out + 1 :]
        shares, value = mixture(p[:, fewer], n)
        if fit - value > cost:
            break
        kept, share, fit = fewer, shares, value
    if single[best] >= fit - cost * (len(kept) - 1):
        return {best: 1.0}
    return dict(zip(kept, (share / share.sum()).tolist(), strict=True))


def identify(docs: DataFrame, model: Model, keep: list[str | Column] | None = None, text_col: str = "text") -> DataFrame:
    """Adds the languages of each whole text to the columns of ``keep`` (all if none).

    ``lang_pred``: the language with the largest share, ``und`` for a null text, one
    without a letter, or if no language was learned. ``score``: its share, 0 for ``und``.
    ``languages``: map of all languages chosen to their shares. ``other``: share of
    trigrams better explained by no learned language. The model is sent to the
    tasks once; its size is fixed by ``BITS`` and the number of languages. Names of
    these columns in ``docs`` are replaced; rows are kept as they are, repeated ones too.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.table))

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, (names, table) = Grams(), shared.value
        for batch in batches:
            pred, score, langs, other = [], [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                found, n = grams.count(text)
                shares = choose(table[found], n) if len(found) and names else {}
                known = {names[i]: x for i, x in shares.items() if i < len(names)}
                top = max(known, key=lambda x: (known[x], x), default=None)
                if top is None and shares:
                    top = names[int(np.argmax(n @ np.log(table[found][:, :-1])))]
                pred.append(top or UNDETERMINED)
                score.append(min(1.0, known.get(top, 0.0)))
                langs.append(list(known.items()))
                other.append(shares.get(len(names), 0.0) if shares else 1.0)
            new = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(langs, pa.map_(pa.string(), pa.float64())), pa.array(other, pa.float64())]
            yield pa.record_batch([*batch.columns[:-1], *new], [*batch.schema.names[:-1], "lang_pred", "score", "languages", "other"])

    new = ["lang_pred", "score", "languages", "other"]
    source = docs.select(*(keep if keep is not None else [docs[c] for c in docs.columns if c not in new]), docs[text_col].cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(label, f"{fields}{', ' if fields else ''}lang_pred string, score double, languages map<string,double>, other double")
