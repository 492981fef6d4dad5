"""Toxicity of texts after undoing disguises by a noisy-channel decoder."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import pieces_of, rows, stored

#: What a sign may stand for, besides itself.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "¢": "c",
}
#: Letters of other scripts that look like these.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y",
    "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g",
}
#: Costs (negative log-probabilities) of the channel.
KEEP_SIGN, DROP_SIGN, SUBSTITUTE, COLLAPSE, JOIN_LETTERS = 6.0, 1.0, 1.0, 0.7, 0.5
#: A letter's smallest probability, and with it the most that the next two letters can differ by in cost.
LEAST = 0.05 / 60
REACH = -2 * math.log(LEAST)
BITS = 17
PREFIXES = (4, 5, 6)
#: Features that may pass the likelihood ratio test by chance, of all tested; and labelled rows used at most.
BY_CHANCE = 1.0
LABELLED_ROWS = 40_000
REMEMBERED = 300_000
HELD_FEATURES = 200_000
CHUNK_BYTES = 1_000_000

_SIGNS = set(LEET) | set(".-_*'`~^#%&/\\:,;=?")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’…¿"
#: Edge signs that stand for no letter.
_OUTER = "".join(c for c in _EDGE if c not in LEET)
_LATTICE = re.compile(rf"([^\W\d_])\1|[{''.join(LOOKALIKES)}]")
_SPACED = re.compile(r"(?<!\S)(?:\S\s+){2,}\S[.,;:!?]*(?!\S)")


def _trigrams(codes: np.ndarray) -> np.ndarray:
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    return (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)


def _bigrams(codes: np.ndarray) -> np.ndarray:
    return (codes[:-1] * np.uint32(0x85EBCA77) + codes[1:] * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)


def _marks(codes: np.ndarray) -> np.ndarray:
    """Where the count of a letter as the first of a pair is kept."""
    return (codes * np.uint32(0x85EBCA77) + np.uint32(0xFFFFFF * 0xC2B2AE3D % 2**32)) >> np.uint32(32 - BITS)


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, np.uint32)
    known = [c for c in range(0x110000) if chr(c).isalpha()]
    table[known] = known
    return table


@dataclass
class CharacterModel:
    """Log-probability of a letter (0: end of a word) after two others, from hashed counts."""

    triples: np.ndarray
    pairs: np.ndarray
    known: dict[str, float] = field(default_factory=dict)

    def cost(self, gram: str) -> float:
        """Negative log-probability of the last of three letters after the first two; a space is a word's edge."""
        value = self.known.get(gram)
        if value is None:
            codes = np.array([0 if x == " " else ord(x) for x in gram], np.uint32)
            three, two = self.triples[_trigrams(codes)[0]], self.pairs[_bigrams(codes)]
            one = self.pairs[_marks(codes[1:2])[0]]
            p = 0.7 * three / max(two[0], 1) + 0.25 * two[1] / max(one, 1) + LEAST
            value = self.known[gram] = -math.log(min(p, 1.0))
        return value


def learn_characters(docs: DataFrame, text_col: str = "text") -> CharacterModel:
    """Counts of letter triples and pairs over whole texts; each task sums tables of fixed size before the shuffle."""

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        sums = np.zeros((2, 1 << BITS), np.int64)
        for part in pieces_of(batches, "text", CHUNK_BYTES):
            text = "\n".join(t for t in part.column(0).to_pylist() if t)  # an edge between texts
            codes = letters[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
            codes = np.concatenate(([0], codes, [0])).astype(np.uint32)
            codes = np.repeat(codes, np.where(codes == 0, 2, 1))  # a word begins after two edges
            inside = (codes[2:] > 0) | (codes[1:-1] > 0)
            pairs = (codes[:-1] > 0) | (codes[1:] > 0)
            begins = (codes[:-2] == 0) & (codes[1:-1] == 0) & (codes[2:] > 0)  # what first letters come after
            two = _bigrams(codes)
            for k, x in enumerate((_trigrams(codes)[inside], np.concatenate((two[pairs], two[:-1][begins], _marks(codes[:-1][pairs]))))):
                sums[k] += np.bincount(x, minlength=1 << BITS)
        kind, gram = np.nonzero(sums)
        yield pa.record_batch([pa.array(kind.astype(np.int32)), pa.array(gram.astype(np.int32)), pa.array(sums[kind, gram])], ["kind", "gram", "n"])

    source = docs.select(F.col(text_col).cast("string").alias("text"))
    found = source.mapInArrow(counts, "kind int, gram int, n bigint").groupBy("kind", "gram").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros((2, 1 << BITS), np.int64)
    np.add.at(sums, (found.column("kind").to_numpy(), found.column("gram").to_numpy()), found.column("n").to_numpy())
    return CharacterModel(sums[0], sums[1])


def restored(token: str, model: CharacterModel) -> str:
    """Likeliest letters behind a disguised token, by Viterbi search over its character lattice.

    Every character may stand for itself, a sign also for the letters it looks like
    or for nothing, a letter also for the one it looks like in another script, and a
    character that repeats the one before for nothing. White
    space either joins what it separates or ends a word, as the character model finds
    likelier; words come back with a space between them. A state is the last two
    letters restored. A state is left out only if it costs more than the best by what
    the next two letters can differ by, as no path through it can win then.
    """
    states: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
    before, known, cost_of = "", model.known, model.cost
    for c in token:
        following: dict[str, tuple[float, tuple | None]] = {}
        gap = c.isspace()
        if gap:
            emitted, dropped = ((" ", 0.0),), JOIN_LETTERS
        elif c.isalpha():
            emitted = ((c, 0.0), (LOOKALIKES[c], SUBSTITUTE)) if c in LOOKALIKES else ((c, 0.0),)
            dropped = None
        else:
            emitted = tuple((x, SUBSTITUTE) for x in LEET.get(c, ""))
            dropped = DROP_SIGN if c in _SIGNS else KEEP_SIGN
        if before == c:
            dropped = COLLAPSE if dropped is None else min(dropped, COLLAPSE)
        for last, (cost, text) in states.items():
            for letter, price in emitted:
                if gap and last == "  ":
                    continue
                gram = last + letter
                total = known.get(gram)
                total = cost + price + (cost_of(gram) if total is None else total)
                state = "  " if gap else gram[1:]
                old = following.get(state)
                if old is None or total < old[0]:
                    following[state] = (total, (text, letter))
            if dropped is not None:
                total = cost + dropped
                old = following.get(last)
                if old is None or total < old[0]:
                    following[last] = (total, text)
        if len(following) > 8:
            limit = min(x[0] for x in following.values()) + REACH
            following = {state: x for state, x in following.items() if x[0] <= limit}
        states = following
        before = before if gap else c
    end = min((cost + (cost_of(last + " ") if last != "  " or text is None else 0.0), last) for last, (cost, text) in states.items())[1]
    text, letters = states[end][1], []
    while text:
        text, letter = text
        letters.append(letter)
    return "".join(reversed(letters)).strip()


class Words(dict):
    """Features of each token: its restored word and the word's first letters; remembered, bounded."""

    def __init__(self, model: CharacterModel, wanted: set[str] | None = None):
        self.model, self.wanted = model, wanted
        whole = [f for f in wanted or () if ":" not in f]
        self.whole = set(whole)
        self.starts = {f.split(":", 1)[1]: f for f in wanted or () if f[:2] in _PREFIX_MARKS and len(f) == 2 + int(f[0])}
        #: What a wanted word may begin with when white space breaks it.
        self.lefts = {f[:n] for f in whole for n in range(1, len(f))}

    def word(self, token: str) -> str:
        token = token.strip(_OUTER) or token
        if token.isalpha() and not _LATTICE.search(token):
            return token
        if not any(c.isalpha() or c in LEET for c in token):
            return ""
        # signs and repeated letters also stand in plain words, so the word as it stands counts too
        return restored(token, self.model)

    def named(self, word: str) -> tuple[str, ...]:
        """Features of a restored word, if any are wanted of these only."""
        if self.wanted is None:
            return (word, *(f"{n}:{word[:n]}" for n in PREFIXES if len(word) >= n)) if word else ()
        get = self.starts.get
        found = {f for n in PREFIXES if (f := get(word[:n]))}
        if word in self.wanted:
            found.add(word)
        return tuple(found)

    def __missing__(self, token: str) -> tuple[str, ...]:
        word, plain = self.word(token), token.strip(_EDGE)
        found = self.named(word)
        if plain != word:
            found = tuple({*found, *self.named(plain)})
        if len(self) < REMEMBERED:
            self[token] = found
        return found

    def piece(self, token: str) -> str:
        plain = token.strip(_EDGE)
        return plain if plain.isalpha() else self.word(token)

    def broken(self, tokens: list[str], begins: set[str]) -> Iterator[str]:
        """Wanted words that white space breaks into pieces, where the lattice joins them; ``begins`` are the first pieces."""
        for i, token in enumerate(tokens):
            if token not in begins:
                continue
            joined, past, pieces = token, i + 1, [token]
            while joined in self.lefts and past < len(tokens):
                pieces.append(self.piece(tokens[past]))
                joined += pieces[-1]
                past += 1
                if joined in self.whole and joined in restored(" ".join(pieces), self.model).split():
                    yield joined

    def features(self, text: str | None) -> set[str]:
        if not text:
            return set()
        lower = text.lower()
        out: set[str] = set()
        for m in _SPACED.finditer(lower):
            run = " ".join(m.group().rstrip(".,;:?").split())
            out.update(*map(self.__getitem__, restored(run, self.model).split()))
        tokens = lower.split()
        different = set(tokens)
        out.update(*filter(None, map(self.__getitem__, different)))
        if begins := self.lefts & different:
            for word in self.broken(tokens, begins):
                out.update(self.named(word))
        return out


_PREFIX_MARKS = {f"{n}:" for n in PREFIXES}


@dataclass
class Model:
    characters: CharacterModel
    weights: dict[str, float]
    slope: float
    base: float

    def score(self, found: set[str]) -> float:
        x = sum(self.weights[f] for f in found)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.base + self.slope * x))))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", labelled_rows: int = LABELLED_ROWS) -> Model:
    """Character model of all texts, and a classifier of restored words from labelled rows.

    ``labels``: ``id_col, label_col`` (0 or 1; of several the larger counts, nulls do
    not). At most ``labelled_rows`` labelled identifiers are used, those with the
    smallest hashes. A feature is a word or its first letters; it counts if it is
    more frequent in toxic documents by a likelihood ratio test that allows for the
    number of features tested. A logistic curve over
    the sum of weights, fitted on the same rows, gives the score. Without labels of
    both kinds every score is one half.
    """
    characters = learn_characters(docs, text_col)
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).filter("_id is not null and _label in (0, 1)")
    used = stored(marked.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(labelled_rows))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(used), "_id")
    shared = spark.sparkContext.broadcast((characters.triples, characters.pairs))
    texts = texts.select("text", F.col("_label").alias("label"))
    kinds = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not clean:
        return Model(characters, {}, 0.0, 0.0)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(CharacterModel(*shared.value))
        held: dict[str, list[int]] = {}

        def sent() -> pa.RecordBatch:
            t, n = zip(*held.values(), strict=True)
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(t, pa.int64()), pa.array(n, pa.int64())], ["feature", "t", "n"])

        for found, labels in rows(batches, "text", "label"):
            for text, label in zip(found, labels, strict=True):
                for feature in known.features(text):
                    pair = held.setdefault(feature, [0, 0])
                    pair[0] += label
                    pair[1] += 1
                if len(held) > HELD_FEATURES:
                    yield sent()
                    held.clear()
        if held:
            yield sent()

    each = texts.mapInArrow(counted, "feature string, t bigint, n bigint").groupBy("feature")
    each = each.agg(F.sum("t").cast("double").alias("t"), F.sum("n").cast("double").alias("n"))
    tested = stored(each.filter("t >= 2"))
    rate = toxic / (toxic + clean)
    evidence = 2 * math.log(max(tested.count(), 1) / BY_CHANCE + 1)
    # clean vocabulary does not pass and stays on the executors
    likely = tested.filter((F.col("t") / F.col("n") > rate) & (_ratio(F.col("t"), F.col("n"), rate) >= evidence))
    weights = {
        r["feature"]: math.log((r["t"] + 0.5) / (toxic + 1)) - math.log((r["n"] - r["t"] + 0.5) / (clean + 1))
        for r in likely.orderBy("feature").collect()
    }

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(CharacterModel(*shared.value), set(weights))
        for found, labels in rows(batches, "text", "label"):
            x = [sum(weights[f] for f in known.features(text)) for text in found]
            yield pa.record_batch([pa.array(labels, pa.int32()), pa.array(x, pa.float64())], ["label", "x"])

    sums = texts.mapInArrow(summed, "label int, x double").toArrow()
    slope, base = _logistic(sums.column("x").to_numpy(), sums.column("label").to_numpy())
    return Model(characters, weights, slope, base)


def _ratio(t: Column, n: Column, rate: float) -> Column:
    """Likelihood ratio statistic of ``t`` toxic documents among ``n``, against the overall rate."""
    def part(k: Column, expected: Column) -> Column:
        return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)

    return 2 * (part(t, n * rate) + part(n - t, n * (1 - rate)))


def _logistic(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and base of a logistic curve, by Newton steps with a small penalty on the slope."""
    slope, base = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(base + slope * x, -500, 500)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((label - p) * x).sum() - slope, (label - p).sum()])
        hessian = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(hessian, gradient)
        slope, base = slope + step[0], base + step[1]
        if abs(step).max() < 1e-8:
            break
    return float(slope), float(base)


def score(docs: DataFrame, model: Model, keep: list[str | Column], text_col: str = "text") -> DataFrame:
    """Columns of ``keep`` and ``score`` (0 to 1), ``predicted`` (1 from one half on) and ``evidence`` (features found) of each whole text.

    Null and empty texts get the score of a text without evidence; rows stay as they are, repeated ones too.
    """
    parts = model.characters.triples, model.characters.pairs, model.weights, model.slope, model.base
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples, pairs, *rest = shared.value
        own = Model(CharacterModel(triples, pairs), *rest)
        known = Words(own.characters, set(own.weights))
        for batch in batches:
            found = [known.features(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            scores = [own.score(f) for f in found]
            new = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([sorted(f) for f in found], pa.list_(pa.string()))]
            yield pa.record_batch([*batch.columns[:-1], *new], [*batch.schema.names[:-1], "score", "predicted", "evidence"])

    source = docs.select(*keep, docs[text_col].cast("string").alias("_text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    return source.mapInArrow(scored, f"{fields}score double, predicted int, evidence array<string>")
