"""Packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import json
import sys
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablefold.llm.common import give_back, pieces_of, rows, stored

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
RANK_ROWS = 5_000
#: Bytes of text taken out of an Arrow batch at once.
BATCH_BYTES = 4_000_000

#: How byte-level BPE vocabularies of this kind split a text, and the printable stand-ins of bytes.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space other than a space between two other characters or a line break between two others.
UNEVEN = ("  ", " \n", "\n ", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_names() -> dict[str, int]:
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder(dict):
    """Token ids of a text, as little-endian unsigned 32-bit integers.

    A piece of this vocabulary never reaches over a space that stands alone
    between other characters, so a text is cut before such spaces and words met
    before are remembered (bounded). Texts with other runs of white space are
    encoded whole; those that hold a special token's string go to the tokenizer
    library, which gives them its id.
    """

    limit = 400_000

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        names = byte_names()
        ranks = {bytes(names[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        words = tiktoken.Encoding("words", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.plain, self.piece = words.encode_ordinary, words._core_bpe.encode_single_piece
        self.ends = {c: _packed(self.plain(c)) for c in ".,;:!?"}

    @cached_property
    def whole(self) -> Tokenizer:
        """The tokenizer library, loaded for the first text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = _packed(self.piece((" " + word).encode()))
        elif word[-1:] in self.ends and word[:-1].isalpha():
            return self[word[:-1]] + self.ends[word[-1]]
        else:
            ids = _packed(self.plain(" " + word))
        if len(self) < self.limit:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return _packed(self.whole.encode(text, add_special_tokens=False).ids)
        if any(s in text for s in UNEVEN) or text.startswith(" ") or text.endswith(" "):
            return _packed(self.plain(text))
        words = text.split(" ")
        return _packed(self.plain(words[0])) + b"".join(map(self.__getitem__, words[1:]))


def _packed(ids: list[int]) -> bytes:
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None
) -> DataFrame:
    """Token ids of each document and an end id, cut where they exceed ``capacity``.

    Returns ``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit
    integers). Only longer documents are cut, into pieces of ``capacity``; what is
    left over is the first piece. A null or empty text is its end id alone; a null
    identifier and repeated rows are kept as they are.
    """
    path = path or tokenizer_path()
    kind = dict(docs.dtypes)[id_col]

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(path), end_id.to_bytes(4, "little")
        schema = None
        for batch in pieces_of(batches, "text", BATCH_BYTES):
            schema = pa.schema([("doc_id", batch.schema.field(0).type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
            out: list[tuple] = []
            size = 0
            for ids, texts in rows([batch], "doc_id", "text"):
                for doc, text in zip(ids, texts, strict=True):
                    data = encoder.encode(text or "") + end
                    n = len(data) // 4
                    first = n if n <= capacity else n % capacity or capacity
                    cuts = [0, *range(first, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        out.append((doc, k, a, b - a, data[4 * a : 4 * b]))
                    size += len(data)
                    if size > 8_000_000:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                        out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        encoder.clear()
        give_back()

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(pieces, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Places for ``counts`` pieces of each length: (length, first rank, past rank, first sequence, offset).

    Works on classes of sequences with equal contents, so its effort follows the
    number of lengths and not of documents. Lengths above a third of the capacity
    come first, from the longest on, each matched with the longest other one that
    fits; then shorter ones, from the longest on, go where the least room is left.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    third = capacity / 3
    classes: dict[int, list[list]] = defaultdict(list)  # room -> [contents, number of sequences]
    rooms: list[int] = []

    def add(contents: tuple[int, ...], n: int) -> None:
        room = capacity - sum(contents)
        if not classes[room]:
            insort(rooms, room)
        classes[room].append([contents, n])

    large = sorted(s for s in left if s > third)
    while large:
        s = large[-1]
        n = left[s]
        k = bisect_left(large, capacity - s + 1) - 1
        if k < 0:
            add((s,), n)
            large.pop()
        elif large[k] == s:
            if n > 1:
                add((s, s), n // 2)
            if n % 2:
                left[s] = 1
                if k:  # the odd one goes with the next shorter length
                    t = large[k - 1]
                    add((s, t), 1)
                    left[t] -= 1
                    if not left[t]:
                        large.pop(k - 1)
                else:
                    add((s,), 1)
            large.remove(s)
        else:
            t = large[k]
            m = min(n, left[t])
            add((s, t), m)
            left[s] -= m
            left[t] -= m
            if not left[t]:
                large.pop(k)
            if not left[s]:
                large.remove(s)
    for s in sorted((s for s in left if s <= third), reverse=True):
        n = left[s]
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                room, found = capacity, [(), -(-n // (capacity // s))]
            else:
                room = rooms[at]
                found = classes[room].pop()
                if not classes[room]:
                    rooms.pop(at)
            contents, m = found
            each = room // s
            full = min(m, n // each)
            if full:
                add(contents + (s,) * each, full)
                n -= full * each
            if full < m and n and n < each:
                add(contents + (s,) * n, 1)
                n, full = 0, full + 1
            if full < m and contents:
                add(contents, m - full)
    places, rank, sequence = [], defaultdict(int), 0
    for room in sorted(classes):
        for contents, m in classes[room]:
            offset = 0
            for s in contents:
                places.append((s, rank[s], rank[s] + m, sequence, offset))
                rank[s] += m
                offset += s
            sequence += m
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``doc_id, piece, length``.

    Only the number of pieces of each length (at most ``capacity`` rows) reaches
    the driver. Pieces of one length are interchangeable: each gets a rank by
    counting inside hashed slices, so that a length of very many copies is never
    sorted in one task, and the plan maps ranks to places. Lengths must lie in 1
    to ``capacity``; others raise. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(s is None or not 0 < s <= capacity for s in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    slices = max(1, sum(counts.values()) // rank_rows)
    places = spark.createDataFrame(
        plan_sequences(counts, capacity), "length bigint, first_rank bigint, past_rank bigint, first_sequence bigint, offset bigint"
    )
    sliced = pieces.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("length", "_slice").agg(F.count("*").alias("_n")).select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_slice").orderBy("doc_id", "piece")
    ranked = (
        sliced.withColumn("_row", F.row_number().over(inside)).join(offsets, ["length", "_slice"])
        .withColumn("_rank", F.col("_before") + F.col("_row") - 1)
    )
    # a few places per length at most, whatever the number of documents
    placed = ranked.join(F.broadcast(places), (ranked["length"] == places["length"]) & (F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("past_rank")))
    return placed.select(*[pieces[c] for c in pieces.columns], (F.col("first_sequence") + F.col("_rank") - F.col("first_rank")).alias("sequence_id"), "offset")
