"""Files of token ids: Huffman-coded blocks of whole documents in order of their identifiers.

A folder holds three Parquet tables, so that any store Spark reaches takes them and a
lost task leaves nothing behind:

* ``codes``: ``id, bits``, the code length of every id that occurs; codes are canonical.
* ``blocks``: a row per block with its ``part`` and ``first`` place in that part, the
  documents' ``doc_ids`` and the ``ends`` of their ids in the block, the coded ``data`` and
  the bits at which every 128th id starts (``checkpoints``, little-endian unsigned 32-bit).
* ``parts``: ``part, first``, the number of ids in all parts before.

A block decodes by itself. It ends with the first document that fills it, so only a
document longer than a block makes a longer one.
"""

from __future__ import annotations

import codecs
import os
from collections.abc import Iterable, Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefold.llm.common import pieces_of, table
from tablefold.llm.huffman import MAX_BITS, Code, Decoder, code_lengths
from tablefold.llm.packing import byte_names
from tablefold.operators.numbering import running_total

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
BLOCK_IDS = 262_144
#: Characters of texts tokenised together, and words remembered per task.
BATCH_CHARS = 4_000_000
KNOWN_WORDS = 400_000

#: Signs that never join a letter before them in one token, unless its normal form or lower case ends in a mark.
_TAIL = ".,;:!?&%$*#"
#: Words of letters below the first and without the second are in normal form C, and Python's lower case is the tokenizer's.
_LATIN, _DOTTED = "\u0180", "\u0130"
#: Every byte as this kind of vocabulary spells it, but ASCII as it is, with the white space between words.
_SPELT = "".join(chr(b) if b < 128 else n for n, b in sorted(byte_names().items(), key=lambda x: x[1]))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts by the tokenizer library, each distinct word encoded once.

    White space separates tokens in this vocabulary, so that a text's ids are those of
    what lies between its ASCII white space; Arrow splits a column of texts there, and
    only different words become Python strings. Words of Latin letters are encoded in
    one call and cut behind the tokens that end a word, in lower case and spelt in the
    vocabulary's names of bytes, so that nothing is left to normalise or to split; other
    words, among them those with further kinds of white space, are told apart by a
    special token between them. Words with a special token's string come one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.whole = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.whole.model)
        self.letters.pre_tokenizer = WhitespaceSplit()
        self.special = [t.content for _, t in sorted(self.whole.get_added_tokens_decoder().items())]
        self.mark = self.special[-1]
        self.mark_id = self.whole.token_to_id(self.mark)
        vocabulary = self.whole.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        if hasattr(self.whole.model, "_resize_cache"):
            self.whole.model._resize_cache(0)  # words come once only
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str, tokenizer: Tokenizer | None = None) -> np.ndarray:
        return np.array((tokenizer or self.whole).encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _learn(self, words: list[str], ids: np.ndarray, cuts: np.ndarray, gap: int) -> None:
        if len(cuts) != len(words) - 1:
            raise ValueError("the ids of different words cannot be told apart")
        data, width = ids.tobytes(), self.kind.itemsize
        for word, a, z in zip(words, [0, *(width * (cuts + gap)).tolist()], [*(width * cuts).tolist(), len(data)], strict=True):
            self.known[word] = data[a:z]

    def learn(self, words: Iterable[str]) -> None:
        """Remembers the ids of ``words``, which are different."""
        plain, others = [], []
        for w in words:
            if w.isalpha() and (w.isascii() or (max(w) < _LATIN and _DOTTED not in w)):
                plain.append(w)
            elif any(s in w for s in self.special):
                self.known[w] = self._ids(w).tobytes()
            else:
                others.append(w)
        if plain:
            ids = self._ids(codecs.charmap_decode("\n".join(plain).lower().encode(), "strict", _SPELT)[0], self.letters)
            self._learn(plain, ids, np.flatnonzero(self.ends[ids])[:-1] + 1, 0)
        if others:
            ids = self._ids(self.mark.join(others))
            self._learn(others, ids, np.flatnonzero(ids == self.mark_id), 1)

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """Ids of each of a column of different words; signs behind a letter are looked up by themselves."""
        stems = pc.utf8_rtrim(words, _TAIL)
        last = pc.utf8_slice_codeunits(stems, -1)
        letters = [c for c in last.unique().to_pylist() if normalize("NFC", c).lower()[-1:].isalpha()]  # some become a letter and a mark
        cut = pc.and_(pc.not_equal(stems, words), pc.is_in(last, pa.array(letters, words.type)))
        pairs = zip(*(x.filter(cut).to_numpy(zero_copy_only=False).tolist() for x in (words, stems)), strict=True)
        tails = pa.array(["", *(w[len(c) :] for w, c in pairs)], words.type)
        parts = pa.concat_arrays([pc.if_else(cut, stems, words), tails]).dictionary_encode()
        distinct, known = parts.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        found = list(map(known.get, distinct))
        self.learn([w for w, x in zip(distinct, found, strict=True) if x is None])
        ids = pa.array([known[w] if x is None else x for w, x in zip(distinct, found, strict=True)], pa.binary())
        stem, tail = np.split(parts.indices.to_numpy(), [len(words)])
        behind = np.full(len(words), tail[0])
        behind[cut.to_numpy(zero_copy_only=False)] = tail[1:]
        return pc.binary_join_element_wise(ids.take(pa.array(stem)), ids.take(pa.array(behind)), b"")

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()

    def encode_column(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Ids of each text of an Arrow column with ``end`` behind them, as a column of bytes; a null text is empty."""
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        by_words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = by_words.flatten().dictionary_encode()
        past = np.cumsum(pc.list_value_length(by_words).to_numpy(), dtype=np.int64)
        ids = pa.concat_arrays([self._ids_of(words.dictionary), pa.array([end], pa.binary())])
        places = np.insert(words.indices.to_numpy(), past, len(words.dictionary))  # the end of every text
        size = np.cumsum(pc.binary_length(ids).to_numpy()[places], dtype=np.int64)
        ends = pa.array(np.concatenate(([0], size[past + np.arange(len(past))])), pa.int32())
        data = ids.take(pa.array(places)).buffers()[2]
        return pa.Array.from_buffers(pa.binary(), len(past), [None, ends.buffers()[1], data or pa.py_buffer(b"")])


def token_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every row: the ids of the whole text and the end id, little-endian, of 16 bits where the vocabulary allows it, else 32.

    A null text is empty. Nulls as identifier and repeated rows stay as they are.
    """
    path = path or tokenizer_path()

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        end = np.array([end_id], encoder.kind).tobytes()
        for part in pieces_of(batches, "text", BATCH_CHARS):
            yield pa.record_batch([part.column(0), encoder.encode_column(part.column(1), end)], ["doc_id", "ids"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(encoded, f"doc_id {dict(docs.dtypes)[id_col]}, ids binary")


def id_width(path: str | None = None) -> int:
    """Bytes of an id in ``token_ids``."""
    return WordEncoder(path or tokenizer_path()).kind.itemsize


def id_counts(ids: DataFrame, width: int) -> DataFrame:
    """``id, n`` over all rows; tasks send their own counts only."""
    kind = f"<u{width}"

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in pieces_of(batches, "ids", BATCH_CHARS):
            n = np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), kind))
            if len(n) > len(total):
                total, n = n, total
            total[: len(n)] += n
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["id", "n"])

    return ids.select("ids").mapInArrow(counted, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(ids: DataFrame, folder: str, width: int, max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS) -> None:
    """Writes rows of ``doc_id, ids`` as files of coded ids below ``folder``, which must not exist.

    Documents come in ascending order of ``doc_id``, null first; rows that repeat an
    identifier by a hash of their ids. Only the counts per id reach the driver, at
    most as many as the vocabulary has; they give one code for all blocks. Every
    identifier's rows may lie in several parts, so that none becomes too large.
    """
    spark, kind = ids.sparkSession, f"<u{width}"
    ids.select("doc_id", "ids", F.xxhash64("ids").alias("tie"), F.monotonically_increasing_id().alias("place")).write.parquet(f"{folder}/given", compression="zstd")
    given = spark.read.parquet(f"{folder}/given")
    counts = id_counts(given, width).toPandas()
    totals = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    totals[counts["id"]] = counts["n"]
    lengths = code_lengths(totals, max(max_bits, int(len(counts)).bit_length()))
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id bigint, bits int").coalesce(1).write.parquet(f"{folder}/codes")
    shared = spark.sparkContext.broadcast(lengths)

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, first, docs, held, size, part = Code(shared.value), 0, [], [], 0, TaskContext.get().partitionId()

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(x) for x in held])
            data, checkpoints = code.encode(np.concatenate(held))
            if len(data) >= 1 << 29:
                raise ValueError("a document of more than 4 billion bits")
            columns = [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([docs], pa.list_(kinds[0]))]
            columns += [pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([data], pa.binary()), pa.array([checkpoints.astype("<u4").tobytes()], pa.binary())]
            return pa.record_batch(columns, ["part", "first", "doc_ids", "ends", "data", "checkpoints"])

        for batch in batches:
            kinds = [batch.schema.field(0).type]
            for doc, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs.append(doc)
                held.append(np.frombuffer(row.as_buffer(), kind))
                size += len(held[-1])
                if size >= block_ids:
                    yield block()
                    first, docs, held, size = first + size, [], [], 0
        if docs:
            yield block()

    ordered = given.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place").select("doc_id", "ids")
    doc_type = dict(ids.dtypes)["doc_id"]
    ordered.mapInArrow(coded, f"part int, first bigint, doc_ids array<{doc_type}>, ends array<bigint>, data binary, checkpoints binary").write.parquet(f"{folder}/blocks", compression="none")
    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum(F.element_at("ends", -1)).alias("n"))
    running_total(sizes.withColumn("all", F.lit(0)), ["all"], "part", F.col("n"), "before").select("part", "before").write.parquet(f"{folder}/parts")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) from a folder of ``write_ids``; ``start`` counts the ids of all documents before."""
    lengths = np.zeros(1, np.uint8)
    codes = table(spark, folder, "codes", "").toPandas()  # at most as many rows as the vocabulary
    if len(codes):
        lengths = np.zeros(int(codes["id"].max()) + 1, np.uint8)
        lengths[codes["id"]] = codes["bits"]
    shared = spark.sparkContext.broadcast(lengths)

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Code(shared.value))
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                doc_ids, ends = row.column(1).flatten(), np.asarray(row.column(2).flatten())
                data, checkpoints = row.column(3)[0].as_py(), np.frombuffer(row.column(4)[0].as_buffer(), "<u4")
                ids = decoder.decode(data, checkpoints, int(ends[-1])).astype("<u4").tobytes()
                begins = np.concatenate(([0], ends[:-1]))
                parts = [ids[4 * a : 4 * z] for a, z in zip(begins.tolist(), ends.tolist(), strict=True)]
                start = pa.array(begins + row.column(0)[0].as_py(), pa.int64())
                yield pa.record_batch([doc_ids, start, pa.array(ends - begins, pa.int64()), pa.array(parts, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    blocks = table(spark, folder, "blocks", "").join(table(spark, folder, "parts", ""), "part")
    kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    placed = blocks.select((F.col("before") + F.col("first")).alias("first"), "doc_ids", "ends", "data", "checkpoints")
    return placed.mapInArrow(decoded, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")
