"""Codes of limited length, blocks of coded ids, and files of them."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tablefold.llm import huffman, idfiles

TEXTS = [
    "", " ", "a  b", "It's  we'll\t x", "x<|endoftext|>y z", "x<|startoftext|> .", "Größe für ciónñ, ÉLAN!", "日本 語 x 3½ 12a", "🙂 a🙂b İstanbul ΟΔΟΣ Σ",
    "don't stop. Now: 12 34!!!", "a.b\nc d\n\ne", "x" * 300, "\x00 a\x1cb \x1d", "...", "á é!", "word's. can't, o'clock", " a b᠎c​d", "12... 3,4", "ﬁn Straße ǅ",
]


def least_total(counts, limit):
    """Fewest bits over all sets of lengths that a prefix code can have."""
    best = None
    for lengths in itertools.product(range(1, limit + 1), repeat=len(counts)):
        if sum(2.0**-x for x in lengths) <= 1:
            total = sum(c * x for c, x in zip(counts, lengths, strict=True))
            best = total if best is None else min(best, total)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_lengths_are_the_best_ones_allowed(seed):
    rng = random.Random(seed)
    counts = [rng.choice([1, 1, 2, 3, 50, 1000]) for _ in range(rng.randint(2, 6))]
    limit = rng.randint(3, 5)
    lengths = huffman.code_lengths(np.array(counts), limit).tolist()
    assert max(lengths) <= limit and sum(2.0**-x for x in lengths) <= 1
    assert sum(c * x for c, x in zip(counts, lengths, strict=True)) == least_total(counts, limit)


def test_lengths_of_small_and_too_large_alphabets():
    assert huffman.code_lengths(np.array([0, 0])).tolist() == [0, 0]
    assert huffman.code_lengths(np.array([0, 7])).tolist() == [0, 1]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, np.int64), 3)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("symbols", [1, 2, 300, 70_000])
def test_blocks_decode_to_what_was_coded(n, symbols):
    rng = np.random.default_rng(n + symbols)
    ids = np.minimum(rng.geometric(0.01, n) * rng.integers(1, 900, n), symbols) - 1
    code = huffman.Code(huffman.code_lengths(np.bincount(ids, minlength=symbols) + (np.arange(symbols) % 3 == 0)))
    data, checkpoints = code.encode(ids)
    assert huffman.Decoder(code).decode(data, checkpoints, n).tolist() == ids.tolist()
    at = "".join(f"{b:08b}" for b in data)
    for k in range(0, n, huffman.CHECKPOINT):  # a checkpoint is where that id's code starts
        length = int(code.lengths[ids[k]])
        assert int(at[checkpoints[k // huffman.CHECKPOINT] :][:length], 2) == int(code.codes[ids[k]])


def test_codes_are_prefix_free_and_canonical():
    code = huffman.Code(huffman.code_lengths(np.array([5, 1, 1, 9, 0, 2, 3])))
    words = {i: f"{int(code.codes[i]):0{code.lengths[i]}b}" for i in range(7) if code.lengths[i]}
    assert not any(a != b and words[b].startswith(words[a]) for a in words for b in words)
    assert sorted(words, key=lambda i: (code.lengths[i], i)) == sorted(words, key=lambda i: words[i].ljust(20, "0"))


def test_ids_equal_the_tokenizer_library(monkeypatch):
    encoder = idfiles.WordEncoder(idfiles.tokenizer_path())
    want = [encoder.whole.encode(t, add_special_tokens=False).ids for t in TEXTS]
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(TEXTS)] == want
    monkeypatch.setattr(idfiles, "KNOWN_WORDS", 3)
    assert [np.frombuffer(x, "<u2").tolist() for t in TEXTS for x in encoder.encode([t])] == want


def test_ids_of_all_documents_of_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    whole = idfiles.WordEncoder(idfiles.tokenizer_path()).whole
    got = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in idfiles.token_ids(docs).collect()}
    assert got == {d: [*e.ids, 2] for d, e in zip(texts, whole.encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}


def test_latin_words_are_encoded_in_one_call():
    encoder = idfiles.WordEncoder(idfiles.tokenizer_path())
    letters = [chr(c) for c in range(0x180) if chr(c).isalpha() and chr(c) != "\u0130"]
    rng = random.Random(7)
    words = {*letters, *("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(3000))}
    want = {w: encoder._ids(w).tobytes() for w in words}
    whole, encoder.whole = encoder.whole, None  # what it would have to encode raises
    encoder.learn(words)
    assert encoder.known == want
    encoder.whole = whole
    encoder.learn({"\u0130x", "\u03a3", "e\u0301"})
    assert all(encoder.known[w] == encoder._ids(w).tobytes() for w in encoder.known.keys() - want.keys())


def test_only_different_words_are_looked_up_and_encoded():
    class Counted(dict):
        looked_up = 0

        def get(self, *args):
            self.looked_up += 1
            return super().get(*args)

    encoder = idfiles.WordEncoder(idfiles.tokenizer_path())
    texts = ["Alpha beta, gamma " * 500, "beta. x<|endoftext|>y " * 300, "\x1cdelta " * 200]
    want = [encoder.whole.encode(t, add_special_tokens=False).ids for t in texts]
    ids, sent = encoder._ids, []
    encoder.known, encoder._ids = Counted(), lambda text, *args: sent.append(text) or ids(text, *args)
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == want
    assert encoder.known.looked_up < 20 and sum(map(len, sent)) < 200


def test_columns_of_texts_with_nulls():
    encoder = idfiles.WordEncoder(idfiles.tokenizer_path())
    column = pa.array(["left out", None, *TEXTS, None, "left out"]).slice(1, len(TEXTS) + 2)
    got = encoder.encode_column(column, b"\2\0")
    got.validate(full=True)
    want = [[*encoder.whole.encode(t or "", add_special_tokens=False).ids, 2] for t in column.to_pylist()]
    assert [np.frombuffer(x, "<u2").tolist() for x in got.to_pylist()] == want
    assert encoder.encode([]) == [] and encoder.encode(["", " "]) == [b"", b""]


def test_signs_join_the_mark_that_a_letter_becomes():
    encoder = idfiles.WordEncoder(idfiles.tokenizer_path())
    texts = [f"a{c}! {c}. {c}b?" for c in ("\u0130", "\u0958", "\u09dc", "\ufb2a", "\u00e9", "\u0416", "\u65e5", "e\u0301")]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == [encoder.whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_give_back_every_document(spark, tmp_path):
    rows = [(7, None), (3, "b c"), (3, "b c"), (3, "other"), (None, "x y"), (-4, ""), (9, "long " * 90_000)] + [(20 + i, TEXTS[i % len(TEXTS)]) for i in range(300)] + [(5, "again")] * 200
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, ids int").repartition(5)
    idfiles.write_ids(idfiles.token_ids(docs), f"{tmp_path}/f", idfiles.id_width(), block_ids=500)
    got = idfiles.read_ids(spark, f"{tmp_path}/f").orderBy("start").collect()
    whole = idfiles.WordEncoder(idfiles.tokenizer_path()).whole
    want = sorted((d is not None, d or 0, zlib.crc32(np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, zlib.crc32(r.ids)) for r in got) == want
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[:2] for w in want]
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert spark.read.parquet(f"{tmp_path}/f/blocks").count() > 5


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    idfiles.write_ids(idfiles.token_ids(docs), f"{tmp_path}/f", idfiles.id_width())
    assert idfiles.read_ids(spark, f"{tmp_path}/f").collect() == []
