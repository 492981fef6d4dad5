"""Tokens and packing."""

import random
from collections import Counter

import numpy as np
import pytest

from tablefold.llm import packing as p

TEXTS = [
    "", " ", "a  b", " a b ", "a\n b", "it's  we'll\t x", "x<|endoftext|>y z", "a b c", "²½ a", "a b\n", "\r\n a", "Größe für ciónñ, élan!",
    "日本 語 x", "🙂 a🙂b", "don't stop. Now: 12 34", "a.b\nc d\n\ne", "x" * 300, "\x00 a",
]


def test_ids_equal_the_tokenizer_library():
    encoder = p.Encoder(p.tokenizer_path())
    for _ in range(2):  # fresh, then remembered
        for text in TEXTS:
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.whole.encode(text, add_special_tokens=False).ids, text


def test_ids_of_all_documents_of_the_smallest_table(spark):
    encoder = p.Encoder(p.tokenizer_path())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text, want in zip(texts, encoder.whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want.ids


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_and_fits(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(1, 1024), rng.randint(300, 700), rng.randint(1, 40), 1024, 341, 342]) for _ in range(rng.choice([1, 7, 3000]))]
    counts = Counter(sizes)
    used, filled = Counter(), Counter()
    for size, first, past, sequence, offset in p.plan_sequences(counts):
        used[size] += past - first
        for k in range(past - first):
            filled[sequence + k] += size
    assert used == counts and max(filled.values()) <= 1024
    least = max(-(-sum(sizes) // 1024), sum(s > 512 for s in sizes), -(-sum(s > 341 for s in sizes) // 2))
    assert len(filled) <= 1.06 * least + 1


def test_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "x"), (4, "word " * 5000)] + [(10 + i, "same text here") for i in range(300)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id bigint, text string, piece int")
    got = p.pack(p.token_pieces(docs), rank_rows=50).collect()
    by_sequence, texts = {}, {}
    for r in got:
        assert r.length == len(r.ids) // 4 and 1 <= r.length <= 1024
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault(r.doc_id, []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    long = sorted(texts[4], key=lambda r: r.piece)
    assert [r.piece for r in long] == list(range(len(long))) and all(r.length == 1024 for r in long[1:])
    assert [r.start for r in long] == [sum(x.length for x in long[:i]) for i in range(len(long))]
    encoder = p.Encoder(p.tokenizer_path())
    assert b"".join(bytes(r.ids) for r in long) == encoder.encode("word " * 5000) + (2).to_bytes(4, "little")
    assert [r.length for r in texts[2] + texts[3]] == [1, 1] and len(texts[1]) == 2 and len(texts[None]) == 1
    assert len(got) == len(rows) - 1 + len(long)
    assert len(by_sequence) <= 1 + -(-sum(r.length for r in got) // 1024)


def test_empty_table_and_wrong_lengths(spark):
    assert p.pack(p.token_pieces(spark.createDataFrame([], "doc_id bigint, text string"))).count() == 0
    with pytest.raises(ValueError):
        p.pack(spark.createDataFrame([(1, 0, 2000)], "doc_id bigint, piece int, length bigint"))
