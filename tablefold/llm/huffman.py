"""Canonical Huffman codes of limited length, and blocks of coded numbers that decode from many places at once."""

from __future__ import annotations

import numpy as np

#: Longest code, unless the alphabet itself needs more, and numbers between two checkpoints of a block.
MAX_BITS = 16
CHECKPOINT = 128


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol's code, at most ``max_bits``, with the fewest bits in total; zero for counts of zero.

    Package-merge: in every level the symbols, in order of their counts, are merged
    with pairs of the level before. The first 2n - 2 entries of the last level are
    taken; a symbol's length is the number of levels whose taken part holds it. One
    symbol alone gets one bit. An alphabet too large for ``max_bits`` raises.
    """
    used = np.flatnonzero(counts)
    n = len(used)
    out = np.zeros(len(counts), np.uint8)
    if n < 2:
        out[used] = 1
        return out
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols do not fit into {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    levels, level = [], np.empty(0, np.int64)
    for _ in range(max_bits):
        pairs = len(level) // 2
        both = np.concatenate((weights, level[0 : 2 * pairs : 2] + level[1 : 2 * pairs : 2]))
        merged = np.argsort(both, kind="stable")
        level = both[merged]
        levels.append(np.concatenate(([0], np.cumsum(merged < n))))  # symbols among the first entries
    lengths, taken = np.zeros(n, np.uint8), 2 * n - 2
    for symbols in reversed(levels):
        own = int(symbols[taken])
        lengths[:own] += 1
        taken = 2 * (taken - own)
    out[order] = lengths
    return out


class Code:
    """Codes in order of length, then symbol, which the lengths alone determine."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        self.bits = max(1, int(lengths.max(initial=1)))
        used = np.flatnonzero(lengths)
        self.order = used[np.argsort(lengths[used], kind="stable")]
        widths = np.int64(1) << (self.bits - lengths[self.order].astype(np.int64))
        first = np.cumsum(widths) - widths
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[self.order] = (first >> (self.bits - lengths[self.order].astype(np.int64))).astype(np.uint64)
        self.widths = widths

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids' codes one behind the other, first bit highest, and the bit at which every ``CHECKPOINT``-th begins."""
        if not len(ids):
            return b"", np.empty(0, np.int64)
        length = self.lengths[ids]
        if not length.all():
            raise ValueError("an id without a code")
        end = np.cumsum(length, dtype=np.int64)
        start = end - length
        word, room = start >> 6, 64 - (start & 63) - length
        code, split = self.codes[ids], np.flatnonzero(room < 0)  # codes that go on in the next word
        here = code << np.maximum(room, 0).view(np.uint64)
        here[split] = code[split] >> (-room[split]).view(np.uint64)
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        firsts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[firsts]] = np.bitwise_or.reduceat(here, firsts)
        out[word[split] + 1] |= code[split] << (64 + room[split]).view(np.uint64)
        return out.astype(">u8").tobytes()[: (int(end[-1]) + 7) // 8], start[::CHECKPOINT]

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length for every possible next ``bits`` bits."""
        missing = (1 << self.bits) - int(self.widths.sum())
        symbols = np.concatenate((np.repeat(self.order, self.widths), np.zeros(missing, np.int64)))
        return symbols.astype(np.uint32), self.lengths[symbols]


class Decoder:
    """Decodes all stretches between the checkpoints of a block side by side, a table look-up per number."""

    def __init__(self, code: Code):
        self.bits = code.bits
        self.symbols, self.lengths = code.table()

    def decode(self, data: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        if not n:
            return np.empty(0, np.uint32)
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.int64)
        parts = len(raw) - 4  # five bytes from each place on hold any code of up to 33 bits
        window = np.zeros(parts, np.int64)
        for i in range(5):
            window = (window << 8) | raw[i : i + parts]
        at = checkpoints.astype(np.int64).copy()
        out = np.empty((CHECKPOINT, len(at)), np.uint32)
        mask = (1 << self.bits) - 1
        for i in range(CHECKPOINT):
            if i == (n - 1) % CHECKPOINT + 1:
                at = at[:-1]  # the last stretch has ended
                if not len(at):
                    break
            seen = (window[at >> 3] >> (40 - self.bits - (at & 7))) & mask
            out[i, : len(at)] = self.symbols[seen]
            at += self.lengths[seen]
        return out.T.ravel()[:n]
