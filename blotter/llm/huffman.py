"""Canonical length-limited Huffman codes on numpy arrays: code table, bit writer, bit reader."""

from __future__ import annotations

import numpy as np

MAX_BITS = 16


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge; 0 for a count of zero."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    n = len(order)
    # Level by level: symbols and pairs of the level below, by weight. For each level keep which
    # of its items are symbols; choosing the cheapest 2n - 2 at the top fixes the rest.
    levels = [np.ones(n, bool)]
    merged = weight
    for _ in range(limit - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < n)
        merged = both[rank]
    found = np.zeros(n, np.int64)
    take = 2 * n - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        found[:symbols] += 1
        take = 2 * (take - symbols)
    lengths[order] = found
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then by symbol."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        # A code is the sum of the shares of the code space taken before it.
        shares = np.left_shift(np.uint64(1), np.uint64(MAX_BITS) - lengths[order].astype(np.uint64))
        before = np.cumsum(shares) - shares
        codes[order] = before >> (np.uint64(MAX_BITS) - lengths[order].astype(np.uint64))
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length for every value of the next ``MAX_BITS`` bits."""
    symbols = np.zeros(1 << MAX_BITS, np.uint16)
    sizes = np.zeros(1 << MAX_BITS, np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    total = int(spans.sum())
    symbols[:total] = np.repeat(order, spans)
    sizes[:total] = np.repeat(lengths[order], spans)
    return symbols, sizes


def write_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` one after another, and the bit offset of every ``every``-th id."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    start = end - size
    if len(ids) and not size.all():
        raise ValueError("an id without a code")
    # Each code is put into a 64-bit frame at its place in the 32-bit word where it starts.
    frame = codes[ids].astype(np.uint64) << (64 - size - (start & 31)).astype(np.uint64)
    word = start >> 5
    words = int(end[-1] + 31 >> 5) + 1 if len(ids) else 0
    # Bits of different codes never meet, so that sums below 2^32 stand for a bitwise or.
    high = np.bincount(word, (frame >> np.uint64(32)).astype(np.float64), words)
    low = np.bincount(word + 1, (frame & np.uint64(0xFFFFFFFF)).astype(np.float64), words + 1)[:words]
    packed = (high + low).astype(np.uint64).astype(">u4").tobytes()
    return packed[: int(end[-1] + 7 >> 3) if len(ids) else 0], start[::every]


def read_bits(
    payload: np.ndarray, starts: np.ndarray, numbers: np.ndarray, table: tuple[np.ndarray, np.ndarray]
) -> np.ndarray:
    """Ids of runs that begin at the bit offsets ``starts``, ``numbers`` of them each, run by run.

    All runs advance together, one table look-up per id; runs are sorted by length, so that those
    at their end drop off the tail.
    """
    symbols, sizes = table
    padded = np.concatenate([payload, np.zeros(4, np.uint8)])
    order = np.argsort(-numbers, kind="stable")
    at = starts[order].astype(np.int64)
    left = numbers[order]
    out = np.zeros(int(numbers.sum()), np.uint16)
    place = (np.cumsum(numbers) - numbers)[order]
    for step in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -step, "left"))
        here = at[:live]
        byte = here >> 3
        window = (
            padded[byte].astype(np.uint32) << 16
            | padded[byte + 1].astype(np.uint32) << 8
            | padded[byte + 2].astype(np.uint32)
        )
        seen = window >> (8 - (here & 7)).astype(np.uint32) & 0xFFFF
        out[place[:live] + step] = symbols[seen]
        here += sizes[seen]
    return out
