"""CRC-32 of many byte spans at once, from a table of what a byte adds at each distance from the end of a span.

CRC-32 is linear but for a constant that depends on the length alone: the sum (exclusive or) of what every byte adds
at its distance from the end, and of that constant, is the checksum.  Spans that end at the same byte share their
distances, so the runs of one, two and three words that end at a word need each byte once.
"""

from __future__ import annotations

import functools

import numpy as np

#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
#: Distances from the end that the table covers; longer spans are folded in blocks of this many bytes.
REACH = 1024
#: Bytes of a long span that are held as contributions at a time.
LONG_BYTES = 1 << 20


@functools.cache
def byte_table() -> np.ndarray:
    """What one byte does to a checksum of 0, for each of its 256 values."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(POLYNOMIAL) * (table & np.uint32(1)))
    return table


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    return (crc >> np.uint32(8)) ^ byte_table()[crc & np.uint32(255)]


@functools.cache
def position_table() -> np.ndarray:
    """At 256 d + b: what byte b adds if d bytes follow it."""
    rows = [byte_table()]
    for _ in range(REACH - 1):
        rows.append(_zero_byte(rows[-1]))
    return np.concatenate(rows)


@functools.cache
def _length_table() -> np.ndarray:
    state = np.array([0xFFFFFFFF], np.uint32)
    states = [state]
    for _ in range(REACH):
        state = _zero_byte(state)
        states.append(state)
    return np.concatenate(states) ^ np.uint32(0xFFFFFFFF)


def _apply(shift: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as four tables of a byte each."""
    crc = np.asarray(crc, np.uint32)
    return (
        shift[0][crc & np.uint32(255)]
        ^ shift[1][(crc >> np.uint32(8)) & np.uint32(255)]
        ^ shift[2][(crc >> np.uint32(16)) & np.uint32(255)]
        ^ shift[3][crc >> np.uint32(24)]
    )


@functools.cache
def _shift(log_blocks: int) -> np.ndarray:
    """The map that appends ``REACH << log_blocks`` zero bytes."""
    if log_blocks:
        half = _shift(log_blocks - 1)
        return np.stack([_apply(half, row) for row in half])
    rows = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(REACH):
        rows = _zero_byte(rows)
    return rows


def _appended_zeros(crc: np.ndarray, n: int) -> np.ndarray:
    """The checksum state after ``n`` zero bytes."""
    blocks, rest = divmod(n, REACH)
    for k in range(blocks.bit_length()):
        if blocks >> k & 1:
            crc = _apply(_shift(k), crc)
    for _ in range(rest):
        crc = _zero_byte(crc)
    return crc


def length_constant(n: int) -> int:
    """The checksum of ``n`` zero bytes, which is what the length alone adds."""
    if n <= REACH:
        return int(_length_table()[n])
    return int(_appended_zeros(np.array([0xFFFFFFFF], np.uint32), n)[0]) ^ 0xFFFFFFFF


def long_crc(span: np.ndarray) -> int:
    """The checksum of one span of any length: blocks from the table, then folded in pairs.

    The front is filled up with zero bytes, which add nothing.
    """
    crc = np.zeros(1, np.uint32)
    head = len(span) % LONG_BYTES
    starts = ([0] if head else []) + list(range(head, len(span), LONG_BYTES))
    distance = (np.arange(REACH - 1, -1, -1, dtype=np.int32) << 8)[None, :]
    for a in starts:
        piece = span[a : head if a == 0 and head else a + LONG_BYTES]
        log = max(0, (-(-len(piece) // REACH) - 1).bit_length())
        blocks = np.zeros(REACH << log, np.uint8)
        blocks[len(blocks) - len(piece) :] = piece
        folded = np.bitwise_xor.reduce(position_table()[blocks.reshape(-1, REACH) | distance], axis=1)
        for k in range(log):
            folded = _apply(_shift(k), folded[0::2]) ^ folded[1::2]
        crc = folded if a == 0 else _appended_zeros(crc, len(piece)) ^ folded
    return int(crc[0]) ^ length_constant(len(span))


def run_crcs(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, a: int, b: int) -> np.ndarray:
    """Checksums of the runs of one, two and three words that end at the words ``a`` to ``b``, one row a word.

    ``text`` holds words with one byte between them; word j is ``text[starts[j]:ends[j]]`` and ``first[j]`` is the
    first word of its document.  Runs that would begin before it have no meaning; they read 0.
    """
    j = np.arange(a, b)
    begins = np.stack([starts[np.maximum(j - k, first[j])] for k in range(3)], axis=1)
    there = np.stack([j - k >= first[j] for k in range(3)], axis=1)
    stop = ends[j]
    crcs = np.zeros((b - a, 3), np.uint32)
    short = stop - begins[:, 2] <= REACH
    lo, hi = begins[short, 2], stop[short]
    if len(lo):
        sizes = hi - lo
        before = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(before - lo, sizes)
        left = np.repeat(hi - 1, sizes) - at
        added = position_table()[(left << 8) | text[at]]
        # Pieces in order: the word but two, the word but one, the word itself, each with the byte that follows it.
        cuts = (begins[short] - lo[:, None] + before[:, None])[:, ::-1]
        held = there[short][:, ::-1]
        pieces = np.zeros(held.shape, np.uint32)
        pieces[held] = np.bitwise_xor.reduceat(added, cuts[held])
        sums = np.bitwise_xor.accumulate(pieces[:, ::-1], axis=1)
        crcs[short] = np.where(there[short], sums ^ _length_table()[hi[:, None] - begins[short]], 0)
    for row in np.flatnonzero(~short):
        for k in np.flatnonzero(there[row]):
            crcs[row, k] = long_crc(text[begins[row, k] : stop[row]])
    return crcs
