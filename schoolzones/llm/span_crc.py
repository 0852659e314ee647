"""CRC-32 of many spans of one buffer at once, by position tables.

CRC-32 is affine: the checksum of n bytes is a constant of the length n, XORed with one contribution of each byte, which
depends on the byte and on its distance from the end alone. So the contributions come from one table, and a span's are
XORed by ``bitwise_xor.reduceat``. The table reaches ``BLOCK`` bytes; a longer span is cut into such blocks from its end,
and the blocks' values are folded in pairs: XOR the left one, moved on by the right one's length, to the right one.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np

#: Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
BLOCK = 64
#: Bytes of spans that are looked up at once, a power of two times BLOCK.
PIECE = 1 << 20


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (table & np.uint32(1)) * np.uint32(POLYNOMIAL)
    return table


_BYTE = _byte_table()


def _zero_byte(state: np.ndarray) -> np.ndarray:
    """The state after one more byte, 0."""
    return (state >> np.uint32(8)) ^ _BYTE[state & np.uint32(255)]


def _position_table() -> np.ndarray:
    rows = [_BYTE]
    while len(rows) < BLOCK:
        rows.append(_zero_byte(rows[-1]))
    return np.concatenate(rows)


#: [256 * distance from the end + byte]
_POSITION = _position_table()


@cache
def _moves(k: int) -> np.ndarray:
    """For each of a state's four bytes and its value: what it becomes BLOCK * 2**k zero bytes later."""
    if k:
        return _moved(_moves(k - 1), k - 1)
    state = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])
    for _ in range(BLOCK):
        state = _zero_byte(state)
    return state


def _moved(state: np.ndarray, k: int) -> np.ndarray:
    table = _moves(k)
    out = np.zeros_like(state)
    for i in range(4):
        out ^= table[i][(state >> np.uint32(8 * i)) & np.uint32(255)]
    return out


def _folded(values: np.ndarray, k: int) -> np.uint32:
    """One value from those of consecutive runs of BLOCK * 2**k bytes each."""
    while len(values) > 1:
        if len(values) % 2:  # zero bytes in front contribute nothing
            values = np.concatenate((np.zeros(1, np.uint32), values))
        values, k = _moved(values[0::2], k) ^ values[1::2], k + 1
    return values[0]


def _long(span: np.ndarray) -> int:
    """A span of more than BLOCK bytes."""
    first = len(span) % PIECE or PIECE
    at = (np.arange(BLOCK - 1, -1, -1, dtype=np.int32) << 8)[None, :]
    pieces = []
    for begin, end in zip([0, *range(first, len(span), PIECE)], range(first, len(span) + 1, PIECE)):
        piece = span[begin:end]
        blocks = np.concatenate((np.zeros(-len(piece) % BLOCK, np.uint8), piece)).reshape(-1, BLOCK)
        pieces.append(_folded(np.bitwise_xor.reduce(_POSITION[at + blocks], axis=1), 0))
    value = _folded(np.array(pieces, np.uint32), (PIECE // BLOCK).bit_length() - 1)
    return int(value) ^ zlib.crc32(bytes(len(span)))


_CONSTANT = np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], np.uint32)


def crc32(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The unsigned CRC-32 of ``data[start : start + length]`` for every span; spans may overlap."""
    out = np.zeros(len(starts), np.uint32)
    some = np.flatnonzero((lengths > 0) & (lengths <= BLOCK))
    upto = np.cumsum(lengths[some])
    cuts = np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, PIECE), "left")
    for begin, end in zip(cuts, [*cuts[1:], len(some)]):
        part = some[begin:end]
        if not len(part):
            continue
        size = lengths[part].astype(np.int32)
        ends = np.cumsum(size, dtype=np.int32)
        begins = ends - size
        place = np.arange(ends[-1], dtype=np.int32)
        left = np.repeat(ends - 1, size) - place
        taken = data[np.repeat(starts[part] - begins, size) + place]
        out[part] = np.bitwise_xor.reduceat(_POSITION[(left << 8) | taken], begins) ^ _CONSTANT[size]
    for i in np.flatnonzero(lengths > BLOCK):
        out[i] = _long(data[starts[i] : starts[i] + lengths[i]])
    return out
