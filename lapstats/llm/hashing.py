"""Vectorised hashing of bytes and words to numpy arrays, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of a word: ASCII letters and digits, and all bytes of other characters.
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_MUL, _MUL2, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x100000001B3)
#: Texts are hashed in pieces of about this many bytes, so scratch arrays stay small for any text.
PIECE = 1 << 20
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that the high bits depend on all bits."""
    x = (x ^ (x >> np.uint64(32))) * _MUL
    return (x ^ (x >> np.uint64(29))) * _MUL2


def mark_byte_ngrams(data: np.ndarray, order: int, flags: np.ndarray) -> None:
    """Set the flags, 2**k of them, of the buckets of all n-grams of ``order`` bytes."""
    shift = np.uint64(64 - int(len(flags)).bit_length() + 1)
    for at in range(0, len(data) - order + 1, PIECE):
        piece = data[at:at + PIECE + order - 1].astype(np.uint64)
        n = len(piece) - order + 1
        code = np.full(n, order, np.uint64)
        for i in range(order):
            code = (code << np.uint64(8)) | piece[i:i + n]
        flags[(code * _MUL) >> shift] = True


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of ``data`` that end between words."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and _WORD[data[end]] and _WORD[data[end - 1]]:
            end += 1
        yield data[at:end]
        at = end


def words(data: np.ndarray, stem: int = 0) -> np.ndarray:
    """64-bit hashes of the words of ``data`` in order, in lower case (A-Z only).

    With ``stem``, two columns: the word's hash and that of its first ``stem`` bytes.
    """
    global _powers
    out = []
    for piece in _pieces(data):
        is_word = _WORD[piece]
        edge = np.diff(np.concatenate(([False], is_word, [False])).astype(np.int8))
        size = np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)
        if not len(size):
            continue
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        if len(_powers) <= (longest := int(size.max())):
            _powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(2 * longest, _BASE))), dtype=np.uint64)
        value = (_LOWER[piece[is_word]].astype(np.uint64) + np.uint64(1)) * _powers[place]
        h = mix(np.add.reduceat(value, first))
        if stem:
            value[place >= stem] = 0
            h = np.stack([h, mix(np.add.reduceat(value, first))], 1)
        out.append(h)
    return np.concatenate(out) if out else np.zeros((0, 2) if stem else 0, np.uint64)
