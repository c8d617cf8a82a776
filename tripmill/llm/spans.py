"""Spans of bytes in numpy arrays: hashes, comparison and first occurrences, eight bytes at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], "u8")


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the limits of each; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    limits = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, "u1") if whole is not None and whole.size else np.empty(0, "u1")
    return data[limits[0] : limits[-1]], limits - limits[0]


def in_eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the last byte."""
    padded = np.concatenate([data, np.zeros(8, "u1")])
    return np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))


def _part(eights: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int) -> np.ndarray:
    return eights[starts + at] & _LOW[np.minimum(lengths - at, 8)]


def hashes(eights: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seeds: np.ndarray | int = 0) -> np.ndarray:
    out = np.zeros(len(starts), "u8") + np.asarray(seeds).astype("u8") * _MIX + lengths.astype("u8")
    live, at = np.arange(len(out)), 0
    while len(live):
        mixed = (out[live] ^ _part(eights, starts[live], lengths[live], at)) * _MIX
        out[live] = mixed ^ (mixed >> np.uint64(29))
        at += 8
        live = live[lengths[live] > at]
    return out


def equal(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether spans of ``a`` and of ``b``, of the same lengths, hold the same bytes."""
    same = np.ones(len(lengths), bool)
    live, at = np.arange(len(lengths)), 0
    while len(live):
        agree = _part(a, a_starts[live], lengths[live], at) == _part(b, b_starts[live], lengths[live], at)
        same[live[~agree]] = False
        at += 8
        live = live[agree]
        live = live[lengths[live] > at]
    return same


def firsts(eights: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashed: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Which spans are the first of their bytes (in their row), by an open-addressing table.

    A span counts as seen only if its bytes equal those of the span that owns the place.
    """
    n = len(starts)
    own = np.zeros(n, bool)
    size = 1 << max(2 * n, 2).bit_length()
    table = np.full(size, -1, "i8")
    place = (hashed >> np.uint64(20)).astype("i8") & (size - 1)
    waiting = np.arange(n)
    while len(waiting):
        at = place[waiting]
        free = table[at] < 0
        # of several for one free place the first stays: it is written last
        table[at[free][::-1]] = waiting[free][::-1]
        owner = table[at]
        got = owner == waiting
        own[waiting[got]] = True
        waiting, owner = waiting[~got], owner[~got]
        seen = (hashed[waiting] == hashed[owner]) & (lengths[waiting] == lengths[owner])
        if rows is not None:
            seen &= rows[waiting] == rows[owner]
        alike = waiting[seen]
        seen[seen] = equal(eights, starts[alike], eights, starts[owner[seen]], lengths[alike])
        waiting = waiting[~seen]
        place[waiting] = (place[waiting] + 1) & (size - 1)
    return own
