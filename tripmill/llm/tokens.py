"""Byte-level BPE ids of whole texts, with a per-worker table of the pieces met before.

The vocabulary's own splitter puts limits into a text that depend on the characters around them
alone, so a text may be cut there and each piece encoded by itself:

* in front of a space that a printing character follows;
* between a letter and ASCII punctuation;
* on both sides of a single line feed between printing characters.

Pieces recur. Their bytes are hashed and looked up for a whole batch of texts at once; a hit counts
only if the bytes are equal. What is new is encoded, many pieces in a text, and kept; the table starts
anew beyond ``MAX_PIECES`` pieces or ``MAX_BYTES`` of them.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from tripmill.llm.spans import equal, firsts, hashes, in_eights, utf8

MAX_PIECES = 1_500_000
MAX_BYTES = 32 << 20
#: Pieces that are encoded as one text.
_JOINED = 2000

_LETTER, _PUNCTUATION, _PRINTING = (np.zeros(256, bool) for _ in range(3))
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PRINTING[0x21:0x7F] = True
_PUNCTUATION[:] = _PRINTING & ~_LETTER
_PUNCTUATION[0x30:0x3A] = False
# first bytes of characters that are printing for the splitter; U+0080 to U+00BF and those from U+1000 on are left out
_LEAD = _PRINTING.copy()
_LEAD[0xC3:0xE1] = True

_encoders: dict[str, PieceEncoder] = {}


class _Growing:
    """An array that doubles its room as it is filled."""

    def __init__(self, kind: str, room: int = 1 << 12, spare: int = 0) -> None:
        self.held, self.n, self.spare = np.zeros(room + spare, kind), 0, spare

    def add(self, more: np.ndarray) -> None:
        need = self.n + len(more) + self.spare
        if need > len(self.held):
            grown = np.zeros(max(need, 2 * len(self.held)), self.held.dtype)
            grown[: self.n] = self.held[: self.n]
            self.held = grown
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)


class PieceEncoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        # a byte-level token has one character a byte; an added token is written as it is
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, "i8")
        for token, at in vocabulary.items():
            self.n_bytes[at] = len(token)
        # no cut may fall into an added token
        self.cuts = _PUNCTUATION.copy()
        for at, token in self.tokenizer.get_added_tokens_decoder().items():
            self.n_bytes[at] = len(token.content.encode())
            self.cuts[list(token.content.encode()[1:])] = False
        self._clear()

    def _clear(self) -> None:
        self.text = _Growing("u1", spare=8)
        self.ids = _Growing("<u4")
        self.hash, self.start, self.length = _Growing("u8"), _Growing("i8"), _Growing("i8")
        self.ids_start, self.n_ids = _Growing("i8"), _Growing("i8")
        self.slots = np.full(1 << 16, -1, "i4")

    def encode(self, texts: pa.Array | Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        data, limits = utf8(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        starts = self._starts(data, limits)
        lengths = np.diff(np.append(starts, len(data)))
        eights = in_eights(data)
        hashed = hashes(eights, starts, lengths)
        if self.hash.n > MAX_PIECES or self.text.n > MAX_BYTES:
            self._clear()
        found = self._find(eights, starts, lengths, hashed)
        new = np.flatnonzero(found < 0)
        if len(new):
            one = new[firsts(eights, starts[new], lengths[new], hashed[new])]
            self._learn(data, starts[one], lengths[one], hashed[one])
            found[new] = self._find(eights, starts[new], lengths[new], hashed[new])
        counts = self.n_ids.held[found]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.ids.held[np.repeat(self.ids_start.held[found] - ends + counts, counts) + np.arange(total)].tobytes()
        at = (4 * np.append(0, ends)[np.searchsorted(starts, limits)]).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]

    def _starts(self, data: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Where pieces begin."""
        n = len(data)
        if not n:
            return np.empty(0, "i8")
        filled = limits[:-1][limits[1:] > limits[:-1]]
        first, last = np.zeros(n, bool), np.zeros(n, bool)
        first[filled] = True
        last[limits[1:][limits[1:] > limits[:-1]] - 1] = True
        # the character that ends with a byte is a letter: an ASCII one, or one of U+00C0 to U+017F but for two
        letter = _LETTER[data]
        two = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
        sign = (data[two] == 0xC3) & ((data[two + 1] == 0x97) | (data[two + 1] == 0xB7))
        letter[two[~sign] + 1] = True
        follows = np.zeros(n, bool)
        follows[:-1] = _LEAD[data[1:]]
        follows &= ~last
        cut = (data == 0x20) & follows
        cut[1:] |= self.cuts[data[1:]] & letter[:-1]
        feed = (data == 0x0A) & follows & ~first
        feed[1:] &= _PRINTING[data[:-1]] | letter[:-1]
        cut |= feed
        cut[1:] |= feed[:-1]
        return np.flatnonzero(cut | first)

    def _find(self, eights: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """Number of each piece in the table, -1 if it is new."""
        out = np.full(len(starts), -1, "i8")
        mask = len(self.slots) - 1
        held = self.text.held
        own = np.ndarray((len(held) - 7,), "<u8", held.data, strides=(1,))
        place = hashed.astype("i8") & mask
        live = np.arange(len(starts))
        while len(live):
            at = self.slots[place[live]]
            live, at = live[at >= 0], at[at >= 0]
            same = (self.hash.held[at] == hashed[live]) & (self.length.held[at] == lengths[live])
            near = live[same]
            same[same] = equal(own, self.start.held[at[same]], eights, starts[near], lengths[near])
            out[live[same]] = at[same]
            live = live[~same]
            place[live] = (place[live] + 1) & mask
        return out

    def _learn(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashed: np.ndarray) -> None:
        """Encode new pieces, all different, and put them into the table."""
        begin, end = data[starts], data[starts + lengths - 1]
        second = data[np.minimum(starts + 1, len(data) - 1)]
        spaced = (begin == 0x20) & (lengths > 1) & _LEAD[second]
        # pieces that a line feed on both sides leaves as they are
        plain = ~spaced & _PRINTING[begin] & _PRINTING[end]
        order = np.concatenate([np.flatnonzero(spaced), np.flatnonzero(plain), np.flatnonzero(~spaced & ~plain)])
        starts, lengths, hashed = starts[order], lengths[order], hashed[order]
        n_spaced, n_plain = int(spaced.sum()), int(plain.sum())
        ends = np.cumsum(lengths)
        flat = data[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])]
        raw, at = flat.tobytes(), np.append(0, ends).tolist()
        groups = [(k, min(k + _JOINED, n_spaced), b"") for k in range(0, n_spaced, _JOINED)]
        groups += [(k, min(k + _JOINED, n_spaced + n_plain), b"\n") for k in range(n_spaced, n_spaced + n_plain, _JOINED)]
        groups += [(k, k + 1, b"") for k in range(n_spaced + n_plain, len(starts))]
        texts = [
            (raw[at[a] : at[b]] if not between else between.join([raw[at[k] : at[k + 1]] for k in range(a, b)])).decode()
            for a, b, between in groups
        ]
        counts, ids_before = np.zeros(len(starts), "i8"), self.ids.n
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for (a, b, between), got in zip(groups, coded, strict=True):
            ids = np.array(got.ids, "<u4")
            sizes = lengths[a:b]
            if between:
                # a line feed is a piece of its own behind each but the last
                sizes = np.stack([sizes, np.ones(b - a, "i8")], 1).ravel()[:-1]
            cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(sizes), side="right")
            each = np.diff(np.append(0, cuts))
            if between:
                keep = np.arange(len(sizes)) % 2 == 0
                ids = ids[np.repeat(keep, each)]
                each = each[keep]
            counts[a:b] = each
            self.ids.add(ids)
        first, before = self.hash.n, self.text.n
        self.text.add(flat)
        self.hash.add(hashed)
        self.start.add(before + ends - lengths)
        self.length.add(lengths)
        self.n_ids.add(counts)
        self.ids_start.add(ids_before + np.cumsum(counts) - counts)
        if 2 * self.hash.n > len(self.slots):
            self.slots = np.full(1 << (4 * self.hash.n).bit_length(), -1, "i4")
            first = 0
        waiting = np.arange(first, self.hash.n)
        mask = len(self.slots) - 1
        place = self.hash.held[waiting].astype("i8") & mask
        while len(waiting):
            free = self.slots[place] < 0
            self.slots[place[free]] = waiting[free]
            left = self.slots[place] != waiting
            waiting, place = waiting[left], (place[left] + 1) & mask


def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
