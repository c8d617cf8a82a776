"""Words of Arrow text batches as integers, exact within a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value of the contracts: words are runs of what is not white space in ASCII.
SPACE = r"[\x20\x09-\x0D]"


class Words:
    """``ids``: a number for each word in order, ``row``: its text's row, ``unique``: the words."""

    def __init__(self, texts: pa.Array) -> None:
        texts = pc.fill_null(texts, "")
        # splits at SPACE
        parts = pc.ascii_split_whitespace(texts)
        flat = parts.flatten()
        row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        full = pc.not_equal(flat, "")
        coded = flat.filter(full).dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype("i8")
        self.row = row[full.to_numpy(zero_copy_only=False)]
        self.unique = coded.dictionary
        self.counts = np.bincount(self.row, minlength=len(texts))


def grams(ids: np.ndarray, row: np.ndarray, n: int, unique: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact numbers of the n-word windows and their first places; none crosses a text."""
    places = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :]) if len(row) >= n else np.empty(0, "i8")
    code, size = ids[places], max(unique, 1)
    for k in range(1, n):
        if size > (1 << 62) // max(unique, 1):
            found, code = np.unique(code, return_inverse=True)
            size = max(len(found), 1)
        code = code * unique + ids[places + k]
        size *= max(unique, 1)
    return code, places
