"""Words of whole Arrow columns of texts, by array operations on their UTF-8 bytes.

Every separator is an ASCII byte, and no byte of a longer UTF-8 character is
one, so cutting bytes cuts code points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORD, SPACE, BREAK = 0, 1, 2


def byte_classes(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    """The class of each byte: separators of words, separators of pieces, and the rest."""
    table = np.full(256, WORD, dtype=np.uint8)
    table[list(spaces)] = SPACE
    table[list(breaks)] = BREAK
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, one text after another, and where each begins (and the last ends)."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def split_words(texts: pa.Array, classes: np.ndarray, lower: bool = True):
    """``(ids, words, doc, begins)``: for each word of the column in order its number in ``words`` (the distinct words as
    bytes), the text it is in, and whether a piece begins with it (a text's first word, or one after a break)."""
    data, offsets = raw_bytes(texts)
    code = classes[data]
    word = code == WORD
    first = word.copy()
    first[1:] &= ~word[:-1]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[at] |= word[at]  # a text's first byte goes on with no word of the text before
    starts = np.flatnonzero(first)
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, bool)
    letters = data[word]
    letters = LOWER[letters] if lower else np.ascontiguousarray(letters)
    ends = np.empty(n + 1, dtype=np.int64)
    ends[:-1] = np.cumsum(word)[starts] - 1
    ends[-1] = len(letters)
    each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    coded = each.dictionary_encode()
    doc = np.searchsorted(offsets, starts, side="right") - 1
    broken = np.cumsum(code == BREAK)[starts]
    begins = np.ones(n, dtype=bool)
    begins[1:] = (broken[1:] != broken[:-1]) | (doc[1:] != doc[:-1])
    return np.asarray(coded.indices, dtype=np.int64), coded.dictionary.to_pylist(), doc, begins
