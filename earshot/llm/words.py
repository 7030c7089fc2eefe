"""Words of whole texts as 64-bit numbers, a batch of texts at a time.

A word is a run of characters other than the blank and the controls 9 to 13; A-Z are
read as a-z, everything else is left as it is. The number of a word is a sum over its
bytes of a random number for the byte times an odd base to the power of its place,
scrambled with the length. Two of n different words share a number with a probability
near n * n / 2**65.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from earshot.llm.common import mixed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_BLANKS = np.zeros(256, bool)
_BLANKS[[9, 10, 11, 12, 13, 32]] = True


def _part(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and byte places of the words of one buffer."""
    data = np.frombuffer(raw, np.uint8)
    inside = ~_BLANKS[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = np.add.reduceat(inside.astype(np.int64), starts)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASE, np.uint64))
    word = np.cumsum(first) - 1
    place = np.where(inside, np.arange(len(data)) - starts[np.maximum(word, 0)], 0)
    values = np.where(inside, _BYTES[data] * powers[place], np.uint64(0))
    with np.errstate(over="ignore"):
        total = np.add.reduceat(values, starts) + lengths.astype(np.uint64) * _BASE
    return mixed(total), starts


def word_numbers(texts: list[str | None], most: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all words in text order, borders): text i has words borders[i]:borders[i + 1].

    The buffer is worked through in runs of about ``most`` bytes that end at a blank,
    so the working memory does not grow with the length of a text; a single longer
    word is taken whole.
    """
    raw = "\n".join(t or "" for t in texts).encode().lower()
    sizes = [len((t or "").encode()) + 1 for t in texts]
    ends = np.cumsum(sizes)
    numbers, places, at = [], [], 0
    while at < len(raw):
        end = min(at + most, len(raw))
        while end < len(raw) and not _BLANKS[raw[end]]:
            end += 1
        got, where = _part(raw[at:end])
        numbers.append(got)
        places.append(where + at)
        at = end
    if not numbers:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    all_places = np.concatenate(places)
    borders = np.concatenate([[0], np.searchsorted(all_places, ends, side="left")])
    return np.concatenate(numbers), borders


def text_batches(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[tuple[list, list]]:
    """(first column, texts) in runs of about ``most`` characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for key, content in zip(batch.column(0), batch.column(1), strict=True):
            text = content.as_py() or ""
            ids.append(key.as_py())
            texts.append(text)
            size += len(text) + 64
            if size >= most:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
