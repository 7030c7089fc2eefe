"""Documents that hold benchmark passages, whole or slightly edited.

Texts are sequences of words (letters and digits, lower case). A document is
contaminated by an item of n words if some run of its words lies within
``edits * n`` word insertions, deletions and replacements of the item.

* Windows of the item's size are taken from the document wherever such a run can begin:
  of the k + 1 equal blocks an item is cut into, one at least must stand unedited in any
  run within k edits, so windows around unedited blocks lose nothing.
* Each window is mapped by the CGK random walk: at every step the walk writes the word
  under its pointer and a random bit of that word decides whether the pointer moves on.
  Windows at a small edit distance meet again and again and write nearly the same, so
  edit distance becomes Hamming distance.
* Hashes of a few sampled places of that writing are looked up among those of the items.
  The number of repetitions, each with a walk and a sample of its own, is chosen for items
  of about one size so that a run at the greatest allowed distance is met with probability
  ``recall``; the chances of a repetition are measured on randomly edited items of that size.
* Items of sizes that would need more than ``most`` repetitions are not hashed: all their
  windows are candidates.
* Every candidate is verified by the exact edit distance.

The items travel to the tasks in slices of bounded size; documents are not shuffled.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import Shipped, give_back, mixed
from earshot.llm.words import text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Characters of text that are worked on at once.
RUN = 4 << 20
MATCHES = "doc_id long, item_id long, distance int, item_words int, first_word long, last_word long"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def walk(rows: np.ndarray, sizes: np.ndarray, seed: int, picks: np.ndarray) -> np.ndarray:
    """Hashes of the CGK writing of each row (padded word ids) at the sampled places.

    ``picks`` are fractions of the writing, which has three places for each of the
    row's ``sizes`` words; behind its end a row writes blanks.
    """
    count, width = rows.shape
    at = np.zeros(count, np.int64)
    places = np.floor(np.outer(3 * sizes, np.sort(picks))).astype(np.int64)
    total, taken = sizes.astype(np.uint64) * _FACTOR, np.zeros(count, np.int64)
    lines = np.arange(count)
    padded = np.concatenate([rows, np.full((count, 1), -1, rows.dtype)], axis=1)
    for step in range(int(places.max(initial=0)) + 1):
        words = padded[lines, np.minimum(at, width)]
        words = np.where(at < sizes, words, -1)
        salt = np.uint64((seed * 1_000_003 + step) * int(_FACTOR) % (1 << 64))
        salted = mixed(words.astype(np.uint64) + salt)
        while True:
            due = np.flatnonzero((taken < places.shape[1]) & (places[lines, np.minimum(taken, places.shape[1] - 1)] == step))
            if not len(due):
                break
            total[due] = mixed(total[due] * _FACTOR + words[due].astype(np.uint64) + np.uint64(1))
            taken[due] += 1
        at += ((salted >> np.uint64(40)) & np.uint64(1)).astype(np.int64) * (at < sizes)
    return total


def best_run(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(distance, begin, end) of the run of ``region`` nearest to ``item``; the first of equals."""

    def last_row(one: np.ndarray, other: np.ndarray, free: bool) -> np.ndarray:
        steps = np.arange(len(other) + 1)
        row = np.zeros(len(other) + 1, np.int64) if free else steps.copy()
        for i, word in enumerate(one, 1):
            new = np.minimum(row + 1, np.concatenate([[i], row[:-1] + (other != word)]))
            row = np.minimum.accumulate(new - steps) + steps
        return row

    ends = last_row(item, region, True)
    end = int(np.argmin(ends))
    begins = last_row(item[::-1], region[:end][::-1], False)
    return int(ends[end]), end - int(np.flatnonzero(begins == ends[end])[0]), end


class Finder:
    """The passages of a slice of the benchmark, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], edits: float, recall: float, sampled: int, most: int = 400):
        kept = [(i, w) for i, w in ((i, words_of(t)) for i, t in items) if w]
        self.ids = [i for i, _ in kept]
        self.vocabulary: dict[str, int] = {}
        for _, words in kept:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.items = [np.array([self.vocabulary[w] for w in words], np.int64) for _, words in kept]
        self.sizes = np.array([len(w) for w in self.items], np.int64)
        self.allowed = np.floor(edits * self.sizes + 1e-9).astype(np.int64)
        self.blocks = self._blocks()
        #: Repetitions of each item, and of each size; 0 where all windows are verified.
        self.needs = self._repetitions(recall, sampled, most)
        self.need_of = np.zeros(int(self.sizes.max(initial=0)) + 1, np.int64)
        self.need_of[self.sizes] = self.needs
        self.picks = list(np.random.default_rng(12).random((int(self.needs.max(initial=0)), sampled)))
        self.tables = [self._table(seed, picks) for seed, picks in enumerate(self.picks)]

    def _padded(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full((len(rows), max(map(len, rows), default=1)), -1, np.int64)
        for line, row in zip(out, rows, strict=True):
            line[: len(row)] = row
        return out

    def _blocks(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """length -> (hashes, (item, offset) rows), sorted by hash."""
        found: dict[int, list] = {}
        for item, (words, k) in enumerate(zip(self.items, self.allowed, strict=True)):
            length = len(words) // (k + 1)
            for block in range(k + 1):
                key = gram(words, np.array([block * length]), length)[0]
                found.setdefault(length, []).append((key, item, block * length))
        out = {}
        for length, rows in found.items():
            rows.sort()
            out[length] = np.array([r[0] for r in rows], np.uint64), np.array([r[1:] for r in rows], np.int64)
        return out

    def _repetitions(self, recall: float, sampled: int, most: int, drawn: int = 100, tries: int = 48) -> np.ndarray:
        """Repetitions that ``recall`` asks of each item, 0 where that is more than ``most``.

        Sizes within a quarter of an octave count as one and are judged by ``drawn`` items.
        """
        rng = np.random.default_rng(11)
        needs = np.zeros(len(self.items), np.int64)
        classes = np.floor(4 * np.log2(np.maximum(self.sizes, 1)) + 0.5)
        for one in np.unique(classes):
            of_class = np.flatnonzero(classes == one)
            some = rng.choice(of_class, drawn)
            originals = [self.items[i] for i in some]
            changed = [edited(self.items[i], int(self.allowed[i]), rng, len(self.vocabulary)) for i in some]
            # the window has the item's size, whatever the edits did to the length
            changed = [np.resize(np.append(c, np.zeros(len(o), np.int64)), len(o)) for c, o in zip(changed, originals, strict=True)]
            met, a, b = np.zeros(drawn), self._padded(originals), self._padded(changed)
            for seed in range(tries):
                picks = rng.random(sampled)
                met += walk(a, self.sizes[some], 1000 + seed, picks) == walk(b, self.sizes[some], 1000 + seed, picks)
            missed, need = 1 - (met + 0.25) / (tries + 0.5), 1
            while need <= most and (missed ** need).mean() > 1 - recall:
                need += 1
            needs[of_class] = need if need <= most else 0
        return needs

    def _table(self, seed: int, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        due = np.flatnonzero(self.needs > seed)
        keys = walk(self._padded([self.items[i] for i in due]), self.sizes[due], seed, picks)
        order = np.argsort(keys, kind="stable")
        return keys[order], due[order]

    def find(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, last word), the best run of each text and item."""
        if not self.items:
            return
        number, parts, borders = self.vocabulary.get, [], [0]
        for text in texts:
            parts.append(np.array([*map(number, words_of(text), repeat(0)), 0], np.int64))
            borders.append(borders[-1] + len(parts[-1]))
        ids, borders = np.concatenate(parts), np.array(borders)
        starts, sizes, met = self._windows(ids)
        for at in range(0, len(starts), 20_000):
            met |= self._candidates(ids, borders, starts[at: at + 20_000], sizes[at: at + 20_000])
        yield from self._verified(ids, borders, sorted((item, start) for start, item in met))

    def _windows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, set[tuple[int, int]]]:
        """Distinct (start, size) of the windows around unedited blocks, and (start, item) where none is hashed.

        A start may lie outside the text.
        """
        known = ids != 0
        breaks = np.flatnonzero(~known)
        run = breaks[np.searchsorted(breaks, np.arange(len(ids)))] - np.arange(len(ids))
        found, met = [], set()
        for length, (keys, rows) in self.blocks.items():
            at = np.flatnonzero(run >= length)
            codes = gram(ids, at, length)
            low, high = np.searchsorted(keys, codes, "left"), np.searchsorted(keys, codes, "right")
            hit = np.flatnonzero(high > low)
            many = high[hit] - low[hit]
            entry = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            item, offset = rows[entry, 0], rows[entry, 1]
            start = np.repeat(at[hit], many) - offset
            hashed = self.needs[item] > 0
            met.update(zip(start[~hashed].tolist(), item[~hashed].tolist(), strict=True))
            start, item = start[hashed], item[hashed]
            k = self.allowed[item]
            spread = np.repeat(start - k, 2 * k + 1)
            spread += np.arange(len(spread)) - np.repeat(np.cumsum(2 * k + 1) - (2 * k + 1), 2 * k + 1)
            found.append(np.column_stack([spread, np.repeat(self.sizes[item], 2 * k + 1)]))
        both = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
        return both[:, 0], both[:, 1], met

    def _candidates(self, ids, borders, starts, sizes) -> set[tuple[int, int]]:
        places = starts[:, None] + np.arange(int(sizes.max(initial=1)))
        inside = (np.arange(places.shape[1]) < sizes[:, None]) & (places >= 0) & (places < len(ids))
        rows = np.where(inside, ids[np.clip(places, 0, len(ids) - 1)], -1)
        met = set()
        needs = self.need_of[sizes]
        for seed, (picks, (keys, order)) in enumerate(zip(self.picks, self.tables, strict=True)):
            due = np.flatnonzero(needs > seed)
            if not len(due):
                break
            codes = walk(rows[due], sizes[due], seed, picks)
            low, high = np.searchsorted(keys, codes, "left"), np.searchsorted(keys, codes, "right")
            for hit in np.flatnonzero(high > low).tolist():
                met.update((int(starts[due[hit]]), int(item)) for item in order[low[hit]: high[hit]])
        return met

    def _verified(self, ids, borders, met) -> Iterator[tuple[int, int, int, int, int]]:
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        at = 0
        while at < len(met):
            item, first = met[at]
            last, k, n = first, int(self.allowed[item]), int(self.sizes[item])
            while at + 1 < len(met) and met[at + 1][0] == item and met[at + 1][1] - last <= k:
                at += 1
                last = met[at][1]
            at += 1
            text = int(np.searchsorted(borders, min(max(last, first + n // 2, 0), len(ids) - 1), "right")) - 1
            for t in {text, max(text - 1, 0)}:
                low, high = max(first - k, int(borders[t])), min(last + n + k, int(borders[t + 1]) - 1)
                if low >= high:
                    continue
                distance, begin, end = best_run(self.items[item], ids[low:high])
                found = (distance, low + begin - int(borders[t]), low + end - 1 - int(borders[t]))
                if distance <= k and found < best.get((t, item), (k + 1,)):
                    best[t, item] = found
        for (t, item), (distance, begin, end) in sorted(best.items()):
            yield t, item, distance, begin, end


def gram(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    total = np.full(len(at), length, np.uint64)
    for k in range(length):
        total = mixed(total * _FACTOR + ids[at + k].astype(np.uint64))
    return total


def edited(words: np.ndarray, edits: int, rng: np.random.Generator, vocabulary: int) -> np.ndarray:
    """``words`` after random replacements, insertions and deletions."""
    out = words.tolist()
    for _ in range(edits):
        at, kind = int(rng.integers(0, len(out))), int(rng.integers(0, 3))
        fresh = int(rng.integers(0, vocabulary + 1))
        if kind == 0 and len(out) > 1:
            del out[at]
        elif kind == 1:
            out.insert(at, fresh)
        else:
            out[at] = fresh
    return np.array(out, np.int64)


def finders(
    benchmark: DataFrame, edits: float, recall: float, sampled: int, item_id: str, text: str, slice_chars: int = 8 << 20
) -> list:
    """Broadcast finders, each over a slice of the items of about ``slice_chars`` characters."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    items = items.where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = max(1, -(-size // slice_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    out = []
    for number in range(slices):
        rows = items.where(part == number).collect()  # one slice
        rows = sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        out.append(Shipped(benchmark.sparkSession, Finder(rows, edits, recall, sampled)))
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, edits: float = 0.2, recall: float = 0.99, sampled: int = 3,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``MATCHES``: the nearest run of each document and item within the allowed distance.

    Word places count from 0, both inclusive. An item without words matches nothing, one of
    fewer than 1 / ``edits`` words only unedited. Null, empty and blank texts match nothing;
    null ids are carried; of equal runs the first is reported; repeated rows are matched
    each; repeated items once each id; other columns are ignored; an empty table on either
    side gives no rows.
    """
    shared = finders(benchmark, edits, recall, sampled, item_id, item_text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def of(finder_of) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = finder_of.value
            for ids, texts in text_batches(batches, RUN):
                found = [(ids[t], finder.ids[i], d, len(finder.items[i]), a, b) for t, i, d, a, b in finder.find(texts)]
                if found:
                    names = [c.split()[0] for c in MATCHES.split(", ")]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
            give_back()

        return rows.mapInArrow(run, MATCHES)

    return reduce(DataFrame.unionByName, [of(f) for f in shared])


def contaminated(
    benchmark: DataFrame, text: Column, edits: float = 0.2, recall: float = 0.99, sampled: int = 3,
    item_id: str = "item_id", item_text: str = "text",
) -> Column:
    """Whether a text holds a run within the allowed distance of any item; false for a null text."""

    def of(finder_of) -> Column:
        @F.pandas_udf("boolean")
        def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            finder = finder_of.value
            for batch in texts:
                flags, at = np.zeros(len(batch), bool), 0
                values = [t or "" for t in batch]
                while at < len(values):
                    end, size = at, 0
                    while end < len(values) and size < RUN:
                        size += len(values[end]) + 64
                        end += 1
                    for found in finder.find(values[at:end]):
                        flags[at + found[0]] = True
                    at = end
                yield pd.Series(flags)
            give_back()

        return run(text)

    return reduce(Column.__or__, [of(f) for f in finders(benchmark, edits, recall, sampled, item_id, item_text)])
