"""Fill-in-the-middle examples: a text cut at two line ranks and written in another order.

The lines of a text (each with its line feed) are the units of an indexable skip list.
Every node of a lane carries two widths, the units and the code points it covers, so a
descent that adds up unit widths reaches a cut rank exactly and knows the code points
before it without walking over the lines.

Defined cases: a null text is an empty one; empty texts, texts that hold one of the marks
and texts not drawn by ``rate`` are ``plain`` and come out as they are, with null piece
lengths. Repeated rows give repeated results; a null id draws as an empty one. Texts are
worked through whole, however long, in runs of about four million characters, so memory
follows the longest text. Other columns of ``docs`` are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.text import bind
from earshot.llm.common import mixed
from earshot.llm.words import text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"


@dataclass(frozen=True)
class Marks:
    """The strings written before the prefix, the suffix and the middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        for a in self.all:
            if not a:
                raise ValueError("a mark must not be empty")
            for b in self.all:
                whole = a in b if a is not b else False
                if whole or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)))):
                    raise ValueError(f"marks {a!r} and {b!r} overlap: a text could not be told from its marks")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def unit_points(text: str) -> np.ndarray:
    """Code points of each line of a text, its line feed included."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return np.empty(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(data[:-1] == 10) + 1])
    return np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)


class Lanes:
    """An indexable skip list over the units of one text.

    Lane 0 holds every unit; a node rises to the next lane with chance 1 in
    ``2**bits``, drawn from its place, and the first node rises always. ``units`` and
    ``points`` of a node cover everything up to the next node of its lane.
    """

    def __init__(self, points: np.ndarray, bits: int = 2, top: int = 8):
        places = np.arange(len(points), dtype=np.int64)
        coins = mixed(places.astype(np.uint64) + np.uint64(1))
        units, down = np.ones(len(points), np.int64), places
        self.lanes = [(units, points, down)]
        while len(places) > top and len(self.lanes) * bits < 64:
            low = (np.uint64(1) << np.uint64(bits * len(self.lanes))) - np.uint64(1)
            rises = (coins[places] & low) == 0
            rises[0] = True
            down = np.flatnonzero(rises)
            if len(down) == len(places):
                break
            places, units, points = places[down], np.add.reduceat(units, down), np.add.reduceat(points, down)
            self.lanes.append((units, points, down))

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        node = passed = reached = 0
        for units, points, down in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                reached += int(points[node])
                node += 1
            if node == len(units):
                break
            node = down[node]
        return reached


def draws(key: str, seed: int) -> list[int]:
    """Four 32-bit numbers that depend on the seed and the id alone."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


def infilled(
    key: str, text: str, marks: Marks, seed: int, rate: int, suffix_rate: int
) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and middle, output) of one text."""
    points = unit_points(text)
    n = len(points)
    h1, h2, h3, h4 = draws(key, seed)
    if not n or h3 % 100 >= rate or any(mark in text for mark in marks.all):
        return n, PLAIN, None, None, text
    lanes = Lanes(points)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = lanes.points_before(first), lanes.points_before(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_rate:
        parts = (marks.suffix, suffix, marks.prefix, prefix, marks.middle, middle)
        return n, SUFFIX_FIRST, a, b - a, "".join(parts)
    return n, PREFIX_FIRST, a, b - a, "".join((marks.prefix, prefix, marks.suffix, suffix, marks.middle, middle))


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", marks: Marks = Marks(),
    seed: int = 7, rate: int = 100, suffix_rate: int = 50,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``rate`` per cent of the texts are cut, ``suffix_rate`` per cent of those begin with
    the suffix. No shuffle: a text is read, cut and written where it lies.
    """

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches):
            rows = [
                infilled("" if k is None else str(k), t, marks, seed, rate, suffix_rate)
                for k, t in zip(ids, texts, strict=True)
            ]
            n, form, prefix, middle, output = map(list, zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, kind), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string()),
                ],
                names=["key", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    spark_type = rows.schema["key"].dataType
    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(spark_type.simpleString())
    if kind is None:
        raise TypeError(f"an id is an integer or a string, not {spark_type.simpleString()}")
    schema = (
        f"key {spark_type.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    )
    return rows.mapInArrow(transform, schema).withColumnRenamed("key", key)


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text an output was made from, from the output and its form alone."""
    borders = "|".join(re.escape(mark) for mark in marks.all)

    def joined(p: Column) -> Column:
        suffix_first = F.concat(F.get(p, 2), F.get(p, 3), F.get(p, 1))
        return F.when(form == SUFFIX_FIRST, suffix_first).otherwise(F.concat(F.get(p, 1), F.get(p, 3), F.get(p, 2)))

    return F.when(form == PLAIN, output).otherwise(bind(F.split(output, borders, -1), joined))
