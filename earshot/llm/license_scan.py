"""License notices in documents: MinHash bands over overlapping windows, then exact containment.

Texts are words (a-z and 0-9, lower case) and notices are sets of five-word shingles. A
document holds a notice if a window of its words contains at least ``share`` of the
notice's shingles. For notices of n words the windows are n + step words long and start
every ``step`` = n / 4 words, so each run of n words lies whole in one of them.

Such a window has a known least Jaccard similarity to the notice, and so a least
probability that one MinHash value agrees. A band is one value, and there are as many bands
as make a window that holds the notice collide with probability ``certainty``.
Windows that collide are compared shingle by shingle.

Texts are cut into windows a run of words at a time, so a task's memory follows the run and the
text itself. Only documents with one of a few telling words are cut into windows: the words are
chosen so that every shingle of every notice has one, hence no match is lost. Only
DataFrame operations; the notices, an argument, are the only side shipped to tasks.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.text import bind

SHINGLE = 5

#: Common license notices in their usual short wording.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "gpl-2.0": "licensed under the GNU General Public License, version 2",
    "lgpl-3.0": "licensed under the GNU Lesser General Public License, version 3",
    "agpl-3.0": "licensed under the GNU Affero General Public License, version 3",
    "mpl-2.0": "subject to the terms of the Mozilla Public License, version 2.0",
    "bsd": "Use of this source code is governed by a BSD-style license",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0",
    "cc0-1.0": "dedicated to the public domain under CC0 1.0 Universal",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


#: Words too common to tell a notice from other text.
COMMON = frozenset("a and any by for from in into is of or other the this to under use with without".split())


def notice_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def shingles(words: list[str]) -> list[str]:
    return sorted({" ".join(words[i: i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)})


def telling_words(notices: dict[str, str]) -> list[str]:
    """Words of which every shingle has at least one: uncommon, long and in many shingles if possible."""
    open_ = {s for text in notices.values() for s in shingles(notice_words(text))}
    chosen = []
    while open_:
        cover: dict[str, int] = {}
        for shingle in open_:
            for word in set(shingle.split(" ")):
                cover[word] = cover.get(word, 0) + 1
        best = max(cover, key=lambda w: (w not in COMMON, min(len(w), 7), cover[w], w))
        chosen.append(best)
        open_ = {s for s in open_ if best not in s.split(" ")}
    return chosen


def step_of(size: int) -> int:
    return max(1, size // 4)


def bands_needed(size: int, share: float, certainty: float) -> int:
    """Bands that let a window with ``share`` of a notice of ``size`` words collide almost surely."""
    of_notice, of_window = size - SHINGLE + 1, size + step_of(size) - SHINGLE + 1
    common = math.ceil(share * of_notice - 1e-9)
    alike = common / (of_notice + of_window - common)
    return 1 if alike >= 1 else math.ceil(math.log(1 - certainty) / math.log(1 - alike))


def band_hashes(grams: Column, size: Column, bands: dict[int, int]) -> Column:
    """One hash per band: of the notice size, the band's number and the least hash of a shingle under it."""
    count = F.coalesce(*[F.when(size == n, F.lit(b)) for n, b in sorted(bands.items())])

    def one(band: Column) -> Column:
        return F.xxhash64(size, band, F.array_min(F.transform(grams, lambda gram: F.xxhash64(band, gram))))

    return F.transform(F.sequence(F.lit(1), count), one)


def text_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def grams_of(words: Column) -> Column:
    """Distinct shingles of an array of words; empty for fewer words than one shingle has."""
    places = F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1))
    runs = F.transform(places, lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))
    return F.when(F.size(words) >= SHINGLE, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


#: Words of a text that are cut into windows at once.
CHUNK = 16_384


def chunks_of(words: Column, longest: int) -> Column:
    """(begin, n, words): runs of ``CHUNK`` words, each with what windows that start in it need beyond it."""

    def one(begin: Column) -> Column:
        own = F.slice(words, begin + 1, CHUNK + longest)
        return F.struct(begin.alias("begin"), F.size(words).alias("n"), own.alias("words"))

    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(CHUNK)), one)


def windows_of(chunk: Column, size: int) -> Column:
    """(size, start, run) of the overlapping windows for notices of ``size`` words that start in a chunk."""
    step = step_of(size)
    first = F.ceil(chunk["begin"] / F.lit(step)).cast("int") * step
    last = F.least(chunk["begin"] + (CHUNK - 1), F.greatest(chunk["n"] - size, F.lit(0)))
    starts = F.when(first <= last, F.sequence(first, F.greatest(first, last), F.lit(step))).otherwise(F.array().cast("array<int>"))

    def one(start: Column) -> Column:
        run = F.slice(chunk["words"], start - chunk["begin"] + 1, size + step)
        return F.struct(F.lit(size).alias("size"), start.alias("start"), run.alias("run"))

    return F.transform(starts, one)


def notice_table(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    """(license_id, notice_size, notice), made of constants."""
    rows = []
    for name, text in notices.items():
        words = notice_words(text)
        grams = F.array(*map(F.lit, shingles(words)))
        rows.append(F.struct(F.lit(name).alias("license_id"), F.lit(len(words)).alias("notice_size"), grams.alias("notice")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan(
    docs: DataFrame, notices: dict[str, str] | None = None, share: float = 0.8, certainty: float = 0.9999,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, license_id, containment, first_word): the best window of each document and notice.

    ``containment`` is the share of the notice's shingles in that window, ``first_word`` the
    window's place in the text, counted in words from 0; of equal windows the first.
    Notices must have at least five words. Null, empty and short texts hold nothing; rows that
    share an id (null included) are one document; other columns are ignored; an empty table
    gives no rows.
    """
    notices = NOTICES if notices is None else notices
    if not notices:
        raise ValueError("no notices to look for")
    sizes = {len(notice_words(notice)) for notice in notices.values()}
    if min(sizes) < SHINGLE:
        raise ValueError(f"a notice has fewer than {SHINGLE} words")
    bands = {size: bands_needed(size, share, certainty) for size in sizes}
    marks = telling_words(notices)

    def telling(lowered: Column) -> Column:
        found = F.lit(False)
        for word in marks:
            found = found | lowered.contains(word)
        return found

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where(bind(F.lower(F.col("text")), telling)).select("doc_id", text_words(F.col("text")).alias("words"))
    held = F.array(*map(F.lit, marks))
    rows = rows.where(F.arrays_overlap("words", held))
    longest = max(size + step_of(size) for size in sizes)
    rows = rows.select("doc_id", F.explode(bind(F.col("words"), lambda words: chunks_of(words, longest))).alias("chunk"))
    rows = rows.where(F.arrays_overlap("chunk.words", held))

    def windows(chunk: Column) -> Column:
        """All windows of all sizes that start in a chunk, as (size, start, run)."""
        every = [windows_of(chunk, size) for size in sorted(sizes)]
        return F.filter(F.concat(*every), lambda w: F.arrays_overlap(w["run"], held) & (F.size(w["run"]) >= SHINGLE))

    cut = rows.select("doc_id", F.explode(windows(F.col("chunk"))).alias("window"))

    def banded(window: Column) -> Column:
        """The window's shingles with each of its bands; the shingles are made once."""
        def of(grams: Column) -> Column:
            hashes = band_hashes(grams, window["size"], bands)
            return F.transform(hashes, lambda band: F.struct(band.alias("band"), grams.alias("grams")))
        return bind(grams_of(window["run"]), of)

    cut = cut.select("doc_id", "window.size", "window.start", F.inline(banded(F.col("window"))))
    own = notice_table(docs.sparkSession, notices)
    own = own.withColumn("band", F.explode(band_hashes(F.col("notice"), F.col("notice_size"), bands)))
    met = cut.join(F.broadcast(own), "band").where("size = notice_size")  # notices x bands
    common = F.size(F.array_intersect("grams", "notice")) / F.size("notice")
    candidates = met.select("doc_id", "license_id", "start", common.alias("containment")).where(F.col("containment") >= share)
    best = F.max(F.struct("containment", (-F.col("start")).alias("place"))).alias("best")
    found = candidates.groupBy("doc_id", "license_id").agg(best)
    return found.select(
        "doc_id", "license_id", F.col("best.containment").alias("containment"),
        (-F.col("best.place")).cast("long").alias("first_word"),
    )
