"""Stupid-backoff scores of documents, from counts of all n-grams of the other documents.

A text is ``order`` - 1 start marks and its words. With c the counts over all *other*
texts, a word w after the ``order`` - 1 tokens h before it scores c(hw) / c(h) if hw
occurs there, and ``discount`` times its score after one token less if not. After no token
it scores c(w) / N, N being the number of words. A word that occurs nowhere else counts as
met once, at one more discount. A text's score is the sum of the logarithms.

Every word keeps its own 64-bit number, and n-grams of every order their counts, those
met once included. An n-gram is keyed by the ranks of its words where all of them are
among the ``shipped`` commonest, and by a hash otherwise; ranks leave far smaller
differences between sorted keys than hashes do, and which words have one changes no
result. Three steps, two shuffles:

* Tasks cut their texts into chunks of bounded size. A chunk's distinct n-grams of all
  orders are merged with their counts, so that a common n-gram, or one of thousands of
  copies, leaves a chunk once. Sorted, they go to the ranges of the key space as blocks of
  differences in as few bytes as these need.
* Each range adds up its part of the count table and answers every block with the totals
  of its n-grams.
* The answers meet the texts of their chunk. The n-grams are exploded again and joined to
  the totals; the counts of the text itself are taken off, and its scores are summed.

Logarithms are rounded to millionths and summed as integers, so the order of rows
changes no bit.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import Shipped, give_back, mixed, stored
from earshot.llm.lm_scores import batches_of, merged
from earshot.llm.words import text_batches, word_numbers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ODD, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x2545F4914F6CDD1D)
_HASHED = np.uint64(1 << 63)
#: Bits of a rank; three ranks make a key. Rank 0 is a word without one, 1 the start mark.
BITS, START, FIRST = 17, 1, 2
#: Rows on the way: a chunk's texts (block is null) and its blocks. A chunk's number is negative.
BLOCKS = "route long, chunk long, block long, first long, keys binary, counts binary"
ANSWERS = "chunk long, block long, counts binary"
SCORES = "doc_id long, n_words long, n_backed_off long, log_score_micro long"


def packed(raw: bytes) -> bytes:
    return struct.pack("<I", len(raw)) + pa.compress(raw, "zstd", asbytes=True)


def unpacked(raw: bytes) -> bytes:
    return pa.decompress(raw[4:], struct.unpack_from("<I", raw)[0], "zstd", asbytes=True)


class Ranks:
    """Ranks of common words, and how the keys made of them are spread over ranges."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        """``words`` from the commonest on."""
        order = np.argsort(words)
        self.words, self.ranks = words[order], order + FIRST
        weights = np.concatenate([[0.5, counts.max(initial=1)], counts]).astype(np.float64)
        self.share = weights / weights.sum()
        self.before = np.cumsum(self.share) - self.share

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        place = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[place] == words, self.ranks[place], 0)

    def ranges(self, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of words or 4 for a hash, range) of sorted keys; a key has one range wherever it is met.

        Keys of ranks are spread as if words were independent.
        """
        kind = 1 + np.searchsorted(np.array([1 << BITS, 1 << 2 * BITS, 1 << 63], np.uint64), keys, "right")
        at = np.empty(len(keys))
        at[kind == 1] = keys[kind == 1] / (1 << BITS)
        at[kind == 4] = (keys[kind == 4] - _HASHED) / float(1 << 63)
        for n in (2, 3):
            some = keys[kind == n]
            inner = np.zeros(len(some))
            for back in range(n):
                rank = (some >> np.uint64(BITS * back) & np.uint64((1 << BITS) - 1)).astype(np.int64)
                inner = self.before[rank] + self.share[rank] * inner
            at[kind == n] = inner
        return kind, np.clip((at * buckets).astype(np.int64), 0, buckets - 1)


def grams(
    numbers: np.ndarray, borders: np.ndarray, order: int, ranks: Ranks
) -> tuple[np.ndarray, list[np.ndarray]]:
    """(text of every word, [keys of the n-grams that end in each word, for order 1, 2, ...])."""
    sizes = np.diff(borders)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(numbers)) - np.repeat(borders[:-1], sizes)
    tokens, known = [numbers], [ranks.of(numbers)]
    for back in range(1, order):
        token, rank = np.full(len(numbers), _START, np.uint64), np.full(len(numbers), START, np.int64)
        inside = place[back:] >= back
        token[back:][inside], rank[back:][inside] = numbers[:-back][inside], known[0][:-back][inside]
        tokens.append(token)
        known.append(rank)

    def key(n: int) -> np.ndarray:
        total, ranked, dense = np.zeros(len(numbers), np.uint64), np.zeros(len(numbers), np.uint64), np.ones(len(numbers), bool)
        for back in range(n - 1, -1, -1):
            total = mixed(total * _ODD + tokens[back])
            ranked = (ranked << np.uint64(BITS)) + known[back].astype(np.uint64)
            dense &= known[back] > 0
        return np.where(dense & (n <= 3), ranked, total | _HASHED)

    return row, [key(n) for n in range(1, order + 1)]


def opening(order: int) -> np.ndarray:
    """Contexts that are no n-grams: none at all, and start marks alone."""
    out, total, ranked = [0], np.zeros(1, np.uint64), 0
    for n in range(1, order):
        total, ranked = mixed(total * _ODD + _START), (ranked << BITS) + START
        out.append(ranked if n <= 3 else int((total | _HASHED)[0]))
    return np.array(out, np.uint64)


def chunk_counts(borders: np.ndarray, each: list, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams and contexts of a chunk, with their counts."""
    keys, counts = np.unique(np.concatenate(each), return_counts=True)
    sizes = np.diff(borders)
    if not sizes.any():
        return keys, counts
    keys = np.append(keys, opening(order))
    counts = np.concatenate([counts, [sizes.sum()], np.full(order - 1, np.count_nonzero(sizes))])
    by_key = np.argsort(keys, kind="stable")
    return keys[by_key], counts[by_key]


def narrow(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs, all lowest bytes first."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + packed(planes.T.tobytes())


def widened(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(unpacked(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


def common_words(rows: DataFrame, most: int, flush: int = 2 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, counts) of at most ``most`` of the commonest words of all texts, from the commonest on.

    Every task counts all its words in a bounded table and hands on its ``most`` commonest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def largest(most: int) -> tuple[np.ndarray, np.ndarray]:
            words, counts = merged(parts)
            best = np.argsort(-counts, kind="stable")[:most]
            return words[best], counts[best]

        for _, texts in text_batches(batches):
            parts.append(np.unique(word_numbers(texts)[0], return_counts=True))
            held += len(parts[-1][0])
            if held >= flush:
                parts = [largest(max(most, flush // 2))]
                held = len(parts[0][0])
        if parts:
            words, counts = largest(most)
            yield from batches_of(words[counts > 1], counts[counts > 1])

    named = rows.select(F.lit(0).alias("none"), "text").mapInArrow(run, "key long, n long")
    named = stored(named.groupBy("key").agg(F.sum("n").alias("n")), "common-words")
    step = F.floor(F.log2("n") * 8)
    level, total = 0, 0
    for row in named.groupBy(step.alias("level")).count().orderBy(F.desc("level")).collect():  # a few hundred levels
        total += row["count"]
        if total > most:
            level = row["level"] + 1
            break
    rows = named.where(step >= level).orderBy(F.desc("n"), "key").toPandas()  # ``most`` at most
    return rows["key"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)


def exploded(rows: DataFrame, order: int, ranks: Shipped, buckets: int, chunk_chars: int) -> DataFrame:
    """``BLOCKS``: texts with the number of their chunk, and the chunk's n-grams by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, table = TaskContext.get().partitionId(), ranks.value
        for ordinal, (ids, texts) in enumerate(text_batches(batches, chunk_chars)):
            numbers, borders = word_numbers(texts)
            keys, counts = chunk_counts(borders, grams(numbers, borders, order, table)[1], order)
            # a chunk that a repeated task cuts otherwise gets another number, so that no answer is mistaken
            own = mixed(np.array([(task << 32) + ordinal], np.uint64) + (keys * counts.astype(np.uint64)).sum(dtype=np.uint64))
            chunk = int((own | _HASHED).view(np.int64)[0])
            for at in range(0, len(texts), 5000):
                part = pa.record_batch([pa.array(ids[at: at + 5000], pa.int64()), pa.array(texts[at: at + 5000], pa.string())], ["doc_id", "text"])
                with pa.BufferOutputStream() as out:
                    with pa.ipc.new_stream(out, part.schema) as writer:
                        writer.write_batch(part)
                    raw = packed(out.getvalue().to_pybytes())
                yield blocks([chunk], chunk, None, [None], [raw], [None])
            if not len(keys):
                continue
            kind, place = table.ranges(keys, buckets)
            cuts = np.flatnonzero(np.diff(kind * buckets + place, prepend=-1))
            ends = np.append(cuts[1:], len(keys))
            for at in range(0, len(cuts), 500):
                a, b = cuts[at: at + 500], ends[at: at + 500]
                yield blocks(
                    place[a], chunk, np.arange(at, at + len(a)), keys[a].view(np.int64),
                    [narrow(np.diff(keys[i:j], prepend=keys[i])) for i, j in zip(a.tolist(), b.tolist(), strict=True)],
                    [narrow(counts[i:j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)],
                )
        give_back()

    def blocks(route, chunk, block, first, keys, counts) -> pa.RecordBatch:
        n = len(keys)
        number = pa.nulls(n, pa.int64()) if block is None else pa.array(block, pa.int64())
        return pa.record_batch([
            pa.array(route, pa.int64()), pa.array([chunk] * n, pa.int64()), number, pa.array(first, pa.int64()),
            pa.array(keys, pa.binary()), pa.array(counts, pa.binary()),
        ], ["route", "chunk", "block", "first", "keys", "counts"])

    return rows.mapInArrow(run, BLOCKS)


def answered(rows: DataFrame) -> DataFrame:
    """``ANSWERS``: totals of the n-grams of every block, in the block's order; texts pass in ``counts``."""

    def run(group: pa.Table) -> pa.Table:
        if group["block"][0].as_py() is None:
            return pa.table([group["chunk"], group["block"], group["keys"]], ["chunk", "block", "counts"])
        firsts = group["first"].to_numpy().view(np.uint64)
        keys = [np.cumsum(widened(raw), dtype=np.uint64) + f for raw, f in zip(group["keys"].to_pylist(), firsts, strict=True)]
        counts = np.concatenate([widened(raw) for raw in group["counts"].to_pylist()])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(int(place.max()) + 1, np.uint64)
        np.add.at(totals, place, counts)
        each = np.split(totals[place], np.cumsum([len(k) for k in keys])[:-1])
        return group.select(["chunk", "block"]).append_column("counts", pa.array([narrow(t) for t in each], pa.binary()))

    return rows.groupBy("route").applyInArrow(run, ANSWERS)


def micro(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log(counts) * 1e6 + 0.5).astype(np.int64)


def chunk_scores(texts: list, totals: np.ndarray, order: int, ranks: Ranks, discount: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, words that back off, score in millionths) of each text of a chunk."""
    numbers, borders = word_numbers(texts)
    sizes = np.diff(borders)
    if not len(numbers):
        return sizes, np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    row, each = grams(numbers, borders, order, ranks)
    keys, place = np.unique(np.concatenate([*each, opening(order)]), return_inverse=True)
    del each
    if len(keys) != len(totals):
        raise RuntimeError("a chunk of texts was cut otherwise on a second run: store the table before scoring it")
    totals, width = totals.astype(np.int64), len(keys)
    words, *first_contexts = totals[place[order * len(numbers):]]
    seen = []
    for n in range(order):
        gram = place[n * len(numbers): (n + 1) * len(numbers)]
        _, pair, own = np.unique(row * width + gram, return_inverse=True, return_counts=True)
        seen.append(totals[gram] - own[pair])
    del place, keys
    first = borders[:-1][sizes > 0]
    score, depth = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    open_ = np.ones(len(numbers), bool)
    step = micro(np.array([discount]))[0]

    def others(n: int) -> np.ndarray:
        """How often the n tokens before each word occur in other texts: as the n-gram of the word before."""
        if n == 0:
            return words - sizes[row]
        out = np.roll(seen[n - 1], 1)
        out[first] = first_contexts[n - 1] - 1  # start marks alone: once in every text
        return out

    for n in range(order, 0, -1):
        here = np.flatnonzero(open_ & (seen[n - 1] > 0))
        score[here] = micro(seen[n - 1][here]) - micro(others(n - 1)[here]) + (order - n) * step
        depth[here] = order - n
        open_[here] = False
    if open_.any():
        rest = np.flatnonzero(open_)
        score[rest] = order * step - micro(np.maximum(others(0)[rest], 1))
        depth[rest] = order
    total, backed = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    np.add.at(total, row, score)
    np.add.at(backed, row, depth > 0)
    return sizes, backed, total


def ngram_scores(
    docs: DataFrame, order: int = 3, discount: float = 0.4, doc_id: str = "doc_id", text: str = "text",
    shipped: int = 65_536, chunk_chars: int = 4 << 20, bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """(doc_id, n_words, n_backed_off, log_score_micro, mean_log_score): natural logarithms; the mean is per word.

    The counts are those of the other rows of ``docs``, equal texts in other rows included;
    ``n_backed_off`` words were not met after their ``order`` - 1 predecessors there.
    Null, empty and blank texts have no words, a score of 0 and no mean; of rows that share
    a ``doc_id`` (null included) the sums are given; a very long text is a chunk of its own;
    other columns are ignored; an empty table gives no rows. ``shipped`` bounds a broadcast,
    ``chunk_chars`` and ``bucket_bytes`` the memory of a task; none changes a result.
    """
    if order < 1 or not 0 < discount <= 1 or not 0 <= shipped < (1 << BITS) - FIRST:
        raise ValueError("order, discount or shipped out of range")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))

    words, counts = common_words(rows, shipped)
    ranks = Shipped(docs.sparkSession, Ranks(words, counts))

    def score(chunk: pa.Table) -> pa.Table:
        blocks = chunk.filter(pc.is_valid(chunk["block"])).sort_by("block")
        totals = np.concatenate([np.empty(0, np.uint64), *map(widened, blocks["counts"].to_pylist())])
        raws = chunk.filter(pc.is_null(chunk["block"]))["counts"].to_pylist()
        texts = pa.concat_tables([pa.ipc.open_stream(unpacked(raw)).read_all() for raw in raws])
        sums = chunk_scores(texts["text"].to_pylist(), totals, order, ranks.value, discount)
        give_back()
        return pa.table([texts["doc_id"].combine_chunks(), *(pa.array(s, pa.int64()) for s in sums)],
                        names=["doc_id", "n_words", "n_backed_off", "log_score_micro"])

    answers = answered(exploded(rows, order, ranks, buckets, chunk_chars))
    scored = answers.groupBy("chunk").applyInArrow(score, SCORES)
    summed = scored.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("n_words", "n_backed_off", "log_score_micro")))
    mean = F.col("log_score_micro") / F.lit(1e6) / F.nullif("n_words", F.lit(0))
    return summed.withColumn("mean_log_score", mean)
