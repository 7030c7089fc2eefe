"""Packs token ids into equal training windows by multiway differencing.

A document becomes a run of ids plus an end id. Whole windows are cut off its
front; what remains is cut into pieces of at most ``piece`` ids. Pieces are pooled
within a task until they fill ``ways`` windows, and Karmarkar-Karp differencing
spreads a pool over its windows: every piece starts as a partial partition with one
loaded window, and the two partitions with the largest spread are merged again and
again, the fullest window of one with the emptiest of the other. The loads come out
nearly equal. If a window exceeds the capacity after all, the pool is spread over
one window more.

No shuffle is needed and no task holds more than one batch of texts and one pool.
The last pool of a task fills fewer windows, so the padding is ``margin`` ids a
window plus less than one window a task.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import give_back
from earshot.llm.words import text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])

#: Characters of text that are encoded at once.
RUN = 1 << 20

#: Characters whose case, normal form and class no library version disputes.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The tokenizer file's own cut of a lower-cased word, over those characters.
_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class Kept(dict):
    """string -> ids as ``make`` gives them, at most ``keep`` bytes; an entry counts for 160 more.

    Half of the room is for the entries put last. When it is full they become the older
    half, whose entries return when asked for; so common strings stay.
    """

    def __init__(self, keep: int, make: Callable[[str], bytes]):
        super().__init__()
        self.room, self.held, self.older, self.make = keep // 2, 0, {}, make

    def __missing__(self, name: str) -> bytes:
        ids = self.older.get(name)
        if ids is None:
            ids = self.make(name)
        size = len(name) + len(ids) + 160
        if size > self.room:
            return ids
        if self.held + size > self.room:
            self.older, self.held = dict(self), 0
            self.clear()
        self[name] = ids
        self.held += size
        return ids


class WordEncoder:
    """Ids of whole texts from ids of words, exactly as the tokenizer file gives them.

    The file's normaliser and splitter never look across a blank or a line feed, so
    the ids of a text are those of its words in turn. Words of plain characters are
    cut and looked up piece by piece; every other word (combining marks, foreign
    scripts, the special strings) goes through the whole tokenizer. Both tables are
    caches of ``keep`` bytes each, which only save time; they hold no reference to the
    encoder, so that they go with it at once.
    """

    def __init__(self, path: str, keep: int = 128 << 20):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenize, encode = tokenizer.model.tokenize, tokenizer.encode
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = (b for b in range(256) if b not in visible)
        byte_names = {b: 256 + i for i, b in enumerate(hidden)}
        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        special = re.compile("|".join(map(re.escape, specials)) or "(?!)").search
        shortest = min(map(len, specials), default=0)

        def of_piece(piece: str) -> bytes:
            # visible ASCII characters are their own names
            name = piece if piece.isascii() else piece.encode().decode("latin-1").translate(byte_names)
            return np.array([t.id for t in tokenize(name)], "<u4").tobytes()

        def of_word(word: str) -> bytes:
            plain = word.isascii() and word.isprintable() or _PLAIN.fullmatch(word)
            if plain and (len(word) < shortest or not special(word)):
                if word.isalpha():  # the cut takes a run of letters whole
                    return pieces[word.lower()]
                return b"".join([pieces[p] for p in _CUT.findall(word.lower())])
            return np.array(encode(word, add_special_tokens=False).ids, "<u4").tobytes()

        self.pieces = pieces = Kept(keep, of_piece)
        self.words = Kept(keep, of_word)

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids, joined."""
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text.

        A word is looked up once for all texts given, so that most of the work is on
        arrays and few lookups go all over the caches.
        """
        lists = pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.large_string()), " ")
        words = lists.flatten().dictionary_encode()
        ids = [self.words[word] for word in words.dictionary.to_numpy(zero_copy_only=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(lengths) - lengths
        codes = words.indices.to_numpy()
        length = lengths[codes]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
        places = np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], length)
        found = np.frombuffer(b"".join(ids), "<u4")[places]
        borders = ends[lists.offsets.to_numpy()].tolist()
        return [found[i:j].tobytes() for i, j in pairwise(borders)]


def differencing(sizes: list[int], ways: int) -> tuple[list[int], int]:
    """The window of each size, and the largest load, by Karmarkar-Karp differencing."""
    heap: list = []
    for item, size in enumerate(sizes):
        loads = np.zeros(ways, np.int64)
        loads[0] = size
        heap.append((-size if ways > 1 else 0, item, loads, item))
    heapq.heapify(heap)
    fresh = len(sizes)
    while len(heap) > 1:
        _, _, big, left = heapq.heappop(heap)
        _, _, small, right = heapq.heappop(heap)
        loads = big + small[::-1]
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        loads -= loads[-1]
        heapq.heappush(heap, (-int(loads[0]), fresh, loads, (left, right, order)))
        fresh += 1
    window = [0] * len(sizes)
    todo = [(heap[0][3], np.arange(ways))] if heap else []
    while todo:
        node, labels = todo.pop()
        if isinstance(node, int):
            window[node] = int(labels[0])
            continue
        left, right, order = node
        of_left = np.empty_like(labels)
        of_left[order] = labels
        todo += [(left, of_left), (right, of_left[::-1])]
    most = int(np.bincount(window, weights=sizes, minlength=1).max()) if sizes else 0
    return window, most


def spread(sizes: list[int], capacity: int) -> list[int]:
    """The window of each size so that none exceeds ``capacity``; the count rises until that holds."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        window, most = differencing(sizes, ways)
        if most <= capacity:
            return window
        ways += 1


class _Rows:
    """Output rows, handed on in record batches of bounded size."""

    def __init__(self, most_bytes: int = 8 << 20):
        self.most, self.size, self.rows = most_bytes, 0, []

    def add(self, *row) -> None:
        self.rows.append(row)
        self.size += len(row[-1]) + 56

    def full(self) -> Iterator[pa.RecordBatch]:
        if self.size >= self.most:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)
            self.rows, self.size = [], 0


def pack(
    docs: DataFrame, encoder: Callable[[], Callable[[str], bytes]], end_id: int = 1, capacity: int = 2048,
    piece: int = 256, ways: int = 64, margin: int = 14, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    ``encoder()`` is called once a task and gives the function text -> joined ids; if that has
    a method ``many``, texts -> list of joined ids, it is called for some texts at a time.
    Returns ``PIECES``: ids [start, start + length) of a document lie at ``offset`` of
    ``sequence_id``; every id lies in exactly one piece.

    Null or empty text is a document of the end id alone; a null ``doc_id`` is carried
    along; repeated rows are documents of their own; other columns are ignored; an
    empty table gives no rows. Sequence ids hold the partition number, so ``docs``
    should be a stored or scanned table, whose partitions repeat when a task is rerun.
    """
    pool_ids = ways * (capacity - margin)
    if not 0 < piece <= capacity or pool_ids <= piece:
        raise ValueError("a piece must fit a window, and a pool more than one piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, end = encoder(), _Rows(), np.array([end_id], "<u4").tobytes()
        base, made = TaskContext.get().partitionId() << 33, 0
        pool: list[tuple] = []
        pooled = 0

        def close() -> int:
            places = spread([p[2] for p in pool], capacity)
            offsets = [0] * (max(places) + 1)
            for (doc, start, length, total, ids), place in zip(pool, places, strict=True):
                out.add(doc, start, length, total, base + made + place, offsets[place], ids)
                offsets[place] += length
            return len(offsets)

        many = getattr(encode, "many", None) or (lambda texts: [encode(text) for text in texts])
        for docs_in, texts in text_batches(batches, RUN):
            for doc, ids in zip(docs_in, many(texts), strict=True):
                ids += end
                total = len(ids) // 4
                start = 0
                while total - start >= capacity:
                    out.add(doc, start, capacity, total, base + made, 0, ids[4 * start: 4 * (start + capacity)])
                    made, start = made + 1, start + capacity
                    yield from out.full()
                while start < total:
                    length = min(piece, total - start, pool_ids - pooled)
                    pool.append((doc, start, length, total, ids[4 * start: 4 * (start + length)]))
                    start, pooled = start + length, pooled + length
                    if pooled == pool_ids:
                        made += close()
                        pool, pooled = [], 0
                        yield from out.full()
        if pool:
            made += close()
        yield from out.rest()
        del encode, many, pool
        give_back()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)
