"""Documents whose sets of word n-grams have a Jaccard similarity above a threshold.

A size-aware join in the heavy-light manner. All sets are put in one global order, rare
shingles first; similar sets then share shingles early in that order.

* Small sets enumerate fixed-size subsets: two similar sets share at least two shingles
  of their first ``n - ceil(t n) + 2``, so every pair of those is a key.
* Large sets use inverted lists: they share at least one of the first
  ``n - ceil(t n) + 1``, each of which is a key. Small sets near the boundary are put on
  the lists too, for partners beyond it.
* The boundary is the size at which a subset row stops being cheaper than scanning the
  list of a single shingle, whose expected length is measured on the corpus.

Equal sets are collapsed first. The lists then serve repeatedly, so that no group is
ever expanded into its pairs: first every document is compared with the first of its
lists and components are formed; then, in a few rounds, with a few members of the largest
component on its lists; and in the end all documents of different components that meet
on a list are compared. All comparisons are exact, and no link between components can be
lost: a pair in one component needs none, any other pair is compared if it shares a key.

Before two sets are brought together their parity bitmaps are: a bit per shingle is flipped,
so the bits in which two bitmaps differ are at most the shingles in which the sets do.
A bitmap has two to four bits for each shingle of a document, so this is a small part of the
traffic of whole sets, and it rules out almost all pairs that are not near. It never rules
out one that is.

The order comes from a table of ``2 ** BITS`` counters (a fixed size) of hashed shingle
occurrences over all documents; collisions only change the order, never the result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm.common import give_back, mixed, sized_broadcast, stored
from earshot.llm.components import components
from earshot.llm.words import text_batches, word_numbers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of text that are worked on at once.
RUN = 1 << 18
#: log2 of the number of occurrence counters, and how many travel in one row.
BITS, BLOCK = 20, 1 << 12
_SETS = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("digest_a", pa.int64()), ("digest_b", pa.int64()),
    *[(f"s{i}", pa.int64()) for i in range(4)], ("bitmap", pa.binary()),
    ("block", pa.int32()), ("part", pa.int32()), ("counts", pa.binary()),
])
_SIGNS = [f"s{i}" for i in range(4)]
_KEYS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("rest", pa.int32())])


def shingle_sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles of each text in hash order, borders); a shorter text is one shingle."""
    numbers, borders = word_numbers(texts)
    counts = np.diff(borders)
    whole = np.zeros(len(numbers) + 1, np.uint64)  # shingle that starts at each word
    with np.errstate(over="ignore"):
        for k in range(words):
            part = mixed(numbers + np.uint64(k + 1) * np.uint64(0xA24BAED4963EE407))
            whole[: max(len(numbers) - k, 0)] += part[k:] * np.uint64(2 * k + 1)
    starts = np.maximum(counts - words + 1, 0)
    row = np.repeat(np.arange(len(texts)), starts)
    first = np.concatenate([[0], np.cumsum(starts)])
    place = np.arange(first[-1]) - np.repeat(first[:-1], starts) + np.repeat(borders[:-1], starts)
    shingles = mixed(whole[place])
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        one = [mixed(np.array([_fold(numbers[borders[i]: borders[i + 1]])], np.uint64))[0] for i in short]
        row, shingles = np.concatenate([row, short]), np.concatenate([shingles, np.array(one, np.uint64)])
    order = np.lexsort((shingles, row))
    row, shingles = row[order], shingles[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingles[1:] != shingles[:-1])
    row, shingles = row[new], shingles[new]
    return shingles, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))])


def _fold(numbers: np.ndarray) -> int:
    """One number for a sequence of fewer words than a shingle has."""
    total = len(numbers) << 60
    for number in numbers.tolist():
        total = (total * 0x9E3779B97F4A7C15 + number + 1) % (1 << 64)
    return total


def summed(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of 64-bit words between the borders, overflowing."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[borders[1:]] - total[borders[:-1]]


def parities(sets: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, borders of bytes, signs): the parity bitmap of each set, and its fold to 256 bits.

    A bitmap has the least power of two of bits that is twice the set's size or more, 256 at least.
    """
    n = np.diff(borders)
    bits = np.left_shift(1, np.ceil(np.log2(np.maximum(2 * n, 256))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(bits)])
    places = mixed(sets ^ np.uint64(0xC2B2AE3D27D4EB4F))
    at = np.repeat(first[:-1], n) + (places & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)
    flat = np.packbits((np.bincount(at, minlength=first[-1]) & 1).astype(np.uint8), bitorder="little")
    row = np.repeat(np.arange(len(n)), n)
    low = np.bincount(row * 256 + (places & np.uint64(255)).astype(np.int64), minlength=256 * len(n)) & 1
    signs = np.packbits(low.astype(np.uint8), bitorder="little").view(np.int64).reshape(len(n), 4)
    return flat, first // 8, signs


def least_difference(one: bytes, two: bytes) -> int:
    """Shingles in which two sets differ at least, from their parity bitmaps."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    if len(a) < len(b):
        a, b = b, a
    folded = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0) if len(a) > len(b) else a
    return int(np.bitwise_count(folded ^ b).sum())


def digests(docs: DataFrame, words: int) -> DataFrame:
    """Per document its set size, digests and bitmap; per task blocks of shingle occurrence counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS, np.int64)
        for ids, texts in text_batches(batches, RUN):
            sets, borders = shingle_sets(texts, words)
            table += np.bincount(sets >> np.uint64(64 - BITS), minlength=1 << BITS)
            a, b = summed(mixed(sets), borders), summed(mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), borders)
            flat, ends, signs = parities(sets, borders)
            bitmaps = pa.Array.from_buffers(
                pa.binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())]
            )
            none = pa.nulls(len(ids))
            columns = [pa.array(ids, pa.int64()), pa.array(np.diff(borders)), a.view(np.int64), b.view(np.int64)]
            columns += [*np.ascontiguousarray(signs.T), bitmaps]
            columns += [none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_SETS)
        if table.any():
            part, blocks = TaskContext.get().partitionId() % 64, len(table) // BLOCK
            none = pa.nulls(blocks, pa.int64())
            counts = [np.minimum(c, 65535).astype(np.uint16).tobytes() for c in table.reshape(blocks, BLOCK)]
            columns = [none] * 8 + [pa.nulls(blocks, pa.binary())] + [pa.array(range(blocks), pa.int32()), pa.array([part] * blocks, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.binary())], schema=_SETS)
        give_back()

    schema = (
        "doc_id long, n long, digest_a long, digest_b long, s0 long, s1 long, s2 long, s3 long, bitmap binary, "
        "block int, part int, counts binary"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def occurrence_table(parts: DataFrame) -> np.ndarray:
    """Sums the counters of all tasks, in two steps so that no group grows with the tasks."""

    def add(width: int):
        def run(table):
            total = np.zeros(BLOCK, np.int64)
            for c in table.column("counts"):
                total += np.frombuffer(c.as_py(), np.uint16 if width == 2 else np.int64)
            block, part = table.column("block")[0].as_py(), table.column("part")[0].as_py()
            return pa.table({
                "block": pa.array([block], pa.int32()), "part": pa.array([part], pa.int32()),
                "counts": pa.array([total.tobytes()], pa.binary()),
            })
        return run

    schema = "block int, part int, counts binary"
    once = parts.groupBy("block", "part").applyInArrow(add(2), schema)
    rows = once.groupBy("block").applyInArrow(add(8), schema).collect()  # 2 ** BITS numbers in all
    table = np.zeros((1 << BITS) // BLOCK * BLOCK, np.int64)
    for row in rows:
        table[row["block"] * BLOCK: (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], np.int64)
    return table


def light_boundary(table: np.ndarray, percent: int) -> int:
    """Largest set size for which enumerating pairs is the cheaper way.

    A set with a prefix of p shingles costs p (p + 1) / 2 subset rows, or p rows and a scan of
    p lists. Prefixes hold the rarest shingles, so the expected length of a list is the mean
    counter of as many of the rarest occurrences as prefixes hold, over the plain mean.
    """
    if not table.any():
        return 0
    counts = np.sort(table[table > 0])
    upto = int(np.searchsorted(np.cumsum(counts), counts.sum() * (100 - percent) / 100)) + 1
    rare = counts[:upto].astype(float)
    length = max(1.0, float((rare ** 2).sum() / rare.sum() / counts.mean()))
    size = 1
    while size < 1000 and prefix(size + 1, percent) + 1 <= 2 * (1 + length):
        size += 1
    return size


def prefix(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def join_keys(docs: DataFrame, words: int, percent: int, table: np.ndarray, boundary: int) -> DataFrame:
    """(key, doc_id, n, rest): ``rest`` bounds the overlap with a partner whose first common key this is."""
    shared = docs.sparkSession.sparkContext.broadcast(table.astype(np.uint32))  # 2 ** BITS counters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for ids, texts in text_batches(batches, RUN):
            sets, borders = shingle_sets(texts, words)
            n = np.diff(borders)
            row = np.repeat(np.arange(len(texts)), n)
            order = np.lexsort((sets, seen[sets >> np.uint64(64 - BITS)], row))
            sets = sets[order]
            place = np.arange(len(sets)) - np.repeat(borders[:-1], n)
            size, reach = n[row], (n - (-(-percent * n // 100)) + 1)[row]
            # inverted lists: large sets, and small ones whose partners may be large
            listed = (place < reach) & (100 * size >= percent * (boundary + 1))
            keys, rows, rest = [sets[listed]], [row[listed]], [(size - place)[listed]]
            # subsets of two: small sets
            for i in np.flatnonzero((n <= boundary) & (n > 1)):
                own = sets[borders[i]: borders[i] + prefix(int(n[i]), percent) + 1]
                one, two = np.triu_indices(len(own), 1)
                keys.append(mixed(own[one] * np.uint64(0xD6E8FEB86659FD93) + own[two]))
                rows.append(np.full(len(one), i))
                rest.append(n[i] - two + 1)
            at = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(keys).view(np.int64)), pa.array(ids, pa.int64()).take(pa.array(at)),
                pa.array(n[at].astype(np.int32)), pa.array(np.concatenate(rest).astype(np.int32)),
            ], schema=_KEYS)
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "key long, doc_id long, n int, rest int")


#: Shingles of sets that are broadcast; more are shuffled.
BROADCAST_SHINGLES = 1_000_000


def sets_of(rows: DataFrame, words: int, out: str) -> DataFrame:
    """(ids of ``rows``, out): the shingles of the texts."""
    keys = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches, RUN):
            sets, borders = shingle_sets(texts, words)
            lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(sets.view(np.int64)))
            columns = [pa.array([i[key] for i in ids], pa.int64()) for key in keys]
            yield pa.RecordBatch.from_arrays([*columns, lists], names=[*keys, out])
        give_back()

    schema = ", ".join(f"{key} long" for key in keys)
    return rows.select(F.struct(*keys).alias("ids"), "text").mapInArrow(run, f"{schema}, {out} array<long>")


def possible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps do not rule out that they are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            sides = zip(batch.column("bitmap_a"), batch.column("bitmap_b"), strict=True)
            apart = np.array([least_difference(x.as_py(), y.as_py()) for x, y in sides], np.int64)
            near = pa.array((100 + percent) * apart <= (100 - percent) * total)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(near)

    for side in ("a", "b"):
        own = bitmaps.select(F.col("doc_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"bitmap_{side}"))
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(run, "a long, b long").distinct()


def verified(docs: DataFrame, bitmaps: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by exact intersection.

    The texts of ``a`` become sets where they are read and travel to ``b`` at most once for each pair that is left; few
    sets of ``b`` are sent to the texts instead.
    """
    pairs = stored(possible(pairs, bitmaps, percent), "near-pairs")
    ends = stored(pairs.select("b").distinct(), "near-ends")
    texts = docs.select("doc_id", "text")
    left = texts.join(sized_broadcast(pairs), texts["doc_id"] == pairs["a"]).select("a", "b", "text")
    right = texts.join(sized_broadcast(ends), texts["doc_id"] == ends["b"]).select("b", "text")
    right = stored(sets_of(right, words, "of_b"), "near-sets")
    right = sized_broadcast(right, F.sum(F.size("of_b") + 8), BROADCAST_SHINGLES)
    both = sets_of(left, words, "of_a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.where(100 * common >= percent * union).select("a", "b").distinct()


def fits(n_a: str, n_b: str, overlap, percent: int):
    """Whether an overlap of at most ``overlap`` can reach the threshold."""
    return (100 + percent) * overlap >= percent * (F.col(n_a) + F.col(n_b))


def similar_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
    rounds: int = 5, few: int = 8,
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Two documents link when ``100 * common >= percent * union`` of their distinct
    ``words``-word shingles; ``component_id`` is the smallest id reachable by links.

    Null, empty and blank texts have no shingles and link with nothing; a text with fewer
    words is one shingle; rows that share an id are one document as far as links go, each
    with its own size; a null id stays null and links with nothing; other columns are
    ignored; an empty table gives no rows. ``rounds`` and ``few`` (comparisons of a document
    with large groups before the last, complete step) change the work, not the result.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    mixed_rows = stored(digests(docs, words), "digests")
    sizes = mixed_rows.where(F.col("block").isNull()).select("doc_id", "n", "digest_a", "digest_b", *_SIGNS, "bitmap")
    bitmaps = sizes.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    table = occurrence_table(mixed_rows.where(F.col("block").isNotNull()).select("block", "part", "counts"))

    # equal sets: one representative each
    key = ["n", "digest_a", "digest_b"]
    real = sizes.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = real.groupBy(*key).agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    classes = sized_broadcast(stored(classes.drop("rows"), "classes"))
    copies = real.join(classes, key).where("doc_id <> first").select("doc_id", "first").distinct()
    copies = stored(copies, "copies")
    # an id that also stands for a set of its own stays in the search
    alone = real.join(classes.select(*key, F.col("first").alias("doc_id")), [*key, "doc_id"], "left_semi")
    single = real.join(classes.select(*key), key, "left_anti")
    needed = alone.unionByName(single).select("doc_id")
    left_out = stored(copies.select("doc_id").distinct().join(needed, "doc_id", "left_anti"), "left-out")
    chosen = docs.where(F.col("doc_id").isNotNull()).join(sized_broadcast(left_out), "doc_id", "left_anti")

    boundary = light_boundary(table, percent)
    rows = join_keys(chosen, words, percent, table, boundary)
    lists = rows.groupBy("key").agg(F.min("n").alias("head_n"), F.max("rest").alias("most"), F.count("*").alias("length"))
    lists = stored(lists.where("length > 1").drop("length"), "lists")
    useful = fits("n", "head_n", F.least("rest", "most"), percent)  # else not even the smallest set can be near
    index = stored(rows.join(lists, "key").where(useful).select("key", "doc_id", "n", "rest"), "index")

    # first against the head of each list, its smallest set
    heads = index.groupBy("key").agg(F.min(F.struct("n", "doc_id")).alias("head"), F.count("*").alias("length"))
    heads = heads.where("length > 1").select("key", F.col("head.n").alias("head_n"), F.col("head.doc_id").alias("head_id"))
    near = index.join(stored(heads, "heads"), "key").where("doc_id <> head_id")
    near = near.where(fits("n", "head_n", F.least("n", "head_n"), percent))
    pairs = favoured(near.select(F.col("doc_id").alias("a"), F.col("head_id").alias("b")), 1)
    same = copies.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    links = stored(same.unionByName(verified(chosen, bitmaps, stored(pairs, "head-pairs"), words, percent)), "links")
    groups = stored(components(links), "groups")

    # then against a few of the largest group on each list, while that joins groups
    for turn in range(rounds):
        index = open_lists(index.select("key", "doc_id", "n", "rest"), groups)
        met = to_main(index, turn, percent)
        pairs = stored(favoured(met, few), "main-pairs")
        tried = pairs.select("a").distinct().count()
        new = stored(verified(chosen, bitmaps, pairs, words, percent), "links")
        joined = new.count()
        if joined:
            links = links.unionByName(new)
            groups = stored(merged(groups, new), "groups")
        if joined * 20 <= tried:
            break

    # then whatever still meets on a list from different groups
    index = open_lists(index.select("key", "doc_id", "n", "rest"), groups)
    links = links.unionByName(verified(chosen, bitmaps, crossings(index, bitmaps, percent), words, percent))
    groups = components(links).select(F.col("id").alias("doc_id"), "component")
    found = sizes.select("doc_id", F.col("n").alias("n_shingles")).join(groups, "doc_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def favoured(pairs: DataFrame, few: int) -> DataFrame:
    """Of pairs (a, b) given once per list they share, the ``few`` most frequent of each a."""
    order = W.partitionBy("a").orderBy(F.desc("votes"), "b")
    votes = pairs.groupBy("a", "b").agg(F.count("*").alias("votes"))
    return votes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= few).select("a", "b")


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` after one step towards the smaller component of each link: coarser, never too coarse."""
    of = groups.select(F.col("id").alias("a"), F.col("component").alias("of_a"))
    ids = links.select(F.explode(F.array("a", "b")).alias("a")).distinct().join(of, "a", "left")
    ids = stored(ids.withColumn("of_a", F.coalesce("of_a", "a")), "link-groups")
    ends = links.join(ids, "a").join(ids.select(F.col("a").alias("b"), F.col("of_a").alias("of_b")), "b")
    steps = ends.where("of_a <> of_b").groupBy(F.greatest("of_a", "of_b").alias("component"))
    steps = steps.agg(F.min(F.least("of_a", "of_b")).alias("onto"))
    known = groups.unionByName(ids.select(F.col("a").alias("id"), F.col("of_a").alias("component"))).distinct()
    return known.join(steps, "component", "left").select("id", F.coalesce("onto", "component").alias("component"))


def open_lists(index: DataFrame, groups: DataFrame) -> DataFrame:
    """The lists on which several groups meet, with each document's group and the list's commonest one."""
    known = groups.select(F.col("id").alias("doc_id"), "component")
    index = index.join(known, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    index = stored(index, "grouped")
    sizes = index.groupBy("key", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("main"), F.count("*").alias("groups"))
    main = main.where("groups > 1").select("key", F.col("main.component").alias("main"))
    return stored(index.join(stored(main, "mains"), "key"), "open-lists")


def to_main(index: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): documents outside the commonest group of a list, with a member of that group; another each turn.

    Every other turn, the first included, takes a member with the fewest shingles before the list's own, where
    edited copies have theirs: it is near the middle of the group, and what is near any member is near it most often.
    """
    chance = F.xxhash64("doc_id", "key", F.lit(turn))
    edits = F.lit(0) if turn % 2 else F.col("n") - F.col("rest")
    inside = index.where("component = main").groupBy("key").agg(
        F.min(F.struct(edits.alias("edits"), chance.alias("chance"), "doc_id", "n", "rest")).alias("inside")
    )
    inside = inside.select(
        "key", F.col("inside.doc_id").alias("b"), F.col("inside.n").alias("n_b"), F.col("inside.rest").alias("rest_b")
    )
    met = index.where("component <> main").join(inside, "key")
    met = met.where(fits("n", "n_b", F.least("rest", "rest_b", "n", "n_b"), percent))
    return met.select(F.col("doc_id").alias("a"), "b")


def crossings(index: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups that meet on a list and are not ruled out by sizes, places and signs.

    On each list the commonest group is set apart: pairs are formed only between the other
    documents, and between those and the commonest group, so a list of one large group
    and a few strangers costs its length times the few.
    """
    signs = bitmaps.select("doc_id", "n", *_SIGNS).distinct()
    index = stored(index.join(signs, ["doc_id", "n"]), "signed")
    few = index.where("component <> main").select(
        "key", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("rest_a"),
        F.col("component").alias("group_a"), *[F.col(c).alias(f"{c}_a") for c in _SIGNS],
    )
    everyone = index.select("key", F.col("doc_id").alias("b"), "n", "rest", "component", "main", *_SIGNS)
    apart = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_a"))) for c in _SIGNS)
    met = few.join(everyone, "key").where(
        (F.col("group_a") != F.col("component"))
        & ((F.col("component") == F.col("main")) | (F.col("a") < F.col("b")))
        & fits("n_a", "n", F.least("rest_a", "rest", "n_a", "n"), percent)
        & ((100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n")))
    )
    return stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "crossings")
