"""Codes against plain integer k-means in Python, and the defined cases."""

import hashlib
import math

import numpy as np
import pytest

from earshot.llm.vector_codes import Codebooks, compress, nearest, sequency_order, walsh


@pytest.mark.parametrize("size", [1, 2, 4, 8, 32, 128])
def test_walsh_is_in_sequency_order_and_scales_distances(size):
    matrix = walsh(np.eye(size, dtype=np.int64))
    assert [(np.diff(matrix[:, i]) != 0).sum() for i in range(size)] == list(range(size))
    assert (matrix @ matrix.T == size * np.eye(size)).all()
    assert sorted(sequency_order(size)) == list(range(size))


@pytest.mark.parametrize("length", [1, 2, 3, 7, 16, 33])
@pytest.mark.parametrize("reach", [1, 40, 1 << 22])
def test_nearest_equals_all_distances(length, reach):
    rng = np.random.default_rng(length)
    points = rng.integers(-reach, reach, (900, length))
    entries = np.concatenate([points[:90], points[:30], rng.integers(-reach, reach, (20, length))])
    every = ((points[:, None] - entries[None]) ** 2).sum(-1)
    code, error = nearest(walsh(points), walsh(entries))
    assert (code == every.argmin(1)).all() and (error == every.min(1)).all()


def plain(rows, parts=4, entries=256, rounds=4):
    """The contract with Python integers: rows of (id, vector, label), ids distinct."""
    kept = [
        (i, [math.floor(1024 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // parts) or 1
    cut = {i: [(v + [0] * parts * width)[p * width : (p + 1) * width] for p in range(parts)] for i, v, _ in kept}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            groups = {}
            for i in cut:
                groups.setdefault(best(cut[i][p], book)[1], []).append(cut[i][p])
            new.append([
                [sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(book)
            ])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = {i: [best(cut[i][p], books[p]) for p in range(parts)] for i in cut}
    error = {i: sum(d for d, _ in f) for i, f in found.items()}
    by_label = {}
    for i, _, label in kept:
        by_label[label] = by_label.get(label, 0) + error[i]
    return sorted(
        (i, "".join(f"{k:02x}" for _, k in found[i]), error[i], by_label[label], digest) for i, _, label in kept
    )


def run(spark, rows, schema="vec_id long, embedding array<float>, label int, error string, code int", **how):
    filler = [("own", 3)] * len(rows)
    df = spark.createDataFrame([(*r, *f) for r, f in zip(rows, filler)], schema).repartition(5)
    made = compress(df, **how)
    assert made.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(tuple(r) for r in made.drop("label").collect())


def vectors(n, size, seed=3):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in rng.normal(size=size)], int(i % 3) or None) for i in rng.permutation(n)]


@pytest.mark.parametrize(("size", "entries"), [(8, 16), (12, 5), (20, 256)])
def test_equals_plain_integers(spark, size, entries):
    rows = vectors(120, size)
    assert run(spark, rows, entries=entries) == plain(rows, entries=entries)


def test_broken_short_and_repeated_vectors(spark):
    rows = vectors(30, 9) + [
        (100, None, 1), (101, [1.0, None, 2.0], 1), (102, [float("nan")] * 9, None), (103, [float("inf")] + [0.0] * 8, 2),
        (104, [], 2), (105, [0.5, -0.25], 2), (106, [-0.0] * 9, None), (107, [0.0] * 9, None), (108, [3.0] * 9, 1), (109, [3.0] * 9, 1),
    ]
    assert run(spark, rows, entries=7) == plain(rows, entries=7)
    assert len(run(spark, rows + [rows[0]] * 3, entries=7)) == len(plain(rows, entries=7)) + 3
    assert run(spark, [(None, [1.0, 2.0], None)])[0][:4] == (None, "00000000", 0, 0)
    assert run(spark, [(1, None, 1)]) == [] and run(spark, [(1, [], 1)])[0][:4] == (1, "00000000", 0, 0)


def test_huge_components_do_not_overflow(spark):
    rows = [(1, [1e30, -1e30, 0.0, 1.0], 1), (2, [-1e30, 1e30, 0.0, 1.0], 1), (3, [0.0, 0.0, 0.0, 5.0], None)]
    got = run(spark, rows, entries=1)
    assert len(got) == 3 and all(r[2] >= 0 for r in got) and got[0][3] == got[0][2] + got[1][2]


def test_empty_table_and_doubles(spark):
    schema = "vec_id long, embedding array<double>, label string, error string, code int"
    assert run(spark, [], schema) == []
    rows = [(i, [x * 1.1 for x in v], str(label)) for i, v, label in vectors(40, 8)]
    assert run(spark, rows, schema, entries=9) == plain(rows, entries=9)


def test_codebook_digest():
    assert Codebooks(np.arange(-2, 4).reshape(1, 3, 2)).sha256 == hashlib.sha256(b"-2,-1,0,1,2,3").hexdigest()
