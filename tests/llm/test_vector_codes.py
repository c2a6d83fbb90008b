"""Vector codes against exact plain rounds in Python's numbers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from marketloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, code string, error string, part int"
EXTRA = ("i", "v", "c", "e", 3)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA.replace("<float>", f"<{kind}>"))


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Result rows, in the order of the kept rows."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1]) if kept else 0
    fits = [len(v) == length and length % parts == 0 for _, v, _ in kept]
    width = length // parts
    whole = [[math.floor(Fraction(x) * scale) for x in v] for _, v, _ in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w, ok in zip(whole, fits) if ok]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(book, x):
        d, e = min((sum((a - b) ** 2 for a, b in zip(x, entry)), i) for i, entry in enumerate(book))
        return e, d

    for _ in range(rounds if cut else 0):
        for p in range(parts):
            own = [nearest(books[p], c[p])[0] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own) if o == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest() if cut else None
    coded = [[nearest(books[p], c[p]) for p in range(parts)] for c in cut]
    found, at = [], 0
    for (i, _, g), ok in zip(kept, fits):
        code = error = None
        if ok:
            code, error = "".join(f"{e:02x}" for e, _ in coded[at]), sum(d for _, d in coded[at])
            error = error if error < 2**63 else None
            at += 1
        found.append([i, g, code, error])
    sums = {}
    for _, g, _, error in found:
        if error is not None:
            sums[g] = sums.get(g, 0) + error
    return [(i, c, e, sums.get(g) if sums.get(g, 0) < 2**63 else None, digest) for i, g, c, e in found]


def same(got, want):
    order = lambda rows: sorted((tuple(r) for r in rows), key=str)
    want = [w if w[-1] else (*w[:-1], hashlib.sha256(b"").hexdigest()) for w in want]
    assert order(got) == order(want)


def vectors(n, seed, length=16, near=3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(near)]
    rows = []
    for i in range(n):
        v = [float(np.float32(x + rng.gauss(0, 0.1))) for x in rng.choice(centres)]
        rows.append((i, v, rng.choice([0, 1, None])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_version(spark, seed):
    rows = vectors(120, seed)
    same(vc.vector_codes(frame(spark, rows)).collect(), plain(rows))


def test_hot_vectors_ties_and_odd_rows(spark):
    rows = vectors(30, 3) + [(100 + i, [0.5] * 16, 0) for i in range(60)]
    # Entries that repeat, identifiers that repeat or are missing, vectors that are dropped or cannot be coded.
    rows += [(0, [0.25] * 16, 1), (0, [0.25] * 16, 1), (None, [0.125] * 16, None), (None, None, 1), (7, None, None)]
    rows += [(8, [float("nan")] * 16, 1), (9, [1.0] * 15 + [float("inf")], 1), (10, [None] + [1.0] * 15, 1)]
    rows += [(11, [1.0] * 8, 2), (12, [], 2), (-5, [-0.5] * 8 + [0.0001] * 8, 1)]
    same(vc.vector_codes(frame(spark, rows)).collect(), plain(rows))


def test_lengths_that_cannot_be_cut(spark):
    rows = [(1, [1.0] * 9, 0), (2, [1.0] * 16, 0)]
    same(vc.vector_codes(frame(spark, rows)).collect(), plain(rows))


def test_numbers_of_any_size_are_exact(spark):
    rows = vectors(20, 4) + [(50, [3e38] * 16, 0), (51, [-3e38, 1.0] * 8, 1), (52, [2.5e14] * 16, 1)]
    rows = [(i, [float(np.float32(x)) for x in v], g) for i, v, g in rows]
    same(vc.vector_codes(frame(spark, rows)).collect(), plain(rows))
    wide = [(i, [x * 1e300 for x in v], g) for i, v, g in vectors(18, 5)]
    same(vc.vector_codes(frame(spark, wide, "double")).collect(), plain(wide))


def test_empty_tables(spark):
    assert vc.vector_codes(frame(spark, [])).collect() == []
    assert vc.vector_codes(frame(spark, [(1, None, 1), (2, [float("nan")], 1)])).collect() == []


def test_tree_finds_the_nearest_entry_and_leaves_out_subtrees():
    rng = np.random.default_rng(6)
    near = rng.integers(-9000, 9000, (5, 6))
    entries = np.concatenate([c + rng.integers(-40, 40, (40, 6)) for c in near] + [near, near])
    queries = np.concatenate([entries, entries + rng.integers(-30, 30, entries.shape)])
    apart = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
    tree = vc.Gnat(entries, range(len(entries)))
    best, index = np.full(len(queries), 2**62), np.full(len(queries), len(entries))
    measured = []
    squared = vc._squared
    try:
        vc._squared = lambda rows, point: (measured.append(len(rows)), squared(rows, point))[1]
        tree.search(queries, np.arange(len(queries)), best, index)
    finally:
        vc._squared = squared
    assert (best == apart.min(axis=1)).all() and (index == apart.argmin(axis=1)).all()
    assert sum(measured) < apart.size / 2
