"""Vector codes against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from fabflow.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """{row number: (code, error)}, label sums and books of plain loops over kept (id, ints, label) rows."""
    def d(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], {}, ""
    k = len(kept[0][1]) // parts
    cut = [[v[p * k:(p + 1) * k] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[cut[r][p] for r in first] for p in range(parts)]

    def codes():
        return [[min(range(len(books[p])), key=lambda e: (d(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = codes()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found, strict=True) if f[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = codes()
    errors = [sum(d(c[p], books[p][f[p]]) for p in range(parts)) for c, f in zip(cut, found, strict=True)]
    sums = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        sums[label] = sums.get(label, 0) + e
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return [(i, "".join(f"{c:02x}" for c in f), e, sums[label], hashlib.sha256(flat.encode()).hexdigest())
            for (i, _, label), f, e in zip(kept, found, errors, strict=True)], sums, flat


def query(spark, monkeypatch, rows, dim_schema=SCHEMA):
    df = spark.createDataFrame(rows, dim_schema).selectExpr("*", "1 as id", "'x' as code", "2 as error", "3 as x", "4 as codes", "5 as of")
    monkeypatch.setattr(queries, "read_table", lambda *a: df)
    return sorted((tuple(r) for r in queries.op13_vector_codes(spark, "").collect()), key=str)


def test_nearest_equals_brute_force_with_ties():
    rng = np.random.default_rng(5)
    for width, entries, spread in [(4, 64, 3), (1, 7, 2), (2, 1, 9), (4, 20, 400), (3, 64, 1)]:
        book = rng.integers(-spread, spread + 1, (entries, width))
        x = rng.integers(-spread, spread + 1, (500, width))
        d = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        index, best = vector_codes.nearest(x, book)
        assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


@pytest.mark.parametrize("n", [0, 1, 30, 300])
def test_codes_equal_brute_force(spark, monkeypatch, n):
    rng = random.Random(n)
    rows = [(i * 7 % 301, [float(np.float32(rng.gauss(0, 0.2))) for _ in range(32)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(5, None, 1), (6, [float("nan")] + [0.5] * 31, 1), (7, [float("inf")] + [0.5] * 31, None), (8, [None] + [0.5] * 31, 2)]
    if n > 1:
        rows += [rows[0], rows[0], (None, [0.25] * 32, None), (None, [-0.001] * 32, 3), (rows[1][0], [0.125] * 32, 1)]
    assert query(spark, monkeypatch, rows) == sorted(brute(rows)[0], key=str)


def test_hot_vector_and_label(spark, monkeypatch):
    rows = [(i, [0.1 * (i % 3)] * 16, 1) for i in range(200)] + [(1000 + i, [float(np.float32(i / 50))] * 16, None) for i in range(50)]
    assert query(spark, monkeypatch, rows) == sorted(brute(rows)[0], key=str)


def test_lengths_and_sizes_that_have_no_codes_raise(spark, monkeypatch):
    for bad in ([0.5] * 17, [0.5] * 32, [1e30] * 16):
        with pytest.raises(Exception, match="vector|component|length"):
            query(spark, monkeypatch, [(1, [0.5] * 16, 1), (2, bad, 1)])
