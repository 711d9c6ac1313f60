import math
import random

import numpy as np
import pytest

from tripmart.llm import hard_negatives as X

SCHEMA = "vec_id long, embedding array<float>, label int, score string, `a.b` int"


def brute(rows, every):
    known = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in vector]
        known.setdefault(vec_id, []).append(((label + 1) % 10 if vec_id % 7 == 0 else label, q))
    known = {k: min(v) for k, v in known.items()}
    out = []
    for anchor in sorted(k for k in known if k % every == 0):
        label, q = known[anchor]
        score = {k: min(X.MOST, max(X.LEAST, sum(a * b for a, b in zip(q, v[1])))) for k, v in known.items() if k != anchor}
        order = sorted(score, key=lambda k: (-score[k], k))
        for p in [k for k in order if known[k][0] == label][:5]:
            fits = [k for k in order if known[k][0] != label and 80 * score[p] <= 100 * score[k] <= 100 * score[p]]
            out += [(anchor, p, r, k, score[p], score[k]) for r, k in enumerate(fits[:5], 1)]
    return sorted(out)


def run(spark, rows, every):
    return sorted(tuple(r) for r in X.mine(spark.createDataFrame(rows, SCHEMA), every).collect())


def rows_of(rng, n, size=6):
    return [(k, [rng.gauss(0.2, 0.4) for _ in range(size)], rng.randrange(4), "s", 1) for k in range(n)]


@pytest.mark.parametrize("cell", [(8192, 4096), (3, 20)])
def test_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(X, "BLOCK_ANCHORS", cell[0])
    monkeypatch.setattr(X, "SLICE_ROWS", cell[1])
    rng = random.Random(3)
    rows = rows_of(rng, 260) + [(-10 * k, [0.5] * 6, k % 3, None, None) for k in range(1, 30)]  # many ties, ids below 0
    rows += [(1000 + k, [0.5] * 6, 2, None, None) for k in range(40)]
    rows += [(2000, None, 1, "", 0), (2010, [0.1, None], 1, "", 0), (2020, [float("nan")] * 6, 1, "", 0),
             (2030, [float("inf")] * 6, 1, "", 0), (2040, [0.1] * 6, None, "", 0), (None, [0.5] * 6, 1, "", 0),
             (2050, [], 1, "", 0), (2060, [0.9, 0.9], 1, "", 0), (2070, [0.3] * 9, 1, "", 0)]
    rows += rows[:50] + [(10, [0.4] * 6, 1, "", 0)]  # repeated rows, and an id with two vectors
    got = run(spark, rows, 10)
    assert got == brute(rows, 10) and len(got) > 100


@pytest.mark.parametrize("power", [15, 18, 25])  # products to 2^54, to 2^60, and beyond 64 bits
def test_huge_components_are_exact(spark, power):
    rows = [(k, [float(2 ** (power + k % 5)), float(-k), 0.75], k % 3, None, None) for k in range(60)]
    assert run(spark, rows, 10) == brute(rows, 10)


def test_no_rows(spark):
    assert run(spark, [], 10) == []
    assert run(spark, [(10, [1.0], 1, None, None)], 10) == []


def test_keys_sort_as_pairs_do():
    rng = random.Random(1)
    some = [(rng.choice([-5, 0, 7, 1 << 62, X.LEAST]), rng.choice([-9, 0, 3, X.MOST, X.LEAST]), rng.random() < 0.5,
             rng.choice([-2, 4, X.MOST])) for _ in range(300)]
    keys = sorted(X.pack(*p) for p in some)
    assert [X.unpack(k) for k in keys] == sorted(some, key=lambda p: (p[0], -p[1], not p[2], p[3]))
    assert len({X.deal(k) for k in keys}) == len({p[0] for p in some})
