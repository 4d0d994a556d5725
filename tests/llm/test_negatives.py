"""Hard negatives against comparing every anchor with every row."""

import random

import pytest
from pyspark.sql import functions as F

from tidelake.llm import negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, anchors, n_positives=5, n_negatives=3, least=50, most=95, scale=256):
    import math

    def fits(r):
        return r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])

    rows = [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in filter(fits, rows)]
    out = []
    for a in (r for r in rows if anchors(r[0])):
        scored = [(-sum(x * y for x, y in zip(a[2], b[2], strict=True)), b[0], b[1]) for b in rows if len(b[2]) == len(a[2])]
        positives = sorted(s for s in scored if s[2] == a[1] and s[1] != a[0])[:n_positives]
        others = sorted(s for s in scored if s[2] != a[1])
        for k, (p, positive, _) in enumerate(positives, 1):
            inside = [s for s in others if least * -p <= 100 * -s[0] <= most * -p][:n_negatives]
            out += [(a[0], positive, k, r, s[1], -p, -s[0]) for r, s in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, anchors, **options):
    frame = spark.createDataFrame(rows, SCHEMA).select("vec_id", "label", negatives.quantised(F.col("embedding"), 256).alias("vector"))
    return sorted(tuple(r) for r in negatives.mine(frame, anchors, **options).collect())


def made(n, dim, labels, seed, grid=None):
    r = random.Random(seed)
    draw = (lambda: r.choice(grid)) if grid else (lambda: r.gauss(0, 0.2))
    return [(k, r.randrange(labels), [draw() for _ in range(dim)]) for k in range(n)]


@pytest.mark.parametrize("tile", [(512, 4096), (3, 7)])
@pytest.mark.parametrize("case", ["plain", "ties", "one label", "many cells"])
def test_equals_brute_force(spark, monkeypatch, case, tile):
    monkeypatch.setattr(negatives, "TILE", tile)
    if case == "many cells":
        for name, value in (("ANCHORS", 5), ("ROWS", 16), ("CELLS", 12)):
            monkeypatch.setattr(negatives, name, value)
    rows = {
        "plain": made(150, 6, 4, 1),
        "ties": made(150, 2, 3, 2, [0.0, 0.25, 0.5]) + [(k, k % 3, [0.5, 0.5]) for k in range(200, 230)],
        "one label": made(60, 4, 1, 3),
        "many cells": made(120, 4, 5, 4),
    }[case]
    got = mined(spark, rows, F.col("vec_id") % 5 == 0)
    assert got == brute(rows, lambda i: i % 5 == 0)
    assert bool(got) == (case != "one label")


def test_odd_rows(spark):
    rows = [(1, 0, [1.0, 0.5]), (2, 0, [1.0, 0.4]), (3, 1, [0.9, 0.1]), (4, 1, [0.5, 0.3]), (5, None, [1.0, 1.0]), (6, 1, None), (None, 1, [1.0, 1.0])]
    rows += [(7, 1, [1.0, None]), (8, 1, [float("nan"), 1.0]), (9, 1, [float("inf"), 1.0]), (10, 0, []), (11, 0, []), (12, 1, []), (13, 1, [0.7])]
    # Repeated rows and ids, and scores beyond 32 and 53 bits.
    rows += [(3, 1, [0.9, 0.1]), (1, 0, [1.0, 0.5]), (1, 1, [0.8, 0.5]), (20, 2, [6e6] * 3), (21, 2, [6e6] * 3), (22, 3, [5e6] * 3), (23, 2, [3e4] * 4), (24, 2, [3e4] * 4), (25, 3, [2e4] * 4)]
    got = mined(spark, rows, F.col("vec_id") < 30)
    assert got == brute(rows, lambda i: i < 30)
    assert {(20, 21), (23, 24), (10, 11)} <= {r[:2] for r in got}


def test_other_sizes(spark):
    rows = made(80, 3, 2, 7)
    got = mined(spark, rows, F.col("vec_id") == 3, positives=2, negatives=9, least=0, most=100)
    assert got == brute(rows, lambda i: i == 3, 2, 9, 0, 100)


def test_no_rows_no_anchors_and_clashing_columns(spark):
    assert mined(spark, [], F.lit(True)) == []
    assert mined(spark, made(9, 2, 2, 0), F.lit(False)) == []
    frame = spark.createDataFrame([(1, 0, [3], 5, 6, 7), (2, 0, [3], 5, 6, 7), (3, 1, [2], 5, 6, 7)], "vec_id int, label int, vector array<int>, place int, cell int, upper int")
    assert [tuple(r) for r in negatives.mine(frame, F.col("vec_id") == 1).collect()] == [(1, 2, 1, 1, 3, 9, 6)]
