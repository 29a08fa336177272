import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termtide.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = negatives.hard_negatives(df, label, F.col("vec_id") % 50 == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def plain(rows):
    held = []
    for i, v, label, _ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out, order = [], lambda p: (-p[0], p[1] is None, p[1] or 0)
    for n, (i, label, v) in enumerate(held):
        if i is None or i % 50:
            continue
        scores = [(sum(a * b for a, b in zip(v, w, strict=True)), j, other) for m, (j, other, w) in enumerate(held) if m != n and len(w) == len(v)]
        for ps, pid, _ in sorted((s for s in scores if s[2] == label), key=order)[:5]:
            fit = sorted((s for s in scores if s[2] != label and 50 * ps <= 100 * s[0] <= 95 * ps), key=order)[:3]
            out += [(i, pid, r, s[1], ps, s[0]) for r, s in enumerate(fit, 1)]
    return sorted(out, key=repr)


def rows_of(n, width, rnd, scale=1.0):
    return [(i, [rnd.gauss(0, scale) + (k == i % 3) * scale for k in range(width)], rnd.randrange(4), "x") for i in range(n)]


@pytest.mark.parametrize(("width", "scale"), [(64, 0.1), (13, 3.0), (8, 500.0)])
def test_equals_plain_scores(spark, width, scale, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 70)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    rows = rows_of(260, width, random.Random(width), scale)
    got = mined(spark, rows)
    assert len(got) > 20 and got == plain(rows)


def test_nulls_ties_repeats_lengths(spark):
    rnd = random.Random(5)
    rows = rows_of(120, 9, rnd)
    rows += [(50, rows[50][1], rows[50][2], "repeat"), (None, rows[50][1], rows[50][2], "no id"), (200, None, 1, ""), (201, [None] * 9, 1, ""), (202, [float("nan")] * 9, 1, ""), (203, [float("inf")] * 9, 1, ""), (204, rows[0][1], None, "")]
    rows += [(300 + i, [0.5, 0.5], i % 2, "ties") for i in range(60)] + [(400 + i, [], i % 2, "empty") for i in range(60)]
    assert mined(spark, rows) == plain(rows)


def test_empty_and_constant_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1, "")]) == []
    assert mined(spark, [(0, [1e300], 1, ""), (1, [1e300], 1, ""), (2, [1.0], 2, "")]) == []  # cut to the bound, no overflow


def test_planes_and_tables_give_products():
    rnd = np.random.default_rng(1)
    for width, top in ((1, 2), (8, 1000), (20, 2**25), (64, 300)):
        a, b = rnd.integers(-top, top, (5, width)), rnd.integers(-top, top + 1, (7, width))
        packed = [p.tobytes() for half in (b[:3], b[3:] // 9) for p in negatives.planes(half)]
        own = np.concatenate([b[:3], b[3:] // 9])
        for i, got in negatives.scored([p.tobytes() for p in negatives.planes(a)], packed, width):
            assert i == 0 and (got == a @ own.T).all()


def test_scores_reach_the_bound():
    top = negatives.most(64)
    rows = np.full((1, 64), -top)
    packed = [negatives.planes(rows)[0].tobytes()]
    assert next(iter(negatives.scored(packed, packed, 64)))[1][0, 0] == 64 * top * top and 100 * 64 * top * top < 2**63
