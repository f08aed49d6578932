"""Hard negatives against all pairs, and the intervals that filter them."""

import numpy as np
import pytest

from chainloom.llm import hard_negatives as hn
from chainloom.llm import queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string"


def slow(rows, is_anchor, positives=5, negatives=5, factor=256):
    """rows: (id, label, whole components)."""
    out = []
    for a, la, va in (r for r in rows if is_anchor(r[0])):
        score = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in rows if i != a and len(v) == len(va))
        for ps, p, _ in [s for s in score if s[2] == la][:positives]:
            good = [s for s in score if s[2] != la and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:negatives]
            out += [(a, p, k, n, -ps, -ns) for k, (ns, n, _) in enumerate(good, 1)]
    return sorted(out)


def whole(v, factor=256):
    return [int(np.floor(float(np.float32(x)) * factor)) for x in v]


def made(spark, data):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, "clash") for i, v, label in data], SCHEMA)


@pytest.mark.parametrize("anchor_rows,vector_rows", [(7, 50), (8192, 32768)])
def test_against_all_pairs(spark, monkeypatch, anchor_rows, vector_rows):
    monkeypatch.setattr(hn, "VECTOR_BATCH", 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 24))
    data = [(i, centres[i % 6] + rng.normal(size=24) * rng.choice([0.2, 1.0, 3.0]), int(rng.integers(0, 4))) for i in range(400)]
    data += [(1000 + i, data[i][1], data[i][2]) for i in range(30)]  # ties
    df = made(spark, data)
    got = hn.hard_negatives(df, df.where("vec_id % 9 = 0"), anchor_rows=anchor_rows, vector_rows=vector_rows)
    assert sorted(tuple(r) for r in got.collect()) == slow([(i, label, whole(v)) for i, v, label in data], lambda i: i % 9 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1, 2], 1), (1, [1, 2.5], 1), (2, [1, 2], 2), (3, [1, 1.9], 2), (4, [nan, 1], 1), (5, [inf, 1], 2), (6, [None, 1], 2), (7, None, 1), (8, [1, 2], None), (9, [], 1), (10, [1, 2, 3], 2), (11, [-1, -2], 1),
        (2, [1, 2], 2), (12, [0, 0], 1), (13, [0, 0], 3),
    ]
    df = made(spark, data)
    kept = {}
    for i, v, label in sorted((d for d in data if d[1] and label_ok(d)), key=lambda d: (d[0], d[2])):
        kept.setdefault(i, (i, label, whole(v)))
    got = hn.hard_negatives(df, df)
    assert sorted(tuple(r) for r in got.collect()) == slow(list(kept.values()), lambda i: True)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hn.hard_negatives(df.limit(0), df.limit(0)).count() == 0
    assert hn.hard_negatives(df, df.limit(0)).count() == 0


def label_ok(d):
    return d[2] is not None and all(x is not None and np.isfinite(x) for x in d[1])


def test_op13_is_whole(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    data = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, whole(r.embedding)) for r in rows]
    assert sorted(tuple(r) for r in queries.op13_hard_negatives(spark, sf).collect()) == slow(data, lambda i: i % 100 == 0)


@pytest.mark.parametrize("d", [1, 3, 64, 100])
def test_intervals_hold_and_narrow(d):
    rng = np.random.default_rng(d)
    q, c = rng.integers(-300, 300, (40, d)), np.concatenate((rng.integers(-300, 300, (200, d)), np.zeros((1, d), int)))
    bounds = hn.Bounds(q, c, 4)
    i, j = np.arange(40)[:, None], np.arange(len(c))[None, :]
    exact, sure, widths = q @ c.T, (0.0, 0.0), []
    for level in range(4):
        sure, low, high = bounds.step(level, i, j, sure)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
    assert widths == sorted(widths, reverse=True)
    if d == 64:
        assert widths[2] < 0.45 * widths[0]


def test_the_filter_leaves_few_pairs():
    """Of clustered vectors the intervals leave a small part to be scored."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 64))
    x = np.floor(256 * (centres[rng.integers(0, 20, 3000)] + 0.2 * rng.normal(size=(3000, 64))) / 8).astype(np.int64)
    bounds = hn.Bounds(x[:50], x, 3)
    best = np.sort(x[:50] @ x.T, axis=1)[:, -10]
    i, _ = bounds.narrowed(np.arange(50), np.arange(3000), np.ones((50, 3000), bool), (0.8 * best)[:, None], best[:, None])
    assert len(i) < 0.15 * 50 * 3000
