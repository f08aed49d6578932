"""Shares of the tokens that the pipeline's mixing keeps, and raking to a tolerance."""

import warnings

import numpy as np
import pytest

import corpus_pipeline as cp
from chainloom.llm import mixing


def test_kept_shares_meet_the_targets_where_a_source_is_scarce(spark, sf):
    n = {"a": 12000, "b": 6000, "c": 2000}
    names = [s for s in n for _ in range(n[s])]
    docs = spark.createDataFrame([(i, "w " * 10, s, "en") for i, s in enumerate(names)], "doc_id bigint, text string, source string, lang string")
    kept = [r[0] for r in cp.mixed(spark, docs, sf).select("source").collect()]
    target = {s: x**0.7 for s, x in n.items()}
    for s in n:
        assert abs(kept.count(s) / len(kept) - target[s] / sum(target.values())) < 0.01, s
    assert len(kept) >= 0.79 * len(names)


def cells_of(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, tokens bigint")


def targets_of(spark, **by):
    return {k: spark.createDataFrame(list(t.items()), f"{k} string, target double") for k, t in by.items()}


def test_sparse_margins_are_raked_to_the_tolerance(spark):
    rows = [("a", "x", 100000), ("a", "y", 10), ("b", "y", 100000), ("b", "z", 10), ("c", "z", 100000), ("c", "x", 10)]
    targets = targets_of(spark, source={"a": 0.5, "b": 0.3, "c": 0.2}, lang={"x": 0.4, "y": 0.3, "z": 0.3})
    miss = lambda got: np.abs(got.groupby("source").weight.sum() - [0.5, 0.3, 0.2]).max()
    assert miss(mixing.fit_cells(cells_of(spark, rows), targets, rounds=8, tolerance=None).toPandas()) > 1e-3
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert miss(mixing.fit_cells(cells_of(spark, rows), targets, tolerance=1e-6).toPandas()) <= 1e-6


def test_crowded_margins_are_summed_without_windows(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(f"s{a}", f"l{b}", int(rng.integers(1, 1000))) for a in range(30) for b in range(3)]
    targets = targets_of(spark, source={f"s{a}": 1.0 + a % 5 for a in range(30)}, lang={"l0": 1.0, "l1": 2.0, "l2": 3.0})
    fit = lambda: mixing.fit_cells(cells_of(spark, rows), targets).toPandas().sort_values(["source", "lang"])
    want = fit()
    monkeypatch.setattr(mixing, "ONE_TASK_CELLS", 0)
    apart = fit()
    monkeypatch.setattr(mixing, "WINDOW_CELLS", 5)
    for got in (apart, fit()):
        assert np.allclose(got.weight, want.weight, rtol=1e-9) and (got.miss <= mixing.TOLERANCE).all()


def test_each_row_is_sampled_for_itself(spark):
    rows = [(i % 50, f"{'w ' * (5 + i % 3)}{i}", "a" if i % 3 else "b", "en") for i in range(600)] + [(None, f"v w {i}", "a", "en") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    mixed = mixing.mix(docs, keep=0.5, rounds=2, tolerance=None).toPandas()
    got = mixing.sample(docs, keep=0.5, rounds=2, tolerance=None)
    assert got.columns == docs.columns and 0 < mixed[mixed.doc_id.isna()].kept.sum() < 600
    texts = {r.text for r in got.collect()}
    scarce = (mixed.weight > 1).any()
    assert scarce or len(texts) == mixed.kept.sum()
    own = mixing.mix(docs.withColumn("kind", docs.source), topic_col="kind", rounds=2, tolerance=None)
    assert own.where("topic <> source").isEmpty()


@pytest.mark.parametrize("one_task", [1 << 16, 0])
def test_margins_that_cannot_hold_are_named(spark, monkeypatch, one_task):
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 10)
    monkeypatch.setattr(mixing, "ONE_TASK_CELLS", one_task)
    targets = targets_of(spark, source={"a": 0.9, "b": 0.1}, lang={"x": 0.1, "y": 0.9})
    with pytest.warns(UserWarning, match="source 'a'"):
        got = mixing.fit_cells(cells_of(spark, [("a", "x", 10), ("b", "y", 10), ("a", "y", 0)]), targets, tolerance=1e-6)
    assert all(abs(r.miss - 0.8) < 1e-9 for r in got.collect())
    docs = spark.createDataFrame([(1, "one two", "a", "x"), (2, "three", "b", "y")], "doc_id bigint, text string, source string, lang string")
    with pytest.warns(UserWarning, match="margins miss"):
        assert {r.margin_miss for r in mixing.mix(docs, targets=targets).collect()} == {0.8}
