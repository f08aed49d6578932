"""Windows that depend on the ones before: pointer jumping against a walk, for keys, blocks and jumps of all sizes."""

import random
import re

import pytest

from chainloom.operators import control, cuts, ordered


def walk(to):
    out, at = [], 0
    while at < len(to):
        out.append(at)
        at = to[at]
    return out


@pytest.mark.parametrize("n,longest,block,most", [(1, 1, 4, 64), (300, 3, 8, 64), (300, 9, 32, 64), (300, 40, 16, 1 << 22), (300, 40, 16, 64), (200, 1000, 16, 64), (50, 1, 8, 64)])
def test_starts(spark, monkeypatch, n, longest, block, most):
    monkeypatch.setattr(cuts, "MOST", most)
    rng = random.Random(n * longest + block)
    to = [min(n, i + rng.randint(1, longest)) for i in range(n)]
    jumps = spark.createDataFrame(list(enumerate(to)), "_pos bigint, _to bigint").repartition(3)
    assert sorted(r[0] for r in cuts.starts(jumps, block).collect()) == walk(to)


def test_no_rows(spark):
    assert cuts.starts(spark.createDataFrame([], "_pos bigint, _to bigint")).count() == 0
    empty = spark.createDataFrame([], "k string, o bigint, size bigint, t bigint")
    assert control.frames_by_size(empty, "k", "o", "size", 10).count() == 0
    assert control.ingest_stats(empty, "t", "o", "size", keys=("k",)).count() == 0


def slow_frames(rows, most):
    out, last, used, frame, held = [], object(), 0, 0, 0
    for k, o, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2] or 0)):
        if k != last:
            last, used, frame, held = k, 0, 0, 0
        elif held and used + (n or 0) > most:
            frame, used, held = frame + 1, 0, 0
        used, held = used + (n or 0), held + 1
        out.append((k, o, n, frame))
    return out


def test_frames_of_a_huge_key(spark, monkeypatch):
    monkeypatch.setattr(cuts, "BLOCK", 64)
    rng = random.Random(4)
    rows = [("big", i, rng.choice([0, 0, 1, 5, 30, 99, 100, 101, 500])) for i in range(2000)] + [(None, 1, 50), (None, 2, 60), ("a", 1, 0), ("a", 2, 1000), ("b", 1, 1), ("b", 1, 1), ("c", 0, 100), ("c", 1, 0), ("c", 2, 1)]
    df = spark.createDataFrame(rows, "k string, o bigint, size bigint")
    assert sorted(map(str, (tuple(r) for r in control.frames_by_size(df, "k", "o", "size", 100).collect()))) == sorted(map(str, slow_frames(rows, 100)))


def test_no_row_is_dealt_by_its_key(spark, monkeypatch):
    """Exchanges of rows go by places and ranges of the order; none by the key."""
    plans = []
    monkeypatch.setattr("chainloom.operators.ordered.checkpointed", lambda df, f=ordered.checkpointed: plans.append(df._jdf.queryExecution().executedPlan().toString()) or f(df))
    monkeypatch.setattr("chainloom.operators.cuts.checkpointed", ordered.checkpointed)
    df = spark.range(1000).selectExpr("'k' as k", "id as o", "id % 7 as size")
    plans.append(control.frames_by_size(df, "k", "o", "size", 100)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 4 and not any(re.search(r"hashpartitioning\((?:coalesce\()?k#", p) for p in plans)


def slow_monitor(rows, n, ms):
    """rows: (chain, t, id, took, size), as the monitor takes them one by one."""
    out, state = [], {}
    for chain, t, i, took, size in sorted(rows):
        s = state.setdefault(chain, {"win": 0, "since": t, "x": []})
        s["x"].append((took, size, i))
        if len(s["x"]) >= n or t - s["since"] >= ms:
            out.append(closed(chain, s, True))
            state[chain] = {"win": s["win"] + 1, "since": t, "x": []}
    return sorted(out + [closed(c, s, False) for c, s in state.items() if s["x"]])


def closed(chain, s, done):
    least = 0
    for took, _, _ in s["x"]:
        if least == 0 or took < least:
            least = took
    took = [x[0] for x in s["x"]]
    return chain, s["win"], len(took), least, max(took), round(sum(took) / len(took), 6), sum(x[1] for x in s["x"]), s["x"][-1][2], done


def monitor_rows(seed):
    rng = random.Random(seed)
    rows = []
    for chain in ("a", "b", "c"):
        t = 1000
        for i in range({"a": 700, "b": 90, "c": 1}[chain]):
            t += rng.choice([0, 1, 20, 60, 400, 2500, 9000])
            rows.append((chain, t, i, rng.choice([0, 3, 9, 40]), rng.randint(1, 50)))
    return rows


LOG = "chain string, t bigint, id bigint, took bigint, size bigint"
COLUMNS = ("chain", "win", "n", "min_ms", "max_ms", "avg_ms", "bytes", "height", "closed")


@pytest.mark.parametrize("n,seconds", [(100, 5), (7, 5), (3, 1), (1, 5), (1000, 100)])
def test_monitor(spark, n, seconds):
    rows = monitor_rows(n)
    got = control.ingest_stats(spark.createDataFrame(rows, LOG).repartition(3), "t", "took", "size", n, seconds, ("id",), ("chain",))
    assert sorted(tuple(round(r[c], 6) if c == "avg_ms" else r[c] for c in COLUMNS) for r in got.collect()) == slow_monitor(rows, n, seconds * 1000)


def test_monitor_without_keys_and_with_null_times(spark):
    rows = [("x", *r[1:]) for r in monitor_rows(2) if r[0] == "b"]
    df = spark.createDataFrame([*rows, ("x", None, 5, 5, 5)], LOG)
    got = control.ingest_stats(df, "t", "took", "size", 9, 5, ("id",))
    assert sorted(("x", *(round(r[c], 6) if c == "avg_ms" else r[c] for c in COLUMNS[1:])) for r in got.collect()) == slow_monitor(rows, 9, 5000)
