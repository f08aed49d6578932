"""Streams with state against the same rule on whole tables."""

import random

import pytest
from pyspark.sql import functions as F

from chainloom.operators import control, staking
from chainloom.streaming import stateful

OWNER = "struct<threshold:bigint,locktime:bigint,addresses:array<string>>"
TXS = f"tx_id string, height bigint, tx_index int, block_ts bigint, tx_type string, node_id string, subnet_id string, weight bigint, start_ts bigint, end_ts bigint, validator_owner {OWNER}, delegator_owner {OWNER}, staking_tx_id string"


def run(spark, tmp_path, batches, schema, make):
    """All rows that a stream of these batches, one file each, gives, and where its checkpoint is."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{k:03d}"))
    source = spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    query = make(source).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    return spark.read.parquet(str(tmp_path / "out")).collect(), str(tmp_path / "at")


def staking_txs(seed):
    rng, rows, open_ = random.Random(seed), [], []
    kinds = [*staking.STAKING_TYPES]
    for h in range(60):
        if open_ and rng.random() < 0.45 or h >= 45 and open_:
            rows.append((f"r{h}", h, 0, h, staking.REWARD_TX, None, None, 0, 0, 0, None, None, open_.pop(rng.randrange(len(open_)))))
        elif h < 45:
            subnet = rng.choice([staking.PRIMARY, staking.PRIMARY, "other"])
            rows.append((f"t{h}", h, 0, h, rng.choice(kinds), rng.choice(["n1", "n2", "n3", ""]), subnet, 1, 0, 9, (1, 0, [f"v{rng.randrange(4)}"]), rng.choice([None, (1, 0, [f"d{rng.randrange(4)}"])]), None))
            if subnet == staking.PRIMARY or rows[-1][4] in ("AddValidatorTx", "AddDelegatorTx"):
                open_.append(f"t{h}")
    return rows, open_


@pytest.mark.parametrize("cut", [1, 20])
def test_affected_stakers(spark, tmp_path, cut):
    rows, left = staking_txs(3)
    table = spark.createDataFrame(rows, TXS)
    want = {tuple(r) for r in staking.affected_stakers(table, staking.staker_keys(table)).collect()}
    size = -(-len(rows) // (60 if cut == 1 else 3)) if cut != 1 else len(rows)
    got, at = run(spark, tmp_path, [rows[i : i + size] for i in range(0, len(rows), size)], TXS, stateful.stream_affected)
    assert {tuple(r) for r in got} == want and ("node", "") not in want
    state = spark.read.format("statestore").option("stateVarName", "meta").load(at)
    assert state.count() == len(left)


def test_finish_in_a_later_batch_than_its_start(spark, tmp_path):
    start = ("t", 1, 0, 1, "AddPermissionlessValidatorTx", "n", staking.PRIMARY, 1, 0, 9, (1, 0, ["a"]), (1, 0, ["b"]), None)
    end = ("r", 9, 0, 9, staking.REWARD_TX, None, None, 0, 0, 0, None, None, "t")
    unknown = ("q", 9, 1, 9, staking.REWARD_TX, None, None, 0, 0, 0, None, None, "nobody")
    got, at = run(spark, tmp_path, [[start], [end, unknown]], TXS, stateful.stream_affected)
    assert sorted(map(tuple, got)) == sorted([("node", "n"), ("address", "a"), ("address", "b")] * 2)
    assert spark.read.format("statestore").option("stateVarName", "meta").load(at).count() == 0


def test_monitor_windows(spark, tmp_path):
    rng, rows, t = random.Random(9), [], 0
    for i in range(400):
        t += rng.choice([0, 5, 40, 700, 6000])
        rows.append((rng.choice("ab"), t, i, rng.choice([0, 0, 4, 9]), rng.randrange(50)))
    schema = "chain string, t bigint, height bigint, ms bigint, size bigint"
    whole = control.ingest_stats(spark.createDataFrame(rows, schema), "t", "ms", "size", 30, 5, ("height",), ("chain",)).where("closed").drop("closed")
    want = sorted(tuple(r) for r in whole.select("chain", "win", "n", "min_ms", "max_ms", "avg_ms", "bytes", "height").collect())
    got, _ = run(spark, tmp_path, [rows[i : i + 90] for i in range(0, 400, 90)], schema, lambda s: stateful.stream_ingest_stats(s, 30, 5))
    assert sorted(tuple(r) for r in got) == want and len(want) > 20


def test_controller(spark, tmp_path):
    rng, rows, t = random.Random(7), [], 1_700_000_000
    for _ in range(500):
        t += rng.choice([0, 0, 1, 2, 3, 30])
        rows.append((rng.choice("ab"), t, rng.choice([50, 200, 450, 700, 1500]) if len(rows) % 100 < 60 else 40, rng.random() < (0.4 if 200 < len(rows) < 300 else 0.99)))
    rows += [(c, t + 100_000, 1, True) for c in "ab"]  # brings the watermark past all windows before
    schema = "chain string, s bigint, duration_ms bigint, success boolean"
    timed = lambda df: df.select("chain", F.timestamp_seconds("s").alias("ts"), "duration_ms", "success")
    table = control.controlled(control.request_health(timed(spark.createDataFrame(rows, schema)))).where(F.col("win_start") < F.timestamp_seconds(F.lit(t + 1)))
    want = sorted(tuple(r) for r in table.select("chain", "win_start", "n", "errors", "p95", "parallelism").collect())
    got, _ = run(spark, tmp_path, [rows[i : i + 70] for i in range(0, len(rows), 70)] + [[("c", t + 200_000, 1, True)]], schema, lambda s: stateful.stream_controller(timed(s)))
    assert sorted(tuple(r) for r in got if r.win_start.timestamp() <= t) == want
    assert len({r[-1] for r in want}) > 5


def test_levels():
    """The level moves by the rule and stays within bounds."""
    assert control.next_level(20, 9, 50, None) == 20 and control.next_level(100, 50, 11, 10) == 50
    assert control.next_level(100, 50, 0, 1001) == 98 and control.next_level(100, 50, 0, 700) == 100
    assert control.next_level(100, 50, 0, 0) == 110 and control.next_level(195, 50, 0, 0) == 200 and control.next_level(30, 50, 99, 1) == 20
