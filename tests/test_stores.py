"""Versioned state: consumers that resume, and batches merged into a keyed table."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from chainloom.operators import control, utxo
from chainloom.sources import merge_store
from chainloom.sources.versions import VersionLog
from chainloom.streaming import consumers


def test_a_version_is_won_once(spark, tmp_path):
    log = VersionLog(spark, f"file://{tmp_path}/log")
    assert log.latest() == (0, {}) and log.versions() == []
    log.commit(1, {"a": 1})
    with pytest.raises(Exception):
        log.commit(1, {"a": 2})
    log.commit(2, {"a": "é"})
    assert log.latest() == (2, {"a": "é"}) and log.read(1) == {"a": 1} and len(os.listdir(tmp_path / "log")) <= 4


def test_consumers_resume_at_their_marks(spark, tmp_path, monkeypatch):
    root, scans = str(tmp_path / "c"), []
    blocks = spark.range(1, 101).select(F.col("id").alias("block_number"), (F.col("id") % 3).alias("x"))
    seen = {"a": lambda df: scans.append("a") or df, "b": lambda df: df.where("x = 1").select("block_number")}
    assert consumers.run_consumers(blocks, {"a": seen["a"]}, root, head=30, batch=20) == {"a": 30}
    # b is killed between its output and its mark, in the second of its ranges.
    commit, calls = VersionLog.commit, []

    def dying(self, version, value):
        if "/b/" in self.folder:
            calls.append(version)
            if len(calls) == 2:
                raise RuntimeError("killed")
        commit(self, version, value)

    monkeypatch.setattr(VersionLog, "commit", dying)
    with pytest.raises(RuntimeError):
        consumers.run_consumers(blocks, seen, root, head=80, batch=25)
    assert (consumers.mark(spark, root, "a"), consumers.mark(spark, root, "b")) == (50, 25)
    assert consumers.consumer_output(spark, root, "b").agg(F.max("block_number")).first()[0] == 25
    low = control.global_watermark(consumers.marks(spark, root, ["a", "b"])).first()
    assert (low.chain, low.watermark) == ("p", 25)
    # The next run reads other ranges, so what the killed one left is not read.
    assert consumers.run_consumers(blocks, seen, root, batch=40) == {"a": 100, "b": 100}
    assert sorted(r[0] for r in consumers.consumer_output(spark, root, "a").select("block_number").collect()) == list(range(1, 101))
    assert sorted(r[0] for r in consumers.consumer_output(spark, root, "b").collect()) == [i for i in range(1, 101) if i % 3 == 1]
    assert consumers.run_consumers(blocks, seen, root) == {"a": 100, "b": 100} and consumers.consumer_output(spark, root, "none") is None


OUT = "utxo_id string, created_on string, consumed_on string, utxo_type string, amount bigint, note string"
SPEND = "store_chain string, utxo_id string, consuming_tx string, consuming_ts bigint, order_key struct<ts:bigint,tx_id:string>"


def ledger(rng, n):
    outputs = [(f"u{i}", "p", rng.choice(["p", "x"]), "TRANSFER", rng.randrange(1, 99), None) for i in range(n)]
    spends = [(rng.choice(["p", "x"]), f"u{rng.randrange(n)}", f"t{k}", k, (k, f"t{k}")) for k in range(n // 2)]
    rng.shuffle(spends)
    return outputs, spends


def test_ten_batches_give_the_rows_of_one(spark, tmp_path):
    rng = random.Random(6)
    outputs, spends = ledger(rng, 300)
    whole = utxo.derive_utxos(spark.createDataFrame(outputs, OUT), spark.createDataFrame(spends, SPEND))
    want = sorted(map(str, whole.select("store_chain", "utxo_id", "amount", "consuming_tx", "consuming_ts").collect()))
    store = merge_store.utxo_store(spark, str(tmp_path / "u"), 8)
    order = list(range(10))
    for k in order:
        some = spark.createDataFrame(outputs[k * 30 : (k + 1) * 30], OUT), spark.createDataFrame(spends[k * 15 : (k + 1) * 15], SPEND)
        assert merge_store.merge_utxos(store, k, *some) == k + 1
        assert merge_store.merge_utxos(store, k, *some) == k + 1  # delivered again
    got = merge_store.stored_utxos(store)
    assert sorted(map(str, got.select("store_chain", "utxo_id", "amount", "consuming_tx", "consuming_ts").collect())) == want
    first = store.read(1)
    assert first.where("amount is not null").select("utxo_id").distinct().count() == 30
    keys = spark.createDataFrame([("p", "u7"), ("p", "u8")], "store_chain string, utxo_id string")
    assert {r.utxo_id for r in store.read_keys(keys).collect()} == {"u7", "u8"}
    assert store.vacuum(1) and sorted(map(str, merge_store.stored_utxos(store).select("store_chain", "utxo_id", "amount", "consuming_tx", "consuming_ts").collect())) == want


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store = merge_store.MergeStore(spark, str(tmp_path / "s"), ("k",), 16)
    assert store.read() is None and store.read_keys(spark.range(1).selectExpr("id as k")) is None
    store.merge(1, spark.range(200).selectExpr("id as k", "id as a", "cast(null as string) as b"))
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{tmp_path}/s/data/**/*.parquet", recursive=True)}
    before = store.log.latest()[1]["files"]
    reader = store.read()
    store.merge(2, spark.createDataFrame([(5, None, "new")], "k bigint, a bigint, b string"))
    after = store.log.latest()[1]["files"]
    assert sum(before[b] != after[b] for b in before) == 1 and all(os.path.getmtime(f) == t for f, t in files.items())
    assert [tuple(r) for r in store.read().where("k = 5").collect()] == [(5, 5, "new")] and store.read().count() == 200
    assert reader.where("b = 'new'").count() == 0  # a reader keeps its version
    store.merge(3, spark.createDataFrame([], "k bigint, a bigint, b string"))
    assert store.log.latest()[0] == 3 and store.read().count() == 200
    assert store.merge(2, spark.range(5).selectExpr("id as k")) == 3  # an old batch


def test_new_columns_join_a_store(spark, tmp_path):
    store = merge_store.MergeStore(spark, str(tmp_path / "n"), ("k",), 4)
    store.merge(1, spark.range(10).selectExpr("id as k", "id as a"))
    store.merge(2, spark.range(4).selectExpr("id as k", "'x' as extra"))
    store.merge(3, spark.range(100, 101).selectExpr("id as k", "'y' as extra"))
    assert store.read().where("extra = 'x'").count() == 4 and store.read().where("a is not null").count() == 10


def test_a_merge_shuffles_and_writes_a_row_once(spark, tmp_path, monkeypatch):
    """A batch that comes from files is not staged; rows go by key to tasks of one bucket each, with no other exchange."""
    plans, given = [], merge_store.last_given
    monkeypatch.setattr(merge_store, "last_given", lambda rows, keys: plans.append(given(rows, keys)) or plans[-1])
    spark.range(4000).selectExpr("id as k", "id as a").write.parquet(str(tmp_path / "in"))
    batch = spark.read.parquet(str(tmp_path / "in"))
    store = merge_store.MergeStore(spark, str(tmp_path / "s"), ("k",), 8)
    store.merge(1, batch.where("k < 3000"), stored=True)
    store.merge(2, batch.where("k >= 2000").selectExpr("k", "'x' as b"), stored=True)
    assert not (tmp_path / "s" / "_staged").exists() and sorted(map(tuple, store.read().select("k", "a", "b").collect())) == [(k, k if k < 3000 else None, "x" if k >= 2000 else None) for k in range(4000)]
    assert [p._jdf.queryExecution().executedPlan().toString().count("Exchange ") for p in plans] == [1, 1]
    assert all(len(glob.glob(f"{tmp_path}/s/{f}/*.parquet")) == 1 for f in store.log.latest()[1]["files"].values())


def test_a_table_begun_by_the_older_hash_keeps_it(spark, tmp_path):
    store = merge_store.MergeStore(spark, str(tmp_path / "o"), ("k",), 4)
    old = spark.range(100).selectExpr("id as k", "id as a", "cast(pmod(xxhash64(id), 4) as int) as _bucket")
    old.write.partitionBy("_bucket").parquet(str(tmp_path / "o/data/1"))
    store.log.commit(1, {"files": {str(b): f"data/1/_bucket={b}" for b in range(4)}, "schema": old.drop("_bucket").schema.json(), "batch": 1, "buckets": 4})
    for k in (2, 3):
        store.merge(k, spark.range(40, 50).selectExpr("id as k", f"id + {k} as a"))
    assert sorted(map(tuple, store.read().collect())) == [(k, k + 3 if 40 <= k < 50 else k) for k in range(100)]
    assert {tuple(r) for r in store.read_keys(spark.range(45, 56).selectExpr("id as k")).collect()} == {(k, k + 3 if k < 50 else k) for k in range(45, 56)}
