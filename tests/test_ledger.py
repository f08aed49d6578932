"""Typed transactions of three chains to the UTXO table, and the queries over it at the edges of time."""

import os
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from chainloom.operators import balances, control, ordered, quality, registry, staking, utxo, validators
from chainloom.sources.schemas import IN, OUT
from chainloom.streaming import jobs


def out(i, kind="transfer", owners=("a",), amount=5, **k):
    return {"kind": kind, "asset_id": "A", "amount": D(amount), "addresses": list(owners), "threshold": 1, "locktime": D(0), "group_id": 3, "payload": "pp", "utxo_id": i, "utxo_bytes": "0x"} | k


P_TX = f"tx_id string, tx_type string, height bigint, block_ts bigint, tx_index int, ins array<{IN}>, outs array<{OUT}>, stake_outs array<{OUT}>, exported_outs array<{OUT}>, dest_chain string, imported_ins array<{IN}>, source_chain string, start_ts bigint, end_ts bigint, node_id string, staking_tx_id string, validator_owner struct<addresses array<string>>, delegator_owner struct<addresses array<string>>, weight decimal(20,0), subnet_id string"


def p(spark, *rows):
    names = [f.name for f in spark.createDataFrame([], P_TX).schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], P_TX)


@pytest.fixture(scope="module")
def ptx(spark):
    return p(
        spark,
        {"tx_id": "t1", "tx_type": "AddValidatorTx", "height": 1, "block_ts": 100, "tx_index": 0, "outs": [out("u0"), out("u1", owners=())], "stake_outs": [out("u2", "stake_lock", locktime=D(900))], "start_ts": 0, "end_ts": 500, "node_id": "n", "validator_owner": {"addresses": ["r"]}, "weight": D(5)},
        {"tx_id": "t2", "tx_type": "ExportTx", "height": 2, "block_ts": 200, "tx_index": 0, "ins": [{"utxo_id": "u0", "amount": D(5)}], "outs": [out("u3")], "exported_outs": [out("u4", "nft_transfer"), out("u5", "unknown")], "dest_chain": "x"},
        {"tx_id": "t3", "tx_type": "ImportTx", "height": 3, "block_ts": 300, "tx_index": 0, "imported_ins": [{"utxo_id": "u9", "amount": D(7)}], "source_chain": "c", "outs": [out("u6", owners=("b", "a"))]},
        {"tx_id": "t4", "tx_type": "RewardValidatorTx", "height": 4, "block_ts": 600, "tx_index": 0, "staking_tx_id": "t1"},
    )


def test_outputs(spark, ptx):
    rows = {r.utxo_id: r for r in utxo.staking_attributes(utxo.p_outputs(ptx)).collect()}
    assert set(rows) == {"u0", "u2", "u3", "u4", "u6"}
    assert [(rows[i].output_index, rows[i].utxo_type) for i in ("u0", "u2", "u4")] == [(0, "TRANSFER"), (2, "STAKEABLE_LOCK"), (1, "NFT_TRANSFER")]
    assert (rows["u2"].stake_start, rows["u2"].stake_end, rows["u2"].reward_addresses, int(rows["u2"].stakeable_locktime)) == (100, 500, ["r"], 900)
    assert rows["u0"].stake_start is None and rows["u4"].payload == "pp"
    fanned = utxo.fan_out_chains(utxo.p_outputs(ptx)).where("utxo_id = 'u4'").collect()
    assert sorted((r.store_chain, r.utxo_type) for r in fanned) == [("p", "NFT_TRANSFER"), ("x", "nft_transfer")]


def test_spends_and_merge(spark, ptx):
    s = utxo.spends(ptx, "p").unionByName(utxo.import_spends(ptx, "p"))
    assert sorted((r.store_chain, r.utxo_id, r.consuming_tx) for r in s.collect()) == [("c", "u9", "t3"), ("p", "u0", "t2"), ("p", "u9", "t3")]
    merged = {(r.store_chain, r.utxo_id): r for r in utxo.derive_utxos(utxo.p_outputs(ptx), s).collect()}
    assert merged["p", "u0"].consuming_tx == "t2" and merged["p", "u0"].consumed_on == "p" and merged["p", "u3"].consuming_tx is None
    whole = sorted(map(str, merged.values()))
    parts = [utxo.p_outputs(ptx.where(f"height = {h}")) for h in (4, 2, 3, 1)]
    again = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    assert sorted(map(str, utxo.derive_utxos(again, s).collect())) == whole


def test_rewards(spark, ptx):
    r = spark.createDataFrame([("t1", 0, "w1", 3, out("w1", owners=("z",))), ("t1", 1, "w2", 4, out("w2", owners=("r",), amount=9)), ("t1", 2, "w3", 5, out("w3", owners=("r",)))], f"staking_tx_id string, position int, utxo_id string, output_index bigint, out {OUT}")
    made = utxo.reward_outputs(ptx, r).collect()
    assert {x.utxo_id for x in made} == {"w1", "w2", "w3"} and all(x.is_reward and not x.staked for x in made)
    assert utxo.staking_outputs_map(utxo.p_outputs(ptx), ptx).count() == 0
    records = staking.complete_staking(staking.staking_records(ptx), ptx.where("tx_type = 'RewardValidatorTx'"))
    m = staking.match_reward_utxo(records, r).first()
    assert (m.reward_utxo_id, int(m.reward_amount), m.completed) == ("w2", 9, True)
    assert staking.match_reward_utxo(records, r, all_matches=True).count() == 2
    assert staking.match_reward_utxo(records, r.limit(0)).first().reward_utxo_id == "NONE"
    assert sorted(map(tuple, staking.affected_stakers(ptx.where("height = 4"), staking.staker_keys(ptx)).collect())) == [("address", "r"), ("node", "n")]


def test_x_and_c_outputs(spark):
    kind = f"tx_id string, tx_type string, outs array<{OUT}>, states array<array<{OUT}>>, ops array<struct<asset_id:string,utxo_ids:array<string>,outs:array<{OUT}>>>, exported_outs array<{OUT}>, dest_chain string, ins array<{IN}>, ts bigint"
    x = spark.createDataFrame([("x1", "CreateAssetTx", [out("a")], [[out("b")], [out("c")]], None, None, None, None, 1), ("x2", "OperationTx", [out("d")], None, [("A", ["b"], [out("e")])], [out("f")], "p", [{"utxo_id": "a", "amount": D(1)}], 2)], kind)
    rows = {r.utxo_id: r for r in utxo.x_outputs(x).collect()}
    assert [(rows[i].output_index, rows[i].asset_id) for i in "abcdef"] == [(0, "A"), (1, "x1"), (2, "x1"), (0, "A"), (1, "A"), (2, "A")]
    assert {r.utxo_id for r in utxo.spends(x, "x").collect()} == {"a", "b"}
    c = spark.createDataFrame([("c1", 1, "export", "p", [out("g")]), ("c2", 2, "export", "x", [out("h")]), ("c3", 3, "import", "p", None)], f"tx_id string, ts bigint, kind string, dest_chain string, exported_outs array<{OUT}>")
    assert {r.utxo_id for r in utxo.c_outputs(c).collect()} == {"g"} and utxo.c_outputs(c, only_p=False).count() == 2
    assert [r.is_batch for r in utxo.atomic_blocks(spark.createDataFrame([(1, bytearray(b"x")), (2**33, bytearray(b"y")), (3, bytearray(b""))], "ts bigint, extra_data binary")).orderBy("ts").collect()] == [False, True]
    history = utxo.utxo_history(utxo.x_outputs(x), utxo.spends(x, "x"), x, "a").collect()
    assert ("a", "x2", "consumed") in {(r.utxo_id, r.tx_id, r.event) for r in history}


def test_as_of_edges(spark):
    u = spark.createDataFrame([("u", 100, 200)], "utxo_id string, created_ts bigint, consuming_ts bigint")
    at = lambda t, **k: balances.as_of(u, F.lit(t), **k).count()
    assert [at(t) for t in (99, 100, 101, 199, 200, 201)] == [0, 0, 1, 1, 0, 0] and at(100, inclusive=True) == 1


def test_categories(spark):
    cols = "utxo_id string, asset_id string, amount bigint, consumed_on string, created_on string, staked boolean, stake_start bigint, stake_end bigint, platform_locktime bigint, stakeable_locktime bigint"
    rows = [("a", "A", 1, "p", "p", False, None, None, 0, 0), ("b", "A", 2, "p", "p", False, None, None, 99, 0), ("c", "A", 3, "p", "p", False, None, None, 0, 99), ("d", "A", 4, "p", "p", True, 1, 99, 0, 0), ("e", "A", 5, "p", "p", True, 60, 99, 0, 0), ("f", "A", 6, "p", "p", True, 1, 50, 0, 0), ("g", "A", 7, "x", "p", False, None, None, 0, 0), ("h", "A", 8, "x", "p", False, None, None, 99, 0), ("i", "Z", 0, "p", "p", False, None, None, 0, 0), ("j", "A", 10, "p", "p", True, 1, 50, 99, 0), ("k", "A", 20, "p", "p", True, 1, 40, None, 99), ("l", "A", 30, "", "p", True, 1, None, 0, 0), ("m", "A", 40, None, "p", True, None, 99, 99, 0)]
    u = spark.createDataFrame(rows, cols)
    got = {(r.category, r.asset_id): (int(r.total), r.n) for r in balances.p_balances(u, F.lit(50)).collect()}
    assert got == {("unlockedUnstaked", "A"): (7, 2), ("lockedPlatform", "A"): (2, 1), ("lockedStakeable", "A"): (3, 1), ("unlockedStaked", "A"): (34, 2), ("lockedStaked", "A"): (40, 1), ("lockedNotStakeable", "A"): (30, 2), ("pendingStaked", "A"): (5, 1), ("atomicMemoryUnlocked", "A"): (7, 1), ("atomicMemoryLocked", "A"): (8, 1)}
    assert balances.c_balances(u, F.lit(50)).where("total = 0").count() == 1
    text = balances.balances_json(balances.p_balances(u, F.lit(50)), balances.P_CATEGORIES).first().balances
    assert '"lockedNotStakeable":[{' in text and '"amount":"8"' in text and "pendingExport" in text


def test_removals_take_the_oldest_open_start(spark):
    v = spark.createDataFrame([("v1", "n", "s", 10), ("v2", "n", "s", 20), ("v3", "m", "s", 5)], "tx_hash string, node_id string, subnet_id string, start bigint")
    r = spark.createDataFrame([("r0", "n", "s", 9), ("r1", "n", "s", 15), ("r2", "n", "s", 30), ("r3", "k", "s", 1)], "tx_id string, node_id string, subnet_id string, ts bigint")
    # Without block times all registrations are known: r0 takes a term that has not begun.
    assert {x.tx_hash: x.remove_tx for x in validators.apply_removals(v, r).collect()} == {"v1": "r0", "v2": "r1", "v3": None}
    late = v.withColumn("block_ts", F.when(F.col("tx_hash") == "v1", 12).otherwise(5).cast("bigint"))
    assert {x.tx_hash: x.remove_tx for x in validators.apply_removals(late, r).collect()} == {"v1": "r1", "v2": "r0", "v3": None}
    rng = random.Random(3)
    vals = [(f"v{i}", f"n{rng.randrange(4)}", "s", rng.randrange(100), rng.choice([None, rng.randrange(150)]), rng.randrange(110)) for i in range(120)]
    removals = [(f"r{i}", f"n{rng.randrange(4)}", "s", rng.randrange(130)) for i in range(90)]
    want, gone = {}, set()
    for name, node, _, ts in sorted(removals, key=lambda x: (x[3], x[0])):
        live = sorted((start, h) for h, n, _, start, paid, seen in vals if n == node and seen <= ts and h not in gone and (paid is None or paid > ts))
        if live:
            gone.add(live[0][1])
            want[live[0][1]] = name
    rows = spark.createDataFrame(vals, "tx_hash string, node_id string, subnet_id string, start bigint, reward_ts bigint, block_ts bigint")
    got = validators.apply_removals(rows, spark.createDataFrame(removals, r.schema)).collect()
    assert {x.tx_hash: x.remove_tx for x in got if x.remove_tx} == want and len(got) == 120


def test_global_orders(spark):
    rng = random.Random(5)
    ids = rng.sample(range(10_000), 700)
    df = spark.createDataFrame([(i, rng.randrange(50)) for i in ids], "id bigint, x bigint").repartition(7)
    rows = {r.id: r for r in ordered.numbered(ordered.running_sum(ordered.lagged(df, "x", ("id",)), "x", ("id",)), ("id",)).collect()}
    total, last = 0, None
    for n, i in enumerate(sorted(ids)):
        total += rows[i].x
        assert (rows[i].n, rows[i].total, rows[i].previous) == (n, total, last)
        last = rows[i].x
    xs = sorted(r.x for r in rows.values())
    assert all(ordered.value_at(df, "x", k) == xs[k] for k in (0, 1, 350, 699))
    assert quality.diff_summary(df.withColumnRenamed("x", "diff").limit(0)).collect() == [(None, None, None, None)]


def test_seed_and_export_ranges(spark):
    subnet, chains = registry.primary_network_seed(spark, 5)
    s = subnet.first()
    assert (s.subnet_id, s.created_height, s.created_ts, s.current_owner.addresses, s.is_l1) == ("11111111111111111111111111111111LpoYY", -1, 1599696000, [""], False)
    assert [(c.name, c.block, c.evm_chain_id) for c in chains.orderBy("name").collect()] == [("C-Chain", -1, 43113), ("P-Chain", -1, None), ("X-Chain", -1, None)]
    heights = lambda rows: spark.createDataFrame(rows, "chain string, height bigint")
    got = control.export_range(heights([("a", 4), ("b", 99), ("c", 10)]), heights([("a", 50), ("b", 99), ("c", 15), ("d", 2)]), batch=10).collect()
    assert sorted(map(tuple, got)) == [("a", 5, 14, True), ("c", 11, 15, False), ("d", 0, 2, False)]


def test_exports_come_batch_by_batch(spark, tmp_path):
    from chainloom.sources import sinks

    blocks = spark.range(25).select(F.col("id").alias("block_number"), F.col("id").alias("n"))
    run = lambda head: jobs.export_next(blocks, spark.createDataFrame([(head,)], "height bigint"), str(tmp_path), batch=10, transform=lambda b: {"t": b})
    assert [run(24), run(24), run(24), run(24)] == [(10, True), (10, True), (5, False), (0, False)]
    assert sorted(r.n for r in sinks.read_export(spark, str(tmp_path), "t").collect()) == list(range(25))


def test_frames_and_sequence(spark):
    rows = spark.createDataFrame([("a", i, n) for i, n in enumerate((4, 4, 4, 20, 1, 9))] + [("b", 0, 5)], "k string, i int, n int")
    got = control.frames_by_size(rows, "k", "i", "n", 10).orderBy("k", "i").collect()
    assert [r.frame for r in got] == [0, 0, 1, 2, 3, 3, 0]
    marks = spark.createDataFrame([(1, 10), (2, 30)], "id int, ts bigint")
    back = control.delta_decode(control.delta_encode(marks, ("ts", "id")).withColumnRenamed("id", "pos").drop("ts"))
    assert sorted(r.ts for r in back.collect()) == [10, 30]
    with pytest.raises(ValueError):
        control.min_unique_prefix(spark.createDataFrame([("abcdefgh1",), ("abcdefgh2",)], "id string"))
    assert control.min_unique_prefix(spark.createDataFrame([("abcd1",), ("abce2",)], "id string")) == 4
    txs = spark.createDataFrame([("a", 0), ("b", 1)], "tx_id string, ts bigint")
    dim = spark.createDataFrame([("a", 7)], "id string, ts bigint")
    assert sorted(r.ts for r in control.fix_timestamps(txs, dim).collect()) == [1, 7]
    with pytest.raises(Exception, match="no time for b"):
        control.fix_timestamps(txs, dim, on_missing="error").collect()


def test_nested_diff(spark):
    j = lambda rows: spark.createDataFrame(rows, "id int, j string")
    a = j([(1, '{"u":[{"utxoId":"x","n":1.0,"t":5},{"utxoId":"y","n":2}]}')])
    b = j([(1, '{"u":[{"utxoId":"y","n":2},{"utxoId":"x","n":1.001,"t":6}]}')])
    assert {r.path for r in quality.diff_nested(a, b, "id", "j").collect()} == {"$.u[x].n", "$.u[x].t"}
    assert [r.path for r in quality.diff_nested(a, b, "id", "j", approx={"n": 0.01}).collect()] == ["$.u[x].t"]
    assert quality.diff_nested(a, b, "id", "j", skip=("t",), approx={"n": 0.01}).count() == 0
    assert spark.range(1).select(quality.json_equal(F.lit('{"a":1,"b":2}'), F.lit('{"b": 2, "a": 1}')).alias("x")).first().x


def test_subnets_and_snapshots(spark, tmp_path):
    own = lambda a: {"addresses": [a]}
    cols = "tx_id string, tx_type string, height bigint, tx_index int, block_ts bigint, subnet_id string, subnet_owner struct<addresses array<string>>, manager_chain_id string, manager_address string, chain_name string, vm_id string, genesis binary"
    rows = [("s1", "CreateSubnetTx", 1, 0, 10, None, own("a"), None, None, None, None, None), ("t", "TransferSubnetOwnershipTx", 2, 0, 20, "s1", own("b"), None, None, None, None, None), ("t2", "TransferSubnetOwnershipTx", 2, 1, 20, "s1", own("c"), None, None, None, None, None), ("k", "ConvertSubnetToL1Tx", 3, 0, 30, "s1", None, "mc", "ma", None, None, None), ("z", "ConvertSubnetToL1Tx", 3, 0, 30, "s9", None, "mc", "ma", None, None, None), ("ch", "CreateChainTx", 4, 0, 40, "s1", None, None, None, "C", "vm", bytearray(b'{"config":{"chainId":7}}'))]
    tx = spark.createDataFrame(rows, cols)
    s = registry.subnets(tx).collect()
    assert len(s) == 1 and (s[0].create_owner.addresses, s[0].current_owner.addresses, s[0].is_l1, s[0].l1_tx_id) == (["a"], ["c"], True, "k")
    assert registry.blockchains(tx).first().genesis == '{"config":{"chainId":7}}' and registry.subnet_blockchains(tx).first().evm_chain_id == 7
    path = str(tmp_path / "snap")
    registry.snapshot_refresh(lambda: spark.range(3), path)
    with pytest.raises(ZeroDivisionError):
        registry.snapshot_refresh(lambda: 1 / 0, path)
    assert registry.read_snapshot(spark, path).count() == 3
    old = registry.read_snapshot(spark, path)
    assert registry.snapshot_refresh(lambda: spark.range(5), path).count() == 5 and old.count() == 3
    registry.snapshot_refresh(lambda: spark.range(6), path)
    assert len([f for f in os.listdir(f"{path}/data") if not f.startswith(".")]) == 2
    with pytest.raises(ValueError):
        registry.read_snapshot(spark, str(tmp_path / "nothing"))


def test_streams(spark, tmp_path):
    src = str(tmp_path / "halves")
    spark.createDataFrame([("u1", "spend", 9), ("u2", "output", 3)], "utxo_id string, half string, ts bigint").write.parquet(src)
    run = lambda: jobs.pair_halves(spark.readStream.schema("utxo_id string, half string, ts bigint").parquet(src)).writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    run()
    spark.createDataFrame([("u1", "output", 4)], "utxo_id string, half string, ts bigint").write.mode("append").parquet(src)
    run()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).collect()] == [("u1", 4, 9)]
    touch = str(tmp_path / "touch")
    spark.createDataFrame([(["a", "b"], ["p"]), (["a"], ["p", "x"])], "addresses array<string>, chains array<string>").write.parquet(touch)
    jobs.stream_address_chains(spark.readStream.schema("addresses array<string>, chains array<string>").parquet(touch), str(tmp_path / "ac"), str(tmp_path / "cp2")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "ac")).collect())) == [("a", "p"), ("a", "x"), ("b", "p")]
    blocks = str(tmp_path / "seq")
    spark.createDataFrame([("c", h) for h in (1, 2, 4)] + [("d", 7)], "chain string, height bigint").write.parquet(blocks)
    q = jobs.stream_sequence(spark.readStream.schema("chain string, height bigint").parquet(blocks)).writeStream.format("parquet").option("path", str(tmp_path / "gaps")).option("checkpointLocation", str(tmp_path / "cp3")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "gaps")).collect()] == [("c", 2, 4)]
