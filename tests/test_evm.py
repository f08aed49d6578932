"""Blocks from compressed JSON lines to six tables, their sinks, and the checks on what is read."""

import json

import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.functions import deep_json
from chainloom.operators import evm, quality
from chainloom.sources import readers, schemas, sinks
from chainloom.streaming import jobs

TOP = "0x" + "f" * 64


def block(n):
    tx = {"hash": f"0xt{n}", "nonce": "0x1", "blockHash": f"0xb{n}", "blockNumber": hex(n), "transactionIndex": "0x0", "from": "0xA", "to": "", "value": "0xde0b6b3a7640000", "gas": "0x5208", "gasPrice": "0x3b9aca00", "input": "0x", "type": "0x0"}
    log = {"address": "0xc", "topics": [TOP, "0x1"], "data": "0x", "blockNumber": hex(n), "transactionHash": tx["hash"], "transactionIndex": "0x0", "blockHash": f"0xb{n}", "logIndex": "0x2", "removed": False}
    receipt = {"blockHash": f"0xb{n}", "contractAddress": "", "cumulativeGasUsed": "0x1", "effectiveGasPrice": "0x1", "from": "0xA", "gasUsed": "0x1", "logs": [log], "status": "0x1", "to": "", "transactionHash": tx["hash"], "transactionIndex": "0x0"}
    leaf = {"from": "0xB", "to": "0xC", "gas": "0x1", "gasUsed": "0x1", "input": "0x", "type": "call", "value": "0x2"}
    tree = leaf | {"to": "", "type": "create", "error": "reverted", "calls": [leaf | {"calls": [leaf]}] + [leaf] * 11}
    return {"block": {"number": hex(n), "hash": f"0xb{n}", "parentHash": f"0xb{n - 1}", "timestamp": hex(1_600_000_000 + n), "size": "0x10", "gasLimit": "0x1", "gasUsed": "0x1", "baseFeePerGas": "0x0", "extraData": "0xff", "receiptsRoot": "0xr", "stateRoot": "0xs", "transactions": [tx]}, "traces": [{"txHash": tx["hash"], "result": json.dumps(tree)}, {"txHash": "0xnone", "result": None}], "receipts": [receipt]}


@pytest.fixture(scope="module")
def nb(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("blocks") / "blocks.jsonl.zst"
    path.write_bytes(zstandard.compress("\n\n".join(json.dumps(block(n)) for n in (7, 8)).encode()))
    return readers.read_normalized_blocks(spark, str(path)).cache()


def test_tables(nb):
    tables = evm.transform_batch(nb)
    for name, df in tables.items():
        assert df.columns == [f.split()[0] for f in schemas.EVM_TABLES[name].replace("decimal(38,0)", "decimal").split(", ")]
    b = tables["blocks"].orderBy("blocknumber").first()
    assert (b.blocknumber, b.blockbasefeepergas, b.blockreceipthash, b.blockreceiptsroot, b.blockextradata, b.blocktransactionlen, str(b.partition_date)) == (7, None, "0xr", "0xs", "/w==", 1, "2020-09-13")
    t = tables["transactions"].first()
    assert (t.transactioncost, t.transactionto, t.transactionmaxfeepergas, t.transactiontype) == (21000 * 10**9 + 10**18, "0x", 10**9, "0")
    assert tables["messages"].first().transactionmessageto == ""
    assert tables["receipts"].first().transactionreceiptcontractaddress == evm.ZERO_ADDRESS
    g = tables["logs"].first()
    assert (g.topicdec_0, g.topichex_1, g.topicdec_1, g.topichex_3, g.topicdec_3) == (str(2**256 - 1), "0x1", "1", "", "")


def test_calls_are_in_preorder(nb):
    rows = evm.evm_internal_txs(nb).where("blocknumber = 7").orderBy("trace_position").collect()
    assert [r.callindex for r in rows] == ["call_0", "call_0_0", "call_0_0_0"] + [f"call_0_{i}" for i in range(1, 12)]
    assert [r.trace_position for r in rows] == list(range(14))
    assert rows[0].revert and rows[0].type == "CREATE" and rows[0].to_address == "0x" and not rows[1].revert and rows[1].from_address == "0xb"


def test_trees_of_any_depth(spark):
    tree = "{}"
    for i in range(1500):
        tree = f'{{"type":"t{i}","calls":[{tree}]}}'
    rows = spark.createDataFrame([(1, tree), (2, None), (3, "no json"), (4, '[1]'), (5, '{"calls":null}')], "k int, tree string")
    got = evm.flatten_tree(rows, "tree", "type string", "calls").collect()
    assert [(r.k, r.position) for r in got] == [(1, i) for i in range(1501)] + [(5, 0)]
    assert got[0].node.type == "t1499" and got[1500].path == [0] * 1500


def test_trees_without_rows_are_named(spark):
    deep = '{"calls":[' * 6000 + "{}" + "]}" * 6000
    rows = spark.createDataFrame([(1, "{}"), (2, None), (3, "no json"), (4, "[1]"), (5, '{"calls":null}'), (6, deep), (7, deep[:-1]), (8, ""), (9, "5")], "k int, tree string")
    named = {r.k: r.reason for r in evm.unreadable_trees(rows, "tree").collect()}
    assert sorted(named) == [3, 4, 7, 8, 9] and all(named[k].startswith("no JSON: ") for k in (3, 7, 8))
    assert (named[4], named[9]) == ("no object: list", "no object: int")
    opened = {r.k for r in evm.flatten_tree(rows, "tree", "type string", "calls").select("k").distinct().collect()}
    assert opened == {1, 5, 6} and evm.unreadable_trees(rows.limit(0), "tree").count() == 0


def test_trees_beyond_the_stack(spark):
    """Trees that the standard parser has no stack for give their rows, and what is broken or odd ends no job."""
    n = 6000
    tree = '{"calls":[' * n + '{"type":"leaf"}' + "]}" * n
    odd = '{"type":"odd","x":' + "[" * 100_000 + "]" * 100_000 + ',"calls":[{"type":"below"}]}'
    rows = spark.createDataFrame([(1, tree), (2, "[" * 100_000), (3, '{"calls":5,"type":"five"}'), (4, odd)], "k int, tree string")
    got = evm.flatten_tree(rows, "tree", "type string", "calls").select("k", "position", "node.type", F.size("path").alias("depth")).collect()
    assert [r.position for r in got if r.k == 1] == list(range(n + 1)) and next(r for r in got if r.k == 1 and r.type == "leaf").depth == n
    assert [(r.k, r.type, r.depth) for r in got if r.k > 1] == [(3, "five", 0), (4, None, 0), (4, "below", 1)]
    deep = '{"a":' * 100_000 + "1.50" + "}" * 100_000
    found = quality.leaves(spark.createDataFrame([(1, deep), (2, deep[:-1])], "id int, answer string"), "id", "answer").select("id", F.length("path").alias("n"), F.left("value", F.lit(9)).alias("value")).collect()
    assert [tuple(r) for r in found] == [(1, 200_001, "1.50"), (2, 1, deep[:9])]


@pytest.mark.parametrize("text", ["1", "-0.5e3", '"a\\u00e9\\n"', "[]", "{}", "[1, [2, {}], []]", '{"a": {"b": [true, false, null]}, "c": -1}', " [ 1 , 2 ] ", '{"a":1,"a":2}', "NaN", "[-Infinity]", "", "[", "[1", "[1,]", '{"a"}', '{"a":}', "{1:2}", "1 2", "tru", "[1}", '{"a":1]', "\"", "01", "-"])
def test_deep_parser_agrees_with_the_standard_one(text):
    for as_text in (False, True):
        try:
            want = json.loads(text, parse_int=str, parse_float=str, parse_constant=str) if as_text else json.loads(text)
        except ValueError:
            with pytest.raises(ValueError):
                deep_json.deep(text, as_text)
        else:
            assert repr(deep_json.deep(text, as_text)) == repr(want)


def test_strict_schema(spark):
    kind = T.StructType.fromDDL("a string, b array<struct<c string>>")
    lines = spark.createDataFrame([('{"a":"1","b":[{"c":"x"}]}',), ('{"a":"1","z":2,"b":[{"c":"x"},{"d":1}]}',)], "value string")
    assert [r.unknown for r in readers.strict_schema_check(lines, kind).collect()] == [[], ["$: z", "$.b[]: d"]]


def test_assembly_and_traces(spark, nb):
    b = nb.select(F.col("block.number").alias("number"), F.col("block.transactions").alias("transactions"))
    receipts, traces = nb.select(F.explode("receipts").alias("r")).select("r.*"), nb.select(F.explode("traces").alias("t")).select("t.*").where("txHash = '0xt7'")
    out, missing = evm.assemble_blocks(b, receipts.where("transactionHash = '0xt7'"), traces)
    assert {r.number: r.receipts and len(r.receipts) for r in out.collect()} == {"0x7": 1, "0x8": None}
    assert [r.transactionHash for r in missing.collect()] == ["0xt8"]
    txs = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "block_number int, tx_index int, tx_hash string")
    got = evm.align_block_traces(txs, spark.createDataFrame([(1, ["T0"])], "block_number int, traces array<string>"), spark.createDataFrame([("b", "own", None), ("c", "bad", "incorrect number of top-level calls")], "tx_hash string, result string, error string"))
    assert {r.tx_hash: r.trace for r in got.collect()} == {"a": "T0", "b": "own", "c": None}


def test_binary_records(spark):
    n = lambda v, size: v.to_bytes(size, "big")
    raw = n(1, 8) + n(2, 8) + bytes(range(32)) + bytes(32) + n(3, 4) + n(4, 4) + n(5, 8) + n(6, 8) + n(2**64 - 1, 8) + b"\x01" * 20 + b"\x02" * 32 + n(4, 4) + b"tail"
    assert len(raw) == 172
    good, bad = readers.decode_cblock_records(spark.createDataFrame([(bytearray(raw),), (bytearray(raw[:-1]),), (bytearray(b"short"),), (None,)], "raw binary"))
    (r,) = good.collect()
    assert (r.height, r.ts, r.size, r.tx_count, r.gas_limit, r.gas_used, r.base_fee, bytes(r.extra_data)) == (1, 2, 3, 4, 5, 6, 2**64 - 1, b"tail") and bad.count() == 3
    assert (r.hash, r.miner, r.ext_data_hash) == ("0x" + bytes(range(32)).hex(), "0x" + "01" * 20, "0x" + "02" * 32)
    x = readers.raw_x_txs(spark.createDataFrame([(1, bytearray((1600000000).to_bytes(8, "big") + b"zz"))], "idx int, raw binary")).first()
    assert (x.ts, bytes(x.tx_bytes)) == (1600000000, b"zz")
    pages = spark.createDataFrame([('{"vertices":[{"hash":"v","timestamp":"2020-09-13T12:26:40.123456789Z","transactions":["t"]}]}',)], "page string")
    assert [tuple(r) for r in readers.read_vertices(pages).collect()] == [("v", 1600000000, "vertex"), ("t", 1600000000, "tx")]


def test_catalogue_headers_and_samples(spark, nb, tmp_path):
    (tmp_path / "c.json").write_text('{"id1": {"name": "C", "evmChainId": 1, "subnetId": "s", "indexer": "u"}}')
    assert readers.read_catalogue(spark, str(tmp_path / "c.json")).first().endpoint == "/api/id1/ws"
    h = readers.c_block_headers(nb).orderBy("height").first()
    assert (h.height, h.tx_count, bytes(h.extra_data)) == (7, 1, b"\xff")
    nums = spark.range(250).withColumnRenamed("id", "block_number")
    assert readers.from_block(nums, 0).count() == 249 and [r[0] for r in readers.sample_blocks(nums, 100, 50).collect()] == [100, 200]
    assert readers.warehouse_last_block(nb.select(F.lit(1).alias("blocknumber")).limit(0)).first().last_block == -1


def test_csv_and_compaction(spark, nb, tmp_path):
    sinks.write_csv(evm.evm_internal_txs(nb), str(tmp_path / "csv"))
    got = readers.read_golden(spark, str(tmp_path / "csv"))
    assert "FROM" in got.columns and got.where("TRACE_POSITION = '0'").first().REVERT == "true"
    sinks.export_rows(evm.evm_blocks(nb), str(tmp_path / "json"), "json", 1)
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    nums = spark.range(1, 1401).where("id <> 150").withColumnRenamed("id", "block_number")
    bad = sinks.compact_blocks(nums, str(tmp_path / "packed"))
    assert [r.batch_start for r in bad.collect()] == [101] and {r[0] for r in spark.read.parquet(str(tmp_path / "packed")).select("batch_start").distinct().collect()} == {1, 201, 301}


def test_export_stream_is_idempotent(spark, nb, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    nb.limit(1).write.parquet(src)
    jobs.run_export(jobs.block_stream(spark, src), out, cp).awaitTermination()
    nb.orderBy(F.desc("block.number")).limit(1).write.mode("append").parquet(src)
    jobs.run_export(jobs.block_stream(spark, src), out, cp).awaitTermination()
    assert sinks.last_committed(spark, out) == 1 and sinks.read_export(spark, out, "blocks").count() == 2
    sinks.write_export_batch(evm.transform_batch(nb.limit(1)), out, 1)
    assert sinks.read_export(spark, out, "transactions").count() == 2
    evm.evm_blocks(nb).write.parquet(f"{out}/blocks/batch_id=9")
    assert sinks.read_export(spark, out, "blocks").count() == 2


def test_blocks_are_gathered_with_one_exchange(spark):
    """Parts that name their block move once, and give what parts without it give; copies of a receipt all stay."""
    blocks = spark.createDataFrame([(1, [("a",), ("b",), ("c",)]), (2, [("d",), (None,)]), (3, [])], "number bigint, transactions array<struct<hash:string>>")
    receipts = spark.createDataFrame([(1, "a", 1), (1, "c", 3), (1, "c", 4), (2, "d", 5), (2, "none", 6), (2, None, 7)], "number bigint, transactionHash string, gasUsed bigint")
    traces = spark.createDataFrame([(1, "a", "ta"), (2, "d", None), (2, None, "tn")], "number bigint, txHash string, result string")
    rows = lambda x: [sorted(map(str, df.collect())) for df in x]
    named, bare = evm.assemble_blocks(blocks, receipts, traces), evm.assemble_blocks(blocks, receipts.drop("number"), traces.drop("number"))
    assert rows(named) == rows(bare) and named[0].schema == bare[0].schema
    got = {r.number: (r.receipts and [x.gasUsed for x in r.receipts], r.traces and [tuple(x) for x in r.traces]) for r in named[0].collect()}
    assert got == {1: ([1, 3, 4], [("a", "ta"), ("c", None), ("c", None)]), 2: ([5], [("d", None)]), 3: (None, None)}
    assert sorted(map(str, (tuple(r) for r in named[1].collect()))) == ["(1, 'b')", "(2, None)"]
    # A receipt of another block with the same hash belongs to that block.
    assert evm.assemble_blocks(blocks, receipts.withColumn("number", 3 - F.col("number")), traces)[0].where("receipts is not null").count() == 0
    plan = named[0].select("receipts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "hashpartitioning(h" not in plan and plan.count("Exchange hashpartitioning") == 1 + ("SortMergeJoin" in plan)


def test_lists_are_opened_without_making_their_items_twice(spark):
    rows = spark.createDataFrame([(1, [7, None]), (2, []), (3, None)], "k int, x array<int>").select("k", F.transform("x", lambda i: i + 1).alias("items"))
    got = evm.each_item(rows, "items", "i", "at")
    assert sorted(map(str, map(tuple, got.collect()))) == ["(1, 0, 8)", "(1, 1, None)"]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("transform(") == 1
