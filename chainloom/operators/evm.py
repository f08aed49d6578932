"""EVM blocks to six flat tables, and assembly of blocks from their parts."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.functions import deep_json
from chainloom.functions.hexes import hex_to_base64, hex_to_decimal, hex_to_decimal_string, hex_to_long
from chainloom.functions.rules import normalise_to, partition_date
from chainloom.sources.schemas import CALL

ZERO_ADDRESS = "0x" + "0" * 40
#: Text that a trace's error has where a precompiled contract made tracing fail.
PRECOMPILE_ERROR = "incorrect number of top-level calls"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _nonzero(c: Column) -> Column:
    return F.nullif(hex_to_decimal(_text(c)), F.lit(0).cast("decimal(38,0)"))


def _base(nb: DataFrame, *more: Column) -> DataFrame:
    """The columns that all tables share, and more; lists are opened by _each(), in a step after this one."""
    b = F.col("block")
    ts = hex_to_long(_text(b["timestamp"]))
    return nb.select(b["hash"].alias("blockhash"), hex_to_long(_text(b["number"])).alias("blocknumber"), ts.alias("blocktimestamp"), partition_date(ts).alias("partition_date"), *more)


def _select(df: DataFrame, *columns: Column) -> DataFrame:
    return df.select("blockhash", "blocknumber", "blocktimestamp", *columns, "partition_date")


def each_item(df: DataFrame, items: str, name: str, at: str = "_at") -> DataFrame:
    """df with one row for each item of a list, as `name`, and its place as `at`, in place of the list; empty lists give none.

    Of explode() Spark makes a filter on the list's size, which makes the items a second time where they are computed.
    """
    keep = [c for c in df.columns if c != items]
    return df.select(*keep, F.posexplode_outer(items).alias(at, name)).where(F.col(at).isNotNull())


def _each(nb: DataFrame, items: str, name: str, at: str = "_at") -> DataFrame:
    """One row for each item of a list of the block, as `name`, with its place in the list as `at`."""
    return each_item(_base(nb, F.col(items).alias("items")), "items", name, at)


def evm_blocks(nb: DataFrame) -> DataFrame:
    """One row a block. The receipts root goes out as the receipt hash, and the state root as the receipts root: the golden
    files have it so."""
    b = F.col("block")
    rows = _base(nb, F.col("block"))
    return rows.select(
        "blocktimestamp", "blockhash", "blocknumber", _nonzero(b["baseFeePerGas"]).alias("blockbasefeepergas"), hex_to_long(_text(b["gasLimit"])).alias("blockgaslimit"), hex_to_long(_text(b["gasUsed"])).alias("blockgasused"),
        b["parentHash"].alias("blockparenthash"), b["receiptsRoot"].alias("blockreceipthash"), b["stateRoot"].alias("blockreceiptsroot"), hex_to_long(_text(b["size"])).alias("blocksize"), b["stateRoot"].alias("blockstateroot"),
        F.coalesce(F.size(b["transactions"]), F.lit(0)).cast("bigint").alias("blocktransactionlen"), hex_to_base64(_text(b["extraData"])).alias("blockextradata"), _nonzero(b["extDataGasUsed"]).alias("blockextdatagasused"), _nonzero(b["blockGasCost"]).alias("blockgascost"), "partition_date",
    )


def tx_cost(gas: Column, price: Column, value: Column) -> Column:
    """gas * price + value, exact."""
    d = "decimal(38,0)"
    return (gas.cast("decimal(19,0)") * price.cast("decimal(19,0)") + value.cast(d)).cast(d)


def evm_transactions(nb: DataFrame) -> DataFrame:
    """One row a transaction; fees that are not given are the gas price, a missing receiver is 0x."""
    t = F.col("t")
    gas, price, value = hex_to_long(_text(t["gas"])), hex_to_long(_text(t["gasPrice"])), hex_to_decimal(_text(t["value"]))
    fee = lambda c: hex_to_decimal(F.when(_text(c) == "", _text(t["gasPrice"])).otherwise(c))
    return _select(
        _each(nb, "block.transactions", "t"),
        t["hash"].alias("transactionhash"), t["from"].alias("transactionfrom"), normalise_to(t["to"]).alias("transactionto"), gas.alias("transactiongas"), price.alias("transactiongasprice"),
        fee(t["maxFeePerGas"]).alias("transactionmaxfeepergas"), fee(t["maxPriorityFeePerGas"]).alias("transactionmaxpriorityfeepergas"), t["input"].alias("transactioninput"), hex_to_long(_text(t["nonce"])).alias("transactionnonce"),
        hex_to_long(_text(t["transactionIndex"])).alias("transactionindex"), tx_cost(gas, price, value).alias("transactioncost"), value.alias("transactionvalue"), hex_to_long(_text(t["type"])).cast("string").alias("transactiontype"),
    )


def evm_receipts(nb: DataFrame) -> DataFrame:
    """One row a receipt; no contract is the zero address, the post state is empty."""
    r = F.col("r")
    contract = F.when(_text(r["contractAddress"]) == "", ZERO_ADDRESS).otherwise(r["contractAddress"])
    n = lambda c: hex_to_long(_text(c))
    return _select(
        _each(nb, "receipts", "r"),
        r["transactionHash"].alias("transactionhash"), n(r["gasUsed"]).alias("transactionreceiptgasused"), n(r["cumulativeGasUsed"]).alias("transactionreceiptcumulativegasused"), n(r["status"]).alias("transactionreceiptstatus"),
        contract.alias("transactionreceiptcontractaddress"), F.lit("").alias("transactionreceiptpoststate"), n(r["effectiveGasPrice"]).alias("transactionreceipteffectivegasprice"),
    )


def topics_pivot(topics: Column, n: int = 4) -> list[Column]:
    """The first n topics as hex text and as decimal text; missing ones are empty."""
    hexes = [_text(F.get(topics, F.lit(i))).alias(f"topichex_{i}") for i in range(n)]
    return hexes + [hex_to_decimal_string(_text(F.get(topics, F.lit(i)))).alias(f"topicdec_{i}") for i in range(n)]


def evm_logs(nb: DataFrame) -> DataFrame:
    """One row a log."""
    g = F.col("g")
    rows = _each(nb, "receipts", "r").select("blockhash", "blocknumber", "blocktimestamp", "partition_date", F.explode("r.logs").alias("g"))
    return _select(
        rows,
        g["transactionHash"].alias("transactionhash"), g["address"].alias("logaddress"), *topics_pivot(g["topics"]), g["data"].alias("logdata"),
        hex_to_long(_text(g["logIndex"])).alias("logindex"), hex_to_long(_text(g["transactionIndex"])).alias("transactionindex"), g["removed"].alias("removed"),
    )


#: Nodes of call trees that a task sends back together.
NODES = 4096


#: Places of paths that they hold together: paths get long in deep trees.
PLACES = 1 << 20


def _walk(text: str, children_field: str) -> Iterator[tuple[str, list[int]]]:
    """(JSON, path) of the nodes of a JSON tree in pre-order, each without its children; children that are no list are none. A
    node whose own fields are nested too deeply to be written is null."""
    try:
        root = deep_json.loads(text)
    except ValueError:
        return
    stack = [(root, [])]
    while stack:
        node, path = stack.pop()
        if isinstance(node, dict):
            below = node.pop(children_field, None)
            try:
                yield json.dumps(node), path
            except RecursionError:
                yield "null", path
            if isinstance(below, list):
                stack += [(below[i], [*path, i]) for i in range(len(below) - 1, -1, -1)]


def flatten_tree(roots: DataFrame, node_col: str, child_schema: str, children_field: str) -> DataFrame:
    """Every node of JSON trees: roots' other columns, `node` (typed, without its children), `path array<int>` and `position`,
    its place in pre-order from 0.

    A tree is opened where its row is, in one pass, however deep it is: there is no shuffle. Text that is no JSON, and nodes
    that are no objects, give no rows; unreadable_trees() names the former.
    """
    keys = [c for c in roots.columns if c != node_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def together(b: pa.RecordBatch, found: list[tuple[int, str, list[int], int]]) -> pa.RecordBatch:
            rows, nodes, paths, places = zip(*found)
            at = pa.array(rows, pa.int64())
            columns = [b.column(k).take(at) for k in keys]
            return pa.RecordBatch.from_arrays([*columns, pa.array(nodes), pa.array(paths, pa.list_(pa.int32())), pa.array(places, pa.int64())], names=[*keys, "node", "path", "position"])

        for b in batches:
            found: list[tuple[int, str, list[int], int]] = []
            places = 0
            for row, text in enumerate(b.column(node_col)):
                for place, (node, path) in enumerate(_walk(text.as_py() or "", children_field)):
                    found.append((row, node, path, place))
                    places += len(path)
                    if len(found) >= NODES or places >= PLACES:
                        yield together(b, found)
                        found, places = [], 0
            if found:
                yield together(b, found)

    kinds = T.StructType([roots.schema[k] for k in keys]).add("node", "string").add("path", T.ArrayType(T.IntegerType())).add("position", "long")
    return roots.mapInArrow(run, kinds).withColumn("node", F.from_json("node", child_schema))


def unreadable_trees(roots: DataFrame, node_col: str) -> DataFrame:
    """The rows that flatten_tree() gives nothing for although they have a text: roots' other columns and `reason`, which says
    where the text stops being JSON, or what it is instead of an object."""
    keys = [c for c in roots.columns if c != node_col]

    def reason(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            root = deep_json.loads(text)
        except ValueError as e:
            return f"no JSON: {e}"
        return None if isinstance(root, dict) else f"no object: {type(root).__name__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reasons = pa.array([reason(t.as_py()) for t in b.column(node_col)], pa.string())
            kept = pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), reasons], names=[*keys, "reason"])
            yield kept.filter(reasons.is_valid())

    return roots.mapInArrow(run, T.StructType([roots.schema[k] for k in keys]).add("reason", "string"))


def evm_internal_txs(nb: DataFrame) -> DataFrame:
    """One row a call of each trace, in pre-order: callindex `call_0`, `call_0_1` and so on, trace_position from 0 in each
    transaction. Null traces give no rows; null values are 0."""
    roots = _each(nb, "traces", "trace", "tx_pos").select("blockhash", "blocknumber", "blocktimestamp", "partition_date", "tx_pos", F.col("trace.txHash").alias("transactionhash"), F.nullif("trace.result", F.lit("null")).alias("tree"))
    n = F.col("node")
    nodes = flatten_tree(roots, "tree", CALL, "calls").where(F.col("node").isNotNull()).withColumnRenamed("position", "trace_position")
    index = F.concat_ws("_", F.lit("call_0"), F.array_join(F.transform("path", lambda i: i.cast("string")), "_"))
    return _select(
        nodes,
        F.col("transactionhash"), F.upper(n["type"]).alias("type"), F.lower(n["from"]).alias("from_address"), F.lower(normalise_to(n["to"])).alias("to_address"), hex_to_decimal(_text(n["value"])).alias("value"),
        hex_to_long(_text(n["gas"])).alias("gas"), hex_to_long(_text(n["gasUsed"])).alias("gasused"), (_text(n["error"]) != "").alias("revert"), _text(n["error"]).alias("error"), _text(n["revertReason"]).alias("revertreason"),
        n["input"].alias("input"), _text(n["output"]).alias("output"), F.when(F.size("path") > 0, index).otherwise("call_0").alias("callindex"), F.col("trace_position"),
    )


def evm_messages(nb: DataFrame) -> DataFrame:
    """One row a transaction: sender, receiver as it is given, gas price."""
    t = F.col("t")
    return _select(_each(nb, "block.transactions", "t"), t["hash"].alias("transactionhash"), t["from"].alias("transactionmessagefrom"), _text(t["to"]).alias("transactionmessageto"), hex_to_long(_text(t["gasPrice"])).alias("transactionmessagegasprice"))


def transform_batch(nb: DataFrame) -> dict[str, DataFrame]:
    """All six tables of a batch; land nb as Parquet first, so that each table reads only its columns."""
    return {"blocks": evm_blocks(nb), "transactions": evm_transactions(nb), "receipts": evm_receipts(nb), "logs": evm_logs(nb), "internal_transactions": evm_internal_txs(nb), "messages": evm_messages(nb)}


#: Tasks that whole blocks are gathered in, for each partition of the session's shuffles: their rows are long, and are not to spill.
GATHERED = 4


def assemble_blocks(blocks: DataFrame, receipts: DataFrame, traces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(assembled, transactions without a receipt): blocks(number, transactions) with receipts(transactionHash, ...) and
    traces(txHash, result) attached in the transactions' order; a missing trace is null.

    Receipts and traces that both name their block, in `number`, belong to its transactions alone and move once, by block. Without
    it they move twice, to their hash and to their block.
    """
    txs = blocks.select("number", F.posexplode("transactions").alias("pos", "tx"))
    by = ["number"] if "number" in receipts.columns and "number" in traces.columns else []
    r = receipts.select(*by, F.col("transactionHash").alias("h"), F.struct(*(c for c in receipts.columns if c not in by)).alias("receipt"))
    t = traces.select(*by, F.col("txHash").alias("h"), F.struct("txHash", "result").alias("trace"))
    sent = txs.select("number", "pos", F.col("tx.hash").alias("h"))
    missing = sent.join(r, [*by, "h"], "left_anti").select("number", F.col("h").alias("transactionHash"))
    if by:
        tasks = GATHERED * int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = sent.unionByName(r.where("h is not null"), allowMissingColumns=True).unionByName(t.where("h is not null"), allowMissingColumns=True).repartition(tasks, "number")
        # Tasks have whole blocks, so neither of the groupings shuffles.
        of_tx = rows.groupBy("number", "h").agg(*(F.collect_list(c).alias(c) for c in ("pos", "receipt", "trace")))
        joined = of_tx.select("number", "h", F.explode("pos").alias("pos"), "receipt", "trace").select("number", "h", "pos", F.explode("receipt").alias("receipt"), "trace").select("number", "h", "pos", "receipt", F.explode_outer("trace").alias("trace"))
    else:
        joined = sent.join(r, "h").join(t, "h", "left")
    trace = F.coalesce("trace", F.struct(F.col("h").alias("txHash"), F.lit(None).cast("string").alias("result")))
    parts = joined.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("pos", "receipt", trace.alias("trace")))).alias("x"))
    return blocks.join(parts, "number", "left").select(*blocks.columns, F.col("x.receipt").alias("receipts"), F.col("x.trace").alias("traces")), missing


def align_block_traces(txs: DataFrame, block_traces: DataFrame, tx_traces: DataFrame) -> DataFrame:
    """txs(block_number, tx_index, tx_hash) with `trace`: the block's trace at the index (traces array<string>), else the
    transaction's own trace(tx_hash, result, error); null where a precompile made tracing fail."""
    at = block_traces.select("block_number", F.posexplode("traces").alias("tx_index", "block_trace"))
    own = tx_traces.select("tx_hash", F.when(~_text(F.col("error")).contains(PRECOMPILE_ERROR), F.col("result")).alias("own_trace"))
    return txs.join(at, ["block_number", "tx_index"], "left").join(own, "tx_hash", "left").select(*txs.columns, F.coalesce("block_trace", "own_trace").alias("trace"))
