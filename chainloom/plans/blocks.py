"""Nested blocks made of orders and their lines, and the block queries with the SQL that gives the same rows from the flat tables.

A block holds the orders of eight neighbouring keys, so its size is bounded whatever the tables' size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions import hexes
from chainloom.operators import evm
from chainloom.plans.queries import query
from chainloom.plans.views import Views, s
from chainloom.sources import readers
from chainloom.sources.schemas import CALL

GENESIS = 1_500_000_000


def h(x: Column | str) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(x)))


def md5(x: Column) -> Column:
    return F.concat(F.lit("0x"), F.md5(s(x)))


def nested(v: Views) -> DataFrame:
    """(block, traces, receipts) in the shape of normalised blocks.

    Orders and lines go to their block's task once, as bare numbers; the nested parts are made there.
    """
    order_row = v.table("orders").select(F.col("o_orderkey").alias("k"), F.lit(False).alias("line"), F.lit(None).cast("bigint").alias("ln"), F.col("o_custkey").alias("a"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("b"), F.lit(None).cast("bigint").alias("c"), F.col("o_orderstatus").alias("t"))
    line_row = v.table("lineitem").select(F.col("l_orderkey").alias("k"), F.lit(True).alias("line"), F.col("l_linenumber").cast("bigint").alias("ln"), F.col("l_partkey").cast("bigint").alias("a"), F.col("l_suppkey").cast("bigint").alias("b"), F.round("l_quantity").cast("bigint").alias("c"), F.col("l_returnflag").alias("t"))
    rows = order_row.unionByName(line_row).withColumn("num", F.floor(F.col("k") / 8).cast("bigint")).repartition("num")
    # A block has few orders, and an order few lines.
    x = rows.groupBy("num").agg(F.sort_array(F.collect_list(F.struct("k", "line", "ln", "a", "b", "c", "t"))).alias("x"))
    own = lambda o: F.filter("x", lambda l: (l["k"] == o["k"]) & l["line"])  # noqa: E731, E741
    orders = F.transform(F.filter("x", lambda o: ~o["line"]), lambda o: F.struct(o["k"].alias("k"), o["a"].alias("cust"), o["b"].alias("v"), o["t"].alias("status"), own(o).alias("lines")))
    blocks = x.where(F.exists("x", lambda o: ~o["line"])).select("num", orders.alias("o"))

    def log(l: Column) -> Column:  # noqa: E741
        key, ln, part, supp = l["k"], l["ln"], l["a"], l["b"]
        topics = F.slice(F.array(h(part), h(supp), h(ln), h(key)), F.lit(1), (ln % 5).cast("int"))
        return F.struct(h(supp).alias("address"), topics.alias("topics"), md5(part).alias("data"), h(key).alias("transactionHash"), h(key % 8).alias("transactionIndex"), h(ln - 1).alias("logIndex"), (l["t"] == "R").alias("removed"))

    def call(l: Column) -> Column:  # noqa: E741
        ln, part, supp, flag = l["ln"], l["a"], l["b"], l["t"]
        inner = F.when(ln % 3 == 0, F.array(F.struct(h(part).alias("from"), h(supp).alias("to"), F.lit("staticcall").alias("type"), h(ln).alias("value"), h(part).alias("gas"), F.lit("0x1").alias("gasUsed"), F.lit("0x").alias("input"))))
        return F.struct(F.concat(F.lit("0xA"), s(supp)).alias("from"), h(supp).alias("to"), F.lit("delegatecall").alias("type"), h(part).alias("gas"), h(l["c"]).alias("gasUsed"), F.lit("0x1").alias("input"), F.lit("0x2").alias("output"), F.when(flag == "R", "reverted").alias("error"), F.when((flag == "R") & (ln % 2 == 0), "why").alias("revertReason"), inner.alias("calls"))

    count = lambda o: F.size(o["lines"]).cast("bigint")

    def tx(o: Column) -> Column:
        k, cust, value = o["k"], o["cust"], o["v"]
        return F.struct(
            h(k).alias("hash"), h(cust).alias("from"), F.when(k % 7 != 0, h(cust + 7)).alias("to"), h(cust + 21000).alias("gas"), h(value % 1000 + 1).alias("gasPrice"), F.concat(h(value), F.lit("0" * 10)).alias("value"), F.when(k % 3 == 0, h(cust)).otherwise("").alias("maxFeePerGas"),
            F.when(k % 5 == 0, h(value)).alias("maxPriorityFeePerGas"), md5(k).alias("input"), h(cust % 1000).alias("nonce"), h(k % 8).alias("transactionIndex"), h(k % 3).alias("type"))

    def receipt(o: Column) -> Column:
        k, n = o["k"], count(o)
        return F.struct(
            h(k).alias("transactionHash"), h(n * 1000).alias("gasUsed"), h(n * 1000 * (k % 8 + 1)).alias("cumulativeGasUsed"), h(F.when(o["status"] == "F", 1).otherwise(0)).alias("status"), F.when(k % 9 == 0, h(k)).when(k % 2 == 0, "").alias("contractAddress"),
            h(o["v"] % 1000 + 1).alias("effectiveGasPrice"), F.transform(o["lines"], log).alias("logs"))

    def trace(o: Column) -> Column:
        k, cust = o["k"], o["cust"]
        calls = F.when(count(o) > 0, F.transform(o["lines"], call))
        root = F.to_json(F.struct(h(cust).alias("from"), F.when(k % 7 != 0, h(cust + 7)).alias("to"), F.lit("call").alias("type"), h(o["v"]).alias("value"), h(cust + 21000).alias("gas"), h(count(o) * 1000).alias("gasUsed"), F.lit("0x").alias("input"), calls.alias("calls")))
        return F.struct(h(k).alias("txHash"), F.when(k % 13 != 0, root).alias("result"))

    n = F.col("num")
    block = F.struct(
        h(n).alias("number"), F.concat(F.lit("0xb"), s(n)).alias("hash"), F.concat(F.lit("0xb"), s(n - 1)).alias("parentHash"), h(n * 12 + GENESIS).alias("timestamp"), h(n % 100 + 500).alias("size"), h(F.lit(8_000_000)).alias("gasLimit"), h(n % 5000).alias("gasUsed"), F.when(n % 4 == 0, "0x0").otherwise(h(n)).alias("baseFeePerGas"),
        md5(n).alias("extraData"), F.concat(F.lit("r"), s(n)).alias("receiptsRoot"), F.concat(F.lit("s"), s(n)).alias("stateRoot"), F.when(n % 2 == 0, "").otherwise(h(n)).alias("extDataGasUsed"), F.lit(None).cast("string").alias("blockGasCost"), F.lit(None).cast("string").alias("blockExtraData"),
        h(n % 7).alias("miner"), md5(n + 1).alias("extDataHash"), F.transform("o", tx).alias("transactions"))
    return blocks.select(block.alias("block"), F.transform("o", trace).alias("traces"), F.transform("o", receipt).alias("receipts"))


#: The flat rows behind the blocks.
_O = f"""o as (select o_orderkey as k, o_orderkey // 8 as num, (o_orderkey // 8) * 12 + {GENESIS} as ts, o_custkey as cust, round(o_totalprice * 100)::bigint as v, o_orderstatus as status, (select count(*) from lineitem where l_orderkey = o_orderkey) as n from orders)"""
_L = "l as (select l_orderkey as k, l_linenumber::bigint as ln, l_partkey::bigint as part, l_suppkey::bigint as supp, round(l_quantity)::bigint as qty, l_returnflag as flag from lineitem)"
_BASE = "'0xb' || num as blockhash, num as blocknumber, ts as blocktimestamp, make_date((ts // 86400)::int)::varchar as partition_date"


def hx(e: str) -> str:
    return f"printf('0x%x', ({e})::bigint)"


def shown(df: DataFrame) -> DataFrame:
    """df with decimals and dates as text."""
    return df.select(*(s(F.col(c)).alias(c) if t.startswith("decimal") or t == "date" else F.col(c) for c, t in df.dtypes))


@query(f"""with {_O} select distinct ts as blocktimestamp, '0xb' || num as blockhash, num as blocknumber, case when num % 4 = 0 or num = 0 then null else num::varchar end as blockbasefeepergas, 8000000 as blockgaslimit, num % 5000 as blockgasused, '0xb' || (num - 1) as blockparenthash,
    'r' || num as blockreceipthash, 's' || num as blockreceiptsroot, num % 100 + 500 as blocksize, 's' || num as blockstateroot, count(*) over (partition by num) as blocktransactionlen, base64(unhex(md5(num::varchar))) as blockextradata, case when num % 2 = 0 then null else num::varchar end as blockextdatagasused,
    null::varchar as blockgascost, make_date((ts // 86400)::int)::varchar as partition_date from o""")  # fmt: skip
def evm_blocks_table(v: Views) -> DataFrame:
    return shown(evm.evm_blocks(nested(v)))


@query(f"""with {_O} select {_BASE}, {hx('k')} as transactionhash, {hx('cust')} as transactionfrom, case when k % 7 <> 0 then {hx('cust + 7')} else '0x' end as transactionto, cust + 21000 as transactiongas, v % 1000 + 1 as transactiongasprice, (case when k % 3 = 0 then cust else v % 1000 + 1 end)::varchar as transactionmaxfeepergas,
    (case when k % 5 = 0 then v else v % 1000 + 1 end)::varchar as transactionmaxpriorityfeepergas, '0x' || md5(k::varchar) as transactioninput, cust % 1000 as transactionnonce, k % 8 as transactionindex, ((cust + 21000)::hugeint * (v % 1000 + 1) + v::hugeint * 1099511627776)::varchar as transactioncost, (v::hugeint * 1099511627776)::varchar as transactionvalue,
    (k % 3)::varchar as transactiontype from o""")  # fmt: skip
def evm_transactions_table(v: Views) -> DataFrame:
    return shown(evm.evm_transactions(nested(v)))


@query(f"""with {_O} select {_BASE}, {hx('k')} as transactionhash, n * 1000 as transactionreceiptgasused, n * 1000 * (k % 8 + 1) as transactionreceiptcumulativegasused, (status = 'F')::bigint as transactionreceiptstatus, case when k % 9 = 0 then {hx('k')} else '{evm.ZERO_ADDRESS}' end as transactionreceiptcontractaddress,
    '' as transactionreceiptpoststate, v % 1000 + 1 as transactionreceipteffectivegasprice from o""")  # fmt: skip
def evm_receipts_table(v: Views) -> DataFrame:
    return shown(evm.evm_receipts(nested(v)))


@query(f"""with {_O}, {_L}, t as (select *, list_slice([part, supp, ln, k], 1, ln % 5) as t from l)
    select {_BASE}, {hx('k')} as transactionhash, {hx('supp')} as logaddress, {', '.join(f"case when len(t) > {i} then {hx(f't[{i + 1}]')} else '' end as topichex_{i}, coalesce(t[{i + 1}]::varchar, '') as topicdec_{i}" for i in range(4))},
    '0x' || md5(part::varchar) as logdata, ln - 1 as logindex, k % 8 as transactionindex, flag = 'R' as removed from t join o using (k)""")  # fmt: skip
def evm_logs_table(v: Views) -> DataFrame:
    return shown(evm.evm_logs(nested(v)))


@query(f"""with {_O}, {_L}, p as (select *, row_number() over (partition by k order by ln, part, supp, qty, flag) - 1 as p, coalesce(sum((ln % 3 = 0)::int) over (partition by k order by ln, part, supp, qty, flag rows between unbounded preceding and 1 preceding), 0)::bigint as inner_before from l),
    c as (
        select k, 'CALL' as type, {hx('cust')} as from_address, case when k % 7 <> 0 then {hx('cust + 7')} else '0x' end as to_address, v::varchar as value, cust + 21000 as gas, n * 1000 as gasused, false as revert, '' as error, '' as revertreason, '0x' as input, '' as output, 'call_0' as callindex, 0 as trace_position from o
        union all select k, 'DELEGATECALL', '0xa' || supp, {hx('supp')}, '0', part, qty, flag = 'R', case when flag = 'R' then 'reverted' else '' end, case when flag = 'R' and ln % 2 = 0 then 'why' else '' end, '0x1', '0x2', 'call_0_' || p, 1 + p + inner_before from p
        union all select k, 'STATICCALL', {hx('part')}, {hx('supp')}, ln::varchar, part, 1, false, '', '', '0x', '', 'call_0_' || p || '_0', 2 + p + inner_before from p where ln % 3 = 0)
    select {_BASE}, {hx('k')} as transactionhash, c.* exclude (k) from c join o using (k) where k % 13 <> 0""")  # fmt: skip
def evm_internal_txs_table(v: Views) -> DataFrame:
    return shown(evm.evm_internal_txs(nested(v)))


@query(f"with {_O} select {_BASE}, {hx('k')} as transactionhash, {hx('cust')} as transactionmessagefrom, case when k % 7 <> 0 then {hx('cust + 7')} else '' end as transactionmessageto, v % 1000 + 1 as transactionmessagegasprice from o")
def evm_messages_table(v: Views) -> DataFrame:
    return shown(evm.evm_messages(nested(v)))


@query(f"""with {_O} select {hx('num')} as number, string_agg({hx('k')}, ',' order by k) filter (k % 10 <> 0) as receipts, string_agg({hx('k')} || (case when k % 13 = 0 or k % 11 = 0 then '-' else '+' end), ',' order by k) filter (k % 10 <> 0) as traces from o group by num""")
def blocks_assembled(v: Views) -> DataFrame:
    nb = nested(v)
    number = F.col("block.number").alias("number")
    receipts = evm.each_item(nb.select(number, "receipts"), "receipts", "r").select("number", "r.*").where(hexes.hex_to_long("transactionHash") % 10 != 0)
    traces = evm.each_item(nb.select(number, "traces"), "traces", "t").select("number", "t.*").where(hexes.hex_to_long("txHash") % 11 != 0)
    out, _ = evm.assemble_blocks(nb.select("block.number", "block.transactions"), receipts, traces)
    marked = F.transform("traces", lambda t: F.concat(t["txHash"], F.when(t["result"].isNull(), "-").otherwise("+")))
    return out.select("number", F.array_join("receipts.transactionHash", ",").alias("receipts"), F.array_join(marked, ",").alias("traces"))


@query(f"with {_O} select {hx('num')} as number, {hx('k')} as \"transactionHash\" from o where k % 10 = 0")
def blocks_without_receipt(v: Views) -> DataFrame:
    nb = nested(v)
    receipts = evm.each_item(nb.select("receipts"), "receipts", "r").select("r.*").where(hexes.hex_to_long("transactionHash") % 10 != 0)
    return evm.assemble_blocks(nb.select("block.number", "block.transactions"), receipts, evm.each_item(nb.select("traces"), "traces", "t").select("t.*"))[1]


@query(f"with {_O}, p as (select *, row_number() over (partition by num order by k) - 1 as i from o) select num as block_number, i::int as tx_index, {hx('k')} as tx_hash, case when num % 2 = 0 then 'block ' || k when k % 13 <> 0 then 'own ' || k end as trace from p")
def traces_aligned(v: Views) -> DataFrame:
    txs = nested(v).select(hexes.hex_to_long("block.number").alias("block_number"), F.posexplode("block.transactions").alias("tx_index", "t")).select("block_number", "tx_index", F.col("t.hash").alias("tx_hash"))
    k = hexes.hex_to_long("tx_hash")
    by_block = txs.where("block_number % 2 = 0").groupBy("block_number").agg(F.transform(F.sort_array(F.collect_list(F.struct("tx_index", k.alias("k")))), lambda t: F.concat(F.lit("block "), s(t["k"]))).alias("traces"))
    own = txs.select("tx_hash", F.concat(F.lit("own "), s(k)).alias("result"), F.when(k % 13 == 0, evm.PRECOMPILE_ERROR).alias("error"))
    return evm.align_block_traces(txs, by_block, own)


@query(f"""with {_O}, b as (select num, any_value(ts) as ts, count(*) as c from o group by num)
    select num as height, ts, num % 100 + 500 as size, 8000000 as gas_limit, num % 5000 as gas_used, case when num % 4 = 0 then 0 else num end as base_fee, c::int as tx_count, '0xb' || num as hash, '0xb' || (num - 1) as parent_hash, {hx('num % 7')} as miner, '0x' || md5((num + 1)::varchar) as ext_data_hash, md5(num::varchar) as extra_data from b""")  # fmt: skip
def block_headers(v: Views) -> DataFrame:
    return readers.c_block_headers(nested(v)).withColumn("extra_data", F.lower(F.hex("extra_data")))


@query(f"""with {_O}, b as (select num, any_value(ts) as ts, count(*) as c from o group by num)
    select num as height, ts, '0x' || md5(num::varchar) || md5(num::varchar) as hash, '0x' || md5((num - 1)::varchar) || md5((num - 1)::varchar) as parent_hash, num % 100 as size, c as tx_count, 8000000 as gas_limit, num % 5000 as gas_used, '18446744073709551615' as base_fee, '0x' || left(md5(num::varchar), 32) || '00000000' as miner, '0x' || md5(num::varchar) || md5(num::varchar) as ext_data_hash, md5(num::varchar) as extra_data from b where num % 6 <> 0""")  # fmt: skip
def binary_headers(v: Views) -> DataFrame:
    b = nested(v).select(hexes.hex_to_long("block.number").alias("n"), hexes.hex_to_long("block.timestamp").alias("ts"), F.size("block.transactions").alias("c"))
    n, m = F.col("n"), lambda x: F.md5(s(x))
    wide = lambda x, size: F.lpad(F.hex(x.cast("bigint")), 2 * size, "0")
    parts = [wide(n, 8), wide(F.col("ts"), 8), m(n), m(n), m(n - 1), m(n - 1), wide(n % 100, 4), wide(F.col("c"), 4), wide(F.lit(8_000_000), 8), wide(n % 5000, 8), F.lit("f" * 16), m(n), F.lit("0" * 8), m(n), m(n), wide(F.lit(16), 4), m(n)]
    whole = F.unhex(F.concat(*parts))
    # Every sixth record lacks its last byte.
    raw = b.select(F.when(n % 6 == 0, F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole).alias("raw"))
    return readers.decode_cblock_records(raw)[0].withColumns({"extra_data": F.lower(F.hex("extra_data")), "base_fee": s("base_fee")})


@query(f"with {_O} select k as idx, ts, md5(k::varchar) as tx_bytes from o")
def timed_records(v: Views) -> DataFrame:
    txs = nested(v).select(hexes.hex_to_long("block.timestamp").alias("ts"), F.explode("block.transactions.hash").alias("t"))
    k = hexes.hex_to_long("t")
    records = txs.select(k.alias("idx"), F.unhex(F.concat(F.lpad(F.hex("ts"), 16, "0"), F.md5(s(k)))).alias("raw"))
    return readers.raw_x_txs(records).withColumn("tx_bytes", F.lower(F.hex("tx_bytes")))


@query(f"with {_O}, b as (select num, any_value(ts) as ts from o group by num) select 'v' || num as id, ts, 'vertex' as kind from b union all select {hx('k')}, ts, 'tx' from o where num % 5 <> 0")
def vertices_opened(v: Views) -> DataFrame:
    n, ts = hexes.hex_to_long("block.number"), hexes.hex_to_long("block.timestamp")
    vertex = F.struct(F.concat(F.lit("v"), s(n)).alias("hash"), F.concat(F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123456789Z")).alias("timestamp"), F.when(n % 5 != 0, F.col("block.transactions.hash")).alias("transactions"))
    return readers.read_vertices(nested(v).select(F.to_json(F.struct(F.array(vertex).alias("vertices"))).alias("page")))


@query(f"with {_O} select max(num) as last_block, count(*) filter (num >= 1000) as from_1000, count(*) filter (num % 100 = 0 and num between 500 and 5000) as sampled from o")
def block_reads(v: Views) -> DataFrame:
    rows = _numbered(v)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return readers.warehouse_last_block(rows, "block_number").crossJoin(count(readers.from_block(rows, 1000), "from_1000")).crossJoin(count(readers.sample_blocks(rows, 100, 500, 5000), "sampled"))


@query(f"with {_O} select num as block_number, {hx('k')} as t from o where num >= 1000")
def blocks_from(v: Views) -> DataFrame:
    return readers.from_block(_numbered(v), 1000)


@query(f"with {_O} select num as block_number, {hx('k')} as t from o where num % 100 = 0 and num between 500 and 5000")
def blocks_sampled(v: Views) -> DataFrame:
    return readers.sample_blocks(_numbered(v), 100, 500, 5000)


def _numbered(v: Views) -> DataFrame:
    return nested(v).select(hexes.hex_to_long("block.number").alias("block_number"), F.explode("block.transactions.hash").alias("t"))


@query(f"with {_O} select k, case when k % 3 = 0 then '$: extra' when k % 3 = 1 then '$.calls[]: odd' else '' end as unknown from o where k % 13 <> 0")
def unknown_keys(v: Views) -> DataFrame:
    from pyspark.sql import types as T

    kind = T.StructType.fromDDL(CALL.replace("calls array<string>", "calls array<struct<`from`: string>>"))
    k = hexes.hex_to_long("t.txHash")
    lines = nested(v).select(F.explode("traces").alias("t")).where(F.col("t.result").isNotNull()).select(k.alias("k"), F.when(k % 3 == 0, '{"type":"call","extra":1}').when(k % 3 == 1, '{"calls":[{"from":"0x1"},{"odd":1}]}').otherwise('{"gas":"0x1"}').alias("value"))
    return readers.strict_schema_check(lines, kind).select("k", F.array_join("unknown", ",").alias("unknown"))
