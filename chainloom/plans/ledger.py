"""Queries for the ledger's construction, answers and registries, over typed transactions made of orders and lines, with SQL.

An order is a transaction of few outputs, its lines: their role goes by the line's number, their kind by the part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions import hexes, rules
from chainloom.operators import balances, control, quality, registry, staking, utxo, validators
from chainloom.operators.ordered import shared_folder
from chainloom.plans.queries import long, query
from chainloom.plans.views import DAY, NOW, Views, s
from chainloom.sources import archive
from chainloom.sources.schemas import IN, OUT

#: Seconds that bring the orders' years across the start of batches.
SHIFT = 850_000_000
KINDS = (*utxo.OUTPUT_KINDS, "odd")
TX_TYPES = ("AddValidatorTx", "ExportTx", "ImportTx", "RewardValidatorTx", "AdvanceTimeTx")


def typed_txs(v: Views) -> DataFrame:
    """Transactions with inputs and outputs, in the columns that the three chains need."""
    part, supp, ln, ts = F.col("part"), F.col("supp"), F.col("output_index"), F.col("created_ts")
    out = F.struct(
        F.get(F.array(*map(F.lit, KINDS)), (part % 7).cast("int")).alias("kind"), F.concat(F.lit("a"), s(part % 5)).alias("asset_id"), F.col("amount").cast("decimal(20,0)").alias("amount"), F.when(part % 17 == 0, F.array().cast("array<string>")).otherwise(F.array(s(supp), s(supp + 1))).alias("addresses"),
        F.lit(1).cast("bigint").alias("threshold"), F.when(part % 3 == 0, ts + part % 400 * DAY).otherwise(0).cast("decimal(20,0)").alias("locktime"), (part % 4).alias("group_id"), F.concat(F.lit("p"), s(part % 4)).alias("payload"), F.col("utxo_id").alias("utxo_id"), F.lit("0x").alias("utxo_bytes"),
    ).cast(OUT)
    spent = F.struct(F.col("utxo_id").alias("utxo_id"), F.col("amount").cast("decimal(20,0)").alias("amount")).cast(IN)
    # An order has few lines.
    rows = v.out.groupBy("tx_id", "created_ts", "block_number", "sender").agg(F.sort_array(F.collect_list(F.struct(ln.alias("ln"), "utxo_id", out.alias("o"), spent.alias("i"), (supp % 2).alias("side")))).alias("x"))
    role = lambda k: F.transform(F.filter("x", lambda t: t["ln"] % 4 == k), lambda t: t["o"])
    side = lambda k: F.transform(F.filter("x", lambda t: t["side"] == k), lambda t: t["i"])
    k = F.col("tx_id")
    owner = F.struct(F.lit(1).cast("bigint").alias("threshold"), F.lit(0).cast("decimal(20,0)").alias("locktime"), F.array(s("sender")).alias("addresses"))
    return rows.select(
        s(k).alias("tx_id"), k.alias("n"), F.get(F.array(*map(F.lit, TX_TYPES)), (k % 5).cast("int")).alias("tx_type"), F.col("block_number").alias("height"), ts.alias("block_ts"), ts.alias("ts"), k.cast("int").alias("tx_index"), F.concat(role(0), role(3)).alias("plain"), role(1).alias("one"), role(2).alias("two"), role(3).alias("three"), role(0).alias("zero"),
        side(0).alias("ins"), side(1).alias("imported_ins"), F.when(k % 2 == 0, "x").otherwise("c").alias("dest_chain"), F.when(k % 3 == 0, "c").otherwise("x").alias("source_chain"), F.when(k % 4 != 0, ts + DAY).otherwise(0).cast("bigint").alias("start_ts"), (ts + 100 * DAY).alias("end_ts"), s("sender").alias("node_id"), owner.alias("validator_owner"), s(k).alias("staking_tx_id"),
    )


def p_typed(v: Views) -> DataFrame:
    return typed_txs(v).select("*", F.col("plain").alias("outs"), F.col("one").alias("stake_outs"), F.col("two").alias("exported_outs")).drop("plain", "zero", "one", "two", "three")


def x_typed(v: Views) -> DataFrame:
    op = F.struct(F.lit("a").alias("asset_id"), F.transform("imported_ins", lambda i: i["utxo_id"]).alias("utxo_ids"), F.col("two").alias("outs"))
    rows = typed_txs(v).select("*", F.col("zero").alias("outs"), F.array("one").alias("states"), F.array(op).alias("ops"), F.col("three").alias("exported_outs"))
    return rows.drop("plain", "zero", "one", "two", "three")


_KIND = "[" + ", ".join(f"'{k}'" for k in KINDS) + "][(part % 7)::int + 1]"
_FX = "case kind when 'transfer' then 'secp256k1fx' when 'stake_lock' then 'secp256k1fx' when 'nft_transfer' then 'nftfx' when 'nft_mint' then 'nftfx' else 'propertyfx' end"
_TYPED = f"typed as (select *, tx_id % 5 as tt, {_KIND} as kind, case when part % 3 = 0 then created_ts + part % 400 * {DAY} else 0 end as lock, output_index % 4 as role from outs)"
_OUT_COLUMNS = f"""utxo_id, {_FX} as fx_id, upper(case kind when 'transfer' then 'transfer' when 'stake_lock' then 'stakeable_lock' else kind end) as utxo_type, amount, supp || ',' || (supp + 1) as addresses, 1 as threshold, case when kind <> 'stake_lock' then lock end as platform_locktime, case when kind = 'stake_lock' then lock end as stakeable_locktime,
    case when kind in ('nft_transfer', 'nft_mint') then part % 4 end as group_id, case when kind = 'nft_transfer' then 'p' || part % 4 end as payload"""
_KNOWN = "kind <> 'odd' and part % 17 <> 0"


def made(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        *more, "utxo_id", "asset_id", "output_index", "role", "consumed_on", "staked", "fx_id", "utxo_type", long("amount").alias("amount"), F.array_join("addresses", ",").alias("addresses"), "threshold",
        long("platform_locktime").alias("platform_locktime"), long("stakeable_locktime").alias("stakeable_locktime"), "group_id", "payload",
    )


@query(f"""with {_TYPED}, r as (select *, row_number() over (partition by tx_id order by case role when 0 then 0 when 3 then 1 when 1 then 2 else 3 end, output_index, utxo_id) - 1 as i from typed where tt <> 4)
    select tx_id::varchar as tx_id, 'a' || part % 5 as asset_id, i as output_index, case role when 1 then 'stake' when 2 then 'export' else 'out' end as role, case when role = 2 then case when tx_id % 2 = 0 then 'x' else 'c' end else 'p' end as consumed_on, role = 1 as staked, {_OUT_COLUMNS} from r where {_KNOWN}""", "outs")  # fmt: skip
def p_outputs_made(v: Views) -> DataFrame:
    return made(utxo.p_outputs(p_typed(v)), "tx_id")


_LABELS = "[" + ", ".join(f"'{t}'" for t in (*utxo.P_TX_TYPES, "AdvanceTimeTx", "UnknownTx")) + "][(tx_id % 21)::int + 1]"


@query(f"""with {_TYPED}, r as (select *, {_LABELS} as tx_type, row_number() over (partition by tx_id order by case role when 0 then 0 when 3 then 1 when 1 then 2 else 3 end, output_index, utxo_id) - 1 as i from typed)
    select tx_type, case role when 1 then 'stake' when 2 then 'export' else 'out' end as role, count(*) as n, count(distinct tx_id) as n_txs, sum(i)::bigint as places, sum(amount)::bigint as amount from r where {_KNOWN} and tx_id % 21 < 19 group by all""", "outs")  # fmt: skip
def p_types(v: Views) -> DataFrame:
    """Outputs of each of the nineteen types of P transactions, and of two that make none."""
    label = F.get(F.array(*map(F.lit, (*utxo.P_TX_TYPES, "AdvanceTimeTx", "UnknownTx"))), (F.col("n") % 21).cast("int"))
    rows = utxo.p_outputs(p_typed(v).withColumn("tx_type", label))
    return rows.groupBy("tx_type", "role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("tx_id").alias("n_txs"), F.sum("output_index").alias("places"), long(F.sum("amount")).alias("amount"))


@query(f"""with {_TYPED}, r as (select *, row_number() over (partition by tx_id order by role, output_index, utxo_id) - 1 as i from typed)
    select tx_id::varchar as tx_id, case when role = 1 then tx_id::varchar else 'a' || part % 5 end as asset_id, i as output_index, ['out', 'state', 'operation', 'export'][role + 1] as role, case when role = 3 then case when tx_id % 2 = 0 then 'x' else 'c' end else 'x' end as consumed_on, false as staked, {_OUT_COLUMNS} from r where {_KNOWN}""", "outs")  # fmt: skip
def x_outputs_made(v: Views) -> DataFrame:
    return made(utxo.x_outputs(x_typed(v)), "tx_id")


@query(f"""with {_TYPED}, r as (select *, row_number() over (partition by tx_id order by output_index, utxo_id) - 1 as i from typed where role = 2 and tx_id % 3 = 0 and tx_id % 2 = 0)
    select tx_id::varchar as tx_id, 'a' || part % 5 as asset_id, i as output_index, 'export' as role, 'p' as consumed_on, false as staked, {_OUT_COLUMNS} from r where {_KNOWN}""", "outs")  # fmt: skip
def c_outputs_made(v: Views) -> DataFrame:
    txs = p_typed(v).withColumns({"kind": F.when(F.col("n") % 3 == 0, "export").otherwise("import"), "dest_chain": F.when(F.col("n") % 2 == 0, "p").otherwise("x")})
    return made(utxo.c_outputs(txs), "tx_id")


@query(f"""with {_TYPED} select utxo_id, case when role = 1 then case when tx_id % 4 <> 0 then created_ts + {DAY} else created_ts end end as stake_start, case when role = 1 then created_ts + {100 * DAY} end as stake_end, case when role = 1 then sender::varchar end as reward_addresses, sender::varchar as node_id from typed where tt <> 4 and {_KNOWN}""", "outs")
def stakes_described(v: Views) -> DataFrame:
    return utxo.staking_attributes(utxo.p_outputs(p_typed(v))).select("utxo_id", "stake_start", "stake_end", F.array_join("reward_addresses", ",").alias("reward_addresses"), "node_id")


@query(f"""with {_TYPED} select tx_id::varchar as tx_id, 'a' || part % 5 as asset_id, output_index, 'p' as consumed_on, false as staked, true as is_reward, {_OUT_COLUMNS} from typed where tt = 3 and {_KNOWN}""", "outs")
def reward_outputs_made(v: Views) -> DataFrame:
    txs = p_typed(v)
    each = txs.where("tx_type = 'RewardValidatorTx'").select("staking_tx_id", F.explode(F.concat("outs", "stake_outs", "exported_outs")).alias("out"))
    at = v.out.select("utxo_id", "output_index")
    rewards = each.join(at, each.out.utxo_id == at.utxo_id).select("staking_tx_id", F.col("output_index").alias("position"), "output_index", "out")
    return made(utxo.reward_outputs(txs, rewards).withColumn("role", F.lit("")), "tx_id", "is_reward").drop("role")


@query("select utxo_id, tx_id::varchar as consuming_tx, created_ts as consuming_ts, block_number::varchar as consuming_block, 'p' as store_chain from outs where supp % 2 = 0 union all select utxo_id, tx_id::varchar, created_ts, block_number::varchar, 'x' from outs", "outs")
def spends_found(v: Views) -> DataFrame:
    """P spends its inputs, X those and the outputs that its operations name."""
    rows = utxo.spends(p_typed(v), "p").unionByName(utxo.spends(x_typed(v), "x"))
    return rows.select("utxo_id", "consuming_tx", "consuming_ts", "consuming_block", "store_chain")


@query("select utxo_id, tx_id::varchar as consuming_tx, unnest(['p', case when tx_id % 3 = 0 then 'c' else 'x' end]) as store_chain, 'p' as consumed_on, case when tx_id % 3 = 0 then 'c' else 'x' end as created_on from outs where supp % 2 = 1", "outs")
def import_spends_found(v: Views) -> DataFrame:
    return utxo.import_spends(p_typed(v), "p").select("utxo_id", "consuming_tx", "store_chain", "consumed_on", "created_on")


@query(f"""with {_TYPED}, m as (select *, case when role = 2 then case when tx_id % 2 = 0 then 'x' else 'c' end else 'p' end as consumed_on_, kind from typed where tt <> 4 and {_KNOWN}), f as (select *, unnest(list_distinct(['p', consumed_on_])) as store_chain from m)
    select store_chain, utxo_id, amount, case when supp % 2 = 0 and store_chain = 'p' then tx_id::varchar end as consuming_tx, case when supp % 2 = 0 and store_chain = 'p' then created_ts end as consuming_ts, case when store_chain = 'x' then lower(t) else t end as utxo_type
    from (select *, upper(case kind when 'stake_lock' then 'stakeable_lock' else kind end) as t from f)""", "outs")  # fmt: skip
def utxos_derived(v: Views) -> DataFrame:
    txs = p_typed(v)
    rows = utxo.derive_utxos(utxo.p_outputs(txs), utxo.spends(txs, "p"))
    return rows.select("store_chain", "utxo_id", long("amount").alias("amount"), "consuming_tx", "consuming_ts", "utxo_type")


@query(f"select o_orderkey as height, epoch_us(o_orderdate) // 1000000 + {SHIFT} >= {utxo.BATCH_ATOMIC_FROM} as is_batch from orders where o_orderkey % 3 <> 0")
def atomic_blocks_kept(v: Views) -> DataFrame:
    k = F.col("tx_id")
    blocks = v.tx.select(k.alias("height"), (F.col("ts") + SHIFT).alias("ts"), F.when(k % 6 == 0, F.lit("")).when(k % 3 != 0, s(k)).cast("binary").alias("extra_data"))
    return utxo.atomic_blocks(blocks).select("height", "is_batch")


def x_assets(v: Views) -> DataFrame:
    k = F.col("p_partkey")
    return v.table("part").select(s(k % 1000).alias("tx_id"), F.when(k % 4 != 0, "CreateAssetTx").otherwise("BaseTx").alias("tx_type"), F.col("p_name").alias("asset_name"), F.col("p_brand").alias("asset_symbol"), F.col("p_size").cast("int").alias("asset_denomination"), k.cast("bigint").alias("ts"))


@query("select (p_partkey % 1000)::varchar as asset_id, p_name as name, p_brand as symbol, p_size::int as denomination from part where p_partkey % 4 <> 0")
def assets_described(v: Views) -> DataFrame:
    return utxo.asset_metadata(x_assets(v))


@query("""with t as (select (p_partkey % 1000)::varchar as asset_id, p_name as name, p_brand as symbol, p_size::int as denomination, case when p_partkey % 1000 < 300 then 5000000 + p_partkey % 1000 else p_partkey end::bigint as created_ts from part where p_partkey % 4 <> 0 union all select 'native', 'Native', 'N', 9, 0),
    r as (select *, row_number() over (partition by asset_id order by created_ts desc, name desc, symbol desc, denomination desc) as i from t) select asset_id, name, symbol, denomination, created_ts from r where i = 1""")  # fmt: skip
def assets_listed(v: Views) -> DataFrame:
    """The first era's times are repaired; ids that occur again keep their last row."""
    repaired = v.table("part").where("p_partkey % 1000 < 300").select((F.col("p_partkey") % 1000).alias("n")).distinct().select(s("n").alias("id"), (F.col("n") + 5_000_000).cast("bigint").alias("ts"))
    native = v.spark.range(1).select(F.lit("native").alias("asset_id"), F.lit("Native").alias("name"), F.lit("N").alias("symbol"), F.lit(9).alias("denomination"), F.lit(0).cast("bigint").alias("created_ts"), F.lit("secp256k1").alias("type"), F.lit("fixed").alias("cap"))
    return registry.assets(x_assets(v), native, repaired).select("asset_id", "name", "symbol", "denomination", "created_ts")


@query(f"""with {_TYPED}, own as (select * from typed where tt <> 4 and {_KNOWN} and (supp = 7 or supp = 6))
    select distinct utxo_id, tx_id::varchar as tx_id, 'created' as event, amount from own union select distinct utxo_id, tx_id::varchar, 'consumed', amount from own where supp % 2 = 0
    union select o.utxo_id, o.tx_id::varchar, 'imported', o.amount from outs o where o.supp % 2 = 1 and o.tx_id in (select tx_id from own)""", "outs")  # fmt: skip
def history_of_one_address(v: Views) -> DataFrame:
    txs = p_typed(v)
    return utxo.utxo_history(utxo.p_outputs(txs), utxo.spends(txs, "p"), txs, "7").select("utxo_id", "tx_id", "event", long("amount").alias("amount"))


# Answers


def shown_utxos(v: Views) -> DataFrame:
    rows = v.utxos.withColumns({"addresses": F.col("addresses").cast("array<string>"), "tx_hash": s("tx_id"), "utxo_type": F.lit("TRANSFER"), "block_timestamp": F.col("created_ts"), "consuming_block": s("block_number"), "credentials": F.lit(None).cast("array<struct<public_key:string,signature:string>>"), "group_id": F.lit(None).cast("bigint"), "payload": F.lit(None).cast("string"), "fx_id": F.lit("secp256k1fx")})
    info = v.table("part").where("p_partkey < 4").select(F.col("p_partkey").alias("asset_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("symbol"), F.col("p_size").cast("int").alias("denomination"))
    return balances.with_asset_info(rows, info)


def fields(df: DataFrame, key: str, paths: dict[str, str]) -> DataFrame:
    """Values of an answer by their paths (`$.a`, `$.a.b`, `$.a[0]`), as text; each answer is parsed once."""
    kinds: dict[str, str] = {}
    inner: dict[str, list[str]] = {}
    for p in paths.values():
        name, _, below = p[2:].partition(".")
        if below:
            inner.setdefault(name, []).append(below)
        else:
            kinds[name.split("[")[0]] = "array<string>" if "[" in name else "string"
    kinds |= {n: f"struct<{','.join(f'{x}:string' for x in below)}>" for n, below in inner.items()}
    parsed = df.select(key, F.explode(F.array(F.from_json("response", ",".join(f"{n} {k}" for n, k in kinds.items())))).alias("r"))
    at = lambda p: F.get(F.col(f"r.{p[2:].split('[')[0]}"), F.lit(int(p.split("[")[1][:-1]))) if "[" in p else F.col(f"r.{p[2:]}")
    return parsed.select(key, *(at(p).alias(n) for n, p in paths.items()))


_NAMES = "n as (select p_partkey as asset_id, p_name, p_brand, p_size from part where p_partkey < 4)"


@query(f"""with {_NAMES} select utxo_id, sender::varchar as owner, coalesce(p_name, 'Unknown') as name, coalesce(p_size, 0)::varchar as denomination, amount::varchar as amount, output_index::varchar as output_index, case when asset_id = 2 then platform_locktime::varchar end as locktime, staked::varchar as staked,
    case when not staked then consuming_tx end as consuming_tx, case when not staked then consuming_ts::varchar end as consuming_ts, stake_end::varchar as stake_end from utxos left join n using (asset_id)""", "utxos")  # fmt: skip
def p_answers(v: Views) -> DataFrame:
    rows = balances.p_response(shown_utxos(v), F.col("asset_id") == 2)
    return fields(rows, "utxo_id", {"owner": "$.addresses[0]", "name": "$.asset.name", "denomination": "$.asset.denomination", "amount": "$.asset.amount", "output_index": "$.outputIndex", "locktime": "$.platformLocktime", "staked": "$.staked", "consuming_tx": "$.consumingTxHash", "consuming_ts": "$.consumingBlockTimestamp", "stake_end": "$.utxoEndTimestamp"})


@query(f"with {_NAMES} select utxo_id, (supp + 100000)::varchar as owner, coalesce(p_brand, '???') as symbol, 'transfer' as utxo_type, platform_locktime::varchar as locktime, consuming_tx, consuming_ts::varchar as consuming_ts from utxos left join n using (asset_id)", "utxos")
def xc_answers(v: Views) -> DataFrame:
    return fields(balances.xc_response(shown_utxos(v)), "utxo_id", {"owner": "$.addresses[1]", "symbol": "$.asset.symbol", "utxo_type": "$.utxoType", "locktime": "$.locktime", "consuming_tx": "$.consumingTxHash", "consuming_ts": "$.consumingTxTimestamp"})


_FEW = f"with u as (select case when consumed_on <> 'x' and platform_locktime > {NOW} then 'atomicMemoryLocked' when consumed_on <> 'x' then 'atomicMemoryUnlocked' when platform_locktime > {NOW} then 'locked' else 'unlocked' end as category, asset_id, amount from utxos where consuming_tx is null and consumed_on <> 'x'), b as (select category, asset_id, sum(amount)::bigint as total, count(*) as n from u group by all)"


def _few(v: Views) -> DataFrame:
    return balances.x_balances(v.utxos.where("consuming_tx is null and consumed_on <> 'x'"), F.lit(NOW))


@query(_FEW + ", c as (select unnest(['unlocked', 'locked', 'atomicMemoryUnlocked', 'atomicMemoryLocked']) as category) select category, asset_id, total, n from c left join b using (category)", "utxos")
def every_category(v: Views) -> DataFrame:
    return balances.all_categories(_few(v), balances.X_CATEGORIES).select("category", "asset_id", long("total").alias("total"), "n")


@query(_FEW + " select category, asset_id, total::varchar as amount, n from b", "utxos")
def balances_as_json(v: Views) -> DataFrame:
    kind = "map<string,array<struct<assetId:bigint,amount:string,utxoCount:bigint>>>"
    rows = balances.balances_json(_few(v), balances.X_CATEGORIES).select(F.explode(F.from_json("balances", kind)).alias("category", "items"))
    return rows.select("category", F.explode("items").alias("i")).select("category", F.col("i.assetId").alias("asset_id"), "i.amount", F.col("i.utxoCount").alias("n"))


# Staking, validators, registries


def named(df: DataFrame) -> DataFrame:
    return df.withColumn("subnet_id", F.when(F.col("subnet_id") == "primary", staking.PRIMARY).otherwise(F.col("subnet_id")))


_STAKES = "st as (select * from p_txs where tx_type in ('AddValidatorTx', 'AddDelegatorTx') or (tx_type in ('AddPermissionlessValidatorTx', 'AddPermissionlessDelegatorTx') and subnet_id = 'primary')), rw as (select staking_tx_id, max(tx_id) as reward_tx from p_txs where tx_type = 'RewardValidatorTx' group by 1)"


@query(f"with {_STAKES} select tx_id, node_id, reward_tx is not null as completed, reward_tx as reward_tx_id from st left join rw on rw.staking_tx_id = st.tx_id", "p_txs")
def stakes_completed(v: Views) -> DataFrame:
    txs = named(v.p_txs)
    return staking.complete_staking(staking.staking_records(txs), txs.where("tx_type = 'RewardValidatorTx'")).select("tx_id", "node_id", "completed", "reward_tx_id")


@query("with r as (select tx_id, row_number() over (order by start_ts desc, case when tx_type like '%ValidatorTx' then 'VALIDATOR' else 'DELEGATOR' end desc, tx_id) as position from p_txs where tx_type in ('AddValidatorTx', 'AddDelegatorTx')) select tx_id, position::int as position, case when (select count(*) from r) > 30 then base64('30'::blob) end as next_token from r where position <= 30", "p_txs")
def pending_page(v: Views) -> DataFrame:
    rows = staking.staking_records(v.p_txs.where("tx_type in ('AddValidatorTx', 'AddDelegatorTx')")).select("tx_id", "start_time", "reward_type")
    return balances.paginate(rows, staking.pending_order(), 30).select("tx_id", "position", "next_token")


_SIDES = f"e as (select utxo_id as tx_id, case when part % 2 = 0 then 'VALIDATOR' else 'DELEGATOR' end as reward_type, ship_ts as start_time, ship_ts + {DAY} * 60 as end_time, part, supp from line), ours as (select * from e where part % 9 <> 0), theirs as (select * from e where part % 8 <> 0)"


def _sides(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = v.line.select(F.col("utxo_id").alias("tx_id"), F.when(F.col("part") % 2 == 0, "VALIDATOR").otherwise("DELEGATOR").alias("reward_type"), F.col("ship_ts").alias("start_time"), (F.col("ship_ts") + 60 * DAY).alias("end_time"), F.when(F.col("supp") % 3 == 0, "r").alias("reward_tx_id"), "part")
    return staking.compare_rewards(e.where("part % 9 <> 0"), e.where("part % 8 <> 0"), F.lit(NOW))


@query(f"with {_SIDES} select reward_type, (select count(*) from ours o where o.reward_type = t.reward_type) as ours, count(*) as theirs from theirs t group by reward_type", "line")
def rewards_counted(v: Views) -> DataFrame:
    return _sides(v)[0].select("reward_type", "ours", "theirs")


@query(f"with {_SIDES} select tx_id, case when supp % 3 = 0 then 'rewarded' when end_time <= {NOW} then 'ended' when start_time > {NOW} then 'pending' else 'active' end as reason from theirs where part % 9 = 0", "line")
def rewards_missing(v: Views) -> DataFrame:
    return _sides(v)[1].select("tx_id", "reason")


@query("""select tx_id as tx_hash, node_id, case when tx_type = 'AddValidatorTx' or subnet_id = 'primary' then 'main' else subnet_id end as subnet, weight as amount, case when tx_index % 7 = 0 then null else (tx_index % 7)::varchar || '.0000000000000000' end as fee, start_ts as start, end_ts as end_,
    case when (tx_type = 'AddValidatorTx' or subnet_id = 'primary') and tx_index % 2 = 0 then 'key' || tx_index end as bls from p_txs where tx_type in ('AddValidatorTx', 'AddPermissionlessValidatorTx')""", "p_txs")  # fmt: skip
def validators_registered(v: Views) -> DataFrame:
    i = F.col("tx_index")
    txs = named(v.p_txs).withColumns({"delegation_shares": (i % 7 * 10_000).cast("int"), "bls": F.struct(F.concat(F.lit("key"), s(i)).alias("key"), F.when(i % 2 == 0, "proof").alias("proof"))})
    subnet = F.when(F.col("subnet_id") == staking.PRIMARY, "main").otherwise(F.col("subnet_id"))
    return validators.validators(txs).select("tx_hash", "node_id", subnet.alias("subnet"), "amount", "fee", "start", F.col("end").alias("end_"), F.col("bls.key").alias("bls"))


@query(f"with {_STAKES} select tx_id as tx_hash, node_id, case when tx_type = 'AddDelegatorTx' or subnet_id = 'primary' then 'main' else subnet_id end as subnet, weight as amount, d_owner as owner, reward_tx, reward_tx is not null as completed from p_txs p left join rw on rw.staking_tx_id = p.tx_id where tx_type in ('AddDelegatorTx', 'AddPermissionlessDelegatorTx')", "p_txs")
def delegators_registered(v: Views) -> DataFrame:
    txs = named(v.p_txs)
    rows = validators.complete_delegators(validators.delegators(txs), txs.where("tx_type = 'RewardValidatorTx'"))
    subnet = F.when(F.col("subnet_id") == staking.PRIMARY, "main").otherwise(F.col("subnet_id"))
    return rows.select("tx_hash", "node_id", subnet.alias("subnet"), "amount", F.get("owner.addresses", F.lit(0)).alias("owner"), "reward_tx", "completed")


@query(f"""with {_STAKES}, paid as (select tx_id::varchar as tx, sum(amount) filter (part % 7 = 0)::bigint as validation_reward from outs group by 1)
    select 'o' || tx.tx_id as tx_hash, case when tx.tx_id % 3 = 0 then 'w' || tx.tx_id end as reward_tx, validation_reward from tx left join paid on paid.tx = tx.tx_id::varchar""", "p_txs")  # fmt: skip
def rewards_applied(v: Views) -> DataFrame:
    txs = p_typed(v)
    o = F.concat(F.lit("o"), "tx_id")
    utxos = txs.select(o.alias("staking_tx_id"), F.explode(F.concat("outs", "stake_outs", "exported_outs")).alias("out"))
    rewards = v.tx.where("tx_id % 3 = 0").select(F.concat(F.lit("o"), s("tx_id")).alias("staking_tx_id"), F.concat(F.lit("w"), s("tx_id")).alias("tx_id"))
    vals = v.tx.select(F.concat(F.lit("o"), s("tx_id")).alias("tx_hash"))
    return validators.apply_rewards(vals, rewards, utxos).select("tx_hash", "reward_tx", long("validation_reward").alias("validation_reward"))


@query("select tx_hash, start from validator where node_id = 3", "validator")
def one_node(v: Views) -> DataFrame:
    return validators.validators_of_node(v.validator, 3).select("tx_hash", "start")


@query(f"""with x as (select *, case when node_id % 11 = 0 then 'removed' when node_id % 7 = 0 then 'completed' when start > {NOW} - {200 * DAY} then 'active' else 'pending' end as st from validator)
    select tx_hash, node_id::varchar as node, st as status, case when st in ('active', 'pending') then amount::varchar end as delegated, case when st = 'active' then (amount + 1)::varchar end as potential, case when st = 'completed' then (amount + 2)::varchar end as rewards, case when st = 'removed' then 'rm' || node_id end as remove_tx from x""", "validator")  # fmt: skip
def validator_answers(v: Views) -> DataFrame:
    k, a = F.col("node_id"), F.col("amount")
    status = F.when(k % 11 == 0, "removed").when(k % 7 == 0, "completed").when(F.col("start") > NOW - 200 * DAY, "active").otherwise("pending")
    rows = v.validator.withColumns({"fee": F.lit("2"), "validation_status": status, "delegator_count": F.lit(1), "delegated_amount": a, "potential_reward": a + 1, "validation_reward": a + 2, "reward_tx": F.lit("r"), "remove_tx": F.concat(F.lit("rm"), s(k)), "remove_ts": F.col("end")})
    return fields(validators.validator_response(rows), "tx_hash", {"node": "$.nodeId", "status": "$.validationStatus", "delegated": "$.amountDelegated", "potential": "$.potentialRewards", "rewards": "$.rewards", "remove_tx": "$.removeTxHash"})


def chain_txs(v: Views) -> DataFrame:
    """Subnets are customers, ownership moves and chains are orders."""
    c, k = F.col("c_custkey"), F.col("tx_id")
    own = lambda x: F.struct(F.array(s(x)).alias("addresses"))
    none = F.lit(None).cast("string")
    made_ = v.table("customer").select(s(c).alias("tx_id"), F.lit("CreateSubnetTx").alias("tx_type"), F.lit(0).cast("bigint").alias("height"), c.cast("bigint").alias("tx_index"), F.lit(0).cast("bigint").alias("block_ts"), none.alias("subnet_id"), own(F.col("c_nationkey")).alias("subnet_owner"), none.alias("manager_chain_id"), none.alias("manager_address"), none.alias("chain_name"), none.alias("vm_id"), none.cast("binary").alias("genesis"))
    kind = F.get(F.array(F.lit("CreateChainTx"), F.lit("TransferSubnetOwnershipTx"), F.lit("ConvertSubnetToL1Tx")), (k % 3).cast("int"))
    genesis = F.when(k % 2 == 0, F.concat(F.lit('{ "config": {"chainId": '), s(k % 5), F.lit("} }"))).otherwise(F.concat(F.lit("raw "), s(k))).cast("binary")
    moves = v.tx.select(F.concat(F.lit("t"), s(k)).alias("tx_id"), kind.alias("tx_type"), F.col("block_number").alias("height"), k.alias("tx_index"), F.col("ts").alias("block_ts"), s("sender").alias("subnet_id"), own(k % 100).alias("subnet_owner"), F.concat(F.lit("m"), s(k)).alias("manager_chain_id"), F.concat(F.lit("0x"), s(k)).alias("manager_address"), F.concat(F.lit("n"), s(k)).alias("chain_name"), F.lit("vm").alias("vm_id"), genesis.alias("genesis"))
    return made_.unionByName(moves)


@query("""with mv as (select sender, arg_max(tx_id % 100, block_number * 1000000000 + tx_id) as owner from tx where tx_id % 3 = 1 group by 1), l1 as (select sender, arg_max(tx_id, block_number * 1000000000 + tx_id) as k from tx where tx_id % 3 = 2 group by 1),
    r as (select c_custkey::varchar as subnet_id, 0 as created_height, c_nationkey::varchar as create_owner, coalesce(owner, c_nationkey)::varchar as current_owner, k is not null as is_l1, 'm' || k as manager_chain_id from customer left join mv on mv.sender = c_custkey left join l1 on l1.sender = c_custkey)
    select * from r union all select 'main', -1, '', '', false, null""", "tx")  # fmt: skip
def subnet_registry(v: Views) -> DataFrame:
    """Created subnets and the one that no transaction creates."""
    rows = registry.subnets(chain_txs(v)).select("subnet_id", "created_height", F.col("create_owner.addresses").alias("a"), F.col("current_owner.addresses").alias("b"), "is_l1", "manager_chain_id")
    seed = registry.primary_network_seed(v.spark)[0].select(F.lit("main").alias("subnet_id"), "created_height", F.col("create_owner.addresses").alias("a"), F.col("current_owner.addresses").alias("b"), "is_l1", F.lit(None).cast("string").alias("manager_chain_id"))
    return rows.unionByName(seed).select("subnet_id", "created_height", F.get("a", F.lit(0)).alias("create_owner"), F.get("b", F.lit(0)).alias("current_owner"), "is_l1", "manager_chain_id")


@query("""select 't' || tx_id as blockchain_id, 'n' || tx_id as name, block_number as block, ts, case when tx_id % 2 = 0 and tx_id % 5 <> 0 then tx_id % 5 end as evm_chain_id, sender::varchar as subnet_id from tx where tx_id % 3 = 0
    union all select unnest(['11111111111111111111111111111111LpoYY', '2oYMBNV4eNHyqk2fjjV5nVQLDbtmNJzq5s3qs3Lo6ftnC6FByM', '2q9e4r6Mu3U68nU1fYjgbR6JvwrRx36CohpAX5UQxse55x1Q5']), unnest(['P-Chain', 'X-Chain', 'C-Chain']), -1, 1599696000, unnest([null, null, 43114]), '11111111111111111111111111111111LpoYY'""", "tx")  # fmt: skip
def subnet_chains(v: Views) -> DataFrame:
    columns = ["blockchain_id", "name", "block", "ts", "evm_chain_id", "subnet_id"]
    return registry.subnet_blockchains(chain_txs(v)).select(columns).unionByName(registry.primary_network_seed(v.spark)[1].select(columns))


@query("""select 't' || tx_id as blockchain_id, case when tx_id % 2 = 0 then '{"config":{"chainId":' || tx_id % 5 || '}}' else base64(('raw ' || tx_id)::blob) end as genesis from tx where tx_id % 3 = 0""", "tx")
def chains_with_genesis(v: Views) -> DataFrame:
    return registry.blockchains(chain_txs(v)).select("blockchain_id", "genesis")


@query("with b as (select sum(round(s_acctbal * 100)::bigint + 1000000)::bigint as w, sum(s_suppkey)::bigint as p from supplier), d as (select sum(amount)::bigint as d from line) select p as potential_reward, round((w + d)::double / 1000000000000000, 9) as staking_ratio from b, d", "line")
def network_ratio(v: Views) -> DataFrame:
    d = v.line.groupBy("supp").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("w"))
    k = F.col("s_suppkey")
    vals = v.table("supplier").join(d, k == F.col("supp"), "left").select(k.alias("node_id"), F.lit(True).alias("connected"), (F.round(F.col("s_acctbal") * 100).cast("bigint") + 1_000_000).alias("weight"), F.coalesce("w", F.lit(0)).alias("delegator_weight"), F.coalesce("n", F.lit(0)).alias("delegator_count"), k.alias("potential_reward"))
    out = registry.network_stats(vals, vals.select("node_id", F.lit("v").alias("version")), F.lit(10**15))
    return out.select(long("potential_reward").alias("potential_reward"), F.round(F.col("staking_ratio").cast("double"), 9).alias("staking_ratio"))


# Control and comparison


@query("with h as (select chain, max(block_number) as head from tx group by 1), e as (select chain, max(block_number) // 3 as done from tx where chain <> 'P' group by 1) select chain, coalesce(done + 1, 0) as first, least(coalesce(done + 1, 0) + 999, head) as last, coalesce(done + 1, 0) + 999 <= head as full_batch from h left join e using (chain) where coalesce(done + 1, 0) <= head", "tx")
def next_exports(v: Views) -> DataFrame:
    heads = v.tx.groupBy("chain").agg(F.max("block_number").alias("height"))
    done = heads.where("chain <> 'P'").select("chain", F.floor(F.col("height") / 3).cast("bigint").alias("height"))
    return control.export_range(done, heads).withColumnRenamed("full", "full_batch")


@query("""with f as (select epoch_us(ts) // 1000000 as t, event_id % 9 as blocks, event_id % 100 as bytes, event_id % 5 as txs from events), m as (select min(t) as t0 from f),
    w as (select (t - t0) // 3600 as "window", count(*) as batches, sum(blocks)::bigint as blocks, sum(bytes)::bigint as bytes, sum(txs)::bigint as txs from f, m group by 1)
    select *, sum(blocks) over o as total_blocks, sum(txs) over o as total_txs, round(blocks / ("window" - coalesce(lag("window") over o, -1)) / 3600.0::double, 9) as recent_rate, round((sum(blocks) over o) / ("window" + 1) / 3600.0::double, 9) as avg_rate from w window o as (order by "window")""")  # fmt: skip
def consumer_rates(v: Views) -> DataFrame:
    k = F.col("event_id")
    frames = v.table("events").select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"), (k % 9).alias("blocks"), (k % 100).alias("bytes"), (k % 5).alias("txs"))
    return control.consumer_metrics(frames, width_s=3600).withColumns({c: F.round(c, 9) for c in ("recent_rate", "avg_rate")})


@query("with e as (select epoch_us(ts) // 1000000 // 3600 * 3600 as win, round(value * 100)::bigint as ms, event_id % 1000 as size from events) select win, count(*) as n, min(ms) as min_ms, max(ms) as max_ms, round(avg(ms), 6) as avg_ms, sum(size)::bigint as bytes from e group by win")
def ingest_stats_hourly(v: Views) -> DataFrame:
    log = v.table("events").select(F.col("ts").cast("timestamp").alias("ts"), F.round(F.col("value") * 100).cast("bigint").alias("ms"), (F.col("event_id") % 1000).alias("size"))
    return control.ingest_stats_by_time(log, "ts", "ms", "size", "1 hour").select(F.unix_seconds("window.start").alias("win"), "n", "min_ms", "max_ms", F.round("avg_ms", 6).alias("avg_ms"), "bytes")


@query("""with recursive t as (select conv_id, turn, coalesce(length(text), 0) as size, row_number() over (partition by conv_id order by turn) as i from conversations),
    f as (select conv_id, turn, size, i, size as used, 0 as frame from t where i = 1 union all select t.conv_id, t.turn, t.size, t.i, case when used + t.size > 800 then t.size else used + t.size end, case when used + t.size > 800 then frame + 1 else frame end from f join t on t.conv_id = f.conv_id and t.i = f.i + 1)
    select conv_id, turn, size, frame from f""")  # fmt: skip
def frames_cut(v: Views) -> DataFrame:
    rows = v.table("conversations").select("conv_id", "turn", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("size"))
    return control.frames_by_size(rows, "conv_id", "turn", "size", 800)


_MONITOR = """with recursive e as (select {key} as chain, event_id, epoch_us(ts) // 1000 as t, event_id % 4 * event_id as ms, event_id % 1000 as size from events),
    r as (select *, row_number() over (partition by chain order by t, event_id) as i, coalesce(lag(t) over (partition by chain order by t, event_id), t) as since from e),
    w as (select chain, i, i as first, 1 as n, 0 as win, since + {ms} as due, t, ms as min_ms, ms as max_ms, ms::double as sum_ms, size::bigint as bytes, event_id as height from r where i = 1
        union all select r.chain, r.i, case when w.n >= {n} or w.t >= w.due then r.i else w.first end, case when w.n >= {n} or w.t >= w.due then 1 else w.n + 1 end, case when w.n >= {n} or w.t >= w.due then win + 1 else win end, case when w.n >= {n} or w.t >= w.due then w.t + {ms} else w.due end, r.t,
            case when w.n >= {n} or w.t >= w.due or w.min_ms = 0 then r.ms else least(w.min_ms, r.ms) end, case when w.n >= {n} or w.t >= w.due then r.ms else greatest(w.max_ms, r.ms) end, case when w.n >= {n} or w.t >= w.due then 0 else w.sum_ms end + r.ms, case when w.n >= {n} or w.t >= w.due then 0 else w.bytes end + r.size, r.event_id
        from w join r on r.chain = w.chain and r.i = w.i + 1)
    select {out}win, n, min_ms, max_ms, round(sum_ms / n, 6) as avg_ms, bytes, height, n >= {n} or t >= due as closed from w qualify i = max(i) over (partition by chain, win)"""


def _monitored(v: Views, *keys: str) -> DataFrame:
    k = F.col("event_id")
    return v.table("events").select(*((F.col("user_id") % 20).alias(c) for c in keys), "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("t"), (k % 4 * k).alias("ms"), (k % 1000).alias("size"))


@query(_MONITOR.format(key="user_id % 20", n=40, ms=36_000_000, out="chain, "))
def ingest_windows(v: Views) -> DataFrame:
    """Windows of 40 blocks or ten hours, whichever is first, of twenty chains; a quarter of the times are zero."""
    return control.ingest_stats(_monitored(v, "chain"), "t", "ms", "size", 40, 36_000, ("event_id",), ("chain",)).withColumn("avg_ms", F.round("avg_ms", 6))


@query(_MONITOR.format(key="0", n=100, ms=14_400_000, out=""))
def ingest_windows_all(v: Views) -> DataFrame:
    return control.ingest_stats(_monitored(v), "t", "ms", "size", 100, 14_400, ("event_id",)).withColumn("avg_ms", F.round("avg_ms", 6))


@query("with d as (select utxo_id as id, ship_ts as ts from line where flag <> 'R') select line.utxo_id as id, d.ts as archived_ts from line left join d on d.id = line.utxo_id union all select sha256(line.utxo_id), null from line", "line")
def archive_lookup(v: Views) -> DataFrame:
    """Times of all lines from an archive of most of them, and of ids that no line has: other ids' prefixes are told apart."""
    root = f"{shared_folder(v.spark)}/archive-{uuid.uuid4().hex}"
    archive.write_archive(v.line.where("flag <> 'R'").select(F.col("utxo_id").alias("id"), F.col("ship_ts").alias("ts")), root)
    ids = v.line.select(F.col("utxo_id").alias("id"))
    return archive.look_up(v.spark, root, ids.unionByName(ids.select(F.sha2("id", 256).alias("id")))).select("id", "archived_ts")


@query("select least(3, (round(value * 100)::bigint > 1000)::int + (round(value * 100)::bigint > 5000)::int + (round(value * 100)::bigint > 20000)::int) as bucket, count(*) as n from events group by 1")
def durations_by_bucket(v: Views) -> DataFrame:
    return control.duration_histogram(v.table("events").select(F.round(F.col("value") * 100).cast("bigint").alias("ms")), "ms", [1000, 5000, 20000])


@query("""with l as (select * from line where part % 3 <> 0), a as (select tx_id, utxo_id, amount from l where part % 11 <> 0), b as (select tx_id, utxo_id, case when part % 10 = 0 then amount + 1 else amount end as amount from l where part % 13 <> 0)
    select coalesce(a.tx_id, b.tx_id) as id, '$.utxos[' || coalesce(a.utxo_id, b.utxo_id) || ']' || f as path, case f when '.amount' then a.amount::varchar else a.utxo_id end as a, case f when '.amount' then b.amount::varchar else b.utxo_id end as b
    from a full join b using (tx_id, utxo_id), (values ('.amount'), ('.utxoId')) t(f) where case f when '.amount' then a.amount::varchar else a.utxo_id end is distinct from case f when '.amount' then b.amount::varchar else b.utxo_id end""", "line")  # fmt: skip
def answers_diff(v: Views) -> DataFrame:
    def answers(keep: str, amount: Column) -> DataFrame:
        item = F.struct(F.col("utxo_id").alias("utxoId"), amount.alias("amount"), F.lit(keep).alias("age"))
        return v.line_by_tx.where(f"part % 3 <> 0 and {keep}").groupBy(F.col("tx_id").alias("id")).agg(F.to_json(F.struct(F.collect_list(item).alias("utxos"))).alias("j"))

    changed = F.when(F.col("part") % 10 == 0, F.col("amount") + 1).otherwise(F.col("amount"))
    return quality.diff_nested(answers("part % 11 <> 0", F.col("amount")), answers("part % 13 <> 0", changed), "id", "j", skip=("age",))


@query(f"select tx_id, coalesce(sum(amount) filter (amount % 5 <> 0 and part % 4 <> 0), 0)::bigint as kept, count(*) filter (ship_ts > {NOW}) as open from (select *, case when part % 4 = 0 then 0 else amount end as shown from line) where true group by tx_id", "line")
def entries_filtered(v: Views) -> DataFrame:
    amount = F.when((F.col("part") % 4 == 0) | (F.col("amount") % 5 == 0), 0).otherwise(F.col("amount"))
    rows = v.line.groupBy("tx_id").agg(F.collect_list(F.struct(s(amount).alias("amount"), F.col("ship_ts").alias("end_time"))).alias("e"))
    kept = F.aggregate(quality.filter_zero_balances(F.col("e")), F.lit(0).cast("bigint"), lambda a, x: a + x["amount"].cast("bigint"))
    return rows.select("tx_id", kept.alias("kept"), F.size(quality.filter_expired(F.col("e"), F.lit(NOW))).cast("bigint").alias("open"))


@query("select tx_id, tx_id % 3 <> 0 as same from tx", "tx")
def json_compared(v: Views) -> DataFrame:
    k = F.col("tx_id")
    a = F.concat(F.lit('{"a":'), s(k), F.lit(',"b":[1,{"c":null}]}'))
    b = F.concat(F.lit('{ "b": [1, {"c": null}], "a": '), s(F.when(k % 3 == 0, k + 1).otherwise(k)), F.lit("}"))
    return v.tx.select("tx_id", quality.json_equal(a, b).alias("same"))


@query("""select utxo_id, part % 3 as kept_zero, case when part % 2 = 0 then '0' else supp::varchar end as big, 21000 + case when part % 5 = 0 then 32000 else 0 end + 4 * 2 + 16 * 32 as gas, case when part % 3 = 0 then 'nft' when part % 5 = 0 then 'nft' else 'secp256k1' end as asset_type,
    (part % 9)::varchar || ',' || (part % 9 + 1) as addresses, case when part % 2 = 0 then '0xab' when part % 3 = 0 then 'true' else 'Ab' end as csv, left(utxo_id, 4) as prefix, case when part % 4 <> 0 then part % 4 end as chain from line""", "line")  # fmt: skip
def small_rules(v: Views) -> DataFrame:
    p = F.col("part")
    h = lambda x: F.concat(F.lit("0x"), F.hex(x))
    # A digest has no zero byte for sure: its digits 0 are made 1, and two zero bytes are added.
    data = F.concat(F.lit("0x"), F.regexp_replace("utxo_id", "0", "1"), F.lit("0000"))
    return v.line.select(
        "utxo_id", hexes.hex_to_long_keep_zero(h(p % 3)).alias("kept_zero"), hexes.hex_to_big_string_zero(F.when(p % 2 == 0, "").otherwise(h(F.col("supp")))).alias("big"), hexes.intrinsic_gas(data, p % 5 == 0).alias("gas"), rules.asset_type(F.when(p % 3 == 0, "My NFT").otherwise("coin"), F.when(p % 5 == 0, "x")).alias("asset_type"),
        F.array_join(rules.parse_address_list(F.concat(s(p % 9), F.lit(" , ,"), s(p % 9 + 1), F.lit(","), s(p % 9))), ",").alias("addresses"), hexes.normalise_csv_value(F.when(p % 2 == 0, "0xAb").when(p % 3 == 0, "TRUE").otherwise("Ab")).alias("csv"), hexes.hash_prefix("utxo_id", 4).alias("prefix"),
        rules.evm_chain_id(F.concat(F.lit('{"config":{"chainId":'), s(p % 4), F.lit("}}"))).alias("chain"),
    )


@query("select tx_id, case chain when 'F' then 'utxo' else 'evm' end as kind from tx where chain <> 'P'", "tx")
def chains_named(v: Views) -> DataFrame:
    dim = v.spark.range(1).select(F.explode(F.array(F.struct(F.lit("F").alias("alias"), F.lit("utxo").alias("kind")), F.struct(F.lit("O").alias("alias"), F.lit("evm").alias("kind")))).alias("x")).select("x.*")
    return rules.chain_kind(v.tx.select("tx_id", "chain"), dim)[0].select("tx_id", "kind")
