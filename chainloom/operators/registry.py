"""Subnets, blockchains, assets, chains that addresses touched, and network statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.functions.rules import evm_chain_id, parse_genesis
from chainloom.operators.control import fix_timestamps
from chainloom.operators.staking import PRIMARY
from chainloom.sources.versions import VersionLog


def latest(events: DataFrame, key: str, value: Column, order: Column) -> DataFrame:
    """(key, value) of the last event by a total order."""
    return events.groupBy(key).agg(F.max_by(value, order).alias("value"))


def subnets(p_txs: DataFrame) -> DataFrame:
    """Created subnets with their first and current owners, and the L1 that they were converted to. Events of unknown
    subnets are left out."""
    order = F.struct("height", "tx_index")
    made = p_txs.where(F.col("tx_type") == "CreateSubnetTx").select(F.col("tx_id").alias("subnet_id"), F.col("height").alias("created_height"), F.col("block_ts").alias("created_ts"), F.col("subnet_owner").alias("create_owner"))
    owner = latest(p_txs.where(F.col("tx_type") == "TransferSubnetOwnershipTx"), "subnet_id", F.col("subnet_owner"), order).select("subnet_id", F.col("value").alias("moved_to"))
    l1 = latest(p_txs.where(F.col("tx_type") == "ConvertSubnetToL1Tx"), "subnet_id", F.struct("tx_id", "manager_chain_id", "manager_address"), order)
    l1 = l1.select("subnet_id", F.col("value.tx_id").alias("l1_tx_id"), "value.manager_chain_id", "value.manager_address")
    out = made.join(owner, "subnet_id", "left").join(l1, "subnet_id", "left")
    return out.select(*made.columns, F.coalesce("moved_to", "create_owner").alias("current_owner"), F.col("l1_tx_id").isNotNull().alias("is_l1"), "l1_tx_id", "manager_chain_id", "manager_address")


def subnet_blockchains(p_txs: DataFrame) -> DataFrame:
    rows = p_txs.where(F.col("tx_type") == "CreateChainTx")
    return rows.select(F.col("tx_id").alias("blockchain_id"), F.col("chain_name").alias("name"), F.col("height").alias("block"), F.col("block_ts").alias("ts"), evm_chain_id(F.col("genesis").cast("string")).alias("evm_chain_id"), "subnet_id", "vm_id")


#: Fixed values of the primary network: its first time, the block that stands for none, and the names, ids and machines of its
#: chains on the main and on the test network (5).
SEED_TS, SEED_BLOCK = 1599696000, -1
SEED_CHAINS = {
    1: (
        (PRIMARY, "P-Chain", "platformvm", None),
        ("2oYMBNV4eNHyqk2fjjV5nVQLDbtmNJzq5s3qs3Lo6ftnC6FByM", "X-Chain", "jvYyfQTxGMJLuGWa55kdP2p2zSUYsQ5Raupu4TW34ZAUBAbtq", None),
        ("2q9e4r6Mu3U68nU1fYjgbR6JvwrRx36CohpAX5UQxse55x1Q5", "C-Chain", "mgj786NP7uDwBCcq6YwThhaN8FLyybkCa4zBWTQbNgmK6k9A6", 43114),
    ),
    5: (
        (PRIMARY, "P-Chain", "platformvm", None),
        ("2JVSBoinj9C2J33VntvzYtVJNZdN2NKiwwKjcumHUWEb5DbBrm", "X-Chain", "jvYyfQTxGMJLuGWa55kdP2p2zSUYsQ5Raupu4TW34ZAUBAbtq", None),
        ("yH8D7ThNJkxmtkuv2jgBa4P1Rn3Qpr4pPr7QYNfcdoS6k6HWp", "C-Chain", "mgj786NP7uDwBCcq6YwThhaN8FLyybkCa4zBWTQbNgmK6k9A6", 43113),
    ),
}


def primary_network_seed(spark: SparkSession, network: int = 1) -> tuple[DataFrame, DataFrame]:
    """(the subnet's row, its chains): what no transaction creates. The subnet has one empty owner."""
    owner = F.struct(F.lit(0).cast("bigint").alias("threshold"), F.lit(0).cast("decimal(20,0)").alias("locktime"), F.array(F.lit("")).alias("addresses"))
    subnet = spark.range(1).select(F.lit(PRIMARY).alias("subnet_id"), F.lit(SEED_BLOCK).cast("bigint").alias("created_height"), F.lit(SEED_TS).cast("bigint").alias("created_ts"), owner.alias("create_owner"), owner.alias("current_owner"), F.lit(False).alias("is_l1"))
    chains = [(i, name, SEED_BLOCK, SEED_TS, evm, PRIMARY, vm) for i, name, vm, evm in SEED_CHAINS[network]]
    return subnet, spark.createDataFrame(chains, "blockchain_id string, name string, block bigint, ts bigint, evm_chain_id bigint, subnet_id string, vm_id string")


def list_subnets(subnet_rows: DataFrame, chains: DataFrame) -> DataFrame:
    """Subnets with their chains, a list in order of id; sort by subnet_order() and page."""
    c = chains.groupBy("subnet_id").agg(F.sort_array(F.collect_list(F.struct("blockchain_id", "name", "vm_id", "evm_chain_id"))).alias("blockchains"))
    return subnet_rows.join(c, "subnet_id", "left")


def subnet_order() -> list[Column]:
    return [F.desc("created_height"), F.desc("subnet_id")]


def blockchains(p_txs: DataFrame) -> DataFrame:
    """Created chains with their genesis as JSON or Base64 text."""
    rows = p_txs.where(F.col("tx_type") == "CreateChainTx")
    return rows.select(F.col("block_ts").alias("ts"), F.col("height").alias("block"), F.col("tx_id").alias("blockchain_id"), "vm_id", "subnet_id", F.col("chain_name").alias("name"), evm_chain_id(F.col("genesis").cast("string")).alias("evm_chain_id"), parse_genesis(F.col("genesis")).alias("genesis"))


def blockchain_order() -> list[Column]:
    return [F.desc("block"), F.desc("blockchain_id")]


def assets(x_txs: DataFrame, native: DataFrame | None = None, times: DataFrame | None = None) -> DataFrame:
    """Created assets over both eras, the last of an id. times(id, ts): the repaired times of the first era's transactions;
    native: rows of the same columns for what no transaction creates."""
    if times is not None:
        x_txs = fix_timestamps(x_txs, times)
    rows = x_txs.where(F.col("tx_type") == "CreateAssetTx").select(F.col("tx_id").alias("asset_id"), F.col("asset_name").alias("name"), F.col("asset_symbol").alias("symbol"), F.col("asset_denomination").alias("denomination"), F.col("ts").alias("created_ts"), F.lit("secp256k1").alias("type"), F.lit("fixed").alias("cap"))
    rows = rows if native is None else rows.unionByName(native)
    rest = [c for c in rows.columns if c != "asset_id"]
    return rows.groupBy("asset_id").agg(F.max_by(F.struct(*rest), F.struct("created_ts", "name", "symbol", "denomination")).alias("r")).select("asset_id", "r.*")


def address_chains(touches: DataFrame, addresses: str = "addresses", chains: str = "chains") -> DataFrame:
    """Distinct (address, chain) of rows with lists of both: a row's addresses touch all of its chains."""
    return touches.select(F.explode(addresses).alias("address"), chains).select("address", F.explode(chains).alias("chain")).distinct()


def touches(outputs: DataFrame, imports: DataFrame | None = None, with_stake_locks: bool = False, with_imports: bool = True) -> DataFrame:
    """(addresses, chains): outputs touch their own chain and the one that may use them; imports(tx_id, source_chain) make
    their transaction's outputs touch the source too. Stakeable locks do not count unless asked for."""
    rows = outputs if with_stake_locks else outputs.where(F.upper("utxo_type") != "STAKEABLE_LOCK")
    own = rows.select("addresses", F.array_distinct(F.array("created_on", "consumed_on")).alias("chains"))
    if imports is None or not with_imports:
        return own
    return own.unionByName(rows.join(imports.select("tx_id", "source_chain").distinct(), "tx_id").select("addresses", F.array("source_chain").alias("chains")))


def list_chain_ids(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(address, chains): for each of wanted(address) its chains in order; addresses without any are left out."""
    return pairs.join(wanted.select("address").distinct(), "address", "left_semi").groupBy("address").agg(F.sort_array(F.collect_set("chain")).alias("chains"))


def version_of(vals: DataFrame, peers: DataFrame) -> DataFrame:
    """vals with version: offline if not connected, else the peer's, else unknown."""
    p = peers.groupBy("node_id").agg(F.max("version").alias("v"))
    return vals.join(p, "node_id", "left").withColumn("version", F.when(~F.coalesce("connected", F.lit(False)), "offline").otherwise(F.coalesce("v", F.lit("unknown")))).drop("v")


def network_stats(vals: DataFrame, peers: DataFrame, supply: Column) -> DataFrame:
    """One row: totals over current validators, the staked share of the supply with 20 decimals, and stake by version,
    largest first."""
    d = "decimal(38,0)"
    by = version_of(vals, peers).groupBy("version").agg(F.sum(F.col("weight").cast(d)).alias("stake"), F.count(F.lit(1)).alias("n"), F.sum(F.col("delegator_weight").cast(d)).alias("delegated"), F.sum("delegator_count").alias("delegators"), F.sum(F.col("potential_reward").cast(d)).alias("rewards"))
    out = by.agg(
        F.sum("stake").cast(d).alias("validator_stake"), F.sum("n").alias("validator_count"), F.sum("delegated").cast(d).alias("delegated_stake"), F.sum("delegators").alias("delegator_count"), F.sum("rewards").cast(d).alias("potential_reward"),
        F.transform(F.sort_array(F.collect_list(F.struct(F.col("stake").cast(d).alias("stake"), "version", "n")), asc=False), lambda v: F.struct(v["version"].alias("version"), v["stake"].alias("stake"), v["n"].alias("validators"))).alias("versions"),
    )
    staked = (F.col("validator_stake") + F.coalesce("delegated_stake", F.lit(0).cast(d))).cast("decimal(20,0)")
    return out.withColumn("staking_ratio", (staked / supply.cast("decimal(20,0)")).cast("decimal(38,20)"))


def snapshot_refresh(make, path: str, keep: int = 2) -> DataFrame:
    """Write make() beside the snapshot at path and switch to it by the next number of its log; on an error the old one stays,
    and of two writers one wins. Older snapshots than the last `keep` are deleted. Returns what readers now see."""
    df = make()
    log, folder = VersionLog(df.sparkSession, f"{path.rstrip('/')}/_versions"), f"data/{uuid.uuid4().hex}"
    number = log.latest()[0] + 1
    df.write.parquet(f"{path.rstrip('/')}/{folder}")
    log.commit(number, {"folder": folder})
    for old in log.versions()[:-keep]:
        log.delete(f"{path.rstrip('/')}/{log.read(old)['folder']}")
        log.forget(old)
    return read_snapshot(df.sparkSession, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version."""
    number, value = VersionLog(spark, f"{path.rstrip('/')}/_versions").latest()
    if not number:
        raise ValueError(f"no snapshot at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{value['folder']}")
