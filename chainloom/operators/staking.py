"""Staking: records, rewards paid and pending, and keys whose answers a batch changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions.rules import progress, split_reward

#: Transactions that start staking, with what they earn; the permissionless ones may be of any subnet.
STAKING_TYPES = {"AddValidatorTx": "VALIDATOR", "AddDelegatorTx": "DELEGATOR", "AddPermissionlessValidatorTx": "VALIDATOR", "AddPermissionlessDelegatorTx": "DELEGATOR"}
REWARD_TX = "RewardValidatorTx"
PRIMARY = "11111111111111111111111111111111LpoYY"
REWARD_KINDS = ("transfer", "stake_lock")


def staking_records(p_txs: DataFrame, primary: str = PRIMARY) -> DataFrame:
    """One row a staking transaction of the primary network: (tx_id, reward_addrs, node_id, stake_amount, start_time,
    end_time, reward_type, block_height). A transaction that occurs twice counts once, as it was last."""
    plain = F.col("tx_type").isin("AddValidatorTx", "AddDelegatorTx")
    rows = p_txs.where(F.col("tx_type").isin(*STAKING_TYPES) & (plain | (F.col("subnet_id") == primary)))
    kind = F.create_map(*(F.lit(v) for kv in STAKING_TYPES.items() for v in kv))[F.col("tx_type")]
    owner = F.when(kind == "VALIDATOR", F.col("validator_owner.addresses")).otherwise(F.coalesce(F.col("delegator_owner.addresses"), F.col("validator_owner.addresses")))
    rest = F.struct(owner.alias("reward_addrs"), "node_id", F.col("weight").alias("stake_amount"), F.col("start_ts").alias("start_time"), F.col("end_ts").alias("end_time"), kind.alias("reward_type"), F.col("height").alias("block_height"))
    return rows.groupBy("tx_id").agg(F.max_by(rest, F.struct("height", "tx_index")).alias("r")).select("tx_id", "r.*")


def complete_staking(records: DataFrame, reward_txs: DataFrame) -> DataFrame:
    """records with completed and reward_tx_id; reward_txs(staking_tx_id, tx_id)."""
    done = reward_txs.groupBy(F.col("staking_tx_id").alias("tx_id")).agg(F.max("tx_id").alias("reward_tx_id"))
    return records.join(done, "tx_id", "left").withColumn("completed", F.col("reward_tx_id").isNotNull())


def match_reward_utxo(records: DataFrame, reward_utxos: DataFrame, all_matches: bool = False) -> DataFrame:
    """records with the first reward output, in list order, that shares an owner: reward_amount, reward_utxo_id,
    output_index; the id is NONE without one. all_matches: every such output, a row each."""
    r = reward_utxos.where(F.col("out.kind").isin(*REWARD_KINDS)).select(F.col("staking_tx_id").alias("_tx"), "position", F.struct(F.col("out.amount").alias("reward_amount"), F.col("utxo_id").alias("reward_utxo_id"), "output_index").alias("o"), F.col("out.addresses").alias("_owners"))
    hits = records.select("tx_id", "reward_addrs").join(r, F.col("tx_id") == F.col("_tx")).where(F.arrays_overlap("reward_addrs", "_owners"))
    chosen = hits.select("tx_id", "o") if all_matches else hits.groupBy("tx_id").agg(F.min_by("o", "position").alias("o"))
    out = records.join(chosen, "tx_id", "left")
    return out.select(*records.columns, "o.reward_amount", F.coalesce("o.reward_utxo_id", F.lit("NONE")).alias("reward_utxo_id"), "o.output_index")


def list_rewards(matched: DataFrame, addresses: list[str] | None = None) -> DataFrame:
    """Completed records with a reward, of any of the addresses if given; order them with reward_order() and page them."""
    rows = matched.where("completed and reward_utxo_id <> 'NONE'")
    return rows if addresses is None else rows.where(F.arrays_overlap("reward_addrs", F.array(*map(F.lit, addresses))))


def reward_order() -> list[Column]:
    return [F.desc("end_time"), F.asc("tx_id")]


def pending_rewards(validators: DataFrame, now: Column, addresses: Column | None = None, nodes: Column | None = None, parity: bool = False) -> DataFrame:
    """Pending rewards of a nested snapshot of validators: (tx_id, node_id, reward_type, addresses, amount, start_time,
    end_time, progress, stake_amount).

    A validator's own reward; each delegator's reward after the validator's fee; that fee, where there is one. Filters: any
    owner in addresses, or the node in nodes (both arrays). parity: delegators only of validators that the addresses own.
    """
    millionths = F.floor(F.col("delegation_fee").cast("decimal(20,10)") * 10000).cast("bigint")
    kinds = "decimal(20,0)"
    mine = validators.select(
        "tx_id", "node_id", F.lit("VALIDATOR").alias("reward_type"), F.col("validation_owner").alias("addresses"), F.col("potential_reward").cast(kinds).alias("amount"),
        F.col("start_time").cast("bigint").alias("start_time"), F.col("end_time").cast("bigint").alias("end_time"), F.col("weight").cast(kinds).alias("stake_amount"),
    )
    each = validators.select("node_id", "validation_owner", "delegation_owner", millionths.alias("shares"), F.explode("delegators").alias("d"))
    if parity and addresses is not None:
        each = each.where(F.arrays_overlap("validation_owner", addresses))
    theirs, fee = split_reward(F.col("d.potential_reward"), F.col("shares"))
    entries = F.array(
        F.struct(F.lit("DELEGATOR").alias("reward_type"), F.col("d.owner").alias("addresses"), theirs.alias("amount")),
        F.struct(F.lit("VALIDATOR_FEE").alias("reward_type"), F.col("delegation_owner").alias("addresses"), fee.alias("amount")),
    )
    split = each.select(F.col("d.tx_id").alias("tx_id"), "node_id", F.col("d.start_time").cast("bigint").alias("start_time"), F.col("d.end_time").cast("bigint").alias("end_time"), F.col("d.weight").cast(kinds).alias("stake_amount"), F.explode(entries).alias("e"))
    split = split.select("tx_id", "node_id", "e.reward_type", "e.addresses", "e.amount", "start_time", "end_time", "stake_amount").where("reward_type = 'DELEGATOR' or amount > 0")
    out = mine.unionByName(split)
    if addresses is not None:
        out = out.where(F.arrays_overlap("addresses", addresses))
    if nodes is not None:
        out = out.where(F.array_contains(nodes, F.col("node_id")))
    return refresh_progress(out, now)


def refresh_progress(entries: DataFrame, now: Column) -> DataFrame:
    """entries with progress as it is at `now`."""
    return entries.withColumn("progress", progress(F.col("start_time"), F.col("end_time"), now))


def pending_order(descending: bool = True) -> list[Column]:
    """By start, then type downwards, then transaction."""
    return [F.desc("start_time") if descending else F.asc("start_time"), F.desc("reward_type"), F.asc("tx_id")]


def staker_keys(p_txs: DataFrame, primary: str = PRIMARY) -> DataFrame:
    """(tx_id, node_id, addrs, height, tx_index) of what starts to stake on the primary network: the node, and whose answers
    change with it; a permissionless validator has two owners."""
    plain = F.col("tx_type").isin("AddValidatorTx", "AddDelegatorTx")
    rows = p_txs.where(F.col("tx_type").isin(*STAKING_TYPES) & (plain | (F.col("subnet_id") == primary)))
    own, other = (F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("validator_owner.addresses", "delegator_owner.addresses"))
    addrs = F.when(F.col("tx_type") == "AddValidatorTx", own).when(F.col("tx_type") == "AddPermissionlessValidatorTx", F.concat(own, other)).otherwise(F.coalesce("delegator_owner.addresses", "validator_owner.addresses", F.array().cast("array<string>")))
    return rows.select("tx_id", "node_id", addrs.alias("addrs"), "height", "tx_index")


def _keys(node: Column, addrs: Column) -> Column:
    return F.concat(F.array(F.struct(F.lit("node").alias("kind"), node.alias("key"))), F.transform(addrs, lambda a: F.struct(F.lit("address").alias("kind"), a.alias("key"))))


def affected_stakers(p_txs: DataFrame, stakers: DataFrame) -> DataFrame:
    """(kind, key): nodes and addresses whose pending answers a batch of transactions changes, by starting or by ending to
    stake; stakers: staker_keys() of all transactions so far, for what ends."""
    begun = staker_keys(p_txs).select("node_id", "addrs")
    ended = p_txs.where(F.col("tx_type") == REWARD_TX).select(F.col("staking_tx_id").alias("tx_id")).join(stakers.select("tx_id", "node_id", "addrs"), "tx_id").select("node_id", "addrs")
    return begun.unionByName(ended).select(F.explode(_keys(F.col("node_id"), F.col("addrs"))).alias("k")).select("k.kind", "k.key").where("key <> ''").distinct()


def compare_rewards(ours: DataFrame, theirs: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(counts by type on both sides, theirs that we lack with the reason): reason is rewarded, ended, pending or active."""
    count = lambda df, n: df.groupBy("reward_type").agg(F.count(F.lit(1)).alias(n))
    counts = count(ours, "ours").join(count(theirs, "theirs"), "reward_type", "full").na.fill(0)
    lost = theirs.join(ours.select("tx_id").distinct(), "tx_id", "left_anti")
    rewarded = F.col("reward_tx_id").isNotNull() if "reward_tx_id" in theirs.columns else F.lit(False)
    reason = F.when(rewarded, "rewarded").when(F.col("end_time") <= now, "ended").when(F.col("start_time") > now, "pending").otherwise("active")
    return counts, lost.withColumn("reason", reason)
