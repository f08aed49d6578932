"""Validators and delegators: registration, links, rewards, removals, status and lists."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions.rules import format_fee
from chainloom.operators.staking import PRIMARY

VALIDATOR_TYPES = ("AddValidatorTx", "AddSubnetValidatorTx", "AddPermissionlessValidatorTx")
DELEGATOR_TYPES = ("AddDelegatorTx", "AddPermissionlessDelegatorTx")


def validators(p_txs: DataFrame, primary: str = PRIMARY) -> DataFrame:
    """Registrations: the fee as a percentage text, and the BLS key where there is a proof, on the primary network only."""
    subnet = F.when(F.col("tx_type") == "AddValidatorTx", primary).otherwise(F.col("subnet_id"))
    bls = F.when((subnet == primary) & F.col("bls.proof").isNotNull(), F.col("bls"))
    return p_txs.where(F.col("tx_type").isin(*VALIDATOR_TYPES)).select(
        F.col("tx_id").alias("tx_hash"), "node_id", subnet.alias("subnet_id"), F.col("weight").alias("amount"), format_fee(F.col("delegation_shares")).alias("fee"), F.col("start_ts").alias("start"), F.col("end_ts").alias("end"),
        bls.alias("bls"), F.col("validator_owner").alias("validation_owner"), F.col("delegator_owner").alias("delegation_owner"), "height", *(["block_ts"] if "block_ts" in p_txs.columns else []),
    )


def delegators(p_txs: DataFrame, primary: str = PRIMARY) -> DataFrame:
    subnet = F.when(F.col("tx_type") == "AddDelegatorTx", primary).otherwise(F.coalesce("subnet_id", F.lit(primary)))
    return p_txs.where(F.col("tx_type").isin(*DELEGATOR_TYPES)).select(F.col("tx_id").alias("tx_hash"), "node_id", subnet.alias("subnet_id"), F.col("weight").alias("amount"), F.col("start_ts").alias("start"), F.col("end_ts").alias("end"), F.col("delegator_owner").alias("owner"), "height")


def link_delegators(dels: DataFrame, vals: DataFrame, keys: tuple[str, ...] = ("node_id", "subnet_id"), start: str = "start", end: str = "end", id_col: str = "tx_hash", bucket: int | None = 100 * 86_400) -> DataFrame:
    """dels with validator_tx: the first validator, by start then id, of the same keys whose interval has the delegator's
    start; null without one. bucket: width of the time buckets by which keys with many terms are spread, None for none."""
    v = vals.select(*keys, F.col(start).alias("v_start"), F.col(end).alias("v_end"), F.col(id_col).alias("validator_tx"))
    d, on = dels.select(*keys, id_col, start).distinct(), list(keys)
    if bucket:
        d = d.withColumn("_b", F.floor(F.col(start) / bucket))
        v = v.where("v_end >= v_start").withColumn("_b", F.explode(F.sequence(F.floor(F.col("v_start") / bucket), F.floor(F.col("v_end") / bucket))))
        on.append("_b")
    hit = d.join(v, on).where(F.col(start).between(F.col("v_start"), F.col("v_end")))
    first = hit.groupBy(*keys, id_col, start).agg(F.min(F.struct("v_start", "validator_tx")).alias("v"))
    return dels.join(first.select(*keys, id_col, start, F.col("v.validator_tx").alias("validator_tx")), [*keys, id_col, start], "left")


def apply_rewards(vals: DataFrame, reward_txs: DataFrame, reward_utxos: DataFrame) -> DataFrame:
    """vals with reward_tx and validation_reward, the sum of the plain transfers among the reward's outputs."""
    paid = reward_utxos.groupBy(F.col("staking_tx_id").alias("tx_hash")).agg(F.sum(F.when(F.col("out.kind") == "transfer", F.col("out.amount"))).alias("validation_reward"))
    txs = reward_txs.groupBy(F.col("staking_tx_id").alias("tx_hash")).agg(F.max("tx_id").alias("reward_tx"))
    return vals.join(txs, "tx_hash", "left").join(paid, "tx_hash", "left")


def complete_delegators(dels: DataFrame, reward_txs: DataFrame) -> DataFrame:
    txs = reward_txs.groupBy(F.col("staking_tx_id").alias("tx_hash")).agg(F.max("tx_id").alias("reward_tx"))
    return dels.join(txs, "tx_hash", "left").withColumn("completed", F.col("reward_tx").isNotNull())


def apply_removals(vals: DataFrame, removals: DataFrame, registered: str = "block_ts") -> DataFrame:
    """vals with remove_tx and remove_ts; removals(tx_id, node_id, subnet_id, ts).

    A removal takes, of its node and subnet, the earliest start (then id) among the registrations of blocks up to its own that
    are neither removed nor rewarded by then; the term need not have begun. One that finds none takes nothing. vals has the
    registration's block time in `registered`; without that column all are known from the beginning. A reward counts from vals'
    reward_ts, or from the start if it only has reward_tx. The rule goes by time, so the events of a node and subnet pass through
    one task in order; it keeps those that are open.
    """
    keys = ["node_id", "subnet_id"]
    kinds = {k: vals.schema[k].dataType.simpleString() for k in (*keys, "tx_hash")}
    until = F.col("reward_ts").cast("bigint") if "reward_ts" in vals.columns else F.when(F.col("reward_tx").isNotNull(), F.col("start").cast("bigint")) if "reward_tx" in vals.columns else F.lit(None).cast("bigint")
    known = F.col(registered).cast("bigint") if registered in vals.columns else F.lit(-(1 << 63)).cast("bigint")
    terms = vals.select(*keys, known.alias("ts"), F.lit(0).alias("is_removal"), F.col("tx_hash").cast("string").alias("id"), until.alias("until"), F.col("start").cast("bigint").alias("start"))
    ends = removals.select(*keys, F.col("ts").cast("bigint").alias("ts"), F.lit(1).alias("is_removal"), F.col("tx_id").cast("string").alias("id"), F.lit(None).cast("bigint").alias("until"), F.lit(None).cast("bigint").alias("start"))
    events = terms.unionByName(ends).repartition(*keys).sortWithinPartitions(*keys, "ts", "is_removal", "id")

    def play(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting = None, []
        for b in batches:
            taken = []
            for node, subnet, ts, is_removal, name, end, start in zip(*(b.column(c).to_pylist() for c in (*keys, "ts", "is_removal", "id", "until", "start"))):
                if (node, subnet) != at:
                    at, waiting = (node, subnet), []
                if not is_removal:
                    heapq.heappush(waiting, (start is not None, start or 0, name, end))
                    continue
                while waiting and waiting[0][3] is not None and waiting[0][3] <= ts:
                    heapq.heappop(waiting)
                if waiting:
                    taken.append((heapq.heappop(waiting)[2], name, ts))
            if taken:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*taken)], names=["tx_hash", "remove_tx", "remove_ts"])

    matched = events.mapInArrow(play, "tx_hash string, remove_tx string, remove_ts bigint").withColumn("tx_hash", F.col("tx_hash").cast(kinds["tx_hash"]))
    return vals.join(matched, "tx_hash", "left")


def validation_status(now: Column, removed: Column, rewarded: Column, start: Column, end: Column) -> Column:
    """removed, then completed by a reward, then pending, active, or completed by time."""
    return F.when(removed, "removed").when(rewarded, "completed").when(start > now, "pending").when(end > now, "active").otherwise("completed")


def delegator_totals(vals: DataFrame, dels: DataFrame, now: Column, id_col: str = "tx_hash") -> DataFrame:
    """vals with delegator_count and delegated_amount of the delegators that are active and not completed; 0 without any."""
    active = dels.where(~F.coalesce("completed", F.lit(False)) & (F.col("start") <= now) & (F.col("end") > now))
    sums = active.groupBy(F.col("validator_tx").alias(id_col)).agg(F.count(F.lit(1)).alias("delegator_count"), F.sum("amount").alias("delegated_amount"))
    return vals.join(sums, id_col, "left").withColumns({"delegator_count": F.coalesce("delegator_count", F.lit(0).cast("bigint")), "delegated_amount": F.coalesce("delegated_amount", F.lit(0))})


def list_validators(vals: DataFrame, subnet: str | None = None, nodes: list[str] | None = None, status: str | None = None) -> DataFrame:
    """Validators of a subnet, or of nodes where no subnet is named, with a status; order with list_order() and page them."""
    out = vals.where(F.col("subnet_id") == subnet) if subnet is not None else vals.where(F.col("node_id").isin(nodes)) if nodes else vals
    return out if status is None else out.where(F.col("validation_status") == status)


def validators_of_node(vals: DataFrame, node: str, limit: int = 100) -> DataFrame:
    return vals.where(F.col("node_id") == node).orderBy(*list_order()).limit(min(max(limit, 1), 100))


def list_order() -> list[Column]:
    """Newest first within a subnet."""
    return [F.desc("subnet_id"), F.desc("start"), F.desc("tx_hash")]


def validator_response(vals: DataFrame) -> DataFrame:
    """(tx_hash, response): JSON whose fields depend on the status."""
    s = F.col("validation_status")
    has = lambda c: F.col(c) if c in vals.columns else F.lit(None).cast("string")
    live = s.isin("active", "pending")
    return vals.select("tx_hash", F.to_json(F.struct(
        F.col("tx_hash").alias("txHash"), F.col("node_id").alias("nodeId"), F.col("subnet_id").alias("subnetId"), F.col("amount").cast("string").alias("amountStaked"), F.col("fee").alias("delegationFee"), F.col("start").alias("startTimestamp"), F.col("end").alias("endTimestamp"), s.alias("validationStatus"),
        F.when(live, has("delegator_count").cast("bigint")).alias("delegatorCount"), F.when(live, has("delegated_amount").cast("string")).alias("amountDelegated"), F.when(s == "active", has("potential_reward").cast("string")).alias("potentialRewards"),
        F.when(s == "completed", has("validation_reward").cast("string")).alias("rewards"), F.when(s == "completed", has("reward_tx")).alias("rewardTxHash"), F.when(s == "removed", has("remove_tx")).alias("removeTxHash"), F.when(s == "removed", has("remove_ts").cast("bigint")).alias("removeTimestamp"),
    )).alias("response"))
