"""The UTXO ledger: outputs and spends of the three chains as append-only facts, and the tables derived from them.

Inputs are the typed transaction tables; arrays of structs hold their inputs and outputs. Nothing is updated in place: an
output, its spend and its later attributes stay facts, and a derived row is a join or an aggregate over them, so that the
result does not depend on how the input was cut into batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions.rules import rfc3339
from chainloom.sources.schemas import OUT

P, X, C = "p", "x", "c"
#: Labels of P transactions that make or spend outputs (advancing time does neither).
P_TX_TYPES = (
    "AddValidatorTx", "AddDelegatorTx", "AddSubnetValidatorTx", "AddPermissionlessValidatorTx", "AddPermissionlessDelegatorTx", "RemoveSubnetValidatorTx", "CreateSubnetTx", "CreateChainTx", "TransformSubnetTx", "TransferSubnetOwnershipTx", "ConvertSubnetToL1Tx",
    "RegisterL1ValidatorTx", "SetL1ValidatorWeightTx", "IncreaseL1ValidatorBalanceTx", "DisableL1ValidatorTx", "RewardValidatorTx", "ImportTx", "ExportTx", "BaseTx",
)
#: Kinds of output with their family and label; other kinds are dropped.
OUTPUT_KINDS = {
    "transfer": ("secp256k1fx", "TRANSFER"),
    "stake_lock": ("secp256k1fx", "STAKEABLE_LOCK"),
    "nft_transfer": ("nftfx", "NFT_TRANSFER"),
    "nft_mint": ("nftfx", "NFT_MINT"),
    "property_owned": ("propertyfx", "PROPERTY_OWNED"),
    "property_mint": ("propertyfx", "PROPERTY_MINT"),
}
#: Fixed value: start of the Apricot phase from which a block has a batch of atomic transactions, on the main network.
BATCH_ATOMIC_FROM = 1638468000


def _outs(c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast(f"array<{OUT}>"))


def _tagged(parts: list[tuple[Column, str, Column, bool]]) -> Column:
    """One array over several lists of outputs, numbered through: list, role, chain where it is used up, staked."""

    def numbered(outs: Column, role: str, consumed_on: Column, staked: bool, offset: Column) -> Column:
        return F.transform(outs, lambda o, i: F.struct((offset + i).cast("bigint").alias("output_index"), o.alias("o"), F.lit(role).alias("role"), consumed_on.alias("consumed_on"), F.lit(staked).alias("staked")))

    lists, offset = [], F.lit(0)
    for part in parts:
        lists.append(numbered(*part, offset))
        offset = offset + F.size(part[0])
    return F.concat(*lists)


def classify_output(df: DataFrame, out_col: str = "o") -> DataFrame:
    """fx_id, utxo_type, amount, threshold, locktimes, group and payload by the kind of output; kinds that are not known and
    outputs without an owner are dropped."""
    o, kind = F.col(out_col), F.col(f"{out_col}.kind")
    pick = lambda i: F.create_map(*(F.lit(v) for k, x in OUTPUT_KINDS.items() for v in (k, x[i])))[kind]
    known = df.where(kind.isin(*OUTPUT_KINDS) & (F.coalesce(F.size(o["addresses"]), F.lit(0)) > 0))
    locked = kind == "stake_lock"
    return known.select(
        *(c for c in df.columns if c != out_col),
        o["utxo_id"].alias("utxo_id"), o["asset_id"].alias("asset_id"), F.coalesce(o["amount"], F.lit(0)).cast("decimal(20,0)").alias("amount"), o["addresses"].alias("addresses"), o["threshold"].alias("threshold"),
        pick(0).alias("fx_id"), pick(1).alias("utxo_type"), F.when(~locked, o["locktime"]).alias("platform_locktime"), F.when(locked, o["locktime"]).alias("stakeable_locktime"),
        F.when(kind.isin("nft_transfer", "nft_mint"), o["group_id"]).alias("group_id"), F.when(kind.isin("nft_transfer"), o["payload"]).alias("payload"), o["utxo_bytes"].alias("utxo_bytes"),
    )


def p_outputs(p_txs: DataFrame) -> DataFrame:
    """Outputs of P transactions: the plain ones from 0, stakes after them, exported ones after both."""
    own = F.lit(P)
    each = _tagged([(_outs("outs"), "out", own, False), (_outs("stake_outs"), "stake", own, True), (_outs("exported_outs"), "export", F.coalesce("dest_chain", own), False)])
    keep = [c for c in ("network", "height", "block_ts", "tx_index", "tx_id", "tx_type", "start_ts", "end_ts", "node_id", "validator_owner") if c in p_txs.columns]
    rows = p_txs.where(F.col("tx_type").isin(*P_TX_TYPES)).select(*keep, F.explode(each).alias("x")).select(*keep, F.lit(P).alias("created_on"), "x.*")
    return classify_output(rows)


def x_outputs(x_txs: DataFrame) -> DataFrame:
    """Outputs of X transactions: plain ones, then those of initial states or operations, then exported ones. Outputs of
    initial states are of the asset that the transaction creates."""
    own = F.lit(X)
    states = F.coalesce(F.flatten("states"), F.array().cast(f"array<{OUT}>"))
    fields = [f.split(":")[0] for f in OUT.removeprefix("struct<").removesuffix(">").replace("decimal(20,0)", "decimal").split(",")]
    states = F.transform(states, lambda o: F.struct(*(F.col("tx_id").alias(f) if f == "asset_id" else o[f].alias(f) for f in fields)).cast(OUT))
    ops = F.coalesce(F.flatten(F.transform("ops", lambda p: p["outs"])), F.array().cast(f"array<{OUT}>"))
    each = _tagged([(_outs("outs"), "out", own, False), (states, "state", own, False), (ops, "operation", own, False), (_outs("exported_outs"), "export", F.coalesce("dest_chain", own), False)])
    keep = [c for c in ("network", "era", "idx", "height", "ts", "tx_id", "tx_type", "credentials") if c in x_txs.columns]
    return classify_output(x_txs.select(*keep, F.explode(each).alias("x")).select(*keep, F.lit(X).alias("created_on"), "x.*"))


def c_outputs(c_atomic: DataFrame, only_p: bool = True) -> DataFrame:
    """Exported outputs of C's atomic transactions, numbered from 0; to P alone unless only_p is unset."""
    rows = c_atomic.where(F.col("kind") == "export")
    rows = rows.where(F.col("dest_chain") == P) if only_p else rows
    each = _tagged([(_outs("exported_outs"), "export", F.coalesce("dest_chain", F.lit(P)), False)])
    keep = [c for c in ("network", "height", "ts", "tx_id", "credentials") if c in c_atomic.columns]
    return classify_output(rows.select(*keep, F.explode(each).alias("x")).select(*keep, F.lit(C).alias("created_on"), "x.*"))


def fan_out_chains(outputs: DataFrame) -> DataFrame:
    """One row for each chain that stores an output: the one that made it and the one that may use it. X has types in
    lower case."""
    rows = outputs.withColumn("store_chain", F.explode(F.array_distinct(F.array("created_on", "consumed_on"))))
    return rows.withColumn("utxo_type", F.when(F.col("store_chain") == X, F.lower("utxo_type")).otherwise(F.col("utxo_type")))


def staking_attributes(outputs: DataFrame) -> DataFrame:
    """stake_start and stake_end of stakes; a start of 0 or none is the block's time. Others have nulls."""
    start = F.coalesce(F.nullif("start_ts", F.lit(0).cast("bigint")), F.col("block_ts"))
    owners = F.col("validator_owner.addresses") if "validator_owner" in outputs.columns else F.lit(None).cast("array<string>")
    return outputs.select(*(c for c in outputs.columns if c != "validator_owner"), F.when(F.col("staked"), start).alias("stake_start"), F.when(F.col("staked"), F.col("end_ts")).alias("stake_end"), F.when(F.col("staked"), owners).alias("reward_addresses"))


def reward_outputs(p_txs: DataFrame, reward_utxos: DataFrame) -> DataFrame:
    """New unstaked outputs of reward transactions, flagged is_reward; what was staked is not used up by them."""
    txs = p_txs.where(F.col("tx_type") == "RewardValidatorTx").select("staking_tx_id", "tx_id", "tx_type", "height", "block_ts")
    rows = txs.join(reward_utxos.select("staking_tx_id", "position", "output_index", F.col("out").alias("o")), "staking_tx_id")
    return classify_output(rows.withColumns({"created_on": F.lit(P), "consumed_on": F.lit(P), "staked": F.lit(False), "is_reward": F.lit(True)}))


def spends(txs: DataFrame, chain: str, order: tuple[str, ...] = ("ts", "height", "tx_index")) -> DataFrame:
    """(store_chain, utxo_id, consuming_tx, consuming_ts, consuming_block, credentials, order_key) of the inputs used on their
    own chain; X's operations name further outputs."""
    ids = F.transform(F.coalesce("ins", F.array().cast("array<struct<utxo_id:string,amount:decimal(20,0)>>")), lambda i: i["utxo_id"])
    if "ops" in txs.columns:
        ids = F.concat(ids, F.coalesce(F.flatten(F.transform("ops", lambda p: p["utxo_ids"])), F.array().cast("array<string>")))
    return _spend_rows(txs, F.lit(chain), ids, order)


def import_spends(txs: DataFrame, chain: str, order: tuple[str, ...] = ("ts", "height", "tx_index")) -> DataFrame:
    """Imported inputs as spends on the importing chain and on the one that they come from, with both chains named."""
    ids = F.transform(F.coalesce("imported_ins", F.array().cast("array<struct<utxo_id:string,amount:decimal(20,0)>>")), lambda i: i["utxo_id"])
    both = txs.withColumn("store_chain", F.explode(F.array_distinct(F.array(F.lit(chain), F.coalesce("source_chain", F.lit(chain))))))
    rows = _spend_rows(both, F.col("store_chain"), ids, order, F.lit(chain), F.col("source_chain"))
    return rows


def _spend_rows(txs: DataFrame, store: Column, ids: Column, order: tuple[str, ...], consumed_on: Column | None = None, created_on: Column | None = None) -> DataFrame:
    has = lambda c, kind: F.col(c) if c in txs.columns else F.lit(None).cast(kind)
    ts = has("ts", "bigint") if "ts" in txs.columns else has("block_ts", "bigint")
    key = F.struct(*(F.coalesce((ts if c == "ts" else has(c, "bigint")).cast("bigint"), F.lit(0).cast("bigint")).alias(c) for c in order), F.col("tx_id").alias("tx_id"))
    none = F.lit(None).cast("string")
    return txs.select(
        store.alias("store_chain"), F.explode(F.array_distinct(ids)).alias("utxo_id"), F.col("tx_id").alias("consuming_tx"), ts.alias("consuming_ts"), has("height", "bigint").cast("string").alias("consuming_block"),
        has("credentials", "array<struct<public_key:string,signature:string>>").alias("credentials"), (none if consumed_on is None else consumed_on).alias("consumed_on"), (none if created_on is None else created_on).alias("created_on"), key.alias("order_key"),
    )


def latest_spend(spend_rows: DataFrame, keys: tuple[str, ...] = ("store_chain", "utxo_id"), order: str = "order_key") -> DataFrame:
    """One row for each key: the last by the order column, which must order a key's rows totally."""
    rest = [c for c in spend_rows.columns if c not in keys]
    return spend_rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("s")).select(*keys, "s.*")


def upsert_merge(updates: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """Column by column the latest value that is not null: what repeated upserts would leave."""
    rest = [c for c in updates.columns if c not in (*keys, order)]
    return updates.groupBy(*keys).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest))


def merge_spend(utxos: DataFrame, spend_rows: DataFrame, keys: tuple[str, ...] = ("store_chain", "utxo_id")) -> DataFrame:
    """utxos with what is known of their spends; block, credentials and chains override only where they are given."""
    s = spend_rows.select(*keys, *(F.col(c).alias(f"_{c}") for c in spend_rows.columns if c not in (*keys, "order_key")))
    out = utxos.join(s, list(keys), "left")
    for c in (c for c in spend_rows.columns if c not in (*keys, "order_key")):
        new = F.nullif(f"_{c}", F.lit("")) if dict(spend_rows.dtypes)[c] == "string" else F.when(F.size(f"_{c}") > 0, F.col(f"_{c}")) if dict(spend_rows.dtypes)[c].startswith("array") else F.col(f"_{c}")
        out = out.withColumn(c, F.coalesce(new, F.col(c)) if c in utxos.columns else new).drop(f"_{c}")
    return out


def staking_outputs_map(outputs: DataFrame, p_txs: DataFrame) -> DataFrame:
    """(tx_id, utxo_ids) of stakes whose transaction has not been rewarded."""
    done = p_txs.where(F.col("tx_type") == "RewardValidatorTx").select(F.col("staking_tx_id").alias("tx_id"))
    return outputs.where("staked").join(done, "tx_id", "left_anti").groupBy("tx_id").agg(F.sort_array(F.collect_list("utxo_id")).alias("utxo_ids"))


def atomic_blocks(c_blocks: DataFrame, batch_from: int = BATCH_ATOMIC_FROM) -> DataFrame:
    """Blocks with extra data, with is_batch: whether it holds a batch of atomic transactions or one."""
    return c_blocks.where(F.length("extra_data") > 0).withColumn("is_batch", F.col("ts") >= batch_from)


def address_index(utxos: DataFrame) -> DataFrame:
    """(store_chain, address, utxo_id), a row for each owner. Write it clustered by address for lookups."""
    # Outputs are moved with their owners together; what repeats has one id, so it is in one task.
    rows = utxos.select("store_chain", "addresses", "utxo_id").repartition("utxo_id")
    return rows.select("store_chain", F.explode(F.array_distinct("addresses")).alias("address"), "utxo_id").distinct()


def asset_metadata(x_txs: DataFrame) -> DataFrame:
    rows = x_txs.where(F.col("tx_type") == "CreateAssetTx")
    return rows.select(F.col("tx_id").alias("asset_id"), F.col("asset_name").alias("name"), F.col("asset_symbol").alias("symbol"), F.col("asset_denomination").alias("denomination"))


def derive_utxos(outputs: DataFrame, spend_rows: DataFrame) -> DataFrame:
    """The UTXO table: outputs fanned out to their chains, with the latest spend of each."""
    return merge_spend(fan_out_chains(outputs), latest_spend(spend_rows))


def utxo_history(outputs: DataFrame, spend_rows: DataFrame, txs: DataFrame, address: str) -> DataFrame:
    """All that one address ever received and spent, and imports of transactions that pay it: (utxo_id, tx_id, event, amount).

    Only the address's own outputs, and the transactions that pay it, reach the joins.
    """
    own = outputs.where(F.array_contains("addresses", address))
    made = own.select("utxo_id", "tx_id", F.lit("created").alias("event"), "amount")
    used = spend_rows.join(own.select("utxo_id", "amount").dropDuplicates(["utxo_id"]), "utxo_id").select("utxo_id", F.col("consuming_tx").alias("tx_id"), F.lit("consumed").alias("event"), "amount")
    if "imported_ins" not in txs.columns:
        return made.unionByName(used).distinct()
    paid = own.select("tx_id").distinct()
    inputs = txs.join(paid, "tx_id", "left_semi").select("tx_id", F.explode("imported_ins").alias("i"))
    imported = inputs.select("i.utxo_id", "tx_id", F.lit("imported").alias("event"), "i.amount")
    return made.unionByName(used).unionByName(imported).distinct()


#: Columns of the warehouse's row, in order, with the UTXO table's column that each one shows.
EXPORT_COLUMNS = {
    "UTXO_ID": "utxo_id", "TRANSACTION_HASH": "tx_hash", "BLOCK_INDEX": "block_number", "OUTPUT_INDEX": "output_index", "TIMESTAMP": "block_timestamp", "TX_TYPE": "tx_type", "OUTPUT_TYPE": "utxo_type", "ADDRESS": "addresses", "CONSUMING_TRANSACTION_HASH": "consuming_tx",
    "ASSET_ID": "asset_id", "LOCKTIME": "platform_locktime", "THRESHOLD": "threshold", "PUBLIC_KEY": "credentials", "SIGNATURE": "credentials", "AMOUNT": "amount", "GROUP_ID": "group_id", "PAYLOAD": "payload", "FX_ID": "fx_id", "CREATED_ON": "created_on", "CONSUMED_ON": "consumed_on",
    "PLATFORM_LOCKTIME": "platform_locktime", "STAKED": "staked", "STAKEABLE_LOCKTIME": "stakeable_locktime", "REWARD": "is_reward", "LAST_UPDATED": "last_updated", "CONSUMING_TRANSACTION_TIMESTAMP": "consuming_ts", "STAKING_START_TIME": "stake_start", "STAKING_END_TIME": "stake_end",
    "NODE_ID": "node_id", "REWARD_ADDRESSES": "reward_addresses", "CONSUMING_BLOCK_HEIGHT": "consuming_block",
}
EXPORT_TIMES = ("TIMESTAMP", "LAST_UPDATED", "CONSUMING_TRANSACTION_TIMESTAMP", "STAKING_START_TIME", "STAKING_END_TIME", "PLATFORM_LOCKTIME", "STAKEABLE_LOCKTIME")
#: Those that are empty if they are not above zero, and the last second that such a text can show.
POSITIVE_TIMES, LAST_SECOND = ("TIMESTAMP", "LAST_UPDATED"), 253_402_300_799


def utxo_export_row(utxos: DataFrame) -> DataFrame:
    """The warehouse's 31 columns: first owner and first credential, times as text (LOCKTIME as a number), reward addresses as JSON
    where there are any; columns that utxos lacks are null, and times empty, as are those after the year 9999."""
    kinds = dict(utxos.dtypes)

    def shown(name: str, source: str) -> Column:
        has = source in kinds
        if name in EXPORT_TIMES:
            at = (F.col(source) if has else F.lit(None)).cast("decimal(20,0)")
            shown_at = F.when(at.between(1, LAST_SECOND), at.cast("bigint"))
            # A time of zero is shown where it is one: a lock that was never set has none.
            return rfc3339(shown_at) if name in POSITIVE_TIMES else F.when(at == 0, "1970-01-01T00:00:00Z").otherwise(rfc3339(shown_at))
        if not has:
            return F.lit(None).cast("string")
        if name in ("PUBLIC_KEY", "SIGNATURE"):
            return F.get(source, F.lit(0))[name.lower()]
        if name == "ADDRESS":
            return F.get(source, F.lit(0))
        return F.when(F.size(source) > 0, F.to_json(source)) if name == "REWARD_ADDRESSES" else F.col(source)

    return utxos.select(*(shown(*x).alias(x[0].lower()) for x in EXPORT_COLUMNS.items()))
