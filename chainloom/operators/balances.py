"""Queries over the UTXO table: whose, unspent when, worth what, by page, and balances by category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PAGE_DEFAULT, PAGE_MOST = 10, 100
#: P's balance categories. A locked output that is neither stakeable nor platform locked is the ninth.
P_CATEGORIES = ("unlockedUnstaked", "unlockedStaked", "lockedPlatform", "lockedStakeable", "lockedStaked", "pendingStaked", "atomicMemoryUnlocked", "atomicMemoryLocked", "lockedNotStakeable")
X_CATEGORIES = ("unlocked", "locked", "atomicMemoryUnlocked", "atomicMemoryLocked")
C_CATEGORIES = ("atomicMemoryUnlocked", "atomicMemoryLocked")
PENDING_EXPORT = "pendingExport"
#: Known owners of a transaction, or what else is a home, that each of its rows is compared with; where there are more, rows go to their owners.
HOME_OWNERS = 1024


def utxos_for_addresses(utxos: DataFrame, addresses: DataFrame, key: str = "utxo_id", owners: str = "addresses") -> DataFrame:
    """Rows that any of addresses(address) owns, each once. The address table may be of any size: keys are joined, and rows
    with several owners in it come back once."""
    hit = utxos.select(key, F.explode(owners).alias("address")).join(addresses.select("address").distinct(), "address", "left_semi").select(key).distinct()
    return utxos.join(hit, key, "left_semi")


def spendable_by(utxos: DataFrame, addresses: DataFrame, key: str = "utxo_id", owners: str = "addresses", threshold: str = "threshold", home: str | None = None, owned: DataFrame | None = None) -> DataFrame:
    """Rows of which at least `threshold` different owners are in addresses(address). Rows of one key count together: the owners
    of all, against the greatest threshold of those that have such an owner.

    home is a column whose value is the same in all rows of a key and never null, as the transaction of an output. Owners are
    then looked up by home, where the rows stay, so that long keys are not moved; only rows of homes with over HOME_OWNERS owners
    in addresses are. owned has, as (home, address), at least the owners of utxos, where they can be had without making the
    rows a second time.
    """
    asked = addresses.select("address").distinct()
    if home is None:
        each = utxos.select("*", F.posexplode_outer(F.array_distinct(owners)).alias("_at", "_owner")).join(asked.select(F.col("address").alias("_asked")), F.col("_owner") == F.col("_asked"), "left")
        counted = each.withColumn("_hits", F.when(F.col(key).isNotNull() & F.col("_asked").isNotNull(), F.array("_owner")))
        return _enough(counted, [key], threshold).where("coalesce(_at, 0) = 0").select(key, *(c for c in utxos.columns if c != key))
    owned = utxos.select(home, F.explode(owners).alias("address")) if owned is None else owned.select(home, "address")
    # Moved before they are collected: lists of one or two owners would be larger than the rows.
    known = owned.join(asked, "address", "left_semi").repartition(home).groupBy(home).agg(F.collect_set("address").alias("_known"))
    crowded = F.size("_known") > HOME_OWNERS
    counted = utxos.join(known.where(~crowded), home).withColumn("_hits", F.when(F.col(key).isNotNull(), F.array_intersect(owners, "_known")))
    out = _enough(counted, [home, key], threshold).select(key, *(c for c in utxos.columns if c != key))
    return out.unionByName(spendable_by(utxos.join(known.where(crowded).select(home), home, "left_semi"), addresses, key, owners, threshold))


def _enough(rows: DataFrame, by: list[str], threshold: str) -> DataFrame:
    """Rows whose group's `_hits` have together as many different owners as the greatest threshold among those with any."""
    group = Window.partitionBy(*by)
    n = F.size(F.array_distinct(F.flatten(F.collect_list("_hits").over(group))))
    return rows.withColumns({"_n": n, "_t": F.max(F.when(F.size("_hits") > 0, F.col(threshold))).over(group)}).where("_n >= _t")


def filter_unspent(utxos: DataFrame, now: Column, include_spent: bool = False, include_active_staked: bool = True) -> DataFrame:
    """Rows without a spend; spent ones too if asked for, and spent stakes that have not ended."""
    keep = F.col("consuming_tx").isNull() | F.lit(include_spent)
    if include_active_staked:
        keep = keep | (F.coalesce("staked", F.lit(False)) & (F.col("stake_end") > now))
    return utxos.where(keep)


def as_of(utxos: DataFrame, ts: Column, created: str = "created_ts", consumed: str = "consuming_ts", inclusive: bool = False) -> DataFrame:
    """Rows that stood at ts: made before it (or at it, if inclusive) and not used up by then."""
    made = F.col(created) <= ts if inclusive else F.col(created) < ts
    return utxos.where(made & ~F.coalesce(F.col(consumed) <= ts, F.lit(False)))


def filter_asset(utxos: DataFrame, asset_id, col: str = "asset_id") -> DataFrame:
    return utxos.where(F.col(col) == asset_id)


def filter_min_amount(utxos: DataFrame, least: int, col: str = "amount") -> DataFrame:
    return utxos.where(F.col(col) >= F.lit(least).cast("decimal(20,0)"))


def sort_order(by: str = "timestamp", descending: bool = True, ts: str = "created_ts", amount: str = "amount", key: str = "utxo_id") -> list[Column]:
    """Columns to sort by: time, amount or id, ties by id in the same direction; nulls last."""
    columns = {"timestamp": [ts, key], "amount": [amount, key], "id": [key]}[by]
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in columns]


def page_token(offset: Column) -> Column:
    return F.base64(offset.cast("string").cast("binary"))


def page_offset(token: str | None) -> int:
    import base64

    return int(base64.b64decode(token)) if token else 0


def paginate(df: DataFrame, order: list[Column], size: int = PAGE_DEFAULT, token: str | None = None) -> DataFrame:
    """A page with `position` (from 1) and `next_token`, null on the last page. Top rows are found by each task first."""
    size, start = min(max(size, 1), PAGE_MOST), page_offset(token)
    rows = df.orderBy(*order).limit(start + size + 1)
    numbered = rows.withColumn("position", F.row_number().over(Window.orderBy(*order))).where(F.col("position") > start)
    more = F.max("position").over(Window.partitionBy()) > start + size
    return numbered.withColumn("next_token", F.when(more, page_token(F.lit(start + size)))).where(F.col("position") <= start + size)


def with_asset_info(df: DataFrame, assets: DataFrame, native: DataFrame | None = None, asset: str = "asset_id") -> DataFrame:
    """name, symbol and denomination of each row's asset; those of the native assets first, `Unknown` for unknown ones."""
    info = assets.select(F.col("asset_id").alias(asset), "name", "symbol", "denomination").dropDuplicates([asset])
    if native is not None:
        info = native.select(F.col("asset_id").alias(asset), "name", "symbol", "denomination").unionByName(info.join(native.select(F.col("asset_id").alias(asset)), asset, "left_anti"))
    out = df.join(info, asset, "left")
    return out.withColumns({"name": F.coalesce("name", F.lit("Unknown")), "symbol": F.coalesce("symbol", F.lit("???")), "denomination": F.coalesce("denomination", F.lit(0))})


def p_category(now: Column) -> Column:
    """The category of an output on P. An output without a chain that uses it up is not atomic; a stake without an end has not
    ended, and an ended one is locked as it was or plainly free."""
    locked_until = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)") > now
    platform, stakeable = locked_until("platform_locktime"), locked_until("stakeable_locktime")
    atomic, staked = ~F.coalesce("consumed_on", F.lit("")).isin("p", ""), F.coalesce("staked", F.lit(False))
    ended, pending = F.coalesce(F.col("stake_end") <= now, F.lit(False)), F.coalesce(F.col("stake_start") > now, F.lit(False))
    locked = platform | stakeable
    return (
        F.when(atomic & locked, "atomicMemoryLocked")
        .when(atomic, "atomicMemoryUnlocked")
        .when(staked & ended & locked, "lockedNotStakeable")
        .when(staked & ended, "unlockedUnstaked")
        .when(staked & pending, "pendingStaked")
        .when(staked & locked, "lockedStaked")
        .when(staked, "unlockedStaked")
        .when(stakeable, "lockedStakeable")
        .when(platform, "lockedPlatform")
        .otherwise("unlockedUnstaked")
    )


def x_category(now: Column) -> Column:
    atomic, locked = ~F.coalesce("consumed_on", F.lit("")).isin("x", ""), F.coalesce(F.col("platform_locktime"), F.lit(0)).cast("decimal(20,0)") > now
    return F.when(atomic & locked, "atomicMemoryLocked").when(atomic, "atomicMemoryUnlocked").when(locked, "locked").otherwise("unlocked")


def c_category(now: Column) -> Column:
    locked = F.coalesce(F.col("platform_locktime"), F.lit(0)).cast("decimal(20,0)") > now
    return F.when(locked, "atomicMemoryLocked").otherwise("atomicMemoryUnlocked")


def balances(utxos: DataFrame, category: Column, asset: str = "asset_id", amount: str = "amount", shared_chain: Column | None = None, drop_zero: bool = True) -> DataFrame:
    """(category, asset, total, n, shared_chain, status): sums and counts by category and asset.

    Atomic sums name the other chain (the smallest, where there are several) and are pending export. Zero sums are dropped
    on P and X, not on C.
    """
    shared = F.lit(None).cast("string") if shared_chain is None else shared_chain
    rows = utxos.select(category.alias("category"), F.col(asset), F.col(amount).cast("decimal(20,0)").alias("a"), shared.alias("s"))
    out = rows.groupBy("category", asset).agg(F.sum("a").alias("total"), F.count(F.lit(1)).alias("n"), F.min("s").alias("shared_chain"))
    out = out.withColumn("status", F.when(F.col("category").startswith("atomic"), PENDING_EXPORT))
    out = out.withColumn("shared_chain", F.when(F.col("category").startswith("atomic"), F.col("shared_chain")))
    return out.where("total > 0") if drop_zero else out


def p_balances(utxos: DataFrame, now: Column) -> DataFrame:
    return balances(utxos, p_category(now), shared_chain=F.col("consumed_on"))


def x_balances(utxos: DataFrame, now: Column) -> DataFrame:
    return balances(utxos, x_category(now), shared_chain=F.col("consumed_on"))


def c_balances(utxos: DataFrame, now: Column) -> DataFrame:
    partner = F.coalesce(F.nullif("created_on", F.lit("")), F.nullif("consumed_on", F.lit("")), F.lit("p"))
    return balances(utxos, c_category(now), shared_chain=partner, drop_zero=False)


def all_categories(sums: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """sums with a row of nulls for each category of the fixed list that has none."""
    dim = sums.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, categories))).alias("category"))
    return dim.join(sums, "category", "left")


def balances_json(sums: DataFrame, categories: tuple[str, ...], asset: str = "asset_id") -> DataFrame:
    """One row, `balances`: a JSON object of each category's list of assets, in order of asset; empty lists stay. It has as
    many entries as there are categories and assets, whatever the number of outputs."""
    item = F.struct(F.col(asset).alias("assetId"), F.col("total").cast("string").alias("amount"), F.col("n").alias("utxoCount"), F.col("shared_chain").alias("sharedWithChainId"), "status")
    by = all_categories(sums, categories).groupBy("category").agg(F.sort_array(F.collect_list(F.when(F.col(asset).isNotNull(), item))).alias("items"))
    return by.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("category", "items"))))).alias("balances"))


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


def p_response(utxos: DataFrame, native: Column) -> DataFrame:
    """(utxo_id, response): P's JSON. Lock times are shown for native assets, spent fields hidden for stakes; nulls left out."""
    spent = ~F.coalesce("staked", F.lit(False))
    asset = F.struct(F.col("asset_id").alias("assetId"), "name", "symbol", "denomination", F.lit("secp256k1").alias("type"), F.col("amount").cast("string").alias("amount"))
    return utxos.select("utxo_id", _json(
        "addresses", asset.alias("asset"), F.col("tx_hash").alias("txHash"), F.col("output_index").alias("outputIndex"), F.col("utxo_id").alias("utxoId"), F.col("utxo_type").alias("utxoType"), F.col("block_number").alias("blockNumber"), F.col("block_timestamp").alias("blockTimestamp"),
        F.when(native, F.col("platform_locktime").cast("bigint")).alias("platformLocktime"), "threshold", "staked", F.col("created_on").alias("createdOnChainId"), F.col("consumed_on").alias("consumedOnChainId"),
        F.when(spent, F.col("consuming_tx")).alias("consumingTxHash"), F.when(spent, F.col("consuming_ts")).alias("consumingBlockTimestamp"), F.when(spent, F.col("consuming_block")).alias("consumingBlockNumber"),
        F.col("stake_start").alias("utxoStartTimestamp"), F.col("stake_end").alias("utxoEndTimestamp"),
    ).alias("response"))


def xc_response(utxos: DataFrame) -> DataFrame:
    """(utxo_id, response): the JSON of X and C: index as text, type in lower case, credentials and NFT fields."""
    asset = F.struct(F.col("asset_id").alias("assetId"), "name", "symbol", "denomination", F.col("amount").cast("string").alias("amount"))
    return utxos.select("utxo_id", _json(
        "addresses", F.col("utxo_id").alias("utxoId"), asset.alias("asset"), F.col("output_index").cast("string").alias("outputIndex"), F.lower("utxo_type").alias("utxoType"), F.col("tx_hash").alias("creationTxHash"), F.col("block_timestamp").alias("timestamp"),
        F.col("platform_locktime").cast("bigint").alias("locktime"), "threshold", F.col("created_on").alias("createdOnChainId"), F.col("consumed_on").alias("consumedOnChainId"), F.col("consuming_tx").alias("consumingTxHash"), F.col("consuming_ts").alias("consumingTxTimestamp"), "credentials", F.col("group_id").alias("groupId"), "payload",
    ).alias("response"))
