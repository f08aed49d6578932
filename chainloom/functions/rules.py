"""Small rules of the ledger as columns: dates, addresses, rewards, fees, genesis data and asset kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most addresses that a request may name.
ADDRESS_CAP = 64
#: Shares are counted in millionths.
SHARES = 1_000_000


def partition_date(ts: Column) -> Column:
    """UTC date of Unix seconds (the session's time zone must be UTC)."""
    return F.to_date(F.timestamp_seconds(ts))


def rfc3339(ts: Column) -> Column:
    """UTC time as text; empty for null or zero seconds."""
    return F.when(F.coalesce(ts, F.lit(0)) == 0, "").otherwise(F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def normalise_to(address: Column) -> Column:
    """A missing receiver as a bare 0x."""
    return F.when(F.coalesce(address, F.lit("")) == "", "0x").otherwise(address)


def strip_chain_prefix(address: Column) -> Column:
    return F.regexp_replace(address, "^P-", "")


def progress(start: Column, end: Column, now: Column) -> Column:
    """Percent of an interval that has passed: 0 before it, 100 from its end on."""
    return F.when(now <= start, 0.0).when(now >= end, 100.0).otherwise((now - start).cast("double") / (end - start) * 100)


def split_reward(amount: Column, shares: Column) -> tuple[Column, Column]:
    """(delegator's part, validator's part) of a reward, by the validator's shares in millionths; whole numbers, rounded down."""
    whole = amount.cast("decimal(20,0)")
    delegator = F.floor((F.lit(SHARES).cast("decimal(10,0)") - shares.cast("decimal(10,0)")) * whole / F.lit(SHARES).cast("decimal(10,0)")).cast("decimal(20,0)")
    return delegator, (whole - delegator).cast("decimal(20,0)")


def format_fee(shares: Column) -> Column:
    """Shares as a percentage with 16 decimals; null for none."""
    return F.when(shares != 0, (shares.cast("decimal(20,0)") / F.lit(10000).cast("decimal(5,0)")).cast("decimal(30,16)").cast("string"))


def evm_chain_id(genesis: Column) -> Column:
    """config.chainId of genesis JSON where it is there and not zero."""
    return F.nullif(F.get_json_object(genesis, "$.config.chainId").try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_genesis(data: Column) -> Column:
    """Genesis bytes as canonical JSON text if they are JSON, else as Base64 text."""
    text = F.try_validate_utf8(data.cast("string")) if hasattr(F, "try_validate_utf8") else data.cast("string")
    return F.coalesce(F.to_json(F.try_parse_json(text)), F.base64(data))


def asset_type(name: Column, payload: Column) -> Column:
    """nft for outputs with a payload and names that say so, else secp256k1."""
    low = F.lower(F.coalesce(name, F.lit("")))
    return F.when((F.coalesce(payload, F.lit("")) != "") | low.contains("nft") | low.contains("family"), "nft").otherwise("secp256k1")


def parse_address_list(s: Column, cap: int = ADDRESS_CAP) -> Column:
    """A comma-separated list: trimmed, blanks dropped, first of equals kept, at most cap."""
    return F.slice(F.array_distinct(F.filter(F.transform(F.split(s, ","), lambda a: F.trim(a)), lambda a: a != "")), 1, cap)


def chain_kind(rows: DataFrame, chain_dim: DataFrame, alias_col: str = "chain") -> tuple[DataFrame, DataFrame]:
    """(rows with kind and canonical chain_id, rows with an unknown chain). chain_dim(alias, network, kind, chain_id) is a
    list of the few chains of a network and of their names."""
    known = rows.join(chain_dim.withColumnRenamed("alias", alias_col), alias_col)
    return known, rows.join(chain_dim, rows[alias_col] == chain_dim["alias"], "left_anti")
