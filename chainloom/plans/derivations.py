"""Derived tables by name: what they read, how they are made, and their key; the place to add one's own."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from chainloom.operators import registry, staking, utxo, validators


@dataclass(frozen=True)
class Derivation:
    inputs: tuple[str, ...]
    derive: Callable[..., DataFrame]
    key: tuple[str, ...]


DERIVATIONS: dict[str, Derivation] = {
    "p_outputs": Derivation(("p_txs",), utxo.p_outputs, ("utxo_id",)),
    "x_outputs": Derivation(("x_txs",), utxo.x_outputs, ("utxo_id",)),
    "c_outputs": Derivation(("c_atomic_txs",), utxo.c_outputs, ("utxo_id",)),
    "utxos": Derivation(("outputs", "spends"), utxo.derive_utxos, ("store_chain", "utxo_id")),
    "staking_records": Derivation(("p_txs",), staking.staking_records, ("tx_id",)),
    "validators": Derivation(("p_txs",), validators.validators, ("tx_hash",)),
    "delegators": Derivation(("p_txs",), validators.delegators, ("tx_hash",)),
    "subnets": Derivation(("p_txs",), registry.subnets, ("subnet_id",)),
    "blockchains": Derivation(("p_txs",), registry.blockchains, ("blockchain_id",)),
    "assets": Derivation(("x_txs",), registry.assets, ("asset_id",)),
}


def register(name: str, inputs: tuple[str, ...], derive: Callable[..., DataFrame], key: tuple[str, ...]) -> None:
    if name in DERIVATIONS:
        raise ValueError(f"{name} is taken")
    DERIVATIONS[name] = Derivation(inputs, derive, key)


def build(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The derived table from named input tables."""
    d = DERIVATIONS[name]
    return d.derive(*(tables[i] for i in d.inputs))
