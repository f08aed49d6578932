"""Derived tables by name give what their functions give."""

import pytest
from test_ledger import ptx  # noqa: F401

from chainloom.operators import utxo
from chainloom.plans import derivations


def test_build(spark, ptx):  # noqa: F811
    outs = derivations.build("p_outputs", {"p_txs": ptx})
    key = list(derivations.DERIVATIONS["p_outputs"].key)
    assert sorted(r.utxo_id for r in outs.select(key).collect()) == sorted(r.utxo_id for r in utxo.p_outputs(ptx).collect())
    rows = derivations.build("utxos", {"outputs": outs, "spends": utxo.spends(ptx, "p")})
    assert rows.where("utxo_id = 'u0'").first().consuming_tx == "t2"
    with pytest.raises(ValueError):
        derivations.register("utxos", (), utxo.p_outputs, ())
