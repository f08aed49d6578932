"""Every registered ledger query against its SQL, over whole small tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from chainloom.plans.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck, same_rows):
    same_rows(QUERIES[name](spark, sf).toPandas(), duck.execute(ORACLE_SQL[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def shared_owner(sf, tmp_path_factory):
    """The small tables with orders whose customer has the address of a line's supplier, as in larger tables, and SQL over them."""
    folder, con = tmp_path_factory.mktemp("owners"), duckdb.connect()
    supp = "(select any_value(l_suppkey) from lineitem where l_orderkey = o_orderkey)"
    for t in ("customer", "supplier", "lineitem", "orders"):
        con.execute(f"create table {t} as select * from '{sf}/{t}.parquet'")
    con.execute(f"update orders set o_custkey = 100000 + {supp} where o_orderkey % 3 = 0 and {supp} is not null")
    for t in ("customer", "supplier", "lineitem", "orders"):
        con.execute(f"copy {t} to '{folder}/{t}.parquet'")
    return str(folder), con


def test_one_owner_counts_once_multisig(spark, same_rows, shared_owner):
    folder, con = shared_owner
    same_rows(QUERIES["multisig_spendable"](spark, folder).toPandas(), con.execute(ORACLE_SQL["multisig_spendable"]).df())


def test_one_owner_counts_once_exploded(spark, same_rows, shared_owner):
    folder, con = shared_owner
    same_rows(QUERIES["outputs_exploded"](spark, folder).toPandas(), con.execute(ORACLE_SQL["outputs_exploded"]).df())


def test_block_reads_reads_all_three_ways(spark):
    """A table with blocks beyond 1,000: the last block, the rows from a block on, and the sampled rows."""
    folder, con = "/root/testdata/sf0.01", duckdb.connect()
    con.execute(f"create view orders as select * from '{folder}/orders.parquet'; create view lineitem as select * from '{folder}/lineitem.parquet'")
    got = QUERIES["block_reads"](spark, folder).first()
    assert (got.last_block, got.from_1000, got.sampled) == con.execute("select max(o_orderkey // 8), count(*) filter (o_orderkey // 8 >= 1000), count(*) filter (o_orderkey // 8 % 100 = 0 and o_orderkey // 8 between 500 and 5000) from orders").fetchone()
    assert got.from_1000 > 0 and got.sampled > 0


def test_blocks_are_made_with_one_exchange(spark, sf):
    """Orders and lines go to their block once, as bare numbers; lines without an order make no block."""
    from chainloom.plans import blocks
    from chainloom.plans.views import Views

    plan = blocks.nested(Views(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["evm_transactions_table", "timed_records", "blocks_without_receipt", "evm_messages_table", "binary_headers", "block_headers", "evm_receipts_table"])
def test_block_queries_move_rows_to_their_block_once(name, spark, sf):
    """As run: one exchange by the block's number, whose result is used again, and beside it only the hashes (h) that blocks_without_receipt compares."""
    df = QUERIES[name](spark, sf)
    df.collect()
    run = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    by = [re.search(r"Exchange hashpartitioning\(([^#,]+)", line)[1] for line in run.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert [c for c in by if c != "h"] == ["num"]


@pytest.fixture(scope="module")
def unnumbered_lines(sf, tmp_path_factory):
    """Orders, and lines of which some have no number, no order's key, or the key of no order, and SQL over them."""
    folder, con = tmp_path_factory.mktemp("unnumbered"), duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"create table {t} as select * from '{sf}/{t}.parquet'")
    con.execute("update lineitem set l_linenumber = null where l_orderkey % 10 in (0, 3) and l_partkey % 2 = 0")
    con.execute("update lineitem set l_orderkey = case when l_partkey % 2 = 0 then l_orderkey + 100000 end where l_orderkey % 10 = 4")
    for t in ("lineitem", "orders"):
        con.execute(f"copy {t} to '{folder}/{t}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", ["evm_transactions_table", "timed_records", "blocks_without_receipt", "evm_messages_table", "binary_headers", "block_headers", "evm_receipts_table"])
def test_a_line_without_number_is_no_order(name, spark, same_rows, unnumbered_lines):
    folder, con = unnumbered_lines
    same_rows(QUERIES[name](spark, folder).toPandas(), con.execute(ORACLE_SQL[name]).df())


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ids_are_made_where_rows_have_been_joined(spark, sf):
    """The long ids are made above the join of lines and transactions, so that the join moves bare numbers."""
    from chainloom.plans.views import Views

    plan = _optimized(Views(spark, sf).out)
    assert plan.index("sha2") < plan.index("Join") and plan.count("sha2") == 1


def test_address_index_moves_outputs_once(spark):
    from chainloom.operators import utxo

    rows = spark.createDataFrame([("p", ["a", "b", "a"], "u1"), ("p", ["a", "b"], "u1"), ("x", [], "u2")], "store_chain string, addresses array<string>, utxo_id string")
    index = utxo.address_index(rows)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(utxo_id" in plan
    assert sorted(map(tuple, index.collect())) == [("p", "a", "u1"), ("p", "b", "u1")]


def test_multisig_ids_are_made_where_rows_stay(spark, sf):
    """As run without broadcasts, no exchange has the long id: lines and owners move as bare numbers, by transaction or address."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        df = QUERIES["multisig_spendable"](spark, sf)
        df.collect()
    finally:
        spark.conf.set(limit, was)
    run = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange" in run and "Exchange hashpartitioning(utxo_id" not in run
    assert run.count("sha2(") == 1 and run.index("sha2(") < run.index("Exchange")


@pytest.mark.parametrize("how", ["by key", "by home", "owners given", "a crowded home", "crowded homes"])
def test_rows_of_one_key_are_spendable_together(how, spark, monkeypatch):
    """Owners of all rows of a key count, against the greatest threshold of those with a hit; a null key is never found."""
    from chainloom.operators import balances

    rows = [
        (1, "a", ["p", "q"], 2), (1, "b", ["p", "p"], 2), (1, "c", ["p", "z"], 1), (2, "d", ["p"], 2), (2, "d", ["q", None], 1), (2, "d", ["z"], 9), (2, "e", ["z"], 0), (3, "f", ["r"], None), (3, None, ["p"], 1), (4, "g", None, 1), (4, "h", [], 0), (5, "i", ["p"], 1), (5, "i", ["p"], 1), (5, "j", ["p"], 0),
    ]
    utxos = spark.createDataFrame(rows, "tx long, utxo_id string, addresses array<string>, threshold int")
    addresses = spark.createDataFrame([("p",), ("q",), ("r",), ("p",), (None,), ("far",)], "address string")
    owned = spark.createDataFrame([(n, a) for n in range(7) for a in ("p", "q", "r", "z", None)], "tx long, address string")
    options = {"by key": {}, "owners given": {"home": "tx", "owned": owned}}.get(how, {"home": "tx"})
    if "crowded" in how:
        monkeypatch.setattr(balances, "HOME_OWNERS", 1 if how == "a crowded home" else 0)
    got = balances.spendable_by(utxos, addresses, **options)
    assert got.columns == ["utxo_id", "tx", "addresses", "threshold"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((k, t, a, n) for t, k, a, n in rows if k in ("a", "c", "d", "i", "j")), key=str)


def test_reward_ids_are_made_in_the_task_of_their_transaction(spark, sf):
    plan = _optimized(QUERIES["reward_match"](spark, sf))
    assert plan.index("sha2") < plan.index("RepartitionByExpression") and plan.count("RepartitionByExpression") == 1


def test_rewards_are_opened_for_reward_transactions_only(spark, sf):
    """Outputs of other transactions, which no reward can match, do not reach the joins."""
    plan = _optimized(QUERIES["reward_outputs_made"](spark, sf))
    assert plan.count("RewardValidatorTx") >= 2


def test_leaves_of_many_answers_go_back_together():
    import pyarrow as pa

    from chainloom.operators import quality

    answers = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(['{"a":1,"b":[2]}', None, "{"] * 100)], names=["id", "j"])
    got = list(quality._leaf_batches(iter([answers]), (), ()))
    assert len(got) == 1 and got[0].num_rows == 400
    assert sorted(zip(*(got[0].column(i).to_pylist() for i in range(3))), key=str)[:2] == [(0, "$.a", "1"), (0, "$.b[0]", "2")]


@pytest.mark.parametrize("name", ["p_answers", "xc_answers"])
def test_answers_are_parsed_once(name, spark, sf):
    plan = _optimized(QUERIES[name](spark, sf))
    assert "get_json_object" not in plan and plan.count("from_json") == 1
