"""Ledger views over the star-schema tables, for Spark and as SQL: transactions, outputs, spends, stakes, validators."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A moment in the middle of the tables' time, in Unix seconds.
NOW = 893_462_400
DAY = 86_400
BASE = 788_918_400  # 1995-01-01


def seconds(c: str) -> Column:
    """Unix seconds of a timestamp that was stored without a zone."""
    return F.unix_seconds(F.col(c).cast("timestamp"))


def s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class Views:
    """The views of one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def tx(self) -> DataFrame:
        ts = seconds("o_orderdate")
        return self.table("orders").select(F.col("o_orderkey").alias("tx_id"), F.floor((ts - BASE) / DAY + 1).cast("bigint").alias("block_number"), ts.alias("ts"), F.col("o_custkey").alias("sender"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("value"), F.col("o_orderstatus").alias("chain"), F.col("o_orderpriority").alias("indexer"))

    @cached_property
    def bare_line(self) -> DataFrame:
        """lineitem with its ship time and its amount in cents; the long id is made from these columns by with_id()."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("tx_id"), F.col("l_linenumber").cast("bigint").alias("output_index"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount"),
            F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), seconds("l_shipdate").alias("ship_ts"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        )

    @staticmethod
    def with_id(lines: DataFrame) -> DataFrame:
        return lines.select(F.sha2(F.concat_ws("|", "tx_id", "output_index", "part", "supp", "ship_ts"), 256).alias("utxo_id"), "*")

    @cached_property
    def line(self) -> DataFrame:
        """lineitem with an id, its ship time and its amount in cents."""
        return self.with_id(self.bare_line)

    @cached_property
    def line_by_tx(self) -> DataFrame:
        """line, with a transaction's lines in one task; ids are made there, as they are most of a line's bytes."""
        return self.with_id(self.bare_line.repartition("tx_id"))

    @cached_property
    def out(self) -> DataFrame:
        tx = self.tx.select("tx_id", F.col("ts").alias("created_ts"), "block_number", "sender")
        # Ids are made after the join, which so moves bare numbers.
        return self.with_id(self.bare_line.join(tx, "tx_id")).select(
            "*", (F.col("part") % 5).alias("asset_id"), F.array(F.col("sender"), F.col("supp") + 100_000).alias("addresses"), F.when(F.col("flag") == "R", 2).otherwise(1).alias("threshold"),
            F.lit("p").alias("created_on"), F.when(F.col("supp") % 4 == 0, "x").otherwise("p").alias("consumed_on"), (F.col("status") == "O").alias("staked"),
            F.when(F.col("status") == "O", F.col("created_ts")).alias("stake_start"), F.when(F.col("status") == "O", F.col("created_ts") + DAY * (30 + F.col("supp") % 200)).alias("stake_end"),
            F.when(F.col("part") % 3 == 0, F.col("created_ts") + DAY * (F.col("part") % 400)).otherwise(0).alias("platform_locktime"), F.when(F.col("part") % 7 == 0, F.col("created_ts") + DAY * (F.col("part") % 400)).otherwise(0).alias("stakeable_locktime"),
        )

    @cached_property
    def owned(self) -> DataFrame:
        """(tx_id, address): the owners of out, from the tables themselves, so a sender comes once; lines without an order are in it too."""
        return self.tx.select("tx_id", F.col("sender").alias("address")).union(self.bare_line.select("tx_id", F.col("supp") + 100_000))

    @cached_property
    def spend(self) -> DataFrame:
        return self.out.where("flag = 'A'").select("utxo_id", F.concat(F.lit("s"), s("tx_id")).alias("consuming_tx"), (F.col("created_ts") + DAY * (1 + F.col("part") % 90)).alias("consuming_ts"))

    @cached_property
    def utxos(self) -> DataFrame:
        """out with its spend; the spend is a function of the row itself, so there is nothing to join."""
        used = F.col("flag") == "A"
        return self.out.withColumns({"consuming_tx": F.when(used, F.concat(F.lit("s"), s("tx_id"))), "consuming_ts": F.when(used, F.col("created_ts") + DAY * (1 + F.col("part") % 90))})

    @cached_property
    def validator(self) -> DataFrame:
        terms = self.table("supplier").select(F.col("s_suppkey").alias("node_id"), F.round(F.col("s_acctbal") * 100).cast("bigint").alias("amount"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
        start = F.lit(BASE) + (F.col("node_id") % 50) * DAY + F.col("k") * 400 * DAY
        return terms.select("node_id", F.lit("primary").alias("subnet_id"), F.concat(F.lit("v"), s("node_id"), F.lit("-"), s("k")).alias("tx_hash"), start.cast("bigint").alias("start"), (start + 300 * DAY).cast("bigint").alias("end"), "amount")

    @cached_property
    def delegator(self) -> DataFrame:
        return self.line.select(F.col("supp").alias("node_id"), F.lit("primary").alias("subnet_id"), F.col("utxo_id").alias("tx_hash"), F.col("ship_ts").alias("start"), (F.col("ship_ts") + DAY * (10 + F.col("part") % 60)).alias("end"), "amount", (F.col("flag") == "R").alias("completed"))

    @cached_property
    def p_txs(self) -> DataFrame:
        """Staking and reward transactions by the kind of part; a reward's stake is the line before it in its order."""
        kinds = ["AddValidatorTx", "AddDelegatorTx", "AddPermissionlessValidatorTx", "AddPermissionlessDelegatorTx", "RewardValidatorTx"]
        owner = lambda c: F.struct(F.lit(1).cast("bigint").alias("threshold"), F.lit(0).cast("decimal(20,0)").alias("locktime"), F.array(s(c)).alias("addresses"))
        return self.out.select(
            F.col("utxo_id").alias("tx_id"), F.col("block_number").alias("height"), F.col("created_ts").alias("block_ts"), F.col("part").alias("tx_index"), F.get(F.array(*map(F.lit, kinds)), (F.col("part") % 5).cast("int")).alias("tx_type"),
            s("supp").alias("node_id"), F.when(F.col("supp") % 3 == 0, "other").otherwise("primary").alias("subnet_id"), F.col("amount").alias("weight"), F.col("created_ts").alias("start_ts"), (F.col("created_ts") + 100 * DAY).alias("end_ts"),
            owner("sender").alias("validator_owner"), owner(F.col("supp") + 100_000).alias("delegator_owner"), F.lag("utxo_id").over(Window.partitionBy("tx_id").orderBy("output_index", "utxo_id")).alias("staking_tx_id"), "status",
        )


#: The same views as SQL; a query's text starts with those that it names.
SQL = {
    "tx": "select o_orderkey as tx_id, datediff('day', date '1995-01-01', o_orderdate::date) + 1 as block_number, epoch_us(o_orderdate) // 1000000 as ts, o_custkey as sender, round(o_totalprice * 100)::bigint as value, o_orderstatus as chain, o_orderpriority as indexer from orders",
    "line": "select sha256(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' || (epoch_us(l_shipdate) // 1000000)) as utxo_id, l_orderkey as tx_id, l_linenumber::bigint as output_index, round(l_extendedprice * 100)::bigint as amount, l_partkey as part, l_suppkey as supp, epoch_us(l_shipdate) // 1000000 as ship_ts, l_returnflag as flag, l_linestatus as status from lineitem",
    "outs": f"""select line.*, tx.ts as created_ts, block_number, sender, part % 5 as asset_id, [sender, supp + 100000] as addresses, case when flag = 'R' then 2 else 1 end as threshold, 'p' as created_on, case when supp % 4 = 0 then 'x' else 'p' end as consumed_on,
        status = 'O' as staked, case when status = 'O' then tx.ts end as stake_start, case when status = 'O' then tx.ts + {DAY} * (30 + supp % 200) end as stake_end,
        case when part % 3 = 0 then tx.ts + {DAY} * (part % 400) else 0 end as platform_locktime, case when part % 7 = 0 then tx.ts + {DAY} * (part % 400) else 0 end as stakeable_locktime from line join tx using (tx_id)""",
    "utxos": f"select *, case when flag = 'A' then 's' || tx_id end as consuming_tx, case when flag = 'A' then created_ts + {DAY} * (1 + part % 90) end as consuming_ts from outs",
    "validator": f"select s_suppkey as node_id, 'primary' as subnet_id, 'v' || s_suppkey || '-' || k as tx_hash, ({BASE} + (s_suppkey % 50) * {DAY} + k * 400 * {DAY})::bigint as start, ({BASE} + (s_suppkey % 50) * {DAY} + k * 400 * {DAY} + 300 * {DAY})::bigint as \"end\", round(s_acctbal * 100)::bigint as amount from supplier, (values (0), (1), (2)) t(k)",
    "delegator": f"select supp as node_id, 'primary' as subnet_id, utxo_id as tx_hash, ship_ts as start, ship_ts + {DAY} * (10 + part % 60) as \"end\", amount, flag = 'R' as completed from line",
    "p_txs": f"""select utxo_id as tx_id, block_number as height, created_ts as block_ts, part as tx_index, ['AddValidatorTx', 'AddDelegatorTx', 'AddPermissionlessValidatorTx', 'AddPermissionlessDelegatorTx', 'RewardValidatorTx'][(part % 5)::int + 1] as tx_type, supp::varchar as node_id,
        case when supp % 3 = 0 then 'other' else 'primary' end as subnet_id, amount as weight, created_ts as start_ts, created_ts + 100 * {DAY} as end_ts, sender::varchar as v_owner, (supp + 100000)::varchar as d_owner, lag(utxo_id) over (partition by tx_id order by output_index, utxo_id) as staking_tx_id, status from outs""",
}
_NEEDS = {"tx": (), "line": (), "outs": ("line", "tx"), "utxos": ("line", "tx", "outs"), "validator": (), "delegator": ("line",), "p_txs": ("line", "tx", "outs")}


def with_views(*names: str) -> str:
    """`with` and the named views, those that they need first."""
    wanted = [v for v in SQL if v in {x for n in names for x in (*_NEEDS[n], n)}]
    return "with " + ", ".join(f"{v} as ({SQL[v]})" for v in wanted) + " "
