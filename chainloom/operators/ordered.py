"""Windows over one global order, without a task that gets all rows.

Rows are range-partitioned by the order and the partitions numbered; a window runs within each, and what a row needs from the
partitions before (their last value, count or sum) comes from a small table with one row a partition.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PART = "_part"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode only."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(base or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder of the session."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def in_parts(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """df with the number of its range partition; written, since the numbers must not change between two uses."""
    return checkpointed(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def windowed(df: DataFrame, order: tuple[str, ...], number: str | None = None, sums: dict[str, str] | None = None, lags: dict[str, str] | None = None, tops: dict[str, str] | None = None) -> DataFrame:
    """df with several windows over one global order, from one written table: each row's place from 0 under the name `number`,
    running sums and maxima up to and with the row, and values of the row before (new name: column). The order must be total for sums.

    What a partition needs of those before it is a row: how many they are, their sums, maxima and the last of their rows.
    """
    sums, lags, tops, own = sums or {}, lags or {}, tops or {}, Window.partitionBy(PART).orderBy(*order)
    parts = in_parts(df, order)
    per = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"), *(F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums.values())), *(F.max(c).alias(f"_t{i}") for i, c in enumerate(tops.values())), *(F.max_by(F.struct(c), F.struct(*order)).alias(f"_l{i}") for i, c in enumerate(lags.values())))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"), *(F.coalesce(F.sum(f"_s{i}").over(earlier), F.lit(0)).alias(f"_s{i}") for i in range(len(sums))), *(F.max(f"_t{i}").over(earlier).alias(f"_t{i}") for i in range(len(tops))), *(F.last(f"_l{i}").over(earlier).getField(c).alias(f"_l{i}") for i, c in enumerate(lags.values())))
    place = F.row_number().over(own)
    new = {name: (F.coalesce(F.sum(c).over(own), F.lit(0)) + F.col(f"_s{i}")) for i, (name, c) in enumerate(sums.items())}
    new |= {name: F.when(place == 1, F.col(f"_l{i}")).otherwise(F.lag(c).over(own)) for i, (name, c) in enumerate(lags.items())}
    new |= {name: F.greatest(F.max(c).over(own), F.col(f"_t{i}")) for i, (name, c) in enumerate(tops.items())}
    if number:
        new[number] = (place - 1 + F.col("_n")).cast("bigint")
    return parts.join(F.broadcast(per), PART).withColumns(new).select(*df.columns, *new)


def lagged(df: DataFrame, col: str, order: tuple[str, ...], keys: tuple[str, ...] = (), name: str = "previous") -> DataFrame:
    """df with the column's value in the row before, of each key or of the whole table."""
    return df.withColumn(name, F.lag(col).over(Window.partitionBy(*keys).orderBy(*order))) if keys else windowed(df, order, lags={name: col})


def numbered(df: DataFrame, order: tuple[str, ...], keys: tuple[str, ...] = (), name: str = "n") -> DataFrame:
    """df with each row's place from 0, in each key or in the whole table."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint")) if keys else windowed(df, order, number=name)


def running_sum(df: DataFrame, col: str, order: tuple[str, ...], keys: tuple[str, ...] = (), name: str = "total") -> DataFrame:
    """df with the sum of the column up to and with each row, in each key or in the whole table; the order must be total."""
    return df.withColumn(name, F.sum(col).over(Window.partitionBy(*keys).orderBy(*order))) if keys else windowed(df, order, sums={name: col})


#: One over the rank error of the sketch, as a share of the rows.
SKETCH = 10_000


def value_at(df: DataFrame, col: str, rank: int, n: int | None = None):
    """The value at a rank (from 0) in the order of a numeric column without nulls; df should be a written table.

    Two passes whatever the spread: a quantile sketch brackets the rank, then one pass counts what lies below the bracket and the
    values inside it, of which there are few but for ties; those are walked in parts.
    """
    n = df.count() if n is None else n
    at = lambda r: min(1.0, max(0.0, r / n))
    # Twice the error to either side; the ends of the column where the rank is near them.
    wide = 2.0 * n / SKETCH + 2
    low, high, least, most = df.agg(F.percentile_approx(col, F.lit(at(rank - wide)), SKETCH), F.percentile_approx(col, F.lit(at(rank + wide)), SKETCH), F.min(col), F.max(col)).first()
    low, high = (least if rank - wide <= 0 else low), (most if rank + wide >= n else high)
    kind = df.schema[col].dataType
    x, low, high = F.col(col), F.lit(low).cast(kind), F.lit(high).cast(kind)
    inside = df.where(x <= high).groupBy(F.when(x >= low, x).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    inside = checkpointed(inside)
    below = inside.where("x is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if below > rank:
        raise ArithmeticError("the sketch missed the rank")
    upto = windowed(inside.where("x is not null"), ("x",), sums={"upto": "n"})
    found = upto.where(F.col("upto") > rank - below).agg(F.min("x")).first()[0]
    if found is None:
        raise ArithmeticError("the sketch missed the rank")
    return found
