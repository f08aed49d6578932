"""Writers: an all-or-nothing set of tables, CSV, exports and compacted blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from chainloom.sources.schemas import CSV_NAMES

BATCH_BLOCKS, HOT_BLOCKS = 100, 1000


def write_export_batch(tables: dict[str, DataFrame], root: str, batch_id: int, prefix: str = "") -> None:
    """Each table under its batch's own folder, then one manifest row that makes the batch visible.

    A retried batch overwrites its own folders, so it is written once however often it runs; readers go by the manifest.
    """
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{prefix}{name}/batch_id={batch_id}")
    spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(",".join(sorted(tables))).alias("tables"), F.current_timestamp().alias("at")).coalesce(1).write.mode("overwrite").parquet(f"{root}/{prefix}_manifest/batch={batch_id}")


def read_export(spark: SparkSession, root: str, table: str, prefix: str = "") -> DataFrame:
    """Rows of the committed batches of a table."""
    manifest = spark.read.parquet(f"{root}/{prefix}_manifest").select("batch_id").distinct()
    return spark.read.parquet(f"{root}/{prefix}{table}").join(manifest, "batch_id", "left_semi")


def last_committed(spark: SparkSession, root: str, prefix: str = "") -> int:
    """The last committed batch, -1 before the first."""
    try:
        return spark.read.parquet(f"{root}/{prefix}_manifest").agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]
    except AnalysisException:
        return -1


def csv_rows(df: DataFrame) -> DataFrame:
    """df as the CSV form has it: text columns, names in capitals, plain numbers, true and false, nulls empty."""

    def text(f: T.StructField):
        c = F.col(f"`{f.name}`")
        return F.to_json(c) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")

    return df.select(*(F.coalesce(text(f), F.lit("")).alias(CSV_NAMES.get(f.name, f.name).upper()) for f in df.schema.fields))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header for each file; a table without rows gives a folder without data files' rows."""
    csv_rows(df).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def export_rows(rows: DataFrame, path: str, form: str = "csv", limit: int | None = None) -> None:
    """Export rows as CSV or JSON lines; limit is the user's own."""
    rows = rows if limit is None else rows.limit(limit)
    if form == "json":
        rows.write.mode("overwrite").json(path)
    elif form == "csv":
        write_csv(rows, path)
    else:
        raise ValueError(f"unknown form {form}")


def compaction_plan(blocks: DataFrame, col: str = "block_number", batch: int = BATCH_BLOCKS, keep: int = HOT_BLOCKS) -> DataFrame:
    """(batch_start, n, complete, cold): aligned batches of blocks from 1 on, whether none is missing, and whether the batch
    lies wholly below the newest `keep` blocks. Only complete and cold batches may be compacted."""
    start = (F.floor((F.greatest(F.col(col), F.lit(1)) - 1) / batch) * batch + 1).cast("bigint")
    newest = blocks.agg(F.max(col)).first()[0] or 0
    plan = blocks.where(F.col(col) > 0).select(start.alias("batch_start"), col).groupBy("batch_start").agg(F.countDistinct(col).alias("n"))
    return plan.select("batch_start", "n", (F.col("n") == batch).alias("complete"), (F.col("batch_start") + batch - 1 + keep <= newest).alias("cold"))


def compact_blocks(blocks: DataFrame, path: str, col: str = "block_number", batch: int = BATCH_BLOCKS, keep: int = HOT_BLOCKS) -> DataFrame:
    """Write the batches that may be compacted, sorted within files; return the cold batches that lack a block."""
    plan = compaction_plan(blocks, col, batch, keep)
    start = (F.floor((F.col(col) - 1) / batch) * batch + 1).cast("bigint")
    ready = blocks.withColumn("batch_start", start).join(plan.where("complete and cold").select("batch_start"), "batch_start", "left_semi")
    ready.repartition("batch_start").sortWithinPartitions("batch_start", col).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return plan.where("cold and not complete")
