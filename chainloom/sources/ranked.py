"""A sorted table with places, for pages deep in an order: rows are stored in blocks of equal size by their place, so a token,
which is an offset, names the blocks that its page is in, and only those are read."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.operators.balances import PAGE_DEFAULT, PAGE_MOST, page_offset, page_token
from chainloom.operators.ordered import windowed
from chainloom.sources.versions import VersionLog

#: Rows of a block.
BLOCK_ROWS = 1 << 16


def write_ranked(df: DataFrame, order: list[Column], root: str, block_rows: int = BLOCK_ROWS) -> int:
    """Store df in the order, which must be total, with `position` from 1; returns the version, of which readers see one whole."""
    root, folder = root.rstrip("/"), f"data/{uuid.uuid4().hex}"
    rows = windowed(df, tuple(order), number="_place")
    rows = rows.withColumns({"position": F.col("_place") + 1, "_block": F.floor(F.col("_place") / block_rows).cast("bigint")}).drop("_place")
    rows.repartition("_block").sortWithinPartitions("_block", "position").write.partitionBy("_block").option("compression", "zstd").parquet(f"{root}/{folder}")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.drop("_block").schema])
    total = df.sparkSession.read.schema(schema).parquet(f"{root}/{folder}").count()
    log = VersionLog(df.sparkSession, f"{root}/_versions")
    version = log.latest()[0] + 1
    log.commit(version, {"folder": folder, "total": total, "block_rows": block_rows, "schema": json.dumps(schema.jsonValue())})
    return version


def read_page(spark: SparkSession, root: str, size: int = PAGE_DEFAULT, token: str | None = None, version: int | None = None) -> DataFrame:
    """A page as paginate() gives it, with the same tokens, from one block or two. A token does not name a version: pass one to
    page through a table that is being replaced."""
    root, log = root.rstrip("/"), VersionLog(spark, f"{root.rstrip('/')}/_versions")
    value = log.read(version) if version is not None else log.latest()[1]
    size, start = min(max(size, 1), PAGE_MOST), page_offset(token)
    schema = T.StructType.fromJson(json.loads(value["schema"]))
    last = min(start + size, value["total"]) - 1
    blocks = range(start // value["block_rows"], last // value["block_rows"] + 1) if last >= start else ()
    rows = spark.read.schema(schema).parquet(*(f"{root}/{value['folder']}/_block={b}" for b in blocks)) if blocks else spark.createDataFrame([], schema)
    more = F.lit(start + size) if start + size < value["total"] else F.lit(None).cast("int")
    return rows.where(F.col("position").between(start + 1, start + size)).withColumn("next_token", page_token(more))
