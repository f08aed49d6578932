"""Consumers of one block table that each go on from their own mark.

A range of blocks is read once for all consumers that need it. What a consumer makes of its part is written first; its next
mark, with the folder of that output, is then one version of its log. A crash in between leaves a folder that no mark names: the
range is made again, and readers, who go by the log, see each block's output once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.sources.versions import VersionLog

Transform = Callable[[DataFrame], DataFrame]
#: Blocks that are read at once.
BATCH = 100_000


def _log(spark: SparkSession, root: str, name: str) -> VersionLog:
    return VersionLog(spark, f"{root.rstrip('/')}/{name}/_marks")


def mark(spark: SparkSession, root: str, name: str) -> int:
    """The last block whose output the consumer has committed, 0 before the first."""
    return _log(spark, root, name).latest()[1].get("mark", 0)


def marks(spark: SparkSession, root: str, names: list[str], chain: str = "p") -> DataFrame:
    """(chain, indexer, height): a row a consumer, as global_watermark() and sync_progress() take them."""
    return spark.createDataFrame([(chain, n, mark(spark, root, n)) for n in names], "chain string, indexer string, height bigint")


def run_consumers(blocks: DataFrame, consumers: dict[str, Transform], root: str, head: int | None = None, batch: int = BATCH, height: str = "block_number") -> dict[str, int]:
    """Bring all consumers to the head (by default the highest block), range by range: the marks that they have then.

    Ranges start after the lowest mark; a consumer gets the rows above its own. An error in one ends the run after the commits
    before it; the next run goes on from the marks.
    """
    spark = blocks.sparkSession
    logs = {name: _log(spark, root, name) for name in consumers}
    at = {name: log.latest() for name, log in logs.items()}
    done = {name: value.get("mark", 0) for name, (_, value) in at.items()}
    numbers = {name: number for name, (number, _) in at.items()}
    head = (blocks.agg(F.max(height)).first()[0] or 0) if head is None else head
    while done and min(done.values()) < head:
        first = min(done.values()) + 1
        last = min(first + batch - 1, head)
        shared = blocks.where(F.col(height).between(first, last)).persist()
        try:
            for name, transform in consumers.items():
                if done[name] >= last:
                    continue
                folder = f"data/{done[name] + 1:020d}-{last:020d}"
                transform(shared.where(F.col(height) > done[name])).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}/{folder}")
                logs[name].commit(numbers[name] + 1, {"mark": last, "folder": folder})
                done[name], numbers[name] = last, numbers[name] + 1
        finally:
            shared.unpersist()
    return done


def consumer_output(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """All that a consumer has committed; None before the first."""
    log = _log(spark, root, name)
    folders = [f"{root.rstrip('/')}/{name}/{log.read(v)['folder']}" for v in log.versions()]
    return spark.read.parquet(*folders) if folders else None
