"""A streaming source of block ranges: its offsets are heights, so the checkpoint says how far an export has come.

Each batch is one row (first, last): the blocks after the last offset, a batch of them at most, up to the head. At the head there
is nothing new and the query waits for its next trigger; after an error the query is started again on its checkpoint and is
given the range that was not committed, with the same bounds.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from chainloom.operators.evm import transform_batch
from chainloom.sources.sinks import write_export_batch

NAME, SCHEMA = "block_ranges", "first bigint, last bigint"


class Ranges(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.head, self.batch, self.start = options["head"], int(options.get("batch", 1000)), int(options.get("start", 1))

    def _height(self) -> int:
        """The newest block: a JSON file {"height": n} that the fetcher replaces, on any file system that pyarrow reaches."""
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.head) if "://" in self.head else (fs.LocalFileSystem(), self.head)
        with system.open_input_stream(path) as f:
            return int(json.loads(f.read())["height"])

    def initialOffset(self) -> dict:  # noqa: N802
        return {"height": self.start - 1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        done = int(start["height"])
        last = min(done + self.batch, self._height())
        return (iter([(done + 1, last)]), {"height": last}) if last > done else (iter([]), start)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter([(int(start["height"]) + 1, int(end["height"]))] if end["height"] > start["height"] else [])


class BlockRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> Ranges:  # noqa: N802
        return Ranges(self.options)


def block_ranges(spark: SparkSession, head: str, batch: int = 1000, start: int = 1) -> DataFrame:
    """The stream of ranges (first, last) up to the height in the head file."""
    spark.dataSource.register(BlockRanges)
    return spark.readStream.format(NAME).option("head", head).option("batch", batch).option("start", start).load()


def export_ranges(ranges: DataFrame, blocks: Callable[[], DataFrame], root: str, checkpoint: str, every: str = "10 seconds", prefix: str = "", height: str = "block_number", transform: Callable[[DataFrame], dict[str, DataFrame]] = transform_batch) -> StreamingQuery:
    """Export each range as one batch of tables, named by its last block, which a manifest makes visible at once.

    A range that is run again replaces itself. blocks is called for each range, so that it lists files that came since.
    """

    def write(batch: DataFrame, _: int) -> None:
        for first, last in batch.collect():  # one row
            rows = blocks().where(F.col(height).between(first, last)).drop(height)
            write_export_batch(transform(rows), root, last, prefix)

    return ranges.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
