"""Streaming jobs: blocks in order to six tables, address activity, health, and spends that come before their outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chainloom.operators.control import export_range
from chainloom.operators.evm import transform_batch
from chainloom.operators.registry import address_chains
from chainloom.sources.readers import from_block
from chainloom.sources.schemas import NORMALIZED_BLOCK
from chainloom.sources.sinks import last_committed, write_export_batch


def block_stream(spark: SparkSession, path: str, start: int = 1, files_per_trigger: int = 10, schema: str = NORMALIZED_BLOCK) -> DataFrame:
    """A stream of landed block files, from a block on; the checkpoint holds where it is."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows if start <= 1 else from_block(rows.withColumn("block_number", F.conv(F.substring("block.number", 3, 16), 16, 10).cast("bigint")), start).drop("block_number")


def run_export(stream: DataFrame, root: str, checkpoint: str, every: str | None = None, prefix: str = "", transform: Callable[[DataFrame], dict[str, DataFrame]] = transform_batch) -> StreamingQuery:
    """Six tables for each micro-batch, committed together by a manifest; a batch that is run again replaces itself.

    every: an interval between triggers; without one all that is there is exported and the query ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                write_export_batch(transform(batch), root, batch_id, prefix)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def stream_address_chains(touches: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """(address, chain) pairs as they first occur; the pairs seen are the query's state."""
    pairs = touches.select(F.explode("addresses").alias("address"), "chains").select("address", F.explode("chains").alias("chain")).dropDuplicates(["address", "chain"])
    return pairs.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def stream_health(log: DataFrame, ts: str = "ts", late: str = "2 minutes", keys: tuple[str, ...] = ("chain",), width: str = "60 seconds", slide: str = "5 seconds") -> DataFrame:
    """Requests, errors and an approximate p95 by sliding window, for a stream; request_health() gives the exact one."""
    by = log.withWatermark(ts, late).groupBy(*keys, F.window(ts, width, slide).alias("w"))
    return by.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("success"), 0).otherwise(1)).alias("errors"), F.percentile_approx("duration_ms", 0.95, 1000).alias("p95"))


def pair_halves(halves: DataFrame, retention_ms: int | None = None) -> DataFrame:
    """(utxo_id, created_ts, consuming_ts) once both an output and its spend have come, in either order.

    halves(utxo_id, half 'output' or 'spend', ts): the first half of an output waits as state, and leaves it with the second;
    a retention, in milliseconds of processing time, lets lonely halves go, else they wait for ever. An output is made and
    spent once, so a half that comes again after its pair is one that was delivered twice.
    """

    def pair(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        made, used = state.get if state.exists else (None, None)
        for pdf in rows:
            for half, ts in zip(pdf.half, pdf.ts):
                made, used = (int(ts), used) if half == "output" else (made, int(ts))
        if made is not None and used is not None:
            if state.exists:
                state.remove()
            yield pd.DataFrame({"utxo_id": [key[0]], "created_ts": [made], "consuming_ts": [used]})
            return
        state.update((made, used))
        if retention_ms:
            state.setTimeoutDuration(retention_ms)

    wait = GroupStateTimeout.ProcessingTimeTimeout if retention_ms else GroupStateTimeout.NoTimeout
    return halves.groupBy("utxo_id").applyInPandasWithState(pair, "utxo_id string, created_ts bigint, consuming_ts bigint", "made bigint, used bigint", "append", wait)


class Sequence(StatefulProcessor):
    """Gaps and disorder of each chain's blocks: (chain, previous, height) where a height is not the last plus one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "height bigint")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for height in sorted(h for pdf in rows for h in pdf.height):
            if last is not None and height != last + 1:
                out.append((key[0], last, int(height)))
            last = int(height)
        if last is not None:
            self.last.update((last,))
        yield pd.DataFrame(out, columns=["chain", "previous", "height"])

    def close(self) -> None:
        pass


def stream_sequence(blocks: DataFrame) -> DataFrame:
    """blocks(chain, height) checked in order, chain by chain; needs the RocksDB state store."""
    return blocks.groupBy("chain").transformWithStateInPandas(Sequence(), "chain string, previous bigint, height bigint", "append", "none")


def export_next(blocks: DataFrame, heads: DataFrame, root: str, batch: int = 1000, prefix: str = "", transform: Callable[[DataFrame], dict[str, DataFrame]] = transform_batch) -> tuple[int, bool]:
    """Export one batch of blocks(block_number, ...) after those that the root's manifest has: (blocks in range, whether the
    batch was full). A scheduler runs it again at once after a full batch, and later after a part of one or an error."""
    spark = blocks.sparkSession
    done = last_committed(spark, root, prefix)
    todo = export_range(spark.createDataFrame([("", done)] if done >= 0 else [], "chain string, height bigint"), heads.select(F.lit("").alias("chain"), "height"), batch=batch).first()
    if todo is None:
        return 0, False
    rows = blocks.where(F.col("block_number").between(todo.first, todo.last)).drop("block_number")
    # A batch is named by its last block, so the manifest says how far the export has come.
    write_export_batch(transform(rows), root, todo.last, prefix)
    return todo.last - todo.first + 1, todo.full


__all__ = ["address_chains", "block_stream", "export_next", "pair_halves", "run_export", "stream_address_chains", "stream_health", "stream_sequence"]
