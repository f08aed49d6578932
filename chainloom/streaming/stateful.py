"""Streams with state of their own: keys that stakers affect, the monitor's windows, and the request controller."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chainloom.operators.control import MIN_SAMPLES, PARALLELISM, next_level
from chainloom.operators.staking import REWARD_TX, staker_keys


class Stakers(StatefulProcessor):
    """Of one staking transaction the node and addresses, from its start until it is rewarded."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.meta = handle.getValueState("meta", "node_id string, addrs array<string>")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        events = sorted(((r.height, r.tx_index, r.ends, r.node_id, r.addrs) for pdf in rows for r in pdf.itertuples()), key=lambda e: e[:3])
        meta, out = (self.meta.get() if self.meta.exists() else None), []
        for _, _, ends, node, addrs in events:
            if not ends:
                meta = (node, list(addrs))
            if meta is not None:
                out += [("node", meta[0])] + [("address", a) for a in meta[1]]
            if ends:
                meta = None
        if meta is None:
            self.meta.clear()
        else:
            self.meta.update(meta)
        yield pd.DataFrame([x for x in dict.fromkeys(out) if x[1]], columns=["kind", "key"])

    def close(self) -> None:
        pass


def stream_affected(p_txs: DataFrame) -> DataFrame:
    """(kind, key) as affected_stakers(), for a stream of transactions in the order of blocks: what starts is remembered by its id
    until its reward takes it out. A key comes once for each transaction that affects it."""
    begun = staker_keys(p_txs).withColumn("ends", F.lit(False))
    ended = p_txs.where(F.col("tx_type") == REWARD_TX).select(F.col("staking_tx_id").alias("tx_id"), F.lit(None).cast("string").alias("node_id"), F.array().cast("array<string>").alias("addrs"), "height", "tx_index", F.lit(True).alias("ends"))
    return begun.unionByName(ended).where("tx_id is not null").groupBy("tx_id").transformWithStateInPandas(Stakers(), "kind string, key string", "append", "none")


class Monitor(StatefulProcessor):
    """The open window of one chain: a window closes with its n-th block or the first that comes too late."""

    def __init__(self, n: int, ms: int):
        self.n, self.ms = n, ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "win bigint, since bigint, n bigint, min_ms bigint, max_ms bigint, sum_ms bigint, bytes bigint")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        state, out = (list(self.open.get()) if self.open.exists() else None), []
        for t, height, took, size in sorted((int(r.t), int(r.height), int(r.ms), int(r.size)) for pdf in rows for r in pdf.itertuples()):
            win, since, n, least, most, total, moved = state or (0, t, 0, 0, 0, 0, 0)
            n, least, most, total, moved = n + 1, took if least == 0 or took < least else least, max(most, took), total + took, moved + size
            state = [win, since, n, least, most, total, moved]
            if n >= self.n or t - since >= self.ms:
                out.append((key[0], win, n, least, most, total / n, moved, height))
                state = [win + 1, t, 0, 0, 0, 0, 0]
        if state:
            self.open.update(tuple(state))
        yield pd.DataFrame(out, columns=["chain", "win", "n", "min_ms", "max_ms", "avg_ms", "bytes", "height"])

    def close(self) -> None:
        pass


def stream_ingest_stats(log: DataFrame, n: int = 100, seconds: int = 5) -> DataFrame:
    """The closed windows of ingest_stats(), for a stream (chain string, t in milliseconds, height, ms, size) that comes in order."""
    return log.groupBy("chain").transformWithStateInPandas(Monitor(n, seconds * 1000), "chain string, win bigint, n bigint, min_ms bigint, max_ms bigint, avg_ms double, bytes bigint, height bigint", "append", "none")


class Controller(StatefulProcessor):
    """The last minute's samples of one chain, the next window that is due and the level after the last one.

    A window is due once the watermark has passed its end; its timer fires even if no more rows come. Samples that no later
    window needs are dropped.
    """

    def __init__(self, width_ms: int, slide_ms: int):
        self.width, self.slide = width_ms, slide_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", "t bigint, ms bigint, ok boolean")
        self.level = handle.getValueState("level", "level int, next bigint")

    def _due(self, chain, more: list[tuple], watermark: int) -> pd.DataFrame:
        samples = sorted([*(tuple(x) for x in self.samples.get()), *more]) if self.samples.exists() else sorted(more)
        level, at = self.level.get() if self.level.exists() else (PARALLELISM[0], None)
        out = []
        first = lambda t: (t - self.width) // self.slide * self.slide + self.slide  # noqa: E731  the first window that has a time
        while samples:
            at = max(at, first(samples[0][0])) if at is not None else first(samples[0][0])
            if at + self.width > watermark:
                break
            inside = [s for s in samples if at <= s[0] < at + self.width]
            if inside:
                n, errors = len(inside), sum(not s[2] for s in inside)
                p95 = sorted(s[1] for s in inside)[n * 95 // 100] if n >= MIN_SAMPLES else None
                level = next_level(level, n, errors, p95)
                out.append((chain, pd.Timestamp(at, unit="ms"), n, errors, p95, level))
            at += self.slide
            samples = [s for s in samples if s[0] >= at]
        if samples:
            self.samples.put(samples)
            self.handle.registerTimer(at + self.width)
        else:
            self.samples.clear()
        self.level.update((level, at if at is not None else 0))
        frame = pd.DataFrame(out, columns=["chain", "win_start", "n", "errors", "p95", "parallelism"], dtype=object)
        return frame.assign(win_start=pd.to_datetime(frame.win_start))

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        more = [(int(t), int(ms), bool(ok)) for pdf in rows for t, ms, ok in zip(pdf.t, pdf.duration_ms, pdf.success)]
        yield self._due(key[0], more, timer_values.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 (names that Spark passes)
        yield self._due(key[0], [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def stream_controller(log: DataFrame, late: str = "1 minute", width_s: int = 60, slide_s: int = 5) -> DataFrame:
    """(chain, win_start, n, errors, p95, parallelism) of each sliding window of a stream (chain string, ts, duration_ms, success),
    exact, with the level carried from window to window, as controlled() has it for a table. Rows later than the watermark are left out."""
    rows = log.withWatermark("ts", late).withColumn("t", F.unix_millis("ts"))
    return rows.groupBy("chain").transformWithStateInPandas(Controller(width_s * 1000, slide_s * 1000), "chain string, win_start timestamp, n bigint, errors bigint, p95 bigint, parallelism int", "append", "EventTime")
