"""Order of blocks, watermarks, progress and measurements of ingestion, and the timestamp dimension."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainloom.operators import cuts
from chainloom.operators.ordered import lagged, numbered, running_sum, windowed

#: Fixed values of the request controller: errors in a window above which load halves, wanted p95 in milliseconds, samples
#: that a decision needs, and bounds of the recommended parallelism (a tenth of the most, and the most).
MAX_ERRORS, MAX_P95_MS, MIN_SAMPLES, PARALLELISM = 10, 1000, 10, (20, 200)


def check_sequence(df: DataFrame, order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose number is not the one before plus one, with `previous`: gaps, repeats and disorder of each key."""
    rows = lagged(df.select(*keys, order), order, (order,), keys)
    return rows.where(F.col("previous").isNotNull() & (F.col(order) != F.col("previous") + 1))


def global_watermark(marks: DataFrame, keys: tuple[str, ...] = ("chain",), height: str = "height") -> DataFrame:
    """The lowest height that all consumers of a chain have reached."""
    return marks.groupBy(*keys).agg(F.min(height).alias("watermark"))


def rows_after_watermark(df: DataFrame, marks: DataFrame, key: str = "chain", df_height: str = "block_number", height: str = "height", consumer: str = "indexer") -> DataFrame:
    """Rows for each consumer above its own mark; marks has a row a consumer and chain."""
    m = marks.select(key, F.col(consumer), F.col(height).alias("_mark"))
    return df.join(m, key).where(F.col(df_height) > F.col("_mark")).drop("_mark")


def sync_progress(marks: DataFrame, heads: DataFrame, key: str = "chain", rate: Column | None = None) -> DataFrame:
    """Indexed and newest height of each chain, blocks behind (never negative), percent, and seconds left at the rate."""
    done = marks.groupBy(key).agg(F.min("height").alias("indexed"))
    out = done.join(heads.groupBy(key).agg(F.max("height").alias("head")), key)
    out = out.withColumn("behind", F.greatest(F.lit(0).cast("bigint"), F.col("head") - F.col("indexed")))
    return out if rate is None else out.withColumn("eta_seconds", F.when(rate > 0, F.col("behind") / rate))


def ingest_stats_by_count(log: DataFrame, order: str, ms: str, size: str, n: int = 100, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per window of n blocks of each key: count, least, largest and total milliseconds, and bytes."""
    rows = numbered(log, (order,), keys, "win").withColumn("win", F.floor(F.col("win") / n).cast("bigint"))
    return rows.groupBy(*keys, "win").agg(F.count(F.lit(1)).alias("n"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"), F.sum(ms).alias("sum_ms"), F.sum(size).alias("bytes"))


def ingest_stats_by_time(log: DataFrame, ts: str, ms: str, size: str, width: str = "5 seconds") -> DataFrame:
    """As ingest_stats_by_count, per window of time; works on a stream with a watermark."""
    return log.groupBy(F.window(ts, width)).agg(F.count(F.lit(1)).alias("n"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"), F.avg(ms).alias("avg_ms"), F.sum(size).alias("bytes"))


def request_health(log: DataFrame, ts: str = "ts", ms: str = "duration_ms", ok: str = "success", keys: tuple[str, ...] = ("chain",), width: str = "60 seconds", slide: str = "5 seconds", current: Column | None = None) -> DataFrame:
    """Sliding windows with n, errors, p95 (the sample at index floor(0.95 n) in order) and the recommended parallelism.

    A window holds a minute of one chain's requests; the rank within it comes from a window function, so no list of samples
    is gathered. Less than MIN_SAMPLES samples give no p95 and no change.
    """
    low, high = PARALLELISM
    now = F.lit(low) if current is None else current
    rows = log.select(*keys, F.explode(F.array(F.window(ts, width, slide))).alias("w"), F.col(ms).alias("_ms"), F.col(ok).alias("_ok"))
    by = [*keys, "w"]
    ranked = rows.withColumn("i", F.row_number().over(Window.partitionBy(*by).orderBy("_ms")) - 1).withColumn("c", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    at = F.when(F.col("i") == F.floor(F.col("c") * F.lit(95) / F.lit(100)), F.col("_ms"))
    out = ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("_ok"), 0).otherwise(1)).alias("errors"), F.max(at).alias("p"))
    p95 = F.when(F.col("n") >= MIN_SAMPLES, F.col("p"))
    # Growth below half the wanted p95: the further below, the faster, from 1 to 20.
    share = F.col("p").cast("double") / (MAX_P95_MS / 2)
    room = F.least(F.lit(20), F.greatest(F.lit(1), F.floor(1.0 / (share + 0.1))))
    advice = F.when(p95.isNull(), now).when(F.col("errors") > MAX_ERRORS, F.floor(now / 2)).when(p95 > MAX_P95_MS, now - 2).when(p95 < MAX_P95_MS / 2, now + room).otherwise(now)
    return out.select(*keys, F.col("w.start").alias("win_start"), "n", "errors", p95.alias("p95"), F.least(F.lit(high), F.greatest(F.lit(low), advice)).cast("int").alias("parallelism"))


def controlled(health: DataFrame, keys: tuple[str, ...] = ("chain",)) -> DataFrame:
    """request_health()'s windows with the parallelism that the controller has after each, from its least on: a window's advice
    starts from the level before. A key's windows pass through one task in order, with the level as its only state; they are a row
    for each slide, however many requests there are."""
    columns = [*keys, "win_start", "n", "errors", "p95"]
    kinds = {f.name: f.dataType.simpleString() for f in health.schema.fields}

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, level = None, PARALLELISM[0]
        for pdf in batches:
            out = []
            for *key, _, n, errors, p95 in pdf[columns].itertuples(index=False):
                if key != at:
                    at, level = key, PARALLELISM[0]
                level = next_level(level, int(n), int(errors), None if pd.isna(p95) else float(p95))
                out.append(level)
            yield pdf[columns].assign(parallelism=out)

    rows = health.select(columns).repartition(*keys).sortWithinPartitions(*keys, "win_start")
    return rows.mapInPandas(walk, ", ".join(f"{c} {kinds[c]}" for c in columns) + ", parallelism int")


def next_level(level: int, n: int, errors: int, p95: float | None) -> int:
    """The controller's parallelism after a look at a window of n requests."""
    low, high = PARALLELISM
    if n >= MIN_SAMPLES:
        if errors > MAX_ERRORS:
            level //= 2
        elif p95 > MAX_P95_MS:
            level -= 2
        elif p95 < MAX_P95_MS / 2:
            level += min(20, max(1, int(1.0 / (p95 / (MAX_P95_MS / 2) + 0.1))))
    return min(high, max(low, level))


def consumer_metrics(frames: DataFrame, ts: str = "ts", width_s: int = 1) -> DataFrame:
    """Per report of a frame log(ts in seconds, blocks, bytes, txs): what came in its window, and totals and rates up to it.

    (window, batches, blocks, bytes, txs, total_blocks, total_txs, recent_rate, avg_rate): blocks a second since the last
    window that had any (the first: over the window itself), and since the log began.
    """
    start = frames.agg(F.min(ts)).first()[0] or 0
    by = frames.groupBy(F.floor((F.col(ts) - start) / width_s).cast("bigint").alias("window")).agg(F.count(F.lit(1)).alias("batches"), F.sum("blocks").alias("blocks"), F.sum("bytes").alias("bytes"), F.sum("txs").alias("txs"))
    by = windowed(by, ("window",), lags={"previous": "window"}, sums={"total_blocks": "blocks", "total_txs": "txs"})
    recent = (F.col("window") - F.coalesce("previous", F.lit(-1))) * width_s
    return by.withColumns({"recent_rate": F.col("blocks") / recent, "avg_rate": F.col("total_blocks") / ((F.col("window") + 1) * width_s)}).drop("previous")


def export_range(exported: DataFrame, heads: DataFrame, keys: tuple[str, ...] = ("chain",), batch: int = 1000) -> DataFrame:
    """(keys, first, last, full): the next blocks to export of each key, from the one after the last exported (0 where there is
    none) to a batch further or the newest; keys that are caught up have no row. full: whether there may be more at once."""
    last = heads.groupBy(*keys).agg(F.max("height").alias("head"))
    rows = last.join(exported.groupBy(*keys).agg(F.max("height").alias("done")), list(keys), "left")
    first = F.coalesce(F.col("done") + 1, F.lit(0).cast("bigint"))
    rows = rows.withColumn("first", first).where(F.col("first") <= F.col("head")).withColumn("last", F.least(F.col("first") + batch - 1, F.col("head")))
    return rows.select(*keys, "first", "last", (F.col("last") - F.col("first") + 1 == batch).alias("full"))


def duration_histogram(log: DataFrame, ms: str, bounds: list[float]) -> DataFrame:
    """(bucket, n): values up to each bound, and above the last; bucket is the bound's place."""
    place = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(ms)))
    return log.groupBy(place.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def frames_by_size(df: DataFrame, key: str, order: str, size: str, most: int) -> DataFrame:
    """(key, order, size, frame): consecutive rows of a key in frames of at most `most` bytes; a larger row is a frame alone.

    Where a frame would start next follows for each row from running sums; cuts.starts() finds the real starts. Null sizes
    count as nothing; rows of a key that share an order are in the order of their size.
    """
    by = (key, order, size)
    rows = windowed(df.select(*by).withColumn("_size", F.coalesce(F.col(size).cast("bigint"), F.lit(0).cast("bigint"))), by, number="_pos", sums={"_upto": "_size"})
    rows = cuts.located(rows, (key,), "_upto", {"_found": F.col("_upto") - F.col("_size") + most}, inclusive=True)
    jumps = rows.select("_pos", F.greatest(F.col("_pos") + 1, F.col("_found")).alias("_to"))
    return cuts.numbered_windows(rows, jumps, (key,), "frame").select(*by, "frame")


def ingest_stats(log: DataFrame, ts: str, ms: str, size: str, n: int = 100, seconds: int = 5, order: tuple[str, ...] = (), keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, win, n, min_ms, max_ms, avg_ms, bytes, height, closed): the monitor's windows of each key, which close with the n-th
    block or with the first that comes `seconds` or more after the last window closed (the first: after its own first block).

    log has whole milliseconds in ts; blocks of one time are in the given order. height is the last block's, by the first column of
    the order if one is given. The rule of the least time holds as it is: a zero is replaced by what comes next. The last window
    of a key may still be open. Rows without a time are left out.
    """
    by, before = (*keys, ts, *order), tuple(f"_key{i}" for i in range(len(keys)))
    rows = windowed(log.where(F.col(ts).isNotNull()).select(*dict.fromkeys((*by, ms, size))), by, number="_pos", lags={"_last": ts, **dict(zip(before, keys))})
    rows = rows.withColumn("_due", F.when(cuts.key_changes(keys, before), F.col(ts)).otherwise(F.col("_last")) + seconds * 1000)
    rows = cuts.located(rows, keys, ts, {"_found": F.col("_due"), "_end": F.lit((1 << 63) - 1)}, inclusive=False)
    to = F.least(F.col("_pos") + n, F.greatest(F.col("_pos"), F.col("_found")) + 1, F.col("_end"))
    jumps = rows.select("_pos", to.alias("_to"))
    rows = cuts.numbered_windows(rows, jumps, keys, "win")
    zero = F.max(F.when(F.col(ms) == 0, F.col("_pos"))).over(Window.partitionBy(*keys, "win"))
    rows = rows.withColumn("_zero", zero)  # a window has n rows at most
    least = F.coalesce(F.min(F.when(F.col("_zero").isNull() | (F.col("_pos") > F.col("_zero")), F.col(ms))), F.lit(0))
    out = rows.groupBy(*keys, "win").agg(
        F.count(F.lit(1)).alias("n"), least.alias("min_ms"), F.max(ms).alias("max_ms"), F.avg(ms).alias("avg_ms"), F.sum(size).alias("bytes"), F.max_by((order or (ts,))[0], "_pos").alias("height"),
        ((F.count(F.lit(1)) == n) | (F.max(ts) >= F.min_by("_due", "_pos"))).alias("closed"),
    )
    return out


def build_timestamp_dim(vertices: DataFrame, txs: DataFrame) -> DataFrame:
    """(id, ts): ids of both, a transaction's time where both have it, the smaller of several."""
    both = vertices.select("id", "ts", F.lit(1).alias("rank")).unionByName(txs.select("id", "ts", F.lit(0).alias("rank")))
    return both.groupBy("id").agg(F.min(F.struct("rank", "ts")).alias("m")).select("id", "m.ts")


def prefix_counts(ids: DataFrame, col: str = "id", low: int = 3, high: int = 8, unit: int = 1) -> DataFrame:
    """(len, n, distinct) for each prefix length; unit: characters for each unit of length (2 for hex text).

    Each id is counted at its longest prefix first; the shorter prefixes are counted from those, ever fewer, rows.
    """
    n = ids.select(col).distinct().count()
    level = ids.select(F.substring(col, 1, high * unit).alias("p")).distinct()
    out = None
    for size in range(high, low - 1, -1):
        level = level.select(F.substring("p", 1, size * unit).alias("p")).distinct()
        row = level.agg(F.lit(size).alias("len"), F.lit(n).cast("bigint").alias("n"), F.count(F.lit(1)).alias("n_distinct"))
        out = row if out is None else out.unionByName(row)
    return out


def min_unique_prefix(ids: DataFrame, col: str = "id", low: int = 3, high: int = 8, unit: int = 1) -> int:
    """The shortest prefix length at which no two ids clash."""
    found = prefix_counts(ids, col, low, high, unit).where("n = n_distinct").agg(F.min("len")).first()[0]
    if found is None:
        raise ValueError(f"ids clash even at {high}")
    return found


def delta_encode(dim: DataFrame, order: tuple[str, ...] = ("ts", "id"), ts: str = "ts", keys: tuple[str, ...] = ()) -> DataFrame:
    """dim with delta, the time since the row before (its own time for the first)."""
    rows = lagged(dim, ts, order, keys, "delta")
    return rows.withColumn("delta", F.col(ts) - F.coalesce("delta", F.lit(0).cast("bigint")))


def delta_decode(encoded: DataFrame, order: str = "pos", keys: tuple[str, ...] = ()) -> DataFrame:
    """encoded with ts, the running sum of delta in order."""
    return running_sum(encoded, "delta", (order,), keys, "ts")


def fix_timestamps(txs: DataFrame, dim: DataFrame, id_col: str = "tx_id", ts_col: str = "ts", on_missing: str = "keep") -> DataFrame:
    """txs with the dimension's times; without one the time is kept, or the job fails (on_missing='error')."""
    d = dim.select(F.col("id").alias(id_col), F.col("ts").alias("_ts"))
    out = txs.join(d, id_col, "left")
    missing = F.raise_error(F.concat(F.lit("no time for "), F.col(id_col).cast("string"))).cast("bigint") if on_missing == "error" else F.col(ts_col)
    return out.withColumn(ts_col, F.when(F.col("_ts").isNotNull(), F.col("_ts")).otherwise(missing)).drop("_ts")
