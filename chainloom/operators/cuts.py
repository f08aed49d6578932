"""Windows that each start where the one before ends, found without walking the order.

For every row it is known where the next window would start if one started there; which rows are real starts depends on all
before. Rows are numbered in a global order of keys and rows, so windows of all keys form one chain from row 0. Within blocks
of rows pointers are doubled until they leave the block; the few rows that are entered from other blocks form a shorter chain,
which is treated in the same way; with its real entries each block marks its own starts. A round handles all blocks at once,
and the number of rounds is the logarithm of the rows to the base of a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.operators.ordered import checkpointed, numbered, windowed

#: Rows of a block, and rows that a block may have to hold two jumps of the longest kind.
BLOCK, MOST = 1 << 16, 1 << 22


def located(rows: DataFrame, keys: tuple[str, ...], value: str, thresholds: dict[str, Column], inclusive: bool) -> DataFrame:
    """rows(_pos, ...) with, for each threshold, the global place of the first row of the key whose value is above it (from it on:
    inclusive=False), or the place after the key's last if there is none. Values must not fall within a key in the order of _pos.

    Rows and thresholds are sorted together; a threshold's place is the number of rows before it.
    """
    marks = rows.select(*keys, F.col(value).alias("_v"), F.lit(0 if inclusive else 1).alias("_kind"), "_pos", F.lit("").alias("_of"), F.lit(1).alias("_row"))
    asked = F.explode(F.array(*(F.struct(t.alias("_v"), F.lit(n).alias("_of")) for n, t in thresholds.items()))).alias("x")
    asked = rows.select(*keys, asked, "_pos").select(*keys, "x._v", F.lit(1 if inclusive else 0).alias("_kind"), "_pos", "x._of", F.lit(0).alias("_row"))
    found = windowed(marks.unionByName(asked), (*keys, "_v", "_kind", "_pos", "_of"), sums={"_found": "_row"}).where("_row = 0")
    found = found.groupBy("_pos").agg(*(F.max(F.when(F.col("_of") == n, F.col("_found"))).alias(n) for n in thresholds))
    return checkpointed(rows.join(found, "_pos"))


def key_changes(keys: tuple[str, ...], before: tuple[str, ...]) -> Column:
    """Whether a row's key is not that of the row before, in columns of windowed()'s lags; true for the first row."""
    same = F.col("_pos") > 0
    for k, b in zip(keys, before):
        same = same & F.col(k).eqNullSafe(F.col(b))
    return ~same


def _exits(t: pa.Table) -> pa.Table:
    """(_pos, _to) of a block with the first place outside it that each row's chain comes to."""
    pos, to = t.column("_pos").to_numpy(), t.column("_to").to_numpy()
    order = np.argsort(pos)
    pos, to = pos[order], to[order].copy()
    end = pos[-1] + 1
    while (inside := to < end).any():
        to[inside] = to[to[inside] - pos[0]]
    return pa.table([pos, to], names=["_pos", "_to"])


def _marks(t: pa.Table) -> pa.Table:
    """Of a block of (_pos, _to, _entry) the places on the chain from its entry."""
    pos, to, entry = (t.column(c).to_numpy(zero_copy_only=False) for c in ("_pos", "_to", "_entry"))
    order = np.argsort(pos)
    pos, to, entry = pos[order], to[order].tolist(), entry[order]
    out, first = [], int(pos[0])
    for at in pos[entry].tolist():
        while at - first < len(to):
            out.append(at)
            at = to[at - first]
    return pa.table([pa.array(out, pa.int64())], names=["_pos"])


def starts(jumps: DataFrame, block: int | None = None) -> DataFrame:
    """(_pos): the places on the chain from place 0 of jumps(_pos, _to), where places go from 0 without gaps and _to > _pos."""
    block, jumps = block or BLOCK, checkpointed(jumps.select("_pos", "_to"))
    n, longest = jumps.agg(F.count(F.lit(1)), F.max(F.col("_to") - F.col("_pos"))).first()
    if not n:
        return jumps.select("_pos")
    if 2 * longest > max(block, MOST):
        return _doubled(jumps, n)
    block = max(block, 2 * longest)
    number = F.floor(F.col("_pos") / block).cast("bigint").alias("_block")
    entries = jumps.sparkSession.range(1).select(F.col("id").alias("_pos"))
    if n > block:
        exits = checkpointed(jumps.groupBy(number).applyInArrow(_exits, "_pos bigint, _to bigint"))
        nodes = exits.where(F.col("_to") < n).select(F.col("_to").alias("_pos")).unionByName(entries).distinct()
        # Half of the rows at most, as a jump is at most half a block long.
        short = checkpointed(numbered(exits.join(nodes, "_pos", "left_semi"), ("_pos",), name="_rank"))
        ranks = short.select(F.col("_pos").alias("_to"), F.col("_rank").alias("_to_rank"))
        inner = short.join(ranks, "_to", "left").select(F.col("_rank").alias("_pos"), F.coalesce("_to_rank", F.lit(short.count())).alias("_to"))
        reached = starts(inner, block).withColumnRenamed("_pos", "_rank")
        entries = short.join(reached, "_rank").select("_pos")
    flagged = jumps.join(entries.withColumn("_entry", F.lit(True)), "_pos", "left").withColumn("_entry", F.coalesce("_entry", F.lit(False)))
    return flagged.groupBy(number).applyInArrow(_marks, "_pos bigint")


def _doubled(jumps: DataFrame, n: int) -> DataFrame:
    """starts() where jumps are long, so the chain is short: jumps of twice, four times ... the length, then all of them back."""
    levels = [jumps]
    while (levels[-1].where("_pos = 0").first()._to) < n:
        f = levels[-1]
        levels.append(checkpointed(f.join(f.select(F.col("_pos").alias("_to"), F.col("_to").alias("_next")), "_to", "left").select("_pos", F.coalesce("_next", F.lit(n)).alias("_to"))))
    reached = jumps.where("_pos = 0").select("_pos")
    for f in reversed(levels):
        reached = checkpointed(reached.unionByName(f.join(reached, "_pos").where(F.col("_to") < n).select(F.col("_to").alias("_pos"))))
    return reached


def numbered_windows(rows: DataFrame, jumps: DataFrame, keys: tuple[str, ...], name: str) -> DataFrame:
    """rows(_pos, keys, ...) with the number, from 0 in each key, of the window that each is in."""
    first = starts(jumps).withColumn("_start", F.lit(1))
    flagged = rows.join(first, "_pos", "left").withColumn("_start", F.coalesce("_start", F.lit(0)))
    counted = windowed(flagged, ("_pos",), sums={"_window": "_start"})
    if not keys:
        return counted.withColumn(name, (F.col("_window") - 1).cast("bigint"))
    # The first row of each key is a start, so what a key's windows are numbered from is known from the starts alone.
    before = tuple(f"_key{i}" for i in range(len(keys)))
    opened = windowed(counted.where("_start = 1").select("_pos", "_window", *keys), ("_pos",), lags=dict(zip(before, keys)))
    opened = opened.withColumn("_first", F.when(key_changes(keys, before), F.col("_window")))
    opened = windowed(opened, ("_pos",), tops={"_base": "_first"}).select("_window", (F.col("_window") - F.col("_base")).cast("bigint").alias(name))
    return counted.join(opened, "_window")
