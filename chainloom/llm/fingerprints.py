"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last WINDOW bytes cuts a text: a place ends a piece of block size 2**k if the hash has k zero bits at its
end, so the cuts of a block size are among those of the half of it, and an edit moves cuts near it only. The block size follows
from the length, so that some PIECES / 2 to PIECES pieces are expected; each piece gives one of 64 letters. The fingerprint has the letters at that block size
and at twice it, so that texts whose block sizes differ by a factor of two can still be compared: by the edit distance of the
letters at a block size that both have.

Neighbours in the order of ids meet within range partitions; of the rows at the partitions' ends, two a partition, the texts
are kept and joined with each other afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainloom.llm.shared import if_small, materialize, small_batches

#: Bytes that the rolling hash sees; pieces that a text should have at most by its length; cuts above and below which a text that
#: repeats itself takes other block sizes.
WINDOW, PIECES, MOST, LEAST = 8, 64, 256, 16
#: Bytes hashed at once.
BLOCK = 1 << 16
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
#: Odd multipliers: of the window's bytes, by their distance from its end, and of the hash when its bits are mixed.
_P, _P2, _P4 = (np.uint32(pow(0x9E3779B1, n, 1 << 32)) for n in (1, 2, 4))
_MIX = np.uint32(0x85EBCA6B)


def rolling(data: np.ndarray) -> np.ndarray:
    """The mixed hash of the WINDOW bytes that end at each place; before the text there are zeros."""
    out = np.empty(len(data), np.uint32)
    for at in range(0, len(data), BLOCK):
        low = max(0, at - WINDOW + 1)
        h = data[low : at + BLOCK].astype(np.uint32) + np.uint32(1)
        for step, factor in ((1, _P), (2, _P2), (4, _P4)):
            h[step:] += h[:-step] * factor
        h ^= h >> np.uint32(15)
        h *= _MIX
        h ^= h >> np.uint32(13)
        out[at : at + BLOCK] = h[at - low :]
    return out


def cuts(h: np.ndarray, k: int) -> np.ndarray:
    """Places whose hash ends in k zero bits; none beyond the bits of a hash."""
    return np.flatnonzero((h & np.uint32((1 << k) - 1)) == 0) if k <= 32 else np.zeros(0, np.int64)


def letters(h: np.ndarray, ends: np.ndarray) -> str:
    """A letter for each piece between cuts, and for what follows the last."""
    starts = np.concatenate(([0], ends + 1))
    starts = starts[starts < len(h)]
    sums = np.add.reduceat(h, starts, dtype=np.uint32) if len(starts) else h[:0]
    return LETTERS[(sums * _P) >> np.uint32(26)].tobytes().decode()


def fingerprint(raw: bytes) -> str:
    """'block size:letters:letters at twice the block size' of a text in UTF-8."""
    h = rolling(np.frombuffer(raw, np.uint8))
    k = (len(h) // PIECES).bit_length()
    found = cuts(h, k)
    while len(found) > MOST:
        k += 1
        found = found[cuts(h[found], k)]
    while len(found) < LEAST and k and len(finer := cuts(h, k - 1)) <= MOST:
        k, found = k - 1, finer
    return f"{1 << k}:{letters(h, found)}:{letters(h, found[cuts(h[found], k + 1)])}"


def edited(text: str, other: str) -> str:
    """text with the last half of its code points, rounded down, replaced by the first as many of the other, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: one less the edit distance of two fingerprints' letters, of the length of the longer, at a block size that
    both have; the better of two such sizes. 1 for equal fingerprints, 0 without a common block size."""
    x, y = F.split(a, ":"), F.split(b, ":")

    def alike(s: Column, t: Column) -> Column:
        most = F.greatest(F.length(s), F.length(t))
        return F.when(most == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(s, t) / most.cast("double"))

    size = lambda p: F.get(p, F.lit(0)).cast("bigint")
    one, two = (lambda p: F.get(p, F.lit(1))), (lambda p: F.get(p, F.lit(2)))
    return (
        F.when(a == b, F.lit(1.0))
        .when(size(x) == size(y), F.greatest(alike(one(x), one(y)), alike(two(x), two(y))))
        .when(size(x) == 2 * size(y), alike(one(x), two(y)))
        .when(size(y) == 2 * size(x), alike(two(x), one(y)))
        .otherwise(F.lit(0.0))
    )


def _result(row_id: pa.Scalar, text: str, own: str, after: str, next_print: str) -> tuple:
    new = edited(text, after).encode()
    return row_id.as_py(), len(text), hashlib.sha256(new).hexdigest(), own, fingerprint(new), next_print, None, None, None


NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint", "part", "is_last", "text"]


def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a partition's rows (id, text) in order but the last; and its first and its last row with their texts."""
    part, before, kinds = TaskContext.get().partitionId(), None, [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.bool_(), pa.string()]
    id_type = None
    for b in batches:
        id_type, rows = b.column(0).type, []
        for row_id, text in zip(b.column(0), b.column(1)):
            text = text.as_py() or ""
            # Rows of one text in a row have one fingerprint; it is made once.
            own = before[2] if before is not None and before[1] == text else fingerprint(text.encode())
            if before is None:
                rows.append((row_id.as_py(), len(text), None, own, None, None, part, False, text))
            else:
                rows.append(_result(*before, text, own))
            before = row_id, text, own
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate([id_type, *kinds])], names=NAMES)
    if before is not None:
        row = (before[0].as_py(), len(before[1]), None, before[2], None, None, part, True, before[1])
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, [id_type, *kinds])], names=NAMES)


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the partitions' last rows (id, text, fingerprint, next text, next fingerprint)."""
    for b in batches:
        rows = [_result(i, t.as_py(), f.as_py(), a.as_py(), n.as_py())[:6] for i, t, f, a, n in zip(*b.columns)]
        kinds = [b.column(0).type, pa.int64(), *[pa.string()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=NAMES[:6])


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document is the next row by ascending id; after the last comes the first, and a single row is its own next. Null
    ids come last. Rows that repeat an id are in the order of their texts, so those that repeat both are each other's next; they
    stream through one task, which holds two of them. Null texts count as empty, whose fingerprint is '1::'. Texts are read whole, other columns are
    ignored, and an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text").asc()]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    made = materialize(small_batches(parts).mapInArrow(in_order, f"{schema}, part bigint, is_last boolean, text string"), "fingerprints")

    ends = made.where(F.col("part").isNotNull())
    # Of each partition that has rows the next such, one row a partition; the last one's next is the first.
    numbers = Window.orderBy("part")
    firsts = ends.where(~F.col("is_last")).select("part")
    following = firsts.withColumns({"to": F.lead("part").over(numbers), "start": F.first("part").over(numbers)}).select("part", F.coalesce("to", "start").alias("to"))
    last = ends.where("is_last").join(if_small(following), "part").select("id", F.col("text").alias("own"), "fingerprint", "to")
    after = ends.where(~F.col("is_last")).select(F.col("part").alias("to"), F.col("text").alias("after"), F.col("fingerprint").alias("next_fingerprint"))
    pairs = last.join(after, "to").select("id", "own", "fingerprint", "after", "next_fingerprint")
    out = made.where(F.col("edited_sha256").isNotNull()).select(*NAMES[:6]).unionByName(small_batches(pairs).mapInArrow(joined, schema))
    near = [likeness(F.col("fingerprint"), F.col(c)).alias(n) for c, n in (("edited_fingerprint", "near_edited"), ("next_fingerprint", "near_next"))]
    return out.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *near)
