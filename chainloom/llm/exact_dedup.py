"""Exact duplicates by an extendible-hash index whose bucket files lie in the shared folder.

Every row's hash, length and digest go to a log. Hashes that occur once need no more: such a row is its own group, and its
text is not shipped. The others are the keys of the index. Its directory maps the leading bits of the hash to buckets: it
starts with one slot and doubles while a bucket holds more keys than it may; slots that need no split go on sharing a bucket.
A bucket is a range of hashes with one owner task, which chains the texts that share a hash and compares their bytes, so two
texts with one hash stay apart. Copies are combined before they are sent to the owner, so a text that a third of all rows
share costs its owner some entries for each input task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import if_small, join_keyed, materialize, only_rows, small_batches

BLANKS = "[\\x20\\x09-\\x0D]"
#: Keys that a bucket may hold, and the directory's depth beyond which it is not split. Hashes of keys are distinct and evenly
#: spread, so a bucket at that depth is overfull only if there are 2**MAX_DEPTH times as many keys.
BUCKET_KEYS, MAX_DEPTH = 1 << 12, 20
#: Repeated hashes, of 8 bytes each, that may be broadcast to pick the texts that are shipped.
SENT_KEYS = 1 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def normal_digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def entries_of(docs: DataFrame, id_col: str, text_col: str, hash_of: Callable[[Column], Column]) -> DataFrame:
    """(id, n, norm, h) of each row: code points of the text, and the text without white space and its hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    entries = docs.select(F.col(id_col).alias("id"), F.length(text).alias("n"), normalised(F.col(text_col)).alias("norm"))
    return entries.withColumn("h", hash_of(F.col("norm")).cast("bigint"))


def build_directory(counts: dict[int, int], bucket_keys: int, max_depth: int = MAX_DEPTH) -> list[int]:
    """Bucket of each slot of the directory; counts: keys by the first max_depth bits of the hash.

    A bucket is named by its first slot at full depth. Doubling goes on while a bucket is overfull and not at max_depth.
    """
    full = np.zeros(1 << max_depth, np.int64)
    for prefix, n in counts.items():
        full[prefix] = n
    upto = np.concatenate(([0], np.cumsum(full)))
    bits, first = np.zeros(1, np.int64), np.zeros(1, np.int64)  # of each slot's bucket: its own depth, and its first slot
    for depth in range(max_depth + 1):
        # Every slot stands for 2**(max_depth - depth) places; a bucket of fewer bits than the directory has several slots.
        keys = upto[first + (1 << (max_depth - bits))] - upto[first]
        over = (keys > bucket_keys) & (bits == depth)
        if depth == max_depth or not over.any():
            break
        bits, first, over = (np.repeat(v, 2) for v in (bits, first, over))
        half = np.arange(len(bits)) & 1
        first = first + np.where(over, half << (max_depth - depth - 1), 0)
        bits = bits + over
    return np.repeat(first, (1 << max_depth) // len(first)).tolist()


def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of entries (bucket, h, norm, n, least, id, size) that come sorted by bucket and hash.

    The chain of a hash has one link for each text that differs in its bytes, so it has one unless hashes collide.
    """
    names = ["bucket", "h", "chain", "sha", "group_size", "keep_id"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
    last, chain, rows, id_type = None, {}, [], None

    def close() -> None:
        for norm, (rank, size) in chain.items():
            rows.append((*last, len(chain), hashlib.sha256(norm.encode("utf-8", "surrogatepass")).digest(), size, rank[2]))

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([*kinds, id_type])], names=names)
        rows.clear()
        return out

    for b in batches:
        id_type = b.schema.field("least").type
        for bucket, h, norm, n, unknown, least, size in zip(*(c.to_pylist() for c in b.columns)):
            if (bucket, h) != last:
                close()
                last, chain = (bucket, h), {}
            rank, so_far = chain.get(norm, (None, 0))
            new = (n, unknown, least)
            chain[norm] = (new if rank is None or new < rank else rank, so_far + size)
        if rows:
            yield flush()
    close()
    if rows:
        yield flush()


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = BUCKET_KEYS, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row for each row of docs: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical without ASCII white space; null counts as empty. Of equal texts the row with the most
    code points stays, then the smallest id (nulls last). Rows that repeat both an id and a text count in group_size each,
    and all are kept if their id is. Ids may be of any type that sorts. An empty table gives an empty result; other columns
    are ignored. Very long texts are hashed and compared whole.
    """
    spark = docs.sparkSession
    entries = entries_of(docs, id_col, text_col, hash_of)
    log = materialize(entries.select("id", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "dedup-log")
    keys = materialize(log.groupBy("h").count().where("count > 1"), "dedup-keys")

    depth = int(np.clip(int(keys.count() / bucket_keys).bit_length() + 2, 1, MAX_DEPTH))
    slot = F.shiftrightunsigned("h", 64 - depth)
    counts = {r[0]: r[1] for r in keys.groupBy(slot.alias("slot")).count().collect()}
    # At most 2**MAX_DEPTH slots, some for each bucket's worth of keys.
    directory = spark.createDataFrame(list(enumerate(build_directory(counts, bucket_keys, depth))), "slot bigint, bucket bigint")

    repeated = entries.join(if_small(keys.select("h"), SENT_KEYS), "h", "left_semi").withColumn("slot", slot).join(F.broadcast(directory), "slot")
    # A few entries of each text and input task, by a part of the id; then one row of each goes to the owner of its bucket.
    part = F.pmod(F.xxhash64("id"), F.lit(8))
    rank = F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("unknown"), F.col("id").alias("least"))
    combined = repeated.groupBy("bucket", "h", "norm", part.alias("part")).agg(F.min(rank).alias("r"), F.count(F.lit(1)).alias("size"))
    owned = combined.select("bucket", "h", "norm", "r.n", "r.unknown", "r.least", "size").repartition("bucket").sortWithinPartitions("bucket", "h")
    kind = docs.schema[id_col].dataType.simpleString()
    index = small_batches(owned).mapInArrow(chained, f"bucket bigint, h bigint, chain int, sha binary, group_size bigint, keep_id {kind}")
    index = materialize(index, "dedup-index")

    # One text for a hash: the hash finds its row, as its bytes were compared. Hashes that collide take the digest as well.
    single = join_keyed(log, index.where("chain = 1").select("h", "group_size", "keep_id", F.lit(True).alias("found"), F.col("group_size").alias("rows")), "h", "rows", "left")
    collided = index.where("chain > 1").select("h", "sha", F.col("group_size").alias("c_size"), F.col("keep_id").alias("c_keep"), F.lit(True).alias("c_found"))
    found = single.join(if_small(collided), ["h", "sha"], "left")
    keep = F.when(F.col("found"), F.col("keep_id")).when(F.col("c_found"), F.col("c_keep")).otherwise(F.col("id"))
    size = F.when(F.col("found"), F.col("group_size")).when(F.col("c_found"), F.col("c_size")).otherwise(F.lit(1)).cast("bigint")
    return found.select(F.col("id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with the rows that stay, decided by row: an id's other texts are not touched.

    Of rows that repeat both the id and the text, white space aside, of the row that stays, the longest one remains.
    """
    groups = duplicate_groups(docs, id_col, text_col, **how)
    return only_rows(docs, groups.select(F.col(id_col).alias("id"), F.unhex("text_sha256").alias("digest"), F.col("kept").alias("stays")), id_col, text_col, normal_digest)
