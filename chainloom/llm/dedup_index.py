"""The extendible-hash index of exact_dedup as files that stay: batches of documents probe and extend it.

A bucket is a range of hashes whose texts lie in one folder. A batch is sent to the owners of the buckets that it touches;
each owner chains what its bucket had and what came, compares bytes, and writes the bucket anew. A bucket that then holds more
keys than it may is split, and the directory doubles if the split needs a bit more than it has. Other buckets keep their files.
A version of the index names the files of all buckets and appears whole, so a batch that failed leaves nothing visible, and
one that comes again changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.llm.exact_dedup import MAX_DEPTH, entries_of
from chainloom.llm.shared import join_keyed, materialize, small_batches
from chainloom.sources.versions import VersionLog

#: Keys that a kept bucket may hold: more than one run's buckets, as each is a folder.
KEPT_KEYS = 1 << 16
COLUMNS = ("h", "norm", "n", "unknown", "least", "size")


def split(first: int, bits: int, upto: np.ndarray, depth: int, most: int) -> list[tuple[int, int, int]]:
    """(first slot, bits, keys) of what a bucket falls into so that none holds over `most` keys, or is at the given depth.

    First slots are of MAX_DEPTH bits; upto has the number of keys before each slot of `depth` bits, and that of all at its end.
    """
    at = first >> (MAX_DEPTH - depth)
    keys = int(upto[at + (1 << (depth - bits))] - upto[at])
    if keys <= most or bits == depth:
        return [(first, bits, keys)]
    upper = first + (1 << (MAX_DEPTH - bits - 1))
    return split(first, bits + 1, upto, depth, most) + split(upper, bits + 1, upto, depth, most)


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each text of entries (bucket, h, norm, n, unknown, least, size) that come sorted by bucket and hash: the
    first of its ranks (n, unknown, least), all its sizes, its place in the chain of its hash, and its digest."""
    last, chain, schema = None, {}, None

    def rows(b: pa.RecordBatch) -> Iterator[tuple]:
        nonlocal last, chain
        for bucket, h, norm, n, unknown, least, size in zip(*(c.to_pylist() for c in b.columns)):
            if (bucket, h) != last:
                yield from close()
                last, chain = (bucket, h), {}
            rank, so_far = chain.get(norm, (None, 0))
            new = (n, unknown, least)
            chain[norm] = (new if rank is None or new < rank else rank, so_far + size)

    def close() -> Iterator[tuple]:
        for place, (norm, (rank, size)) in enumerate(chain.items()):
            yield (*last, norm, *rank, size, place, hashlib.sha256(norm.encode("utf-8", "surrogatepass")).digest())

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    for b in batches:
        schema = schema or b.schema.append(pa.field("place", pa.int32())).append(pa.field("sha", pa.binary()))
        if found := list(rows(b)):
            yield batch(found)
    if found := list(close()):
        yield batch(found)


class DedupIndex:
    """The index under `root`, a folder that driver and executors share. Ids may be of any type that sorts, the same in every batch."""

    def __init__(self, spark: SparkSession, root: str, bucket_keys: int = KEPT_KEYS, hash_of: Callable[[Column], Column] = F.xxhash64):
        self.spark, self.root, self.bucket_keys, self.hash_of = spark, root.rstrip("/"), bucket_keys, hash_of
        self.log = VersionLog(spark, f"{self.root}/_versions")

    def _directory(self, buckets: dict[str, list]) -> tuple[DataFrame, int]:
        """(slot, bucket) for each slot, and the directory's depth: at most 2**MAX_DEPTH rows."""
        depth = max(1, *(bits for bits, *_ in buckets.values()))
        firsts = np.sort(np.array([int(b) for b in buckets], np.int64))
        slots = np.arange(1 << depth, dtype=np.int64)
        of_slot = firsts[np.searchsorted(firsts, slots << (MAX_DEPTH - depth), side="right") - 1]
        return self.spark.createDataFrame(pa.table({"slot": slots, "bucket": of_slot})), depth

    def _in_buckets(self, rows: DataFrame, buckets: dict[str, list]) -> DataFrame:
        directory, depth = self._directory(buckets)
        return rows.join(F.broadcast(directory), F.shiftrightunsigned("h", 64 - depth) == F.col("slot")).drop("slot")

    def _read(self, value: dict, touched: list[int]) -> DataFrame | None:
        paths = [f"{self.root}/{path}" for _, _, path in (value["buckets"].get(str(b), (0, 0, "")) for b in touched) if path]
        return self.spark.read.schema(value["schema"]).parquet(*paths) if paths else None

    def add(self, batch_id: int, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
        """Extend the index by a batch; returns the buckets that were written. A batch id that is not above the last one's
        changes nothing. Texts are equal, and of equal ones a row stays, as in duplicate_groups()."""
        number, value = self.log.latest()
        if number and batch_id <= value["batch"]:
            return []
        buckets: dict[str, list] = dict(value.get("buckets") or {"0": [0, 0, ""]})
        # A few entries of each text: copies are combined before anything goes to an owner.
        part = F.pmod(F.xxhash64("id"), F.lit(8))
        rank = F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("unknown"), F.col("id").alias("least"))
        combined = entries_of(docs, id_col, text_col, self.hash_of).groupBy("h", "norm", part.alias("part")).agg(F.min(rank).alias("r"), F.count(F.lit(1)).alias("size"))
        staged = f"{self.root}/_staged/{uuid.uuid4().hex}"
        self._in_buckets(combined.select("h", "norm", "r.n", "r.unknown", "r.least", "size"), buckets).write.option("compression", "zstd").parquet(staged)
        batch = self.spark.read.parquet(staged)
        touched = sorted(r[0] for r in batch.select("bucket").distinct().collect())  # at most all buckets
        written: list[tuple[int, int, int]] = []
        if touched:
            before, rows = self._read(value, touched) if number else None, batch.select(*COLUMNS)
            rows = rows if before is None else rows.unionByName(before.select(*COLUMNS))
            keys = rows.select("h").distinct()
            most = sum(n for _, n, _ in buckets.values()) + batch.count()
            depth = int(np.clip(max(int(most / self.bucket_keys).bit_length() + 2, max(bits for bits, *_ in buckets.values())), 1, MAX_DEPTH))
            full = np.zeros((1 << depth) + 1, np.int64)  # at most 2**MAX_DEPTH slots
            for slot, n in keys.groupBy(F.shiftrightunsigned("h", 64 - depth).alias("slot")).count().collect():
                full[slot + 1] = n
            upto = np.cumsum(full)
            for b in touched:
                written += split(b, buckets.pop(str(b))[0], upto, depth, self.bucket_keys)
            folder = f"data/{number + 1:08d}-{uuid.uuid4().hex}"
            buckets |= {str(first): [bits, n, f"{folder}/bucket={first}" if n else ""] for first, bits, n in written}
            owned = self._in_buckets(rows, buckets).select("bucket", *COLUMNS).repartition("bucket").sortWithinPartitions("bucket", "h")
            kind = docs.schema[id_col].dataType.simpleString()
            stored = f"h bigint, norm string, n int, unknown boolean, least {kind}, size bigint, place int, sha binary"
            small_batches(owned).mapInArrow(merged, f"bucket bigint, {stored}").write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.root}/{folder}")
            value = {"schema": stored}
        self.log.commit(number + 1, {"batch": batch_id, "buckets": buckets, "schema": value.get("schema", "")})
        self.log.delete(staged)
        return [first for first, _, n in written if n]

    def groups(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row for each row of docs, as from duplicate_groups() over all batches so far: (id, keep_id, group_size, kept,
        text_sha256). Reads only the buckets that the rows' hashes are in. A text that the index does not have gives a null
        keep_id, a size of 0 and a null kept."""
        number, value = self.log.latest()
        entries = entries_of(docs, id_col, text_col, self.hash_of).select("id", "h", F.unhex(F.sha2("norm", 256)).alias("sha"))
        rows = materialize(self._in_buckets(entries, value["buckets"] if number else {"0": [0, 0, ""]}), "dedup-probes")
        touched = sorted(r[0] for r in rows.select("bucket").distinct().collect())  # at most all buckets
        known = self._read(value, touched) if number else None
        if known is None:
            found = rows.withColumns({"least": F.lit(None).cast(docs.schema[id_col].dataType), "size": F.lit(None).cast("bigint")})
        else:
            probes = rows.groupBy("h", "sha").agg(F.count(F.lit(1)).alias("n_rows"))
            hits = materialize(probes.join(known.select("h", "sha", "least", "size"), ["h", "sha"]).select("sha", "least", "size", "n_rows"), "dedup-hits")
            found = join_keyed(rows, hits, "sha", "n_rows", "left")
        kept = F.when(F.col("size").isNotNull(), F.col("id").eqNullSafe(F.col("least")))
        return found.select(F.col("id").alias(id_col), F.col("least").alias("keep_id"), F.coalesce("size", F.lit(0)).cast("bigint").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all but the last versions and delete the folders that none of those names, while nothing else uses the index."""
        versions = self.log.versions()
        for v in versions[:-keep]:
            self.log.forget(v)
        used = {path.split("/")[1] for v in versions[-keep:] for _, _, path in self.log.read(v)["buckets"].values() if path}
        gone = [f for f in self.log.folders(f"{self.root}/data") if f not in used]
        for f in gone:
            self.log.delete(f"{self.root}/data/{f}")
        return gone
