"""A keyed table that batches are merged into: buckets of keys, copy on write, and versions.

A row's bucket is a hash of its key. A batch reads and writes only the buckets that it touches; the new version names the new
files of those and the old files of all others, and appears at once. A reader has one whole version, whatever is written
meanwhile; a batch that is run again after it was committed changes nothing, and one that failed has left nothing visible.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.operators.utxo import fan_out_chains, merge_spend
from chainloom.sources.versions import VersionLog

Combine = Callable[[DataFrame], DataFrame]
SEQ = "_seq"


def last_given(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Column by column the last value that is not null, in the order of the batches."""
    rest = [c for c in rows.columns if c not in (*keys, SEQ)]
    return rows.groupBy(*keys).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(SEQ))).alias(c) for c in rest))


@dataclass
class MergeStore:
    """The table under `root`; how many buckets it has is fixed with its first version."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    buckets: int = 256

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self.log = VersionLog(self.spark, f"{self.root}/_versions")

    def _bucket(self, value: dict) -> Column:
        """The bucket of a row in the version, by the hash that repartition() goes by: see merge()."""
        number = F.hash if value.get("hash", "" if value else "hash") == "hash" else F.xxhash64  # versions of older tables name none
        return F.pmod(number(*self.keys), F.lit(value.get("buckets", self.buckets))).cast("int").alias("_bucket")

    def _rows(self, value: dict, only: set[str] | None = None) -> DataFrame | None:
        paths = sorted({f"{self.root}/{p}" for b, p in value.get("files", {}).items() if only is None or b in only})
        return self.spark.read.schema(T.StructType.fromJson(json.loads(value["schema"]))).parquet(*paths) if paths else None

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, the last by default; None before the first."""
        number, value = self.log.latest() if version is None else (version, self.log.read(version))
        return self._rows(value) if number else None

    def read_keys(self, keys: DataFrame) -> DataFrame | None:
        """The rows of some keys, from the buckets that may have them."""
        number, value = self.log.latest()
        if not number:
            return None
        wanted = {str(r[0]) for r in keys.select(self._bucket(value)).distinct().collect()}  # at most all buckets
        rows = self._rows(value, wanted)
        return rows.join(keys.select(*self.keys).distinct(), list(self.keys), "left_semi") if rows is not None else None

    def merge(self, batch_id: int, updates: DataFrame, combine: Combine | None = None, stored: bool = False) -> int:
        """Merge a batch and return the version that has it. combine: one row for each key of rows with SEQ, 0 for what is there
        and 1 for the batch; by default last_given(). A batch id that is not above the last one's changes nothing.

        A batch may have several rows of a key; combine must say which of them counts, if it matters. A batch is staged, as it is
        read twice; stored says that it comes from files and gives the same rows each time, and need not be.

        Rows are shuffled once, by key: combine finds a key's rows in one task, and as the number of tasks is a multiple of that of
        buckets and both go by one hash, a task's rows are of one bucket.
        """
        number, value = self.log.latest()
        if number and batch_id <= value["batch"]:
            return number
        n, bucket = value.get("buckets", self.buckets), self._bucket(value)
        staged = f"{self.root}/_staged/{uuid.uuid4().hex}"
        if not stored:
            updates.write.option("compression", "zstd").parquet(staged)
            updates = self.spark.read.schema(updates.schema).parquet(staged)
        seen = lambda rows: sorted(str(r[0]) for r in rows.select(bucket).distinct().collect())  # at most all buckets
        # If a few rows touch every bucket, the others need not be asked.
        touched = seen(updates.limit(64 * n))
        touched = touched if len(touched) == n else seen(updates)
        hash_name = value.get("hash", "") if value else "hash"
        if touched:
            rows = updates.withColumn(SEQ, F.lit(1))
            before = self._rows(value, set(touched)) if number else None
            if before is not None:
                rows = before.withColumn(SEQ, F.lit(0)).unionByName(rows, allowMissingColumns=True)
            tasks = n * -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // n)
            merged = (combine or (lambda r: last_given(r, self.keys)))(rows.repartition(tasks, *self.keys))
            folder = f"data/{number + 1:08d}-{uuid.uuid4().hex}"
            merged.withColumn("_bucket", bucket).sortWithinPartitions("_bucket", *self.keys).write.partitionBy("_bucket").option("compression", "zstd").parquet(f"{self.root}/{folder}")
            # Columns that only other buckets have stay in the table's schema.
            fields = {f.name: T.StructField(f.name, f.dataType) for f in (*(T.StructType.fromJson(json.loads(value["schema"])) if value.get("schema") else ()), *merged.schema)}
            value = {"files": value.get("files", {}) | {b: f"{folder}/_bucket={b}" for b in touched}, "schema": json.dumps(T.StructType(list(fields.values())).jsonValue())}
        self.log.commit(number + 1, {"files": value.get("files", {}), "schema": value.get("schema", ""), "batch": batch_id, "buckets": n, "hash": hash_name})
        if not stored:
            self.log.delete(staged)
        return number + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all but the last versions, and delete the folders that none of those names: nothing may read older ones, and no
        merge may run meanwhile. The deleted folders' names."""
        versions = self.log.versions()
        for v in versions[:-keep]:
            self.log.forget(v)
        used = {p.split("/")[1] for v in versions[-keep:] for p in self.log.read(v)["files"].values()}
        gone = [f for f in self.log.folders(f"{self.root}/data") if f not in used]
        for f in gone:
            self.log.delete(f"{self.root}/data/{f}")
        return gone


UTXO_KEYS = ("store_chain", "utxo_id")


def utxo_store(spark: SparkSession, root: str, buckets: int = 256) -> MergeStore:
    return MergeStore(spark, root, UTXO_KEYS, buckets)


def merge_utxos(store: MergeStore, batch_id: int, outputs: DataFrame | None, spend_rows: DataFrame | None) -> int:
    """Merge a batch of outputs and of spends (rows of spends() and import_spends()). A spend may come before its output, or in
    any order among an output's spends: the one of the highest order_key counts."""
    parts = []
    if outputs is not None:
        parts.append(fan_out_chains(outputs))
    if spend_rows is not None:
        rest = [c for c in spend_rows.columns if c not in (*UTXO_KEYS, "order_key")]
        parts.append(spend_rows.select(*UTXO_KEYS, F.struct("order_key", F.struct(*rest).alias("values")).alias("spend")))
    if not parts:
        raise ValueError("a batch has outputs or spends")
    updates = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    def combine(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (*UTXO_KEYS, SEQ, "spend")]
        spend = [F.max_by("spend", "spend.order_key").alias("spend")] if "spend" in rows.columns else []
        # Of an output that comes again every column's last given value counts; an output's own columns are known by its amount.
        return rows.groupBy(*UTXO_KEYS).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(SEQ))).alias(c) for c in rest), *spend)

    return store.merge(batch_id, updates, combine)


def stored_utxos(store: MergeStore, known: str = "amount") -> DataFrame | None:
    """The UTXO table of the last version: outputs with the latest spend of each. Spends whose output has not come are left out."""
    rows = store.read()
    if rows is None or known not in rows.columns:
        return None
    made = rows.where(F.col(known).isNotNull())
    return made if "spend" not in rows.columns else merge_spend(made.drop("spend"), rows.where("spend is not null").select(*UTXO_KEYS, "spend.values.*"))
