"""What several operators of this subpackage need: tables, the shared folder, and joins between rounds."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_clear, *_files(spark))
    _WRITTEN.add(path)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


#: Folders of the tables that materialize() wrote, for as long as somebody holds them; and all that are not deleted yet.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_WRITTEN: set[str] = set()


def _files(spark: SparkSession) -> tuple:
    """What deleting files takes, also after the session has stopped."""
    return spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()


def _delete(path: str, path_class, conf) -> None:
    folder = path_class(path)
    folder.getFileSystem(conf).delete(folder, True)
    _WRITTEN.discard(path)


def _clear(path_class, conf) -> None:
    """At the end of the driver, whose lazy tables end with it; a Java process that is gone already leaves its files."""
    with contextlib.suppress(Exception):
        for path in list(_WRITTEN):
            _delete(path, path_class, conf)


def discard(table: DataFrame) -> None:
    """Delete the files of a table of materialize() that nothing reads any more: that of a finished round."""
    path = _FOLDERS.pop(table, None)
    if path:
        _delete(path, *_files(table.sparkSession))


def clear(spark: SparkSession) -> int:
    """Delete all intermediate tables that this driver's operators have written, and return how many there were.

    Results are lazy and read those tables, so store them first; results that are not stored cannot be read afterwards. A driver
    that ends by itself does the same; what one that was killed has left is in the shared folder under the operators' names.
    """
    paths = list(_WRITTEN)
    for path in paths:
        _delete(path, *_files(spark))
    return len(paths)


#: Rows that a join may broadcast; a larger side is shuffled instead.
BROADCAST_ROWS = 1 << 16
#: A key is hot if it has more than one in so many of all rows, so there are fewer hot keys than this.
HOT_SHARE = 1024


def if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df, to be broadcast if it has at most BROADCAST_ROWS rows; df should be a written table, since it is counted."""
    most = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def join_keyed(rows: DataFrame, keyed: DataFrame, key: str, n_rows: str, how: str = "inner") -> DataFrame:
    """rows joined with keyed, which has one row for each key and in n_rows how many rows have it; how: inner or left.

    Both are written tables. A small keyed table is broadcast. Else the hot keys are, of which there are fewer than
    HOT_SHARE, and only rows with other keys are shuffled, so no task gets more than one key's share of 1 / HOT_SHARE.
    """
    if keyed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keyed.drop(n_rows)), key, how)
    hot = F.col(n_rows) * HOT_SHARE > rows.count()
    some, rest = keyed.where(hot).drop(n_rows), keyed.where(~hot).drop(n_rows)
    return rows.join(F.broadcast(some), key).unionByName(rows.join(F.broadcast(some.select(key)), key, "left_anti").join(rest, key, how))


def only_rows(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """docs without the rows whose id (null equals null) and digest of the text are decided(id, digest, stays) not to stay.

    Of rows that repeat both id and digest one stays: that of the longest text, then the greatest digest of its bytes, and any of
    rows that do not differ in those.
    """
    decided = materialize(decided.groupBy("id", "digest").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")), "decided")
    same = docs[id_col].eqNullSafe(F.col("__id")) & (digest(docs[text_col]) == F.col("__digest"))
    keys = lambda rows: if_small(rows.select(F.col("id").alias("__id"), F.col("digest").alias("__digest")))
    docs = docs.join(keys(decided.where(~F.col("stays"))), same, "left_anti")
    repeated = decided.where("stays and n > 1")
    if repeated.isEmpty():
        return docs
    text = F.coalesce(docs[text_col], F.lit(""))
    best = F.max_by(F.struct(*docs.columns), F.struct(F.length(text), text_digest(text))).alias("__row")
    one = docs.join(keys(repeated), same, "left_semi").groupBy(docs[id_col].alias("__id"), digest(docs[text_col]).alias("__digest")).agg(best)
    return docs.join(keys(repeated), same, "left_anti").unionByName(one.select("__row.*"))


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's batches; after the last, the memory that it has freed goes back to the system, since idle workers would keep it."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # C libraries without it
            ctypes.CDLL(None).malloc_trim(0)


#: Bytes and rows of the batches that tasks send to Python: texts may be long, and several copies of a batch are in memory.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


#: Spark's own defaults of the two limits.
DEFAULT_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": "67108864b"}


def small_batches(df: DataFrame) -> DataFrame:
    """df, after lowering its session's Arrow batch limits to BATCH_BYTES and BATCH_ROWS where they are Spark's defaults."""
    conf = df.sparkSession.conf
    for (key, default), most in zip(DEFAULT_BATCHES.items(), (BATCH_ROWS, BATCH_BYTES)):
        if conf.get(key) == default:
            conf.set(key, str(most))
    return df
