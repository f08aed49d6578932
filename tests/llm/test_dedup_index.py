"""The kept index of exact duplicates: batches give the groups of one run, and write only the buckets that they touch."""

import os

import numpy as np
from pyspark.sql import functions as F

from chainloom.llm import dedup_index, exact_dedup
from chainloom.llm.dedup_index import DedupIndex

KEY = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def rows_of(df):
    return sorted(map(str, df.select(KEY).collect()))


def files_of(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{root}/data") for f in names}


def test_batches_give_the_groups_of_one_run(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = [(None, "same text"), (900_001, "same  text "), (900_001, "same text"), (900_002, None), (900_003, " \n"), (None, None), (900_004, "x" * 100_000), (900_005, "x" * 100_000 + " ")]
    # Copies across batches: longer spellings come later, so rows that stayed are overtaken.
    docs = docs.union(docs.select(F.col("doc_id") + 500_000, F.concat("text", F.lit(" \n")))).union(spark.createDataFrame(odd, docs.schema))
    index = DedupIndex(spark, str(tmp_path / "index"), bucket_keys=16)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(3))
    for i in range(3):
        assert index.add(i + 1, docs.where(part == i))
    want = rows_of(exact_dedup.duplicate_groups(docs))
    assert rows_of(index.groups(docs)) == want
    number, value = index.log.latest()
    assert number == 3 and len(value["buckets"]) > 8 and all(n <= 16 for _, n, _ in value["buckets"].values())
    assert sum(n for _, n, _ in value["buckets"].values()) == len({r.split("text_sha256=")[1] for r in want})
    # A batch that comes again changes nothing; old versions go, and the last one answers as before.
    assert index.add(3, docs) == [] and index.log.latest() == (number, value)
    assert index.vacuum(keep=1) and rows_of(index.groups(docs)) == want
    assert index.groups(docs).columns == KEY


def test_a_batch_writes_only_the_buckets_that_it_touches(spark, tmp_path):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    index = DedupIndex(spark, str(tmp_path), bucket_keys=32)
    index.add(1, docs)
    before, old = files_of(tmp_path), index.log.latest()[1]["buckets"]
    assert len(old) > 12
    touched = index.add(2, spark.createDataFrame([(1000, "text number 7"), (1001, "textnumber7   and so on"[:11]), (1002, "text number 7 ")], "doc_id bigint, text string"))
    new = index.log.latest()[1]["buckets"]
    assert len(touched) == 1 and {b for b in old if old[b] != new[b]} == {str(touched[0])}
    after = files_of(tmp_path)
    assert before.items() <= after.items() and {os.path.basename(os.path.dirname(f)) for f in after.keys() - before.keys() if f.endswith(".parquet")} == {f"bucket={touched[0]}"}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in index.groups(docs.where("doc_id in (7, 8)")).collect()}
    assert got == {7: (1002, 4, False), 8: (8, 1, True)}


def test_colliding_hashes_unknown_texts_and_empty_batches(spark, tmp_path):
    kind = "doc_id string, text string, keep_id string"
    index = DedupIndex(spark, str(tmp_path), bucket_keys=1, hash_of=lambda norm: F.length(norm) % 3)
    empty = spark.createDataFrame([], kind)
    assert [tuple(r)[:4] for r in index.groups(spark.createDataFrame([("a", "x", "")], kind)).collect()] == [("a", None, 0, None)]
    assert index.add(1, empty) == [] and index.groups(empty).count() == 0
    index.add(2, spark.createDataFrame([("b", "ab", ""), ("a", "a b", ""), ("c", "cd", "")], kind))
    index.add(3, spark.createDataFrame([("d", "c d ", ""), ("e", "xyz", ""), ("f", "vwxyz", "")], kind))
    asked = spark.createDataFrame([("b", "ab", ""), ("c", "cd", ""), ("d", "cd", ""), ("e", "xyz", ""), ("f", "vwxyz", ""), ("g", "yz", "")], kind)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in index.groups(asked).collect()}
    assert got == {"b": ("a", 2, False), "c": ("d", 2, False), "d": ("d", 2, True), "e": ("e", 1, True), "f": ("f", 1, True), "g": (None, 0, None)}


def test_split_follows_the_counts():
    rng = np.random.default_rng(3)
    full = rng.integers(0, 40, 256)
    parts = dedup_index.split(0, 0, np.concatenate(([0], np.cumsum(full))), 8, 100)
    wide = exact_dedup.MAX_DEPTH - 8
    assert [first >> wide for first, _, _ in parts] == sorted(first >> wide for first, _, _ in parts)
    assert sum(1 << (8 - bits) for _, bits, _ in parts) == 256
    for first, bits, n in parts:
        at = first >> wide
        assert n == full[at : at + (1 << (8 - bits))].sum() and (n <= 100 or bits == 8)
