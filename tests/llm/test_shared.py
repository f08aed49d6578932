"""Joins beyond what may be broadcast give what the broadcast ones give; folders of finished rounds are deleted."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from chainloom.llm import exact_dedup, mixing, secrets, shared, simhash


@pytest.fixture
def shuffled(monkeypatch):
    """Nothing is small, and keys of more than a twentieth of the rows are hot."""

    def on():
        monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(shared, "HOT_SHARE", 20)
        monkeypatch.setattr(exact_dedup, "SENT_KEYS", 0)

    return on


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_joins_beyond_the_broadcast_bound(spark, sf, shuffled):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    hot = docs.union(docs.limit(1).crossJoin(spark.range(60)).select((F.col("id") + 10_000).alias("doc_id"), "text", "lang", "source", "n_chars"))
    few = {"rounds": 2, "tolerance": None}
    runs = (
        lambda: exact_dedup.drop_duplicates(hot), lambda: simhash.keep_one(hot), lambda: simhash.keep_one_similar(hot),
        lambda: secrets.findings(hot)[0], lambda: mixing.sample(hot, **few),
    )
    want = [rows_of(run()) for run in runs]
    shuffled()
    assert [rows_of(run()) for run in runs] == want


def test_left_join_of_keys(spark, shuffled):
    rows = shared.materialize(spark.range(200).select(F.when(F.col("id") < 80, 1).when(F.col("id") < 190, F.col("id") % 7).otherwise(99).cast("bigint").alias("k"), "id"), "rows")
    keyed = shared.materialize(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 99").withColumn("v", F.col("k") * 10), "keyed")
    want = {how: rows_of(shared.join_keyed(rows, keyed, "k", "n", how)) for how in ("inner", "left")}
    assert len(want["inner"]) == 190 and len(want["left"]) == 200
    shuffled()
    assert {how: rows_of(shared.join_keyed(rows, keyed, "k", "n", how)) for how in ("inner", "left")} == want


def test_finished_folders_go(spark):
    df = shared.materialize(spark.range(3), "gone")
    path = shared._FOLDERS[df].removeprefix("file:")
    assert os.path.isdir(path)
    shared.discard(df)
    assert not os.path.exists(path)
    links = shared.materialize(spark.range(300).selectExpr("id + 1 as u", "id as v"), "kept")
    folders = lambda: {d for d in os.listdir(os.path.dirname(path)) if d.startswith("links-")}
    before = folders()
    assert simhash.components(links).count() == 300 and len(folders() - before) == 1


ENDS = """
import sys
from pyspark.sql import SparkSession
from chainloom.llm import exact_dedup
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
docs = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id bigint, text string")
exact_dedup.duplicate_groups(docs).write.parquet(sys.argv[2])
if len(sys.argv) > 3:
    spark.stop()
"""


@pytest.mark.parametrize("stop", [[], ["stop"]])
def test_a_driver_that_ends_leaves_no_intermediate_tables(spark, tmp_path, stop):
    shared_folder, out = tmp_path / "shared", tmp_path / "out"
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", ENDS, str(shared_folder), str(out), *stop], check=True, cwd=root, timeout=180)
    assert spark.read.parquet(str(out)).count() == 3
    assert not [d for d in os.listdir(shared_folder) if d.startswith("dedup")]


def test_clear_deletes_what_was_written(spark, monkeypatch):
    monkeypatch.setattr(shared, "_WRITTEN", set())
    tables = [shared.materialize(spark.range(3), "one"), shared.materialize(spark.range(4), "two")]
    paths = [t.inputFiles()[0].removeprefix("file:") for t in tables]
    shared.discard(tables[0])
    assert not os.path.exists(paths[0]) and os.path.exists(paths[1])
    assert shared.clear(spark) == 1 and not os.path.exists(paths[1]) and shared.clear(spark) == 0
