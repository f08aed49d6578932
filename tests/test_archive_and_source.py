"""The prefix archive, ranked pages, and the source of block ranges."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from chainloom.operators import balances, control, ordered, quality
from chainloom.sources import archive, ranked, schemas, sinks
from chainloom.streaming import block_source


def ids(n, salt=""):
    return [hashlib.sha256(f"{salt}{i}".encode()).hexdigest() for i in range(n)]


def test_archive_equals_the_join(spark, tmp_path):
    known = ids(3000)
    dim = spark.createDataFrame([(x, 1000 + i * 7) for i, x in enumerate(known)], "id string, ts bigint")
    size = archive.write_archive(dim, str(tmp_path / "a"), block_rows=16)
    assert size == control.min_unique_prefix(dim, unit=2) <= 4
    clash = known[5][: 2 * size] + "0" * (64 - 2 * size)  # another id with a prefix that is there
    asked = spark.createDataFrame([(x, k) for k, x in enumerate([*known[::50], *ids(20, "no"), clash, None, known[0]])], "id string, k int")
    got = archive.look_up(spark, str(tmp_path / "a"), asked).collect()
    want = {x: 1000 + i * 7 for i, x in enumerate(known)}
    assert len(got) == 83 and all(r.archived_ts == want.get(r.id) for r in got)
    assert [r.id for r in got if r.false_hit] == [clash]


def test_archive_reads_what_the_ids_lead_to(spark, tmp_path):
    known = ids(2000)
    archive.write_archive(spark.createDataFrame([(x, 5) for x in known], "id string, ts bigint"), str(tmp_path / "a"))
    one = archive.look_up(spark, str(tmp_path / "a"), spark.createDataFrame([(known[0],)], "id string"))
    assert {f.split("_folder=")[1][:2] for f in one.inputFiles() if "_folder=" in f} == {known[0][:2]}
    assert archive.look_up(spark, str(tmp_path / "a"), spark.createDataFrame([], "id string")).count() == 0


def test_archive_opens_each_block_once(spark, tmp_path):
    """No row of ids carries the entries of a block: they are opened before the join, which is by the whole prefix."""
    known = ids(2000)
    archive.write_archive(spark.createDataFrame([(x, 5) for x in known], "id string, ts bigint"), str(tmp_path / "a"))
    found = archive.look_up(spark, str(tmp_path / "a"), spark.createDataFrame([(x,) for x in known], "id string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("explode(entries") and plan.count("Generate explode") == 1
    assert found.where("archived_ts = 5").count() == 2000


def test_ranked_pages(spark, tmp_path):
    rng = random.Random(3)
    df = spark.createDataFrame([(f"u{i}", rng.randrange(40), None if i % 9 else i) for i in range(500)], "id string, amount bigint, extra int")
    order = [F.desc("amount"), F.asc("id")]
    version = ranked.write_ranked(df, order, str(tmp_path / "r"), block_rows=64)
    token = None
    for _ in range(30):
        page = ranked.read_page(spark, str(tmp_path / "r"), 37, token)
        rows = page.orderBy("position").collect()
        want = balances.paginate(df, order, 37, token).orderBy("position").collect()
        assert [(r.id, r.amount, r.extra, r.position, r.next_token) for r in rows] == [(r.id, r.amount, r.extra, r.position, r.next_token) for r in want]
        assert len({f.split("_block=")[1].split("/")[0] for f in page.inputFiles()}) <= 2
        token = rows[-1].next_token
        if token is None:
            break
    assert token is None
    # A new version does not disturb a reader of the old one; an empty table has empty pages.
    ranked.write_ranked(df.limit(0), order, str(tmp_path / "r"))
    assert ranked.read_page(spark, str(tmp_path / "r")).count() == 0 and ranked.read_page(spark, str(tmp_path / "r"), 5, version=version).count() == 5


@pytest.mark.parametrize("values", [[7], [3, 3, 3, 9], list(range(1000)), [0] * 50 + [10**12] * 51, [2.5, 1e-9, 1e300, 4.0]])
def test_value_at_any_rank(spark, values):
    rng = random.Random(1)
    df = ordered.checkpointed(spark.createDataFrame([(x,) for x in rng.sample(values, len(values))], "x double" if isinstance(values[0], float) else "x bigint"))
    for rank in {0, len(values) // 2, len(values) - 1, len(values) // 3}:
        assert ordered.value_at(df, "x", rank) == sorted(values)[rank]


def test_summary_of_differences(spark):
    df = spark.createDataFrame([(k, d) for k, d in enumerate([0, 5, -5, 3, 100, -1])], "key int, diff bigint")
    assert tuple(quality.diff_summary(df).first()) == (1, 100, 5, 5)


def test_missing_times_can_stop_a_job(spark):
    txs = spark.createDataFrame([("a", 1), ("b", 2)], "tx_id string, ts bigint")
    dim = spark.createDataFrame([("a", 9)], "id string, ts bigint")
    assert sorted(map(tuple, control.fix_timestamps(txs, dim).collect())) == [("a", 9), ("b", 2)]
    with pytest.raises(Exception, match="no time for b"):
        control.fix_timestamps(txs, dim, on_missing="error").collect()
    assert control.fix_timestamps(txs.where("tx_id = 'a'"), dim, on_missing="error").first().ts == 9


def test_compaction_writes_whole_cold_batches(spark, tmp_path):
    blocks = spark.range(1, 1501).where("id <> 250").select(F.col("id").alias("block_number"), (F.col("id") * 2).alias("x"))
    lacking = sinks.compact_blocks(blocks, str(tmp_path / "c")).collect()
    assert [(r.batch_start, r.n) for r in lacking] == [(201, 99)]
    rows = spark.read.parquet(str(tmp_path / "c"))
    assert sorted({r[0] for r in rows.select("batch_start").distinct().collect()}) == [1, 101, 301, 401] and rows.count() == 400


def test_tables_can_be_created(spark, tmp_path):
    for name in schemas.EVM_TABLES:
        spark.sql(schemas.ddl(name, f"{tmp_path}/{name}", "ddl_test_"))
        try:
            assert spark.table(f"ddl_test_{name}").columns[-1] == "partition_date"
        finally:
            spark.sql(f"drop table ddl_test_{name}")


def test_ranges_go_on_where_they_were(spark, tmp_path):
    head, seen = tmp_path / "head.json", []
    head.write_text(json.dumps({"height": 25}))
    blocks = lambda: spark.range(1, 101).select(F.col("id").alias("block_number"), F.col("id").alias("number"))

    def run(fail_at=None):
        def transform(rows):
            numbers = sorted(r[0] for r in rows.select("number").collect())
            if fail_at in numbers:
                raise RuntimeError("stopped in the middle of a range")
            seen.append((numbers[0], numbers[-1]))
            return {"t": rows}

        query = block_source.export_ranges(block_source.block_ranges(spark, str(head), 10), blocks, str(tmp_path / "out"), str(tmp_path / "at"), "0 seconds", transform=transform)
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="stopped in the middle"):
        run(fail_at=15)
    assert seen == [(1, 10)]
    head.write_text(json.dumps({"height": 40}))  # the head moves while the export is down
    run()
    assert seen[1] == (11, 20) and seen[-1][1] == 40
    run()
    head.write_text(json.dumps({"height": 43}))
    run()
    assert seen[-1] == (41, 43) and sinks.last_committed(spark, str(tmp_path / "out")) == 43
    assert sorted(r[0] for r in sinks.read_export(spark, str(tmp_path / "out"), "t").select("number").collect()) == list(range(1, 44))
