"""Comparison of tables: sets of rows, values by key, cells, nested answers, and UTXO sets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainloom.functions import deep_json
from chainloom.operators.ordered import checkpointed, value_at

#: Upper bounds of the magnitudes by which differences are reported.
MAGNITUDES = (10, 100, 1000, 10000)
#: Leaves of JSON answers that a task sends back together, and characters of their paths.
LEAVES, PATH_CHARS = 4096, 1 << 22


def diff_row_sets(got: DataFrame, want: DataFrame) -> DataFrame:
    """(side, row columns): rows of one table that the other lacks, as sets: missing from got, or extra in it."""
    missing, extra = want.subtract(got), got.subtract(want)
    return missing.select(F.lit("missing").alias("side"), "*").unionByName(extra.select(F.lit("extra").alias("side"), "*"))


def diff_report(diff: DataFrame, samples: int = 3) -> DataFrame:
    """(side, n, samples): counts of diff_row_sets() with the first few rows as JSON."""
    row = F.to_json(F.struct(*(c for c in diff.columns if c != "side")), {"ignoreNullFields": "false"})
    rows = diff.select("side", row.alias("r"))
    first = rows.withColumn("i", F.row_number().over(Window.partitionBy("side").orderBy("r"))).where(F.col("i") <= samples)
    return rows.groupBy("side").agg(F.count(F.lit(1)).alias("n")).join(first.groupBy("side").agg(F.sort_array(F.collect_list("r")).alias("samples")), "side")


def diff_by_key(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, status, a, b, diff, abs_diff, pct): matched, differing, missing (from a) or extra; keys without case."""
    side = lambda df, n: df.select(F.lower(F.col(key).cast("string")).alias("key"), F.col(value).cast("decimal(38,0)").alias(n), F.lit(True).alias(f"has_{n}"))
    j = side(a, "a").join(side(b, "b"), "key", "full")
    diff = F.col("a") - F.col("b")
    status = F.when(F.col("has_a").isNull(), "missing").when(F.col("has_b").isNull(), "extra").when(F.col("a").eqNullSafe(F.col("b")), "matched").otherwise("differing")
    pct = F.when(F.col("b") != 0, (F.abs(diff).cast("double") / F.abs(F.col("b")).cast("double")) * 100)
    return j.select("key", status.alias("status"), "a", "b", diff.alias("diff"), F.abs(diff).alias("abs_diff"), pct.alias("pct"))


def magnitude(abs_diff: Column) -> Column:
    """Report bucket of an absolute difference: below each bound, or at least the last."""
    out = F.lit(f">={MAGNITUDES[-1]}")
    for m in reversed(MAGNITUDES):
        out = F.when(abs_diff < m, f"<{m}").otherwise(out)
    return out


def diff_distribution(diffs: DataFrame, col: str = "diff") -> DataFrame:
    """(bucket, n, pct, larger, smaller) by magnitude of the differences that are not zero."""
    rows = diffs.where(F.col(col) != 0)
    by = rows.groupBy(magnitude(F.abs(col)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col(col) > 0, 1).otherwise(0)).alias("larger"), F.sum(F.when(F.col(col) < 0, 1).otherwise(0)).alias("smaller"))
    return by.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def diff_summary(diffs: DataFrame, col: str = "diff") -> DataFrame:
    """One row: least, largest and median absolute difference (the one at index n/2 in order), and their number."""
    rows = checkpointed(diffs.where(F.col(col) != 0).select(F.abs(col).alias("d")))
    n = rows.count()
    median = value_at(rows, "d", n // 2, n) if n else None
    return rows.agg(F.min("d").alias("least"), F.max("d").alias("most"), F.lit(median).cast(rows.schema["d"].dataType).alias("median"), F.nullif(F.count(F.lit(1)), F.lit(0)).alias("n"))


def top_diffs(diffs: DataFrame, k: int = 5, col: str = "abs_diff") -> DataFrame:
    """The k largest differences, ties by key: the top-k report."""
    return diffs.where(F.col(col) > 0).orderBy(F.desc(col), "key").limit(k)


def diff_columns_by_key(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, column, a, b) for each cell that differs, case aside, between rows with equal keys; columns of both tables."""
    cells = [c for c in a.columns if c in b.columns and c not in keys]
    j = a.select(*keys, F.struct(*cells).alias("_a")).join(b.select(*keys, F.struct(*cells).alias("_b")), list(keys))
    text = lambda c: F.lower(F.coalesce(c.cast("string"), F.lit("")))
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"_a.{c}").cast("string").alias("a"), F.col(f"_b.{c}").cast("string").alias("b"), (text(F.col(f"_a.{c}")) != text(F.col(f"_b.{c}"))).alias("differs")) for c in cells))
    return j.select(*keys, F.explode(F.filter(each, lambda x: x["differs"])).alias("x")).select(*keys, "x.column", "x.a", "x.b")


def header_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Columns that only one table has, case aside."""
    low = lambda df: {c.lower() for c in df.columns}
    return {"missing": sorted(low(b) - low(a)), "extra": sorted(low(a) - low(b))}


def _leaves(text: str | None, match: tuple[str, ...], skip: tuple[str, ...]) -> Iterator[tuple[str, str | None]]:
    try:
        # Numbers stay as they are written.
        stack = [("$", deep_json.loads(text or "null", numbers_as_text=True))]
    except ValueError:
        stack = [("$", text)]
    while stack:
        path, x = stack.pop()
        if isinstance(x, dict):
            stack += [(f"{path}.{k}", v) for k, v in x.items() if k not in skip]
        elif isinstance(x, list):
            for i, v in enumerate(x):
                name = next((m for m in match if isinstance(v, dict) and v.get(m) is not None), None)
                tag = str(i) if name is None else f"{v[name]}:{v['rewardType']}" if name == "txHash" and v.get("rewardType") is not None else v[name]
                stack.append((f"{path}[{tag}]", v))
        else:
            yield path, str(x).lower() if isinstance(x, bool) else x


def _leaf_batches(batches: Iterator[pa.RecordBatch], match: tuple[str, ...], skip: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The leaves of batches of (id, JSON), those of many rows together."""

    def together(b: pa.RecordBatch, rows: list[int], found: list[tuple[str, str | None]]) -> pa.RecordBatch:
        paths, values = zip(*found)
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(paths, pa.string()), pa.array(values, pa.string())], names=["id", "path", "value"])

    for b in batches:
        rows: list[int] = []
        found: list[tuple[str, str | None]] = []
        size = 0
        for row, text in enumerate(b.column(1).to_pylist()):
            for leaf in _leaves(text, match, skip):
                rows.append(row)
                found.append(leaf)
                size += len(leaf[0])
                if len(found) >= LEAVES or size >= PATH_CHARS:
                    yield together(b, rows, found)
                    rows, found, size = [], [], 0
        if found:
            yield together(b, rows, found)


def leaves(df: DataFrame, id_col: str, json_col: str, match: tuple[str, ...] = ("utxoId", "txHash"), skip: tuple[str, ...] = ()) -> DataFrame:
    """(id, path, value): the leaves of JSON answers of any depth, in one pass. Elements of arrays go by the first of `match`
    that they have (txHash with rewardType), else by place; fields in skip are left out. Text that is no JSON is one leaf."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, json_col).mapInArrow(lambda batches: _leaf_batches(batches, match, skip), f"id {kind}, path string, value string")


def diff_nested(a: DataFrame, b: DataFrame, id_col: str, json_col: str, skip: tuple[str, ...] = (), approx: dict[str, float] | None = None) -> DataFrame:
    """(id, path, a, b): leaves that differ between two tables of JSON answers; approx: for a field the relative difference
    that passes."""
    j = leaves(a, id_col, json_col, skip=skip).withColumnRenamed("value", "a").join(leaves(b, id_col, json_col, skip=skip).withColumnRenamed("value", "b"), ["id", "path"], "full")
    same = F.col("a").eqNullSafe(F.col("b"))
    for field, tol in (approx or {}).items():
        x, y = F.col("a").try_cast("double"), F.col("b").try_cast("double")
        near = F.abs(x - y) <= F.greatest(F.abs(x), F.abs(y)) * tol
        same = same | (F.col("path").endswith(f".{field}") & F.coalesce(near, F.lit(False)))
    return j.where(~same)


def compare_utxo_sets(local: DataFrame, remote: DataFrame, keys: tuple[str, ...] = ("address", "tx_id", "output_index"), amount: str = "amount", asset: str = "asset_id", foreign: Column | None = None) -> DataFrame:
    """Per address: missing_local, missing_remote, mismatched, matched, skipped (local rows made on another chain) and passed."""
    l = local.select(*keys, F.col(amount).alias("la"), F.col(asset).alias("ls"), F.lit(True).alias("l"), (F.lit(False) if foreign is None else foreign).alias("f"))
    r = remote.select(*keys, F.col(amount).alias("ra"), F.col(asset).alias("rs"), F.lit(True).alias("r"))
    j = l.join(r, list(keys), "full")
    skip = F.coalesce("f", F.lit(False))
    kind = F.when(skip, "skipped").when(F.col("l").isNull(), "missing_local").when(F.col("r").isNull(), "missing_remote").when((F.col("la") == F.col("ra")) & F.col("ls").eqNullSafe(F.col("rs")), "matched").otherwise("mismatched")
    sums = [F.sum(F.when(F.col("k") == n, 1).otherwise(0)).alias(n) for n in ("missing_local", "missing_remote", "mismatched", "matched", "skipped")]
    return j.select(keys[0], kind.alias("k")).groupBy(keys[0]).agg(*sums).withColumn("passed", F.expr("missing_local + missing_remote + mismatched = 0"))


def filter_zero_balances(entries: Column, field: str = "amount") -> Column:
    """An array of answers without those whose amount is zero."""
    return F.filter(entries, lambda x: x[field].cast("decimal(38,0)") != 0)


def filter_expired(entries: Column, now: Column, field: str = "end_time") -> Column:
    """An array of answers without those that have ended."""
    return F.filter(entries, lambda x: x[field] > now)


def json_equal(a: Column, b: Column) -> Column:
    """Whether two JSON texts are equal, order of keys and blanks aside; null where either is no JSON."""
    form = lambda c: F.to_json(F.try_parse_json(c))
    return form(a) == form(b)
