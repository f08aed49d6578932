"""Readers of blocks, catalogues, vertex pages and binary records, and checks on what they read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.functions.hexes import hex_to_long
from chainloom.sources.schemas import CATALOGUE, NORMALIZED_BLOCK, VERTEX_PAGE


def read_normalized_blocks(spark: SparkSession, path: str, schema: str = NORMALIZED_BLOCK, fail_fast: bool = True) -> DataFrame:
    """Zstandard JSON lines, one block a line; blank lines are skipped, malformed ones stop the read (or give nulls).

    A compressed file is one task: write the result as Parquet by block range before heavy use.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST" if fail_fast else "PERMISSIVE").json(path)


def _unknown(json: Column, kind: T.DataType, at: str) -> list[tuple[str, Column]]:
    """(path, unknown keys) for each object in a JSON text that the schema says something about."""
    if isinstance(kind, T.StructType):
        known = F.array(*(F.lit(f.name) for f in kind.fields))
        out = [(at, F.array_except(F.coalesce(F.json_object_keys(json), F.array().cast("array<string>")), known))]
        for f in kind.fields:
            out += _unknown(F.get_json_object(json, f"$['{f.name}']"), f.dataType, f"{at}.{f.name}")
        return out
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        items = F.coalesce(F.from_json(json, "array<string>"), F.array().cast("array<string>"))
        paths = [p for p, _ in _unknown(F.lit(""), kind.elementType, f"{at}[]")]

        def within(k: int) -> Column:
            return F.array_distinct(F.flatten(F.transform(items, lambda x: _unknown(x, kind.elementType, f"{at}[]")[k][1])))

        return [(p, within(k)) for k, p in enumerate(paths)]
    return []


def strict_schema_check(lines: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """lines with `unknown`: `path: key` of each JSON key, at any level, that the schema lacks. Empty means the line passes."""

    def told(path: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.concat(F.lit(f"{path}: "), k))

    return lines.withColumn("unknown", F.flatten(F.array(*(told(*x) for x in _unknown(F.col(value_col), schema, "$")))))


def from_block(df: DataFrame, start: int = 1, col: str = "block_number") -> DataFrame:
    """Rows from a block on; the filter reaches the scan. A start of 0 means the first block, 1."""
    return df.where(F.col(col) >= max(1, start))


def sample_blocks(df: DataFrame, modulo: int = 100, low: int | None = None, high: int | None = None, col: str = "block_number") -> DataFrame:
    """Every modulo-th block of a range, for golden files: the sampling operator."""
    out = df.where(F.col(col) % modulo == 0)
    out = out if low is None else out.where(F.col(col) >= low)
    return out if high is None else out.where(F.col(col) <= high)


def read_catalogue(spark: SparkSession, path: str, endpoint: str = "/api/{id}/ws") -> DataFrame:
    """(chain_id, name, evm_chain_id, subnet_id, indexer, endpoint) from a JSON map of chains."""
    chains = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", CATALOGUE)).alias("chain_id", "c"))
    return chains.select("chain_id", "c.name", F.col("c.evmChainId").alias("evm_chain_id"), F.col("c.subnetId").alias("subnet_id"), "c.indexer", F.replace(F.lit(endpoint), F.lit("{id}"), F.col("chain_id")).alias("endpoint"))


def _big_endian(raw: Column, at: int, size: int) -> Column:
    """size bytes (8 at most) from the offset, as a whole number."""
    return F.conv(F.hex(F.substring(raw, at + 1, size)), 16, 10).cast("decimal(20,0)")


#: Offset, size in bytes and kind of the fields of a binary block header; extra_len bytes of extra data follow.
HEADER_FIELDS = {
    "height": (0, 8, "long"), "ts": (8, 8, "long"), "hash": (16, 32, "hex"), "parent_hash": (48, 32, "hex"), "size": (80, 4, "long"), "tx_count": (84, 4, "long"), "gas_limit": (88, 8, "long"), "gas_used": (96, 8, "long"),
    "base_fee": (104, 8, "decimal"), "miner": (112, 20, "hex"), "ext_data_hash": (132, 32, "hex"), "extra_len": (164, 4, "long"),
}


def decode_cblock_records(df: DataFrame, raw_col: str = "raw", fields: dict[str, tuple[int, int, str]] = HEADER_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(headers, rows too short for their header or extra data): fixed-layout binary records, with extra_data at the end."""
    fixed = max(at + size for at, size, _ in fields.values())
    raw = F.col(raw_col)

    def field(at: int, size: int, kind: str) -> Column:
        if kind == "hex":
            return F.concat(F.lit("0x"), F.lower(F.hex(F.substring(raw, at + 1, size))))
        return _big_endian(raw, at, size) if kind == "decimal" else _big_endian(raw, at, size).cast("bigint")

    extra = field(*fields["extra_len"])
    whole = F.when(F.length(raw_col) >= fixed, F.length(raw_col) >= fixed + extra).otherwise(False)
    columns = [field(*f).alias(name) for name, f in fields.items() if name != "extra_len"]
    good = df.where(whole).select(*columns, F.substring(raw, F.lit(fixed + 1), extra.cast("int")).alias("extra_data"))
    return good, df.where(~F.coalesce(whole, F.lit(False)))


def c_block_headers(blocks: DataFrame, block_col: str = "block") -> DataFrame:
    """Header columns of JSON blocks, with the number of transactions."""
    b = F.col(block_col)
    numbers = {"height": "number", "ts": "timestamp", "size": "size", "gas_limit": "gasLimit", "gas_used": "gasUsed", "base_fee": "baseFeePerGas"}
    extra = F.coalesce(F.nullif(b["blockExtraData"], F.lit("")), b["extraData"])
    return blocks.select(
        *(hex_to_long(b[src]).alias(name) for name, src in numbers.items()),
        F.coalesce(F.size(b["transactions"]), F.lit(0)).alias("tx_count"),
        b["hash"].alias("hash"), b["parentHash"].alias("parent_hash"), b["miner"].alias("miner"), b["extDataHash"].alias("ext_data_hash"),
        F.try_to_binary(F.regexp_replace(extra, "^0[xX]", ""), F.lit("hex")).alias("extra_data"),
    )


def raw_x_txs(records: DataFrame, idx_col: str = "idx", raw_col: str = "raw") -> DataFrame:
    """(idx, ts, tx_bytes) of records that are an 8-byte big-endian time and a transaction."""
    return records.select(idx_col, _big_endian(F.col(raw_col), 0, 8).cast("bigint").alias("ts"), F.substring(F.col(raw_col), F.lit(9), F.length(raw_col)).alias("tx_bytes"))


def rfc3339_seconds(text: Column) -> Column:
    """Unix seconds of an RFC 3339 time with up to nanoseconds; the fraction is cut off."""
    return F.unix_timestamp(F.to_timestamp(F.regexp_replace(text, r"\.[0-9]+", "")))


def read_vertices(pages: DataFrame, page_col: str = "page") -> DataFrame:
    """(id, ts, kind): vertices, and their transactions with the vertex's time, from JSON pages or typed ones."""
    page = F.col(page_col)
    if isinstance(pages.schema[page_col].dataType, T.StringType):
        page = F.from_json(page, VERTEX_PAGE)
    each = pages.select(F.explode(page["vertices"]).alias("v")).select("v.hash", rfc3339_seconds(F.col("v.timestamp")).alias("ts"), "v.transactions")
    ids = F.concat(F.array(F.struct(F.col("hash").alias("id"), F.lit("vertex").alias("kind"))), F.transform(F.coalesce("transactions", F.array().cast("array<string>")), lambda t: F.struct(t.alias("id"), F.lit("tx").alias("kind"))))
    return each.select(F.explode(ids).alias("x"), "ts").select("x.id", "ts", "x.kind")


def warehouse_last_block(table: DataFrame, col: str = "blocknumber") -> DataFrame:
    """One row: the last block written, -1 for an empty table."""
    return table.agg(F.coalesce(F.max(col), F.lit(-1)).cast("bigint").alias("last_block"))


def read_golden(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """A golden file by its name: JSON lines with the block schema, or CSV with a header and every column as text."""
    df = read_normalized_blocks(spark, path) if ".jsonl" in path else spark.read.option("header", True).csv(path)
    return df if key is None else df.where(F.col(key).isNotNull())
