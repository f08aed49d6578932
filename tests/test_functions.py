"""Numbers in text, small rules and the fixed vectors that they must give."""

import base64

import pytest
from pyspark.sql import functions as F

from chainloom.functions import hexes, rules


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text", ["0x0", "0xff", "0xFF", "0x" + "f" * 16, "0x" + "f" * 31, "0x" + "f" * 64, "0x" + "1" * 40, "0xde0b6b3a7640000", "0x8" + "0" * 63, "0x3b9aca00", "0x" + "0" * 10 + "1", "0x" + "f" * 32, "0x" + "9" * 64, "0x" + "1" + "0" * 63, "0x" + "c" * 65, "0x" + "f" * 200])
def test_hex(spark, text):
    n = int(text, 16)
    assert one(spark, hexes.hex_to_decimal_string(F.lit(text))) == str(n)
    assert one(spark, hexes.hex_to_decimal(F.lit(text))) == (n if n < 2**124 else None)
    assert one(spark, hexes.hex_to_long(F.lit(text))) == (n if n < 2**63 else None)


def test_odd_text(spark):
    rows = spark.createDataFrame([("",), ("0x",), ("zz",), (None,), ("12",)], "s string")
    got = rows.select(hexes.hex_to_long("s"), hexes.hex_to_long_or_null("s"), hexes.hex_to_long_keep_zero("s"), hexes.hex_to_decimal_string("s"), hexes.hex_to_big_string_zero("s"), hexes.hex_to_base64("s")).collect()
    assert [tuple(r) for r in got] == [(0, None, None, "", "0", ""), (0, None, 0, "0", "0", ""), (None, None, None, None, None, ""), (None, None, None, None, None, None), (12, 12, 12, "12", "12", base64.b64encode(b"\x12").decode())]


def test_gas_and_checksum(spark):
    assert one(spark, hexes.intrinsic_gas(F.lit("0x00ff0001"), F.lit(True))) == 21000 + 32000 + 2 * 4 + 2 * 16
    assert one(spark, hexes.intrinsic_gas(F.lit("0x"), F.lit(False))) == 21000
    assert one(spark, hexes.checksum_hex(F.lit("0x00"))) == "0x00" + "6e340b9cffb37a989ca544e6bb780a2c78901d3fb33738768511a30617afa01d"[-8:]
    assert one(spark, hexes.normalise_csv_value(F.lit("TRUE"))) == "true" and one(spark, hexes.normalise_csv_value(F.lit("AbC"))) == "AbC"
    with pytest.raises(ValueError):
        hexes.hash_prefix(F.lit(b"x"), 9)


def test_rules(spark):
    assert one(spark, rules.parse_genesis(F.lit(bytearray(b'{"b": 1}')))) == '{"b":1}'
    assert one(spark, rules.parse_genesis(F.lit(bytearray(b"\x01\xff")))) == "Af8="
    assert one(spark, rules.evm_chain_id(F.lit('{"config":{"chainId":43114}}'))) == 43114
    assert one(spark, rules.evm_chain_id(F.lit('{"config":{"chainId":0}}'))) is None and one(spark, rules.evm_chain_id(F.lit("no"))) is None
    assert one(spark, rules.format_fee(F.lit(20000))) == "2.0000000000000000" and one(spark, rules.format_fee(F.lit(0))) is None
    big = 2**63 - 1
    delegator, validator = rules.split_reward(F.lit(big), F.lit(20000))
    assert one(spark, delegator) == big * 980000 // 1000000 and one(spark, validator) == big - big * 980000 // 1000000
    assert one(spark, rules.parse_address_list(F.lit(" a,,b, a "))) == ["a", "b"]
    assert [one(spark, rules.progress(F.lit(10), F.lit(20), F.lit(n))) for n in (5, 10, 15, 20)] == [0, 0, 50, 100]
    assert one(spark, rules.asset_type(F.lit("My NFT"), F.lit(None))) == "nft" and one(spark, rules.asset_type(F.lit("x"), F.lit(""))) == "secp256k1"
    assert one(spark, rules.rfc3339(F.lit(0))) == "" and one(spark, rules.rfc3339(F.lit(86400))) == "1970-01-02T00:00:00Z"


def test_short_hex_gives_what_the_long_way_gives(spark):
    texts = ["", "0x", "0X0", "0x0f", "0xABCDEF", "0x" + "f" * 15, "0x" + "f" * 16, "0x7" + "f" * 15, "0x8" + "0" * 15, "0x" + "0" * 40 + "1", "12", "-7", "9223372036854775808", "0xg", "x", " 0x1", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", hexes.hex_to_long("t").alias("n"), hexes.hex_to_decimal("t").try_cast("bigint").alias("d"))
    assert [(r.t, r.n) for r in df.collect()] == [(r.t, r.d) for r in df.collect()]
    # Short texts are no more made 38-digit decimals.
    assert df.select("n").where("t = '0x0f'").first().n == 15 and "<= 17" in df.select("n")._jdf.queryExecution().analyzed().toString()
