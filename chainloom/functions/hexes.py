"""Quantities in hexadecimal text, as integers, decimals and exact decimal text; built-in functions only.

Texts are `0x...` in either case or plain decimal digits. Values that do not fit the target type become null, and text
that is no number becomes null, so that one bad row never stops a job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

Text = Column | str
#: Base of the decimal limbs in which numbers are added up, and digits of one limb.
LIMB, LIMB_DIGITS = 10**9, 9
#: 256-bit numbers: words of six hex digits, whose products with a limb add up within 64 bits.
WORD_DIGITS, WORDS, WIDE_LIMBS = 6, 12, 9


def _col(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_hex(s: Column) -> Column:
    return s.rlike("^0[xX][0-9a-fA-F]*$")


def _is_decimal(s: Column) -> Column:
    return s.rlike("^-?[0-9]+$")


def _bare(s: Column) -> Column:
    """Hex digits without prefix and leading zeros."""
    return F.ltrim(F.substring(s, F.lit(3), F.length(s)), F.lit("0"))


def hex_to_decimal(s: Text) -> Column:
    """DECIMAL(38,0); empty text and a bare 0x are 0; null beyond 38 digits or 124 bits."""
    s = _col(s)
    wide = F.lpad(_bare(s), 31, "0")
    half = [F.conv(F.substring(wide, at, n), 16, 10).cast("decimal(20,0)") for at, n in ((1, 15), (16, 16))]
    value = (half[0].cast("decimal(19,0)") * F.lit("18446744073709551616").cast("decimal(20,0)") + half[1]).cast("decimal(38,0)")
    return F.when(s == "", F.lit(0).cast("decimal(38,0)")).when(_is_hex(s), F.when(F.length(_bare(s)) <= 31, value)).when(_is_decimal(s), s.try_cast("decimal(38,0)"))


def hex_to_long(s: Text) -> Column:
    """BIGINT; empty text is 0; null where the value does not fit. Up to 15 digits, which always fit, take a short way."""
    s = _col(s)
    short = F.conv(F.concat(F.lit("0"), F.substring(s, 3, 15)), 16, 10).cast("bigint")
    return F.when((F.length(s) <= 17) & _is_hex(s), short).otherwise(hex_to_decimal(s).try_cast("bigint"))


def hex_to_long_or_null(s: Text) -> Column:
    """hex_to_long with zero and empty text as null."""
    return F.nullif(hex_to_long(s), F.lit(0).cast("bigint"))


def hex_to_long_keep_zero(s: Text) -> Column:
    """hex_to_long with empty text as null and zero kept."""
    return F.when(_col(s) != "", hex_to_long(s))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _limb_text(limb: Column) -> Column:
    return F.lpad(limb.cast("string"), LIMB_DIGITS, "0")


def _wide_text(digits: Column) -> Column:
    """Decimal digits, with leading zeros, of up to 64 hex digits: words of 24 bits times the decimal limbs of their powers of two,
    added up limb by limb, then the carries. All of it fits 64 bits."""
    wide = F.lpad(digits, WORD_DIGITS * WORDS, "0")
    # Two words at a time are read, and split by shifts.
    pairs = F.array(*(F.conv(F.substring(wide, 2 * WORD_DIGITS * i + 1, 2 * WORD_DIGITS), 16, 10).cast("bigint") for i in reversed(range(WORDS // 2))))
    mask = F.lit((1 << (4 * WORD_DIGITS)) - 1).cast("bigint")
    halves = lambda p: [w for i in range(WORDS // 2) for x in [F.get(p, F.lit(i))] for w in (x.bitwiseAND(mask), F.shiftright(x, 4 * WORD_DIGITS))]

    def limbs(w: Column) -> Column:
        factors = [[(i, (1 << (4 * WORD_DIGITS * i)) // LIMB**k % LIMB) for i in range(WORDS)] for k in range(WIDE_LIMBS)]
        return F.array(*(reduce(add, (F.get(w, F.lit(i)) * F.lit(f).cast("bigint") for i, f in row if f)) for row in factors))

    def step(acc: Column, x: Column) -> Column:
        carry = F.call_function("div", x + acc["carry"], F.lit(LIMB))
        return F.struct(carry.alias("carry"), F.concat(_limb_text((x + acc["carry"]) % LIMB), acc["text"]).alias("text"))

    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("text"))
    return F.aggregate(_let(_let(pairs, lambda p: F.array(*halves(p))), limbs), start, step, lambda acc: acc["text"])


def _long_text(digits: Column) -> Column:
    """Decimal digits, with leading zeros, of hex digits of any number, folded seven at a time into limbs of nine decimal
    digits, the lowest first."""
    padded = F.lpad(digits, ((F.length(digits) + 6) / 7).cast("int") * 7, "0")
    groups = F.transform(F.sequence(F.lit(0), (F.length(padded) / 7).cast("int") - 1), lambda i: F.conv(F.substring(padded, i * 7 + 1, F.lit(7)), 16, 10).cast("bigint"))
    empty = F.array().cast("array<bigint>")

    def fold(limbs: Column, group: Column) -> Column:
        """limbs * 16**7 + group, with carries."""
        first = F.struct(group.alias("carry"), empty.alias("out"))

        def step(acc: Column, limb: Column) -> Column:
            v = limb * (16**7) + acc["carry"]
            return F.struct(F.floor(v / F.lit(LIMB).cast("decimal(10,0)")).cast("bigint").alias("carry"), F.concat(acc["out"], F.array(v % LIMB)).alias("out"))

        return F.aggregate(limbs, first, step, lambda acc: F.when(acc["carry"] > 0, F.concat(acc["out"], F.array(acc["carry"]))).otherwise(acc["out"]))

    limbs = F.aggregate(groups, empty, fold)
    return F.array_join(F.reverse(F.transform(limbs, _limb_text)), "")


def hex_to_decimal_string(s: Text) -> Column:
    """Exact decimal text of 256 bits and more; empty text stays empty. Short numbers take the shorter way."""
    s = _col(s)
    digits = _bare(s)
    size = F.length(digits)
    # conv() is exact up to 64 bits; longer numbers come with leading zeros, but are not zero.
    exact = F.when(size == 0, "0").when(size <= 16, F.conv(digits, 16, 10)).when(size <= 64, F.ltrim(_wide_text(digits), F.lit("0"))).otherwise(F.ltrim(_long_text(digits), F.lit("0")))
    return F.when(s == "", "").when(_is_hex(s), exact).when(_is_decimal(s), F.regexp_replace(s, "^(-?)0+(?=[0-9])", "$1"))


def hex_to_big_string_zero(s: Text) -> Column:
    """hex_to_decimal_string with empty text as 0."""
    return F.when(_col(s) == "", "0").otherwise(hex_to_decimal_string(s))


def _raw(s: Column) -> Column:
    """Bytes of hex text with or without prefix; null if it is none."""
    return F.try_to_binary(F.regexp_replace(s, "^0[xX]", ""), F.lit("hex"))


def hex_to_base64(s: Text) -> Column:
    """Base64 of the bytes; bad hex gives empty text."""
    s = _col(s)
    even = F.length(F.regexp_replace(s, "^0[xX]", "")) % 2 == 0
    return F.when(s.isNotNull(), F.coalesce(F.when(even, F.base64(_raw(s))), F.lit("")))


def intrinsic_gas(data: Text, is_create: Column) -> Column:
    """Gas that a transaction costs before it runs: base, creation, and its zero and other bytes."""
    pairs = F.regexp_extract_all(F.regexp_replace(_col(data), "^0[xX]", ""), F.lit("(..)"), F.lit(1))
    zero = F.size(F.filter(pairs, lambda p: p == "00"))
    # Fixed values of the fee schedule: base 21000, creation 32000, 4 for a zero byte, 16 for another.
    return (F.lit(21000) + F.when(is_create, 32000).otherwise(0) + zero * 4 + (F.size(pairs) - zero) * 16).cast("bigint")


def checksum_hex(h: Text) -> Column:
    """0x text with the last four bytes of the SHA-256 of the bytes added."""
    bare = F.lower(F.regexp_replace(_col(h), "^0[xX]", ""))
    return F.concat(F.lit("0x"), bare, F.right(F.sha2(F.unhex(bare), 256), F.lit(8)))


def normalise_csv_value(s: Text) -> Column:
    """0x values and truth values in lower case, other text as it is."""
    s = _col(s)
    return F.when(s.rlike("^0[xX]") | s.rlike("^(?i:true|false)$"), F.lower(s)).otherwise(s)


def hash_prefix(raw: Text, n: int) -> Column:
    """The first n bytes of an id, n from 3 to 8."""
    if not 3 <= n <= 8:
        raise ValueError("a prefix has 3 to 8 bytes")
    return F.substring(_col(raw), 1, n)
