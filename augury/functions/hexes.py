"""Columns over 256-bit words written as 64 lower-case hexadecimal digits; string order is numeric order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = "0" * 64


def body(text: Column, width: int = 64) -> Column:
    """Hexadecimal digits without 0x, lower case, padded on the left."""
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    plain = F.substring(low, F.when(low.startswith("0x"), 3).otherwise(1), F.lit(2**31 - 1))
    return F.lpad(plain, F.greatest(F.length(plain), F.lit(width)), F.lit("0")) if width else plain


def word(data: Column, index: int) -> Column:
    """The index-th 32-byte word of hexadecimal data without prefix."""
    return F.substring(data.cast("binary"), 64 * index + 1, 64).cast("string")  # bytes need no walk over the characters before


def digits(text: Column) -> Column:
    """Whether there are only lower-case hexadecimal digits in a text."""
    return F.unhex(text).isNotNull() & (F.lower(text) == text)


def unsigned(hex64: Column) -> Column:
    """Value as DECIMAL(38,0); null where it has more digits than that, or is not hexadecimal."""
    def wide(h: Column) -> Column:
        part = lambda at, n: F.conv(F.substring(h, at, n), 16, 10).cast("decimal(38,0)")
        high = F.try_multiply(part(33, 16), F.lit("18446744073709551616").cast("decimal(20,0)")).cast("decimal(38,0)")
        fits = h.rlike("^0{32}[0-4][0-9a-f]{31}$")  # under 5 * 2^124, which 38 digits hold
        return F.when(fits, (high + part(49, 16)).cast("decimal(38,0)"))

    return F.coalesce(small(hex64).cast("decimal(38,0)"), rarely(wide, hex64))


def rarely(f: Callable[..., Column], *args: Column) -> Column:
    """f of the arguments, as a function over an array of one: it takes little room in compiled code, which Java leaves
    uncompiled where a method is long. For branches that few rows take."""
    return F.element_at(F.transform(F.array(F.struct(*[a.alias(f"a{i}") for i, a in enumerate(args)])), lambda s: f(*[s[f"a{i}"] for i in range(len(args))])), 1)


def small(hex64: Column) -> Column:
    """Value as BIGINT; null where it does not fit."""
    low = F.substring(hex64, 49, 16)
    return F.when((F.length(hex64) == 64) & hex64.startswith("0" * 48) & (low < "8") & digits(low), F.conv(low, 16, 10).cast("long"))


def of_long(value: Column) -> Column:
    """A non-negative BIGINT as a word."""
    return F.lpad(F.lower(F.hex(value)), 64, "0")


def address(word_: Column) -> Column:
    """The address in the last 20 bytes of a topic."""
    return F.concat(F.lit("0x"), F.substring(body(word_), 25, 40))


def _div(x: Column, by: int) -> Column:
    """Whole quotient of non-negative BIGINTs."""
    return ((x - x % by).cast("decimal(20,0)") / by).cast("bigint") if by & (by - 1) else F.shiftright(x, by.bit_length() - 1)


def _folded(digits: Column, start: int, base: int, limbs: int, limb: int) -> Column:
    """Horner's rule over digits (array of BIGINT) of a base, in so many limbs under `limb`, the lowest first; null if the
    value needs more. No step leaves 63 bits."""
    none = F.struct(F.lit(start).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, digit: Column) -> Column:
        first = F.struct(digit.cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            acc["out"], first,
            lambda s, x: F.struct(_div(x * F.lit(base).cast("bigint") + s["carry"], limb).alias("carry"), F.array_append(s["out"], (x * F.lit(base).cast("bigint") + s["carry"]) % F.lit(limb).cast("bigint")).alias("out")),
            lambda s: F.struct((acc["carry"] + s["carry"]).alias("carry"), s["out"].alias("out")),
        )

    zero = F.struct(none["carry"].alias("carry"), F.array_repeat(F.lit(0).cast("bigint"), limbs).alias("out"))
    return F.aggregate(digits, zero, step, lambda s: F.when(s["carry"] == 0, s["out"]))


def from_decimal(text: Column) -> Column:
    """Word of a whole number in decimal text; null if it is none or does not fit in 256 bits."""
    digits = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.substring(F.lpad(text, 81, "0"), 9 * i + 1, F.lit(9)).try_cast("bigint"))
    limbs = _folded(digits, 0, 10**9, 8, 1 << 32)
    joined = F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")
    return F.when(text.rlike("^[0-9]{1,78}$"), F.when(limbs.isNotNull(), joined))


def to_decimal(hex64: Column) -> Column:
    """Decimal text of a word, without leading zeros; null if it is none."""
    digits = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(hex64, 8 * i + 1, F.lit(8)), 16, 10).cast("bigint"))
    joined = F.array_join(F.transform(F.reverse(_folded(digits, 0, 1 << 32, 9, 10**9)), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
    return F.when(hex64.rlike("^[0-9a-f]{64}$"), F.regexp_replace(joined, "^0+(?=[0-9])", ""))


def position(condition: Column, outcome: Column) -> Column:
    """Word of the position of a module condition's outcome: the condition's 31 bytes, then the outcome."""
    return F.concat(F.substring(condition, 3, 62), F.lpad(F.lower(F.hex(outcome.cast("bigint"))), 2, "0"))
