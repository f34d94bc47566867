"""Scalar functions that every layer shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that stands for null in hashes, and end of validity of a current version. Fixed values.
NULL_TEXT = "__null__"
OPEN_END = "9999-12-31 23:59:59.999999"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_hash(*columns: Column | str) -> Column:
    """Upper-case SHA-256 over the columns' text; null counts as a text of its own."""
    return F.upper(F.sha2(F.concat_ws("||", *[F.coalesce(col(c).cast("string"), F.lit(NULL_TEXT)) for c in columns]), 256))


def row_hash(columns: list[str]) -> Column:
    """SHA-256 over the JSON of the columns in the order of their names; nulls are left out of the JSON."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])), 256)


def iso_text(ts: Column | str) -> Column:
    return F.date_format(col(ts), ISO_PATTERN)


def ratio(numerator: Column, denominator: float | Column, compat: str = "double", digits: int = 6) -> Column:
    """Rounded quotient; null over zero. compat="trino" keeps one decimal digit, rounded half up, as decimal division of integers does there."""
    d = F.lit(denominator) if not isinstance(denominator, Column) else denominator
    if compat == "trino":
        return F.when(d != 0, F.floor((10 * numerator + d / 2) / d) / F.lit(10.0))
    return F.round(F.when(d != 0, numerator.cast("double") / d.cast("double")), digits)


def strict_greatest(*columns: Column | str) -> Column:
    """greatest() that is null if any argument is."""
    known = F.lit(True)
    for c in columns:
        known = known & col(c).isNotNull()
    return F.when(known, F.greatest(*map(col, columns)))


def salt_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(col(key)), F.lit(buckets)).cast("int")


def stable_id(prefix: str, number: Column) -> Column:
    """Identifiers such as usr_000000000012."""
    return F.format_string(f"{prefix}_%012d", number)


def _wrapped(x: Column) -> Column:
    """A decimal, not below -2^65, modulo 2^64 as a signed long."""
    size, half = F.lit(str(1 << 64)).cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)")
    return ((x + half + size + size) % size - half).cast("long")


def _times(a: Column, factor: int) -> Column:
    """a * factor modulo 2^64, by 32-bit halves in decimals: nothing overflows."""
    f = F.lit(str(factor)).cast("decimal(20,0)")
    low = a.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("decimal(10,0)") * f
    high = (F.shiftrightunsigned(a, 32).cast("decimal(10,0)") * f) % F.lit(1 << 32).cast("decimal(10,0)")
    return _wrapped(low + high * F.lit(1 << 32).cast("decimal(10,0)"))


def splitmix64(number: Column) -> Column:
    """The public splitmix64 generator's output for a state, in column expressions: as a signed long."""
    z = _wrapped(number.cast("decimal(20,0)") + F.lit(str(0x9E3779B97F4A7C15)).cast("decimal(20,0)"))
    z = _times(z.bitwiseXOR(F.shiftrightunsigned(z, 30)), 0xBF58476D1CE4E5B9)
    z = _times(z.bitwiseXOR(F.shiftrightunsigned(z, 27)), 0x94D049BB133111EB)
    return z.bitwiseXOR(F.shiftrightunsigned(z, 31))
