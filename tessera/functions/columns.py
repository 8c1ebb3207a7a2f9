"""Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that count as no value.
EMPTY_WORDS = ("", "nan", "none", "null", "unknown")


def populated(c: Column) -> Column:
    """Text that says something."""
    return c.isNotNull() & ~F.lower(F.trim(c.cast("string"))).isin(*EMPTY_WORDS)


def populated_flag(c: Column) -> Column:
    """For booleans of the relational schema: only true is a value."""
    return F.coalesce(c, F.lit(False))


def stable_id(kind: str, *parts: Column) -> Column:
    """kind- and 16 hex digits of the SHA-256 of the parts, nulls as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{kind}-"), F.substring(F.sha2(joined, 256), 1, 16))


def condition_fingerprint(**fields: Column) -> Column:
    """name=value of populated fields, in the order given."""
    return F.concat_ws("|", *[F.when(populated(c), F.concat(F.lit(f"{n}="), c.cast("string"))) for n, c in fields.items()])


def md5_bucket(key: Column, modulus: int = 1000) -> Column:
    """The 128-bit MD5 modulo `modulus`, folded from its two 64-bit halves."""
    half = lambda at: F.conv(F.substring(F.md5(key), at, 16), 16, 10).cast("decimal(20,0)")
    high, low = half(1) % modulus, half(17) % modulus
    return ((high * (2**64 % modulus) + low) % modulus).cast("int")


def split_of(bucket: Column) -> Column:
    return F.when(bucket < 100, "val").when(bucket < 300, "test").otherwise("train")


def doi_canonical(doi: Column) -> Column:
    """The first underscore of a 10. name is its slash."""
    return F.regexp_replace(F.trim(doi), r"^(10\.[^_/]*)_", "$1/")


def log10_positive(c: Column) -> Column:
    return F.when(c > 0, F.log10(c))


#: DuckDB's form of md5_bucket.
SQL_BUCKET = "((cast(concat('0x', substr(md5({k}), 1, 16)) as ubigint) % 1000) * 616 + cast(concat('0x', substr(md5({k}), 17, 16)) as ubigint) % 1000) % 1000"
