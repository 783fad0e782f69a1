"""Column helpers that pin down null, zero and hashing behaviour."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose split hash falls below this many ten-thousandths go to the test part.
TEST_SHARE = 2000
SPLIT_BASE = 10_000

#: Hex digits kept from the digest: 60 bits, so a draw can address any table size.
HASH_HEX_DIGITS = 15
HASH_BITS = 4 * HASH_HEX_DIGITS


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown comparison counts as 0, never as NULL."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def with_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present; the test reaches the Parquet scan."""
    return reduce(lambda rows, key: rows.where(F.col(key).isNotNull()), keys, df)


def total(column: str | Column) -> Column:
    """Sum that is 0 instead of NULL when every value is missing."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def percent(column: Column) -> Column:
    return column * F.lit(100.0)


def month_of(column: str | Column) -> Column:
    """Month as ``YYYY-MM`` text."""
    return F.date_format(column, "yyyy-MM")


def key_hash(seed: int, *keys: str | Column) -> Column:
    """Uniform 60-bit number fixed by the seed and the key values alone.

    Addressing randomness by key, not by row position, gives the same draw
    under every partitioning and after every task retry.
    """
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_HEX_DIGITS), 16, 10).cast("bigint")


def in_test_split(seed: int, *keys: str | Column) -> Column:
    """True for about 20 % of the keys."""
    return F.pmod(key_hash(seed, *keys), F.lit(SPLIT_BASE)) < TEST_SHARE
