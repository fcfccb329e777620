"""Row hashes that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASHES = ("murmur3", "md5", "xxhash64")


def md5_number(col: Column | str) -> Column:
    """First 32 bits of the md5 of the text form, as bigint.

    Any SQL engine with an md5 function can repeat it.
    """
    if isinstance(col, str):
        return F.expr(f"cast(conv(substring(md5(cast(cast(`{col}` AS STRING) AS BINARY)), 1, 8), 16, 10) AS BIGINT)")
    text = col.cast("string").cast("binary")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_number(col: Column | str, hash_fn: str = "murmur3") -> Column:
    if hash_fn == "murmur3":
        return F.hash(col).cast("bigint")
    if hash_fn == "xxhash64":
        return F.xxhash64(col)
    if hash_fn == "md5":
        return md5_number(col)
    raise ValueError(f"hash_fn must be one of {HASHES}, not {hash_fn!r}")


def hash_bucket(col: Column | str, buckets: int, hash_fn: str = "murmur3", salt: str = "") -> Column:
    """A bucket 0..buckets-1 that is a function of the value and the salt alone.

    Buckets of different salts are independent of each other.
    """
    if salt:
        col = F.concat(F.lit(f"{salt}:"), (F.col(col) if isinstance(col, str) else col).cast("string"))
    return F.pmod(hash_number(col, hash_fn), F.lit(buckets).cast("bigint")).cast("int")
