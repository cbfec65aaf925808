"""Stable keys: content digests, seeded sampling order, sample and pair identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptmill.functions.text import col, strip


def digest(c) -> Column:
    """32-byte content key that stands for a long text in shuffles and joins."""
    return F.unhex(F.sha2(col(c), 256))


def sample_order(seed, *keys) -> Column:
    """Seeded uniform order key; the same text in any SQL engine with md5."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys]))


def hash_fraction(order_key) -> Column:
    """Uniform number in [0, 1) from the first 8 hex digits of an md5 text."""
    return stable_u32(order_key, hashed=True) / F.lit(4294967296.0)


def stable_u32(c, hashed=False) -> Column:
    """First 32 bits of the md5 of a text."""
    hexed = col(c) if hashed else F.md5(col(c))
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("long")


def pair_id(c) -> Column:
    """Stable pair identifier: 12 hex digits of the md5."""
    return F.substring(F.md5(col(c)), 1, 12)


def sample_id(prefix, rank, prompt, digits=16) -> Column:
    """``prefix-rank-sha1`` with a five-digit rank and a shortened content hash."""
    sha = F.substring(F.sha1(strip(prompt)), 1, digits)
    return F.concat_ws("-", col(prefix), F.format_string("%05d", col(rank)), sha)


def pair_key(prompt, dimension, severity) -> Column:
    """Resume key of a work item: first 100 characters, dimension, severity."""
    return F.concat(F.substring(col(prompt), 1, 100), F.lit("|"), col(dimension), F.lit("|"),
                    col(severity))
