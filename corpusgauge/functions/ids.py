"""Deterministic ids, splits and hash-derived uniforms: same parts, same value, on any machine."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def joined(*parts: Column) -> Column:
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def sha_id(*parts: Column) -> Column:
    """60-bit id from the first 15 hex digits of SHA-256; stays in generated code."""
    return F.conv(F.substring(F.sha2(joined(*parts), 256), 1, 15), 16, 10).cast("long")


def sha_id_63(*parts: Column) -> Column:
    """63-bit id from the first 16 hex digits of SHA-256, for relations of more than some 10^9 rows."""
    digest = F.sha2(joined(*parts), 256)
    whole = lambda at, n: F.conv(F.substring(digest, at, n), 16, 10).cast("long")
    return F.shiftleft(whole(1, 8), 31).bitwiseOR(F.shiftright(whole(9, 8), 1))


@F.pandas_udf(T.LongType())
def _blake63(text: pd.Series) -> pd.Series:
    mask = (1 << 63) - 1
    return text.map(
        lambda s: int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big") & mask
    )


def blake_id(*parts: Column) -> Column:
    """63-bit BLAKE2b id, for tables whose ids were made that way. Arrow batches."""
    return _blake63(joined(*parts))


def fold_31(key: Column) -> Column:
    """The 31-bit fold older tables use. Collides at millions of rows: audit with ``duplicates``."""
    return F.pmod(key, F.lit(2**31 - 1)).cast("int")


def hash_split(key: Column, val_fraction: float, test_fraction: float = 0.0) -> Column:
    """train / val (/ test) by ``key`` modulo 10000; a subject never changes its split."""
    bucket = F.pmod(key, F.lit(10000))
    val, test = int(val_fraction * 10000), int(test_fraction * 10000)
    return (
        F.when(bucket < val, "val").when(bucket < val + test, "test").otherwise("train")
    )


def uniform(*parts: Column) -> Column:
    """A value in [0, 1) fixed by its parts."""
    return sha_id(*parts) / F.lit(float(1 << 60))
