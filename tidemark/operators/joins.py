"""Joins that hold up when a key is hot, and broadcasts behind a size check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
HOT_SHARE = 256  # a key with at least this part of the rows is hot
SALTS = 256


def heavy_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """The keys that about one in ``share`` rows or more has, not NULL: found in one pass by a sketch of frequent
    items, without a shuffle of the keys. At most ``share`` of them."""
    known = df.where(F.col(key).isNotNull())
    found = known.agg(
        F.expr(f"approx_top_k(`{key}`, {share}, {32 * share})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(t.item for t in found.top or () if t["count"] * share >= found.n)


def _salt_of(key: Column, hot: Sequence, salts: int, spread_by: str) -> Column:
    return F.when(key.isin(list(hot)), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).otherwise(F.lit(0))


def _with_salts(right: DataFrame, key: str, hot: Sequence, salts: int) -> DataFrame:
    """Rows of hot keys once for every salt, all others once."""
    every = F.when(F.col(key).isin(list(hot)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return right.withColumn("_salt", F.explode(every))


def left_join_spread_nulls(
    left: DataFrame, right: DataFrame, key: str, spread_by: str, hot: Sequence = (), salts: int = SALTS
) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where NULL keys, and ``hot`` ones, on the left may be many.

    NULL never matches, yet a hash join would send all such rows to one partition. They are
    hashed by ``spread_by`` instead, and the extra condition keeps them unmatched. Rows of ``hot`` keys
    (:func:`heavy_keys`) get a salt from ``spread_by``, and the right rows of those few keys stand under every
    salt. Other keys that turn out hot are left to adaptive skew-join, which splits the left side.
    """
    keyed = left.withColumn("_join_key", F.coalesce(F.col(key), F.col(spread_by)))
    on = (F.col("_join_key") == F.col("_other_key")) & F.col(key).isNotNull()
    if hot:
        keyed = keyed.withColumn("_left_salt", _salt_of(F.col(key), hot, salts, spread_by))
        right = _with_salts(right, key, hot, salts)
        on = on & (F.col("_left_salt") == F.col("_salt"))
    other = right.withColumnRenamed(key, "_other_key")
    return keyed.join(other, on, "left").drop("_join_key", "_other_key", "_left_salt", "_salt")


def inner_join_spread(
    left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str], hot: Sequence, salts: int = SALTS
) -> DataFrame:
    """``left JOIN right USING (key)`` where ``hot`` keys on the left may be many; see above."""
    if not hot:
        return left.join(right, key)
    salt = F.when(F.col(key).isin(list(hot)), F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    salted = left.withColumn("_salt", salt)
    return salted.join(_with_salts(right, key, hot, salts), [key, "_salt"]).drop("_salt")


def broadcast_if_small(keys: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the rows, measured, fit the limit; else leave them to a shuffle.

    Meant for key lists of a batch: one aggregate over a small relation decides whether a join
    with a large table can leave that table where it is.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in keys.columns),
        start=F.lit(0),
    )
    size = keys.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(keys) if size <= limit else keys
