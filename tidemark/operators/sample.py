"""Repeatable random samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config as C


def sample_rows(
    df: DataFrame, keys: Sequence[str], n: int = C.SAMPLE_SIZE, seed: int = 0
) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their key.

    Unlike a random number per row, the choice does not depend on partitioning or on tasks
    that run again. Every task keeps its own first ``n`` rows only.
    """
    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(shuffled, *keys).limit(n)
