"""Joins that split hot keys.

The list of hot keys is worked out once, by a job over the key column alone.  Without any the
join is a plain one; otherwise the list is broadcast, if its count says that it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlytics.session import cut_observed

# Rows of one join key that a single task should see.
ROWS_PER_SLOT = 1_000_000
# Most hot keys that are broadcast: with ids of some 20 bytes about 20 MB.
BROADCAST_KEYS = 200_000


def hot_keys(df: DataFrame, key: str, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """``(key, slots)`` of all keys with more than ``rows_per_slot`` rows: fewer than the rows
    of ``df`` divided by that number."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .filter(F.col("count") > rows_per_slot)
        .select(key, F.ceil(F.col("count") / rows_per_slot).cast("int").alias("slots"))
    )


def join_spread(
    large: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on ``key`` whose hot keys on the large side are split over many tasks.

    Rows of a hot key are dealt to ``slots`` groups by a hash of ``spread_by``; the other
    side repeats its few rows of that key once per group.  Every row meets each partner
    exactly once, so ``inner``, ``left``, ``left_semi`` and ``left_anti`` keep their results.
    ``hot`` comes from :func:`hot_keys`, by default over ``large``.  Its count is taken as it is
    written: nothing is dealt when there are no hot keys, and a long list is not broadcast.
    """
    hot, found = cut_observed(hot_keys(large, key) if hot is None else hot, keys=F.count("*"))
    if not found["keys"]:
        return large.join(small, key, how)
    slots = F.broadcast(hot) if found["keys"] <= BROADCAST_KEYS else hot
    dealt = (
        large.join(slots, key, "left")
        .withColumn(
            "slot",
            F.when(F.col("slots").isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(spread_by), F.col("slots")).cast("int")
            ),
        )
        .drop("slots")
    )
    repeated = (
        small.join(slots, key, "left")
        .withColumn(
            "slot",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slots"), F.lit(1)) - 1)),
        )
        .drop("slots")
    )
    return dealt.join(repeated, [key, "slot"], how).drop("slot")
