"""Plans that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key that holds at least one row in HOT_SHARE is hot, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 64


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold at least 1/share of the non-null rows of df: at most `share` rows, whatever the size of df."""
    counts = df.where(_filled(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return counts.join(F.broadcast(total), F.col("_n") * share >= F.col("_total")).select(*keys)


def _filled(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond &= F.col(k).isNotNull()
    return cond


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", *, share: int = HOT_SHARE) -> DataFrame:
    """left joined with right, which has one row per key (left, inner, left_semi or left_anti).

    Rows of a hot key don't meet in one task: the at most `share` hot keys' rows of right are broadcast, all other
    rows are joined by an ordinary shuffle. Null keys match nothing.
    """
    keys = list(keys)
    hot = F.broadcast(hot_keys(left, keys, share).withColumn("_hot", F.lit(True)))
    marked = left.join(hot, keys, "left")
    cold = marked.where("_hot is null").drop("_hot").join(right, keys, how)
    warm = marked.where("_hot").drop("_hot").join(F.broadcast(right.join(hot.drop("_hot"), keys, "left_semi")), keys, how)
    return cold.unionByName(warm)


def checked_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", *, most: int = 20_000, size: Column | None = None, most_bytes: int = 32 << 20) -> DataFrame:
    """lookup, but right is broadcast if a count proves it small, so that left isn't shuffled.

    Small is at most `most` rows, and where `size` gives a row's bytes, at most `most_bytes` of them.
    """
    some = right.select(*keys) if size is None else right.select(size.cast("bigint").alias("_size"))
    counted = some.limit(most + 1).agg(F.count(F.lit(1)), F.sum("_size") if size is not None else F.lit(0)).first()
    if counted[0] <= most and (counted[1] or 0) <= most_bytes:
        return left.join(F.broadcast(right), list(keys), how)
    return lookup(left, right, keys, how)
