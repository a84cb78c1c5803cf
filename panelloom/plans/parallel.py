"""Spreading of work that costs far more CPU than its input has bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Partitions per core for CPU-bound stages.
PER_CORE = 3


def tasks(df: DataFrame) -> int:
    """Partitions that keep the cluster's cores evenly busy, and no fewer than the session's shuffle partitions."""
    spark = df.sparkSession
    return max(PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")) if spark.sparkContext.defaultParallelism > 64 else 0)


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan with at least as many partitions as there are cores.

    A small or well-compressed file is one split, however much work its rows are; it is shuffled once. A table of many
    splits, as any large one, is left as it is. The number is explicit, so it isn't coalesced at run time.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return scan
    return scan.repartition(tasks(scan))
