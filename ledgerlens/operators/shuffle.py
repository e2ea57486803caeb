"""Random row order (the shuffle half of combine-and-shuffle, S5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def random_order(df: DataFrame, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """A uniformly random permutation of ``df``'s rows.

    Every row draws a random key; rows are hash-partitioned on it and sorted
    by it inside each partition.  Reading the partitions in order is then a
    random permutation, without the sampling pass and range shuffle of a
    global ``orderBy(rand())``.  ``rand(seed)`` is seeded per input
    partition, so a retried task draws the same keys.
    """
    keyed = df.withColumn("_shuffle_key", F.rand(seed))
    keyed = (keyed.repartition(partitions, "_shuffle_key") if partitions
             else keyed.repartition("_shuffle_key"))
    return keyed.sortWithinPartitions("_shuffle_key").drop("_shuffle_key")
