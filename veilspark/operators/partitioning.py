"""Partition helper for CPU-heavy narrow work (hashing, masking).

Protect projections are narrow: each input split becomes one task. A table
stored as a few big files can be dealt to more tasks first; that is the
caller's decision, since it puts a shuffle of clear data before the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` over ``partitions`` tasks (round robin); unchanged without a number."""
    return df.repartition(partitions) if partitions else df
