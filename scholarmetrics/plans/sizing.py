"""Shuffle sizing from the inputs' size.

The widest shuffles here move (a projection of) the largest input table:
edges by cited paper, link rows by author, and so on.  This module picks
``spark.sql.shuffle.partitions`` so that such a shuffle lands at about
``target_bytes`` per partition.  AQE then coalesces partitions that turn out
small, so erring high is cheap, while too few partitions spill or fail.
There is no upper bound: 100 TB of compressed input ask for about 1.6 million
partitions of the target size.  Pass ``maximum`` (or a larger ``target_bytes``)
where a scheduler cannot take so many, and plan for the larger partitions.
Sizes come from plan statistics (file sizes); no job runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from scholarmetrics.operators.skew import INPUT_INFLATION, input_bytes

# Default target bytes per shuffle partition and the least number.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MIN_PARTITIONS = 200


def suggested_shuffle_partitions(
    inputs: Iterable[DataFrame],
    target_bytes: int = TARGET_PARTITION_BYTES,
    minimum: int = MIN_PARTITIONS,
    maximum: int | None = None,
) -> int:
    biggest = max((input_bytes(df) or 0 for df in inputs), default=0)
    wanted = math.ceil(biggest * INPUT_INFLATION / target_bytes)
    return max(minimum, wanted if maximum is None else min(maximum, wanted))


def size_shuffles(spark: SparkSession, inputs: Iterable[DataFrame], **kw) -> int | None:
    """Set ``spark.sql.shuffle.partitions`` from the inputs unless it was set
    when the application was launched.  Returns the value set, or ``None``."""
    try:
        if spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
            return None
    except Exception:  # no SparkContext on a Spark Connect client: leave it
        return None
    n = suggested_shuffle_partitions(inputs, **kw)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
