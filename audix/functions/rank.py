"""Exact global row index without a single-task window.

``row_number()`` over an un-partitioned window moves every row into one task.
Instead: range-partition by the order (distributed sort), number rows inside
each partition, and add the row count of all earlier partitions. Only one
count per partition reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.session import cut_lineage


def row_index(df: DataFrame, order_cols: list, name: str = "rank") -> DataFrame:
    """``df`` plus ``name`` = 1-based position in ``order_cols`` order.
    The order must be total (add a unique tie-break column)."""
    spark = df.sparkSession
    sorted_df = df.orderBy(*order_cols)
    tagged = cut_lineage(sorted_df.select("*", F.spark_partition_id().alias("_pid"),
                                          F.monotonically_increasing_id().alias("_mid")))
    counts = tagged.groupBy("_pid").agg(F.count("*").alias("_n"), F.min("_mid").alias("_m0")).collect()
    offsets, acc = [], 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((r["_pid"], acc, r["_m0"]))
        acc += r["_n"]
    off = spark.createDataFrame(offsets, "_pid int, _off long, _m0 long")
    return (tagged.join(F.broadcast(off), "_pid")
            .withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1)
            .drop("_pid", "_mid", "_off", "_m0"))
