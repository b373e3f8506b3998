"""Incremental audience revenue with Structured Streaming.

The reference runs its evaluation as a daily batch over dated spend
partitions. The same computation as a stream: new spend files are read as
they land (``availableNow`` processes what is there and stops, which is how a
daily trigger runs it), filtered to the window, joined to the audience list
(stream-static join), and summed per hour in a stateful aggregation whose
state and progress live in the checkpoint location, so a restarted or
re-scheduled run resumes exactly where the last one stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.operators.evaluate import DEFAULT_SOURCE
from audix.session import checkpoint_dir
from audix.sources.tables import SPEND_SCHEMA
from audix.functions.text import in_open_range


def spend_stream(spark: SparkSession, path: str, schema: str = SPEND_SCHEMA, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def hourly_revenue_stream(spend: DataFrame, audience: DataFrame, lo_hour: str, hi_hour: str,
                          source: str = DEFAULT_SOURCE, col: str = "sid") -> DataFrame:
    """Streaming form of A3: hour_id -> revenue of the audience's spend."""
    s = spend.where(F.col("s_id").isNotNull() & F.col("advertiser_cost").isNotNull()
                    & (F.col("advertiser_cost") != 0.0) & in_open_range("hour_id", lo_hour, hi_hour)
                    & (F.col("source") == source))
    ids = audience.select(F.col(col).alias("_lid"))
    return (s.join(ids, s.s_id == ids._lid)
            .groupBy("hour_id").agg(F.sum("advertiser_cost").alias("revenue")))


def run_to_table(agg: DataFrame, table_path: str, checkpoint: str | None = None,
                 query_name: str = "audience_revenue"):
    """Run until the available input is consumed; each micro-batch rewrites the
    hourly table (complete output) atomically via foreachBatch."""
    spark = agg.sparkSession
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/{query_name}"

    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(table_path)

    q = (agg.writeStream.outputMode("complete").queryName(query_name)
         .option("checkpointLocation", ckpt).foreachBatch(write_batch)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
