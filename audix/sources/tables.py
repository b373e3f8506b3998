"""Scans (S1-S6) and dated-partition readers.

Schemas are declared, never inferred; readers stay lazy so Catalyst can push
filters and column pruning into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audix.functions.text import trim_ws

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()

# Declared schemas of the reference's inputs (see FIXTURES.md part 1).
USER_CLUSTERS_SCHEMA = T.StructType([
    T.StructField("id_type", T.StringType()),
    T.StructField("raw_id", T.StringType()),
    T.StructField("cluster_ids", T.ArrayType(T.StructType([T.StructField("id", T.LongType())]))),
])
CLUSTER_USERS_SCHEMA = T.StructType([
    T.StructField("cluster_id", T.LongType()),
    T.StructField("user_raw_ids", T.ArrayType(T.StructType([
        T.StructField("id_type", T.StringType()),
        T.StructField("raw_id", T.StringType())]))),
])
SPEND_SCHEMA = "s_id string, advertiser_cost double, hour_id string, source string"
SEGMENT_REVENUE_SCHEMA = ("id string, usertype string, dt string, source string, "
                          "revenue double, userscount long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """catalog/table scan. Parquet path per table under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_id_list(spark: SparkSession, path: str, col: str = "sid", sep: str = "\t") -> DataFrame:
    """Delimited text with a declared one-column schema; extra fields ignored."""
    return (spark.read.schema(f"{col} string").option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


def read_id_lines(spark: SparkSession, path: str, col: str = "sid") -> DataFrame:
    """S3: one id per line, white space (incl. a trailing tab, K9) trimmed."""
    return spark.read.text(path).select(trim_ws("value").alias(col))


def read_matrix(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Scan of a cluster matrix. ``fmt='avro'`` needs the Avro module on
    the classpath; it is not present in the test container, so tests use parquet."""
    return spark.read.format(fmt).schema(schema).load(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """S5/S6 raw: every line of every file under ``path`` as ``value``."""
    return spark.read.text(path)


def committed_dates(spark: SparkSession, root: str, dt_col: str = "dt", flag: str = "_SUCCESS") -> list[str]:
    """Dates of the partitions ``root/dt=...`` that carry the done flag."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{dt_col}=*/{flag}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(f.getPath().getParent().getName().split("=", 1)[1] for f in found)


def latest_snapshot(df: DataFrame, dt_col: str = "dt", committed: list[str] | None = None) -> DataFrame:
    """Rows of the newest dated partition, of the ``committed`` ones if
    given. The date is fetched first (a scan of the partition column alone) and
    filters as a literal, so only that partition is read; no date, no rows."""
    latest = max(committed, default=None) if committed is not None else df.agg(F.max(dt_col)).first()[0]
    return df.where(F.col(dt_col) == F.lit(latest))


def as_of(df: DataFrame, dt: str, dt_col: str = "dt") -> DataFrame:
    """One dated partition; partition pruning when ``dt`` is a partition column."""
    return df.where(F.col(dt_col) == F.lit(dt))


def retention_window(df: DataFrame, run_date: str, keep_days: int = 400,
                     dt_col: str = "dt", exact_day_only: bool = False) -> DataFrame:
    """Retention. Default keeps partitions newer than run date - keep_days;
    ``exact_day_only`` drops only the partition dated exactly run - keep_days
    (the scheduled-delete form)."""
    d = F.to_date(F.col(dt_col), "yyyyMMdd")
    cut = F.date_sub(F.to_date(F.lit(run_date), "yyyyMMdd"), keep_days)
    return df.where(d != cut) if exact_day_only else df.where(d > cut)
