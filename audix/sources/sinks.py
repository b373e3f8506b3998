"""Sinks (S7-S16, S19, S20): key-partitioned text, graph lines, training lines,
plain text and compressed id lists. All are DataFrameWriter calls; Spark's
commit protocol makes each write atomic per task, and ``overwrite`` replaces
the whole output, so reruns leave nothing stale (S19).

Spark writes a directory per key as ``key=value`` (not the bare value); the
value is sanitised first (S10) so it is a valid single path segment.
"""

from __future__ import annotations

import re
import warnings
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audix.functions.features import graph_line, label_importance, training_line
from audix.functions.text import sanitize_key

# The reference's compression names and Spark's codec names.
COMPRESSION = {"none": "none", "bz2": "bzip2", "bz": "bzip2", "gz": "gzip"}


def codec(name: str | None) -> str:
    """S8: 'none', 'bz2', 'bz', 'gz'; anything else warns and writes plain."""
    key = (name or "none").lower()
    if key not in COMPRESSION:
        warnings.warn(f"unknown compression {name!r}; writing uncompressed", stacklevel=2)
        return "none"
    return COMPRESSION[key]


def check_keys(df: DataFrame, keys: list[str]) -> None:
    """Fail before any work when a key column does not exist."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key column(s) {missing} not in {df.columns}")


def write_partitioned_text(df: DataFrame, path: str, keys: list[str], value: Column | None = None,
                           compression: str = "none", delimiter: str = "\t",
                           remove_keys: bool = True, mode: str = "overwrite") -> None:
    """One directory per (multi-level) key value.

    ``value`` is the line to write; by default the non-key columns joined
    with ``delimiter``. With ``remove_keys=False`` the key values stay in the
    line too (K9: no trailing delimiter is written either way)."""
    check_keys(df, keys)
    key_cols = [sanitize_key(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    if value is None:
        rest = [c for c in df.columns if not (remove_keys and c in keys)]
        value = F.concat_ws(delimiter, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rest])
    out = df.select(value.alias("value"), *key_cols)
    renamed = out
    for i, k in enumerate(keys):
        renamed = renamed.withColumnRenamed(f"_k{i}", k)
    # A rerun replaces the whole dated output, also keys it no longer has.
    (renamed.write.mode(mode).partitionBy(*keys).option("partitionOverwriteMode", "static")
     .option("compression", codec(compression)).text(path))


def write_graph_lines(feat: DataFrame, path: str, key: str = "segment_id", compression: str = "none") -> None:
    """``id |demo ... |keywords ...`` lines per key; rows with a null id
    are dropped. ``feat`` has sid, the five token arrays and ``key``."""
    rows = feat.where(F.col("sid").isNotNull())
    write_partitioned_text(rows, path, [key], graph_line("sid"), compression)


def write_training_lines(feat: DataFrame, path: str, key: str = "segment_id", click_col: str = "clicks",
                         compression: str = "none") -> None:
    """``label importance |demo ... |keywords ...`` lines per key (F7 labels)."""
    rows = feat.select("*", *label_importance(click_col))
    write_partitioned_text(rows, path, [key], training_line(), compression)


def write_text(df: DataFrame, path: str, sep: str = "\t", compression: str = "none", mode: str = "overwrite") -> None:
    """Plain tab-separated text (PigStorage-like)."""
    df.write.mode(mode).option("sep", sep).option("compression", codec(compression)).csv(path)


def write_ids_gzip(ids: DataFrame, path: str, col: str = "sid", mode: str = "overwrite") -> None:
    """Gzip text of ids, one per line."""
    ids.select(F.col(col).cast("string")).write.mode(mode).option("compression", "gzip").text(path)


def delete_output(spark, path: str) -> bool:
    """Remove an output through the cluster's file system; False if there
    was none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def delete_dated(spark, root: str, run_date: str, keep_days: int = 400, dt_col: str = "dt",
                 exact_day_only: bool = True) -> list[str]:
    """Deletes the partition ``root/dt=...`` dated ``run_date`` minus ``keep_days``, as
    the daily run does; without ``exact_day_only`` also all earlier ones, which days
    without a run would leave. Other folders stay, also those whose name is no date.
    Returns the deleted dates."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{dt_col}=*")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    cut = (datetime.strptime(run_date, "%Y%m%d") - timedelta(days=keep_days)).strftime("%Y%m%d")
    gone = []
    for found in fs.globStatus(pattern) or []:
        day = found.getPath().getName().split("=", 1)[1]
        if day == cut or (not exact_day_only and re.fullmatch(r"\d{8}", day) and day < cut):
            if fs.delete(found.getPath(), True):
                gone.append(day)
    return sorted(gone)


def output_exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_records(df: DataFrame, path: str, fmt: str = "parquet", compression: str = "gzip",
                  mode: str = "overwrite") -> None:
    """Record files (Avro in the reference; any available format here),
    gzip-compressed; an empty result writes no data file, and a rerun that is
    empty leaves none of the earlier ones (S19)."""
    if df.limit(1).count() == 0:
        if mode == "overwrite":
            delete_output(df.sparkSession, path)
        return
    df.write.mode(mode).format(fmt).option("compression", compression).save(path)
