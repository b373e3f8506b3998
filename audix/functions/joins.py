"""Join helpers: broadcast only behind a size check, otherwise a shuffle join
that AQE may still convert at runtime from measured sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bound under which an id-like side is broadcast without further proof.
DEFAULT_BROADCAST_ROWS = 1_000_000


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Reads at most max_rows+1
    rows' worth of work per partition thanks to the limit."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is checked to be within the bound,
    else ``df`` unchanged (shuffle join; AQE re-plans from real sizes)."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (e.g. the output
    of a ``limit(k)`` top-k, or one row per fixed vocabulary entry)."""
    return F.broadcast(df)


# A key is heavy when more than one in HEAVY_SHARE rows has it: there are fewer of them.
HEAVY_SHARE = 1000


def split_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Equi-join of ``rows`` with ``table`` (one row a key) that no hot key of ``rows``
    sends to one task: the heavy keys, counted on ``rows``, are broadcast with their
    table rows, the others are shuffled."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    total = rows.count()
    heavy = F.broadcast(counts.where(F.col("_n") > max(1000, total // HEAVY_SHARE)).select(key).join(table, key))
    light = rows.join(heavy.select(key), key, "left_anti")
    return rows.join(heavy, key).unionByName(light.join(table, key))
