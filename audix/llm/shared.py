"""Tables between steps: written to the shared checkpoint folder, read pruned."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.session import checkpoint_dir

# A key is "heavy" when it holds more than 1/HEAVY_SHARE of all rows, so there
# are fewer than HEAVY_SHARE heavy keys, whatever the size of the table.
HEAVY_SHARE = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again: cuts
    the lineage, survives lost executors, and later reads are column-pruned."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: all that was made of
    them is itself stored."""
    for table in tables:
        spark = table.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()
# Arrow batches between the JVM and Python hold 10,000 rows, or so many bytes of them.
ARROW_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: their Python
    workers import the operators' task code by name, wherever the driver runs.
    Batches sent to them are bounded by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parents[1]
    name = Path(tempfile.mkdtemp(prefix="audix-")) / "audix_package.zip"
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(name))


def join_by_key(rows: DataFrame, table: DataFrame, key: list[str], count: str, total: int,
                how: str = "inner") -> DataFrame:
    """Equi-join of ``rows`` with ``table`` (one row per key, ``count`` = rows
    of that key), safe for hot keys.

    Keys holding more than total/HEAVY_SHARE rows are fewer than HEAVY_SHARE by
    counting, so their table rows are broadcast; every other key is shuffled and
    brings at most total/HEAVY_SHARE rows to a task.
    """
    limit = max(1000, total // HEAVY_SHARE)
    heavy = F.broadcast(table.where(F.col(count) > limit))
    light = table.where(F.col(count) <= limit)
    rest = rows.join(heavy.select(*key), key, "left_anti")
    return rows.join(heavy, key, how).unionByName(rest.join(light, key, how))


# Size up to which a table is broadcast instead of shuffled against.
BROADCAST_BYTES = 32 << 20


def small(table: DataFrame, row_bytes: int, lists: Column | None = None) -> DataFrame:
    """``table`` (a stored one) marked for broadcast if its counted rows, and
    the counted items of its lists, take at most BROADCAST_BYTES; else as it
    is, for a shuffle join of the same rows."""
    items = F.sum(lists) if lists is not None else F.lit(0)
    n = table.agg(F.count("*").alias("rows"), F.coalesce(items, F.lit(0)).alias("items")).first()
    return F.broadcast(table) if n.rows * row_bytes + n["items"] * 8 <= BROADCAST_BYTES else table


def text_bytes(c: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long")


def packed(docs: DataFrame, results: list[str]) -> DataFrame:
    """(row, doc_id, text): the columns of ``docs`` travel in one struct, so that
    no name of theirs meets one of an operator; of columns named like a result,
    the result stays."""
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("text", *results)]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def join_decision(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of whole documents with a table of distinct ids; a
    null id is never in the table."""
    return docs.join(ids.where(F.col("doc_id").isNotNull()).distinct(), "doc_id", how)
