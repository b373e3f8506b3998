"""Write, read back, compare."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from audix.functions import features as feats
from audix.sources import sinks, tables


def test_codec():
    assert sinks.codec("bz") == "bzip2" and sinks.codec("gz") == "gzip" and sinks.codec(None) == "none"
    with pytest.warns(UserWarning):
        assert sinks.codec("lzo") == "none"


def test_partitioned_text(spark, tmp_out):
    df = spark.createDataFrame([("a/b", "x", 1), (None, "y", 2), ("c", "z", 3)], "k string, v string, n int")
    with pytest.raises(ValueError):
        sinks.write_partitioned_text(df, tmp_out + "/bad", ["nope"])
    sinks.write_partitioned_text(df, tmp_out + "/p", ["k"], compression="gz")
    dirs = sorted(os.path.basename(d) for d in glob.glob(tmp_out + "/p/k=*"))
    assert dirs == ["k=a-b", "k=c", "k=null"]             # '/' -> '-', null -> 'null'
    assert glob.glob(tmp_out + "/p/k=c/*.gz")
    back = spark.read.text(tmp_out + "/p/k=a-b").collect()
    assert [r.value for r in back] == ["x\t1"]            # key removed, no trailing tab (K9)
    sinks.write_partitioned_text(df, tmp_out + "/q", ["k", "v"], remove_keys=False)
    assert os.path.isdir(tmp_out + "/q/k=c/v=z")
    assert spark.read.text(tmp_out + "/q/k=c/v=z").first().value == "c\tz\t3"
    # a rerun replaces the whole output: keys it no longer has are gone
    sinks.write_partitioned_text(df.where("n = 3").withColumn("v", F.lit("again")), tmp_out + "/p", ["k"])
    assert sorted(os.path.basename(d) for d in glob.glob(tmp_out + "/p/k=*")) == ["k=c"]
    assert [r.value for r in spark.read.text(tmp_out + "/p/k=c").collect()] == ["again\t3"]


def test_graph_and_training_lines(spark, tmp_out):
    f = spark.createDataFrame([
        ("u1", "S1", 3, ["F"], ["x"], None, ["1"], ["a", "b"]),
        (None, "S1", 0, ["M"], [], [], [], []),
        ("u3", "S2", None, [], None, [], [], ["c"]),
    ], "sid string, segment_id string, clicks long, demo array<string>, device array<string>, "
       "app_activities array<string>, geo array<string>, keywords array<string>")
    sinks.write_graph_lines(f, tmp_out + "/g")
    lines = tables.read_text_lines(spark, tmp_out + "/g/segment_id=S1").collect()
    assert [r.value for r in lines] == ["u1 |demo F |device x |geo 1 |keywords a b"]
    parsed = feats.parse_feature_lines(tables.read_text_lines(spark, tmp_out + "/g"))
    assert {r.sid for r in parsed.collect()} == {"u1", "u3"}
    sinks.write_training_lines(f, tmp_out + "/t")
    t = {r.value for r in tables.read_text_lines(spark, tmp_out + "/t").collect()}
    assert "1 3 |demo F |device x |geo 1 |keywords a b" in t
    assert "-1 1 |demo |app_activities |geo |keywords c" in t
    back = feats.parse_feature_lines(tables.read_text_lines(spark, tmp_out + "/t"), with_label=True)
    assert sorted((r.label, r.importance) for r in back.collect()) == [(-1, 1), (-1, 1), (1, 3)]


def test_ids_and_records(spark, tmp_out):
    ids = spark.createDataFrame([("s1",), ("s2",)], "sid string")
    sinks.write_ids_gzip(ids, tmp_out + "/ids")
    assert glob.glob(tmp_out + "/ids/*.gz")
    back = tables.read_id_lines(spark, tmp_out + "/ids")
    assert sorted(r.sid for r in back.collect()) == ["s1", "s2"]
    sinks.write_records(ids.where("false"), tmp_out + "/empty")
    assert not os.path.exists(tmp_out + "/empty")          # no file for empty output
    sinks.write_records(ids, tmp_out + "/empty")
    sinks.write_records(ids.where("false"), tmp_out + "/empty")   # an empty rerun leaves nothing stale
    assert not os.path.exists(tmp_out + "/empty")
    sinks.write_text(ids.withColumn("n", F.lit(1)), tmp_out + "/txt")
    assert tables.read_id_list(spark, tmp_out + "/txt").count() == 2


def test_latest_committed_partition(spark, tmp_out):
    for dt, v in (("20240101", 1), ("20240102", 2)):
        sinks.write_records(spark.createDataFrame([(v,)], "v int"), f"{tmp_out}/t/dt={dt}")
    os.remove(f"{tmp_out}/t/dt=20240102/_SUCCESS")
    done = tables.committed_dates(spark, tmp_out + "/t")
    assert done == ["20240101"] and tables.committed_dates(spark, tmp_out + "/none") == []
    df = spark.read.schema("v int, dt string").parquet(tmp_out + "/t")
    snapshot = tables.latest_snapshot(df, committed=done)
    assert [r.v for r in snapshot.collect()] == [1]
    plan = snapshot._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "20240101" in plan


def test_delete_dated(spark, tmp_out):
    """Only the folder of the day goes, or all of the days before it; other names stay."""
    days = ["20230101", "20231230", "20240101", "20240102", "__HIVE_DEFAULT_PARTITION__", "2024"]
    for d in days:
        spark.range(2).write.parquet(f"{tmp_out}/dt={d}")
    spark.range(1).write.parquet(f"{tmp_out}/other")
    assert sinks.delete_dated(spark, tmp_out, "20250204", 400) == ["20240101"]
    assert sinks.delete_dated(spark, tmp_out, "20250204", 400) == []
    assert sinks.delete_dated(spark, tmp_out, "20250204", 400, exact_day_only=False) == ["20230101", "20231230"]
    assert sorted(os.listdir(tmp_out)) == sorted(["other", "dt=20240102", "dt=__HIVE_DEFAULT_PARTITION__", "dt=2024"])
    assert sinks.delete_dated(spark, f"{tmp_out}/nowhere", "20250204") == []
