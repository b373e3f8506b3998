"""Streaming revenue equals the batch computation."""

from audix.operators import evaluate
from audix.streaming import revenue


def test_stream_matches_batch(spark, tmp_out):
    rows = [("s1", 1.0, "2024010701", "regular"), ("s2", 2.0, "2024010702", "regular"),
            ("s3", 4.0, "2024010702", "regular"), ("s1", 8.0, "2024011400", "regular")]
    src = tmp_out + "/spend"
    for i, r in enumerate(rows):
        spark.createDataFrame([r], revenue.SPEND_SCHEMA).write.mode("append").parquet(src)
    ids = spark.createDataFrame([("s1",), ("s2",)], "sid string")
    agg = revenue.hourly_revenue_stream(revenue.spend_stream(spark, src, max_files_per_trigger=1),
                                        ids, "2024010700", "2024011400", "regular")
    revenue.run_to_table(agg, tmp_out + "/out", checkpoint=tmp_out + "/ckpt")
    got = {r.hour_id: r.revenue for r in spark.read.parquet(tmp_out + "/out").collect()}
    batch = evaluate.audience_revenue_hourly(
        evaluate.spend_in_window(spark.read.parquet(src), "2024010700", "2024011400", "regular"), ids)
    assert got == {r.hour_id: r.revenue for r in batch.collect()} == {"2024010701": 1.0, "2024010702": 2.0}
