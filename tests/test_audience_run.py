"""The whole daily run on the sf0.001 stand-ins: every stage produces a
consistent result."""

import os

import pytest
from pyspark.sql import functions as F

from audix.plans import audience
from audix.sources import standins

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.mark.parametrize("loss", ["squared", None])
def test_run(spark, loss):
    p = audience.RunParams(segment_dt=standins.SEGMENT_REVENUE_DT, profile_dt=standins.PROFILE_DT,
                           divisor=10, spend_lo="2024010700", spend_hi="2024011400", spend_source="purchase",
                           method="label_propagation", learn_loss=loss)
    out = audience.run(spark, standins.segment_revenue(spark, SF), standins.profiles(spark, SF),
                       standins.user_clusters(spark, SF), standins.cluster_users(spark, SF),
                       standins.spend(spark, SF), None, p)
    assert out["top_segments"].count() == 10
    members = {r.raw_id for r in out["members"].collect()}
    fresh = {r.raw_id for r in out["fresh"].collect()}
    assert members and not (members & fresh)
    assert out["final"].count() == min(p.counters["candidates"] // 10, out["admitted"].count())
    assert out["final"].where(F.col("gain") <= 0).count() == 0          # gate never admits gain <= 0
    vids = {r.vid for r in out["vertices"].collect()}
    assert {r.vid for r in out["membership"].collect()} == vids          # every vertex in one community
    cmp = {r.list: r for r in out["compare"].collect()}
    assert cmp["raw"].n_users >= len(fresh)
