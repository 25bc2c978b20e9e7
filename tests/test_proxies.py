"""Stand-in inputs grow with the driver tables (no band that stops growing with scale)."""

import os

import pytest

from gridmart.plans import proxies
from gridmart.plans.driver import Assets

SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not (os.path.exists(SMALL) and os.path.exists(LARGE)),
                                reason="driver test data not present")


def _families(spark, sf):
    rows = proxies.geo_feature_rows(spark, sf).groupBy("geometry_type").count().collect()
    return {r["geometry_type"]: r["count"] for r in rows}


def test_geo_families_scale_with_events(spark):
    small, large = _families(spark, SMALL), _families(spark, LARGE)
    ev_ratio = (spark.read.parquet(f"{LARGE}/events.parquet").count()
                / spark.read.parquet(f"{SMALL}/events.parquet").count())
    for family in ("Point", "LineString", "MultiLineString", None):
        assert large[family] / small[family] == pytest.approx(ev_ratio, rel=0.35)


def test_geo_marts_scale(spark):
    counts = {sf: (Assets(spark, sf).substations.count(), Assets(spark, sf).lines.count()) for sf in (SMALL, LARGE)}
    assert counts[LARGE][0] > 5 * counts[SMALL][0] and counts[LARGE][1] > 5 * counts[SMALL][1]


def test_features_without_a_band_are_kept_and_counted(spark):
    """Events whose type or band is NULL stay in the one pass over the table."""
    rows = proxies.geo_feature_rows(spark, SMALL)
    assert rows.count() == spark.read.parquet(f"{SMALL}/events.parquet").count()
