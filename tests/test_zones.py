"""The source of landed zones: equal to plain filters, and ranges leave zones unread."""

import random

import pytest
from pyspark.sql import functions as F

from duskfield.operators import spatial
from duskfield.sources import catalogs, zones


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    g = random.Random(8)
    rows = [(i, g.uniform(0, 360), g.uniform(-90, 90), g.uniform(10, 20)) for i in range(3000)] + [(5000, None, 1.0, 12.0), (5001, float("nan"), 2.0, 12.0), (5002, 10.0, None, None), (5003, 5.0, -5.0, None), (5004, 5.0, 90.0, 1.0)]
    stars = spark.createDataFrame(rows, "star_id int, ra double, dec double, rmag double")
    path = f"file://{tmp_path_factory.mktemp('landed')}/stars"
    zones.land(stars, path, 30.0)
    return stars, path


def plain(t):
    return sorted(map(str, t.collect()))


@pytest.mark.parametrize("where", ["ra > 40 and ra <= 62.5 and dec between -12 and 3", "dec >= 90", "ra = 5.0", "dec < -80 or dec > 85", "rmag < 12 and dec > 60", "ra >= 350", "star_id in (5000, 5001)", "ra > 400", "true"])
def test_rows_are_those_of_a_filter(spark, landed, where):
    stars, path = landed
    got = zones.zoned(spark, path, 30.0)
    assert got.columns == stars.columns
    assert plain(got.where(where)) == plain(stars.where(where))


@pytest.mark.parametrize("field", [(0.5, 10.0, 8.0, 6.0), (200.0, -40.0, 3.0, 3.0), (359.0, 88.0, 4.0, 4.0), (90.0, 89.9, 6.0, 6.0)])
def test_regions(spark, landed, field):
    stars, path = landed
    assert plain(zones.zoned_region(spark, path, *field, zone=30.0)) == plain(spatial.region(stars, *field))


def test_ranges_prune_zones(spark, landed):
    _, path = landed
    every = zones.zoned(spark, path, 30.0)
    few = every.where("ra > 40 and ra <= 62.5 and dec between -12 and 3")
    n, m = every.rdd.getNumPartitions(), few.rdd.getNumPartitions()
    assert n > 60 and m <= 2 * 2 + 4  # two zones by two, and what has no position
    reader = zones.ZoneReader(path, 30.0, ("ra", "dec"))
    assert len(reader.partitions()) == n
    list(reader.pushFilters([]))
    assert len(reader.partitions()) == n


def test_store_fetches_by_the_source(spark, landed, tmp_path):
    stars, path = landed
    spec = catalogs.Catalog("ra", "dec", {"Sloan_r": "rmag"}, limit_band="Sloan_r")
    fetch = lambda name, ra, dec, w, h, limit: catalogs.reference_stars(zones.zoned_region(spark, path, ra, dec, w, h, 30.0), spec, ra, dec, w, h, limit)
    store = catalogs.CatalogStore(spark, f"file://{tmp_path}/kept", fetch)
    got = store.get("mine", 120.0, 30.0, 20.0, 20.0, 18.0)
    want = catalogs.reference_stars(stars, spec, 120.0, 30.0, 21.0, 21.0, 18.0)
    assert plain(got) == plain(want) and got.count() > 5
    assert got.where(F.col("Sloan_r") >= 18).count() == 0
