"""Catalogues kept by cell against joins and loops, and their plans."""

import math
import random

import pytest

from duskfield.operators import spatial
from duskfield.sources.cells import CellCatalog


def field(spark, seed, n=400):
    g = random.Random(seed)
    crowd = [(i, 359.999 + g.uniform(0, 0.002) - (360 if g.random() < 0.5 else 0), g.uniform(0, 0.002)) for i in range(n)]
    wide = [(n + i, g.uniform(0, 360), math.degrees(math.asin(g.uniform(-1, 1)))) for i in range(n)]
    poles = [(2 * n + i, g.uniform(0, 360), g.choice([-1, 1]) * (90 - g.uniform(0, 0.001))) for i in range(40)]
    return [(k, a % 360, d) for k, a, d in crowd + wide + poles]


def test_pairs_are_the_joins(spark, tmp_path):
    stars = spark.createDataFrame([*field(spark, 1), (9001, None, 1.0), (9002, float("nan"), 1.0)], "star_id int, sra double, sdec double")
    det = spark.createDataFrame([*field(spark, 2), (9001, None, 1.0), (9003, 1.0, float("inf"))], "det_id int, ra double, dec double")
    kept = CellCatalog.save(stars, f"file://{tmp_path}/cells", 8.0, on=("sra", "sdec"), levels=3, most=20, buckets=4)
    assert kept.stars().count() == 840 and kept.stars().groupBy("cell").count().agg({"count": "max"}).first()[0] < 400
    for radius in (0.3, 1.9, 30.0):  # within, and beyond the finest cells
        got = kept.match(det, radius, strict=False)
        want = spatial.radius_join(det.where("ra is not null and not isnan(ra) and dec <= 90"), stars.where("not isnan(sra)"), radius, "sky", right_on=("sra", "sdec"))
        plain = lambda t: sorted((r["det_id"], r["star_id"], round(r["dist"], 6)) for r in t.collect())
        assert plain(got) == plain(want) and plain(got)
        assert sorted(got.columns) == sorted(want.columns)


def test_pixels_empty_tables_and_names(spark, tmp_path):
    stars = spark.createDataFrame([(1, 5.0, 5.0), (1, 5.0, 5.0), (2, -3.0, 4.0)], "star_id int, sx double, sy double")
    det = spark.createDataFrame([(7, 5.0, 6.0), (8, -3.0, 4.0)], "det_id int, x double, y double")
    kept = CellCatalog.save(stars, f"file://{tmp_path}/pix", 10.0, "pixel", ("sx", "sy"), levels=2, most=1, buckets=2)
    assert sorted((r["det_id"], r["star_id"], r["dist"]) for r in kept.match(det, 1.0).collect()) == [(7, 1, 1.0), (7, 1, 1.0), (8, 2, 0.0)]
    assert [r["det_id"] for r in kept.match(det, 1.0, strict=True).collect()] == [8]
    assert kept.match(det.limit(0), 1.0).count() == 0
    empty = CellCatalog.save(stars.limit(0), f"file://{tmp_path}/none", 10.0, "pixel", ("sx", "sy"), buckets=2)
    assert empty.match(det, 1.0).count() == 0
    with pytest.raises(ValueError):
        CellCatalog.save(stars, f"file://{tmp_path}/bad", 1.0, "galactic")


def test_catalogue_is_not_exchanged(spark, tmp_path):
    stars = spark.createDataFrame(field(spark, 3), "star_id int, sra double, sdec double")
    det = spark.createDataFrame(field(spark, 4), "det_id int, ra double, dec double")
    CellCatalog.save(stars, f"file://{tmp_path}/cells", 60.0, on=("sra", "sdec"), buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = spark.newSession()
        other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for session, rows in ((spark, det), (other, other.createDataFrame(field(spark, 4), "det_id int, ra double, dec double"))):
            kept = CellCatalog(session, f"file://{tmp_path}/cells")
            plan = kept.match(rows, 2.0)._jdf.queryExecution().executedPlan().toString()
            scan = plan[plan.index("SortMergeJoin") :]
            assert scan.count("Exchange") == 1 and "Bucketed: true" in scan
            assert scan.index("Exchange") < scan.index("FileScan")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
