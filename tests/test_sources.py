"""Settings, text tables, registries, viewer rows and sinks."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskfield.plans import viewer
from duskfield.sources import catalogs, tables
from duskfield.sources.config import Settings
from duskfield.sources.fits import read_fits
from duskfield.streaming import ingest

TEXT = """# %ECSV 1.0
# ---
# delimiter: ','
# meta: {OBSID: 94249.01, CTIME: 1700000000.0}
NUMBER,ALPHA_J2000,MAG_CALIB
1,180.5,17.25
2,180.6,
"""
SCHEMA = T.StructType([T.StructField("NUMBER", T.LongType()), T.StructField("MAG_CALIB", T.DoubleType()), T.StructField("FLAGS", T.IntegerType())])


def test_text_tables(spark, tmp_path):
    (tmp_path / "a.ecsv").write_text(TEXT)
    (tmp_path / "b.ecsv").write_text("# meta: [\nnot a table")
    (tmp_path / "c.ecsv").write_text("NUMBER FLAGS\n7 4\n")
    every = tables.read_text_tables(spark, f"{tmp_path}/*.ecsv", SCHEMA)
    bad = every.where("problem is not null").collect()
    assert [r["filename"].rsplit("/")[-1] for r in bad] == ["b.ecsv"] and bad[0]["NUMBER"] is None
    rows = every.where("problem is null").orderBy("NUMBER").collect()
    assert [(r["NUMBER"], r["MAG_CALIB"], r["FLAGS"]) for r in rows] == [(1, 17.25, None), (2, None, None), (7, None, 4)]
    assert rows[0]["meta"]["OBSID"] == "94249.01" and rows[0]["filename"].endswith("a.ecsv") and rows[2]["meta"] == {}


def test_conform(spark):
    x = tables.conform(spark.createDataFrame([("5", 1)], "NUMBER string, other int"), SCHEMA)
    assert x.dtypes == [("NUMBER", "bigint"), ("MAG_CALIB", "double"), ("FLAGS", "int")] and x.first()["NUMBER"] == 5


def test_epochs_are_added_once(spark, tmp_path):
    path = str(tmp_path / "epochs")
    tables.add_epochs(spark.createDataFrame([(1, "a"), (2, "b")], "epoch_id int, v string"), path)
    tables.add_epochs(spark.createDataFrame([(2, "again"), (3, "c")], "epoch_id int, v string"), path)
    assert {(r["epoch_id"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "b"), (3, "c")}


def test_states(spark):
    x = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")], "key string, version int, v string")
    assert {(r["key"], r["v"]) for r in tables.latest(x, "key", "version").collect()} == {("k", "new"), ("j", "only")}
    y = spark.range(1).select(F.current_timestamp().alias("at")).union(spark.sql("select timestamp'2001-01-01' as at"))
    assert tables.fresh(y, "at", 30).count() == 1


def test_settings(tmp_path):
    (tmp_path / "a.yaml").write_text("detection: {siglim: 4, catalogs: [gaia, usno], unknown: 1}\nfrontend: {max_candidates: 7}\n")
    (tmp_path / "a.ini").write_text("[detection]\nsiglim = 4\ncatalogs = gaia, usno\n")
    a, b = Settings.read(str(tmp_path / "a.yaml")), Settings.read(str(tmp_path / "a.ini"))
    assert a.siglim == b.siglim == 4.0 and a.catalogs == b.catalogs == ("gaia", "usno") and a.max_candidates == 7
    assert Settings.of({"siglim": "3.5"}).siglim == 3.5 and Settings.of({}) == Settings()
    (tmp_path / "b.yaml").write_text(a.dump())
    assert Settings.read(str(tmp_path / "b.yaml")) == a


def test_viewer(spark):
    x = spark.createDataFrame([(1, "new", None, 1.0), (2, None, 0.5, 9.0), (3, "new", 2.0, 0.1)], "det_id long, type string, sn_score double, quality_score double")
    assert [r["det_id"] for r in viewer.ranked(x, 2, ["sn_score", "quality_score"]).collect()] == [3, 1]
    assert {(r["type"], r["n"]) for r in viewer.facets(x, "type").collect()} == {("new", 2), ("unknown", 1)}
    assert viewer.chosen(x, type="unknown", other=None).count() == 1
    assert json.loads(viewer.candidate_json(x.where("det_id = 3")).first()["value"])["sn_score"] == 2.0
    p = spark.createDataFrame([(1, 15.0), (1, 16.0)], "gid long, mag double")
    assert viewer.axis_range(p).first()[1:] == pytest.approx((14.5, 17.0))
    line = viewer.region_lines(spark.createDataFrame([("t1", 1.0, 2.0)], "transient_id string, ra double, dec double")).first()["value"]
    assert line == 'circle(1.000000,2.000000,5.0") # text={t1}'


def test_either_ending(spark, tmp_path):
    (tmp_path / "a.ecsv").write_text("NUMBER FLAGS\n1 0\n")
    (tmp_path / "a.cat").write_text("NUMBER FLAGS\n9 0\n")
    (tmp_path / "b.ecsv").write_text("# meta: [\nbroken")
    (tmp_path / "b.cat").write_text("NUMBER FLAGS\n2 0\n")
    (tmp_path / "c.cat").write_text("NUMBER FLAGS\n3 0\n")
    (tmp_path / "d.ecsv").write_text("# meta: [\nbroken")
    rows = tables.read_either(spark, str(tmp_path), ["a", "b", "c", "d"], SCHEMA).collect()
    assert sorted((r["stem"], r["NUMBER"]) for r in rows if r["problem"] is None) == [("a", 1), ("b", 2), ("c", 3)]
    assert [r["stem"] for r in rows if r["problem"]] == ["d"]


def test_registered_and_missing(spark, tmp_path):
    x = spark.createDataFrame([(1, 2.0), (2, 3.0), (3, 4.0)], "epoch_id int, v double")
    assert tables.registered(x, x.where("epoch_id <> 2")).count() == 2
    seen, path = [], str(tmp_path / "made")

    def make(df):
        seen.append(sorted(r["epoch_id"] for r in df.collect()))
        return df.withColumn("v", F.col("v") * 2)

    tables.add_missing(x.where("epoch_id < 3"), path, make)
    tables.add_missing(x, path, make)
    assert seen == [[1, 2], [3]] and spark.read.parquet(path).agg(F.sum("v")).first()[0] == 18.0


def test_one_writer_at_a_time(spark, tmp_path):
    path = str(tmp_path / "t")
    with tables.single_writer(spark, path):
        with pytest.raises(TimeoutError), tables.single_writer(spark, path, wait=0.2, pause=0.05):
            pass
    with tables.single_writer(spark, path, wait=0.2):
        pass


def card(key, value):
    return f"{key:<8}= {value:>20}".ljust(80)


def unit(cards, pixels=b""):
    head = "".join(cards + ["END".ljust(80)])
    return head.ljust(-(-len(head) // 2880) * 2880).encode() + pixels.ljust(-(-len(pixels) // 2880) * 2880, b"\0")


def test_fits(spark, tmp_path):
    a = np.arange(12, dtype=">i2").reshape(3, 4)
    cards = [card("SIMPLE", "T"), card("BITPIX", "16"), card("NAXIS", "2"), card("NAXIS1", "4"), card("NAXIS2", "3"), card("BSCALE", "2.0"), card("BZERO", "1.0"), card("BLANK", "2"), "OBJECT  = 'AT ''26'' x' / name".ljust(80)]
    (tmp_path / "a.fits").write_bytes(unit(cards, a.tobytes()))
    empty = [card("SIMPLE", "T"), card("BITPIX", "8"), card("NAXIS", "0")]
    ext = ["XTENSION= 'IMAGE   '".ljust(80), card("BITPIX", "-32"), card("NAXIS", "2"), card("NAXIS1", "2"), card("NAXIS2", "2"), card("PCOUNT", "0")]
    (tmp_path / "b.fits").write_bytes(unit(empty) + unit(ext, np.array([[1, 2], [3, 4.5]], ">f4").tobytes()))
    (tmp_path / "c.fits").write_bytes(b"not one")
    got = {r["path"].rsplit("/")[-1]: r for r in read_fits(spark, f"{tmp_path}/*.fits").collect()}
    assert (got["a.fits"]["width"], got["a.fits"]["height"]) == (4, 3) and got["a.fits"]["header"]["OBJECT"] == "AT '26' x"
    want = [1.0 + 2 * v for v in range(12)]
    assert got["a.fits"]["pixels"] == [None if k == 2 else w for k, w in enumerate(want)]
    assert got["b.fits"]["pixels"] == [1.0, 2.0, 3.0, 4.5] and got["c.fits"]["problem"] and got["c.fits"]["pixels"] is None
    cut = read_fits(spark, f"{tmp_path}/a.fits", (2, 1, 5, 2)).first()
    assert (cut["width"], cut["height"], cut["pixels"]) == (2, 2, [13.0, 15.0, 21.0, 23.0])


def test_catalogs(spark):
    with pytest.raises(ValueError):
        catalogs.catalog("nothing")
    t = spark.createDataFrame([(359.95, 10.0, 15.0), (0.05, 10.0, 15.0), (0.05, 10.0, 25.0), (5.0, 10.0, 15.0), (0.0, 11.0, 15.0)], "ra double, dec double, phot_g_mean_mag double").withColumns({"phot_bp_mean_mag": F.lit(1.0), "phot_rp_mean_mag": F.lit(1.0), "pmra": F.lit(0.1), "pmdec": F.lit(0.2)})
    x = catalogs.reference_stars(t, catalogs.catalog("Gaia@localhost"), 0.0, 10.0, 0.2, 0.2, 20.0)
    assert sorted(r["radeg"] for r in x.collect()) == [0.05, 359.95] and x.columns == ["radeg", "decdeg", "pmra", "pmdec", "G", "BP", "RP"]


def test_keys_run_side_by_side(spark):
    import time

    def work(key):
        if key == "bad":
            raise ValueError("no")
        if key == "slow":
            spark.range(4).repartition(4).mapInPandas(lambda it: (time.sleep(20) or b for b in it), "id long").count()
        spark.range(10).count()

    got = ingest.run_keys(spark, ["a", "b", "a", "bad", "slow"], work, workers=3, timeout=4)
    assert got == {"a": "done", "b": "done", "bad": "ValueError: no", "slow": "timeout"}


def test_only_changes_are_published(spark, tmp_path):
    path, schema = str(tmp_path / "site"), "key string, a int, b double"
    first = ingest.publish_changed(spark.createDataFrame([("x", 1, None), ("y", 2, 1.0)], schema), path, "key")
    second = ingest.publish_changed(spark.createDataFrame([("x", 1, None), ("y", 3, 1.0), ("z", 0, 0.0)], schema), path, "key")
    assert first.count() == 2 and {(r["key"], r["version"]) for r in second.collect()} == {("y", 2), ("z", 1)}


def test_counters(spark, tmp_path):
    seen = ingest.Counters()
    spark.streams.addListener(seen)
    try:
        spark.createDataFrame([("k",), ("j",)], "key string").write.parquet(str(tmp_path / "in"))
        q = ingest.run_bursts(spark.readStream.schema("key string").parquet(str(tmp_path / "in")), "key", str(tmp_path / "c"), lambda df, n: df.collect())
        q.awaitTermination()
        for _ in range(100):
            if seen.running == 0 and seen.rows:
                break
            import time

            time.sleep(0.1)
        assert seen.rows == 2 and seen.failures == 0 and seen.batches >= 1 and "rows 2" in seen.line()
    finally:
        spark.streams.removeListener(seen)


def test_light_curves_and_partitions(spark, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps({"t1": [{"mjd": 1.0, "mag": 17.0, "mag_err": 0.1, "band": "g", "survey": "z", "ulim": False}, {"mjd": 2.0, "mag": 18.0, "band": "g", "survey": "z", "ulim": True}], "t2": []}))
    got = tables.read_light_curves(spark, str(tmp_path / "l.json"))
    assert [(r["gid"], r["mjd"], r["mag_err"], r["ulim"]) for r in got.orderBy("mjd").collect()] == [("t1", 1.0, 0.1, False), ("t1", 2.0, None, True)]
    path = str(tmp_path / "p")
    ingest.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "e int, v string"), path, "e")
    ingest.replace_partitions(spark.createDataFrame([(2, "c")], "e int, v string"), path, "e")
    assert {(r["e"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c")}


def test_regions_are_stored(spark, tmp_path):
    asked = []

    def fetch(name, ra, dec, width, height, limit):
        asked.append((name, ra, dec, width))
        return spark.createDataFrame([(len(asked),)], "n int")

    store = catalogs.CatalogStore(spark, str(tmp_path), fetch)
    assert store.get("gaia", 10.2, 20.1, 0.5, 0.5, 20).first()["n"] == store.get("gaia", 9.8, 19.9, 0.5, 0.5, 20).first()["n"] == 1
    assert store.get("gaia", 10.2, 20.1, 0.5, 0.5, 19).first()["n"] == 2
    assert catalogs.CatalogStore(spark, str(tmp_path), fetch).get("gaia", 10.2, 20.1, 0.5, 0.5, 20).first()["n"] == 1
    assert catalogs.CatalogStore(spark, str(tmp_path), fetch, days=0).get("gaia", 10.2, 20.1, 0.5, 0.5, 20).first()["n"] == 3
    assert asked[0] == ("gaia", 10.0, 20.0, 1.5)


def test_command_line(spark, tmp_path):
    from duskfield.__main__ import main

    rows = [(k, k // 4, 3600.0 * (k // 4), 10 + 0.01 * (k % 4), 20.0, 100.0 * (k % 4) + 50, 100.0, 17.0 + 0.3 * (k // 4 % 2), 0.02, 3.0, 1.5, 1.4, 0.0, 0, 20.0) for k in range(24)]
    spark.createDataFrame(rows, "det_id long, epoch_id int, obs_time double, ra double, dec double, x double, y double, mag double, err double, fwhm double, a double, b double, theta double, flags int, maglim double").write.parquet(str(tmp_path / "d"))
    spark.createDataFrame([(50.0, 100.0, 17.1)], "sx double, sy double, star_mag double").write.parquet(str(tmp_path / "g"))
    (tmp_path / "s.yaml").write_text("detection: {min_quality: 0.001}\n")
    main(["--config", str(tmp_path / "s.yaml"), "votes", "--detections", str(tmp_path / "d"), "--catalog", f"gaia={tmp_path / 'g'}", "--min-found", "4", "--output", str(tmp_path / "o")], spark)
    got = spark.read.parquet(str(tmp_path / "o/candidates"))
    assert got.count() == 3 and {r["candidate_type"] for r in got.collect()} == {"new"}
    assert {r["n_detections"] for r in spark.read.json(str(tmp_path / "o/lightcurve_summary")).collect()} == {6}
    assert spark.read.parquet(str(tmp_path / "o/lightcurves")).count() == 18
    nested = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "o/candidates_json")).collect()]
    assert len(nested) == 3 and all(n["lightcurve"]["n_points"] == 6 for n in nested)
    c = got.selectExpr("det_id", "0 as epoch_id", "ra", "dec", "17.0D as mag", "20.0D as maglim", "0.1D as ellipticity", "1.0D as fwhm_ratio", "0.9D as axis_ratio", "candidate_type", "quality_score as quality")
    c.write.parquet(str(tmp_path / "c"))
    spark.createDataFrame([], "epoch_id int, mra double, mdec double").write.parquet(str(tmp_path / "m"))
    spark.createDataFrame([], "sra double, sdec double, pmra double, pmdec double").write.parquet(str(tmp_path / "st"))
    spark.createDataFrame([(1, 10.01, 20.0)], "gal_id long, gra double, gdec double").write.parquet(str(tmp_path / "ga"))
    spark.createDataFrame([("AT1", 10.02, 20.0)], "name string, kra double, kdec double").write.parquet(str(tmp_path / "k"))
    main(["supernova", "--candidates", str(tmp_path / "c"), "--movers", str(tmp_path / "m"), "--stars", str(tmp_path / "st"), "--galaxies", str(tmp_path / "ga"), "--known", str(tmp_path / "k"), "--target", "10.0", "20.0", "--output", str(tmp_path / "sn")], spark)
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "sn/report_lines")).collect()]
    assert len(lines) == 3 and {x["tns_name"] for x in lines} == {None, "AT1"} and {x["galaxy_flag"] for x in lines} == {"nuclear", "isolated"}
    assert spark.read.json(str(tmp_path / "sn/report")).first()["n_candidates"] == 3
