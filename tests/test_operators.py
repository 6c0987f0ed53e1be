"""Golden values, and joins and clusters against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duskfield.functions import geometry as geo
from duskfield.functions import identity as ident
from duskfield.functions import photometry as phot
from duskfield.operators import cluster, epochs, features, graph, images, lightcurve, spatial
from duskfield.plans import pipeline
from duskfield.sources import catalogs
from duskfield.sources.config import Settings
from duskfield.streaming import ingest


def one(spark, value, **cols):
    row = spark.createDataFrame([tuple(cols.values()) or (0,)], list(cols) or ["none"])
    return row.select(value.alias("v")).first()["v"]


@pytest.mark.parametrize("cols, want", [({}, 1.0), ({"fwhm_ratio": 1.0}, 1.5), ({"fwhm_ratio": 2.0}, 1.5 * math.exp(-2)), ({"axis_ratio": 0.5}, 0.75), ({"axis_ratio": 1.5}, 1.5), ({"snr_auto": 20.0}, 2.0), ({"snr_auto": 5.0}, 0.5), ({"flags": 4}, 0.5), ({"flags": 0}, 1.0), ({"nearest_source_dist": 5.0}, 0.5), ({"nearest_source_dist": 20.0}, 1.0), ({"mag": 14.0, "maglim": 17.0}, 1.6), ({"mag": 5.0, "maglim": 20.0}, 2.0), ({"mag": 25.0, "maglim": 17.0}, 0.5), ({"mag": 15.0}, 1.0), ({"mag": 9.0}, 3.0), ({"mag": 30.0}, 0.1), ({"candidate_type": "trail", "fwhm_ratio": 1.0}, 0.5)])
def test_base_score(spark, cols, want):
    assert one(spark, features.base_score(set(cols)), **cols) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("mean, spread, want", [(12.0, 1.0, 2 * math.e), (15.0, 10.0, 30.0)])
def test_light_curve_factor(spark, mean, spread, want):
    assert one(spark, features.light_curve_factor(F.lit(mean), F.lit(spread), F.lit(1), 1)) == pytest.approx(want, abs=1e-9)


def test_radii(spark):
    assert one(spark, features.pixel_radius(F.lit(1.0), F.lit(1.0), 3.0, F.lit(1.0))) == pytest.approx(3 * math.sqrt(2))
    assert one(spark, features.pixel_radius(F.lit(1.0), F.lit(1.0), 3.0, F.lit(1.5))) == pytest.approx(3 * math.sqrt(3))
    assert one(spark, features.pixel_radius(F.lit(1e-9), F.lit(0.0), 3.0, F.lit(1.0))) == 1.0
    assert one(spark, features.pixel_radius(F.lit(1e9), F.lit(0.0), 3.0, F.lit(1.0))) == 8.0
    assert one(spark, features.pixel_radius(F.lit(float("nan")), F.lit(0.0), 3.0, F.lit(1.0))) is None


def test_bands_and_response(spark):
    x = spark.createDataFrame([(15.0, None, 99.0, None, None), (None, None, 14.0, None, None)], "g double, r double, i double, z double, j double")
    rows = x.select(*[v.alias(b) for b, v in zip("grizj", phot.fill_bands([F.col(b) for b in "grizj"]), strict=True)]).collect()
    assert rows[0]["g"] is None and rows[1]["g"] is None
    y = spark.createDataFrame([(15.0, 14.5)], "g double, r double").withColumn("n", F.lit(None).cast("double"))
    assert [y.select(v).first()[0] for v in phot.fill_bands([F.col("g"), F.col("r"), F.col("n")])] == pytest.approx([15.0, 14.5, 14.8])
    assert phot.parse_response("Z=25.0,PX=0.1,SC=0.2") == {"Z": 25.0, "PX": 0.1, "SC": 0.2}
    with pytest.raises(ValueError):
        phot.parse_response("Q=1")


def test_response_of_stars_is_the_fitted_model(spark):
    """Colours against none by the names in a map, next to the model that is built from a dict."""
    colours, level = [0.7, -0.2, 0.35, 1.1], F.lit(0.0)
    half, zero = F.lit(0.5), F.lit(0.0)
    model = lambda t, c: phot.fitted_model(t, zero, F.lit(1.0), zero, zero, [F.lit(v) for v in c], half, half, F.lit(0))
    for line in ("Z=25.0", "PC=0.3,P2D=-0.1,PX=0.4,PXC=9", "P2CD=0.3,PAE=0.2,PNF=0.01", "PD:1=0.2,PD:2=7", *(f"{n}={v}" for n in ("XC", "SC") for v in (-0.7, -0.3, 0.2, 0.8, 1.2, 1.8)), "GA=0.1,GW=-1,RS=0.2,RC=0.1"):
        terms = phot.parse_response(line)
        got = one(spark, phot.response_model(phot.response_terms(F.col("t")), [F.lit(c) for c in colours]), t=line)
        assert got == pytest.approx(one(spark, model(terms, colours) - model(terms, [0.0] * 4) + level, t=line), abs=1e-9), line
    text = F.col("t")
    assert one(spark, phot.response_model(phot.response_terms(text), [F.lit(c) for c in colours]), t="FILTER=r,PC=x,,SCHEMA") == 0.0
    assert one(spark, phot.response_model(phot.response_terms(text), [F.lit(None).cast("double"), *[F.lit(0.1)] * 3]), t="PC=1") is None
    assert one(spark, phot.response_model(F.lit(None).cast("map<string,double>"), [F.lit(0.1)] * 4), t="") == 0.0


def test_stars_as_exposures_see_them(spark):
    stars = spark.createDataFrame([(1, 10.0, 20.0, 15.0, 14.6, None), (2, 10.01, 20.0, None, 14.0, None), (3, 190.0, -20.0, 15.0, 14.0, 13.9), (4, None, 20.0, 15.0, 14.0, 13.9)], "star_id int, radeg double, decdeg double, Sloan_g double, Sloan_r double, Sloan_z double")
    frames = spark.createDataFrame([(0, 10.0, 20.0, 1.0, 50.0, 60.0, 100, 120, "PC=0.5"), (1, 10.0, 20.0, 1.0, 50.0, 60.0, 100, 120, None), (2, None, 20.0, 1.0, 50.0, 60.0, 100, 120, "PC=0.5")], "epoch_id int, ra0 double, dec0 double, scale double, px0 double, py0 double, width int, height int, response string")
    got = {(r["epoch_id"], r["star_id"]): r for r in catalogs.frame_stars(stars, frames).collect()}
    assert set(got) == {(0, 1), (0, 2), (1, 1), (1, 2)}
    assert (got[0, 1]["sx"], got[0, 1]["sy"]) == pytest.approx((50.0, 60.0), abs=1e-6) and got[0, 1]["star_mag"] == pytest.approx(14.6 + 0.5 * 0.4)
    assert got[0, 2]["star_mag"] is None and got[1, 1]["star_mag"] == pytest.approx(14.6)
    assert got[0, 2]["sx"] == pytest.approx(50.0 - 36 * math.cos(math.radians(20)), abs=1e-3)
    assert catalogs.frame_stars(stars.limit(0), frames).count() == 0 and catalogs.frame_stars(stars, frames.limit(0)).count() == 0


def test_votes_from_catalogue_rows(spark):
    """Catalogue rows placed in each exposure give what stars placed beforehand give."""
    g = random.Random(4)
    rows = [(e * 100 + k, e, 3600.0 * e, 10 + (k % 10) * 0.01, 20 + (k // 10) * 0.01, 15.0 + g.gauss(0, 0.3), 0.02, 3.0, 1.5, 1.4, 0.0, 0, 19.0) for e in range(4) for k in range(40)]
    det = spark.createDataFrame(rows, "det_id long, epoch_id int, obs_time double, ra double, dec double, mag double, err double, fwhm double, a double, b double, theta double, flags int, maglim double")
    x, y = geo.tan_pixel(F.col("ra"), F.col("dec"), 10.0, 20.0, 1.0, 400.0, 10.0)
    det = det.withColumns({"x": x, "y": y})
    stars = det.where("epoch_id = 0 and det_id % 3 <> 0").select(F.col("det_id").alias("star_id"), F.col("ra").alias("radeg"), F.col("dec").alias("decdeg"), F.lit(15.4).alias("Sloan_g"), F.lit(15.0).alias("Sloan_r"))
    frames = det.select("epoch_id").distinct().select("epoch_id", F.lit(10.0).alias("ra0"), F.lit(20.0).alias("dec0"), F.lit(1.0).alias("scale"), F.lit(400.0).alias("px0"), F.lit(10.0).alias("py0"), F.lit(800).alias("width"), F.lit(400).alias("height"), F.lit("PC=0.25").alias("response"))
    s = Settings(min_quality=0.0, min_n_detections=2)
    seen, _ = pipeline.CatalogVotes({"panstarrs": stars}, s, exposures=frames).run(det)
    placed = stars.withColumns(dict(zip(("sx", "sy"), geo.tan_pixel(F.col("radeg"), F.col("decdeg"), 10.0, 20.0, 1.0, 400.0, 10.0), strict=True))).select("sx", "sy", F.lit(15.1).alias("star_mag"))
    known, _ = pipeline.CatalogVotes({"panstarrs": placed}, s).run(det)
    plain = lambda t: sorted((r["transient_id"], r["candidate_type"], round(r["quality_score"], 9)) for r in t.collect())
    assert plain(seen) == plain(known) and len({r[1] for r in plain(seen)}) >= 2


def test_names(spark):
    want = {" 94249.01 ": "94249", "a--b": "a_b", "...": "unknown", "__x__": "x"}
    for text, out in want.items():
        assert one(spark, ident.clean_observation_id(F.col("t")), t=text) == out
    assert one(spark, ident.base_filename(F.col("t"), F.lit(3)), t="/a/b c.fits") == "b_c"
    assert one(spark, ident.observation_id([], F.col("t")), t="/d/obs_12345_x.ecsv") == "12345"
    assert one(spark, ident.exposure_from_name(F.col("t")), t="img_exp30.fits") == 30.0
    assert one(spark, ident.json_value(F.col("t")), t="nan") is None


def separation(a, b):
    v = [(math.cos(math.radians(d)) * math.cos(math.radians(r)), math.cos(math.radians(d)) * math.sin(math.radians(r)), math.sin(math.radians(d))) for r, d in (a, b)]
    return math.degrees(2 * math.asin(min(1.0, math.dist(*v) / 2))) * 3600


@pytest.mark.parametrize("centre", [(0.0, 10.0), (120.0, 89.9995), (200.0, -45.0)])
def test_sky_join(spark, centre):
    random.seed(1)
    points = [((centre[0] + random.uniform(-0.003, 0.003) * (300 if centre[1] > 89 else 1)) % 360, min(90.0, centre[1] + random.uniform(-0.003, 0.003))) for _ in range(120)]
    a = spark.createDataFrame([(k, *p) for k, p in enumerate(points[:60])], "i long, ra double, dec double")
    b = spark.createDataFrame([(k, *p) for k, p in enumerate(points[60:])], "j long, sra double, sdec double")
    got = {(r["i"], r["j"]) for r in spatial.radius_join(a, b, 4.0, "sky", right_on=("sra", "sdec")).collect()}
    assert got == {(i, j) for i, p in enumerate(points[:60]) for j, q in enumerate(points[60:]) if separation(p, q) <= 4.0}


def test_pixel_join_and_system(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 0.0)], "i long, x double, y double")
    b = spark.createDataFrame([(1, 3.0, 0.0), (2, -3.0, 0.0)], "j long, u double, v double")
    assert {(r["i"], r["j"]) for r in spatial.radius_join(a, b, 3.0, right_on=("u", "v")).collect()} == {(1, 1), (1, 2), (2, 1)}
    assert {(r["i"], r["j"]) for r in spatial.radius_join(a, b, 3.0, right_on=("u", "v"), strict=True).collect()} == {(2, 1)}
    assert [r["i"] for r in spatial.radius_anti(a, b.where("j = 2"), 3.0, right_on=("u", "v")).collect()] == [2]
    with pytest.raises(ValueError):
        spatial.radius_join(a, b, 1.0, "galactic")


def test_components(spark):
    random.seed(2)
    n, edges = 200, [(random.randrange(200), random.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(150, 190)]
    root = list(range(n))
    for _ in range(n):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    nodes = spark.range(n).withColumnRenamed("id", "det_id")
    got = graph.connected_components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["det_id"]: r["component"] for r in got} == dict(enumerate(root))


def test_greedy_split(spark):
    rows = [(0, k, e, 1.0 - k / 10, 180.0, 30.0) for k, e in enumerate([0, 1, 1, 2])]
    got = graph.greedy_split(spark.createDataFrame(rows, "component long, det_id long, epoch_id int, quality double, ra double, dec double"), 2.0).collect()
    assert {r["det_id"]: r["sub"] for r in got} == {0: 0, 1: 0, 2: 1, 3: 0}


def test_dipole_and_stack():
    assert epochs.needs_stack(10, None, None) and not epochs.needs_stack(9, None, None)
    assert not epochs.needs_stack(12, 10, 0.2) and epochs.needs_stack(15, 10, 0.2) and not epochs.needs_stack(15, 10, 1.0)


def test_stamps(spark):
    flat = [0.0] * 64
    flat[3 * 8 + 4], flat[3 * 8 + 5] = 10.0, -9.0
    x = spark.createDataFrame([(flat, 10.0), ([0.0] * 64, 10.0)], "s array<double>, f double")
    got = [r[0] for r in x.select(images.is_dipole(F.col("s"), 8, F.lit(4), F.lit(3), 1, F.col("f"))).collect()]
    assert got == [True, False]
    assert one(spark, F.aggregate(images.psf_stamp(1.5, 3), F.lit(0.0), lambda a, b: a + b)) == pytest.approx(1.0)


def test_motion(spark):
    rows = [(1, k, k, 3600.0 * k, 180.0 + k / 3600, 30.0 - k / 7200, 15.0, 0.1) for k in range(5)]
    got = lightcurve.motion(spark.createDataFrame(rows, "gid long, det_id long, epoch_id int, obs_time double, ra double, dec double, mag double, err double")).first()
    assert got["motion_dec_as_per_hr"] == pytest.approx(-0.5) and got["motion_ra_as_per_hr"] == pytest.approx(math.cos(math.radians(30)), rel=1e-6)


def test_empty_union_keeps_types(spark):
    a = spark.createDataFrame([], "quality_score double, candidate_type string")
    b = spark.createDataFrame([("new", 1.0)], "candidate_type string, quality_score double")
    assert dict(a.unionByName(b, allowMissingColumns=True).dtypes) == {"quality_score": "double", "candidate_type": "string"}


def test_projection_round_trip(spark):
    x = spark.createDataFrame([(180.01, 30.02), (179.95, 29.97)], "ra double, dec double")
    px, py = geo.tan_pixel(F.col("ra"), F.col("dec"), 180.0, 30.0, 0.5, 512.0, 512.0)
    back = geo.tan_sky(F.col("px"), F.col("py"), 180.0, 30.0, 0.5, 512.0, 512.0)
    for r in x.withColumns({"px": px, "py": py}).select("ra", "dec", back[0].alias("a"), back[1].alias("d")).collect():
        assert (r["a"], r["d"]) == pytest.approx((r["ra"], r["dec"]), abs=1e-9)


def test_stream_of_bursts(spark, tmp_path):
    src, seen = str(tmp_path / "in"), {}
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("k string, v int").parquet(src)
    q = ingest.run_bursts(stream, "k", str(tmp_path / "cp"), lambda df, n: seen.update({r["k"]: r["n"] for r in df.collect()}))
    q.awaitTermination(60)
    assert seen == {"a": 2, "b": 1}


def test_vote(spark):
    rows = [(0, 0, 1.0, 1.0, 0.5, "gaia"), (1, 0, 1.1, 1.0, 0.5, "usno"), (2, 0, 9.0, 9.0, 0.5, "gaia"), (3, 1, 9.0, 9.0, 0.5, "usno")]
    got = cluster.vote(spark.createDataFrame(rows, "cand_id long, epoch_id int, x double, y double, r double, catalog string"), 0.5, 2, 1.0).collect()
    assert [(r["component"], r["votes"]) for r in got] == [(0, 2)]


# --- against brute force -------------------------------------------------------------------------------------------


def sep(a, d, b, e):
    a, d, b, e = map(math.radians, (a, d, b, e))
    h = math.sin((e - d) / 2) ** 2 + math.cos(d) * math.cos(e) * math.sin((b - a) / 2) ** 2
    return math.degrees(2 * math.asin(math.sqrt(h))) * 3600


def classes(keys, linked):
    root = {k: k for k in keys}
    for a in keys:
        for b in keys:
            if a < b and root[a] != root[b] and linked(a, b):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return root


def split_greedily(members, radius):
    """members: (key, epoch, quality, ra, dec) -> key -> number of its group."""
    groups, out = [], {}
    for key, epoch, _, ra, dec in sorted(members, key=lambda m: (-m[2], m[0])):
        for k, g in enumerate(groups):
            mid = [sum(m[i] for m in g) / len(g) for i in (3, 4)]
            if epoch not in {m[1] for m in g} and sep(*mid, ra, dec) <= radius:
                g.append((key, epoch, 0, ra, dec))
                out[key] = k
                break
        else:
            groups.append([(key, epoch, 0, ra, dec)])
            out[key] = len(groups) - 1
    return out


def field(seed, n=160, epochs_=5):
    """Detections around a few positions: (det_id, epoch_id, ra, dec, r, quality)."""
    g = random.Random(seed)
    spots = [(g.uniform(10, 10.004), g.uniform(20, 20.004)) for _ in range(25)]
    out = []
    for i in range(n):
        a, d = g.choice(spots)
        out.append((i, g.randrange(epochs_), a + g.gauss(0, 0.7) / 3600, d + g.gauss(0, 0.7) / 3600, g.uniform(0.5, 2.0), round(g.random(), 3)))
    return out


def brute_cross_epoch(rows, radius, least):
    by = {x[0]: x for x in rows}
    first = classes(by, lambda a, b: sep(*by[a][2:4], *by[b][2:4]) <= min(by[a][4], by[b][4], 0.6 * radius))
    groups = {}
    for k, c in first.items():
        groups.setdefault(c, []).append(by[k])
    mid = {c: [sum(m[i] for m in g) / len(g) for i in (2, 3)] for c, g in groups.items()}
    apart = lambda a, b: not {m[1] for m in groups[a]} & {m[1] for m in groups[b]}
    merged = classes(groups, lambda a, b: sep(*mid[a], *mid[b]) <= radius and apart(a, b))
    out = {}
    for c in set(merged.values()):
        members = [m for k, g in groups.items() if merged[k] == c for m in g]
        if len(members) >= least:
            got = split_greedily([(m[0], m[1], m[5], m[2], m[3]) for m in members], radius)
            for k, s in got.items():
                if sum(v == s for v in got.values()) >= least:
                    out[k] = (c, s)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cross_epoch_is_brute_force(spark, seed):
    rows = field(seed) + [(1000, 0, float("nan"), 20.0, 1.0, 0.5), (1001, 0, 10.0, 95.0, 1.0, 0.5)]
    got = cluster.cross_epoch(spark.createDataFrame(rows, "det_id long, epoch_id int, ra double, dec double, r double, quality double"), 2.0, 2).collect()
    want = brute_cross_epoch(rows[:-2], 2.0, 2)
    assert want and {r["det_id"]: (r["component"], r["sub"]) for r in got} == want


def test_greedy_split_is_brute_force(spark):
    rows = [(i % 6, *x) for i, x in enumerate(field(9, 240))]
    got = graph.greedy_split(spark.createDataFrame(rows, "component long, det_id long, epoch_id int, ra double, dec double, r double, quality double"), 6.0).collect()
    want = {}
    for c in range(6):
        want |= split_greedily([(x[1], x[2], x[6], x[3], x[4]) for x in rows if x[0] == c], 6.0)
    assert {r["det_id"]: r["sub"] for r in got} == want


def test_source_list_is_brute_force(spark):
    rows = [x[:4] for x in field(4, 300, 7)] + [(900, 1, None, None)]
    got = {r["det_id"]: r["source"] for r in graph.source_list(spark.createDataFrame(rows, "det_id long, epoch_id int, ra double, dec double"), 1.5).collect()}
    opened, want = [], {}
    for e in range(7):
        known = list(opened)
        for k, _, a, d in sorted(x for x in rows if x[1] == e and x[2] is not None):
            near = [s for s in known if sep(a, d, s[1], s[2]) <= 1.5]
            want[k] = near[0][0] if near else k
            if not near:
                opened.append((k, a, d))
    # a source's number in the list is its order of opening, by exposure and then key
    assert got == want


def test_terms_are_fitted_robustly(spark):
    g = np.random.default_rng(3)
    rows = []
    for e in range(3):
        for _ in range(80):
            x, y = g.uniform(-1, 1, 2)
            v = 20 + e + 0.3 * x - 0.1 * y + g.normal(0, 0.02) + (5.0 if g.random() < 0.05 else 0.0)
            rows.append((e, float(v), float(g.uniform(0.01, 0.05)), float(x), float(y)))
    rows += [(7, 1.0, 0.1, 0.5, 0.5), (7, 1.2, 0.1, 0.5, 0.5), (0, None, 0.1, 0.0, 0.0), (1, 1.0, float("nan"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "epoch_id int, m double, e double, x double, y double").repartition(5)
    got = {}
    for r in epochs.fit_terms(df, "epoch_id", "m", "e", {"Z": F.lit(1.0), "PX": F.col("x"), "PY": F.col("y")}).collect():
        got[r["epoch_id"], r["term"]] = (r["value"], r["error"])
    for e in (0, 1, 2, 7):
        own = np.array([r[1:] for r in rows if r[0] == e and r[1] is not None and r[2] == r[2]], float)
        a, w = np.column_stack([np.ones(len(own)), own[:, 2:]]), 1 / own[:, 1] ** 2
        for _ in range(8):
            cov = np.linalg.pinv(a.T @ (a * w[:, None]), rcond=1e-12, hermitian=True)
            beta = cov @ (a.T @ (own[:, 0] * w))
            w = 1 / own[:, 1] ** 2 / (1 + ((own[:, 0] - a @ beta) / own[:, 1]) ** 2)
        for k, t in enumerate(("Z", "PX", "PY")):
            assert got[e, t] == pytest.approx((beta[k], math.sqrt(max(cov[k, k], 0))), rel=1e-6, abs=1e-9)
    assert abs(got[1, "PX"][0] - 0.3) < 0.05 and abs(got[2, "Z"][0] - 22) < 0.05  # outliers don't pull


def test_votes_are_brute_force(spark):
    g = random.Random(6)
    rows = []
    for i, (k, e, a, d, r, q) in enumerate(field(8, 200, 3)):
        kind = g.choice(["new", "brightening", "fading", "unknown"])
        rows.append((i, k, e, a, d, r, g.choice(["gaia", "usno", "atlas"]), q, kind, g.choice([float("nan"), 0.0, -1.5, 0.7])))
    df = spark.createDataFrame(rows, "cand_id long, det_id long, epoch_id int, ra double, dec double, r double, catalog string, quality double, candidate_type string, magnitude_difference double")
    got = {r["cand_id"]: r for r in cluster.vote_candidates(df, 2.0, 3, 0.6).collect()}
    by = {x[0]: x for x in rows}
    comp = classes(by, lambda a, b: by[a][2] == by[b][2] and sep(*by[a][3:5], *by[b][3:5]) <= min(by[a][5], by[b][5]))
    want = {}
    for c in set(comp.values()):
        own = [by[k] for k in by if comp[k] == c]
        votes = len({m[6] for m in own})
        if votes >= 2:
            best = max(own, key=lambda m: (m[7], -m[0]))
            kind = max(own, key=lambda m: (features.TYPE_PRIORITY[m[8]], m[7], -m[0]))[8]
            sized = [m for m in own if m[8] == kind and m[9] == m[9]]
            want[best[0]] = (votes, kind, max(sized, key=lambda m: (abs(m[9]), -m[0]))[9] if sized else None)
    assert want and {k: (r["votes"], r["candidate_type"], r["magnitude_difference"]) for k, r in got.items()} == want


def test_nearest_has_no_bound(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 5000.0, 3.0), (3, float("nan"), 0.0)], "i long, x double, y double")
    b = spark.createDataFrame([(7, 1.0, 0.0), (8, -1.0, 0.0), (9, 100.0, 0.0)], "j long, u double, v double")
    got = {r["i"]: (r["j"], r["dist"]) for r in spatial.nearest_any(a, b, 0.5, "i", "j", right_on=("u", "v")).collect()}
    assert got == {1: (7, 1.0), 2: (9, math.hypot(4900, 3))}
    assert spatial.nearest_any(a, b.where("false"), 0.5, "i", "j", right_on=("u", "v")).count() == 0
    sky = spatial.nearest_any(spark.createDataFrame([(1, 359.9, 0.0)], "i long, ra double, dec double"), spark.createDataFrame([(7, 179.9, 0.0), (8, 0.2, 1.0)], "j long, u double, v double"), 1.0, "i", "j", system="sky", right_on=("u", "v")).first()
    assert sky["j"] == 8


def test_anti_is_one_join(spark):
    a = spark.createDataFrame([(i, float(i), 0.0, i % 2) for i in range(10)], "i long, x double, y double, e int")
    b = spark.createDataFrame([(2.0, 0.0, 0), (7.0, 0.0, 0)], "u double, v double, e int")
    x = spatial.radius_anti(a, b, 1.0, right_on=("u", "v"), by=("e",))
    assert sorted(r["i"] for r in x.collect()) == [0, 1, 3, 4, 5, 7, 9] and x.columns == a.columns
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftAnti") >= 1 and "Cartesian" not in plan and "NestedLoop" not in plan


def test_terms_of_a_fit():
    t = phot.TermList({"Z": 25.0, "PX": 0.1})
    t.hold("PX")
    t.fit("GA", 0.2)
    t.hold("Z", 24.0)
    t.fit("Z")
    assert t.free == {"GA": 0.2, "Z": 24.0} and t.held == {"PX": 0.1} and t.value("PX") == 0.1
    t.hold_all()
    t.remove("GA")
    assert t.free == {} and phot.parse_response(t.line()) == {"Z": 24.0, "PX": 0.1}
    with pytest.raises(ValueError):
        t.fit("QQ")


def test_model_table(spark):
    x = phot.model_table(spark, {"Z": (24.0, 0.1), "P2C": (0.5, 0.0)})
    assert x.columns == ["term", "val", "err"] and phot.model_terms(x) == {"Z": (24.0, 0.1), "P2C": (0.5, 0.0)}


def test_unknown_engine():
    with pytest.raises(ValueError):
        images.subtract("nothing", None, None)


def test_bodies_variables_and_trails_leave_the_plan(spark):
    """A steady new source, one on a variable star, a moving body that the ephemeris knows, and a moving one that it doesn't."""
    g, rows, k = random.Random(2), [], 0
    spots = {"steady": (10.0, 20.0, 0.0), "variable": (10.01, 20.0, 0.0), "body": (10.02, 20.0, 0.0), "mover": (10.03, 20.0, 1.2)}
    for e in range(6):
        for name, (a, d, rate) in spots.items():
            a += rate * e / 3600 / math.cos(math.radians(20))
            mag = 17.0 + 0.5 * (e % 2) + g.gauss(0, 0.01)
            x, y = (a - 9.99) * 3600 * math.cos(math.radians(20)) * 3, (d - 19.99) * 3600 * 3
            rows.append((k, e, 3600.0 * e, a, d + g.gauss(0, 0.02) / 3600, x, y, mag, 0.02, 3.0, 1.5, 1.4, 0.0, 0, 20.0, name))
            k += 1
    det = spark.createDataFrame(rows, "det_id long, epoch_id int, obs_time double, ra double, dec double, x double, y double, mag double, err double, fwhm double, a double, b double, theta double, flags int, maglim double, name string")
    none = spark.createDataFrame([(5000.0, 5000.0, 15.0)], "sx double, sy double, star_mag double")
    bodies = spark.createDataFrame([(e, 10.02, 20.0) for e in range(6)], "epoch_id int, mra double, mdec double")
    variables = spark.createDataFrame([(10.01, 20.0)], "vra double, vdec double")
    s = pipeline.Settings(position_match_radius_arcsec=8.0, min_quality=0.001, adaptive_nsigma=6.0)
    rows_, points = pipeline.CatalogVotes({"gaia": none, "usno": none}, s, movers=bodies, variables=variables, frame=(4000.0, 4000.0), ast_sigma=0.3).run(det)
    found = {r["name"]: r for r in rows_.join(det.select("det_id", "name"), "det_id").collect()}
    assert set(found) == {"steady", "mover"} and found["steady"]["votes"] if "votes" in rows_.columns else set(found) == {"steady", "mover"}
    assert found["steady"]["candidate_type"] == "new" and found["mover"]["candidate_type"] == "trail"
    assert found["steady"]["n_detections"] == 6 and points.select("gid").distinct().count() == 2
    plain, _ = pipeline.CatalogVotes({"gaia": none, "usno": none}, s, extend=lambda r, p: r.withColumn("seen", F.lit(p.count()))).run(det)
    assert plain.count() == 4 and plain.first()["seen"] == 24
    edge, _ = pipeline.CatalogVotes({"gaia": none, "usno": none}, s, frame=(150.0, 4000.0)).run(det)
    assert {r["det_id"] % 4 for r in edge.collect()} == {0}


def percentile(values, q):
    v = sorted(values)
    at = q * (len(v) - 1)
    low = math.floor(at)
    return v[low] + (v[min(low + 1, len(v) - 1)] - v[low]) * (at - low)


def brute_catalog_votes(rows, catalogs, bodies, variables, s, frame, ast_sigma):
    """The plan in plain loops: rows are dicts of the detections' columns."""
    clip = lambda v, a, b: min(max(v, a), b)
    out = []
    for e in sorted({r["epoch_id"] for r in rows}):
        own = [r | {"match": clip(s.adaptive_nsigma * math.sqrt(r["ex2"] + r["ey2"]), 1, 8)} for r in rows if r["epoch_id"] == e]
        cap = percentile([r["match"] for r in own], s.adaptive_percentile / 100)
        own = [r for r in own if not (r["x"] < 10 or r["y"] < 10 or r["x"] > frame[0] - 10 or r["y"] > frame[1] - 10)]
        for k, (name, stars) in enumerate(catalogs.items()):
            floor = {"gaia": 0.01, "usno": 0.1}[name]
            kept = []
            for r in own:
                near = [m for x, y, m in stars if math.hypot(r["x"] - x, r["y"] - y) <= min(r["match"], cap)]
                usable = [m for m in near if m is not None]
                sigma = math.sqrt(r["err"] ** 2 + 0.01**2 + floor**2)
                big = [r["mag"] - m for m in usable if abs(r["mag"] - m) >= s.mag_change_threshold and abs(r["mag"] - m) / sigma > s.siglim]
                change = max(big, key=abs) if big else None
                if not near:
                    kind, size, ok = "new", 0.0, r["err"] < 1.091 / s.new_source_siglim
                elif not usable:
                    kind, size, ok = "new", None, r["err"] < 1.091 / s.siglim
                else:
                    kind, size, ok = ("brightening" if big and change < 0 else "fading"), change, bool(big) and r["err"] < 1.091 / s.siglim
                if not ok or r["mag"] > s.maglim_filter_multiplier * r["maglim"]:
                    continue
                kept.append((r, kind, size))
            for r, kind, size in kept:
                alone = min([math.hypot(r["x"] - x, r["y"] - y) for x, y, _ in stars], default=math.inf)
                fr, ar, snr = r["fwhm"] / percentile([c["fwhm"] for c, *_ in kept], 0.5), r["b"] / r["a"], 1.0857 / r["err"]
                q = math.exp(-((fr - 1) ** 2) / 0.5) * 1.5 * clip(ar, 0, 1) * 1.5 * clip(snr / 20, 0, 1) * 2 * (0.5 if r["flags"] > 0 else 1) * clip(1 + 0.2 * (r["maglim"] - r["mag"]), 0.5, 2) * clip(alone / 10, 0, 1)
                if q < s.min_quality or any(b[0] == e and sep(r["ra"], r["dec"], b[1], b[2]) < s.vsx_match_radius_arcsec for b in bodies):
                    continue
                reach = clip(s.adaptive_nsigma * r["fwhm"] / 2.35 * math.sqrt(10 / max(snr, 3)), 1, 8) * s.default_plate_scale_arcsec_per_px
                out.append(r | {"cand": r["det_id"] * len(catalogs) + k, "cat": name, "kind": kind, "size": size, "q": q, "r": reach})
    by = {c["cand"]: c for c in out}
    comp = classes(by, lambda a, b: by[a]["epoch_id"] == by[b]["epoch_id"] and sep(by[a]["ra"], by[a]["dec"], by[b]["ra"], by[b]["dec"]) <= min(by[a]["r"], by[b]["r"]))

    def best_of(members, key):
        best = max(members, key=lambda m: (m["q"], -m[key]))
        kind = max(members, key=lambda m: (features.TYPE_PRIORITY[m["kind"]], m["q"], -m[key]))["kind"]
        sized = [m for m in members if m["kind"] == kind and m["size"] is not None]
        return best | {"kind": kind, "size": max(sized, key=lambda m: (abs(m["size"]), -m[key]))["size"] if sized else None}

    cands = []
    for c in set(comp.values()):
        own = [by[k] for k in by if comp[k] == c]
        if len({m["cat"] for m in own}) >= max(1, math.ceil(s.min_catalogs_fraction * len(catalogs))):
            cands.append(best_of(own, "cand"))
    groups = brute_cross_epoch([(c["det_id"], c["epoch_id"], c["ra"], c["dec"], c["r"], c["q"]) for c in cands], s.position_match_radius_arcsec, s.min_n_detections)
    final = {}
    for g in set(groups.values()):
        own = [c for c in cands if groups.get(c["det_id"]) == g]
        rep, mid = best_of(own, "det_id"), [sum(c[k] for c in own) / len(own) for k in ("ra", "dec")]
        points = []
        for e in {r["epoch_id"] for r in rows}:
            near = [(round(sep(*mid, r["ra"], r["dec"]), 7), r["det_id"], r) for r in rows if r["epoch_id"] == e and sep(*mid, r["ra"], r["dec"]) <= s.position_match_radius_arcsec]
            points += [min(near, key=lambda n: n[:2])[2]] if near else []
        if len(points) < s.min_n_detections:
            continue
        ref = min(points, key=lambda p: (p["err"], p["det_id"]))
        t = np.array([(p["obs_time"] - ref["obs_time"]) / 3600 for p in points])
        off = np.array([[(p["ra"] - ref["ra"]) * math.cos(math.radians(ref["dec"])) * 3600, (p["dec"] - ref["dec"]) * 3600] for p in points])
        fit = [np.polyfit(t, off[:, k], 1) for k in (0, 1)]
        res = np.column_stack([off[:, k] - np.polyval(fit[k], t) for k in (0, 1)])
        sigma = math.hypot(*[np.median(np.abs(res[:, k] - np.median(res[:, k]))) / 0.67 for k in (0, 1)])
        rate, moving = math.hypot(fit[0][0], fit[1][0]), int((np.hypot(res[:, 0], res[:, 1]) <= 2 * sigma + 1e-7).sum())
        angle = math.degrees(math.atan2(fit[0][0], fit[1][0])) % 180
        turn = [abs(angle - p["theta"]) for p in points]
        align = np.mean([1 - (180 - v if v > 90 else v) / 90 for v in turn])
        hours = (max(p["obs_time"] for p in points) - min(p["obs_time"] for p in points)) / 3600
        far, sig = rate * hours / ast_sigma, rate / max(sigma, 1e-6)
        score = 0.35 * np.mean([clip(1 - p["b"] / p["a"], 0, 1) for p in points]) + 0.3 * clip(sig / 10, 0, 1) + 0.15 * clip(align, 0, 1) + 0.2 * clip(far / 5, 0, 1)
        if moving >= 3 and ((sigma >= 0.5 and sig >= 3 and score >= 0.7) or far >= 3) and rep["kind"] not in ("brightening", "fading"):
            rep["kind"] = "trail"
        w = [1 / p["err"] ** 2 for p in points]
        mean, spread = sum(p["mag"] * v for p, v in zip(points, w, strict=True)) / sum(w), max(p["mag"] for p in points) - min(p["mag"] for p in points)
        rep["score"] = rep["q"] * math.exp(-(mean - 15) / 3) * min(spread / 0.5, 3) * spread * math.sqrt(len(points) / s.min_n_detections)
        rep["n"] = len(points)
        ident_ = (round(rep["ra"] * 1000), round(rep["dec"] * 1000))
        if ident_ not in final or rep["score"] > final[ident_]["score"]:
            final[ident_] = rep
    return {r["det_id"]: (r["kind"], r["n"], r["score"]) for r in final.values() if r["score"] >= s.min_quality and not any(sep(r["ra"], r["dec"], *v) < s.vsx_match_radius_arcsec for v in variables)}


@pytest.mark.parametrize("seed", [11, 12])
def test_catalog_votes_are_brute_force(spark, seed):
    g, rows, k = random.Random(seed), [], 0
    spots = [(10 + 0.004 * (i % 8) + g.uniform(0, 0.001), 20 + 0.004 * (i // 8), g.choice([0, 0, 0, 1.0]), g.uniform(15, 18)) for i in range(40)]
    for e in range(6):
        for a, d, rate, mag in spots:
            if g.random() < 0.9:
                a2, d2 = a + (rate * e + g.gauss(0, 0.05)) / 3600, d + g.gauss(0, 0.05) / 3600
                err = g.choice([0.01, 0.03, 0.05, 0.3])
                rows.append({"det_id": k, "epoch_id": e, "obs_time": 3600.0 * e + 10 * g.random(), "ra": a2, "dec": d2, "x": (a2 - 9.99) * 3600 * 3, "y": (d2 - 19.99) * 3600 * 3, "mag": mag + g.gauss(0, 0.4), "err": err + 0.0001 * g.random(), "fwhm": g.uniform(2, 4), "a": 1.6, "b": g.uniform(1, 1.5), "theta": g.uniform(0, 180), "flags": g.choice([0, 0, 1]), "maglim": g.uniform(14, 20), "ex2": g.uniform(0, 0.4), "ey2": g.uniform(0, 0.4)})
                k += 1
    star = lambda known: [((a - 9.99) * 10800 + g.uniform(-2, 2), (d - 19.99) * 10800 + g.uniform(-2, 2), g.choice([None, m, m, m + 1.5])) for a, d, _, m in spots if g.random() < known]
    catalogs = {"gaia": star(0.6), "usno": star(0.4)}
    bodies, variables = [(e, spots[3][0], spots[3][1]) for e in range(6)], [spots[5][:2], spots[9][:2]]
    s = pipeline.Settings(position_match_radius_arcsec=4.0, min_quality=0.02, min_catalogs_fraction=0.5, adaptive_nsigma=4.0, new_source_siglim=4.0)
    det = spark.createDataFrame([tuple(r.values()) for r in rows], list(rows[0])).withColumns({"epoch_id": F.col("epoch_id").cast("int"), "flags": F.col("flags").cast("int")})
    tables = {n: spark.createDataFrame(v, "sx double, sy double, star_mag double") for n, v in catalogs.items()}
    plan = pipeline.CatalogVotes(tables, s, movers=spark.createDataFrame(bodies, "epoch_id int, mra double, mdec double"), variables=spark.createDataFrame(variables, "vra double, vdec double"), frame=(360.0, 2000.0), ast_sigma=0.3)
    got = {r["det_id"]: (r["candidate_type"], r["n_detections"], r["quality_score"]) for r in plan.run(det)[0].collect()}
    want = brute_catalog_votes(rows, catalogs, bodies, variables, s, (360.0, 2000.0), 0.3)
    assert len(want) > 8 and {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert all(got[i][2] == pytest.approx(want[i][2], rel=1e-6) for i in want)


def test_difference_candidates(spark):
    """Steady sources of difference images become candidates with the template's name; dipoles and faint ones don't."""
    g, rows, k = random.Random(5), [], 0
    for e in range(5):
        for i, (err, dipole) in enumerate([(0.02, False), (0.02, True), (0.9, False), (0.05, None)]):
            rows.append((k, e, 3600.0 * e, 10 + 0.01 * i + g.gauss(0, 0.02) / 3600, 20.0, 100.0 * i + 50, 60.0, 17 + 0.4 * (e % 2), err, 3.0 + 0.1 * i, 0.1, 30.0, 1.5, 1.4, 0, 20.0, dipole))
            k += 1
    det = spark.createDataFrame(rows, "det_id long, epoch_id int, obs_time double, ra double, dec double, x double, y double, mag double, err double, fwhm double, ellipticity double, theta double, a double, b double, flags int, maglim double, dipole boolean")
    plan = pipeline.STRATEGIES["subtraction"](pipeline.Settings(min_quality=0.001), "ps1_template")
    assert {r["catalog"] for r in plan.proposals(det).select("catalog").distinct().collect()} == {"ps1_template"}
    got, points = plan.run(det)
    assert sorted(r["det_id"] % 4 for r in got.collect()) == [0, 3] and {r["candidate_type"] for r in got.collect()} == {"new"}
    assert points.where("epoch_id = 2").count() == 2


def test_stack_plan(spark):
    frames = [("a", i, "r" if i % 3 else "g", 30.0 if i % 4 else 60.04, float(i)) for i in range(30)] + [("b", 100 + i, "r", 10.0, float(i)) for i in range(9)]
    frames += [(f, 200 + 50 * k + i, "r", 10.0, float(i)) for k, f in enumerate("cde") for i in range(12)] + [("a", 99, None, 30.0, 99.0)]
    x = spark.createDataFrame(frames, "field string, epoch_id long, filter string, exptime double, obs_time double")
    scores = spark.createDataFrame([("c", 1.2), ("a", 0.3)], "field string, score double")
    done = spark.createDataFrame([("d", 9), ("e", 7)], "field string, n long")
    got = pipeline.stack_plan(x, scores, done, pipeline.Settings(stacking_max_epochs=4)).collect()
    want = sorted((f for f in frames if f[0] == "a" and f[2] == "r" and f[3] == 30.0), key=lambda f: -f[4])[:4]
    assert {r["epoch_id"] for r in got if r["field"] == "a"} == {f[1] for f in want}
    assert {r["field"] for r in got} == {"a", "e"} and sum(r["field"] == "e" for r in got) == 4
    assert pipeline.stack_plan(x, scores, done, pipeline.Settings(stacking_enabled=False)).count() == 0


def test_sources_of_an_image(spark):
    g = np.random.default_rng(4)
    y, x = np.mgrid[0:40, 0:60]
    img = 100 + g.normal(0, 1, x.shape)
    for cx, cy, f in ((12.3, 10.0, 80), (40.0, 25.5, 50)):
        img += f * np.exp(-((x - cx) ** 2 / 2 + (y - cy) ** 2 / 8) / 2)
    img[5, 50] = np.nan
    img[30, 5] = 500.0  # a hot pixel is too small
    pix = spark.createDataFrame([(1, int(j), int(i), float(img[j, i])) for j in range(40) for i in range(60)], "img long, py int, px int, v double")
    got = images.sources(pix, "img", 5.0, 5).orderBy("x").collect()
    assert [(round(r["x"], 0), round(r["y"], 0)) for r in got] == [(12, 10), (40, 26)] or [(round(r["x"], 0), round(r["y"], 0)) for r in got] == [(12, 10), (40, 25)]
    assert all(abs(abs(r["theta"]) - 90) < 12 and r["a"] > r["b"] for r in got) and got[0]["peak"] > got[1]["peak"]


def test_display_levels(spark):
    g = np.random.default_rng(1)
    sky = np.r_[g.normal(100, 5, 900), np.full(100, 5000.0)]
    rows = [(1, sky.tolist()), (2, [3.0] * 20), (3, []), (4, None), (5, [1.0, float("nan"), 2.0]), (6, [0.0] * 99 + [1.0])]
    got = {r["k"]: (r["low"], r["high"]) for r in images.display_levels(spark.createDataFrame(rows, "k long, p array<double>"), "k", "p").collect()}
    assert 70 < got[1][0] < 100 < got[1][1] < 500  # bright pixels don't stretch the sky
    assert got[2] == (3.0, 3.0) and got[3] == got[4] == (None, None) and 1.0 <= got[5][0] < got[5][1] <= 2.0 and got[6][0] == 0.0 and got[6][1] > 0


def test_radii_are_chosen_for_each_exposure(spark):
    """Position errors count in an exposure that has a valid one; its other rows take the default, and other exposures sizes."""
    nan = float("nan")
    rows = [(0, 0, 2.0, 0.01, 1.0, 1.0), (1, 0, 2.0, 0.01, nan, 1.0), (2, 1, 2.35, 0.1091, None, None), (3, 1, 2.35, 0.1091, -1.0, 1.0)]
    det = spark.createDataFrame(rows, "det_id long, epoch_id int, fwhm double, err double, ex2 double, ey2 double")
    s = pipeline.Settings(enable_adaptive_idlimit=True, adaptive_nsigma=2.0, adaptive_percentile=100.0, idlimit_px=1.5, idlimit_min_px=0.1, idlimit_max_px=8.0)
    got = {r["det_id"]: r["match_px"] for r in pipeline.CatalogVotes({}, s).match_radii(det).collect()}
    assert got == pytest.approx({0: 2 * math.sqrt(2), 1: 1.5, 2: 1.0, 3: 1.0})


@pytest.mark.parametrize("system", ["pixel", "sky"])
def test_nearest_over_gaps_is_brute_force(spark, system):
    """Clumps far apart, ties, copies and a first radius that is far too small or too large."""
    rng = random.Random(21)
    far = 3000.0 if system == "pixel" else 60.0
    spot = lambda: (rng.choice([0.0, 1.0, -1.0]) * far + rng.gauss(0, 1), rng.choice([0.0, 0.9]) * far + rng.gauss(0, 1))
    a = [(k, *spot()) for k in range(60)] + [(900, float("nan"), 1.0), (901, 0.0, float("inf"))]
    b = [(k, *spot()) for k in range(25)] + [(40, *a[3][1:]), (41, *a[3][1:]), (99, float("nan"), 0.0)]
    if system == "sky":
        turn = lambda r: (r[0], r[1] % 360, r[2])
        a, b = list(map(turn, a)), list(map(turn, b))
    axes = ("x", "y") if system == "pixel" else ("ra", "dec")
    x, y = spark.createDataFrame(a, f"i long, {axes[0]} double, {axes[1]} double"), spark.createDataFrame(b, "j long, u double, v double")
    dist = (lambda p, q: math.hypot(p[1] - q[1], p[2] - q[2])) if system == "pixel" else (lambda p, q: sep(*p[1:], *q[1:]))
    fine = lambda r: all(map(math.isfinite, r[1:]))
    want = {p[0]: min((round(dist(p, q), 6), q[0]) for q in b if fine(q)) for p in a if fine(p)}
    for first in (0.01, 7.0, 1e5):
        got = spatial.nearest_any(x, y, first, "i", "j", system=system, right_on=("u", "v")).collect()
        assert {r["i"]: r["j"] for r in got} == {k: v[1] for k, v in want.items()}
        assert all(r["dist"] == pytest.approx(want[r["i"]][0], abs=1e-4, rel=1e-6) for r in got)


def _most_joined(plan):
    """The most rows that a join of an executed plan put out."""
    if "AdaptiveSparkPlan" in plan.nodeName():
        return _most_joined(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return _most_joined(plan.plan())
    n = plan.metrics().apply("numOutputRows").value() if "Join" in plan.nodeName() else 0
    return max([n, *[_most_joined(plan.children().apply(k)) for k in range(plan.children().size())]])


def test_nearest_from_far_meets_the_edge_only(spark):
    a = spark.range(400).selectExpr("id as i", "20.0D*(id%20) as x", "3000.0D+20*floor(id/20) as y")
    b = spark.range(1600).selectExpr("id as j", "20.0D*(id%40) as u", "20.0D*floor(id/40) as v")
    got = spatial.nearest_any(a, b, 16.0, "i", "j", right_on=("u", "v"))
    assert all(r["j"] == 1560 + r["i"] % 20 for r in got.collect())
    assert _most_joined(got._jdf.queryExecution().executedPlan()) < 400 * 100  # not 400 * 1600


def test_nearest_from_very_far_meets_few(spark):
    """Where all of an edge is about as far, what is nearer to all rows of a left cell is what counts."""
    a = spark.range(400).selectExpr("id as i", "20.0D*(id%20) as x", "300000.0D+20*floor(id/20) as y")
    b = spark.range(1600).selectExpr("id as j", "20.0D*(id%40) as u", "20.0D*floor(id/40) as v")
    got = spatial.nearest_any(a, b, 16.0, "i", "j", right_on=("u", "v"))
    assert all(r["j"] == 1560 + r["i"] % 20 for r in got.collect())
    assert _most_joined(got._jdf.queryExecution().executedPlan()) < 400 * 10  # not 400 * 40


def test_copies_of_a_position_add_no_pairs(spark, monkeypatch):
    rng = random.Random(5)
    at = [(rng.randrange(6) * 0.5, rng.randrange(4) * 0.5) for _ in range(12)]
    rows = [(k, k % 3, *rng.choice(at), rng.choice([0.3, 0.6, -1.0, 0.0, None])) for k in range(150)] + [(900 + k, 1, float("nan"), 0.0, 0.5) for k in range(2)]
    seen = []
    plain = graph.connected_components
    monkeypatch.setattr(graph, "connected_components", lambda nodes, edges, key: (seen.append(edges.count()), plain(nodes, edges, key))[1])
    got = graph.near_components(spark.createDataFrame(rows, "det_id long, epoch_id int, x double, y double, r double"), 0.7, "det_id", "r", ("epoch_id",))

    def joined(p, q):
        r = [v for v in (p[4], q[4]) if v is not None]
        return p[1] == q[1] and bool(r) and math.hypot(p[2] - q[2], p[3] - q[3]) <= min(0.7, *r)

    by = {r[0]: r for r in rows}
    want = classes(by, lambda a, b: joined(by[a], by[b]))
    assert {r["det_id"]: r["component"] for r in got.collect()} == want
    assert seen[0] < sum(joined(p, q) for p in rows for q in rows if p[0] < q[0])


def test_trails_are_no_single_task(spark):
    """Points are few bytes when packed, which Spark would join into one task that sorts them all."""
    cols = "gid long, det_id long, obs_time double, ra double, dec double, err double, fwhm double, a double, b double, theta double"
    points = spark.createDataFrame([(g, 10 * g + k, 3600.0 * k, 180.0 + k / 3600, 30.0, 0.1, 2.0, 1.5, 1.0, 90.0) for g in range(40) for k in range(4)], cols)
    got = lightcurve.trails(points, F.lit(0.2))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") <= 4  # no pass is computed again within another
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert got.count() == 40 and got.where("is_trail").count() == 40
