"""What is kept and brought up to date, against the same from all rows at once."""

import random
import time
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from duskfield.functions.tables import shared_dir
from duskfield.operators import cluster, graph
from duskfield.operators.incremental import ClusterStore
from duskfield.sources import tables


def folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


SKY = "det_id long, epoch_id int, ra double, dec double, r double, quality double"


def exposures(seed, ra0, n=5, sources=14, stray=3):
    """Sources seen in most exposures, near pairs, drifting ones and strays, around a border of tiles (and of 0/360)."""
    rng = random.Random(seed)
    at = [(rng.uniform(-40, 40), rng.uniform(-40, 40)) for _ in range(sources)]
    at += [(x + 1.1, y) for x, y in at[:4]]
    rows = []
    for e in range(n):
        for k, (x, y) in enumerate(at):
            if rng.random() < 0.75:
                drift = 0.7 * e if k % 5 == 0 else 0.0
                rows.append((x + drift + rng.gauss(0, 0.3), y + rng.gauss(0, 0.3), e))
        rows += [(rng.uniform(-60, 60), rng.uniform(-60, 60), e) for _ in range(stray)]
    rng.shuffle(rows)
    return [(k, e, (ra0 + x / 3600) % 360, y / 3600, rng.choice([0.8, 1.5]), rng.random()) for k, (x, y, e) in enumerate(rows)]


@pytest.mark.parametrize("seed,ra0,steps", [(1, 180.0, ((2, 0), (4,), (1, 3))), (2, 0.0, ((0, 1, 2, 4), (3,)))])
def test_exposures_added_one_by_one(spark, seed, ra0, steps):
    rows = exposures(seed, ra0)
    store = ClusterStore(spark, folder(spark, "clusters"), 2.0, 2, tile_degrees=8 / 3600)
    seen = []
    for step in steps:  # exposures need not come in order
        new = [r for r in rows if r[1] in step]
        seen += new
        told = store.add(spark.createDataFrame(new, SKY))
        assert told["added"] == len(new) <= told["clustered"] <= len(seen)
    whole = cluster.cross_epoch(spark.createDataFrame(rows, SKY), 2.0, 2)
    assert sorted(map(tuple, store.clusters().collect())) == sorted(map(tuple, whole.collect()))
    assert store.add(spark.createDataFrame(new, SKY)) == {"added": 0, "clustered": 0, "tiles": 0}


def test_untouched_neighbourhoods_stay(spark):
    """A far exposure clusters its own rows only; a half done update is finished by the next."""
    rows = exposures(3, 100.0, n=3)
    store = ClusterStore(spark, folder(spark, "clusters"), 2.0, 2, tile_degrees=10 / 3600)
    store.add(spark.createDataFrame(rows, SKY))
    before = sorted(map(tuple, store.clusters().collect()))
    far = [(10_000 + k, 9, 200.0, 50.0 + k, 1.0, 0.5) for k in range(3)] + [(10_009, 9, float("nan"), 1.0, 1.0, 0.5)]
    finish, store._finish = store._finish, lambda: None
    store.add(spark.createDataFrame(far, SKY))  # the driver is lost before the tiles are in place
    assert sorted(map(tuple, store.clusters().collect())) == before
    store._finish = finish
    told = store.add(spark.createDataFrame([(20_000, 10, 200.0, 50.0, 1.0, 0.4)], SKY))
    assert told["added"] == 1 and told["clustered"] == 2
    assert sorted(map(tuple, store.clusters().collect())) == sorted([*before, (10_000, 10_000, 0), (20_000, 10_000, 0)])
    with pytest.raises(ValueError):
        ClusterStore(spark, folder(spark, "clusters"), 7200.0, 2)


def test_components_in_rounds(spark, monkeypatch):
    """Rounds with hubs, long chains and the last task agree with union-find."""
    rng = random.Random(4)
    edges = [(0, k) for k in range(1, 300)] + [(k, k + 1) for k in range(1000, 1400)] + [(rng.randrange(2000, 3000), rng.randrange(2000, 3000)) for _ in range(600)]
    up = {k: k for k in range(3200)}

    def top(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    x = spark.createDataFrame(edges, "a long, b long")
    nodes = spark.range(3200).withColumnRenamed("id", "det_id")
    for finish, hub in ((0, 0.1), (500, 0.001), (10**6, 0.001)):
        monkeypatch.setattr(graph, "FINISH", finish)
        monkeypatch.setattr(graph, "HUB", hub)
        assert dict(map(tuple, graph.connected_components(nodes, x).collect())) == {k: top(k) for k in up}


def test_stale_lock_is_broken(spark):
    path = folder(spark, "locked")
    with tables.single_writer(spark, path):
        with pytest.raises(TimeoutError):
            with tables.single_writer(spark, path, wait=0.2, pause=0.05):
                pass
        time.sleep(1.1)
        with tables.single_writer(spark, path, wait=0.2, pause=0.05, stale=1.0):
            pass


def test_source_list_as_a_stream(spark):
    """Exposures that arrive one by one, over a restart, give the batch's list; sources lie across borders of cells."""
    from duskfield.streaming import source_list

    rng = random.Random(9)
    at = [(rng.uniform(-20, 20), rng.uniform(-20, 20)) for _ in range(25)]
    rows = [(e * 1000 + k, e, (x + rng.gauss(0, 0.6)) / 3600 % 360, (y + rng.gauss(0, 0.6)) / 3600) for e in range(5) for k, (x, y) in enumerate(at) if rng.random() < 0.8]
    rows.append((99_999, 2, float("nan"), 1.0))
    x = spark.createDataFrame(rows, "det_id long, epoch_id long, ra double, dec double")
    arrivals, top = folder(spark, "arrivals"), folder(spark, "sources")
    for e in range(5):
        x.where(F.col("epoch_id") == e).coalesce(1).write.mode("append").parquet(arrivals)
        if e in (2, 4):
            stream = source_list.grow(spark, arrivals, top, 1.0)
            stream.processAllAvailable()
            stream.stop()
    got = {r["det_id"]: r["source"] for r in source_list.decisions(spark, top).collect()}
    want = {r["det_id"]: r["source"] for r in graph.source_list(x, 1.0).collect()}
    assert got == want and len(set(want.values())) < len(want)
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{top}/announced").count() > 0


def test_messages_are_landed(spark):
    """Lines that are no messages are kept aside with the reason; a second run reads nothing twice."""
    from duskfield.streaming import ingest

    lines, top = folder(spark, "lines"), folder(spark, "landed")
    given = ['{"ecsv_path": "a.ecsv", "fits_path": "a.fits"}', '{"ecsv_path": "a.ecsv"}', "{broken", '{"fits_path": "b.fits"}', '{"ecsv_path": "b.ecsv", "fits_path": null}', "[]"]
    spark.createDataFrame([(v,) for v in given], "value string").coalesce(1).write.text(lines)
    read = lambda s, paths: s.createDataFrame([(p, k) for p in paths for k in range(2)], "path string, row int")
    for _ in range(2):
        ingest.land(ingest.arrival_messages(spark.readStream.text(lines)), read, f"{top}/rows", f"{top}/checkpoint").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{top}/rows").select("path", "row").collect())) == [("a.ecsv", 0), ("a.ecsv", 1), ("b.ecsv", 0), ("b.ecsv", 1)]
    bad = spark.read.parquet(f"{top}/rows.problems").select("problem").collect()
    assert sorted(r[0] for r in bad) == ["names no table", "not a JSON object", "not a JSON object"]


def test_tiles_are_not_listed_in_the_driver(spark, monkeypatch):
    """Tiles are joined, so that their number isn't the driver's; folders are pruned still."""
    rows = [(e * 100 + k, e, 10.0 + k / 50, 5.0, 1.0, 0.5) for e in (0, 1) for k in range(100)]
    store = ClusterStore(spark, folder(spark, "clusters"), 2.0, 2, tile_degrees=0.02)
    frames = [spark.createDataFrame([r for r in rows if r[1] == e], SKY) for e in (0, 1)]
    plain, listed = type(frames[0]).collect, []

    def collect(df):
        out = plain(df)
        listed.append(len(out))
        return out

    monkeypatch.setattr(type(frames[0]), "collect", collect)
    assert [store.add(f)["added"] for f in frames] == [100, 100]
    assert sum(listed) < 20
    assert sorted(map(tuple, plain(store.clusters()))) == sorted((k + 100 * e, k, 0) for k in range(100) for e in (0, 1))
    near = store._read("members", store._around(frames[1].where("det_id < 103")))
    assert "dynamicpruning" in near._jdf.queryExecution().executedPlan().toString()
    assert {r["det_id"] for r in plain(near)} >= {0, 1, 2, 100, 101, 102}


def test_a_cell_keeps_one_source_of_each_position():
    from duskfield.streaming import source_list

    class Kept(list):
        def get(self):
            return iter(self)

        appendList = list.extend  # noqa: N815

    cell = source_list.Sources(1.0)
    cell.known = Kept()
    place = {"x": 0.5, "y": 0.5, "z": 0.5}
    rows = lambda e, keys: [pd.DataFrame([{"kind": source_list.DETECTION, "cell": 7, "epoch_id": e, "det_id": k, "source": k, **place} for k in keys])]
    first = pd.concat(cell.handleInputRows((7,), iter(rows(1, range(100, 0, -1))), None))
    decided = first[first["kind"] == source_list.DECISION]
    assert (decided["source"] == decided["det_id"]).all() and len(decided) == 100
    assert sum(np.size(v[1]) for v in cell.known) == 1  # the others can't be found
    later = pd.concat(cell.handleInputRows((7,), iter(rows(2, (200, 201))), None))
    assert later["source"].tolist() == [1, 1]


def test_first_near_is_brute_force(monkeypatch):
    from duskfield.streaming import source_list

    monkeypatch.setattr(source_list, "PAIRS", 50)
    rng = np.random.default_rng(3)
    at, sources = rng.uniform(-1, 1, (300, 3)), rng.uniform(-1, 1, (400, 3))
    near = np.sqrt(((at[:, None] - sources) ** 2).sum(axis=2)) <= 0.2
    want = np.where(near.any(axis=1), near.argmax(axis=1), 400)
    assert (source_list.first_near(at, sources, 0.2) == want).all()
    assert source_list.first_near(at, sources[:0], 0.2).tolist() == [0] * 300
