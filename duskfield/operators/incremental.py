"""Clusters over exposures that are kept and brought up to date: an exposure re-clusters only the neighbourhoods it touches.

What ``cluster.cross_epoch`` computes from all candidates at once depends, for each group, on nothing but the candidates of
the groups that the new ones reach: by a pair within their radii, or by a centroid that has moved into or out of reach.
Those groups are read, clustered again and written back; all others keep their rows and ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import unit_vector
from ..functions.tables import written
from ..sources.tables import single_writer
from .cluster import merged_components, split_components, valid_positions
from .graph import connected_components
from .spatial import radius_join, self_pairs

_STEPS = 21  # bits of a tile's number for each axis


class ClusterStore:
    """Clusters in a folder that the cluster shares, as two Parquet tables partitioned by tile of the sky.

    ``members``: key, epoch_id, ra, dec, r, quality, first (its component within the pair radius), root (the component
    after merging), sub (its group there; null where the group is too small), ``tiles`` (where its root's members are) and
    ``home`` (where its component's centroid is).
    ``groups``: first, ra, dec, epochs, root, tiles, by the tile of the centroid. ``tile_degrees`` must be larger than the
    radii. Both tables' new tiles are staged first: an update that a lost driver left half done is finished by the next.

    Defined cases: candidates without a finite position are not kept; a key that is there already is left out, so that an
    exposure can be added twice; null qualities sort last; an empty exposure changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, radius: float, least: int, key: str = "det_id", tile_degrees: float = 1.0):
        if radius / 3600 >= tile_degrees:
            raise ValueError("tiles must be wider than the radius")
        self.spark, self.path, self.radius, self.least, self.key = spark, path.rstrip("/"), radius, least, key
        self.size = 2 * math.sin(math.radians(tile_degrees) / 2)
        self.columns = [key, "epoch_id", "ra", "dec", "r", "quality"]

    # --- what is kept ---

    def _fs(self, name: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _exists(self, name: str) -> bool:
        fs, at = self._fs(name)
        return fs.exists(at)

    def _read(self, name: str, tiles: DataFrame | None = None) -> DataFrame:
        """A table, or its rows in ``tiles`` (a written table): by a join, so that no list of tiles is in the driver or in a
        plan. The comparison makes Spark prune folders by what the join meets."""
        x = self.spark.read.parquet(f"{self.path}/{name}")
        return x if tiles is None else x.join(F.broadcast(tiles.where("tile >= 0")), "tile", "left_semi")

    def clusters(self) -> DataFrame:
        """(key, component, sub), as ``cross_epoch`` gives them for all that was added."""
        return self._read("members").where("sub is not null").select(self.key, F.col("root").alias("component"), "sub")

    def _cells(self) -> list[Column]:
        return [F.floor(v / F.lit(self.size)) + (1 << (_STEPS - 1)) for v in unit_vector(F.col("ra"), F.col("dec"))]

    def _tile(self) -> Column:
        a, b, c = self._cells()
        return (a * (1 << 2 * _STEPS) + b * (1 << _STEPS) + c).cast("long")

    def _around(self, rows: DataFrame) -> DataFrame:
        """The tiles of the rows and those next to them, written."""
        near = lambda n: F.explode(F.array(*[F.col(n) + d for d in (-1, 0, 1)])).alias(n)
        x = rows.select(*[v.alias(n) for n, v in zip("abc", self._cells(), strict=True)]).distinct()
        x = x.select(near("a"), "b", "c").select("a", near("b"), "c").select("a", "b", near("c"))
        return written(x.select((F.col("a") * (1 << 2 * _STEPS) + F.col("b") * (1 << _STEPS) + F.col("c")).cast("long").alias("tile")).distinct(), "tiles")

    # --- what an exposure changes ---

    def add(self, candidates: DataFrame) -> dict[str, int]:
        """Adds one exposure's, or several exposures', candidates (key, epoch_id, ra, dec, r, quality). Gives the number of rows
        added, of rows clustered again (the added ones among them) and of tiles written."""
        with single_writer(self.spark, self.path):
            if self._exists("staged/_ready"):
                self._finish()
            return self._add(candidates)

    def _add(self, candidates: DataFrame) -> dict[str, int]:
        k, spark = self.key, self.spark
        new = written(valid_positions(candidates).select(*self.columns), "new")
        first_time = not self._exists("members")
        if first_time:
            nothing = new.where("false")
            ids = [F.lit(None).cast(new.schema[k].dataType).alias(c) for c in ("first", "root")]
            members = nothing.select("*", *ids, F.lit(None).cast("int").alias("sub"), F.lit(None).cast("array<long>").alias("tiles"), F.lit(None).cast("long").alias("home"), self._tile().alias("tile"))
        else:
            members = self._read("members", self._around(new))
            new = written(new.join(members.select(k).hint("merge"), k, "left_anti"), "new")
        added = new.count()
        if not added:
            return {"added": 0, "clustered": 0, "tiles": 0}

        # Components: the new rows and, for each component they reach, one node.
        old = members.select(F.col("first").alias("reached"), F.col("ra").alias("ra2"), F.col("dec").alias("dec2"), F.col("r").alias("r2"), F.col("root").alias("root2"), F.col("tiles").alias("tiles2"))
        met = radius_join(old, new, 0.6 * self.radius, "sky", ("ra2", "dec2"), ("ra", "dec"))
        met = written(met.where(F.col("dist") <= F.least("r", "r2")).groupBy(k, "reached").agg(F.first("root2").alias("root2"), F.first("tiles2").alias("tiles2")), "met")
        pairs = self_pairs(new, 0.6 * self.radius, k, carry=("r",), system="sky").where(F.col("dist") <= F.least("r", "r2"))
        edges = pairs.select(F.col(k).alias("a"), F.col(f"{k}2").alias("b")).union(met.select(k, "reached"))
        nodes = new.select(k).union(met.select("reached").distinct())
        now = written(connected_components(nodes, edges, k), "components")
        moved = now.select(F.col(k).alias("first"), F.col("component").alias("_to"))

        # All members of the groups reached, then of the groups whose centroids are in reach of the new centroids.
        roots = met.select(F.col("root2").alias("root"), F.explode("tiles2").alias("tile")).distinct()
        pool = members.select(*self.columns, "first", "root", "home") if first_time else self._members_of(roots)
        pool = pool.join(moved.hint("merge"), "first", "left").withColumn("first", F.coalesce("_to", "first")).drop("_to")
        own = new.join(now.hint("merge"), k).select(*self.columns, F.col("component").alias("first"), F.lit(None).cast(pool.schema["root"].dataType).alias("root"), F.lit(None).cast("long").alias("home"))
        pool = written(pool.unionByName(own), "pool")
        mid = self._centroids(pool)
        if not first_time:
            groups = self._read("groups", self._around(mid)).join(pool.select("root").where("root is not null").distinct().hint("merge"), "root", "left_anti")
            far = groups.select(F.col("ra").alias("ra2"), F.col("dec").alias("dec2"), F.col("epochs").alias("epochs2"), F.col("root").alias("root2"), F.col("tiles").alias("tiles2"))
            reach = radius_join(far, mid, self.radius, "sky", ("ra2", "dec2"), ("ra", "dec")).where(~F.arrays_overlap("epochs", "epochs2"))
            more = self._members_of(reach.select(F.col("root2").alias("root"), F.explode("tiles2").alias("tile")).distinct())
            pool = written(pool.unionByName(more), "pool")
            mid = self._centroids(pool)

        merged = merged_components(mid, self.radius)
        homes = mid.select("component", self._tile().alias("home"))
        x = pool.drop("root", "home").join(merged.join(homes.hint("merge"), "component").withColumnRenamed("component", "first").hint("merge"), "first")
        sub = split_components(x.withColumnRenamed("root", "component"), self.radius, self.least, k).select(k, "sub")
        x = x.join(sub.hint("merge"), k, "left").withColumn("tile", self._tile())
        spread = x.groupBy("root").agg(F.sort_array(F.collect_set("tile")).alias("tiles"))
        x = written(x.join(spread.hint("merge"), "root").select(*self.columns, "first", "root", "sub", "tiles", "home", "tile"), "clustered")
        mids = mid.withColumnRenamed("component", "first").join(x.select("first", "root", "tiles", F.col("home").alias("tile")).distinct().hint("merge"), "first")
        before = pool.where("root is not null")
        return {"added": added, "clustered": x.count(), "tiles": self._replace(x, mids, before)}

    def _members_of(self, roots: DataFrame) -> DataFrame:
        """The members of ``roots`` (root, tile): only these tiles are read."""
        roots = written(roots, "roots")
        rows = self._read("members", roots.select("tile").distinct())
        return rows.join(roots.select("root").distinct().hint("merge"), "root", "left_semi").select(*self.columns, "first", "root", "home")

    def _centroids(self, pool: DataFrame) -> DataFrame:
        mid = pool.groupBy(F.col("first").alias("component")).agg(F.avg("ra").alias("ra"), F.avg("dec").alias("dec"), F.collect_set("epoch_id").alias("epochs"))
        return written(mid, "centroids")

    def _replace(self, members: DataFrame, groups: DataFrame, before: DataFrame) -> int:
        """Stages the new content of every tile that gains or loses rows (``before``: what the rows were), and puts it in place."""
        fs, staged = self._fs("staged")
        fs.delete(staged, True)
        roots, n = before.select("root").distinct().hint("merge"), 0
        for name, rows in (("members", members), ("groups", groups)):
            tiles = rows.select("tile")
            if self._exists(name):
                if name == "groups":
                    tiles = tiles.union(before.select(F.col("home").alias("tile")))
                tiles = written(tiles.distinct(), "tiles")
                rows = rows.unionByName(self._read(name, tiles).join(roots, "root", "left_anti").select(rows.columns))
            rows.repartition("tile").sortWithinPartitions("tile").write.partitionBy("tile").parquet(f"{self.path}/staged/{name}")
            if self._exists(name):
                kept = self.spark.read.parquet(f"{self.path}/staged/{name}").select("tile").distinct()
                self._note(name, tiles.join(kept, "tile", "left_anti"))
            n += tiles.distinct().count()
        fs, at = self._fs("staged/_ready")
        fs.create(at, True).close()
        self._finish()
        return n

    def _note(self, name: str, empty: DataFrame) -> None:
        """The tiles that are left without rows, as folders to delete."""
        fs, at = self._fs(f"staged/_empty/{name}")
        fs.mkdirs(at)
        for t in empty.toLocalIterator():
            f, p = self._fs(f"staged/_empty/{name}/{t[0]}")
            f.create(p, True).close()

    def _finish(self) -> None:
        """Puts staged tiles in place; doing so again does no harm."""
        for name in ("members", "groups"):
            fs, top = self._fs(f"staged/{name}")
            self._fs(name)[0].mkdirs(self._fs(name)[1])
            if fs.exists(top):
                for f in fs.listStatus(top):
                    part = f.getPath().getName()
                    if part.startswith("tile="):
                        _, to = self._fs(f"{name}/{part}")
                        fs.delete(to, True)
                        fs.rename(f.getPath(), to)
            _, empty = self._fs(f"staged/_empty/{name}")
            if fs.exists(empty):
                for f in fs.listStatus(empty):
                    fs.delete(self._fs(f"{name}/tile={f.getPath().getName()}")[1], True)
        fs, at = self._fs("staged")
        fs.delete(at, True)
