"""MinHash near-duplicate classes with exact Jaccard verification.

Circulant MinHash: one permutation scatters the shingles over a universe, a second one, circularly shifted, gives all
coordinates of the signature. Bands of the signature make buckets. Every bucket is compared with one hub, exactly, on
full shingle sets. What that leaves open in a small bucket is settled inside it: counts of the sets by hash range bound
what two members share, and those that may be linked are compared exactly. In a large one, members that aren't linked to
their hub meet others of the hub's members only through elements of their difference from the hub, which two linked sets
must share, so that no link is lost and no group emits all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, dropped, ship, small_broadcasts, written

WORDS_PER_SHINGLE = 5
UNIVERSE_BITS = 20
ROWS = 5
#: A pair just at the threshold meets in no band with this chance at most.
MISS = 5e-7
#: Members up to this Jaccard distance from their hub are told apart by their differences from it.
NEAR_HUB = 0.5
#: Pairs of buckets of up to so many members are settled one by one, those of larger ones by way of a hub.
SMALL_BUCKET = 512
#: Rows of a large bucket that go to one task; float cells that a comparison inside a bucket holds at a time.
SALT_ROWS = 512
LABEL_SALTS = 8
COMPARED_CELLS = 1 << 21
#: A set's profile: how many of its hashes fall in each of so many equal ranges, each count in a byte.
PROFILE = 256
#: So many distinct words a worker keeps the hashes of before it starts anew.
WORD_CACHE = 1 << 16
#: Rows that pass to Python at a time.
BATCH_ROWS = 1000
#: Texts to read again are told by a bitmap of their ids' hashes, broadcast in blocks of BLOCK_BITS: ID_BITS for each id, and
#: ID_BLOCKS blocks at most (16 MB), beyond which more texts pass that aren't needed.
BLOCK_BITS = 1 << 15
ID_BITS = 16
ID_BLOCKS = 1 << 12
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _WordHashes()


def _finish(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads what multiplying leaves in the upper ones."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: bytes) -> tuple[np.ndarray, bytes]:
    """The sorted distinct shingle hashes of a text in UTF-8, and a digest of its word sequence (empty without words).

    Of bytes, ``lower`` changes A-Z only and ``split`` splits at the six ASCII white space characters only.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64), b""
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    key = xxhash.xxh3_128_digest(h.tobytes())
    k = min(WORDS_PER_SHINGLE, len(h))
    n = len(h) - k + 1
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc = _finish(acc ^ (h[j : j + n] * _MIX[j]))
    return np.unique(acc), key


def _texts(column: pa.Array) -> Iterator[bytes]:
    for t in column:
        yield t.as_buffer().to_pybytes() if t.is_valid else b""


@lru_cache(maxsize=2)
def _circulant(coordinates: int) -> np.ndarray:
    """Row ``i``: what the second permutation, shifted 0 to ``coordinates`` - 1 places, gives for element ``i``."""
    pi = np.random.default_rng(20_111).permutation(1 << UNIVERSE_BITS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: coordinates - 1]]), coordinates)


def bands_for(percent: int) -> int:
    """As many bands as leave a pair of similarity ``percent`` without a common one with chance MISS at most: 25 at 85, 37 at 80."""
    return math.ceil(math.log(MISS) / math.log1p(-min((percent / 100) ** ROWS, 1 - MISS)))


def signature(shingles: np.ndarray, coordinates: int = 125) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least value of the second permutation, shifted by k, over the set that the
    first permutation scatters. The first is a bijection of the 64-bit hashes, cut to the universe's bits."""
    rows = _circulant(coordinates)
    at = (_finish(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)
    out = np.full(coordinates, 1 << UNIVERSE_BITS, np.uint32)
    for k in range(0, len(at), 4096):
        out = np.minimum(out, rows[at[k : k + 4096]].min(axis=0))
    return out


def band_keys(sig: np.ndarray) -> list[int]:
    """A signed 64-bit key for each band."""
    return [int.from_bytes(xxhash.xxh64_digest(band.tobytes(), seed=b), "little", signed=True) for b, band in enumerate(sig.reshape(-1, ROWS))]


def _signed(percent: int):
    """id, extra, text -> id, extra, word digest, set size, band keys."""
    coordinates = bands_for(percent) * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, bands = [], [], []
            for t in _texts(b["text"]):
                s, key = shingle_set(t)
                keys.append(key)
                sizes.append(len(s))
                bands.append(band_keys(signature(s, coordinates)) if len(s) else [])
            yield pa.RecordBatch.from_arrays([b["id"], b["extra"], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "extra", "key", "n", "bands"])

    return run


def profile(shingles: np.ndarray) -> np.ndarray:
    """The set's hashes counted by range, 255 at most in each."""
    return np.minimum(np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=PROFILE), 255).astype(np.uint8)


def shared_at_most(one: np.ndarray, n: int, others: np.ndarray, ns: np.ndarray) -> np.ndarray:
    """No fewer elements than a set of size ``n`` shares with each of others, by their profiles. What a full range doesn't
    count could be shared."""
    beyond = np.minimum(n - int(one.sum(dtype=np.int64)), ns - others.sum(axis=1, dtype=np.int64))
    return np.minimum(one, others).sum(axis=1, dtype=np.int64) + beyond


def _keyed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> word digest, the sorted shingle hashes as bytes, their profile."""
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            got = [shingle_set(t) for t in _texts(b["text"].slice(at, 1000))]
            yield pa.RecordBatch.from_arrays([pa.array([k for _, k in got], pa.binary()), pa.array([s.tobytes() for s, _ in got], pa.binary()), pa.array([profile(s).tobytes() for s, _ in got], pa.binary())], names=["key", "s", "profile"])


def _linked(percent: int):
    """hub, member and their sets -> hub, member, whether linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b["hub_set"], b["s"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * inter >= percent * (len(x) + len(y) - inter))
            yield pa.RecordBatch.from_arrays([b["hub"], b["node"], pa.array(ok, pa.bool_())], names=["hub", "node", "ok"])

    return run


def _compare(percent: int):
    """hub, member and their sets -> hub, member, the member's size, whether linked, and what ``_residual`` needs of a
    member near its hub (the difference of the sets) and of one far from it (its own set); in between, both."""
    none = np.empty(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                n, ok, diff, own = [], [], [], []
                for x, y in zip(part["hub_set"], part["s"], strict=True):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    d = np.setxor1d(x, y, assume_unique=True)
                    inter = (len(x) + len(y) - len(d)) // 2
                    n.append(len(y))
                    ok.append(100 * inter >= percent * (len(x) + len(y) - inter))
                    away = len(d) / (inter + len(d))
                    diff.append(d.view(np.int64) if away <= NEAR_HUB else none)
                    own.append(y.view(np.int64) if away >= NEAR_HUB - (1 - percent / 100) else none)
                yield pa.RecordBatch.from_arrays([part["hub"], part["node"], pa.array(n, pa.int64()), pa.array(ok, pa.bool_()), pa.array(diff, pa.list_(pa.int64())), pa.array(own, pa.list_(pa.int64()))], names=["hub", "node", "n", "ok", "diff", "own"])

    return run


def _some_ids(rows: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """``rows`` whose ``id`` is one of the ``count`` that ``ids`` has, and a few more (one in ID_BITS of the others, about).

    What is broadcast is two bytes an id, where a table of ids takes a hundred; and it has a bound.
    """
    blocks = max(1, min(ID_BLOCKS, math.ceil(ID_BITS * count / BLOCK_BITS)))
    place = F.expr(f"pmod(xxhash64(id), {blocks * BLOCK_BITS})")
    block, bit = (place / BLOCK_BITS).cast("int"), (place % BLOCK_BITS).cast("int")
    bits = ids.select(block.alias("block"), bit.alias("bit")).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8) + 1, F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(bits), (block == F.col("block")) & (F.getbit(byte, bit % 8) == 1), "left_semi")


def _label_salted(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(LABEL_SALTS)).cast("int"))


def _for_label_salts(labels: DataFrame) -> DataFrame:
    return labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1)))).hint("merge")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (node, label) with ``label`` lowered to the least of its component along ``edges`` (a, b).

    Least labels spread along edges and through the node that a label names; each round is written, so that neither
    lineage nor plan grows. Partial minima keep a node of very many edges to a row for each task.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = written(both, "edges")
    now = held = written(nodes.select("node", "label"), "labels")
    while True:
        near = both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        new = now.join(near, "node", "left").select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        # A label that many nodes have is dealt to LABEL_SALTS tasks; only those that have a lesser label themselves are met.
        up = _for_label_salts(new.where("label < node").select(F.col("node").alias("label"), F.col("label").alias("root")))
        new = written(_label_salted(new).join(up, ["label", "salt"], "left").select("node", F.least("label", "root").alias("label"), "old"), "labels")
        changed = new.where("label <> old").limit(1).count()
        dropped(held)
        now, held = new.select("node", "label"), new
        if not changed:
            dropped(both)
            return now


def _salted(members: DataFrame) -> DataFrame:
    """Members (bucket, node, many) of large buckets dealt to as many salts as their bucket's size ``many`` asks for."""
    return members.withColumn("salt", F.expr(f"pmod(xxhash64(node), many div {SALT_ROWS} + 1)"))


def _for_salts(buckets: DataFrame) -> DataFrame:
    """A row of each bucket (bucket, many, ...) for each of its salts."""
    return buckets.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"many div {SALT_ROWS}")))).drop("many").hint("merge")


def _with_hubs(buckets: DataFrame) -> DataFrame:
    """(bucket, hub, node) for the members of each bucket but its hub, the least of them. ``buckets``: bucket, node, many."""
    hubs = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("most"), F.max("many").alias("many")).where("hub < most").select("bucket", "hub", "many")
    return _salted(buckets).join(_for_salts(hubs), ["bucket", "salt"]).where("node <> hub").select("bucket", "hub", "node")


def _unsettled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets (bucket, node, many) whose members have more than one label, and with column ``small`` one that is true."""
    x = buckets.join(labels, "node")
    small = F.max("small") if "small" in buckets.columns else F.lit(True)
    mixed = x.groupBy("bucket").agg(F.min("label").alias("p"), F.max("label").alias("q"), small.alias("any"), F.max("many").alias("many")).where("p < q and any").select("bucket", "many")
    return _salted(x).join(_for_salts(mixed), ["bucket", "salt"], "left_semi").select("bucket", "node", "many")


def _prefixes(x: DataFrame, c: float) -> DataFrame:
    """(grp, node, n, ok, e, small, a, b): of each member's elements, the first ``prefix``, rarest within the group first, that
    others have too, and whether among the first ``small``. ``x``: grp, node, n, ok, elements, prefix, small. Elements
    that one member has alone only take up places.

    A linked pair shares (a(x) + a(y)) / 2 elements at least, a = elements - c n; it can't share more than either has in
    common with any other, so a(x) <= b(y) and a(y) <= b(x), b = 2 * shareable elements - a.
    """
    one = x.select("grp", "node", "n", "ok", F.size("elements").alias("all"), "prefix", "small", F.explode("elements").alias("e"))
    rare = one.groupBy("grp", "e").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = Window.partitionBy("grp", "node")
    shared = one.join(rare, ["grp", "e"]).withColumn("common", F.count(F.lit(1)).over(own)).withColumn("r", F.row_number().over(own.orderBy("df", "e")) + F.col("all") - F.col("common"))
    least = F.col("all") - c * F.col("n")
    return shared.where("r <= prefix").select("grp", "node", "n", "ok", "e", (F.col("r") <= F.col("small")).alias("small"), least.alias("a"), (2 * F.col("common") - least).alias("b"))


def _residual(compared: DataFrame, groups: DataFrame, labels: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """New buckets for the pairs within each of ``groups`` (grp, hub, node) that no comparison with its hub has settled: the
    small ones as links (a, b) that join what holds together, the large ones as buckets (bucket, node, many).

    A new bucket lies within one group and lacks its hub, so that the rounds narrow down to nothing. Also the tables that
    both read, to be dropped when they are written.

    Two sets that share k elements share one of the first |A| - k + 1 and |B| - k + 1 in any one order; rarest first is
    taken. For the smaller set of a pair k is larger, so that a shorter prefix (``small``) does; a bucket in which all are
    beyond that has no pair. Let t be the similarity. If two members are linked, their distances from the hub differ by
    1 - t at most, so either both are at most NEAR_HUB from it or both are over NEAR_HUB - (1 - t).

    Far members: linked sets share t |x| elements at least. Near ones: for members x, y of hub m with differences X, Y
    from it, x and y are linked only if |X △ Y| <= c (|x| + |y|), c = (1 - t) / (1 + t). If x isn't linked to m, then
    |X| > c (|x| + |m|), so X and Y share at least (1 - c) |Y| / 2 elements. Whichever are linked, T = |x| (1 / t - 1)
    bounds |X △ Y|, so they share at least (|X| + max(1, |X| - T) - T) / 2, or |X| - T / 2 if |X| <= |Y|. Pairs of which
    both are linked to the hub are settled. Either way |x △ y| is that of the elements, so that pairs of a small bucket
    are settled by these alone.
    """
    t = percent / 100
    c = (1 - t) / (1 + t)
    x = compared.join(labels, "node").join(labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label")), "hub")
    x = groups.join(x, ["hub", "node"])
    apart = x.where("label <> hub_label").select("grp").distinct()
    x = written(x.join(apart, "grp", "left_semi"), "apart")
    n, d = F.col("n"), F.size("diff")
    far = x.where(F.size("own") > 0).select("grp", "node", "n", F.lit(False).alias("ok"), F.col("own").alias("elements"), (n - F.ceil(t * n - 1e-9) + 1).alias("prefix"), (n - F.ceil(2 * t / (1 + t) * n - 1e-9) + 1).alias("small"))
    reach = F.floor(n * (1 / t - 1) + 1e-9)
    own = F.greatest(F.lit(1), F.ceil((1 - c) * d / 2 - 1e-9))
    loose = F.greatest(F.lit(1), F.ceil((d + F.greatest(F.lit(1), d - reach) - reach) / 2 - 1e-9))
    share = F.when(F.col("ok"), F.greatest(own, loose)).otherwise(loose)
    smaller = F.greatest(share, F.ceil(d - reach / 2 - 1e-9))
    near = x.where(d > 0).select("grp", "node", "n", "ok", F.col("diff").alias("elements"), (d - share + 1).alias("prefix"), (d - smaller + 1).alias("small"))
    keys = _prefixes(far, c).withColumn("near", F.lit(False)).unionByName(_prefixes(near, c).withColumn("near", F.lit(True)))
    keys = written(keys.join(labels, "node").withColumn("bucket", F.xxhash64("grp", "e", "near")), "keys")
    first = keys
    for _ in range(2):
        keys = keys.join(_possible(keys), "bucket").where("a <= most_b + 1e-6 and b >= least_a - 1e-6").drop("most_b", "least_a", "many")
    keys = written(keys.join(_possible(keys).select("bucket", "many"), "bucket"), "keys")
    dropped(first)
    few = keys.where(F.col("many") <= SMALL_BUCKET).select("bucket", "grp", "near", "node", "label", "ok", "small", "a", "b")
    elements = x.select("grp", "node", "n", F.lit(True).alias("near"), F.col("diff").alias("v")).unionByName(x.select("grp", "node", "n", F.lit(False).alias("near"), F.col("own").alias("v")))
    few = few.join(elements, ["grp", "near", "node"]).select("bucket", "node", "label", "ok", "small", "a", "b", "n", "v")
    links = few.groupBy("bucket").applyInArrow(_links_within(percent), "a long, b long").distinct()
    many = keys.where(F.col("many") > SMALL_BUCKET).groupBy("bucket", "node").agg(F.max("small").alias("small"), F.max("many").alias("many"))
    return links, many, [x, keys]


def _links_within(percent: int):
    """The links (a, b) inside one bucket of at most SMALL_BUCKET members, which leave as a spanning forest: one for each
    member at most. Elements ``v``: longs, or their bytes."""

    def run(t: pa.Table) -> pa.Table:
        node, label, n, a, b = (t[c].to_numpy() for c in ("node", "label", "n", "a", "b"))
        ok, small = (t[c].to_numpy(zero_copy_only=False) for c in ("ok", "small"))
        open_ = (label[:, None] != label) & (small[:, None] | small) & ~(ok[:, None] & ok) & (a[:, None] <= b + 1e-6) & (a <= b[:, None] + 1e-6)
        use = np.flatnonzero(open_.any(axis=1))
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if len(use) < 2:
            return none
        sets = t["v"].take(pa.array(use))
        if pa.types.is_binary(sets.type):
            sets = [np.frombuffer(v.as_buffer(), np.int64) for v in sets]
            sizes, flat = np.array([len(v) for v in sets], np.int64), np.concatenate(sets)
        else:
            sets = sets.combine_chunks()
            sizes, flat = sets.value_lengths().to_numpy().astype(np.int64), sets.flatten().to_numpy()
        owner = np.repeat(np.arange(len(use)), sizes)
        of, at = np.unique(flat, return_inverse=True)
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        shared = np.zeros((len(use), len(use)), np.float32)
        step = max(1, COMPARED_CELLS // len(use))  # elements at a time
        for first in range(0, len(of), step):
            lo, hi = np.searchsorted(at, (first, first + step))
            has = np.zeros((len(use), step), np.float32)
            has[owner[lo:hi], at[lo:hi] - first] = 1
            shared += has @ has.T
        total = (n[use][:, None] + n[use]).astype(np.int64)
        inter = (total - (sizes[:, None] + sizes - 2 * shared.astype(np.int64))) / 2
        linked = open_[np.ix_(use, use)] & (100 * inter >= percent * (total - inter))
        out = [(node[use[i]], node[use[j]]) for i, j in _forest(linked)]
        return pa.table({"a": pa.array([p for p, _ in out], pa.int64()), "b": pa.array([q for _, q in out], pa.int64())}) if out else none

    return run


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric matrix of links, tree by tree, roots first."""
    out, seen = [], np.zeros(len(linked), bool)
    for root in range(len(linked)):
        todo = [] if seen[root] else [root]
        seen[root] = True
        while todo:
            i = todo.pop()
            new = np.flatnonzero(linked[i] & ~seen)
            seen[new] = True
            todo += new.tolist()
            out += [(i, j) for j in new.tolist()]
    return out


def _likely(percent: int):
    """Whole buckets (members: node, label, n, profile) -> (bucket, node) of what may be linked with others of another label,
    a bucket for each group that this holds together. It is named by its members, so that it is one wherever they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for members in b["members"]:
                t = members.values
                order = np.argsort(t.field("node").to_numpy())
                node, label, n = (t.field(c).to_numpy()[order] for c in ("node", "label", "n"))
                profiles = np.frombuffer(b"".join(t.field("profile").to_pylist()), np.uint8).reshape(-1, PROFILE)[order]
                may = np.zeros((len(node), len(node)), bool)
                for i in range(len(node) - 1):
                    others = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
                    inter = shared_at_most(profiles[i], int(n[i]), profiles[others], n[others])
                    may[i, others] = 100 * inter >= percent * (n[i] + n[others] - inter)
                trees: dict[int, list[int]] = {}
                for i, j in _forest(may | may.T):
                    tree = trees.setdefault(i, [i])
                    tree.append(j)
                    trees[j] = tree
                for tree in {id(v): v for v in trees.values()}.values():
                    held = np.sort(node[tree])
                    name = int.from_bytes(xxhash.xxh64_digest(held.tobytes()), "little", signed=True)
                    out += [(name, v) for v in held.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in out], pa.int64()), pa.array([v for _, v in out], pa.int64())], names=["bucket", "node"])

    return run


def _links_inside(buckets: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The links (a, b) that join what holds together in buckets (bucket, node, many) of SMALL_BUCKET members at most; and the
    table that they read, to be dropped when they are written.

    A member moves once a bucket with the PROFILE bytes of its profile, and with its set only if a profile says that it
    may have a link, so that what moves and what joins give grows as the members do. Only the comparisons inside a
    task are quadratic in a bucket.
    """
    narrow = labels.join(sets.select("node", "profile", F.expr("octet_length(s) div 8").cast("long").alias("n")), "node")
    whole = buckets.join(narrow, "node").groupBy("bucket").agg(F.collect_list(F.struct("node", "label", "n", "profile")).alias("members"))
    likely = written(whole.mapInArrow(_likely(percent), "bucket long, node long").distinct(), "likely")
    few = likely.join(labels, "node").join(sets.select("node", "s"), "node")
    every = [F.lit(False).alias("ok"), F.lit(True).alias("small"), F.lit(0.0).alias("a"), F.lit(0.0).alias("b")]
    few = few.select("bucket", "node", "label", *every, F.expr("octet_length(s) div 8").cast("long").alias("n"), F.col("s").alias("v"))
    return few.groupBy("bucket").applyInArrow(_links_within(percent), "a long, b long").distinct(), likely


def _possible(keys: DataFrame) -> DataFrame:
    """What the members of a bucket that may yet hold a link need of each other, for buckets that do."""
    x = keys.groupBy("bucket").agg(F.max("b").alias("most_b"), F.min("a").alias("least_a"), F.count(F.lit(1)).alias("many"), F.min("label").alias("p"), F.max("label").alias("q"), F.max("small").alias("s"), F.min("ok").alias("o"))
    return x.where("many > 1 and p < q and s and not o").select("bucket", "most_b", "least_a", "many")


def near_duplicates(docs: DataFrame, percent: int = 85, carry: tuple[Column, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (the least id its links reach, itself
    included) and ``kept`` (``doc_id`` is ``component_id``); and ``carry``, named expressions over the row.

    A text's set is its distinct shingles of five words (A-Z lower-cased); of fewer words, the whole sequence. Texts
    are linked if 100 * |intersection| >= ``percent`` * |union|. Defined cases: texts without words have an empty set
    and are linked with nothing; equal texts are one class, so rows of one id are judged each by its own text; a null
    id is least only where all ids of its class are null; an empty table gives an empty table; extra columns are not
    read.

    Scale: equal word sequences meet by digest first, with partial minima, and one of each goes on. Signatures are
    made where texts are read; what moves is band keys, then the sets of the members of buckets. A bucket, however
    large, gives as many pairs as members; of what that leaves open, buckets of SMALL_BUCKET members at most are settled
    inside a task (see ``_links_inside``) and larger ones go round again (see ``_residual``). Links and labels stay in
    tables; joins of tables that grow with the documents are sorted, so that the driver holds none of these. A table of
    salts is marked so wherever it is made, as Spark estimates it by what it was before.
    """
    ship(docs.sparkSession)
    with arrow_batches(docs.sparkSession, BATCH_ROWS), small_broadcasts(docs.sparkSession):
        return _near_duplicates(docs, percent, carry, id_col, text_col)


def _near_duplicates(docs: DataFrame, percent: int, carry: tuple[Column, ...], id_col: str, text_col: str) -> DataFrame:
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(F.lit(0).alias("none"), *carry).alias("extra"))
    kind, extra = x.schema["id"].dataType.simpleString(), x.schema["extra"].dataType.simpleString()
    signed = written(x.mapInArrow(_signed(percent), f"id {kind}, extra {extra}, key binary, n long, bands array<long>"), "signed")
    same = signed.where("n > 0").groupBy("key").agg(F.min("id").alias("least"), F.any_value("bands").alias("bands"))
    banded = written(same.withColumn("node", F.monotonically_increasing_id()), "classes")
    rows = written(signed.select("id", "extra", "key", "n"), "rows")  # without the bands, which take most of the room
    dropped(signed)
    buckets = banded.select("node", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    members = written(buckets.join(sizes, "bucket"), "members")
    classes = written(banded.drop("bands"), "classes")
    dropped(banded)
    # Nodes are numbered anew, those with the most company first: the likely middles of their groups, which make good hubs.
    company = members.groupBy("node").agg(F.sum("many").alias("many")).orderBy(F.desc("many"), "node")
    ranked = written(company.select(F.col("node").alias("old"), F.monotonically_increasing_id().alias("node")), "ranked")
    used = written(ranked.join(classes.select(F.col("node").alias("old"), "key", "least"), "old").select("node", "key", "least"), "used")
    inside = written(members.select("bucket", F.col("node").alias("old"), "many").join(ranked, "old").select("bucket", "node", "many"), "inside")
    dropped(members, ranked)
    texts = _some_ids(x, used.select(F.col("least").alias("id")), used.count()).select("text")
    sets = texts.mapInArrow(_keyed_sets, "key binary, s binary, profile binary").join(used.select("key", "node"), "key").groupBy("node").agg(F.any_value("s").alias("s"), F.any_value("profile").alias("profile"))
    sets = written(sets, "sets")
    hub_sets = sets.select(F.col("node").alias("hub"), F.col("s").alias("hub_set"))

    def compared(pairs: DataFrame, rest: bool) -> DataFrame:
        both = pairs.join(sets.select("node", "s"), "node").join(hub_sets, "hub").select("hub", "node", "hub_set", "s")
        if rest:
            return written(both.mapInArrow(_compare(percent), "hub long, node long, n long, ok boolean, diff array<long>, own array<long>"), "compared")
        return written(both.mapInArrow(_linked(percent), "hub long, node long, ok boolean"), "compared")

    def joined(labels: DataFrame, found: DataFrame) -> DataFrame:
        return components(labels, found.where("ok").select(F.col("hub").alias("a"), F.col("node").alias("b")))

    # First each node with the least of its hubs, which settles most buckets; then what small ones leave; then whole large
    # ones, as long as any is left.
    labels = used.select("node", F.col("node").alias("label"))
    found = compared(_with_hubs(inside).groupBy("node").agg(F.min("hub").alias("hub")), rest=False)
    labels = joined(labels, found)
    open_ = written(_unsettled(inside, labels), "open")
    dropped(found, inside)
    links, likely = _links_inside(open_.where(F.col("many") <= SMALL_BUCKET), labels, sets, percent)
    links = written(links, "links")
    dropped(likely)
    if links.limit(1).count():
        labels = components(labels, links)
    left = written(_unsettled(open_.where(F.col("many") > SMALL_BUCKET), labels), "left")
    dropped(open_, links)
    first = True
    while left.limit(1).count():
        groups = _with_hubs(left).select(F.col("hub" if first else "bucket").alias("grp"), "hub", "node").distinct()
        groups, first = written(groups, "groups"), False
        found = compared(groups.select("hub", "node").distinct(), rest=True)
        labels = joined(labels, found)
        links, new, read = _residual(found, groups, labels, percent)
        links, new = written(links, "links"), written(new, "left")
        dropped(found, groups, left, *read)
        if links.limit(1).count():
            labels = components(labels, links)
        left = written(_unsettled(new, labels), "left")
        dropped(links, new)
    dropped(left, sets)
    named = used.join(labels.hint("merge"), "node")
    roots = _for_label_salts(named.groupBy("label").agg(F.min("least").alias("root")))
    roots = _label_salted(named).join(roots, ["label", "salt"]).select("key", "root")
    found = classes.select("key", "least").join(roots.hint("merge"), "key", "left").select("key", F.coalesce("root", "least").alias("component"))
    # Texts without words, which all have one key, don't meet.
    out = rows.where("n > 0").join(found.hint("merge"), "key").unionByName(rows.where("n = 0").withColumn("component", F.col("id")))
    component = F.col("component")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), *[F.col("extra").getField(c).alias(c) for c in x.schema["extra"].dataType.names[1:]])
