"""The prefix trie of conversations: what a cache of shared beginnings would hold, and what it would save.

Conversations are sorted by their turns' digests. The lengths of the beginnings that neighbours share (their LCP array)
have a Cartesian tree, and its intervals are the trie's nodes: minima that are equal merge into one node, and a node
without branches stands for all depths down to the next one. The array is cut into blocks, Spark's partitions of the sort.
A stack inside a block closes every interval that ends there. What is still open at its end finds the block that ends it,
the next one with a smaller minimum, from the blocks' minima alone; sums over the blocks in between are differences of
running sums.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, ship, written

#: Turns in a block at most, on average; a block is one task's rows.
BLOCK_TURNS = 500_000
DIGEST = 16
NONE = hashlib.sha256(b"").hexdigest()
_FAR, _NO_ID = 2**31 - 1, 2**63 - 1
#: How a node's parent is found: open since an earlier block, open beyond this block, or closed in it and known.
_BEFORE, _BEYOND, _KNOWN = 0, 1, 2


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) from rows (conv_id, turn, role, text): digests and code points of the turns, in order.

    Null turns come first; rows of one turn are ordered by digest; null roles and texts are empty; rows without a conv_id
    belong to no conversation. Texts stay where they are read: 128-bit digests of role and text are grouped.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    x = turns.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.char_length(text).alias("chars")).alias("t"))
    return x.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_heads(convs: DataFrame, group: int = 100, spread: int = 6) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of c - c % ``group``, h being crc32(c) % ``spread``.

    Only beginnings of ``spread`` - 1 turns are joined, each to the conversations of its group.
    """
    c = F.col("conv_id")
    h = F.pmod(F.crc32(c.cast("string")), F.lit(spread)).cast("int")
    heads = convs.where(c % group == 0).select(c.alias("base"), F.slice("turns", 1, spread - 1).alias("head"))
    x = convs.select("conv_id", "turns", h.alias("h"), (c - c % group).alias("base")).join(heads, "base", "left")
    none = F.slice("turns", 1, 0)
    return x.select("conv_id", F.concat(F.slice(F.coalesce("head", none), 1, F.col("h")), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def shared(a: bytes, b: bytes) -> int:
    """The digests that both keys begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))) // DIGEST


_ARRAY = pa.schema([("part", pa.int32()), ("i", pa.int64()), ("conv_id", pa.int64()), ("size", pa.int32()), ("lcp", pa.int32()), ("sums", pa.list_(pa.int64())), ("edge", pa.binary())])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted keys to the LCP array: per conversation what it shares with the one before, and the running sums of code points
    from there on. A block's first and last rows carry their keys; the first one's LCP is left open."""
    part, held, before, i = TaskContext.get().partitionId(), None, None, 0

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARRAY, strict=True)], schema=_ARRAY)

    for b in batches:
        rows = []
        for conv, key, chars in zip(b["conv_id"].to_pylist(), b["key"].to_pylist(), b["chars"].to_pylist(), strict=True):
            if held:
                rows.append(held)
            v = None if before is None else shared(before, key)
            sums = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])[v or 0 :]
            held = (part, i, conv, len(chars), v, sums, key if v is None else None)
            before, i = key, i + 1
        if rows:
            yield batch(rows)
    if held:
        yield batch([(*held[:6], before)])


_SWEPT = pa.schema([("what", pa.string()), ("block", pa.int32()), ("depth", pa.int32()), ("prev", pa.int32()), ("n", pa.int64()), ("low", pa.int64()), ("s", pa.int64()), ("leaves", pa.int64()), ("c", pa.int64()), ("kids", pa.int64()), ("via", pa.int32()), ("parent", pa.int64()), ("ids", pa.string())])


def sweep(block: int, first: int, after: int, size: list[int], lcp: list[int], conv: list[int], sums: list) -> list[tuple]:
    """The rows of one block: closed nodes (``node``), nodes open at its end (``spine``), its minima so far (``chain``), its
    totals (``block``) and the ids of conversations that end at nodes that reach beyond it (``ids``).

    ``first``: the LCP of its first row, ``after``: that of the next block's, -1 at the array's ends. ``sums``: per row
    the code points of its first v, v + 1 ... turns, v being its LCP (0 for the first row). Columns as in _SWEPT: n
    conversations, low the least id, s the code points that neighbours within share, c those before the node's own turn.
    A chain row (depth, prev) is the first row whose LCP is under prev, with the sums before it: it ends the nodes open
    since earlier blocks that are deeper than depth and at most as deep as prev.
    """
    start, depth, own, low, s0, l0, kids, par, ends = [], [], [], [], [], [], [], [], []
    stack: list[int] = []
    done: dict[int, tuple[int, int, int]] = {}
    out, lead = [], []
    total = leaves = children = 0
    least, cur, run = _NO_ID, _FAR, -1

    def close(i: int) -> int:
        j = stack.pop()
        done[j] = (i - start[j], total - s0[j], leaves - l0[j])
        if stack:
            low[stack[-1]] = min(low[stack[-1]], low[j])
        return j

    for i in range(len(size)):
        v, at = (lcp[i], lcp[i]) if i else (first, 0)
        if i and v < size[i - 1]:
            leaves += 1
        while stack and depth[stack[-1]] > v:
            close(i)
        if not stack and v < cur:
            out.append(("chain", block, v, cur, i, least, total, leaves, 0, children, _KNOWN, None, None))
            cur, children = v, 0
        total += int(sums[i][v - at]) if v >= 0 else 0
        least = min(least, conv[i])
        if size[i] > v:
            if stack:
                kids[stack[-1]] += 1
            else:
                children += 1
            for d in range(v + 1, size[i] + 1):
                par.append(stack[-1] if stack else -1)
                stack.append(len(start))
                start.append(i)
                depth.append(d)
                own.append(int(sums[i][d - 1 - at]) if d else 0)
                low.append(_NO_ID)
                s0.append(total)
                l0.append(leaves)
                kids.append(int(d < size[i]))
                ends.append(None)
            run = stack[-1]
            ends[run] = []
        (lead if run < 0 else ends[run]).append(conv[i])
        if stack:
            low[stack[-1]] = min(low[stack[-1]], conv[i])
    leaves += size[-1] > after
    spine = set(stack)
    while stack:
        close(len(size))
    for j, (n, s, reached) in done.items():
        p = par[j]
        via = _BEFORE if p < 0 else _BEYOND if p in spine else _KNOWN
        ids = ",".join(map(str, ends[j])) if ends[j] else ""
        row = (block, depth[j], None, n, low[j], s, reached, own[j], kids[j], via, low[p] if via == _KNOWN else None)
        out.append(("spine" if j in spine else "node", *row, None if j in spine else hashlib.sha256(ids.encode()).hexdigest() if ids else NONE))
        if j in spine and ids:
            out.append(("ids", block, depth[j], None, 0, 0, 0, 0, 0, 0, _BEYOND, None, ids))
    if lead:
        out.append(("ids", block, size[0], None, 0, 0, 0, 0, 0, 0, _BEFORE, None, ",".join(map(str, lead))))
    out.append(("block", block, cur, None, len(size), least, total, leaves, 0, children, _KNOWN, None, None))
    return out


class Blocks:
    """What a few numbers per block tell: where an open interval ends or began, and sums and minima over blocks in between."""

    def __init__(self, rows: list):
        col = lambda k: np.array([r[k] for r in rows], np.int64)
        self.size, self.least, self.kids = len(rows), col("depth"), col("kids")
        self.sums = {k: np.concatenate([[0], np.cumsum(col(k))]) for k in ("n", "s", "leaves")}
        self.mins, self.lows = self._levels(self.least), self._levels(col("low"))
        order = np.lexsort((np.arange(self.size), self.least))
        self.sorted = self.least[order] * (self.size + 1) + order
        self.run = np.concatenate([[0], np.cumsum(self.kids[order])])

    @staticmethod
    def _levels(v: np.ndarray) -> list[np.ndarray]:
        out = [v]
        while len(out[-1]) > 1 << (len(out) - 1):
            w = 1 << (len(out) - 1)
            out.append(np.minimum(out[-1][:-w], out[-1][w:]))
        return out

    def end(self, block: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first later block with a minimum under ``depth`` (their number where there is none), and the least id of the
        blocks in between."""
        at, low = block + 1, np.full(len(block), _NO_ID)
        for k in reversed(range(len(self.mins))):
            ok = at + (1 << k) <= self.size
            here = np.where(ok, at, 0)
            ok &= self.mins[k][here] >= depth
            low = np.where(ok, np.minimum(low, self.lows[k][here]), low)
            at = at + (ok.astype(np.int64) << k)
        return at, low

    def begin(self, block: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last earlier block with a minimum under ``depth``: the node of that depth open at ``block`` began there."""
        at = block
        for k in reversed(range(len(self.mins))):
            ok = at - (1 << k) >= 0
            ok &= self.mins[k][np.where(ok, at - (1 << k), 0)] >= depth
            at = at - (ok.astype(np.int64) << k)
        return at - 1

    def between(self, what: str, block: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.sums[what][end] - self.sums[what][block + 1]

    def children(self, block: np.ndarray, end: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The children that nodes of ``depth`` get in the blocks in between: all are of blocks with that minimum."""
        place = lambda b: np.searchsorted(self.sorted, depth * (self.size + 1) + b)
        return self.run[place(end)] - self.run[place(block + 1)]


def _swept(table: DataFrame, bounds: dict[int, tuple[int, int, int]]) -> DataFrame:
    def whole(t: pa.Table) -> pa.Table:
        t = t.sort_by("i")
        block, first, after = bounds[t["part"][0].as_py()]
        sums = t["sums"].combine_chunks()
        at, flat = sums.offsets.to_numpy(), sums.values.to_numpy()
        rows = sweep(block, first, after, t["size"].to_pylist(), t["lcp"].to_pylist(), t["conv_id"].to_pylist(), [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)])
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SWEPT, strict=True)], schema=_SWEPT)

    kinds = {pa.string(): "string", pa.int32(): "int", pa.int64(): "long"}
    return table.drop("edge").groupBy("part").applyInArrow(whole, ", ".join(f"{f.name} {kinds[f.type]}" for f in _SWEPT))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces (owner, depth, ids) to one digest for each owner and depth, taken piece by piece."""
    at, sha = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([sha.hexdigest()])], names=["owner", "depth", "ends"])

    for b in batches:
        for owner, depth, ids in zip(b["owner"].to_pylist(), b["depth"].to_pylist(), b["ids"], strict=True):
            if (owner, depth) != at:
                if at:
                    yield row()
                at, sha = (owner, depth), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.as_py().encode())
    if at:
        yield row()


def _in_arrow(df: DataFrame, more: list[tuple[str, str]], f) -> DataFrame:
    """``df`` with columns computed from its numbers, batch by batch."""

    def mapped(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            got = f({n: t[n].to_numpy().astype(np.int64) for n in ("block", "depth")})
            for name, kind in more:
                t = t.append_column(name, pa.array(got[name], {"int": pa.int32(), "long": pa.int64()}[kind]))
            yield from t.to_batches()

    return df.mapInArrow(mapped, ", ".join([f"{x.name} {x.dataType.simpleString()}" for x in df.schema] + [f"{n} {k}" for n, k in more]))


def prefix_trie(convs: DataFrame, blocks: int | None = None) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``convs``: conv_id, turns (digest, chars), as ``sequences`` gives them; empty turns are a member of the root alone. A node
    is a distinct beginning; its members begin with it; ``saved_tokens`` sums, over its subtree, the code points of a node's
    last turn times its members but one; ``ends_sha256`` is the digest of the sorted, comma-joined ids of the members that
    end there. Defined cases: equal conversations are members of the same nodes, and an id that comes twice counts twice;
    an empty table has no nodes; other columns are not read.

    Scale: a row moves three times (grouped, sorted, swept), as digests of 16 bytes a turn; a conversation is one row and a
    block of about BLOCK_TURNS turns one task's. Copies of one conversation are dealt over blocks by their ids. Per block a
    few numbers come to the driver; the nodes open at a block's end are as many as its last conversation has turns. SHA-256
    can't be cut: the ids that end at one node are hashed in their order, a block's piece at a time.
    """
    ship(convs.sparkSession)
    spark = convs.sparkSession
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key")
    x = written(convs.select("conv_id", key, F.transform("turns", lambda t: t["chars"].cast("long")).alias("chars")), "sequences")
    if blocks is None:
        turns = x.agg(F.sum(F.size("chars") + 1)).first()[0] or 1
        blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(turns / BLOCK_TURNS))
    x = x.repartitionByRange(blocks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    table = written(x.mapInArrow(_neighbours, "part int, i long, conv_id long, size int, lcp int, sums array<long>, edge binary"), "array")

    # A block's first LCP: two keys a block, in order.
    edges = table.where("edge is not null").select("part", "i", "edge", F.lag("edge").over(Window.orderBy("part", "i")).alias("last")).where("i = 0")

    def met(batches):
        for b in batches:
            v = [-1 if c is None else shared(c, e) for e, c in zip(b["edge"].to_pylist(), b["last"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["part"], pa.array(v, pa.int32())], names=["part", "v"])

    firsts = sorted(tuple(r) for r in edges.mapInArrow(met, "part int, v int").collect())
    bounds = {p: (k, v, after) for k, ((p, v), after) in enumerate(zip(firsts, [*[v for _, v in firsts[1:]], -1], strict=False))}
    swept = written(_swept(table, bounds), "swept")
    dropped(table)
    known = Blocks(sorted(swept.where("what = 'block'").collect(), key=lambda r: r["block"]))

    def ended(x):
        end, low = known.end(x["block"], x["depth"])
        return {"end": end, "b_low": low, "b_kids": known.children(x["block"], end, x["depth"])} | {f"b_{k}": known.between(k, x["block"], end) for k in ("n", "s", "leaves")}

    spine = _in_arrow(swept.where("what = 'spine'").drop("what", "prev", "ids"), [("end", "int"), *[(f"b_{k}", "long") for k in ("n", "low", "s", "leaves", "kids")]], ended)
    chain = swept.where("what = 'chain'")
    stop = chain.select(F.col("block").alias("end"), F.col("depth").alias("under"), "prev", *[F.col(k).alias(f"c_{k}") for k in ("n", "low", "s", "leaves", "kids")])
    spine = spine.join(stop, (spine["end"] == stop["end"]) & (F.col("under") < F.col("depth")) & (F.col("depth") <= F.col("prev")), "left")
    part = lambda k: F.coalesce(f"c_{k}", F.lit(0))
    added = [(F.col(k) + F.col(f"b_{k}") + part(k)).alias(k) for k in ("n", "s", "leaves")]
    more = F.when(F.col("prev") == F.col("depth"), part("kids")).otherwise(0)
    spine = written(spine.select("block", "depth", F.least("low", "b_low", "c_low").alias("low"), *added, (F.col("kids") + F.col("b_kids") + more).alias("kids"), "c", "via", "parent"), "spine")

    owner = [("owner", "int")]
    began = lambda x: {"owner": known.begin(x["block"], x["depth"])}
    pieces = swept.where("what = 'ids'").select("block", "depth", "via", "ids")
    pieces = pieces.where(F.col("via") == _BEYOND).withColumn("owner", F.col("block")).unionByName(_in_arrow(pieces.where(F.col("via") == _BEFORE), owner, began))
    ends = pieces.select("owner", "depth", "block", "ids").repartition("owner", "depth").sortWithinPartitions("owner", "depth", "block").drop("block").mapInArrow(_hashed, "owner int, depth int, ends string")
    spine = spine.join(ends.withColumnRenamed("owner", "block"), ["block", "depth"], "left").withColumn("ends", F.coalesce("ends", F.lit(NONE)))

    # The ids of the parents that are closed beyond a block or opened before it, for each block that needs them.
    asked = _in_arrow(chain.where("depth >= 0").select("block", "depth"), owner, began)
    opened = spine.select(F.col("block").alias("owner"), "depth", F.col("low").alias("up"))
    before = asked.join(opened, ["owner", "depth"]).select("block", F.lit(_BEFORE).alias("via"), F.col("depth").alias("p"), "up")
    path = before.unionByName(spine.select("block", F.lit(_BEYOND).alias("via"), F.col("depth").alias("p"), F.col("low").alias("up")))
    nodes = swept.where("what = 'node'").withColumnRenamed("ids", "ends").select(spine.columns).unionByName(spine).withColumn("p", F.col("depth") - 1)
    long = lambda c: c.cast("long")
    return nodes.join(path, ["block", "via", "p"], "left").select(
        F.col("low").alias("conv_id"),
        long(F.col("depth")).alias("depth"),
        F.coalesce("parent", "up").alias("parent_conv_id"),
        long(F.col("n")).alias("n_convs"),
        long(F.col("kids")).alias("n_children"),
        long(F.col("leaves")).alias("n_leaves"),
        long(F.col("s") - (F.col("n") - 1) * F.col("c")).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
