"""Hierarchical multi-length packing of documents into training sequences.

Documents are routed to tiers of context sizes by what is left of them after whole windows of the largest tier; each
tier is packed from its longest piece down, gaps are filled from shorter tiers, pieces are cut only where no whole one
fits, and the sequences of a tier are dealt to step groups of equal tokens and even attention cost.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import ship
from .tokens import ByteEncoder

TIERS = (256, 512, 1024, 2048)
#: Tokens that are packed together at a time, and tokens of a step group.
BLOCK_TOKENS = 1 << 21
STEP_TOKENS = 1 << 16

Piece = tuple[int, int, int]  # document, start, length


class Packer:
    """Packs pieces into windows that are full to the last token; what fills none waits for more.

    ``windows`` gets (tier, pieces). Pieces are kept by tier in lists sorted by length.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tiers
        self.pools: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}  # (length, document, start)
        self.windows: list[tuple[int, list[Piece]]] = []
        self.rest: list[Piece] = []

    def add(self, doc: int, n: int) -> None:
        """A document of ``n`` tokens: whole windows of the largest tier at once, the rest to its tier."""
        most, at = self.tiers[-1], 0
        while n - at >= most:
            self.windows.append((most, [(doc, at, most)]))
            at += most
        if at < n:
            self._keep(n - at, doc, at)

    def _keep(self, length: int, doc: int, start: int) -> None:
        insort(self.pools[next(t for t in self.tiers if length <= t)], (length, doc, start))

    def _fill(self, gap: int, tiers: list[int]) -> tuple[int, int, int] | None:
        """The longest piece of ``tiers`` that fits the gap; else the shortest, cut to it."""
        for t in tiers:
            pool = self.pools[t]
            if pool and (k := bisect_right(pool, (gap, 1 << 62, 0))):
                return pool.pop(k - 1)
        for t in reversed(tiers):
            pool = self.pools[t]
            if pool:
                length, doc, start = pool.pop(bisect_left(pool, (gap, -1, 0)) if pool[-1][0] > gap else 0)
                self._keep(length - gap, doc, start + gap)
                return gap, doc, start
        return None

    def pack(self) -> None:
        """Windows of each tier, the largest first, until none can be filled."""
        for k in range(len(self.tiers) - 1, -1, -1):
            tier, pool = self.tiers[k], self.pools[self.tiers[k]]
            shorter = list(reversed(self.tiers[:k]))
            while pool:
                length, doc, start = pool.pop()
                held, gap = [(length, doc, start)], tier - length
                while gap:
                    got = self._fill(gap, shorter) or self._fill(gap, [tier])
                    if got is None:
                        break
                    held.append(got)
                    gap -= got[0]
                if gap:  # nothing is left anywhere in or below this tier
                    for length, doc, start in held:
                        self.rest.append((doc, start, length))
                    break
                self.windows.append((tier, [(d, s, n) for n, d, s in held]))
        for doc, start, length in self.rest:
            self._keep(length, doc, start)
        self.rest = []

    def finish(self) -> None:
        """What fills no window of its tier goes out in sequences whose lengths are powers of two, so without padding."""
        left = [(d, s, n) for t in reversed(self.tiers) for n, d, s in reversed(self.pools[t])]
        self.pools = {t: [] for t in self.tiers}
        total = sum(n for _, _, n in left)
        size = self.tiers[-1]
        while total:
            while size > total:
                size //= 2
            held, gap = [], size
            while gap:
                doc, start, n = left.pop(0)
                if n > gap:
                    left.insert(0, (doc, start + gap, n - gap))
                    n = gap
                held.append((doc, start, n))
                gap -= n
            self.windows.append((size, held))
            total -= size


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each window: groups hold windows of one tier, about ``step_tokens`` tokens each, and as even a sum of
    squared piece lengths as dealing to and fro from the costliest down gives."""
    out = [0] * len(windows)
    first = 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        own = sorted((k for k, (t, _) in enumerate(windows) if t == tier), key=lambda k: (-sum(n * n for _, _, n in windows[k][1]), k))
        groups = max(1, -(-len(own) * tier // step_tokens))
        for i, k in enumerate(own):
            lap, at = divmod(i, groups)
            out[k] = first + (at if lap % 2 == 0 else groups - 1 - at)
        first += groups
    return out


def _packed(path: str, ranks_path: str | None, end_id: int, tiers: tuple[int, ...], block_tokens: int, step_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ByteEncoder(path, ranks_path)
        first = TaskContext.get().partitionId() << 32
        packer, docs, serial, step, held = Packer(tiers), {}, 0, 0, 0
        kind = None

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal serial, step
            groups = step_groups(packer.windows, step_tokens)
            cols: list[list] = [[] for _ in range(9)]
            for (tier, pieces), group in zip(packer.windows, groups, strict=True):
                offset = 0
                for doc, start, n in pieces:
                    row, ids = docs[doc]
                    for c, v in zip(cols, (row, start, n, ids[start : start + n].tobytes(), len(ids), first + serial, offset, tier, first + step + group), strict=True):
                        c.append(v)
                    offset += n
                serial += 1
            step += max(groups, default=-1) + 1
            packer.windows = []
            for at in range(0, len(cols[0]), 2000):
                part = [c[at : at + 2000] for c in cols]
                types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types, strict=True)], names=NAMES)

        key = 0
        for batch in batches:
            kind = batch["doc_id"].type
            for row, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                docs[key] = (row, ids)
                packer.add(key, len(ids))
                key += 1
                held += len(ids)
                if held >= block_tokens:
                    packer.pack()
                    yield from out()
                    live = {d for pool in packer.pools.values() for _, d, _ in pool}
                    docs, held = {d: v for d, v in docs.items() if d in live}, 0
        if kind is not None:
            packer.pack()
            packer.finish()
            yield from out()

    return run


NAMES = ["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]


def pack_documents(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, end_id: int = 1, tiers: tuple[int, ...] = TIERS, block_tokens: int = BLOCK_TOKENS, step_tokens: int = STEP_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``tokens`` (little-endian unsigned 32-bit ids), ``doc_tokens``,
    ``sequence_id``, ``offset``, ``tier`` (its sequence's length) and ``step_group``.

    Every id of every document, with ``end_id`` at its end, is in one piece; sequences are gapless from offset 0 and
    their lengths are tiers or, for the last few of a partition, smaller powers of two: none needs padding. Defined
    cases: a null or empty text has the end id alone; rows of one id are documents of their own; a null id is kept;
    an empty table gives no pieces; extra columns are not read.

    Scale: a partition packs its own documents in blocks of about ``block_tokens``, so nothing is shuffled, memory is
    bounded by a block and the longest document, and a lost task is packed anew by itself. Ids of sequences and groups
    carry the partition's number in their upper bits.
    """
    if list(tiers) != sorted(set(tiers)) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two, smallest first")
    ship(docs.sparkSession)
    x = docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text")
    kind = x.schema["doc_id"].dataType.simpleString()
    return x.mapInArrow(_packed(tokenizer_path, ranks_path, end_id, tiers, block_tokens, step_tokens), f"doc_id {kind}, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long, tier long, step_group long")
