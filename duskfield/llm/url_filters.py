"""URL filters: rules in a sorted array of digests, memory-mapped by every worker.

The 64-bit xxhash of every rule's host and path goes into a sorted array; a batch of urls gives all its candidate
keys (host suffix with path prefix), which are probed by one vectorised binary search, and a hit counts only if the
stored full string equals the candidate.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ship

#: An index of more bytes is cut by ranges of digests into several files.
MAX_INDEX_BYTES = 256 << 20
MAGIC = b"DIGIDX01"
_placed: dict[str, str] = {}


def write_index(rules: list[tuple[str, str, str]], most: int = MAX_INDEX_BYTES) -> list[bytes]:
    """Files of (verdict, host, path) rules, each of about ``most`` bytes or one rule: digests sorted over all files, then
    offsets, verdicts and the strings, then the lengths of all rules' paths."""
    seen: dict[str, str] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r}")
        seen[f"{host}{path}"] = verdict if seen.get(f"{host}{path}", verdict) == verdict else "block"  # a rule given both ways blocks
    hosts = {f"{h}{p}": h for _, h, p in rules}
    rows = sorted((xxhash.xxh64_intdigest(k.encode()), k) for k in seen)
    lengths = np.array(sorted({len(p) for _, _, p in rules}), "<i4")
    cuts, held = [0], 0
    for i, (_, k) in enumerate(rows):
        size = len(k.encode()) + 21
        if held and held + size > most:
            cuts.append(i)
            held = 0
        held += size
    cuts.append(len(rows))
    files = []
    for first, last in zip(cuts, cuts[1:], strict=False):
        own = rows[first:last]
        texts = [k.encode() for _, k in own]
        offsets = np.zeros(len(own) + 1, "<i8")
        offsets[1:] = np.cumsum([len(t) for t in texts])
        host_bytes = np.array([len(hosts[k].encode()) for _, k in own], "<i4")
        head = MAGIC + struct.pack("<qq", len(own), len(lengths))
        files.append(b"".join([head, np.array([d for d, _ in own], "<u8").tobytes(), offsets.tobytes(), host_bytes.tobytes(), np.array([seen[k] == "allow" for _, k in own], "u1").tobytes(), lengths.tobytes(), *texts]))
    return files


class DigestIndex:
    """A mapped file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, k = struct.unpack("<qq", raw[8:24].tobytes())
        at = 24
        take = lambda kind, count, at: (raw[at : at + count * np.dtype(kind).itemsize].view(kind), at + count * np.dtype(kind).itemsize)
        self.digests, at = take("<u8", n, at)
        offsets = raw[at : at + 8 * (n + 1)]
        self.offsets, at = offsets.view("<i8"), at + 8 * (n + 1)
        host_bytes = raw[at : at + 4 * n].tobytes()
        self.host_bytes, at = np.frombuffer(host_bytes, "<i4"), at + 4 * n
        self.allow, at = raw[at : at + n], at + n
        self.lengths, at = np.frombuffer(raw[at : at + 4 * k].tobytes(), "<i4").tolist(), at + 4 * k
        self.texts = raw[at:]

    def text(self, row: int) -> bytes:
        return self.texts[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def find(self, probes: np.ndarray, keys: list[bytes], hosts: list[int]) -> Iterator[tuple[int, int]]:
        """(candidate, row) of the candidates that are rules, by one binary search for all."""
        if not len(self.digests) or not keys:
            return
        at = np.searchsorted(self.digests, probes)
        for j in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == probes):
            row = int(at[j])
            while row < len(self.digests) and self.digests[row] == probes[j]:  # equal digests lie side by side
                if self.text(row) == keys[j] and self.host_bytes[row] == hosts[j]:
                    yield int(j), row
                    break
                row += 1


def _lookup(names: list[str]):
    files: list[DigestIndex] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not files:
            files.extend(DigestIndex(SparkFiles.get(n)) for n in names)
        for batch in batches:
            keys: list[bytes] = []
            hosts: list[int] = []
            owner: list[int] = []
            for j, (host, path) in enumerate(zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)):
                parts = host.split(".")
                suffixes = [".".join(parts[k:]).encode() for k in range(len(parts))]
                for n in files[0].lengths:
                    if n <= len(path):
                        p = path[:n].encode()
                        for s in suffixes:
                            keys.append(s + p)
                            hosts.append(len(s))
                            owner.append(j)
            probes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
            best: list[tuple[int, int, bytes, bool] | None] = [None] * batch.num_rows
            for x in files:
                for c, row in x.find(probes, keys, hosts):
                    found = (len(keys[c]), hosts[c], keys[c], bool(x.allow[row]))
                    j = owner[c]
                    if best[j] is None or found > best[j]:
                        best[j] = found
            rule = [b[2].decode() if b else None for b in best]
            verdict = [("allow" if b[3] else "block") if b else None for b in best]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["host"], batch["path"], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["row", "host", "path", "rule", "verdict"])

    return run


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://((?s:.*))$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow", max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are (verdict, host, path). A rule fits its host and all subdomains if the path starts with the rule's;
    the longest fitting rule wins, by its host where two are as long; without one the verdict is ``default``. Defined
    cases: a null url, or one without ``://``, has an empty host and path, which no rule fits; repeated rows are
    judged each; an empty table, or no rules, works.

    Scale: one pass without a shuffle. The index travels as files, of ``max_index_bytes`` each at most, that an executor
    fetches once and its workers map, so they share the pages; more rules make more files, and every one is searched.
    """
    ship(pages.sparkSession)
    host, path = url_parts(F.col(url_col))
    x = pages.select(F.col(id_col).alias("row"), host.alias("host"), path.alias("path"))
    names = []
    for raw in write_index(rules, max_index_bytes):
        name = f"rules-{hashlib.sha256(raw).hexdigest()[:24]}.idx"
        if name not in _placed:  # one path for a name, as Spark's file server wants it
            _placed[name] = os.path.join(tempfile.mkdtemp(prefix="duskfield-"), name)
            with open(_placed[name], "wb") as f:
                f.write(raw)
        pages.sparkSession.sparkContext.addFile(_placed[name])
        names.append(name)
    kind = x.schema["row"].dataType.simpleString()
    out = x.mapInArrow(_lookup(names), f"row {kind}, host string, path string, rule string, verdict string")
    return out.select(F.col("row").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))

