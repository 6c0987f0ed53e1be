"""Token counts by a map-side two-tier lookup.

A text is cut into the pre-tokens of its tokenizer; their token counts come from a broadcast table of the corpus'
frequent pre-tokens and, where that misses, from a cache that each worker keeps. Pre-tokens are never shuffled: what
moves for the table is each partition's bounded summary of its heaviest ones.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .tokens import tokenizer

#: Entries of the broadcast table, counters of a partition's summary, entries of a worker's cache.
TABLE_ENTRIES = 1 << 16
SUMMARY_COUNTERS = 1 << 13
CACHE_ENTRIES = 1 << 19
#: Pre-tokens of more characters are encoded each time, so that tables and caches stay small.
LONG = 64

#: Characters on whose classes, cases and compositions all Unicode versions agree: printable ones to Latin Extended-A, and
#: common dashes, quotes and the euro sign. Texts with others are encoded whole.
_PLAIN = [*map(chr, [*range(9, 14), *range(32, 127), *range(0xA0, 0x180), *range(0x2010, 0x2028), 0x20AC])]
PLAIN = re.compile(f"[{''.join(map(re.escape, _PLAIN))}]*")


def _spelled(pattern: str) -> str:
    """A tokenizer's pattern with its letter and number classes spelled out over the plain characters, which takes half the
    time to match."""
    chars = lambda kind: "".join(re.escape(c) for c in _PLAIN if unicodedata.category(c)[0] == kind)
    return re.sub(r"\[\\p\{([LN])\}\]|\\p\{([LN])\}", lambda m: f"[{chars(m[1])}]" if m[1] else chars(m[2]), pattern)


def _compiled(pattern: str):
    if "\\p" in re.sub(r"\[(?:\\.|[^\]\\])*\]", "", pattern.replace("\\p{", "\\p<")):  # a class that isn't in brackets
        return regex.compile(pattern)
    return re.compile(_spelled(pattern))


@lru_cache(maxsize=4)
def rules(path: str) -> tuple[object, bool] | None:
    """How a tokenizer file cuts plain texts into pre-tokens whose tokens don't depend on their neighbours: a pattern whose
    matches they are, and whether texts are lower-cased first. None where the file has steps other than these, and texts
    are encoded whole.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, norm, pre = file["model"], file.get("normalizer"), file.get("pre_tokenizer")
    if model["type"] != "BPE" or model.get("dropout") or file.get("truncation") or file.get("padding"):
        return None
    lower = False
    for step in (norm or {}).get("normalizers", [norm] if norm else []):
        if step["type"] == "Lowercase":
            lower = True
        elif step["type"] == "Replace":
            if step["pattern"] != {"Regex": r"\s+"} or step["content"] != " ":
                return None
        elif step["type"] != "NFC":  # plain characters are composed already
            return None
    squeezed = norm is not None and any(x["type"] == "Replace" for x in norm.get("normalizers", [norm]))
    cuts = (pre or {}).get("pretokenizers", [pre] if pre else [])
    if len(cuts) == 1 and cuts[0]["type"] == "ByteLevel" and cuts[0].get("use_regex", True) and not cuts[0]["add_prefix_space"] and not squeezed:
        return regex.compile(public_tokenizers.PATTERN), lower
    if len(cuts) == 2 and cuts[0]["type"] == "Split" and cuts[1]["type"] == "ByteLevel" and not cuts[1].get("use_regex", True) and not cuts[1]["add_prefix_space"]:
        split = cuts[0]
        drops_space = split["behavior"] == "Removed" and split["invert"]
        if "Regex" in split["pattern"] and drops_space and all(not re.fullmatch(_spelled(split["pattern"]["Regex"]), c) for c in " \t\n"):
            return _compiled(split["pattern"]["Regex"]), lower
    return None


def write_table(lengths: dict[str, int]) -> bytes:
    """A compact hash table: the number of entries, sorted 64-bit digests, lengths, offsets, and the pre-tokens themselves."""
    rows = sorted((xxhash.xxh64_intdigest(k), k) for k in (p.encode() for p in lengths))
    offsets = np.zeros(len(rows) + 1, "<u4")
    offsets[1:] = np.cumsum([len(k) for _, k in rows])
    counts = np.array([lengths[k.decode()] for _, k in rows], "<u2")
    return b"".join([np.array([len(rows)], "<u8").tobytes(), np.array([d for d, _ in rows], "<u8").tobytes(), offsets.tobytes(), counts.tobytes(), *[k for _, k in rows]])


class LengthTable:
    """The mapped file, whose pages a machine's workers share."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view("<u8")[0])
        self.digests = raw[8 : 8 + 8 * n].view("<u8")
        at = 8 + 8 * n
        self.offsets = np.frombuffer(raw[at : at + 4 * (n + 1)].tobytes(), "<u4")
        at += 4 * (n + 1)
        self.counts = np.frombuffer(raw[at : at + 2 * n].tobytes(), "<u2")
        self.texts = raw[at + 2 * n :]

    def find(self, pres: list[str]) -> dict[str, int]:
        """Those of ``pres`` that the table has, confirmed by their strings, by one binary search for all."""
        if not len(self.digests) or not pres:
            return {}
        keys = [p.encode() for p in pres]
        probes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, probes)
        out = {}
        for j in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == probes):
            row = int(at[j])
            while row < len(self.digests) and self.digests[row] == probes[j]:
                if self.texts[self.offsets[row] : self.offsets[row + 1]].tobytes() == keys[j]:
                    out[pres[j]] = int(self.counts[row])
                    break
                row += 1
        return out


class Lengths(dict):
    """A worker's cache: pre-token -> its tokens, from the table or else encoded; started anew when it is full."""

    def __init__(self, path: str, table: LengthTable):
        super().__init__()
        self.own, self.table, self.rules = tokenizer(path), table, rules(path)
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]

    def __missing__(self, pre: str) -> int:
        n = len(self.own.encode(pre, add_special_tokens=False).ids)
        if len(pre) <= LONG:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[pre] = n
        return n

    def learn(self, pres: set[str]) -> None:
        """Looks the unknown ones up together and encodes what the table lacks, which costs less than one by one."""
        new = [p for p in pres if p not in self and len(p) <= LONG]
        if len(self) + len(new) > CACHE_ENTRIES:
            self.clear()
        got = self.table.find(new)
        self.update(got)
        rest = [p for p in new if p not in got]
        self.update(zip(rest, (len(e.ids) for e in self.own.encode_batch_fast(rest, add_special_tokens=False)), strict=True))


def pre_tokens(text: str, special: list[str], cut: tuple[object, bool] | None) -> list[str] | None:
    """The pre-tokens of a text of plain characters; None for one that has to be encoded whole."""
    if cut is None or not PLAIN.fullmatch(text) or any(s in text for s in special):
        return None
    return cut[0].findall(text.lower() if cut[1] else text)


_known: dict[str, tuple[str, Lengths]] = {}


def _summaries(path: str, counters: int):
    """Each partition's heaviest pre-tokens with lower bounds of their counts (Misra and Gries, pruned in bulk)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
        held: Counter = Counter()
        cut = rules(path)
        for b in batches:
            for t in b["text"]:
                held.update(pre_tokens(t.as_py() or "", special, cut) or ())
                if len(held) > 8 * counters:
                    least = sorted(held.values(), reverse=True)[counters]
                    held = Counter({k: v - least for k, v in held.items() if v > least})
        top = [(k, v) for k, v in held.most_common(counters) if len(k) <= LONG]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([v for _, v in top], pa.int64())], names=["pre", "n"])

    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", entries: int = TABLE_ENTRIES, counters: int = SUMMARY_COUNTERS) -> dict[str, int]:
    """The corpus' frequent pre-tokens with their token counts: at most ``entries`` of at most LONG characters."""
    x = docs.select(F.col(text_col).alias("text")).mapInArrow(_summaries(path, counters), "pre string, n long")
    rows = x.groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(entries).collect()
    pres = [r["pre"] for r in rows]
    return dict(zip(pres, (len(e.ids) for e in tokenizer(path).encode_batch_fast(pres, add_special_tokens=False)), strict=True))


_placed: dict[str, str] = {}


def _ship_table(docs: DataFrame, lengths: dict[str, int]) -> str:
    """The table as a file that each executor fetches once; its name."""
    raw = write_table(lengths)
    name = f"lengths-{hashlib.sha256(raw).hexdigest()[:24]}.tbl"
    if name not in _placed:  # one path for a name, as Spark's file server wants it
        _placed[name] = os.path.join(tempfile.mkdtemp(prefix="duskfield-"), name)
        with open(_placed[name], "wb") as f:
            f.write(raw)
    docs.sparkSession.sparkContext.addFile(_placed[name])
    return name


def _counted(path: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _known.get(path)
        if held is None or held[0] != name:
            held = _known[path] = (name, Lengths(path, LengthTable(SparkFiles.get(name))))
        lengths = held[1]
        for b in batches:
            counts: list[int] = []
            for at in range(0, b.num_rows, 256):
                part = [pre if (pre := pre_tokens(t, lengths.special, lengths.rules)) is not None else t for t in ((v.as_py() or "") for v in b["text"].slice(at, 256))]
                lengths.learn(set().union(*[p for p in part if isinstance(p, list)]))
                counts += [sum(map(lengths.__getitem__, p)) if isinstance(p, list) else len(lengths.own.encode(p, add_special_tokens=False).ids) for p in part]
            yield pa.RecordBatch.from_arrays([b["id"], b["n_bytes"], pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", entries: int = TABLE_ENTRIES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (over ``limit``).

    Counts are those of the tokenizer file over the whole text, special strings in it included, without added tokens. Any
    file of the library does: where its steps allow it (see ``rules``), texts are cut and looked up, else encoded whole.
    Defined cases: a null or empty text has no bytes and no tokens; repeated rows are counted each; null ids stay; an
    empty table gives an empty table; extra columns are not read.

    Scale: two passes over the texts, no shuffle of text or pre-tokens. The table and the summaries are bounded by
    parameters, whatever the corpus; so is what a worker remembers. The table travels as a file of hashes and lengths that
    the workers of a machine map, so that they share its pages.
    """
    ship(docs.sparkSession)
    frequent = frequent_lengths(docs, tokenizer_path, text_col, entries)
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = x.schema["id"].dataType.simpleString()
    got = x.mapInArrow(_counted(tokenizer_path, _ship_table(docs, frequent)), f"id {kind}, n_bytes long, n_tokens long")
    return got.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
