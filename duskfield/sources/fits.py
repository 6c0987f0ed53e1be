"""FITS images: headers and pixels of the first image of each file, or a rectangle of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

BLOCK, CARD = 2880, 80
#: Pixel types by BITPIX, all big-endian.
TYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
SCHEMA = "path string, header map<string,string>, width int, height int, pixels array<double>, problem string"


def _card(card: str) -> tuple[str, str] | None:
    """Keyword and value of a card; None without a value."""
    if card[8:10] != "= ":
        return None
    text = card[10:].strip()
    if text.startswith("'"):
        end, out = 1, ""
        while end < len(text):
            if text[end] == "'":
                if text[end + 1 : end + 2] != "'":
                    break
                end += 1  # two quotes are one
            out += text[end]
            end += 1
        return card[:8].strip(), out.rstrip()
    return card[:8].strip(), text.split("/")[0].strip()


def read_header(data: bytes, at: int = 0) -> tuple[dict[str, str], int]:
    """The header that starts at ``at``, and where its data start."""
    out: dict[str, str] = {}
    while at < len(data):
        block = data[at : at + BLOCK].decode("ascii", "replace")
        at += BLOCK
        for k in range(0, len(block), CARD):
            card = block[k : k + CARD]
            if card[:8].rstrip() == "END":
                return out, at
            got = _card(card)
            if got and got[0] not in out:
                out[got[0]] = got[1]
    raise ValueError("no END card")


def read_image(data: bytes) -> tuple[dict[str, str], np.ndarray]:
    """Header and pixels (rows from the bottom up) of the first unit that holds an image of two axes, scaled by BSCALE and
    BZERO, with BLANK as NaN."""
    if data[:6] != b"SIMPLE":
        raise ValueError("no FITS file")
    at = 0
    while at < len(data):
        head, start = read_header(data, at)
        shape = [int(head[f"NAXIS{k + 1}"]) for k in range(int(head.get("NAXIS", "0")))]
        kind = np.dtype(TYPES[int(head["BITPIX"])])
        size = int(np.prod(shape)) * kind.itemsize if shape else 0
        if len(shape) >= 2 and head.get("XTENSION", "IMAGE") == "IMAGE" and all(n == 1 for n in shape[2:]):
            raw = np.frombuffer(data, kind, shape[0] * shape[1], start).reshape(shape[1], shape[0])
            out = raw.astype(float) * float(head.get("BSCALE", "1")) + float(head.get("BZERO", "0"))
            if "BLANK" in head and kind.kind in "iu":
                out[raw == int(head["BLANK"])] = np.nan
            return head, out
        size += int(head.get("PCOUNT", "0")) if "XTENSION" in head else 0
        at = start + -(-size // BLOCK) * BLOCK
    raise ValueError("no image")


def read_fits(spark: SparkSession, path: str, box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """A row per file at ``path``: path, header, width, height, pixels (row by row, as doubles; null where blank or NaN) and problem.

    ``box`` (x0, y0, width, height) reads that rectangle only, cut where the image ends. A file that can't be read has
    its problem and no pixels. Files are read one at a time where Spark reads them; a task holds one image.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"], strict=True):
                try:
                    head, pixels = read_image(bytes(data))
                    if box:
                        x0, y0, w, h = box
                        pixels = pixels[max(y0, 0) : max(y0 + h, 0), max(x0, 0) : max(x0 + w, 0)]
                    row = (name, head, pixels.shape[1], pixels.shape[0], pixels.ravel(), None)
                except (ValueError, KeyError) as e:
                    row = (name, {}, 0, 0, None, f"{type(e).__name__}: {e}")
                yield pd.DataFrame([row], columns=["path", "header", "width", "height", "pixels", "problem"])

    return files.mapInPandas(decode, SCHEMA)
