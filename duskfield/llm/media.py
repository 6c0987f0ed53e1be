"""Media columns: motion-JPEG AVI files written and read without a codec library.

Frames are grey lossless JPEGs (process SOF3, 8-bit samples, left prediction) 64 samples wide, one restart interval per
row, so that the rows of all frames of a batch are coded and decoded side by side, sample by sample. Reading goes by
the RIFF index, decodes every intra frame, and cuts shots where the histogram changes by more than the recent past has it.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

WIDTH, HEIGHT = 64, 16
FRAME = WIDTH * HEIGHT
MS_PER_FRAME = 40
#: Huffman code lengths by difference category. Text's differences are mostly of categories 1 to 7.
CODE_LENGTHS = {1: 3, 2: 3, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 0: 4, 8: 5}
HISTOGRAM_BINS = 16
#: A shot ends where the histogram difference is over the mean of the last ones by so many standard deviations, and this much.
SHOT_WINDOW, SHOT_SIGMAS, SHOT_LEAST = 8, 3.0, 0.15
#: Bytes of payload that are coded or decoded together.
GROUP_BYTES = 1 << 21


def _codes(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Canonical codes: category -> (code, bits), in order of length."""
    out, code, last = {}, 0, 0
    for symbol, n in sorted(lengths.items(), key=lambda x: x[1]):
        code <<= n - last
        out[symbol], code, last = (code, n), code + 1, n
    return out


def _headers() -> bytes:
    by_length = sorted(CODE_LENGTHS.items(), key=lambda x: x[1])
    counts = bytes(sum(n == k for _, n in by_length) for k in range(1, 17))
    dht = b"\x00" + counts + bytes(s for s, _ in by_length)
    sof = struct.pack(">BHHB", 8, HEIGHT, WIDTH, 1) + b"\x01\x11\x00"
    segment = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    return b"\xff\xd8" + segment(0xC4, dht) + segment(0xC3, sof) + segment(0xDD, struct.pack(">H", WIDTH)) + segment(0xDA, b"\x01\x01\x00\x01\x00\x00")


@lru_cache(maxsize=1)
def _encoder() -> tuple[np.ndarray, np.ndarray]:
    """For each difference -255 to 255: its code with the extra bits, and their number."""
    codes = _codes(CODE_LENGTHS)
    bits, lengths = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        k = abs(d).bit_length()
        code, n = codes[k]
        bits[d + 255] = code << k | (d if d >= 0 else d + (1 << k) - 1)
        lengths[d + 255] = n + k
    return bits, lengths


@lru_cache(maxsize=8)
def _decoder(dht: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For every 16 bits: the difference that they begin with, and its bits."""
    counts, symbols = dht[1:17], dht[17:]
    lengths = dict(zip(symbols, [k + 1 for k, n in enumerate(counts) for _ in range(n)], strict=True))
    value, used = np.zeros(1 << 16, np.int16), np.zeros(1 << 16, np.int64)
    for k, (code, n) in _codes(lengths).items():
        if n + k > 16:
            raise ValueError("codes of over 16 bits with their extra bits are not read")
        extra = np.arange(1 << k)
        d = np.where(extra >= (1 << k) >> 1, extra, extra - (1 << k) + 1) if k else extra
        span = 1 << (16 - n - k)
        first = (code << k) * span
        value[first : first + (span << k)] = np.repeat(d, span)
        used[first : first + (span << k)] = n + k
    return value, used


def encode_rows(rows: np.ndarray) -> list[bytes]:
    """The entropy-coded segment of every row of samples, stuffed."""
    bits, lengths = _encoder()
    d = np.diff(rows.astype(np.int16), axis=1, prepend=np.int16(128)) + 255
    code, n = bits[d], lengths[d]
    end = np.cumsum(n, axis=1)
    at = end - n
    stride = int(end[:, -1].max(initial=0)) // 8 + 4
    word = code << (24 - n - (at & 7))
    where = (at >> 3) + np.arange(len(rows))[:, None] * stride
    out = np.zeros(len(rows) * stride)
    for k in range(3):
        out += np.bincount((where + k).ravel(), weights=(word >> (16 - 8 * k) & 255).ravel(), minlength=len(out))
    total = end[:, -1]
    spare = -total & 7
    last = (total - 1 >> 3) + np.arange(len(rows)) * stride
    out[last] += (1 << spare) - 1  # the last byte is filled with ones
    raw = out.astype(np.uint8).tobytes()
    size = (total + 7 >> 3).tolist()
    return [raw[k * stride : k * stride + m].replace(b"\xff", b"\xff\x00") for k, m in enumerate(size)]


def decode_rows(segments: list[bytes], dht: bytes) -> np.ndarray:
    """Samples of rows from their unstuffed segments, all rows in step."""
    value, used = _decoder(dht)
    stride = max(map(len, segments), default=0) + 3
    raw = np.frombuffer(b"".join(s.ljust(stride, b"\xff") for s in segments), np.uint8).reshape(len(segments), stride).astype(np.int32)
    window = (raw[:, :-2] << 16 | raw[:, 1:-1] << 8 | raw[:, 2:]).ravel()
    base = np.arange(len(segments)) * (stride - 2)
    pos = np.zeros(len(segments), np.int64)
    out = np.empty((WIDTH, len(segments)), np.int16)
    last = np.full(len(segments), 128, np.int16)
    for j in range(WIDTH):
        peek = window[base + (pos >> 3)] >> (8 - (pos & 7)) & 0xFFFF
        last = last + value[peek]
        pos += used[peek]
        out[j] = last
    return out.T.astype(np.uint8)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def avi_file(frames: list[bytes], payload_bytes: int) -> bytes:
    """A RIFF AVI file of the frames, with its index; a comment has the samples that count."""
    most = max(map(len, frames))
    avih = struct.pack("<14I", MS_PER_FRAME * 1000, most * 1000 // MS_PER_FRAME, 0, 0x10, len(frames), 0, 1, most, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, MS_PER_FRAME, 1000, 0, len(frames), most, 0xFFFFFFFF, 0, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    info = _chunk(b"LIST", b"INFO" + _chunk(b"ICMT", b"payload_bytes=%d\0" % payload_bytes))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(_chunk(b"00dc", f))
        at += len(movi[-1])
    return _chunk(b"RIFF", b"AVI " + hdrl + info + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """An AVI file for each payload, whose size is a multiple of WIDTH; the last frame is filled up with zeros."""
    rows = [np.frombuffer(p, np.uint8).reshape(-1, WIDTH) for p in payloads]
    rows = [np.vstack([r, np.zeros((-len(r) % HEIGHT, WIDTH), np.uint8)]) for r in rows]
    segments = encode_rows(np.vstack(rows))
    head, out, at = _headers(), [], 0
    marks = [bytes([0xFF, 0xD0 + k % 8]) for k in range(HEIGHT)]
    for p, r in zip(payloads, rows, strict=True):
        frames = []
        for _ in range(len(r) // HEIGHT):
            body = [x for k in range(HEIGHT) for x in (segments[at + k], marks[k])][:-1]
            frames.append(head + b"".join(body) + b"\xff\xd9")
            at += HEIGHT
        out.append(avi_file(frames, len(p)))
    return out


def _chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        name, n = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name in (b"LIST", b"RIFF"):
            yield name + data[at + 8 : at + 12], at + 12, at + 8 + n
        else:
            yield name, at + 8, at + 8 + n
        at += 8 + n + (n & 1)


def parse_avi(data: bytes) -> tuple[int, list[bytes]]:
    """The payload's size and the frames, by the index."""
    top = next(_chunks(data, 0, len(data)), None)
    if top is None or top[0] != b"RIFFAVI ":
        raise ValueError("no RIFF AVI file")
    movi, index, size = None, b"", None
    for name, at, end in _chunks(data, top[1], min(top[2], len(data))):
        if name == b"LISTmovi":
            movi = at - 4
        elif name == b"idx1":
            index = data[at:end]
        elif name == b"LISTINFO":
            for inner, a, e in _chunks(data, at, end):
                if inner == b"ICMT" and (m := re.match(rb"payload_bytes=(\d+)", data[a:e])):
                    size = int(m[1])
    if movi is None or size is None:
        raise ValueError("no frames or no payload size")
    frames = []
    for k in range(0, len(index) - 15, 16):
        at, n = struct.unpack_from("<II", index, k + 8)
        frames.append(data[movi + at + 8 : movi + at + 8 + n])
    return size, frames


_MARK = re.compile(b"\xff[\xd0-\xd7]")


def _segments(frame: bytes) -> tuple[bytes, list[bytes]]:
    """A frame's Huffman table and its rows' unstuffed segments."""
    at, dht, rows = 2, b"", 0
    while True:
        marker, n = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
        body = frame[at + 4 : at + 2 + n]
        if marker == 0xC4:
            dht = body
        elif marker == 0xC3:
            bits, rows, width, planes = struct.unpack_from(">BHHB", body)
            if (bits, width, planes) != (8, WIDTH, 1):
                raise ValueError("frame of another kind")
        at += 2 + n
        if marker == 0xDA:
            break
    scan = frame[at : frame.rindex(b"\xff\xd9")]
    out = [s.replace(b"\xff\x00", b"\xff") for s in _MARK.split(scan)]
    if len(out) != rows:
        raise ValueError("rows are missing")
    return dht, out


def shots(counts: np.ndarray) -> list[tuple[int, int]]:
    """First and last frame of each shot, from the frames' histograms."""
    share = counts / counts.sum(axis=1, keepdims=True)
    change = np.abs(np.diff(share, axis=0)).sum(axis=1) / 2
    starts = [0]
    for k, x in enumerate(change.tolist()):
        past = change[max(starts[-1], k - SHOT_WINDOW) : k]
        limit = max(SHOT_LEAST, float(past.mean() + SHOT_SIGMAS * past.std())) if len(past) else SHOT_LEAST * 2
        if x > limit:
            starts.append(k + 1)
    return list(zip(starts, [s - 1 for s in starts[1:]] + [len(counts) - 1], strict=True))


def decode_files(files: list[bytes]) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """Each file's payload and its shots."""
    parsed = [parse_avi(f) for f in files]
    got = [_segments(f) for _, frames in parsed for f in frames]
    if len({dht for dht, _ in got}) > 1:
        return [x for f in files for x in decode_files([f])] if len(files) > 1 else _by_table(parsed)
    samples = decode_rows([s for _, segments in got for s in segments], got[0][0])
    pixels = samples.reshape(len(got), FRAME)
    frame = np.repeat(np.arange(len(got)), FRAME)
    counts = np.bincount(frame * HISTOGRAM_BINS + (pixels.ravel() >> 4), minlength=len(got) * HISTOGRAM_BINS).reshape(-1, HISTOGRAM_BINS)
    out, at = [], 0
    for size, frames in parsed:
        counts[at + len(frames) - 1, 0] -= len(frames) * FRAME - size  # what the last frame is filled up with
        out.append((pixels[at : at + len(frames)].tobytes()[:size], shots(counts[at : at + len(frames)])))
        at += len(frames)
    return out


def _by_table(parsed: list[tuple[int, list[bytes]]]) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """A file whose frames have tables of their own."""
    size, frames = parsed[0]
    pixels = np.stack([decode_rows(s, dht).ravel() for dht, s in map(_segments, frames)])
    counts = np.stack([np.bincount(p >> 4, minlength=HISTOGRAM_BINS) for p in pixels])
    counts[-1, 0] -= pixels.size - size
    return [(pixels.tobytes()[:size], shots(counts))]


def payload(text: bytes) -> bytes:
    """The bytes with zeros up to a positive multiple of WIDTH."""
    return text.ljust(max(WIDTH, -(-len(text) // WIDTH) * WIDTH), b"\0")


def _groups(sizes: list[int]) -> Iterator[slice]:
    first, held = 0, 0
    for k, n in enumerate(sizes):
        if held and held + n > GROUP_BYTES:
            yield slice(first, k)
            first, held = k, 0
        held += n
    if sizes:
        yield slice(first, len(sizes))


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in b["text"]]
        for g in _groups([len(t) for t in texts]):
            yield pa.RecordBatch.from_arrays([b["id"][g.start : g.stop], pa.array([len(t) for t in texts[g]], pa.int64()), pa.array(encode_payloads([payload(t) for t in texts[g]]), pa.binary())], names=["id", "n_bytes", "media"])


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    clip = pa.list_(pa.struct([("first_frame", pa.int32()), ("last_frame", pa.int32()), ("start_ms", pa.int64()), ("end_ms", pa.int64())]))
    for b in batches:
        files = [m.as_buffer().to_pybytes() for m in b["media"]]
        for g in _groups([len(f) for f in files]):
            got = decode_files(files[g])
            clips = [[{"first_frame": s, "last_frame": e, "start_ms": s * MS_PER_FRAME, "end_ms": (e + 1) * MS_PER_FRAME} for s, e in c] for _, c in got]
            cut = b.slice(g.start, g.stop - g.start)
            yield pa.RecordBatch.from_arrays([cut["id"], cut["n_bytes"], cut["media"], pa.array([p for p, _ in got], pa.binary()), pa.array(clips, clip)], names=["id", "n_bytes", "media", "payload", "clips"])


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_bytes`` (of the text in UTF-8) and ``media``, an AVI file of its bytes.

    Equal texts give equal files. Null texts are empty; an empty text is 64 zero bytes; rows of one id are each stored;
    an empty table gives an empty table; extra columns are not read.
    """
    ship(docs.sparkSession)
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return x.mapInArrow(_encoded, f"id {x.schema['id'].dataType.simpleString()}, n_bytes long, media binary")


def from_media(media: DataFrame) -> DataFrame:
    """The rows of ``to_media`` with ``payload``, the samples read back, and ``clips``, the shots with their times.

    ``media`` is as ``to_media`` gives it, where nulls have become empty texts; null ids stay; equal rows are read each; an
    empty table gives an empty table. Both ways are row by row in groups of about GROUP_BYTES, without a shuffle; memory
    is bounded by a group and the longest text.
    """
    ship(media.sparkSession)
    return media.mapInArrow(_decoded, f"id {media.schema['id'].dataType.simpleString()}, n_bytes long, media binary, payload binary, clips array<struct<first_frame:int,last_frame:int,start_ms:long,end_ms:long>>")


def clip_rows(decoded: DataFrame) -> DataFrame:
    """A row per clip: ``id``, ``clip`` (its number from 0), its first and last frame and its times in milliseconds.

    Every file has a clip at least, also that of an empty text; rows of one id give clips each; null ids stay; an empty
    table gives an empty table. A projection, without a shuffle.
    """
    return decoded.select("id", F.posexplode("clips").alias("clip", "c")).select("id", "clip", "c.*")
