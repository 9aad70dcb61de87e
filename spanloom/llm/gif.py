"""GIF media columns: write byte payloads as timed frames, and decode any GIF into timed frames.

The decoder follows GIF89a: logical screen, global and local palettes, graphic control (delay,
disposal, transparency), interlaced rows, LZW code streams of any minimum code size. Frames are
composed on the canvas by their disposal and transparency rules; each frame gets a colour histogram.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import encode

#: Fixed by the format: the code table holds 4096 entries.
MAX_CODES = 4096
#: Frames and canvases of more pixels end the reading of a file: a few bytes can claim gigabytes.
MAX_PIXELS = 1 << 24
WIDTH, ROWS_PER_FRAME, DELAY_CS = 192, 128, 10
_INDEX = np.arange(256)
#: Palette of written files: 3 bits red, 3 bits green, 2 bits blue.
PALETTE = np.stack([(_INDEX >> 5) * 36, (_INDEX >> 2 & 7) * 36, (_INDEX & 3) * 85], axis=1).astype(np.uint8)


def _widths(min_size: int, n: int) -> np.ndarray:
    """Bit widths of the first n codes after a clear code: they follow from the table's growth alone."""
    entries = np.minimum((1 << min_size) + 1 + np.arange(n), MAX_CODES - 1)
    return np.maximum(min_size + 1, np.frexp(entries)[1]).astype(np.int64)


_WIDTHS = {m: _widths(m, MAX_CODES - (1 << m) - 1) for m in range(1, 9)}


def _pack(codes: np.ndarray, widths: np.ndarray) -> bytes:
    """Codes of the given bit widths, least significant bit first."""
    ends = np.cumsum(widths)
    at = ends - widths
    spread, byte = codes << (at & 7), at >> 3
    n = int(ends[-1] + 7) >> 3
    parts = [np.bincount(byte + k, (spread >> 8 * k) & 255, n + 3) for k in range(3)]
    return sum(parts)[:n].astype(np.uint8).tobytes()


def lzw_encode(data: bytes, min_size: int = 8) -> bytes:
    """The code stream of a frame's palette indices, with a clear code whenever the table is full."""
    clear, out = 1 << min_size, [1 << min_size]
    runs: list[tuple[int, int]] = []  # first and end position of the codes of one table
    table: dict[int, int] = {}
    find, put, free, start = table.get, out.append, clear + 2, 1
    rest = iter(data)
    cur = next(rest, -1)
    for c in rest:
        key = cur << 8 | c
        nxt = find(key)
        if nxt is not None:
            cur = nxt
            continue
        put(cur)
        cur = c
        if free < MAX_CODES:
            table[key] = free
            free += 1
        else:
            runs.append((start, len(out)))
            put(clear)
            start, free = len(out), clear + 2
            table.clear()
    if cur >= 0:
        put(cur)
    put(clear + 1)
    runs.append((start, len(out)))
    size = np.full(len(out), 12, np.int64)
    size[0] = min_size + 1
    for a, b in runs:  # between two clear codes
        known = _WIDTHS[min_size][: b - a]
        size[a : a + len(known)] = known
    return _pack(np.array(out, np.int64), size)


def _codes(stream: bytes, min_size: int):
    """The codes between two clear codes, read in bulk, and whether they go on with the last table.

    Code widths depend only on how many codes were read since the last clear, so all codes up to a
    full table are cut out of the bits at once; the first clear or end code among them ends the table.
    """
    clear = 1 << min_size
    raw = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    known, n_bits, pos = _WIDTHS[min_size], 8 * len(stream), 0

    def cut(at: np.ndarray, w: np.ndarray | int) -> np.ndarray:
        i = at >> 3
        return ((raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16) >> (at & 7)) & ((1 << w) - 1)

    while True:
        w = known[: (n_bits - pos) // (min_size + 1)]
        ends = pos + np.cumsum(w)
        n = int(np.searchsorted(ends, n_bits, "right"))
        if n <= 0:
            return
        w, ends = w[:n], ends[:n]
        codes = cut(ends - w, w)
        stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
        end = int(stop[0]) if len(stop) else n
        yield codes[:end], False
        if len(stop):
            if codes[end] == clear + 1:
                return
            pos = int(ends[end])
            continue
        pos = int(ends[-1])
        m = (n_bits - pos) // 12
        if m <= 0 or n < len(known):
            return
        more = cut(pos + 12 * np.arange(m), 12)  # a full table that goes on: 12-bit codes until a clear
        stop = np.flatnonzero((more == clear) | (more == clear + 1))
        end = int(stop[0]) if len(stop) else m
        yield more[:end], True
        if not len(stop) or more[end] == clear + 1:
            return
        pos += 12 * (end + 1)


def _expand(codes: np.ndarray, clear: int, limit: int) -> tuple[np.ndarray, bool]:
    """The indices that one table's codes stand for, and whether all codes were valid. Codes behind the
    first ``limit`` indices, known from the codes' lengths, are not expanded.

    The n-th entry of a table is what the n-th code wrote and the byte after it, so a code above the
    clear code repeats an earlier stretch of the output. Lengths, then the output itself, follow by
    going from stretch to stretch back to literals, twice as far each round, for all codes at once.
    """
    i = np.arange(len(codes))
    back = codes - (clear + 2)
    literal = codes < clear
    bad = np.flatnonzero(~literal & ((back < 0) | (back >= i) | (back >= MAX_CODES - clear - 2)))
    if len(bad):
        codes, back, literal, i = (x[: bad[0]] for x in (codes, back, literal, i))
    jump, steps = np.where(literal, i, back), (~literal).astype(np.int64)
    while not literal[jump].all():
        jump, steps = jump[jump], steps + steps[jump]
    ends = np.cumsum(steps + 1)
    if len(ends) and ends[-1] > limit:
        n = int(np.searchsorted(ends, limit)) + 1
        codes, back, literal, i, steps, ends = (x[:n] for x in (codes, back, literal, i, steps, ends))
    kind = np.int64 if limit <= 1 << 22 else np.int32  # half the memory, but slower
    start = (ends - steps - 1).astype(kind, copy=False)
    owner = np.repeat(i.astype(kind, copy=False), steps + 1)
    source = np.arange(len(owner), dtype=kind)
    far = ~literal[owner]
    source[far] += (start[np.where(literal, i, back)] - start)[owner[far]]
    while True:
        further = source[source]
        if (further == source).all():
            return codes[owner[source]].astype(np.uint8), not len(bad)
        source = further


def lzw_decode(stream: bytes, min_size: int, limit: int) -> bytes:
    """Palette indices of a code stream, at most ``limit`` of them; a code that has no entry yet ends it."""
    out: list[np.ndarray] = []
    table: list[np.ndarray] = []
    ok, left = True, limit
    for codes, goes_on in chain(_codes(stream, min_size), [(None, False)]):
        if not goes_on and table and ok:
            indices, ok = _expand(np.concatenate(table), 1 << min_size, left)
            out.append(indices[:left])
            left -= len(out[-1])
            if not left:
                break
        if codes is not None:
            table = [*table, codes] if goes_on else [codes]
    return b"".join(x.tobytes() for x in out)


def _blocks(data: bytes) -> bytes:
    parts = [bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)]
    return b"".join(parts) + b"\x00"


def write_gif(payload: bytes, width: int = WIDTH, rows: int = ROWS_PER_FRAME, delay: int = DELAY_CS) -> bytes:
    """A GIF whose frames' palette indices are the payload (a positive multiple of width), row by row."""
    height = min(rows, len(payload) // width)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), PALETTE.tobytes()]
    for i in range(0, len(payload), width * rows):
        part = payload[i : i + width * rows]
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, delay, 0, 0))
        out.append(struct.pack("<BHHHHB", 0x2C, 0, 0, width, len(part) // width, 0) + b"\x08" + _blocks(lzw_encode(part)))
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    delay_cs: int
    disposal: int
    transparent: int | None
    indices: bytes
    start_cs: int = 0
    histogram: dict[int, int] = field(default_factory=dict)


def colour_histogram(canvas: np.ndarray, drawn: np.ndarray) -> dict[int, int]:
    """Drawn pixels by colour cell: 2 bits of each channel, 64 cells."""
    c = canvas[drawn] >> 6
    counts = np.bincount(c[:, 0] * 16 + c[:, 1] * 4 + c[:, 2], minlength=64)
    return {int(i): int(counts[i]) for i in np.flatnonzero(counts)}


def palette_histogram(pixels: np.ndarray, colours: np.ndarray) -> dict[int, int]:
    """colour_histogram of pixels that are palette indices."""
    n = np.bincount(np.minimum(pixels.ravel(), len(colours) - 1), minlength=len(colours))
    c = colours >> 6
    counts = np.bincount(c[:, 0].astype(np.int64) * 16 + c[:, 1] * 4 + c[:, 2], n, 64)
    return {int(i): int(counts[i]) for i in np.flatnonzero(counts)}


class _Broken(Exception):
    """What follows in the file can't be read."""


def _take(data: bytes, pos: int, n: int) -> tuple[bytes, int]:
    if pos + n > len(data):
        raise _Broken
    return data[pos : pos + n], pos + n


def _palette(data: bytes, pos: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, pos
    raw, pos = _take(data, pos, 3 * (2 << (flags & 7)))
    return np.frombuffer(raw, np.uint8).reshape(-1, 3), pos


def _sub_blocks(data: bytes, pos: int) -> tuple[bytes, int]:
    parts = []
    while True:
        size, pos = _take(data, pos, 1)
        if not size[0]:
            return b"".join(parts), pos
        part, pos = _take(data, pos, size[0])
        parts.append(part)


class _Canvas:
    """What is to be seen, as far as frames have reached yet; the rest of the screen is empty."""

    def __init__(self, width: int, height: int):
        self.limit = (height, width)
        self.pixels, self.drawn = np.zeros((0, 0, 3), np.uint8), np.zeros((0, 0), bool)

    def reach(self, bottom: int, right: int) -> None:
        h, w = max(self.drawn.shape[0], min(bottom, self.limit[0])), max(self.drawn.shape[1], min(right, self.limit[1]))
        if h * w > MAX_PIXELS:
            raise _Broken
        more = ((0, h - self.drawn.shape[0]), (0, w - self.drawn.shape[1]))
        if any(b for _, b in more):
            self.pixels, self.drawn = np.pad(self.pixels, (*more, (0, 0))), np.pad(self.drawn, more)


def read_gif(data: bytes) -> list[Frame]:
    """The frames of a GIF in order, each with start time and the histogram of the composed canvas.

    What is not a GIF has no frames. A file that breaks off, or holds what no GIF can, yields the frames
    that are whole before that; nothing in it raises. A frame or canvas above MAX_PIXELS counts as such.
    """
    frames: list[Frame] = []
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        return frames
    width, height, flags, _, _ = struct.unpack("<HHBBB", data[6:13])
    delay, disposal, transparent, clock = 0, 0, None, 0
    try:
        palette, pos = _palette(data, 13, flags)
        canvas = _Canvas(width, height)
        while True:
            kind, pos = _take(data, pos, 1)
            if kind == b"\x21":
                label, pos = _take(data, pos, 1)
                body, pos = _sub_blocks(data, pos)
                if label == b"\xf9" and len(body) >= 4:
                    bits, delay, index = struct.unpack("<BHB", body[:4])
                    disposal, transparent = bits >> 2 & 7, index if bits & 1 else None
                continue
            if kind != b"\x2c":
                break
            head, pos = _take(data, pos, 9)
            left, top, w, h, bits = struct.unpack("<HHHHB", head)
            local, pos = _palette(data, pos, bits)
            colours = palette if local is None else local
            size, pos = _take(data, pos, 1)
            stream, pos = _sub_blocks(data, pos)
            if not 1 <= size[0] <= 8 or w * h > MAX_PIXELS:
                raise _Broken
            got = lzw_decode(stream, size[0], w * h)
            if len(got) < w * h:
                raise _Broken
            pixels = np.frombuffer(got, np.uint8).reshape(h, w)
            if bits & 0x40:
                order = [r for s, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for r in range(s, h, step)]
                rows = np.empty_like(pixels)
                rows[order] = pixels
                pixels = rows
            f = Frame(left, top, w, h, delay, disposal, transparent, pixels.tobytes(), clock)
            canvas.reach(top + h, left + w)
            before = (canvas.pixels.copy(), canvas.drawn.copy()) if disposal == 3 else None
            box = (slice(top, min(top + h, height)), slice(left, min(left + w, width)))
            seen = pixels[: max(0, height - top), : max(0, width - left)]
            known = colours if colours is not None else np.zeros((1, 3), np.uint8)
            if transparent is None:
                canvas.pixels[box] = known[np.minimum(seen, len(known) - 1)]
                canvas.drawn[box] = True
            else:
                show = seen != transparent
                canvas.pixels[box][show] = known[np.minimum(seen[show], len(known) - 1)]
                canvas.drawn[box] |= show
            if transparent is None and seen.shape == canvas.drawn.shape and (left, top) == (0, 0):
                f.histogram = palette_histogram(seen, known)  # the frame is all there is to see
            else:
                f.histogram = colour_histogram(canvas.pixels, canvas.drawn)
            frames.append(f)
            clock += delay
            if disposal == 2:
                canvas.drawn[box] = False
                canvas.pixels[box] = 0
            elif before is not None:
                canvas.pixels, canvas.drawn = before
            delay, disposal, transparent = 0, 0, None
    except _Broken:
        pass
    return frames


def payload_of(text: str | None, unit: int = WIDTH) -> bytes:
    """UTF-8 of a text, filled with bytes 32 up to a positive multiple of the unit."""
    raw = encode(text)
    return raw + b" " * (-len(raw) % unit or (0 if raw else unit))


def _encode(batches):
    for batch in batches:
        n, media = [], []
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            texts = [t.as_py() for t in part.column(1)]
            n = [len(encode(t)) for t in texts]
            media = [write_gif(payload_of(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


def text_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every whole text as an animated GIF.

    Null and empty texts give one row of spaces; repeated rows are each stored; an empty table gives
    an empty result; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encode, "doc_id long, n_bytes long, media binary")


FRAMES = "array<struct<start_cs: int, delay_cs: int, left: int, top: int, width: int, height: int, disposal: int, transparent: int, pixels: binary, histogram: map<int, long>>>"
_FRAME_TYPE = pa.list_(pa.struct([*((n, pa.int32()) for n in ("start_cs", "delay_cs", "left", "top", "width", "height", "disposal", "transparent")), ("pixels", pa.binary()), ("histogram", pa.map_(pa.int32(), pa.int64()))]))


def _decode(batches):
    names = ("start_cs", "delay_cs", "left", "top", "width", "height", "disposal", "transparent")
    for batch in batches:
        at = batch.schema.get_field_index("media")
        out = []
        for m in batch.column(at):
            found = read_gif(m.as_py() or b"")
            out.append([{**{n: getattr(f, n) for n in names}, "pixels": f.indices, "histogram": list(f.histogram.items())} for f in found])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, _FRAME_TYPE)], [*batch.schema.names, "frames"])


def decode_frames(media: DataFrame) -> DataFrame:
    """media(media, ...) with the column frames: timed frames, their pixels and colour histograms.

    Null media or what is no GIF have no frames. A column named frames is replaced.
    """
    media = media.drop("frames")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema)
    return media.mapInArrow(_decode, f"{schema}, frames {FRAMES}")


_DIGESTS = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "n_frames": pa.int64()}


def _digest_of(media: bytes | None) -> tuple:
    if media is None:
        return (None,) * len(_DIGESTS)
    frames = read_gif(media)
    payload, total = b"".join(f.indices for f in frames), np.zeros(64, np.int64)
    for f in frames:
        total[list(f.histogram)] += list(f.histogram.values())
    feature = ",".join(f"{i}:{total[i]}" for i in np.flatnonzero(total))
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(frames)


def _digest(batches):
    for batch in batches:
        doc_id, n_bytes, media = (batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "n_bytes", "media"))
        rows = [_digest_of(m.as_py()) for m in media]
        found = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_DIGESTS.values())]
        yield pa.RecordBatch.from_arrays([doc_id, n_bytes, *found], ["doc_id", "n_bytes", *_DIGESTS])


def digests(media: DataFrame) -> DataFrame:
    """Digests and the colour-histogram feature of text_media rows, from the decoded media.

    Null media have null digests, and what is no GIF those of no frames; ids and sizes may be null or
    repeat; an empty table gives an empty table; other columns are not read.
    """
    return media.select("doc_id", "n_bytes", "media").mapInArrow(
        _digest,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long",
    )
