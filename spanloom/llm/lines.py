"""Lines that many documents share, dropped in all but one of them.

A line's key is the line without white space at both ends, A-Z in lower case. Keys of at least
``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines except in the
largest doc_id that holds them.

Two Bloom filters tell repeats from the rest before any line moves: one of the hashes seen once, one
of those seen twice. Each task fills a pair of its own and sends the bits that are set; merged, a bit
seen in two tasks counts as seen twice. The filters lie in blocks, so each is merged in a task of its
own, and they grow with the documents. The filter of twice-seen hashes goes to all tasks, folded to at
most 2**FILTER_BITS bits; if it is too full then, the lines meet its bits in a join instead. Only lines
whose bits are all there ("suspects") are shuffled, as 128-bit digests of their keys with the doc_id;
equal digests count as equal keys. Which keys are dropped goes to all tasks if there are at most
BROADCAST_KEYS, else documents get their own keys by a join.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import materialize, release
from .text import SpanHasher, chunks, mix64

MIN_CHARS, MIN_DOCS = 40, 5
#: Bits of a filter for each line that the documents can hold at most, bits of a block, most bits sent to all tasks.
BITS_PER_LINE, BLOCK_BITS, FILTER_BITS = 16, 20, 27
#: The share of set bits above which the folded filter would let too much through.
FULL = 0.25
BROADCAST_KEYS = 1 << 20
_CHUNK, _HELD = 1 << 20, 1 << 20
_HASHER = SpanHasher(seed=11)
_LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


class Lines:
    """The lines of some texts that lie one behind the other: ``starts`` and ``ends`` (without \\n),
    ``text`` (of each), and for the keys of enough characters (``long``, positions of lines) where they
    lie and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, min_chars: int):
        breaks = np.flatnonzero(data == 10)
        self.starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
        self.ends = np.sort(np.concatenate([breaks, offsets[1:]]))
        n = np.diff(np.searchsorted(breaks, offsets)) + 1
        self.text = np.repeat(np.arange(len(offsets) - 1), n)
        self.low = data.tobytes().translate(_LOW)
        inside = np.append(np.flatnonzero(~_SPACE[data]), len(data))
        first = inside[np.searchsorted(inside[:-1], self.starts)]
        last = inside[np.maximum(np.searchsorted(inside[:-1], self.ends) - 1, 0)] + 1
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        found = first < self.ends
        size = np.where(found, chars[np.minimum(last, len(data))] - chars[first], 0)
        self.long = np.flatnonzero(found & (size >= max(1, min_chars)))
        self.first, self.last = first[self.long], last[self.long]
        sums = _HASHER.prefix(np.frombuffer(self.low, np.uint8))
        self.hashes = mix64(_HASHER.spans(sums, self.first, self.last) + (self.last - self.first).astype(np.uint64))

    def digest(self, i: int) -> bytes:
        """128 bits of the i-th long key."""
        return hashlib.blake2b(self.low[self.first[i] : self.last[i]], digest_size=16).digest()


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in a filter of 2**bits bits; both are in the same block."""
    block = (hashes >> np.uint64(64 - bits + min(bits, BLOCK_BITS))) if bits > BLOCK_BITS else np.zeros_like(hashes)
    inside = np.uint64((1 << min(bits, BLOCK_BITS)) - 1)
    base = block << np.uint64(BLOCK_BITS)
    return base | hashes & inside, base | (hashes >> np.uint64(20)) & inside


def _parts(min_chars: int, bits: int):
    """Rows (block, once, twice) of the filters of what a task has read: set bits as 32-bit numbers."""

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        bit, n = np.unique(np.concatenate(held), return_counts=True)
        block = (bit >> np.uint64(BLOCK_BITS)).astype(np.int64)
        edge = np.flatnonzero(np.diff(block, prepend=-1))
        inside = (bit & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint32)
        once = [x.tobytes() for x in np.split(inside, edge[1:])]
        twice = [x[k > 1].tobytes() for x, k in zip(np.split(inside, edge[1:]), np.split(n, edge[1:]), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(block[edge]), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["block", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, data, offsets in chunks(batch.column(0), _CHUNK):
                lines = Lines(data, offsets, min_chars)
                # a line counts once in a text, however often it is there
                order = np.lexsort((lines.hashes, lines.text[lines.long]))
                h, t = lines.hashes[order], lines.text[lines.long][order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
                a, b = _places(h[new], bits)
                held += [a, b[a != b]]
                n += len(a)
                if n >= _HELD:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    return run


def _merged(df: pd.DataFrame) -> pd.DataFrame:
    """The set bits of a block's twice-seen filter."""
    seen, twice = np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)
    for once, more in zip(df["once"], df["twice"], strict=True):
        here = np.frombuffer(once, np.uint32)
        twice[here[seen[here]]] = True
        seen[here] = True
        twice[np.frombuffer(more, np.uint32)] = True
    return pd.DataFrame({"block": df["block"].iloc[:1], "bits": [np.flatnonzero(twice).astype(np.uint32).tobytes()]})


def twice_seen(docs: DataFrame, min_chars: int = MIN_CHARS) -> tuple[DataFrame, int]:
    """The filter of keys that may stand in two rows of docs(text): a written table (block, bits), and
    the logarithm of its size. It misses none."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = max(BLOCK_BITS, math.ceil(math.log2(BITS_PER_LINE * (size // (min_chars + 1) + 1))))
    parts = docs.select("text").mapInArrow(_parts(min_chars, bits), "block long, once binary, twice binary")
    return materialize(parts.groupBy("block").applyInPandas(_merged, "block long, bits binary"), "twice"), bits


class _Folded:
    """A filter folded to at most 2**FILTER_BITS bits: a bit is set if any that falls on it is."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 1 << min(bits, FILTER_BITS)
        self.data = np.zeros(self.size // 8, np.uint8)

    def _at(self, bit: np.ndarray) -> np.ndarray:
        return bit & np.uint64(self.size - 1)

    def add(self, block: int, offsets: bytes) -> None:
        bit = self._at((np.frombuffer(offsets, np.uint32).astype(np.uint64)) | np.uint64(block << BLOCK_BITS))
        np.bitwise_or.at(self.data, (bit >> np.uint64(3)).astype(np.int64), (1 << (bit & np.uint64(7))).astype(np.uint8))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be in."""
        at = np.arange(len(hashes))
        for bit in map(self._at, _places(hashes, self.bits)):
            at = at[self.data[(bit[at] >> np.uint64(3)).astype(np.int64)] >> (bit[at] & np.uint64(7)).astype(np.uint8) & 1 == 1]
        return at


def _suspects(min_chars: int, bits: int, maybe=None):
    """Rows (doc_id, digest, h, place) of the long keys of each text, once a text; with ``maybe`` only of
    those that it lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1), _CHUNK):
                lines = Lines(data, offsets, min_chars)
                at = np.arange(len(lines.long)) if maybe is None else maybe.value(lines.hashes)
                text = lines.text[lines.long]
                rows = {(int(text[i]), lines.digest(i)): i for i in at.tolist()}
                i = np.fromiter(rows.values(), np.int64, len(rows))
                ids = batch.column(0).take(pa.array(first + text[i]))
                place = _places(lines.hashes[i], bits)[0]
                yield pa.RecordBatch.from_arrays([ids, pa.array([d for _, d in rows], pa.binary()), pa.array(lines.hashes[i].view(np.int64)), pa.array(place.view(np.int64))], ["doc_id", "digest", "h", "place"])

    return run


_FOUND = "doc_id long, digest binary, h long, place long"


def repeated_keys(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(digest, h, keeper): the keys that at least ``min_docs`` documents of docs(doc_id, text) hold, and
    the largest doc_id that holds each; a written table. Rows without an id are one document."""
    twice, bits = twice_seen(docs, min_chars)
    n = twice.agg(F.sum(F.octet_length("bits") / 4).alias("n")).first()["n"] or 0
    if n <= FULL * (1 << min(bits, FILTER_BITS)):
        folded = _Folded(bits)
        for row in twice.toLocalIterator():
            folded.add(row["block"], row["bits"])
        found = docs.select("doc_id", "text").mapInArrow(_suspects(min_chars, bits, docs.sparkSession.sparkContext.broadcast(folded)), _FOUND)
    else:  # (a line's first bit decides here; more would be moved for the second)
        places = twice.mapInArrow(_set_bits, "place long")
        found = docs.select("doc_id", "text").mapInArrow(_suspects(min_chars, bits), _FOUND).join(places, "place", "left_semi")
    held = found.select("digest", "h", "doc_id").distinct()
    # (a key in very many documents is summed on both sides of the exchange)
    keys = held.groupBy("digest", "h").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs)
    out = materialize(keys.select("digest", "h", "keeper"), "keys")
    release(twice)
    return out


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(bits, np.uint32).astype(np.int64) | block << BLOCK_BITS)], ["place"])


class _Keys:
    """Keys to drop by hash: who keeps the key of a hash and digest, or None."""

    def __init__(self, table: pa.Table):
        order = np.argsort(h := table.column("h").to_numpy().view(np.uint64), kind="stable")
        self.h, self.keeper = h[order], table.column("keeper").to_numpy()[order]
        self.digest = np.frombuffer(b"".join(table.column("digest").to_pylist()), "V16")[order]

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.h, hashes)
        at[at == len(self.h)] = 0
        return np.flatnonzero(self.h[at] == hashes) if len(self.h) else at[:0]

    def keeper_of(self, h: np.uint64, digest: bytes) -> int | None:
        for i in range(int(np.searchsorted(self.h, h)), int(np.searchsorted(self.h, h, "right"))):
            if self.digest[i].tobytes() == digest:
                return int(self.keeper[i])
        return None


def _dropped(min_chars: int, keys=None):
    """Rows (doc_id, text, ..., and with no ``keys`` __digests) with kept_text, n_lines, n_dropped behind
    them. A line goes if ``keys`` says that another document keeps its key, or if its digest is
    among the row's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            own = None if keys is not None else columns.pop("__digests").to_pylist()
            ids, texts = columns["doc_id"].to_pylist(), columns["text"]
            kept, n_lines, n_dropped = [], [], []
            for first, data, offsets in chunks(texts, _CHUNK):
                lines = Lines(data, offsets, min_chars)
                n = np.bincount(lines.text, minlength=len(offsets) - 1)
                gone: dict[int, set[int]] = {}
                for i in keys.value.candidates(lines.hashes) if keys is not None else range(len(lines.long)):
                    line = int(lines.long[i])
                    t = int(lines.text[line])
                    if keys is not None:
                        keeper = keys.value.keeper_of(lines.hashes[i], lines.digest(i))
                        drop = keeper is not None and keeper != ids[first + t]
                    else:
                        drop = bool(own[first + t]) and lines.digest(i) in own[first + t]
                    if drop:
                        gone.setdefault(t, set()).add(line)
                begin = np.concatenate([[0], np.cumsum(n)])
                raw = data.tobytes()
                for t in range(len(n)):
                    cut = gone.get(t, ())
                    text = raw[offsets[t] : offsets[t + 1]]
                    if cut:
                        text = b"\n".join(raw[lines.starts[k] : lines.ends[k]] for k in range(begin[t], begin[t + 1]) if k not in cut)
                    kept.append(text)
                    n_dropped.append(len(cut))
                n_lines += n.tolist()
            text = pa.array(kept, pa.binary()).cast(pa.string())
            text = pc.if_else(texts.is_null(), pa.scalar(None, pa.string()), text) if texts.null_count else text
            yield pa.RecordBatch.from_arrays([*columns.values(), text, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*columns, "kept_text", "n_lines", "n_dropped"])

    return run


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """docs(doc_id, text, ...) with kept_text (the text without the dropped lines), n_lines and n_dropped.

    A null text stays null and has one line, as the empty text. Rows that share a doc_id are one
    document, and so are all rows without one, which keeps nothing; each row is reported. A line that
    stands twice in the document that keeps it stays twice. An empty table gives an empty table;
    columns with the names of added ones are replaced, all others kept.
    """
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keys = repeated_keys(rows, min_chars, min_docs)
    schema = T.StructType([*docs.schema, T.StructField("kept_text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    if keys.count() <= broadcast_keys:
        return docs.mapInArrow(_dropped(min_chars, docs.sparkSession.sparkContext.broadcast(_Keys(keys.toArrow()))), schema)
    # the digests that a document loses, by its id and text: at most its own lines
    name = F.sha2("text", 256)
    lost = rows.select("doc_id", "text", name.alias("of")).mapInArrow(_all_keys(min_chars), "doc_id long, of string, digest binary").join(keys, "digest")
    mine = lost.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).groupBy(F.col("doc_id").alias("__lost_id"), F.col("of").alias("__lost_of")).agg(F.collect_set("digest").alias("__digests"))
    joined = docs.join(mine, F.col("doc_id").cast("long").eqNullSafe(F.col("__lost_id")) & (name == F.col("__lost_of")), "left").drop("__lost_id", "__lost_of")
    return joined.mapInArrow(_dropped(min_chars), schema)


def _all_keys(min_chars: int):
    """Rows (doc_id, of, digest) of the long keys of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1), _CHUNK):
                lines = Lines(data, offsets, min_chars)
                rows = pa.array(first + lines.text[lines.long])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(2).take(rows), pa.array([lines.digest(i) for i in range(len(rows))], pa.binary())], ["doc_id", "of", "digest"])

    return run
