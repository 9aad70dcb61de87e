"""Removal of long repeated byte strings by prefix-free parsing.

Parsing. Wherever the Karp-Rabin hash of the last TRIGGER bytes is 0, a phrase ends; the next one starts
with those same TRIGGER bytes, so no phrase of the dictionary is a prefix of another and equal
strings are cut alike wherever they stand. A phrase goes by the 128-bit digest of its bytes.

A window is a string of ``length`` bytes. If it holds a whole phrase that occurs once in the corpus,
it occurs once: all such windows are settled by the dictionary's counts. What remains are windows in
repetitive text (and in long stretches without a trigger). Each lies in a cover, the run of phrases
from the last cut before it to the first one after it. Covers are ordered by the 128-bit digests of
their phrases' digests; where one occurs twice, all its windows are repeated, and one of its places
is enough to stand for them. The windows still open then are brought into one corpus-wide order, in
which equal windows are neighbours. That order is of 64-bit rolling hashes and only names suspects:
a window is removed if the digest of its own 400 bytes (128 bits again) has an equal elsewhere.

The orders are those of digests rather than the lexicographic ones that suffix arrays of dictionary
and parse would give: only which strings are equal is asked for, and digests can be cut into ranges
of equal size whatever the text, while a range of a suffix array is as large as its commonest prefix.

All orders are made alike. Distinct texts are packed into units of about UNIT_BYTES, which are
written. A unit sends each of its distinct values once, cut by value range; a range sees at most one
copy per unit and answers with one bit per value. So a phrase or passage that a third of all texts
share costs one value per unit, and no task holds more than a unit or a range. (A unit is counted in
bytes of text; text that repeats a few bytes at which a trigger falls has a phrase for each repeat.)
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize, release
from .text import SpanHasher, encode, mix64

#: The hash of TRIGGER bytes is the number that their values are to base 256, modulo a prime; a phrase is
#: about as many bytes long. A byte's value is 1 + byte * SPREAD % (MODULUS - 1), never 0, so a run of one
#: byte, whichever it is, triggers nowhere.
LENGTH, TRIGGER, MODULUS, SPREAD = 400, 16, 61, 37
_VALUES = (1 + np.arange(256) * SPREAD % (MODULUS - 1)).astype(np.int32)
_PLACES = [pow(256, TRIGGER - 1 - i, MODULUS) for i in range(TRIGGER)]
DIGEST = 16
UNIT_BYTES, LEAST_RANGES = 3 << 20, 32
_HASHER = SpanHasher(seed=23)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _digests(strings) -> bytes:
    return b"".join([hashlib.blake2b(x, digest_size=DIGEST).digest() for x in strings])


def parse(raw: bytes) -> tuple[np.ndarray, bytes]:
    """Cuts of a text (where triggers end), and digests of its pieces: what stands before the first cut,
    the phrases between each two cuts, and what stands after the last."""
    cuts = np.zeros(0, np.int64)
    if len(raw) >= TRIGGER:
        data, n = _VALUES[np.frombuffer(raw, np.uint8)], len(raw) - TRIGGER + 1
        rolled = np.zeros(n, np.int32)
        for i, place in enumerate(_PLACES):
            rolled += place * data[i : i + n]
        cuts = np.flatnonzero(rolled % MODULUS == 0) + TRIGGER
    starts = np.concatenate(([0], cuts - TRIGGER))
    if len(cuts):
        starts[-1] += TRIGGER
    return cuts, _digests(map(raw.__getitem__, map(slice, starts.tolist(), [*cuts.tolist(), len(raw)])))


#: Texts whose digests are sent on together.
_TEXTS = 500


def _parsed(batches):
    for batch in (b.slice(i, _TEXTS) for b in batches for i in range(0, b.num_rows, _TEXTS)):
        n, sha, cuts, pieces = [], [], [], []
        for text in batch.column(2):
            raw = encode(text.as_py())
            n.append(len(raw))
            sha.append(hashlib.sha256(raw).hexdigest())
            c, p = parse(raw)
            cuts.append(c.astype(np.int32).tobytes())
            pieces.append(p)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(cuts, pa.binary()), pa.array(pieces, pa.binary())],
            ["doc_id", "key", "n_bytes", "sha", "cuts", "pieces"],
        )


_SENT = "range long, unit binary, vals binary, multi binary"
_ANSWER = "range long, unit binary, bits binary, lead binary"


def _pack(limit: int):
    """Rows (key, n_bytes, ...) as units: one row of lists for about ``limit`` bytes, named by its first key."""

    def unit(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        ends = pa.array([0, table.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, c.chunk(0)) for c in table.columns]
        return pa.RecordBatch.from_arrays([table.column("key").chunk(0).slice(0, 1), *lists], ["unit", *table.column_names])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            start = 0
            for i, n in enumerate(batch.column(batch.schema.get_field_index("n_bytes")).to_pylist()):
                size += n
                if size >= limit:
                    held.append(batch.slice(start, i + 1 - start))
                    yield unit(held)
                    held, size, start = [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield unit(held)

    return run


def _packed(rows: DataFrame, limit: int, name: str) -> DataFrame:
    schema = ", ".join(f"{f.name} array<{f.dataType.simpleString()}>" for f in rows.schema)
    return materialize(rows.mapInArrow(_pack(limit), f"unit binary, {schema}"), name)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts values (rows of one or two 64-bit numbers), where each distinct one starts
    in it, and how often each occurs."""
    order = np.lexsort(values.T[::-1])
    if not len(order):
        return order, order, order
    far = values[order]
    first = np.concatenate(([0], np.flatnonzero((far[1:] != far[:-1]).any(axis=1)) + 1))
    return order, first, np.diff(np.concatenate((first, [len(order)])))


def _edges(distinct: np.ndarray, ranges: int) -> np.ndarray:
    """Where each value range starts in sorted values: the top 32 bits scaled to the number of ranges."""
    at = ((distinct[:, 0] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    return np.searchsorted(at, np.arange(ranges + 1))


def _sender(values, columns: tuple[str, ...], ranges: int):
    """Sends the distinct values of each unit, cut by value range, with whether the unit has them twice."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                unit = batch.column(batch.schema.get_field_index("unit"))[i].as_py()
                lists = [batch.column(batch.schema.get_field_index(c))[i].as_py() for c in columns]
                every = values(*lists)
                order, first, counts = _distinct(every)
                distinct = every[order[first]]
                edges = _edges(distinct, ranges)
                rows = [(r, distinct[a:b].tobytes(), np.packbits(counts[a:b] > 1).tobytes()) for r, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]
                r, vals, multi = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r, pa.int64()), pa.array([unit] * len(r), pa.binary()), pa.array(vals, pa.binary()), pa.array(multi, pa.binary())], ["range", "unit", "vals", "multi"]
                )

    return run


def _answer(width: int):
    def run(df: pd.DataFrame) -> pd.DataFrame:
        """For every unit's values in a range one bit each, set where the value occurs twice in all, and
        one that names the unit whose value stands for the others."""
        vals = [_numbers(v, width) for v in df["vals"]]
        multi = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(v)) for m, v in zip(df["multi"], vals, strict=True)]
        order, first, size = _distinct(np.concatenate(vals))
        held = np.logical_or.reduceat(np.concatenate(multi).astype(bool)[order], first) | (size > 1)
        twice, lead = np.empty(len(order), bool), np.zeros(len(order), bool)
        twice[order], lead[order[first]] = np.repeat(held, size), True
        ends = np.cumsum([len(v) for v in vals])
        cut = lambda flags: [np.packbits(flags[e - len(v) : e]).tobytes() for e, v in zip(ends, vals, strict=True)]
        return pd.DataFrame({"range": df["range"], "unit": df["unit"], "bits": cut(twice), "lead": cut(lead)})

    return run


def _flags(values: np.ndarray, answers: pd.DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """For each value of a unit: whether it occurs twice, and whether it is the one that stands for all."""
    order, first, counts = _distinct(values)
    edges = _edges(values[order[first]], ranges)
    flag, leads = np.zeros(len(first), bool), np.zeros(len(first), bool)
    for r, bits, one in zip(answers["range"], answers["bits"], answers["lead"], strict=True):
        a, b = edges[r], edges[r + 1]
        flag[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(b - a))
        leads[a:b] = np.unpackbits(np.frombuffer(one, np.uint8), count=int(b - a))
    twice, lead = np.zeros(len(values), bool), np.zeros(len(values), bool)
    twice[order] = np.repeat(flag, counts)
    lead[order[first[leads]]] = True
    return twice, lead


def _numbers(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint64).reshape(-1, width)


def _joined(blobs: list[bytes]) -> np.ndarray:
    return _numbers(b"".join(blobs), 2)


def _all_phrases(pieces: list[bytes]) -> np.ndarray:
    """The first half of each whole phrase's digest: it tells enough, as phrases are only counted by it."""
    return _joined([p[DIGEST:-DIGEST] for p in pieces])[:, :1]


def open_windows(n: int, cuts: np.ndarray, repeated: np.ndarray, length: int) -> np.ndarray:
    """Starts (first, end) of the windows of a text that hold no phrase which occurs once."""
    starts = n - length + 1
    once = ~repeated
    first, end = cuts[1:][once] - length, cuts[:-1][once] - TRIGGER + 1  # windows that hold the phrase
    good = first < end
    first, end = np.maximum(first[good], 0), np.minimum(end[good], starts)
    good = first < end
    step = np.zeros(starts + 1, np.int32)
    np.add.at(step, first[good], 1)
    np.add.at(step, end[good], -1)
    free = np.concatenate(([False], np.cumsum(step[:-1]) == 0, [False]))
    turns = np.flatnonzero(free[1:] != free[:-1])
    return turns.reshape(-1, 2)


def covers(n: int, cuts: np.ndarray, pieces: bytes, open_: np.ndarray, length: int) -> tuple[np.ndarray, bytes]:
    """Runs (first, end) of open windows that share a cover, and the covers' digests."""
    bounds = np.concatenate(([0], cuts, [n]))
    # the cover changes where a window starts at a cut, and where its end passes one
    turns = np.unique(np.concatenate((open_.ravel(), cuts, cuts - length + 1)))
    turns = turns[(turns >= 0) & (turns <= n - length + 1)]
    first, end = turns[:-1], turns[1:]
    k = np.searchsorted(open_[:, 0], first, "right") - 1
    inside = (k >= 0) & (first < open_[np.maximum(k, 0), 1])
    first, end = first[inside], end[inside]
    a = np.searchsorted(bounds, first, "right") - 1
    b = np.searchsorted(bounds, first + length, "left")
    # (a piece at either end of a text never equals a phrase, since it would hold a cut)
    return np.stack([first, end], axis=1), _digests(map(pieces.__getitem__, map(slice, (a * DIGEST).tolist(), (b * DIGEST).tolist())))


def longest_shared(cuts: np.ndarray, repeated: np.ndarray) -> int:
    """Bytes of the longest run of whole phrases that each occur elsewhere too."""
    turns = np.flatnonzero(np.diff(np.concatenate(([0], repeated.astype(np.int8), [0])))).reshape(-1, 2)
    return int((cuts[turns[:, 1]] - cuts[turns[:, 0]]).max() + TRIGGER) if len(turns) else 0


def _candidates(ranges: int, length: int):
    def run(units: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for u in units.itertuples():
            twice, at, rows = _flags(_all_phrases(list(u.pieces)), answers, ranges)[0], 0, []
            for key, n, c, pieces in zip(u.key, u.n_bytes, u.cuts, u.pieces, strict=True):
                cuts = np.frombuffer(c, np.int32).astype(np.int64)
                k = max(0, len(pieces) // DIGEST - 2)
                repeated = twice[at : at + k]
                at += k
                open_ = open_windows(int(n), cuts, repeated, length) if n >= length else ()
                shared = longest_shared(cuts, repeated) if k else 0
                shared = shared if 2 * shared >= length else 0
                runs, digests = covers(int(n), cuts, pieces, open_, length) if len(open_) else (np.zeros(0), b"")
                if len(runs) or shared:
                    rows.append((key, shared, runs.tobytes(), digests))
            if rows:
                key, shared, runs, digests = map(list, zip(*rows, strict=True))
                out.append((u.unit, key, shared, runs, digests))
        return pd.DataFrame(out, columns=["unit", "key", "shared", "runs", "covers"])

    return run


#: What is known of a run of windows: nothing yet; repeated, and sent for others; repeated, and not sent.
_OPEN, _STANDS, _FOLLOWS = 0, 1, 2


def _settled(ranges: int):
    def run(units: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for u in units.itertuples():
            (twice, lead), at = _flags(_joined(list(u.covers)), answers, ranges), 0
            for key, shared, runs, digests in zip(u.key, u.shared, u.runs, u.covers, strict=True):
                k = len(digests) // DIGEST
                state = np.where(twice[at : at + k], np.where(lead[at : at + k], _STANDS, _FOLLOWS), _OPEN)
                at += k
                runs = np.frombuffer(runs, np.int64).reshape(-1, 2)
                new = np.flatnonzero(np.concatenate(([k > 0], (runs[1:, 0] != runs[:-1, 1]) | (state[1:] != state[:-1]))))
                last = np.concatenate((new[1:], [k])) - 1 if k else new
                out.append((key, int(shared), np.stack([runs[new, 0], runs[last, 1], state[new]], axis=1).tobytes()))
        return pd.DataFrame(out, columns=["key", "shared", "spans"])

    return run


def _starts(spans: bytes, *states: int) -> np.ndarray:
    runs = np.frombuffer(spans, np.int64).reshape(-1, 3)
    return np.concatenate([np.zeros(0, np.int64), *(np.arange(a, b) for a, b, s in runs if s in states)])


def window_hashes(texts, spans, length: int) -> np.ndarray:
    """64-bit hashes of all windows to be sent of some (compressed) texts, in order; equal windows have
    equal ones, but not the other way round."""
    values, unpack = [np.zeros(0, np.uint64)], zstandard.ZstdDecompressor()
    for text, sp in zip(texts, spans, strict=True):
        at = _starts(sp, _OPEN, _STANDS)
        if len(at):
            values.append(mix64(_HASHER.spans(_HASHER.prefix(np.frombuffer(unpack.decompress(text), np.uint8)), at, at + length)))
    return np.concatenate(values)[:, None]


def _suspects(ranges: int, length: int, hashes):
    """Windows whose hash occurs twice, with the digests of their bytes."""

    def run(units: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out, unpack = [], zstandard.ZstdDecompressor()
        for u in units.itertuples():
            twice, at, rows = _flags(hashes(u.text, u.spans), answers, ranges)[0], 0, []
            for key, text, spans in zip(u.key, u.text, u.spans, strict=True):
                sent = _starts(spans, _OPEN, _STANDS)
                hit = sent[twice[at : at + len(sent)]]
                at += len(sent)
                if len(hit):
                    raw = unpack.decompress(text)
                    rows.append((key, hit.tobytes(), _digests(map(raw.__getitem__, map(slice, hit.tolist(), (hit + length).tolist())))))
            if rows:
                out.append((u.unit, *map(list, zip(*rows, strict=True))))
        return pd.DataFrame(out, columns=["unit", "key", "starts", "digests"])

    return run


def _confirmed(ranges: int):
    def run(units: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for u in units.itertuples():
            twice, at, starts = _flags(_joined(list(u.digests)), answers, ranges)[0], 0, []
            for s in u.starts:
                s = np.frombuffer(s, np.int64)
                starts.append(s[twice[at : at + len(s)]].tobytes())
                at += len(s)
            out.append((u.unit, list(u.key), starts))
        return pd.DataFrame(out, columns=["unit", "key", "starts"])

    return run


def _compressed(batches):
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = [encode(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(t) for t in texts], pa.int64()), pa.array([pack.compress(t) for t in texts], pa.binary())],
            ["doc_id", "key", "n_bytes", "text"],
        )


def _cut(length: int):
    def run(units: pd.DataFrame, confirmed: pd.DataFrame) -> pd.DataFrame:
        out, unpack = [], zstandard.ZstdDecompressor()
        found = {k: s for c in confirmed.itertuples() for k, s in zip(c.key, c.starts, strict=True)}
        for u in units.itertuples():
            for key, text, spans in zip(u.key, u.text, u.spans, strict=True):
                hit = np.union1d(np.frombuffer(found.get(key, b""), np.int64), _starts(spans, _STANDS, _FOLLOWS))
                if not len(hit):
                    continue
                raw = unpack.decompress(text)
                breaks = np.flatnonzero(np.diff(hit) > length)
                a = hit[np.concatenate(([0], breaks + 1))]
                b = hit[np.concatenate((breaks, [len(hit) - 1]))] + length
                edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(raw)]
                kept = b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                out.append((key, len(raw) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), edges[1:-1]))
        return pd.DataFrame(out, columns=["key", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, longest_shared, spans of every row of
    docs(doc_id, text, ...).

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere else in
    the texts, the same one included; ``spans`` lists the start and end of each removed run in turn.
    ``longest_shared`` tells of shorter repeats as well, which stay: bytes of the longest run of whole
    phrases that each occur elsewhere too (of a text with copies: all its bytes), 0 below half of
    ``length``.
    ``length`` must be at least TRIGGER. Null texts are empty; shorter texts lose nothing; rows that
    repeat (ids too) each count as a text of their own; an empty table gives an empty result; other
    columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.substring(F.sha2(text, 256), 1, 2 * DIGEST)).alias("key"), F.col("text").cast("string").alias("text"))
    rows = materialize(source.mapInArrow(_parsed, "doc_id long, key binary, n_bytes long, sha string, cuts binary, pieces binary"), "parse")
    size = rows.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(LEAST_RANGES, math.ceil(size / UNIT_BYTES / 2))
    limit = max(1 << 16, min(UNIT_BYTES, size // LEAST_RANGES))
    # one row stands for all copies of a text; copies meet in the partial sums of each task
    cut_at = F.struct("n_bytes", "cuts", "pieces")
    one = materialize(rows.where(F.col("n_bytes") > TRIGGER).groupBy("key").agg(F.count("*").alias("copies"), F.first(cut_at).alias("c")).select("key", "copies", "c.*"), "texts")

    def answers(units: DataFrame, values, columns: tuple[str, ...], width: int, name: str) -> DataFrame:
        sent = units.select("unit", *columns).mapInArrow(_sender(values, columns, ranges), _SENT)
        return materialize(sent.groupBy("range").applyInPandas(_answer(width), _ANSWER), name)

    parsed = _packed(one.select("key", "n_bytes", "cuts", "pieces"), limit, "parsed")
    dictionary = answers(parsed, _all_phrases, ("pieces",), 1, "dictionary")
    found = materialize(
        parsed.groupBy("unit").cogroup(dictionary.groupBy("unit")).applyInPandas(
            _candidates(ranges, length), "unit binary, key array<binary>, shared array<long>, runs array<binary>, covers array<binary>"
        ),
        "candidates",
    )
    release(parsed, dictionary)
    cover_order = answers(found, _joined, ("covers",), 2, "covers")
    settled = materialize(
        found.groupBy("unit").cogroup(cover_order.groupBy("unit")).applyInPandas(_settled(ranges), "key binary, shared long, spans binary"), "settled"
    )
    release(found, cover_order)
    wanted = settled.where(F.length("spans") > 0).select("key", "spans")
    # the one pass that moves texts
    texts = source.mapInArrow(_compressed, "doc_id long, key binary, n_bytes long, text binary").groupBy("key").agg(F.first(F.struct("n_bytes", "text")).alias("t"))
    whole = _packed(texts.join(wanted.hint("merge"), "key").select("key", "t.n_bytes", "spans", "t.text"), limit, "whole")
    hashes = partial(window_hashes, length=length)
    order = answers(whole, hashes, ("text", "spans"), 1, "order")
    suspects = materialize(
        whole.groupBy("unit").cogroup(order.groupBy("unit")).applyInPandas(_suspects(ranges, length, hashes), "unit binary, key array<binary>, starts array<binary>, digests array<binary>"),
        "suspects",
    )
    equal = answers(suspects, _joined, ("digests",), 2, "equal")
    confirmed = materialize(
        suspects.groupBy("unit").cogroup(equal.groupBy("unit")).applyInPandas(_confirmed(ranges), "unit binary, key array<binary>, starts array<binary>"), "confirmed"
    )
    cut = materialize(
        whole.groupBy("unit").cogroup(confirmed.groupBy("unit")).applyInPandas(_cut(length), "key binary, n_removed long, n_spans long, kept_sha256 string, spans array<long>"), "cut"
    )
    release(whole, order, suspects, equal, confirmed)
    known = materialize(one.select("key", "copies").join(settled.select("key", "shared"), "key", "left").join(cut, "key", "left").where("copies > 1 or shared > 0 or n_removed > 0"), "known")
    release(one, settled, cut)
    out = rows.select("doc_id", "key", "n_bytes", "sha").join(known.hint("merge"), "key", "left")
    copied = F.coalesce(F.col("copies") > 1, F.lit(False))
    gone = copied & (F.col("n_bytes") >= length)
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(gone, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copied, F.when(2 * F.col("n_bytes") >= length, F.col("n_bytes")).otherwise(zero)).otherwise(F.coalesce("shared", zero)).alias("longest_shared"),
        F.when(gone, F.array(zero, F.col("n_bytes"))).otherwise(F.coalesce("spans", F.array().cast("array<long>"))).alias("spans"),
    )
