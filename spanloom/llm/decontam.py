"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a mask over consecutive tokens: positions marked 1 must agree, the others may
differ. The masked windows of the benchmark items are hashed into a table of seeds; document windows
with the same hash join it. Such a hit fixes how item and document lie against each other, and both
sides bring the tokens around the seed: the document leaks the item when some window of WINDOW
tokens there (or the whole item, if shorter) agrees in at least AGREE of its tokens. The masks meet
every such window: MASKS those of 12 to 20 tokens, SHORT (by number of tokens) those of shorter
items; tests/llm enumerate all cases.

The documents are read in one pass whatever the benchmark's size. A Bloom filter of the seeds' hashes,
of at most 2**FILTER_BITS bits, keeps windows from the join that meet no seed; where a benchmark is so
large that the filter fills, more windows reach the join, which settles them. Leaks depend on the text
alone, so they are found per distinct text and copies of a text share them.

Hot passages. Items that agree in a seed and its surroundings are one class, which stands for the set of
its items. A seed at over HOT places of the benchmark doesn't meet them one by one: of the windows of
WINDOW tokens over it the one is taken in which the fewest differ, places with the same window are one
class, and a text with just that window leaks all its items, as no agreement is higher. So a passage
that n items and n texts have makes n hits of a class, not n * n. Only texts that have the seed but
not the window are held against the places of the class one by one, unless another seed has
settled the same set (or, where texts are dropped, the text). Sets become lists of items at the very end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize, release
from .text import WORD_BYTES, SpanHasher, chunks, mix64

MASKS = ("1111011", "1101010101", "11001010011", "101100110001", "110001111")
SHORT = {
    1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("111", "11011"), 6: ("111",), 7: ("111",), 8: ("1111",), 9: ("1111",), 10: ("111",), 11: ("111",)
}
WINDOW, AGREE = 20, 0.8
LEAST_BITS, FILTER_BITS = 24, 29
#: Places of the benchmark above which a seed's places are met by classes.
HOT = 32
_STEP = np.uint64(0xD6E8FEB86659FD93)
# All masks; the place in this list tells their hashes apart.
_SEEDS = [*MASKS, *sorted({m for ms in SHORT.values() for m in ms})]
_OFFSETS = [np.flatnonzero([c == "1" for c in m]) for m in _SEEDS]
#: Masks that only items of their own length have: the seed is the whole item, what is around it doesn't matter.
_WHOLE = frozenset(_SEEDS.index(m) for m in ("1", "11"))
SHORTEST = max(map(len, MASKS))
_HASHER = SpanHasher(seed=31)
#: Tokens kept with a hit: WINDOW - 1 before the seed's start, and as many after the longest seed.
_BEFORE, _AROUND = WINDOW - 1, 2 * (WINDOW - 1) + SHORTEST
#: Blocks of the filter, bytes of text looked at together, hits sent together.
_BLOCKS, _CHUNK, _SENT = 4096, 1 << 19, 1 << 14


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit values (never 0) of the words of some texts that lie one behind the other in ``data``, and
    the text of each. Words are lower-cased runs of ASCII letters, digits and bytes above 127."""
    low = np.frombuffer(data.tobytes().translate(WORD_BYTES), np.uint8)
    inside = low != 32
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]  # texts that aren't empty
    starts[edge] = inside[edge]
    ends[edge[1:] - 1] = inside[edge[1:] - 1]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    values = mix64(_HASHER.spans(_HASHER.prefix(low), a, b) + (b - a).astype(np.uint64) * _STEP)
    return np.maximum(values, np.uint64(1)), np.searchsorted(offsets, a, "right") - 1


def seeds_of(values: np.ndarray, text: np.ndarray, tag: int, maybe=None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a mask's windows that lie in one text each, and their hashes; only those that
    ``maybe`` lets through."""
    n = len(values) - int(_OFFSETS[tag][-1])
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    acc = np.full(n, tag + 1, np.uint64)
    for o in _OFFSETS[tag]:
        acc *= _STEP
        acc += values[o : o + n]
    acc = mix64(acc)
    at = np.arange(n) if maybe is None else maybe(acc)
    at = at[text[at] == text[at + int(_OFFSETS[tag][-1])]]
    return at, acc[at]


def around(values: np.ndarray, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The tokens around some positions, one row each; 0 where the text has none."""
    where = at[:, None] + np.arange(-_BEFORE, _AROUND - _BEFORE)
    held = np.clip(where, 0, len(values) - 1)
    return np.where((where == held) & (text[held] == text[at][:, None]), values[held], np.uint64(0))


def agreement(doc: np.ndarray, item: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each pair of surroundings: the most tokens in which a window agrees that lies in both texts,
    or 0 where no window agrees enough; ``size`` is the item's number of tokens."""
    both = (doc != 0) & (item != 0)
    same, best = both & (doc == item), np.zeros(len(size), np.int64)
    for n in np.unique(np.minimum(size, WINDOW)).tolist():
        on = np.flatnonzero(np.minimum(size, WINDOW) == n)
        run = lambda x: np.cumsum(np.pad(x[on].astype(np.int16), ((0, 0), (1, 0))), axis=1)
        here, good = run(both), run(same)
        whole = here[:, n:] - here[:, :-n] == n
        most = np.where(whole, good[:, n:] - good[:, :-n], 0).max(axis=1)
        best[on] = np.where(most >= math.ceil(AGREE * n - 1e-9), most, 0)
    return best


class SeedFilter:
    """A Bloom filter in _BLOCKS blocks of equal size: the top bits of a hash name its block, three
    other parts of it a bit each in there."""

    def __init__(self, blocks: dict[int, bytes], bits: int):
        self.block = (1 << bits) // _BLOCKS
        empty = bytes(self.block // 8)
        self.data = np.frombuffer(b"".join(blocks.get(i, empty) for i in range(_BLOCKS)), np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be in."""
        at = None
        for shift in (0, 17, 34):
            h = hashes if at is None else hashes[at]
            i = (h >> np.uint64(52)) * np.uint64(self.block) + (h >> np.uint64(shift) & np.uint64(self.block - 1))
            hit = np.flatnonzero(self.data[(i >> np.uint64(3)).astype(np.int64)] >> (i & np.uint64(7)).astype(np.uint8) & 1)
            at = hit if at is None else at[hit]
        return at


def _bits_of(block: int):
    def run(df):
        h, bits = df["h"].to_numpy().view(np.uint64), np.zeros(block, np.uint8)
        for shift in (0, 17, 34):
            bits[(h >> np.uint64(shift) & np.uint64(block - 1)).astype(np.int64)] = 1
        return df.iloc[:1][["b"]].assign(bits=[np.packbits(bits, bitorder="little").tobytes()])

    return run


def _item_seeds(batches):
    for batch in batches:
        out = {k: [] for k in ("h", "tag", "size", "item_tokens")}
        rows = []
        for first, data, offsets in chunks(batch.column(1), _CHUNK):
            values, text = tokens(data, offsets)
            size = np.bincount(text, minlength=len(offsets) - 1)
            for tag, mask in enumerate(_SEEDS):
                at, h = seeds_of(values, text, tag)
                n = size[text[at]]
                fits = n >= SHORTEST if tag < len(MASKS) else np.isin(n, [k for k, ms in SHORT.items() if mask in ms])
                fits = fits if tag < len(MASKS) else fits & (n < SHORTEST)
                at, h, n = at[fits], h[fits], n[fits]
                rows.append(first + text[at])
                out["h"].append(h.view(np.int64))
                out["tag"].append(np.full(len(at), tag, np.int32))
                out["size"].append(n.astype(np.int64))
                out["item_tokens"] += [r.tobytes() for r in around(values, text, at)]
        ids = batch.column(0).take(pa.array(np.concatenate(rows))) if rows else batch.column(0).slice(0, 0)
        joined = [np.concatenate(out[k]) if rows else np.zeros(0, t) for k, t in (("h", np.int64), ("tag", np.int32), ("size", np.int64))]
        yield pa.RecordBatch.from_arrays([*map(pa.array, joined), ids, pa.array(out["item_tokens"], pa.binary())], ["h", "tag", "size", "item_id", "item_tokens"])


def _hits(maybe, tags):
    def run(batches):
        seen: set[bytes] = set()  # texts with hits that this task has sent
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1), _CHUNK):
                values, text = tokens(data, offsets)
                new = np.full(len(offsets) - 1, -1, np.int8)  # of each text: not met yet, sent before, or to be sent
                for tag in tags:
                    at, h = seeds_of(values, text, tag, maybe.value)
                    if tag in _WHOLE:  # one hit a text and seed tells as much as all
                        once = np.unique(np.stack([text[at].astype(np.uint64), h]), axis=1, return_index=True)[1]
                        at, h = at[once], h[once]
                    for i in np.unique(text[at]).tolist():
                        if new[i] < 0:
                            key = batch.column(0)[first + i].as_py()
                            new[i] = key not in seen
                            seen.add(key)
                    sent = new[text[at]] == 1
                    at, h = at[sent], h[sent]
                    for i in range(0, len(at), _SENT):
                        part = at[i : i + _SENT]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(first + text[part])), pa.array(h[i : i + _SENT].view(np.int64)), pa.array([r.tobytes() for r in around(values, text, part)], pa.binary())],
                            ["text_key", "h", "tokens"],
                        )

    return run


def _table(batch, name: str) -> np.ndarray:
    """A column of token bytes as rows of numbers."""
    parts = batch.column(batch.schema.get_field_index(name)).to_pylist()
    return np.frombuffer(b"".join(parts), np.uint64).reshape(len(parts), -1 if parts else _AROUND)


def _verified(batches):
    for batch in batches:
        get = lambda n: batch.column(batch.schema.get_field_index(n))
        best = agreement(_table(batch, "tokens"), _table(batch, "item_tokens"), get("size").to_numpy())
        good = pa.array(best > 0)
        yield pa.RecordBatch.from_arrays([get("text_key").filter(good), get("item_id").filter(good), pa.array(best[best > 0])], ["text_key", "item_id", "best"])


def _judged(batches):
    """Hits against classes: best is the agreement, or -1 where a hot class has another window than the text."""
    for batch in batches:
        get = lambda n: batch.column(batch.schema.get_field_index(n))
        start, size = get("start").to_numpy(), get("size").to_numpy()
        best = np.zeros(len(start), np.int64)
        for at in np.unique(start).tolist():
            on = np.flatnonzero(start == at)
            part = batch.take(pa.array(on))
            doc, item = _table(part, "tokens"), _table(part, "part")
            if at < 0:
                best[on] = agreement(doc, item, size[on])
            else:
                best[on] = np.where((doc[:, at : at + WINDOW] == item).all(axis=1), WINDOW, -1)
        good, closed = pa.array(best != 0), pa.array(best[best != 0] > 0)
        tokens_ = pc.if_else(closed, pa.scalar(None, pa.binary()), get("tokens").filter(good))
        yield pa.RecordBatch.from_arrays(
            [get("text_key").filter(good), get("set_id").filter(good), pa.array(best[best != 0]), get("h").filter(good), tokens_], ["text_key", "set_id", "best", "h", "tokens"]
        )


def _text_key():
    return F.unhex(F.substring(F.sha2(F.col("text").cast("string"), 256), 1, 32))


def _places(seeds: DataFrame) -> DataFrame:
    """seeds with (start, part) of the class of each: part is the window of WINDOW tokens from start on for
    places of a hot seed, and all surroundings (start -1) for the others."""
    window = "substring(item_tokens, 8 * start + 1, 8 * {})".format(WINDOW)
    token = lambda at: f"substring(item_tokens, 8 * ({at}) + 1, 8) <> X'{'00' * 8}'"
    inside = F.expr(f"size >= {WINDOW} and {token('start')} and {token(f'start + {WINDOW - 1}')}")
    spans = F.array(*[F.lit(len(m)) for m in _SEEDS])
    hot = seeds.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("h")
    over = seeds.join(hot, "h").withColumn("start", F.explode(F.sequence(F.element_at(spans, F.col("tag") + 1) - 1, F.lit(_BEFORE))))
    windows = over.where(inside).groupBy("h", "start", F.expr(window).alias("part")).agg(F.count("*").alias("n"))
    saved = windows.groupBy("h", "start").agg((F.sum("n") - F.count("*")).alias("saved"))
    picks = saved.groupBy("h").agg(F.max_by("start", F.struct("saved", "start")).alias("start"))
    held = seeds.join(picks, "h", "left").withColumn("start", F.when(F.coalesce(inside, F.lit(False)), F.col("start")).otherwise(-1))
    return held.withColumn("part", F.when(F.col("start") >= 0, F.expr(window)).otherwise(F.col("item_tokens")))


class _Found:
    """What texts leak: written rows of (text, set of items), those left to be held against places one by
    one, and the tables of sets and places."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame):
        spark = docs.sparkSession
        items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        seeds = materialize(items.mapInArrow(_item_seeds, "h long, tag int, size long, item_id long, item_tokens binary").distinct(), "seeds")
        n = seeds.count()
        bits = min(FILTER_BITS, max(LEAST_BITS, math.ceil(math.log2(64 * n + 1))))
        named = seeds.select("h", F.shiftrightunsigned("h", 52).alias("b")).distinct()
        blocks = named.groupBy("b").applyInPandas(_bits_of((1 << bits) // _BLOCKS), "b long, bits binary").collect()  # at most 2**FILTER_BITS bits
        maybe = spark.sparkContext.broadcast(SeedFilter({r.b: bytes(r.bits) for r in blocks}, bits))
        tags = sorted(r.tag for r in seeds.select("tag").distinct().collect())
        # classes, and the set of items of each: two sums of hashes and their number name it
        key = ["h", "size", "start", "part"]
        places = materialize(_places(seeds).withColumn("size", F.least("size", F.lit(WINDOW))), "places")
        digest = F.concat_ws(":", F.count("*"), *[F.bit_xor(F.xxhash64(F.lit(i), "item_id")) for i in (1, 2)])
        heads = places.select(*key, "item_id").distinct().groupBy(*key).agg(F.unhex(F.substring(F.sha2(digest, 256), 1, 32)).alias("set_id"))
        heads = materialize(heads, "classes")
        self.places = places.join(heads, key).select("h", "set_id", "size", "start", "item_id", "item_tokens")
        texts = docs.where("text is not null").select(_text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
        hits = texts.mapInArrow(_hits(maybe, tags), "text_key binary, h long, tokens binary")
        # (both sides grow with their tables, so Spark picks the join by their sizes)
        judged = hits.join(heads, "h").mapInArrow(_judged, "text_key binary, set_id binary, best long, h long, tokens binary")
        self.judged = materialize(judged, "judged")
        self.by_set = self.judged.where("best > 0").groupBy("text_key", "set_id").agg(F.max("best").alias("best"))
        self.written = [seeds, places, heads, self.judged]

    def one_by_one(self, settled: DataFrame) -> DataFrame:
        """(text_key, item_id, best) of the hits that are open, but for those whose columns settled has."""
        left = self.judged.where("best < 0").select("text_key", "set_id", "h", "tokens").join(settled, settled.columns, "left_anti")
        pairs = left.join(self.places.where("start >= 0"), ["h", "set_id"])
        return pairs.mapInArrow(_verified, "text_key binary, item_id long, best long")

    def release(self) -> None:
        release(*self.written)


def leaking_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_key, items, best) of the distinct texts of docs that leak an item; text_key is the first
    half of the text's SHA-256. The table is written."""
    found = _Found(docs, benchmark)
    settled = found.by_set.where(F.col("best") == WINDOW).select("text_key", "set_id")
    sets = found.places.select("set_id", "item_id").distinct()
    pairs = found.by_set.join(sets, "set_id").select("text_key", "item_id", "best").union(found.one_by_one(settled))
    pairs = pairs.groupBy("text_key", "item_id").agg(F.max("best").alias("best"))
    leaks = materialize(pairs.groupBy("text_key").agg(F.sort_array(F.collect_list("item_id")).alias("items"), F.max("best").alias("best")), "leaks")
    found.release()
    return leaks


def leaking_text_keys(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_key) of the texts that leaking_texts tells of, without their items. The table is written."""
    found = _Found(docs, benchmark)
    settled = found.by_set.select("text_key").distinct()
    leaks = materialize(settled.union(found.one_by_one(settled).select("text_key")).distinct(), "leaks")
    found.release()
    return leaks


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, items, best) of every row of docs: the sorted ids of leaked items, and the most
    agreeing tokens in one window.

    Null and empty texts leak nothing; items with null id or text or no word are passed over; rows of
    the benchmark that share an id count as one item; an empty benchmark leaks nothing; repeated rows
    of docs are each reported; other columns are not read.
    """
    leaks = leaking_texts(docs, benchmark)
    rows = docs.select(F.col(key).cast("long").alias(key), _text_key().alias("text_key"))
    return rows.join(leaks, "text_key", "left").select(key, F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("best", F.lit(0).cast("long")).alias("best"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that leak a benchmark item; same columns, all other rows kept.

    Rows with null or empty text stay; null ids and repeated rows make no difference; columns of any
    name are kept; an empty table or an empty benchmark drops nothing.
    """
    leaks = leaking_text_keys(docs, benchmark)
    return docs.join(leaks, _text_key() == leaks.text_key, "left_anti")
