"""How the sources of a language differ in their words.

All counts are exact: p of a term in a group is 1 + floor(SCALE * (count + 1) / (N + V)) with N the
group's count of kept terms and V their number in the language, and p against q costs
floor((p - q)^2 / q).

Each task counts the terms of the documents it reads, so what is shuffled are counts. The kept terms
of a language get numbers and are dealt into buckets of about BUCKET terms. In a bucket a group is one
pair of sorted arrays (term numbers, counts), and the groups of a language stand in tiles of TILE: one
task takes a bucket and two tiles and sets every unordered pair of groups in them against each other.
The shorter array's numbers are searched in the longer one; terms of both, of one and of neither are
priced both ways at once, the last by their number alone. Sums over buckets are the pairs' values. So
no task holds a group's whole vocabulary, and a group is sent to as many tasks as there are tiles, not
groups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize

SCALE, MIN_DOCS, TOP = 1_000_000_000, 3, 200
BUCKET, TILE = 1 << 16, 8
#: Terms that a task counts before it sends them on; bits of a count that are its documents.
_HELD, _DOCS = 400_000, 30
#: ASCII letters in lower case, bytes of other characters as they are, all else a space.
_TERMS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) as rows (lang, source, term, n, docs)."""
    held: dict[tuple[str, str], dict[bytes, int]] = {}
    size = 0

    def flush():
        for (lang, source), terms in held.items():
            same = lambda x: pa.array([x] * len(terms), pa.string())  # noqa: B023, E731
            n, docs = [v >> _DOCS for v in terms.values()], [v & (1 << _DOCS) - 1 for v in terms.values()]
            yield pa.RecordBatch.from_arrays([same(lang), same(source), pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            terms = held.setdefault((lang, source), {})
            before = len(terms)
            found = Counter(text.encode("utf-8", "surrogatepass").translate(_TERMS).split(b" "))
            del found[b""]
            for term, n in found.items():
                terms[term] = terms.get(term, 0) + (n << _DOCS) + 1
            size += len(terms) - before
            if size >= _HELD:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Two written tables: the groups (lang, source) of docs(lang, source, text), and (lang, source, term,
    n, lang_n, id, first) of the terms that at least ``min_docs`` rows of their language have; id is the
    term's number there, and one of its rows is the first."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = materialize(docs.select(text("lang"), text("source")).distinct(), "groups")
    counted = docs.select(text("lang"), text("source"), text("text")).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    # (tasks send sums, so a common term is a few rows for each task and source)
    counts = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")  # a row for each source
    rows = counts.withColumns({"lang_n": F.sum("n").over(of_term), "in_docs": F.sum("docs").over(of_term)})
    rows = rows.where(F.col("in_docs") >= min_docs).withColumn("row", F.monotonically_increasing_id())
    numbered = rows.withColumn("id", F.min("row").over(of_term)).withColumn("first", F.col("row") == F.col("id"))
    return groups, materialize(numbered.select("lang", "source", "term", "n", "lang_n", "id", "first"), "terms")


def share(count: str, size: str) -> Column:
    """p for a count among ``size`` (= N + V), exact for all sizes: by decimals where longs end."""
    scaled = F.lit(SCALE).cast("decimal(10, 0)") * (F.col(count) + 1).cast("decimal(19, 0)")
    large = F.call_function("div", scaled, F.col(size).cast("decimal(19, 0)"))
    return F.when(F.col(count) < (1 << 63) // SCALE - 1, F.call_function("div", (F.col(count) + 1) * SCALE, F.col(size))).otherwise(large) + 1


def cost(p, q) -> Column:
    """floor((p - q)^2 / q); the square is below 2^62."""
    return F.call_function("div", (p - q) * (p - q), q)


def _shares(counts: np.ndarray, size: int) -> np.ndarray:
    """1 + floor(SCALE * (counts + 1) / size), by three digits to base 1000: exact for sizes below 2^53."""
    out, rest = np.zeros(len(counts), np.int64), counts + 1
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, size)
        out = out * 1000 + digit
    return out + 1


def _costs(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _overlap(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the numbers that two sorted arrays share stand in each."""
    if len(a) > len(b):
        return _overlap(b, a)[::-1]
    at = np.searchsorted(b, a)
    hit = np.flatnonzero(at < len(b))
    hit = hit[b[at[hit]] == a[hit]]
    return hit, at[hit]


def pair_values(groups: list[tuple[np.ndarray, np.ndarray, int]], n_terms: int, pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(a, b, value of b as a's item, value of a as b's item) for some pairs of groups (sorted term numbers,
    counts, N + V) in a bucket of ``n_terms`` kept terms."""
    priced = [(ids, _shares(counts, size), _shares(np.zeros(1, np.int64), size)) for ids, counts, size in groups]
    for a, b in pairs:
        (ia, pa_, za), (ib, pb, zb) = priced[a], priced[b]
        in_a, in_b = _overlap(ia, ib)
        only_a, only_b = np.ones(len(ia), bool), np.ones(len(ib), bool)
        only_a[in_a] = only_b[in_b] = False
        neither = n_terms - len(ia) - len(ib) + len(in_a)
        both_ways = []
        for (x, here, alone, zero), (y, there, other, none) in (((pa_, in_a, only_a, za), (pb, in_b, only_b, zb)), ((pb, in_b, only_b, zb), (pa_, in_a, only_a, za))):
            value = int(_costs(x[here], y[there]).sum()) + int(_costs(x[alone], none).sum()) + int(_costs(zero, y[other]).sum())
            both_ways.append(value + neither * int(_costs(zero, none)[0]))
        yield a, b, *both_ways


def _tiles(df: pd.DataFrame) -> pd.DataFrame:
    """The pairs of one bucket and two tiles, both ways; each once over all tasks."""
    first, second = int(df["t1"].iloc[0]), int(df["t2"].iloc[0])
    groups = [(np.asarray(i, np.int64), np.asarray(n, np.int64), int(s)) for i, n, s in zip(df["ids"], df["ns"], df["size"], strict=True)]
    tile, names = df["tile"].tolist(), df["source"].tolist()
    on = [k for k, t in enumerate(tile) if t == first], [k for k, t in enumerate(tile) if t == second]
    pairs = ((a, b) for a in on[0] for b in on[1] if first != second or a < b)
    rows = []
    for a, b, x, y in pair_values(groups, int(df["in_bucket"].iloc[0]), pairs):
        rows += [(names[a], names[b], x), (names[b], names[a], y)]
    out = pd.DataFrame(rows, columns=["source", "item", "value"]).astype({"source": object, "item": object, "value": "int64"})
    return out.assign(lang=df["lang"].iloc[0])[["lang", "source", "item", "value"]]


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bucket: int = BUCKET, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs(lang, source, text): for each group (lang, source) in
    part ``pair`` every other source of the language with the group's cost against it, in part ``term``
    its ``top`` terms that it has more often than the language, with their costs; ranked by value, then
    item.

    Null lang, source and text are empty texts; each row is a document, repeated or not; a group
    without terms takes part with counts of 0; a language without kept terms gives pairs of value 0; ties
    in value go by the item's bytes; an empty table gives an empty table; other columns are not read.
    """
    groups, terms = kept_terms(docs, min_docs)
    langs = materialize(terms.where("first").groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "langs")
    totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sized = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    # (no bytes of a source stand for another order: a tile is any TILE sources of the language)
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sized = materialize(sized.select("lang", "source", "v", (F.col("total") + F.col("v")).alias("size"), (F.col("lang_total") + F.col("v")).alias("lang_size"), F.floor(number / tile).alias("tile"), F.floor((F.count("*").over(Window.partitionBy("lang")) - 1) / tile).alias("last_tile")), "sized")

    # pairs: every group has a row in every bucket of its language, with the terms that it has there
    buckets = F.greatest(F.lit(1), F.ceil(F.col("v") / bucket)).cast("long")
    place = F.pmod(F.xxhash64("id"), F.col("buckets"))
    parts = langs.select("lang", buckets.alias("buckets"))
    mine = terms.join(parts, "lang").groupBy("lang", "source", place.alias("bucket")).agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("have"))
    sizes = terms.where("first").join(parts, "lang").groupBy("lang", place.alias("bucket")).agg(F.count("*").alias("in_bucket"))
    every = sized.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)))
    rows = every.join(mine, ["lang", "source", "bucket"], "left").join(sizes, ["lang", "bucket"], "left")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_tile")))
    rows = rows.select("lang", "source", "bucket", "size", "tile", F.coalesce("in_bucket", F.lit(0)).cast("long").alias("in_bucket"), F.coalesce(F.col("have.id"), F.array().cast("array<long>")).alias("ids"), F.coalesce(F.col("have.n"), F.array().cast("array<long>")).alias("ns"), other.alias("other"))
    tiles = rows.withColumns({"t1": F.least("tile", "other"), "t2": F.greatest("tile", "other")}).drop("other").where("size > 0")
    priced = tiles.groupBy("lang", "bucket", "t1", "t2").applyInPandas(_tiles, "lang string, source string, item string, value long")
    by_pair = priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # languages without kept terms have groups of size 0
    bare = sized.where("v = 0").select("lang", "source")
    by_pair = by_pair.unionByName(bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long")))

    p, q = share("n", "size"), share("lang_n", "lang_size")
    scored = terms.join(sized, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    by_term = scored.select("lang", "source", "item", cost(F.col("p"), F.col("q")).alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = lambda rows, part: rows.withColumn("rank", rank).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return ranked(by_pair, "pair").unionByName(ranked(by_term, "term").where(F.col("rank") <= top))
