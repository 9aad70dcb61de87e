"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

A document is its set of distinct k-word shingles. Plain banding with R-value keys in L tables needs
R * L minhashes. Here two collections of ``bands`` short bands (``rows`` minhashes each) are computed
and a table is formed for every pair of one band from either collection: ``bands ** 2`` tables with
keys of ``2 * rows`` minhashes from only ``2 * bands * rows`` hash functions. A pair of similarity s
is missed when it agrees in no band of one collection: 2 * (1 - s**rows)**bands, 6e-5 at s = 0.8.

Hot groups. Documents with equal sets are one class before anything else happens. A short band value
that only one class has can't make a key that two have, so it is left out before keys are formed. In
a table's bucket every class is confirmed against one hub, the class whose values are the most
common, instead of against all others; a group of variants of one text has that text as its hub.
Then only classes of a hub that ended in different components can have a link left to find. Seen
from their hub h they are short: x is the set dx of shingles in which x and h differ, and x and y
are linked exactly if |dx & dy| >= t = (|dx| + |dy| - r * (|x| + |y|)) / 2, r = (100 - percent) /
(100 + percent). (t <= 0 is possible only if both are linked with h already.) Two such differences
must meet in the |dx| - t + 1 shingles of dx that are rarest in the hub's group, so joining on
those finds every pair that is left, and these are confirmed on the full sets. No bucket is
collected in one place, no group is expanded into all its pairs, and no candidate is dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import materialize
from .text import SpanHasher, encode, mix64

ROWS, BANDS = 5, 26

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_HASHER = SpanHasher()
_STEP = np.uint64(0xD6E8FEB86659FD93)
_RNG = np.random.default_rng(11)
_MUL = (_RNG.integers(0, 2**31, 2 * BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADD = _RNG.integers(0, 2**32, 2 * BANDS * ROWS, dtype=np.uint32)[:, None]


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles of a whole text; A-Z are lower-cased and
    words are runs of bytes other than 0x20 and 0x09-0x0D. Fewer words: the whole sequence is one."""
    data = np.frombuffer(encode(text).lower(), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    turns = np.diff(inside)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    w = mix64(_HASHER.spans(_HASHER.prefix(data), starts, ends))
    n = max(1, len(w) - k + 1)
    acc = np.zeros(n, np.uint64)
    for i in range(min(k, len(w))):
        acc = acc * _STEP + w[i : i + n]
    return np.unique(mix64(acc))


def band_values(shingles: np.ndarray) -> np.ndarray:
    """The 2 * BANDS short band values of a set, each mixed with its band's number."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(2 * BANDS * ROWS, 2**32 - 1, np.uint32)
    for i in range(0, len(h), 2048):
        np.minimum(least, (h[None, i : i + 2048] * _MUL + _ADD).min(axis=1), out=least)
    parts = least.reshape(2 * BANDS, ROWS).astype(np.uint64)
    acc = np.arange(1, 2 * BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        acc = mix64(acc * _STEP + parts[:, i])
    return acc.view(np.int64)


def _signatures(k: int):
    def run(batches):
        for batch in batches:
            ids, n, keys, bands = batch.column(0), [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k)
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_values(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            found = [shingle_set(t.as_py(), k).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "shingles"])

    return run


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b) with the sets sa and sb, and na, nb, common."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return (
        pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
        .withColumns({"na": F.size("sa"), "nb": F.size("sb"), "common": F.size(F.array_intersect("sa", "sb"))})
    )


def _linked(percent: int):
    return F.expr(f"100 * common >= {percent} * (na + nb - common)")


def _left_over(star: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of one hub that may be linked though their components differ.

    star: hub a, class b, the class's shingle count nb, and the difference ``delta`` of both sets.
    """
    r = (100 - percent) / (100 + percent)
    placed = star.join(comps.withColumnRenamed("id", "b"), "b", "left").select(
        "a", "b", "nb", F.coalesce("component", "b").alias("comp"), F.size("delta").alias("d"), "delta"
    ).withColumn("f", F.col("d") - r * F.col("nb"))
    # per hub, the least f of any component and of any other one: what a partner has at least
    placed = materialize(placed, "placed")
    per = placed.groupBy("a", "comp").agg(F.min("f").alias("f"))
    first = materialize(per.groupBy("a").agg(F.min(F.struct("f", "comp")).alias("lo"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1"), "first")
    others = materialize(per.join(first, "a").where("comp <> lo.comp").select("a", "f"), "others")
    second = others.groupBy("a").agg(F.min("f").alias("f2"))
    bound = materialize(first.select("a", F.col("lo.f").alias("f1"), F.col("lo.comp").alias("comp1")).join(second, "a"), "bounds")
    least = F.when(F.col("comp") == F.col("comp1"), F.col("f2")).otherwise(F.col("f1"))
    overlap = F.greatest(F.lit(1), F.ceil((F.col("f") + least) / 2 - 1e-6))
    mixed = placed.join(bound, "a").withColumn("reach", F.col("d") - overlap + 1).where("reach > 0")
    parts = materialize(mixed.select("a", "b", "comp", "nb", "reach", F.explode("delta").alias("e")), "parts")
    often = parts.groupBy("a", "e").agg(F.count("*").alias("n")).where("n > 1")
    # shingles that one class alone has come first and find no partner
    alone = parts.select("a", "b", "reach").groupBy("a", "b").agg(F.first("reach").alias("reach"), F.count("*").alias("d"))
    shared = parts.join(often, ["a", "e"]).groupBy("a", "b", "comp", "nb").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("es"))
    rare = shared.join(alone, ["a", "b"]).withColumn("take", F.greatest(F.lit(0), F.col("reach") - (F.col("d") - F.size("es"))).cast("int"))
    rare = rare.where("take > 0").select("a", "b", "comp", "nb", "d", F.posexplode(F.slice("es", 1, F.col("take"))).alias("i", "x"), F.size("es").alias("shared"))
    # pos: the shingle's place among all of the class's difference
    rare = rare.select("a", "b", "comp", "nb", "d", (F.col("d") - F.col("shared") + F.col("i") + 1).alias("pos"), "x.e", (F.col("d") - r * F.col("nb")).alias("f"))
    rare = materialize(rare, "rare")
    other = rare.select("a", "e", *[F.col(c).alias(f"{c}_y") for c in ("b", "comp", "nb", "d", "pos", "f")])
    least_t = "greatest(1, ceil((f + f_y) / 2 - 1e-6))"
    near = F.expr(
        f"b < b_y and comp <> comp_y and 100 * least(nb, nb_y) >= {percent} * greatest(nb, nb_y) "
        f"and pos + {least_t} <= d + 1 and pos_y + {least_t} <= d_y + 1"
    )
    return rare.join(other, ["a", "e"]).where(near).select(F.col("b").alias("a"), F.col("b_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs(doc_id, text, ...).

    Links documents with 100 * |A & B| >= percent * |A | B| on k-word shingle sets; component_id is
    the smallest doc_id reachable, kept marks the row that stays of each component.

    Null or wordless texts: n_shingles 0, linked with nothing. Null doc_id: in no component
    (component_id null, kept true). Rows that share a doc_id count as one document with several
    texts. Empty table: empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sigs = materialize(
        rows.mapInArrow(_signatures(k), "doc_id long, n_shingles long, set_key binary, bands array<long>"), "signatures"
    )
    classes = materialize(
        sigs.where("doc_id is not null and n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")),
        "classes",
    )

    # band values that at least two classes have
    values = classes.select("id", F.posexplode("bands").alias("band", "v")).withColumn("band", F.col("band").cast("short"))
    shared = values.groupBy("v").agg(F.count("*").alias("n")).where("n > 1")
    kept = values.join(shared.hint("merge"), "v").groupBy("id").agg(
        F.sum("n").alias("common"),
        F.collect_list(F.when(F.col("band") < BANDS, F.col("v"))).alias("first"),
        F.collect_list(F.when(F.col("band") >= BANDS, F.col("v"))).alias("second"),
    )
    # a class goes by a number that sorts by how common its values are; classes that happen to have one
    # number can't be told apart in a bucket, so they are candidates of each other anyhow
    code = F.shiftleft(F.least("common", F.lit(2**31 - 1)), 32).bitwiseOR(F.xxhash64("id").bitwiseAND(F.lit(2**32 - 1)))
    kept = materialize(kept.where((F.size("first") > 0) & (F.size("second") > 0)).withColumn("code", code), "kept")
    # the tables: one key for every pair of a band of either collection
    entries = kept.select("code", F.explode("first").alias("u"), "second").select(
        "code", F.explode(F.transform("second", lambda v: F.xxhash64("u", v))).alias("key")
    )
    hubs = entries.groupBy("key").agg(F.max("code").alias("hub"), F.min("code").alias("last")).where("last < hub").select("key", "hub")
    pairs = entries.join(hubs.hint("merge"), "key").where("code < hub").select("hub", "code").distinct()
    names = kept.select("code", "id")
    alike = names.join(names.groupBy("code").agg(F.count("*").alias("n")).where("n > 1"), "code").select("code", "id")
    alike = alike.select("code", F.col("id").alias("a")).join(alike.select("code", F.col("id").alias("b")), "code").where("a < b").select("a", "b")
    pairs = materialize(
        pairs.join(names.select(F.col("code").alias("hub"), F.col("id").alias("a")), "hub")
        .join(names.select("code", F.col("id").alias("b")), "code").select("a", "b").union(alike),
        "pairs",
    )

    # (both sides of these joins grow with the input, so they are shuffled at any size)
    # full sets of the classes that stand in a bucket with another one
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = rows.join(wanted.hint("merge"), rows.doc_id == wanted.id, "left_semi").select(F.col("doc_id").alias("id"), "text")
    sets = materialize(texts.mapInArrow(_sets(k), "id long, shingles array<long>"), "sets")

    star = _with_sets(pairs, sets).withColumn("delta", F.concat(F.array_except("sa", "sb"), F.array_except("sb", "sa")))
    crowded = materialize(pairs.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a", F.lit(True).alias("crowded")), "crowded")
    star = star.join(crowded, "a", "left").select("a", "b", "nb", _linked(percent).alias("linked"), F.when(F.col("crowded"), F.col("delta")).alias("delta"))
    star = materialize(star, "star")
    edges = star.where("linked").select("a", "b")
    comps = connected_components(edges)
    more = materialize(_left_over(star.where("delta is not null"), comps, percent), "left_over")
    if more.take(1):
        found = _with_sets(more, sets).where(_linked(percent)).select("a", "b")
        comps = connected_components(edges.union(found))

    member = classes.select("set_key", "id").join(comps, "id", "left").select("set_key", F.coalesce("component", "id").alias("root"))
    return (
        sigs.select("doc_id", "n_shingles", "set_key")
        .join(member, "set_key", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs without the rows whose doc_id is not the smallest of its component; same columns.

    Of rows that repeat one kept doc_id all stay. Null ids and wordless texts stay.
    """
    gone = near_duplicates(docs, k, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
