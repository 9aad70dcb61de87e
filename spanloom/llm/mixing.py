"""Mix sources to target weights: water-filled targets, then pivotal dependent rounding.

Each source gets a share of the words in proportion to its weight, but at most MAX_COPIES times its
own size; what is above is shared again by weight. Within a source every document should be taken
target / source_size times: the whole part is certain, the fraction is a probability. Rounding each
on its own would miss the target by many words, so documents are paired: mass moves at random from
one probability to the other, in inverse proportion to their sizes so that the expected words stay
the same, until one of the two is 0 or 1. All but one document of a group are then decided.

Groups are hash buckets of a source with about GROUP_ROWS documents each; the one undecided document
of each group goes on to the next level, FAN groups to one, until one is left per source, which is
rounded by its own probability. So no task sees a whole source, a source's words miss the target by
at most one document, and all random draws are hashes of ids: reruns agree.
"""

from __future__ import annotations

import hashlib
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize

WEIGHTS = (3, 1, 2)
SHARE, MAX_COPIES = 1.5, 2.0
GROUP_ROWS, FAN = 500, 256
#: Rows that repeat are numbered in so many parts each, and stand for themselves in steps of so many.
SALT, STEP = 64, 4096
_WORD = r"[^\x20\x09-\x0D]+"


def _before(rows: DataFrame, order: list, sums: tuple[str, ...], name: str) -> DataFrame:
    """rows with ``before`` (how many come before each in an order) and, for each column of ``sums``, its
    sum over those as {column}_before. Ranges of the order are numbered on their own; one row per range
    gives them their offsets, so no task sees all rows."""
    placed = materialize(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), name)
    above = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    count = {"before": F.count(F.lit(1)), **{f"{c}_before": F.sum(c) for c in sums}}
    inside = placed.withColumns({c: F.coalesce(agg.over(above), F.lit(0)) for c, agg in count.items()})
    ranges = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = placed.groupBy("range").agg(*[agg.alias(f"{c}_in") for c, agg in count.items()])
    offsets = totals.select("range", *[F.coalesce(F.sum(f"{c}_in").over(ranges), F.lit(0)).alias(f"{c}_off") for c in count])
    return inside.join(F.broadcast(offsets), "range").select(*rows.columns, *[(F.col(c) + F.col(f"{c}_off")).alias(c) for c in count])


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES) -> DataFrame:
    """(source, source_size, n, target) from (source, size): one row per source, null included.

    Sources are ranked by code point, null last, and take the weights in turn. A source is full when
    its cap per weight is at most the level at which the words run out; the level follows from the
    running sums in that order, so no loop is needed. An empty table gives an empty result.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n"))
    named = _before(per, [F.col("source").asc_nulls_last()], (), "sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("before") % len(weights) + 1).cast("int"))
    ranked = named.withColumn("w", w).drop("before").withColumn("full_at", cap * F.col("source_size") / F.col("w"))
    filled = _before(ranked, [F.col("full_at").asc(), F.col("source").asc_nulls_last()], ("source_size", "w"), "levels")
    total = ranked.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    level = (share * (total["size"] or 0) - cap * F.col("source_size_before")) / ((total["w"] or 0) - F.col("w_before"))
    # the first source that its share doesn't fill sets the level of all that follow
    first = filled.withColumn("level", level).where("full_at > level").agg(F.min(F.struct("full_at", "level")).alias("first")).first()["first"]
    full = cap * F.col("source_size")
    target = F.least(full, F.col("w") * F.lit(first["level"])) if first else full
    return ranked.select("source", "source_size", "n", target.cast("double").alias("target"))


def _draw(*parts) -> float:
    """A number in [0, 1) that depends on the arguments alone."""
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "big") / 2**64


def pivot(rows: list[tuple[object, int, float]]) -> tuple[dict[object, int], tuple[object, int, float] | None]:
    """Decide all but at most one of (id, size, probability), size > 0; keeps sum(size * probability)."""
    done: dict[object, int] = {}
    held = None
    for i, size, p in rows:
        if held is None:
            held = (i, size, p)
        else:
            j, other, q = held
            # either words move from j to i, or from i to j; each as far as one of the two allows
            up, down = min((1 - p) * size, q * other), min(p * size, (1 - q) * other)
            move = up if _draw(i, j) * (up + down) < down else -down
            p, q = p + move / size, q - move / other
            near = [(min(x, 1 - x), k) for k, x in enumerate((p, q))]
            if min(near)[1] == 0:  # this document is decided, the other stays in hand
                done[i], held = round(p), (j, other, q)
            else:
                done[j], held = round(q), (i, size, p)
        if held is not None and min(held[2], 1 - held[2]) < 1e-9:
            done[held[0]] = round(held[2])
            held = None
    return done, held


def _round(last: bool):
    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["size", "k", "k2", "copy"], ascending=False, kind="stable").reset_index(drop=True)
        ids = list(zip(df["k"].tolist(), df["k2"].tolist(), df["copy"].tolist(), strict=True))
        done, held = pivot(list(zip(ids, df["size"].tolist(), df["p"].tolist(), strict=True)))
        if held is not None and last:
            done[held[0]] = int(_draw(held[0]) < held[2])
        out = df[["k", "k2", "copy", "size", "p", "src", "bucket"]].copy()
        out["extra"] = pd.array([done.get(i) for i in ids], dtype="Int64")
        if held is not None and not last:
            out.loc[ids.index(held[0]), "p"] = held[2]
        return out

    return run


def n_words(text) -> F.Column:
    """Words of a whole text: runs of anything but 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES, size: str | None = None) -> DataFrame:
    """docs(doc_id, source, text, ...) with size, source_size, target, copies and taken (= copies * size).

    size is the number of words of the whole text, or the column named by ``size`` (then no text is
    needed). Null texts have 0 words and 0 copies. Null sources form one source. Rows alike in all
    of id, source and text are decided one by one. An empty table gives an empty result. Columns of
    docs with the names of added ones are replaced.
    """
    words = F.coalesce(F.col(size), F.lit(0)).cast("long") if size else n_words(F.col("text"))
    own = "__mix"  # starts no column of docs
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    plain = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    source, kind = F.col("source").cast("string"), F.col("source").isNull()
    parts = (F.col("doc_id").cast("string"), F.col("doc_id").isNull(), source, kind, *([words] if size else [F.col("text").cast("string")]))
    # 128 bits name a row; the position in the input deals rows that repeat into parts. All that follows
    # reads the written table, so that every step sees the same positions
    added = {"k": F.xxhash64(*parts), "k2": F.xxhash64(F.lit("second"), *parts), "salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALT)), "src": F.xxhash64(source, kind), "size": words}
    docs = materialize(docs.withColumns({f"{own}_{name}": c for name, c in added.items()}).select(*plain, *[f"{own}_{name}" for name in added]), "keyed")
    sized = docs.select(*[F.col(f"{own}_{name}").alias(name) for name in added], source.alias("source"))
    targets = materialize(source_targets(sized, weights, share, cap), "targets")

    # rows alike in every part are counted; one row per distinct key stands for all of them
    same = sized.groupBy("k", "k2", "src", "source", "size").agg(F.count("*").alias("times")).where("size > 0")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ready = same.join(targets, same.source.eqNullSafe(targets.source)).select("k", "k2", "size", "times", "n", "src", rate.alias("rate"))
    rows = (
        ready.withColumn("base", F.floor("rate"))
        .withColumn("p", F.col("rate") - F.col("base"))
        .withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"), F.lit(STEP).cast("long"))))
        .withColumn("copy", F.explode(F.sequence(F.col("from"), F.least("times", F.col("from") + (STEP - 1)))))
        .select("k", "k2", "copy", "times", "size", "base", "p", "src", F.pmod(F.xxhash64("k2", "copy", F.lit(1)), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / GROUP_ROWS))).alias("bucket"))
    )
    rows = materialize(rows, "rows")
    widest = (rows.agg(F.max("bucket")).first()[0] or 0) + 1
    schema = "k long, k2 long, copy long, size long, p double, src long, bucket long, extra long"
    live = rows.where("p > 0").select("k", "k2", "copy", "size", "p", "src", "bucket")
    decided, level = [], 0
    while True:
        last = widest == 1
        live = materialize(live.groupBy("src", "bucket").applyInPandas(_round(last), schema), f"level{level}")
        decided.append(live.where("extra is not null").select("k", "k2", "extra"))
        if last:
            break
        widest, level = -(-widest // FAN), level + 1
        live = live.where("extra is null").select("k", "k2", "copy", "size", "p", "src", F.floor(F.col("bucket") / FAN).alias("bucket"))
    extra = decided[0]
    for d in decided[1:]:
        extra = extra.union(d)
    # of the rows that share a key, which differ in nothing, so many take one copy more than the others:
    # the first ones of the parts in which they stand
    more = extra.groupBy("k", "k2").agg(F.sum("extra").alias("extra"))
    by_key = rows.select("k", "k2", "base").distinct().join(more, ["k", "k2"], "left")
    in_part = sized.where("size > 0").groupBy("k", "k2", "salt").agg(F.count("*").alias("here"))
    before = F.sum("here").over(Window.partitionBy("k", "k2").orderBy("salt")) - F.col("here")
    lucky = in_part.withColumn("before", before).join(by_key, ["k", "k2"]).select(
        *[F.col(c).alias(f"{own}_{c}") for c in ("k", "k2", "salt", "base")], (F.coalesce("extra", F.lit(0)) - F.col("before")).alias(f"{own}_lucky")
    )
    key = [f"{own}_k", f"{own}_k2", f"{own}_salt"]
    number = F.row_number().over(Window.partitionBy(*key).orderBy(key[-1]))
    copies = F.coalesce(F.col(f"{own}_base") + (number <= F.col(f"{own}_lucky")).cast("int"), F.lit(0)).cast("long")
    both = docs.join(materialize(lucky, "copies"), key, "left").withColumn("copies", copies)
    t = targets.select(F.col("source").alias(f"{own}_s"), "source_size", "target")
    return both.join(F.broadcast(t) if targets.count() < 10_000 else t, F.col("source").cast("string").eqNullSafe(F.col(f"{own}_s")), "left").select(
        *plain, F.col(f"{own}_size").alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col(f"{own}_size")).alias("taken")
    )


def mixed_copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES) -> DataFrame:
    """The rows of docs, each as often as the mix takes it (not at all, once or more); same columns.

    Null and wordless texts are taken 0 times; null sources form one source; null ids and repeated
    rows are decided one by one; an empty table stays empty.
    """
    clash = {c: f"__own_{c}" for c in ("size", "source_size", "target", "copies", "taken") if c in docs.columns}
    out = mix(docs.withColumnsRenamed(clash), weights, share, cap).where("copies > 0")
    out = out.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])
