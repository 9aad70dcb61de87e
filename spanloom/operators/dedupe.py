"""Span ids that a client and its server share ("Zipkin style") are told apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sessions import ORDER, ROW, ask_by_id, over_id, told


def mark_shared(spans: DataFrame, keys: tuple[str, ...], spread: bool = False) -> DataFrame:
    """spans with ``renamed`` (a server whose id a client of its trace session has as well) and ``nth``, the
    number of a renamed span among those of its session, in order; with ``spread`` any number of its own."""
    trace = [*keys, "sid"]
    marked = over_id(spans, keys, {"__shared": F.max(F.col("is_client").cast("int"))}, spread)
    marked = marked.withColumn("renamed", F.coalesce((F.col("__shared") == 1) & F.col("is_server"), F.lit(False))).drop("__shared")
    if spread:
        return marked.withColumn("nth", F.when(F.col("renamed"), F.col(ROW)))
    so_far = Window.partitionBy(*trace).orderBy(*ORDER, "parent_span_id", "service").rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("nth", F.when(F.col("renamed"), F.sum(F.col("renamed").cast("int")).over(so_far).cast("int")))


def dedupe_span_ids(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """spans with the ids of shared servers renamed and parents led to them.

    In a trace session each server span whose id a client span has as well gets a fresh id (the k-th
    renamed one the k-th smallest positive number that is neither a span id nor a parent id there);
    its old id becomes its parent. Then every span whose parent is a renamed id gets the last fresh
    id of it as parent, but for that renamed span itself. Adds ``renamed`` (boolean).
    """
    named = _with_free_numbers(mark_shared(spans, keys), keys)
    named = named.withColumn("__p", F.when(F.col("renamed"), F.col("span_id")).otherwise(F.col("parent_span_id")))
    led = ask_by_id(named, keys, [F.col("span_id")], [F.col("__p")], {"__heir": F.max(told(F.when(F.col("renamed"), F.struct("nth", "__fresh"))))})
    own, heir = F.coalesce("__fresh", "span_id"), F.col("__heir.__fresh")
    parent = F.when(heir.isNotNull() & (heir != own), heir).otherwise(F.col("__p"))
    return led.withColumns({"span_id": own, "parent_span_id": parent}).select(*spans.columns, "renamed")


def _with_free_numbers(marked: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """marked with __fresh: for the k-th renamed span of a trace session (nth = k) the k-th smallest
    positive number that is no id there, else null.

    If the used numbers in order are u1 < u2 < ..., there are u - i free ones below the i-th, so the
    k-th free one is k plus the number of used ones with u - i < k. Both are running sums over the
    session's spans and ids, sorted; no set of all ids is gathered.
    """
    trace = [*keys, "sid"]
    event = lambda number, used: F.struct(number.cast("long").alias("number"), F.lit(used).alias("used"))
    events = F.array(event(F.lit(None), False), event(F.col("span_id"), True), event(F.col("parent_span_id"), True))
    rows = marked.withColumn("__e", F.explode(events)).where("not __e.used or __e.number > 0")
    by_number = Window.partitionBy(*trace).orderBy("__e.number")
    new = F.col("__e.used") & ~F.coalesce(F.lag("__e.number").over(by_number) == F.col("__e.number"), F.lit(False))
    rows = rows.withColumn("__new", new.cast("int")).withColumn("__i", F.sum("__new").over(by_number.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.where("not __e.used or __new = 1").withColumn("__at", F.when(F.col("__e.used"), F.col("__e.number") - F.col("__i")).otherwise(F.col("nth").cast("long")))
    below = F.sum(F.col("__e.used").cast("int")).over(Window.partitionBy(*trace).orderBy("__at", "__e.used").rowsBetween(Window.unboundedPreceding, 0))
    fresh = F.when(F.col("renamed"), F.col("nth") + below).cast("long")
    return rows.withColumn("__fresh", fresh).where("not __e.used").drop("__e", "__new", "__i", "__at")
