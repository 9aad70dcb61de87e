"""Who calls whom: edges of traces, counts by window, one list per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import mark_shared
from .sessions import ORDER, ask_by_id, told, tumble

#: Fixed value of the result table.
SOURCE = "jaeger"


def trace_edges(spans: DataFrame, keys: tuple[str, ...], spread: bool = False) -> DataFrame:
    """(keys, sid, session_end, parent, child): one row for each span whose parent is in the session.

    The last span of an id names its service; spans without a known parent, or whose parent has no
    service, give no edge; self-calls stay.
    """
    last = F.max(told(F.struct(*ORDER, "service")))
    linked = ask_by_id(spans, keys, [F.col("span_id")], [F.col("parent_span_id")], {"last": last}, spread)
    return _edges(linked, keys)


def deduped_edges(spans: DataFrame, keys: tuple[str, ...], spread: bool = False) -> DataFrame:
    """trace_edges of dedupe_span_ids, without making up fresh ids: a renamed span is known by the pair
    (true, its number), any other by (false, its id), so all look-ups stay on the trace key's
    partitioning, or with ``spread`` (for spans with ROW) on sessions and ids."""
    m = mark_shared(spans, keys, spread).withColumn("p", F.when(F.col("renamed"), F.col("span_id")).otherwise(F.col("parent_span_id")))
    if spread:  # numbers have no order
        last = F.max(told(F.when(F.col("renamed"), F.struct(*ORDER, "parent_span_id", "service", "nth"))))["nth"]
    else:
        last = F.max(told(F.col("nth")))
    m = ask_by_id(m, keys, [F.col("span_id")], [F.col("p")], {"heir": last}, spread)
    led = F.col("heir").isNotNull() & ~F.coalesce(F.col("nth") == F.col("heir"), F.lit(False))
    own = [F.col("renamed"), F.coalesce(F.col("nth").cast("long"), F.col("span_id"))]
    asked = [led, F.when(led, F.col("heir").cast("long")).otherwise(F.col("p"))]
    # the order of spans by their new ids equals dedupe_span_ids' order where times differ
    return _edges(ask_by_id(m, keys, own, asked, {"last": F.max(told(F.struct(*ORDER, "service")))}, spread), keys)


def _edges(linked: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    known = linked.where("last.service is not null")
    return known.select(*keys, "sid", "session_end", F.col("last.service").alias("parent"), F.col("service").alias("child"))


def calls(edges: DataFrame, window_minutes: int = 30) -> DataFrame:
    """(window_end, parent, child, call_count): each edge as a call, to be added."""
    return edges.select(tumble("session_end", window_minutes)[1].alias("window_end"), "parent", "child", F.lit(1).cast("long").alias("call_count"))


def call_counts(edges: DataFrame, window_minutes: int = 30) -> DataFrame:
    """(window_start, window_end, parent, child, call_count)."""
    start, end = tumble("session_end", window_minutes)
    return edges.groupBy(start.alias("window_start"), end.alias("window_end"), "parent", "child").agg(F.count("*").alias("call_count"))


def dependencies_rollup(counts: DataFrame, run_ts: str | None = None) -> DataFrame:
    """(dependencies, ts, ts_bucket): one row per window with all its pairs, in order.

    Input may hold several partial counts of a pair; they are added. ``run_ts`` replaces the window's
    end as the time of the row.
    """
    pairs = counts.groupBy("window_end", "parent", "child").agg(F.sum("call_count").alias("call_count"))
    entry = F.struct("parent", "child", "call_count", F.lit(SOURCE).alias("source"))
    rows = pairs.groupBy("window_end").agg(F.sort_array(F.collect_list(entry)).alias("dependencies"))
    ts = F.lit(run_ts).cast("timestamp") if run_ts else F.col("window_end")
    return rows.select("dependencies", ts.alias("ts"), F.date_trunc("DAY", ts).alias("ts_bucket"))
