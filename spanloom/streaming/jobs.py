"""The jobs as streams: sessions as windows, one trace step when a session closes, append output.

Streams allow neither row_number nor self-joins inside a session, so here the trace steps are functions
of a session's spans in order, that run in time linear to the trace.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import least_trace_id_hex
from ..functions.versions import MINIMUM
from ..operators import paths, sizes
from ..operators.dependencies import SOURCE
from ..operators.quality import CLIENT_VERSION, FAIL, HAS_CLIENT, HAS_SERVER, MINIMUM_VERSION, PASS, UNIQUE_IDS
from .sessions import large_traces as open_large_traces
from .sessions import sessions, trace_sessions, trace_sessions_and_late

#: Minutes that a span may be late.
WATERMARK = 10


def adjusted(spans) -> list[dict]:
    """The spans of one trace with shared server ids renamed and parents led to them."""
    out = [dict(s) for s in spans]
    clients = {s["span_id"] for s in out if s["is_client"]}
    used = {x for s in out for x in (s["span_id"], s["parent_span_id"])}
    fresh, heirs = 0, {}
    for s in out:
        if s["is_server"] and s["span_id"] in clients:
            fresh += 1
            while fresh in used:
                fresh += 1
            heirs[s["span_id"]] = fresh
            s["parent_span_id"], s["span_id"] = s["span_id"], fresh
    for s in out:
        heir = heirs.get(s["parent_span_id"])
        if heir is not None and heir != s["span_id"]:
            s["parent_span_id"] = heir
    return out


def edges_of(spans) -> list[tuple[str, str]]:
    """(parent service, child service) for every call of one adjusted trace."""
    service = {s["span_id"]: s["service"] for s in spans}
    return [(p, s["service"]) for s in spans if (p := service.get(s["parent_span_id"])) is not None]


def _calls(spans) -> Iterable[tuple[str, str]]:
    return edges_of(adjusted(spans))


def dependency_counts(spans: DataFrame, gap: int = 3, window: str = "30 minutes", watermark: float = WATERMARK) -> DataFrame:
    """(window, parent, child, call_count) from flat dependency spans."""
    kept = spans.where("is_client or is_server")
    edges = trace_sessions(kept, ("trace_id_high", "trace_id_low"), gap, ("is_server", "is_client"), _calls, "parent string, child string", watermark)
    return edges.groupBy(F.window("at", window).alias("window"), "parent", "child").agg(F.count("*").alias("call_count"))


def dependency_counts_and_late(spans: DataFrame, gap: int = 3, window: str = "30 minutes", watermark: float = WATERMARK) -> DataFrame:
    """(window, parent, child, call_count, late_trace, late): dependency_counts, with late_trace null and late
    0; and for each trace with spans that came too late for its sessions their number by the window of
    the watermark at which they came, under the trace's ids in hex. A sink tells the two by late. The gap
    is shorter than the window."""
    kept = spans.where("is_client or is_server")
    rows = trace_sessions_and_late(kept, ("trace_id_high", "trace_id_low"), gap, ("is_server", "is_client"), _calls, "parent string, child string", watermark)
    trace = F.when(F.col("late") > 0, F.concat_ws(":", F.lower(F.hex("trace_id_high")), F.lower(F.hex("trace_id_low"))))
    # windows are set on by the gap, as the times are
    counted = rows.groupBy(F.window("at", window, startTime=f"{gap} minutes").alias("w"), "parent", "child", trace.alias("late_trace"))
    counts = counted.agg(F.sum((F.col("late") == 0).cast("long")).alias("call_count"), F.sum("late").alias("late"))
    back = F.struct(*[(F.col(f"w.{end}") - F.expr(f"INTERVAL {gap} MINUTES")).alias(end) for end in ("start", "end")])
    return counts.select(back.alias("window"), "parent", "child", "late_trace", "call_count", "late")


def _orphans(spans) -> Iterator[tuple[int, int, int]]:
    known = {s["span_id"] for s in spans}
    return ((s["span_id"], s["parent_span_id"], s["start_time_us"]) for s in spans if s["parent_span_id"] not in known)


def orphan_spans(spans: DataFrame, gap: int = 3, watermark: float = WATERMARK) -> DataFrame:
    """(trace_id_low, sid, span_id, parent_span_id, start_time_us) of the quality job's spans whose parent is
    not in their trace session, once that has closed."""
    kept = spans.where("is_client or is_server")
    return trace_sessions(kept, ("trace_id_low",), gap, (), _orphans, "span_id long, parent_span_id long, start_time_us long", watermark).drop("at")


def large_traces(spans: DataFrame, gap: int = 3, threshold: int = 80_000, watermark: float = WATERMARK) -> DataFrame:
    """(trace_id_high, trace_id_low, sid, n) of the dependency job's traces as soon as they are large."""
    return open_large_traces(spans.where("is_client or is_server"), ("trace_id_high", "trace_id_low"), gap, threshold, watermark)


def dependencies_stream(spans: DataFrame, window: str = "30 minutes", **options) -> DataFrame:
    """(dependencies, ts, ts_bucket): one row per window, once it has closed."""
    counts = dependency_counts(spans, window=window, **options)
    entry = F.struct("parent", "child", "call_count", F.lit(SOURCE).alias("source"))
    rows = counts.groupBy(F.window(F.window_time("window"), window).alias("w")).agg(F.sort_array(F.collect_list(entry)).alias("dependencies"))
    return rows.select("dependencies", F.col("w.end").alias("ts"), F.date_trunc("DAY", "w.end").alias("ts_bucket"))


def _walked(spans) -> Iterator[tuple]:
    return ((p,) for p in paths.walk(spans))


def paths_stream(spans: DataFrame, gap: int = 5, window: str = "10 minutes", watermark: float = WATERMARK) -> DataFrame:
    """Index rows of flat path spans."""
    found = trace_sessions(spans, ("trace_id_low",), gap, ("operation", "span_kind"), _walked, f"p array<{paths.NODE}>", watermark)
    capped = found.withColumn("path", paths.path_length_cap(F.col("p")))
    unique = capped.groupBy(F.window("at", window).alias("w"), "path").agg(least_trace_id_hex("trace_id_low").alias("trace_id"))
    return paths.focal_node_index(unique.withColumn("window_end", F.col("w.end")))


def _new_enough(version: str | None) -> bool:
    parts = (version or "").lower().rstrip("-").split("-")
    if len(parts) != 2 or parts[0] not in MINIMUM or not all(p.isascii() and p.isdigit() for p in parts[1].split(".")):
        return False
    for have, need in zip(parts[1].split("."), MINIMUM[parts[0]].split("."), strict=False):
        if int(have) >= 2**31:
            return False
        if int(have) != int(need):
            return int(have) > int(need)
    return True


Score = tuple[str, str, str]
#: (service, metric, submetric) of the scores that a rule gives one trace, whose spans come in order as dicts.
Rule = Callable[[Sequence[dict]], Iterable[Score]]


def score_client_version(spans) -> Iterator[Score]:
    for s in spans:
        yield s["service"], CLIENT_VERSION, s["client_version"]


def score_minimum_client_version(spans) -> Iterator[Score]:
    for s in spans:
        yield s["service"], MINIMUM_VERSION, PASS if _new_enough(s["client_version"]) else FAIL


def score_unique_span_id(spans) -> Iterator[Score]:
    count: dict[int, int] = defaultdict(int)
    for s in spans:
        count[s["span_id"]] += 1
    for s in spans:
        yield s["service"], UNIQUE_IDS, PASS if count[s["span_id"]] == 1 else FAIL


def score_has_client_server(spans) -> Iterator[Score]:
    first: dict[int, dict] = {}
    for s in spans:
        first.setdefault(s["span_id"], s)
    for s in spans:
        child, parent = first[s["span_id"]], first.get(s["parent_span_id"])
        own, peer = child["service"], child["peer_service"]
        if parent is None:
            if child["is_client"]:
                yield peer, HAS_SERVER, FAIL
                yield own, HAS_CLIENT, PASS
            elif child["is_server"]:
                yield peer, HAS_CLIENT, FAIL
                yield own, HAS_SERVER, PASS
        elif parent["is_client"]:
            if child["is_server"]:
                yield own, HAS_SERVER, PASS
            if child["is_client"]:
                yield own, HAS_SERVER, FAIL
        elif parent["is_server"]:
            if child["is_client"]:
                yield own, HAS_CLIENT, PASS
            if child["is_server"]:
                yield own if peer is None else peer, HAS_CLIENT, FAIL


RULES: tuple[Rule, ...] = (score_client_version, score_minimum_client_version, score_unique_span_id, score_has_client_server)


def scores_of(spans, rules: Sequence[Rule] = RULES) -> list[Score]:
    """Every score of one trace by some rules; those with a null or empty part are left out."""
    return [x for rule in rules for x in rule(spans) if all(x)]


def quality_stream(spans: DataFrame, gap: int = 3, window: str = "1 hour", watermark: float = WATERMARK, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Partial quality_metrics rows: a bucket may come from two windows, so the sink has to add them.

    ``rules`` are functions of one trace; a job takes more than the four, or others.
    """
    kept, fields = spans.where("is_client or is_server"), ("peer_service", "is_server", "is_client", "client_version")
    scores = trace_sessions(kept, ("trace_id_low",), gap, fields, partial(scores_of, rules=tuple(rules)), "service string, metric string, submetric string", watermark)
    named = scores.withColumns({"time_bucket": F.date_trunc("HOUR", F.timestamp_millis("sid")), "trace_id": F.lower(F.hex("trace_id_low"))})
    rows = named.groupBy(F.window("at", window).alias("w"), "service", "time_bucket", "metric", "submetric")
    return rows.agg(F.count("*").alias("count"), F.min("trace_id").alias("trace_id")).drop("w")


def trace_sizes(spans: DataFrame, gap: int = 3, window: str = "30 minutes", watermark: float = WATERMARK, accuracy: float = sizes.ACCURACY) -> DataFrame:
    """(window_start, window_end, bucket, traces): the sketch of the sizes of traces that end in each
    window, from flat dependency spans."""
    kept = spans.where("is_client or is_server")
    each = sessions(kept, ("trace_id_high", "trace_id_low"), gap, watermark).agg(F.count("*").alias("size"))
    rows = each.groupBy(F.window(F.window_time("session_window"), window).alias("w"), sizes.bucket("size", accuracy).alias("bucket")).agg(F.count("*").alias("traces"))
    return rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bucket", "traces")


def run_available(stream: DataFrame, write, checkpoint: str, partitions: int | None = None, settings: dict[str, str] | None = None):
    """Process what there is and stop: each micro-batch goes to write(rows, batch_id).

    Each operator with state has a store in each of ``partitions``, which it opens and commits in each
    micro-batch, however little it holds; without a number there are as many as tasks run at once. A
    checkpoint keeps the number that it began with. ``settings`` are Spark's, for this run alone."""
    spark = stream.sparkSession
    wanted = {"spark.sql.shuffle.partitions": partitions or spark.sparkContext.defaultParallelism, **(settings or {})}
    before = {name: spark.conf.get(name) for name in wanted}
    try:  # (the stream takes a copy of the session when it starts)
        for name, value in wanted.items():
            spark.conf.set(name, value)
        query = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    query.awaitTermination()
    return query
