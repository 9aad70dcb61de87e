"""The batch jobs: flat spans in, result tables out.

Each job takes ``hot_spans``: trace keys with more spans than that are worked on without dealing their
spans by key (see operators.sessions); None leaves that out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import dependencies, paths, quality, report
from ..operators.dedupe import dedupe_span_ids
from ..operators.sessions import HOT_SPANS, ROW, annotate_sessions, bounded_tasks, deal, hot_sessions, split_hot
from ..sources.shared import written
from ..sources.tables import read_quality

HIGH_LOW, LOW = ("trace_id_high", "trace_id_low"), ("trace_id_low",)
#: Spans of a trace key from which the path job doesn't hold its traces in one task.
LARGE_TRACE = 80_000


def filter_local_spans(spans: DataFrame) -> DataFrame:
    """Client and server spans; done before sessions are formed, which local spans must not prolong."""
    return spans.where("is_client or is_server")


def drop_untraced(spans: DataFrame) -> DataFrame:
    """Spans of a trace: those without an id, which the wire format shows as 0, would all be one trace.
    The jobs keep them, as a trace may have the id 0; call this first where none has."""
    return spans.where("trace_id_low <> 0 or trace_id_high <> 0")


def _in_sessions(spans: DataFrame, keys: tuple[str, ...], gap: int, hot_spans: int | None, step: Callable[[DataFrame, bool], DataFrame], total: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What step(spans in their sessions, whether they are those of hot traces) gives for all spans. They are
    counted and dealt by trace key to as many tasks as there are TASK_SPANS spans, so a task's memory
    doesn't grow with them. ``total`` makes a few rows of all that; where there are hot traces these are
    written, as joins of bounded tasks can only be had while they run."""
    count = spans.count()
    with bounded_tasks(spans.sparkSession, count):
        cold, hot = split_hot(spans, keys, hot_spans, count)
        rows = step(annotate_sessions(deal(cold, count, *keys), keys, gap), False)
        if hot is not None:
            rows = rows.unionByName(step(hot_sessions(hot, keys, gap), True))
        if total is None:
            return rows
        return total(rows) if hot is None else written(total(rows), "total")


def _plain(traces: DataFrame, hot: bool) -> DataFrame:
    return traces.drop(ROW)


def _dependency_spans(spans: DataFrame) -> DataFrame:
    return filter_local_spans(spans).select(*HIGH_LOW, "span_id", "parent_span_id", "service", "is_server", "is_client", "start_time_us")


def dependency_sessions(spans: DataFrame, gap: int = 3, hot_spans: int | None = HOT_SPANS) -> DataFrame:
    """Client and server spans of the dependency job in their sessions."""
    return _in_sessions(_dependency_spans(spans), HIGH_LOW, gap, hot_spans, _plain)


def _from_edges(spans: DataFrame, dedupe: bool, gap: int, hot_spans: int | None, total: Callable[[DataFrame], DataFrame]) -> DataFrame:
    find = dependencies.deduped_edges if dedupe else dependencies.trace_edges
    return _in_sessions(_dependency_spans(spans), HIGH_LOW, gap, hot_spans, lambda traces, hot: find(traces, HIGH_LOW, hot), total)


def dependency_counts(spans: DataFrame, dedupe: bool = True, gap: int = 3, window: int = 30, hot_spans: int | None = HOT_SPANS) -> DataFrame:
    """(window_start, window_end, parent, child, call_count)."""
    return _from_edges(spans, dedupe, gap, hot_spans, lambda edges: dependencies.call_counts(edges, window))


def dependencies_job(spans: DataFrame, run_ts: str | None = None, gap: int = 3, hot_spans: int | None = HOT_SPANS) -> DataFrame:
    """One row per 30-minute window with all its service pairs, which are counted once, for the row."""
    return _from_edges(spans, True, gap, hot_spans, lambda edges: dependencies.dependencies_rollup(dependencies.calls(edges), run_ts))


def _path_spans(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return spans.select(*keys, "span_id", "parent_span_id", "service", "operation", "span_kind", "start_time_us")


def path_sessions(spans: DataFrame, gap: int = 5, hot_spans: int | None = HOT_SPANS, keys: tuple[str, ...] = LOW) -> DataFrame:
    """All spans of the path job in their sessions."""
    return _in_sessions(_path_spans(spans, keys), keys, gap, hot_spans, _plain)


def unique_paths(spans: DataFrame, dedupe: bool = False, gap: int = 5, window: int = 10, hot_spans: int | None = LARGE_TRACE, keys: tuple[str, ...] = LOW) -> DataFrame:
    """(window_start, window_end, path, trace_id). ``dedupe`` first tells shared span ids apart (in one task
    for each trace session). Traces go by the low half of their id, or with HIGH_LOW as keys by both."""

    def found(traces: DataFrame, hot: bool) -> DataFrame:
        if dedupe:
            flags = traces.selectExpr("*", "coalesce(span_kind = 'CLIENT', false) is_client", "coalesce(span_kind = 'SERVER', false) is_server")
            traces = dedupe_span_ids(flags, keys).drop("renamed", "is_client", "is_server")
        return paths.trace_paths(traces, keys, spread=hot, dealt=not hot)

    return paths.dedupe_paths(_in_sessions(_path_spans(spans, keys), keys, gap, hot_spans, found), window, keys[-1])


def paths_job(spans: DataFrame, dedupe: bool = False, **options) -> DataFrame:
    """Index rows of every path for every service and operation on it; ``options`` are unique_paths'."""
    return paths.focal_node_index(unique_paths(spans, dedupe, **options))


def _quality_spans(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return filter_local_spans(spans).select(*keys, "span_id", "parent_span_id", "service", "peer_service", "is_server", "is_client", "client_version", "start_time_us")


def quality_sessions(spans: DataFrame, gap: int = 3, hot_spans: int | None = HOT_SPANS, keys: tuple[str, ...] = LOW) -> DataFrame:
    """Client and server spans of the quality job in their sessions."""
    return _in_sessions(_quality_spans(spans, keys), keys, gap, hot_spans, _plain)


def quality_job(spans: DataFrame, hot_spans: int | None = HOT_SPANS, gap: int = 3, keys: tuple[str, ...] = LOW, **rules) -> DataFrame:
    """quality_metrics rows: counters by hour, service, metric and submetric. Traces go by the low half of
    their id, or with HIGH_LOW as keys by both."""
    scores = _in_sessions(_quality_spans(spans, keys), keys, gap, hot_spans, lambda traces, hot: quality.score_all(traces, keys, spread=hot, **rules))
    return quality.quality_counts(scores)


def report_job(spark: SparkSession, path: str, now, hours: int, service: str | None = None) -> DataFrame:
    """The report on the last hours before ``now`` of a written quality_metrics table, for one service
    or all, in its order; only the days of these hours are read."""
    rows = report.recent(read_quality(spark, path, service, report.hours_before(now, hours)), now, hours)
    return report.sorted_metrics(report.service_metrics_report(rows))
