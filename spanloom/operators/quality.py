"""Instrumentation quality: rules that score spans and traces, and their counters.

A span rule is a Column of array<struct<service, metric, submetric>> over annotated spans. A trace rule
is a pair: a function that adds to annotated spans what the rule must know of other spans of the trace,
and such a Column over the result. Both kinds are plain lists, so a job takes more of either; all
columns are evaluated on the same rows and exploded once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spans import least_trace_id_hex, trace_id_hex
from ..functions.versions import meets_minimum
from .sessions import ORDER, ask_by_id, over_id, told

PASS, FAIL = "PASS", "FAIL"
HAS_CLIENT, HAS_SERVER = "HasClientSpans", "HasServerSpans"
UNIQUE_IDS, CLIENT_VERSION, MINIMUM_VERSION = "HasUniqueSpanIds", "ClientVersion", "MinimumClientVersionCheck"

SpanRule = Callable[[tuple[str, ...]], Column]


class TraceRule(NamedTuple):
    """``prepare`` keeps one row per span and its columns; ``scores`` may use those that it adds.
    ``spread`` does the same for spans of hot traces, which aren't dealt by trace key."""

    prepare: Callable[[DataFrame, tuple[str, ...]], DataFrame]
    scores: SpanRule
    spread: Callable[[DataFrame, tuple[str, ...]], DataFrame] | None = None


def score(service, metric: str, submetric) -> Column:
    """One score."""
    return F.struct(F.col(service).alias("service") if isinstance(service, str) else service.alias("service"), F.lit(metric).alias("metric"), (F.lit(submetric) if isinstance(submetric, str) else submetric).alias("submetric"))


def score_client_version(keys) -> Column:
    """The version itself as submetric, for spans that have one."""
    return F.array(score("service", CLIENT_VERSION, F.col("client_version")))


def score_minimum_client_version(keys) -> Column:
    """PASS if the client version meets its language's minimum, else FAIL."""
    return F.array(score("service", MINIMUM_VERSION, F.when(meets_minimum(F.col("client_version")), PASS).otherwise(FAIL)))


def score_unique_span_id(keys) -> Column:
    """PASS if the span's id is used once in its trace session, else FAIL."""
    n = F.count("*").over(Window.partitionBy(*keys, "sid", "span_id"))
    return F.array(score("service", UNIQUE_IDS, F.when(n == 1, PASS).otherwise(FAIL)))


def _unique_among(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return spans if "__same_id" in spans.columns else over_id(spans, keys, {"__same_id": F.count("*")}, spread=True)


#: score_unique_span_id for hot traces.
_SPREAD_UNIQUE = TraceRule(_unique_among, lambda keys: F.array(score("service", UNIQUE_IDS, F.when(F.col("__same_id") == 1, PASS).otherwise(FAIL))), _unique_among)


def with_relatives(spans: DataFrame, keys: tuple[str, ...], spread: bool = False) -> DataFrame:
    """spans with child (the first span of its own id) and parent (the first one of its parent's id, or
    null for orphans and roots), as structs of service, peer_service, is_client, is_server. With ``spread``
    what is told of an id, the number of its spans too (__same_id), is found once, from spans themselves:
    a look-up among looked-up rows would move them all again."""
    fields = F.struct("service", "peer_service", "is_client", "is_server")
    ranked = F.struct(*ORDER, "parent_span_id", "service", fields.alias("s"))
    if spread:
        trace = [*keys, "sid"]
        ids = spans.groupBy(*trace, "span_id").agg(F.min(ranked)["s"].alias("child"), F.count("*").alias("__same_id"))
        above = ids.select(*trace, F.col("span_id").alias("parent_span_id"), F.col("child").alias("parent"))
        return spans.join(ids, [*trace, "span_id"]).join(above, [*trace, "parent_span_id"], "left")
    first = over_id(spans, keys, {"__own": F.min(ranked)})
    linked = ask_by_id(first, keys, [F.col("span_id")], [F.col("parent_span_id")], {"__above": F.min(told(ranked))})
    return linked.withColumns({"child": F.col("__own.s"), "parent": F.col("__above.s")}).drop("__own", "__above")


def parent_child_pairs(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, sid, session_end, child, parent) for every span; see with_relatives."""
    return with_relatives(spans, keys).select(*keys, "sid", "session_end", "child", "parent")


def orphan_spans(spans: DataFrame, keys: tuple[str, ...], spread: bool = False) -> DataFrame:
    """Spans whose parent id no span of their trace session has."""
    linked = ask_by_id(spans, keys, [F.col("span_id")], [F.col("parent_span_id")], {"known": F.max(told(F.lit(True)))}, spread)
    return linked.where("known is null").drop("known")


def client_server_scores(keys=()) -> Column:
    """Scores of (child, parent) pairs, whether calls have both their client and their server span; a
    child without a parent counts as a root."""
    c, p = F.col("child"), F.col("parent")
    own = lambda metric, sub: score(c["service"], metric, sub)
    peer = lambda metric: score(c["peer_service"], metric, FAIL)
    none = F.array().cast("array<struct<service: string, metric: string, submetric: string>>")
    root = F.when(c["is_client"], F.array(peer(HAS_SERVER), own(HAS_CLIENT, PASS))).when(c["is_server"], F.array(peer(HAS_CLIENT), own(HAS_SERVER, PASS))).otherwise(none)
    below_client = F.concat(F.when(c["is_server"], F.array(own(HAS_SERVER, PASS))).otherwise(none), F.when(c["is_client"], F.array(own(HAS_SERVER, FAIL))).otherwise(none))
    at_fault = score(F.coalesce(c["peer_service"], c["service"]), HAS_CLIENT, FAIL)
    below_server = F.concat(F.when(c["is_client"], F.array(own(HAS_CLIENT, PASS))).otherwise(none), F.when(c["is_server"], F.array(at_fault)).otherwise(none))
    return F.when(p.isNull(), root).when(p["is_client"], below_client).when(p["is_server"], below_server).otherwise(none)


score_has_client_server = TraceRule(with_relatives, client_server_scores, partial(with_relatives, spread=True))


SPAN_RULES: tuple[SpanRule, ...] = (score_client_version, score_minimum_client_version, score_unique_span_id)
TRACE_RULES: tuple[TraceRule, ...] = (score_has_client_server,)


def score_guard(scores: DataFrame) -> DataFrame:
    """Scores with a service, metric and submetric; nulls and empty names go."""
    return scores.where("service <> '' and metric <> '' and submetric <> ''")


def score_all(spans: DataFrame, keys: tuple[str, ...] = ("trace_id_low",), span_rules: Sequence[SpanRule] = SPAN_RULES, trace_rules: Sequence[TraceRule] = TRACE_RULES, spread: bool = False) -> DataFrame:
    """(time_bucket, service, metric, submetric, trace_id, trace_id_low, session_end): every score of every
    rule. With ``spread`` the built-in rules are evaluated without dealing the spans by trace key."""
    if spread and score_unique_span_id in span_rules:
        span_rules = [r for r in span_rules if r is not score_unique_span_id]
        trace_rules = [*trace_rules, _SPREAD_UNIQUE]
    columns = [r(keys) for r in span_rules]
    scored = {f"__s{n}": c for n, c in enumerate(columns)}
    # what span rules count over a span's id is sorted like what a trace rule asks of it; with spread their
    # scores come last, not to be moved
    rows = spans if spread else spans.withColumns(scored)
    for rule in trace_rules:
        rows = (rule.spread if spread and rule.spread else rule.prepare)(rows, keys)
    rows = rows.withColumns(scored) if spread else rows
    scores = F.concat(*[F.col(f"__s{n}") for n in range(len(columns))], *[rule.scores(keys) for rule in trace_rules])
    every = rows.select(*keys, "sid", "session_end", F.explode(scores).alias("s")).select(*keys, "sid", "session_end", "s.*")
    bucket = F.date_trunc("HOUR", F.timestamp_millis("sid"))
    return score_guard(every).select(bucket.alias("time_bucket"), "service", "metric", "submetric", trace_id_hex(keys[-1]).alias("trace_id"), F.col(keys[-1]).alias("trace_id_low"), "session_end")


def quality_counts(scores: DataFrame) -> DataFrame:
    """(service, time_bucket, metric, submetric, count, trace_id): summed by bucket, least trace id."""
    return scores.groupBy("service", "time_bucket", "metric", "submetric").agg(F.count("*").alias("count"), least_trace_id_hex("trace_id_low").alias("trace_id"))
