"""Column expressions that read one nested span; built-in functions only.

Null arrays count as empty. Names are matched as each job matches them: dependencies compare tag
names and reference types exactly, paths and quality ignore the case of reference types, quality
also that of tag names and values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _last(array: Column, keep) -> Column:
    return F.try_element_at(F.filter(array, keep), F.lit(-1))


def resolve_parent(any_case: bool) -> Column:
    """parentSpanId if not null (even 0), else the span of the last child_of reference, else 0."""
    kind = (lambda r: F.lower(r["refType"])) if any_case else (lambda r: r["refType"])
    return F.coalesce("parentSpanId", _last(F.col("references"), lambda r: kind(r) == "child_of")["spanId"], F.lit(0).cast("long"))


def has_kind(value: str, any_case: bool) -> Column:
    """Whether any span.kind tag has the value; a span can be client and server."""
    fold = F.lower if any_case else (lambda c: c)
    return F.coalesce(F.exists("tags", lambda t: F.coalesce((fold(t["key"]) == "span.kind") & (fold(t["vStr"]) == value), F.lit(False))), F.lit(False))


def span_kind() -> Column:
    """SERVER, CLIENT, LOCAL or UNKNOWN by the last span.kind tag; null without such a tag."""
    tag = _last(F.col("tags"), lambda t: t["key"] == "span.kind")
    value = F.lower(tag["vStr"])
    known = F.when(value.isin("server", "client", "local"), F.upper(value)).otherwise(F.lit("UNKNOWN"))
    return F.when(tag.isNotNull(), known)


def peer_service() -> Column:
    """The last peer.service tag that has a string, in lower case."""
    return F.lower(_last(F.col("tags"), lambda t: (F.lower(t["key"]) == "peer.service") & t["vStr"].isNotNull())["vStr"])


def client_version() -> Column:
    """The last jaeger.version tag of the process that has a string."""
    return _last(F.col("process.tags"), lambda t: (F.lower(t["key"]) == "jaeger.version") & t["vStr"].isNotNull())["vStr"]


def event_time(us: Column | str) -> Column:
    """Timestamp in whole milliseconds of a time in microseconds."""
    return F.timestamp_millis(F.expr(f"{us} div 1000") if isinstance(us, str) else F.floor(us / 1000))


def trace_id_hex(low: Column | str) -> Column:
    """Unsigned lower-case hex without leading zeros."""
    return F.lower(F.hex(low))


def least_trace_id_hex(low: Column | str) -> Column:
    """Aggregate: the least trace_id_hex of a group, as text.

    Numbers are compared instead of texts, so that groups can be hashed: an id of up to 15 hex digits
    is moved to the left and its number of digits put behind, which sorts as its text does; ids of 16
    digits sort as unsigned numbers.
    """
    low = F.col(low) if isinstance(low, str) else low
    shift = lambda name, value, by: F.call_function(name, value, by.cast("int"))
    flip = F.lit(-(2**63)).cast("long")  # signed order of what is unsigned
    digits = F.length(F.hex(low))
    moved = F.shiftleft(shift("shiftleft", low, 4 * (15 - digits)), 4).bitwiseOR(digits.cast("long"))
    short, long = F.min(F.when(digits <= 15, moved.bitwiseXOR(flip))).bitwiseXOR(flip), F.min(F.when(digits > 15, low.bitwiseXOR(flip))).bitwiseXOR(flip)
    back = shift("shiftrightunsigned", F.shiftrightunsigned(short, 4), 4 * (15 - short.bitwiseAND(F.lit(15).cast("long"))))
    return F.least(trace_id_hex(back), trace_id_hex(long))


def _common(any_case: bool) -> list[Column]:
    return [
        F.coalesce("traceIdHigh", F.lit(0).cast("long")).alias("trace_id_high"),
        F.col("traceIdLow").alias("trace_id_low"),
        F.col("spanId").alias("span_id"),
        resolve_parent(any_case).alias("parent_span_id"),
        F.col("process.serviceName").alias("service"),
        F.col("startTime").alias("start_time_us"),
        event_time("startTime").alias("ts"),
    ]


def flatten_spans_dependencies(nested: DataFrame) -> DataFrame:
    """The columns that the dependency job needs; the rest is pruned before any shuffle."""
    return nested.select(*_common(False), has_kind("server", False).alias("is_server"), has_kind("client", False).alias("is_client"))


def flatten_spans_paths(nested: DataFrame) -> DataFrame:
    """The columns that the path job needs."""
    return nested.select(*_common(True), F.col("operationName").alias("operation"), span_kind().alias("span_kind"))


def flatten_spans_quality(nested: DataFrame) -> DataFrame:
    """The columns that the quality job needs."""
    return nested.select(
        *_common(True), peer_service().alias("peer_service"), has_kind("server", True).alias("is_server"), has_kind("client", True).alias("is_client"), client_version().alias("client_version")
    )
