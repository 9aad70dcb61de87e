"""Trace sessions in streams.

The spans of a trace session are one row of Spark's own session windows, which are merged, kept and
closed inside Spark; only what a trace step makes of a closed session runs in Python, on Arrow batches
of many sessions. There is no call into Python for each trace and micro-batch. An open session's spans
are written again in each micro-batch that adds to them.

What session windows can't tell is found by keyed state over buckets of traces: which spans are late
(``trace_sessions_and_late``), and which open sessions have become large (``large_traces``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Commits write what has changed instead of the whole store.
CHANGES_KEY = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
#: Off: each write of a row would look first whether it is new, for a count of the rows that nobody reads.
TOTAL_KEY = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
#: Groups of traces that share a state.
BUCKETS = 1024
#: From the spans of a session, as dicts in order, to rows (tuples in the order of the output's columns).
Step = Callable[[list[dict]], Iterable[tuple]]


def merged(intervals: list[tuple[int, int]], times: Iterable[int], gap: int) -> list[tuple[int, int]]:
    """The sessions (first, last) of a trace when spans at some times come to those it has; spans exactly
    one gap apart are in one session."""
    out: list[tuple[int, int]] = []
    for first, last in sorted([*intervals, *((t, t) for t in times)]):
        if out and first - out[-1][1] <= gap:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def _store(spans: DataFrame) -> None:
    conf = spans.sparkSession.conf
    if "RocksDB" not in conf.get(STORE_KEY, ""):
        conf.set(STORE_KEY, ROCKS_DB)  # state on disk, with timers
        conf.set(CHANGES_KEY, "true")
        conf.set(TOTAL_KEY, "false")


def sessions(spans: DataFrame, keys: tuple[str, ...], gap_minutes: int, watermark_minutes: float) -> GroupedData:
    """A stream's spans grouped by keys and session_window, that ends the gap after its last span (ms)."""
    _store(spans)
    timed = spans.withColumn("__at", F.timestamp_millis(F.expr("start_time_us div 1000"))).withWatermark("__at", f"{int(watermark_minutes * 60_000)} milliseconds")
    return timed.groupBy(*keys, F.session_window("__at", f"{gap_minutes} minutes"))


def _made(step: Step, names: list[str], result: T.StructType) -> Callable[..., Column]:
    """A function of a column of sessions' spans, in order: the rows that ``step`` makes of each. Spans come
    out of Arrow, and rows go into it, as columns of all sessions of a batch."""
    kind = T.ArrayType(result)
    arrow = to_arrow_type(kind)
    fields = list(arrow.value_type)

    @F.arrow_udf(returnType=kind)
    def made(spans: pa.Array) -> pa.Array:
        values = spans.flatten()
        each = zip(*(values.field(i).to_pylist() for i in range(len(names))), strict=True)
        rows, ends = [], [0]
        for n in spans.value_lengths().to_pylist():
            if n:
                rows.extend(step([dict(zip(names, s, strict=True)) for s in islice(each, n)]))
            ends.append(len(rows))
        columns = zip(*rows, strict=True) if rows else [()] * len(fields)
        made_ = [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(made_, fields=fields), type=arrow)

    return made


def _spans(span: Column) -> Column:
    """Aggregate: the spans of a session in order, nulls first."""
    return F.sort_array(F.collect_list(span)).alias("spans")


def _names(fields: tuple[str, ...]) -> list[str]:
    return ["start_time_us", "span_id", "parent_span_id", "service", *fields]


def trace_sessions(spans: DataFrame, keys: tuple[str, ...], gap_minutes: int, fields: tuple[str, ...], step: Step, result: str, watermark_minutes: float) -> DataFrame:
    """(keys, sid, at, and the columns of ``result``, DDL): what ``step`` makes of each closed session of a
    stream of spans(keys, start_time_us, span_id, parent_span_id, service, ``fields``).

    sid is the session's first span (ms); at is the event time of what it gives, just before its end. A
    span is late when the session that it would be alone has ended; late spans are dropped.
    """
    names, wanted = _names(fields), T.StructType.fromDDL(result)
    closed = sessions(spans, keys, gap_minutes, watermark_minutes).agg(_spans(F.struct(*names)))
    made = _made(step, names, wanted)
    rows = closed.select(*keys, "session_window", F.window_time("session_window").alias("at"), F.explode(made("spans")).alias("r"))
    return rows.select(*keys, F.unix_millis("session_window.start").alias("sid"), "at", "r.*")


class _Late(StatefulProcessor):
    """Rows (keys, ms, span), each with its event time and, if it is late, the watermark at which it came."""

    def __init__(self, columns: list[str], gap: int):
        self.columns, self.gap = columns, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for df in rows:
            until = df["ms"].to_numpy() + self.gap
            late = until <= now
            out = df[self.columns].copy()
            at = np.where(late, now + 1, until)  # Spark takes no times up to the watermark
            out["until"] = pd.DatetimeIndex((at * 1000).astype("datetime64[us]"), tz="UTC")  # (nanoseconds end in 2262)
            out["late_at"] = np.where(late, now, -1)
            yield out


def trace_sessions_and_late(spans: DataFrame, keys: tuple[str, ...], gap_minutes: int, fields: tuple[str, ...], step: Step, result: str, watermark_minutes: float) -> DataFrame:
    """trace_sessions with a column late, 0 for what sessions give; and for each trace and batch with spans
    that come after the watermark has passed the end of their own sessions a row with their number and
    nulls, whose at is that of the watermark. They aren't in any session. at is one gap later than in
    trace_sessions, for sessions and late spans alike, as each span's event time is here the end of its own
    session."""
    _store(spans)
    names, gap, wanted = _names(fields), gap_minutes * 60_000, T.StructType.fromDDL(result)
    ms = F.expr("start_time_us div 1000")
    # a span goes as text, which keeps nulls and whole numbers whatever pandas makes of them
    shape = spans.select(*names).schema
    known = spans.select(*keys, ms.alias("ms"), F.to_json(F.struct(*names)).alias("span"), F.timestamp_millis(ms).alias("at"), F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("bucket"))
    # without their time when they get there, as Spark would drop late rows before they are told of
    known = known.withWatermark("at", f"{int(watermark_minutes * 60_000)} milliseconds").drop("at")
    columns = [*keys, "span"]
    out = T.StructType([*(known.schema[c] for c in columns), T.StructField("until", T.TimestampType()), T.StructField("late_at", T.LongType())])
    timed = known.groupBy("bucket").transformWithStateInPandas(_Late(columns, gap), out, "Append", "EventTime", eventTimeColumnName="until")
    on_time = F.when(F.col("late_at") < 0, F.from_json("span", shape))
    closed = timed.groupBy(*keys, "late_at", F.session_window("until", f"{gap_minutes} minutes")).agg(_spans(on_time), F.count("*").alias("n"))
    none = F.array(F.lit(None).cast(wanted))
    made = F.when(F.col("late_at") < 0, _made(step, names, wanted)("spans")).otherwise(none)
    rows = closed.select(*keys, "session_window", F.window_time("session_window").alias("at"), F.when(F.col("late_at") < 0, 0).otherwise(F.col("n")).cast("long").alias("late"), F.explode(made).alias("r"))
    sid = F.when(F.col("late") == 0, F.unix_millis("session_window.start") - gap)
    return rows.select(*keys, sid.alias("sid"), "at", "r.*", "late")


class _Large(StatefulProcessor):
    """Tells of sessions (keys, sid, n) in the batch in which they get more than ``threshold`` spans. The state
    of a bucket of traces is its open sessions, as rows of whole numbers: keys, first, last, n, told."""

    def __init__(self, keys: tuple[str, ...], gap: int, threshold: int):
        self.keys, self.gap, self.threshold = keys, gap, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "sessions binary")

    def _get(self) -> np.ndarray:
        held = self.open.get() if self.open.exists() else None
        return np.frombuffer(held[0] if held else b"", np.int64).reshape(-1, len(self.keys) + 4)

    def _put(self, table: np.ndarray) -> None:
        if len(table):
            self.open.update((table.tobytes(),))
            self.handle.registerTimer(int(table[:, -3].min()) + self.gap)
        else:
            self.open.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [self._get()]
        for df in rows:
            ms = df["start_time_us"].to_numpy(np.int64) // 1000
            parts.append(np.column_stack([*(df[k].to_numpy(np.int64) for k in self.keys), ms, ms, np.ones_like(ms), np.zeros_like(ms)]))
        table = joined(np.concatenate(parts), len(self.keys), self.gap)
        new = (table[:, -2] > self.threshold) & (table[:, -1] == 0)
        table[new, -1] = 1
        self._put(table)
        if new.any():
            yield pd.DataFrame(table[new][:, [*range(len(self.keys) + 1), -2]], columns=[*self.keys, "sid", "n"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        table = self._get()
        self._put(table[table[:, -3] + self.gap > timerValues.getCurrentWatermarkInMs()])
        return iter(())


def joined(parts: np.ndarray, keys: int, gap: int) -> np.ndarray:
    """Rows (keys, first, last, n, told) of one table with those of a trace that are at most a gap apart as one."""
    parts = parts[np.lexsort([parts[:, i] for i in range(keys, -1, -1)])]
    other = np.r_[True, (parts[1:, :keys] != parts[:-1, :keys]).any(axis=1)]
    last = pd.Series(parts[:, keys + 1]).groupby(other.cumsum()).cummax().to_numpy()  # of the trace so far
    starts = np.flatnonzero(other | np.r_[True, parts[1:, keys] - last[:-1] > gap])
    out = parts[starts]
    for i, of in ((keys + 1, np.maximum), (keys + 2, np.add), (keys + 3, np.maximum)):
        out[:, i] = of.reduceat(parts[:, i], starts)
    return out


def large_traces(spans: DataFrame, keys: tuple[str, ...], gap_minutes: int, threshold: int, watermark_minutes: float) -> DataFrame:
    """(keys, sid, n) of each trace session of a stream as soon as it has more than ``threshold`` spans,
    while it is still open: sid and n are as of then. State holds counts, no spans. keys are whole numbers."""
    _store(spans)
    gap = gap_minutes * 60_000
    until = F.timestamp_millis(F.expr("start_time_us div 1000") + gap).alias("until")
    kept = spans.select(*keys, until, "start_time_us", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("bucket"))
    kept = kept.withWatermark("until", f"{int(watermark_minutes * 60_000) + gap} milliseconds")
    out = T.StructType([*(kept.schema[k] for k in keys), T.StructField("sid", T.LongType()), T.StructField("n", T.LongType())])
    return kept.groupBy("bucket").transformWithStateInPandas(_Large(keys, gap, threshold), out, "Append", "EventTime")
