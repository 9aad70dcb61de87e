"""Traces as event-time sessions, in row form.

A trace is all spans of a trace key between two silences longer than the gap. ``annotate_sessions``
deals the spans out by trace key once; every later window and join inside a trace works on that
partitioning, so a job has one full-volume shuffle. Rows stay rows: a giant trace is sorted and
spilled, never gathered into one array.

A hot key (the id 0 of spans without a trace, say) would still be one task. ``split_hot`` takes such
keys out; ``stitch_sessions`` forms their sessions in two levels without dealing their spans by key, and
the look-ups take ``spread`` to find other spans of such a trace by joins on (session, id), which Spark
can split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import written

#: Spans of a trace key above which it is hot; the length of the slices in which its sessions are formed.
HOT_SPANS, SLICE_MINUTES = 1_000_000, 10
#: Buckets of trace keys for as many spans as make a key hot.
HOT_BUCKETS = 16
#: Spans that a task of a job takes: its sorts hold some 4 kB for each while they are told apart.
TASK_SPANS = 100_000
#: Bytes of an exchange that a task takes where hot traces are worked on (see bounded_tasks).
TASK_BYTES = "8m"
#: Tells rows of hot traces apart; stays the same however often they are read.
ROW = "__row"
#: What orders the spans of a trace where first and last matter.
ORDER = ("start_time_us", "span_id")


def annotate_sessions(spans: DataFrame, keys: tuple[str, ...], gap_minutes: int) -> DataFrame:
    """spans with sid (start of the session, ms) and session_end (last span + gap, ms).

    Spans exactly one gap apart are in one session. spans needs start_time_us.
    """
    gap = gap_minutes * 60_000
    by_time = Window.partitionBy(*keys).orderBy("__ms")
    new = F.col("__ms") - F.lag("__ms").over(by_time)
    first = F.when(new.isNull() | (new > gap), F.col("__ms"))
    out = spans.withColumn("__ms", F.expr("start_time_us div 1000")).withColumn("__first", first)
    out = out.withColumn("sid", F.max("__first").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    end = F.max("__ms").over(Window.partitionBy(*keys, "sid")) + gap
    return out.withColumn("session_end", end).drop("__ms", "__first")


def deal(spans: DataFrame, count: int, *by: str) -> DataFrame:
    """``count`` rows dealt out by some columns to as many tasks as keep each at TASK_SPANS or so."""
    return spans.repartition(max(spans.sparkSession.sparkContext.defaultParallelism, math.ceil(count / TASK_SPANS)), *by)


@contextmanager
def bounded_tasks(spark: SparkSession, count: int) -> Iterator[None]:
    """Until it ends, Spark deals what joins and sums of ``count`` rows move to as many tasks as these need, and
    puts no more than TASK_BYTES of it together in one, so that a task's sorts don't grow with the input.
    It can still split what is hot. Holds for what runs meanwhile, such as tables that are written."""
    partitions, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {name: spark.conf.get(name) for name in (partitions, size)}
    spark.conf.set(partitions, max(int(before[partitions]), math.ceil(count / TASK_SPANS)))
    spark.conf.set(size, TASK_BYTES)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def split_hot(spans: DataFrame, keys: tuple[str, ...], above: int | None = HOT_SPANS, count: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The spans of keys with at most ``above`` spans, and those of the others if there are any. The hot
    keys are at most one for every ``above`` spans, and are written as a table. ``count`` is the number of
    spans where it is known.

    Spans are counted by buckets of keys first, of which there are few for any number of keys; keys are
    counted only in buckets with over ``above`` spans, as no other can have a hot key."""
    if above is None:
        return spans, None
    count = spans.count() if count is None else count
    if count <= above:
        return spans, None
    bucket = F.pmod(F.xxhash64(*keys), F.lit(math.ceil(HOT_BUCKETS * count / above))).alias("__bucket")
    full = written(spans.groupBy(bucket).agg(F.count("*").alias("n")).where(F.col("n") > above).select("__bucket"), "full_buckets")
    if full.isEmpty():
        return spans, None
    among = spans.select(*keys, bucket).join(full, "__bucket", "left_semi")
    hot = written(among.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > above).select(*keys), "hot")
    if hot.isEmpty():
        return spans, None
    return spans.join(hot, list(keys), "left_anti"), spans.join(hot, list(keys), "left_semi")


def stitch_sessions(spans: DataFrame, keys: tuple[str, ...], gap_minutes: int, slice_minutes: int = SLICE_MINUTES) -> DataFrame:
    """annotate_sessions in two levels, for keys with very many spans.

    Sessions depend on the distinct times of a key alone. These are dealt by (key, slice of time); each
    slice gives the intervals between its own silences, and the intervals of a key, a few for each
    slice, are stitched across the slices' borders by running sums in the order of time. Spans meet
    the intervals of their slice in a join that needs no exchange if those are few, and else can be
    split where a slice is hot.
    """
    gap, size = gap_minutes * 60_000, slice_minutes * 60_000
    timed = spans.withColumn("__ms", F.expr("start_time_us div 1000")).withColumn("__slice", F.floor(F.col("__ms") / size))
    times = timed.select(*keys, "__slice", "__ms").distinct()

    def first_of(order: str, before: str, *part: str):
        by = Window.partitionBy(*part).orderBy(order)
        silence = F.col(order) - F.lag(before).over(by)
        return F.max("__new").over(by.rowsBetween(Window.unboundedPreceding, 0)), F.when(silence.isNull() | (silence > gap), F.col(order))

    start, new = first_of("__ms", "__ms", *keys, "__slice")
    inside = times.withColumn("__new", new).withColumn("__from", start).groupBy(*keys, "__slice", "__from").agg(F.max("__ms").alias("__to"))
    start, new = first_of("__from", "__to", *keys)
    stitched = inside.withColumn("__new", new).withColumn("sid", start)
    stitched = stitched.withColumn("session_end", F.max("__to").over(Window.partitionBy(*keys, "sid")) + gap)
    found = stitched.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__slice").alias("__s"), "__from", "__to", "sid", "session_end")
    same = F.col("__slice") == F.col("__s")
    for k in keys:
        same &= F.col(k) == F.col(f"__{k}")
    joined = timed.join(found, same & F.col("__ms").between(F.col("__from"), F.col("__to")))
    return joined.select(*spans.columns, "sid", "session_end")


def hot_sessions(hot: DataFrame, keys: tuple[str, ...], gap_minutes: int) -> DataFrame:
    """stitch_sessions as a written table, whose rows ROW tells apart."""
    return written(stitch_sessions(hot, keys, gap_minutes).withColumn(ROW, F.monotonically_increasing_id()), "hot_sessions")


def tumble(end_ms, minutes: int):
    """Start and end (timestamps) of the tumbling window in which a session that ends at end_ms falls:
    what a session emits carries the time end - 1 ms."""
    size = minutes * 60_000
    start = F.floor((F.col(end_ms) - 1) / size) * size
    return F.timestamp_millis(start), F.timestamp_millis(start + size)


def trace_sizes(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, sid, n): the spans of each trace session."""
    return spans.groupBy(*keys, "sid").agg(F.count("*").alias("n"))


def large_traces(spans: DataFrame, keys: tuple[str, ...] = ("trace_id_high", "trace_id_low"), threshold: int = 80_000) -> DataFrame:
    """Traces with more than ``threshold`` spans: ids in hex, session, size."""
    return trace_sizes(spans, keys).where(F.col("n") > threshold).select(*[F.lower(F.hex(k)).alias(k) for k in keys], "sid", "n")


def trace_size_histogram(spans: DataFrame, keys: tuple[str, ...] = ("trace_id_high", "trace_id_low")) -> DataFrame:
    """(size, traces): how many trace sessions have each number of spans."""
    return trace_sizes(spans, keys).groupBy(F.col("n").alias("size")).agg(F.count("*").alias("traces"))


def over_id(spans: DataFrame, keys: tuple[str, ...], answers: dict, spread: bool = False) -> DataFrame:
    """spans with aggregates (Columns) over the spans of each span's own id in its trace session."""
    if spread:
        place = [*keys, "sid", "span_id"]
        return spans.join(spans.groupBy(*place).agg(*[agg.alias(name) for name, agg in answers.items()]), place)
    by_id = Window.partitionBy(*keys, "sid", "span_id")
    return spans.withColumns({name: agg.over(by_id) for name, agg in answers.items()})


def ask_by_id(spans: DataFrame, keys: tuple[str, ...], own: list, asked: list, answers: dict, spread: bool = False) -> DataFrame:
    """A look-up of other spans of the same trace session by id, without a join.

    Each span stands twice: under its own id, where it tells, and under the id it asks for (``own``
    and ``asked`` are lists of Columns of equal length). ``answers`` maps new column names to
    aggregates (Columns) over the tellers of an id; every span gets those of the id it asks for. As
    windows over the trace key's partitioning need no exchange, neither does this. With ``spread``
    the tellers are aggregated by id and joined, so that neither a trace nor an id that many ask for
    is one task.
    """
    place = lambda cols, tells: F.struct(*[c.alias(f"i{n}") for n, c in enumerate(cols)], F.lit(tells).alias("tells"))
    ids = [f"__at.i{n}" for n in range(len(own))]
    if spread:
        tellers = spans.withColumn("__at", place(own, True)).groupBy(*[F.col(k).alias(f"__k_{k}") for k in (*keys, "sid")], *[F.col(i).alias(f"__t{n}") for n, i in enumerate(ids)])
        told_ = tellers.agg(*[agg.alias(name) for name, agg in answers.items()])
        same = F.lit(True)
        for k in (*keys, "sid"):
            same &= F.col(k) == F.col(f"__k_{k}")
        asking = spans.withColumn("__at", place(asked, False))
        for n, i in enumerate(ids):
            same &= F.col(i) == F.col(f"__t{n}")
        return asking.join(told_, same, "left").select(*spans.columns, *answers)
    twice = spans.withColumn("__at", F.explode(F.array(place(own, True), place(asked, False))))
    by_id = Window.partitionBy(*keys, "sid", *[F.col(i) for i in ids])
    told = twice.withColumns({name: agg.over(by_id) for name, agg in answers.items()})
    return told.where(~F.col("__at.tells")).drop("__at")


def told(value):
    """A value of the tellers in ask_by_id; null for those who ask."""
    return F.when(F.col("__at.tells"), value)
