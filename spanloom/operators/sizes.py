"""How large traces are: exact histograms and mergeable quantile sketches, per tumbling window.

A sketch counts traces by the logarithm of their size: bucket i holds sizes above g**(i - 1) up to g**i,
with g = (1 + accuracy) / (1 - accuracy), and stands for 2 * g**i / (g + 1), which is at most
``accuracy`` of a size off. A window has some hundred rows however many traces it holds, and sketches of
parts of it (micro-batches, clusters, hours of a day) are merged by adding counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sessions import tumble

ACCURACY = 0.01


def gamma(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def bucket(size, accuracy: float = ACCURACY) -> Column:
    """The bucket of a size of 1 or more."""
    return F.ceil(F.log(F.col(size).cast("double")) / F.lit(math.log(gamma(accuracy)))).cast("int")


def sizes_by_window(spans: DataFrame, keys: tuple[str, ...] = ("trace_id_high", "trace_id_low"), window_minutes: int = 30) -> DataFrame:
    """(window_start, window_end, size, traces): the exact histogram of each window, from spans in
    sessions; a trace falls in the window in which its session ends."""
    start, end = tumble("session_end", window_minutes)
    each = spans.groupBy(*keys, "sid", "session_end").agg(F.count("*").alias("size"))
    return each.groupBy(start.alias("window_start"), end.alias("window_end"), "size").agg(F.count("*").alias("traces"))


def sketch(histogram: DataFrame, accuracy: float = ACCURACY) -> DataFrame:
    """(window_start, window_end, bucket, traces) from (window_start, window_end, size, traces)."""
    return histogram.groupBy("window_start", "window_end", bucket("size", accuracy).alias("bucket")).agg(F.sum("traces").alias("traces"))


def merge(sketches: DataFrame) -> DataFrame:
    """One sketch for each window of several sketches' rows, all of one accuracy."""
    return sketches.groupBy("window_start", "window_end", "bucket").agg(F.sum("traces").alias("traces"))


def coarser(sketches: DataFrame, window_minutes: int) -> DataFrame:
    """Sketches of longer windows, whole multiples of those given."""
    start, end = tumble("__end", window_minutes)
    ends = sketches.withColumn("__end", F.unix_millis("window_end"))
    return ends.groupBy(start.alias("window_start"), end.alias("window_end"), "bucket").agg(F.sum("traces").alias("traces"))


def _at_ranks(rows: DataFrame, value: str, ranks: tuple[float, ...]) -> DataFrame:
    """(window_start, window_end, rank, value): the least value with at least rank * all traces at or
    below it; a window's rows are few."""
    by = Window.partitionBy("window_start", "window_end")
    total = F.sum("traces").over(by)
    upto = F.sum("traces").over(by.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    wanted = rows.withColumns({"__all": total, "__upto": upto}).withColumn("rank", F.explode(F.array(*[F.lit(r) for r in ranks])))
    least = F.greatest(F.lit(1), F.ceil(F.col("rank") * F.col("__all")))
    return wanted.where(F.col("__upto") >= least).groupBy("window_start", "window_end", "rank").agg(F.min(value).alias(value))


def exact_quantiles(histogram: DataFrame, ranks: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """(window_start, window_end, rank, size) of an exact histogram."""
    return _at_ranks(histogram, "size", ranks)


def quantiles(sketches: DataFrame, ranks: tuple[float, ...] = (0.5, 0.9, 0.99), accuracy: float = ACCURACY) -> DataFrame:
    """(window_start, window_end, rank, bucket, size) of merged sketches: size is at most ``accuracy`` of
    the exact quantile off."""
    g = gamma(accuracy)
    return _at_ranks(sketches, "bucket", ranks).withColumn("size", F.lit(2 / (g + 1)) * F.pow(F.lit(g), F.col("bucket")))
