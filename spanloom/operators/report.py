"""Reports over quality_metrics, for all services at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPLETENESS, QUALITY, OTHER = "Completeness", "Quality", "Other"
# Description and type of each metric, and of all others.
CATALOG = (
    ("HasServerSpans", "The service emitted spans with server span.kind", COMPLETENESS),
    ("HasClientSpans", "The service emitted spans with client span.kind ", COMPLETENESS),
    ("HasUniqueSpanIds", "The service emitted spans with unique span ids", QUALITY),
    ("MinimumClientVersionCheck", "This service emitted a span that has an acceptable client version", COMPLETENESS),
)
UNKNOWN = ("This metric isn't used for computing trace quality", OTHER)


def metric_catalog_lookup(rows: DataFrame) -> DataFrame:
    """rows(metric, ...) with description and type; the metric's case does not matter."""
    spark = rows.sparkSession
    catalog = spark.createDataFrame([(m.lower(), d, t) for m, d, t in CATALOG], "m string, d string, t string")
    out = rows.join(F.broadcast(catalog), F.lower("metric") == F.col("m"), "left")  # four rows
    return out.withColumns({"description": F.coalesce("d", F.lit(UNKNOWN[0])), "type": F.coalesce("t", F.lit(UNKNOWN[1]))}).drop("m", "d", "t")


def hours_before(now, hours: int):
    """Some hours before ``now``, a timestamp Column or text."""
    at = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    return at - F.make_interval(hours=F.lit(hours))


def recent(metrics: DataFrame, now, hours: int) -> DataFrame:
    """Rows of the last hours: time_bucket >= now - hours."""
    return metrics.where(F.col("time_bucket") >= hours_before(now, hours))


def service_metrics_report(metrics: DataFrame) -> DataFrame:
    """(service, metric, submetric, count, trace_ids, description, type) of every service.

    Metrics that differ in case are one; they are shown as the earliest row writes them. Trace ids
    come in the order of their buckets: those of a month are put in order first, by many tasks, then
    the months, so that the few tasks that put a report's rows together sort months, not ids.
    """
    place, first = F.struct("time_bucket", "metric", "submetric", "trace_id"), F.get("places", F.lit(0))
    key = ["service", F.lower("metric").alias("lm"), F.lower("submetric").alias("ls")]
    dealt = metrics.withColumn("month", F.date_trunc("MONTH", "time_bucket")).repartition("service", "month")
    months = dealt.groupBy(*key, "month").agg(F.sum("count").alias("count"), F.sort_array(F.collect_list(place)).alias("places"))
    ids = F.transform("places", lambda p: p["trace_id"])
    part = F.struct("month", first["metric"].alias("metric"), first["submetric"].alias("submetric"), ids.alias("trace_ids"))
    rows = months.select("service", "lm", "ls", "count", part.alias("part")).groupBy("service", "lm", "ls").agg(
        F.sum("count").alias("count"), F.sort_array(F.collect_list("part")).alias("parts")
    )
    first, ids = F.get("parts", F.lit(0)), F.flatten("parts.trace_ids")
    return metric_catalog_lookup(rows.select("service", first["metric"].alias("metric"), first["submetric"].alias("submetric"), "count", ids.alias("trace_ids")))


def sorted_metrics(report: DataFrame) -> DataFrame:
    """A report by service, then metric and submetric whatever their case."""
    return report.orderBy("service", F.lower("metric"), F.lower("submetric"))


def service_score(metrics: DataFrame) -> DataFrame:
    """(service, completeness, quality): PASS / (PASS + FAIL) over the metrics of each type, as 32-bit
    floats; null for a service without such rows."""
    typed = metric_catalog_lookup(metrics.withColumn("sub", F.upper("submetric")))

    def ratio(kind: str):
        n = lambda *subs: F.sum(F.when((F.col("type") == kind) & F.col("sub").isin(*subs), F.col("count")).otherwise(0))
        return F.try_divide(n("PASS").cast("double"), n("PASS", "FAIL").cast("double")).cast("float")

    return typed.groupBy("service").agg(ratio(COMPLETENESS).alias("completeness"), ratio(QUALITY).alias("quality"))


def report_json(report: DataFrame) -> DataFrame:
    """(service, json): each row of a report as JSON with the field names of the web interface."""
    body = F.to_json(F.struct(F.col("metric").alias("Metric"), F.col("submetric").alias("Submetric"), F.col("count").alias("Count"), F.col("trace_ids").alias("TraceIDs"), F.col("description").alias("Description"), F.col("type").alias("Type")))
    return report.select("service", body.alias("json"))
