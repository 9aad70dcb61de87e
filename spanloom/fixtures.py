"""Spans derived from lineitem: the same text runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.spans import event_time

SPANS_SQL = """
SELECT CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE l_orderkey % 3 END AS trace_id_high,
 l_orderkey AS trace_id_low, CAST(l_linenumber AS BIGINT) AS span_id,
 CAST(FLOOR(l_linenumber / 2.0) AS BIGINT) AS parent_span_id,
 CONCAT('svc-', CAST(l_suppkey % 12 AS VARCHAR(9))) AS service,
 CONCAT('op-', CAST(l_partkey % 5 AS VARCHAR(9))) AS operation,
 CASE WHEN l_partkey % 10 = 9 THEN 'local' WHEN l_partkey % 10 = 8 THEN NULL
      WHEN (CASE WHEN l_linenumber = 1 THEN 0 WHEN l_linenumber < 4 THEN 1 ELSE 2 END + l_partkey) % 2 = 0 THEN 'server' ELSE 'client' END AS span_kind,
 1704067200000000 + l_orderkey * 97000000 + l_linenumber * 7000000
   + CASE WHEN l_partkey % 50 = 0 THEN 600000000 ELSE 0 END + l_partkey * 1000 + l_suppkey AS start_time_us,
 CASE WHEN l_suppkey % 7 = 0 THEN '' WHEN l_suppkey % 4 = 0 THEN CONCAT('svc-', CAST((l_suppkey + 1) % 12 AS VARCHAR(9))) ELSE NULL END AS peer_service,
 CASE l_partkey % 8 WHEN 0 THEN 'Go-2.6.1' WHEN 1 THEN 'java-0.0.16' WHEN 2 THEN 'python-3.9.0' WHEN 3 THEN 'node-2.1.1'
      WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'go-2' ELSE '5.5.5' END AS client_version
FROM lineitem"""


def raw_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat spans with all derived columns."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(SPANS_SQL.replace("FROM lineitem", "FROM {lineitem}"), lineitem=lineitem)


def flat_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_spans as the jobs take them: ids never null, kind in upper case, flags, ts."""
    kind = F.col("span_kind")
    return raw_spans(spark, sf_dir).withColumns(
        {
            "trace_id_high": F.coalesce("trace_id_high", F.lit(0).cast("long")),
            "is_server": F.coalesce(kind == "server", F.lit(False)),
            "is_client": F.coalesce(kind == "client", F.lit(False)),
            "span_kind": F.upper(kind),
            "ts": event_time("start_time_us"),
        }
    )


def _text(key, value) -> F.Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    null = lambda kind: F.lit(None).cast(kind)
    return F.struct(as_column(key).alias("key"), F.lit("STRING").alias("vType"), as_column(value).cast("string").alias("vStr"), null("double").alias("vDouble"), null("boolean").alias("vBool"), null("long").alias("vLong"), null("binary").alias("vBinary"))


def nested_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same spans as wire records: for even span ids the parent stands in a reference only."""
    kind = F.col("span_kind")
    return _nested(raw_spans(spark, sf_dir), [F.when(kind.isNotNull(), _text("span.kind", kind))], F.lit("child_of"), "peer.service")


def odd_nested_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire records with one oddity each, by start time modulo 6: references in upper case, tag names in
    mixed case, kinds in upper case, a second kind, negative trace ids, no service name."""
    odd, kind = F.col("start_time_us") % 6, F.col("span_kind")
    other = F.when(kind == "server", "client").when(kind == "client", "server")
    own = _text(F.when(odd == 1, "Span.Kind").otherwise("span.kind"), F.when(odd == 2, F.upper(kind)).otherwise(kind))
    rows = raw_spans(spark, sf_dir).withColumns(
        {"trace_id_low": F.when(odd == 4, -F.col("trace_id_low")).otherwise(F.col("trace_id_low")), "service": F.when(odd != 5, F.col("service"))}
    )
    kinds = [F.when((odd == 3) & other.isNotNull(), _text("span.kind", other)), F.when(kind.isNotNull(), own)]
    return _nested(rows, kinds, F.when(odd == 0, "CHILD_OF").otherwise("child_of"), "Peer.Service")


def _nested(rows: DataFrame, kinds: list, child_of, peer: str) -> DataFrame:
    by_reference = F.col("span_id") % 2 == 0
    reference = lambda kind, span: F.struct(kind.alias("refType"), F.col("trace_id_low").alias("traceIdLow"), F.col("trace_id_high").alias("traceIdHigh"), span.alias("spanId"))
    tags = F.array(*kinds, F.when(F.col("peer_service").isNotNull(), _text(peer, F.upper("peer_service"))), _text("http.method", "GET"))
    return rows.select(
        F.col("trace_id_low").alias("traceIdLow"),
        F.col("trace_id_high").alias("traceIdHigh"),
        F.col("span_id").alias("spanId"),
        F.when(~by_reference, F.col("parent_span_id")).alias("parentSpanId"),
        F.col("operation").alias("operationName"),
        F.when(by_reference, F.array(reference(child_of, F.lit(99).cast("long")), reference(child_of, F.col("parent_span_id")), reference(F.lit("follows_from"), F.lit(77).cast("long")))).alias("references"),
        F.lit(0).alias("flags"),
        F.col("start_time_us").alias("startTime"),
        F.lit(1).cast("long").alias("duration"),
        F.filter(tags, lambda t: t.isNotNull()).alias("tags"),
        F.lit(None).cast("array<struct<timestamp: bigint, fields: array<struct<key: string, vType: string, vStr: string, vDouble: double, vBool: boolean, vLong: bigint, vBinary: binary>>>>").alias("logs"),
        F.struct(F.col("service").alias("serviceName"), F.when(F.col("client_version").isNotNull(), F.array(_text("jaeger.version", F.col("client_version")))).alias("tags")).alias("process"),
    )
