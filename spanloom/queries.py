"""Queries over spans that are derived from lineitem, each with its SQL for DuckDB.

Times are shown as whole milliseconds and arrays as text, so that both engines' rows compare.
"""

from __future__ import annotations

import gc
import math
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as o
from .fixtures import flat_spans, nested_spans, odd_nested_spans
from .functions import spans as fs
from .functions.versions import version_at_least
from .operators import dependencies as dep
from .operators import paths as pt
from .operators import quality as ql
from .operators import report as rp
from .operators import sessions as ss
from .operators import sizes as sz
from .operators.dedupe import dedupe_span_ids
from .plans import jobs
from .sources import tables
from .sources.commits import Commits
from .sources.shared import delete, shared_dir
from .sources import spans as sp
from .streaming import jobs as st
from .streaming.sessions import CHANGES_KEY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _ms(c) -> F.Column:
    return F.unix_millis(c)


_KEY = "trace_id_low, span_id, start_time_us"
_NESTED = ("traceIdLow AS trace_id_low", "spanId AS span_id", "startTime AS start_time_us")
_LOWER_PEER = "lower(peer_service) AS peer_service"


@query(o.select(o.FLAT, f"SELECT trace_id_high, {_KEY}, parent_span_id, service, ms, is_server, is_client FROM f"))
def flatten_spans_dependencies(spark, sf_dir):
    return fs.flatten_spans_dependencies(nested_spans(spark, sf_dir)).withColumn("ms", _ms("ts")).drop("ts")


@query(o.select(o.FLAT, f"SELECT trace_id_high, {_KEY}, parent_span_id, service, ms, operation, span_kind FROM f"))
def flatten_spans_paths(spark, sf_dir):
    return fs.flatten_spans_paths(nested_spans(spark, sf_dir)).withColumn("ms", _ms("ts")).drop("ts")


@query(o.select(o.FLAT, f"SELECT trace_id_high, {_KEY}, parent_span_id, service, ms, {_LOWER_PEER}, is_server, is_client, client_version FROM f"))
def flatten_spans_quality(spark, sf_dir):
    return fs.flatten_spans_quality(nested_spans(spark, sf_dir)).withColumn("ms", _ms("ts")).drop("ts")


_NAMES = "trace_id_low, span_id, start_time_us"


@query(o.select(o.ODD, f"SELECT {_NAMES}, CASE WHEN odd = 0 AND span_id % 2 = 0 THEN 0 ELSE parent_span_id END AS exact, parent_span_id AS any_case FROM d"))
def resolve_parent(spark, sf_dir):
    return odd_nested_spans(spark, sf_dir).select(*map(F.expr, _NESTED), fs.resolve_parent(False).alias("exact"), fs.resolve_parent(True).alias("any_case"))


@query(o.select(o.ODD, f"""SELECT {_NAMES}, coalesce(kind = 'server' OR second = 'server', false) AS is_server, coalesce(kind = 'client' OR second = 'client', false) AS is_client,
 odd NOT IN (1, 2) AND coalesce(kind = 'server' OR second = 'server', false) AS exact_server, odd NOT IN (1, 2) AND coalesce(kind = 'client' OR second = 'client', false) AS exact_client FROM d"""))
def span_kind_flags(spark, sf_dir):
    flags = {f"{name}_{kind}": fs.has_kind(kind, name == "is") for name in ("is", "exact") for kind in ("server", "client")}
    return odd_nested_spans(spark, sf_dir).select(*map(F.expr, _NESTED), *[c.alias(n) for n, c in flags.items()])


@query(o.select(o.ODD, f"SELECT {_NAMES}, CASE WHEN odd <> 1 THEN upper(kind) END AS span_kind FROM d"))
def span_kind_enum(spark, sf_dir):
    return odd_nested_spans(spark, sf_dir).select(*map(F.expr, _NESTED), fs.span_kind().alias("span_kind"))


@query(o.select(o.ODD, f"SELECT {_NAMES}, {_LOWER_PEER} FROM d"))
def peer_service(spark, sf_dir):
    return odd_nested_spans(spark, sf_dir).select(*map(F.expr, _NESTED), fs.peer_service().alias("peer_service"))


@query(o.select(o.FLAT, f"SELECT {_KEY}, client_version FROM f"))
def client_version(spark, sf_dir):
    return nested_spans(spark, sf_dir).select(*map(F.expr, _NESTED), fs.client_version().alias("client_version"))


@query(o.select(o.ODD, f"SELECT {_NAMES}, start_time_us // 1000 AS ms, coalesce(trace_id_high, 0) || ':' || trace_id_low AS trace_key, lower(to_hex(trace_id_low)) AS trace_id, service FROM d"))
def trace_key_and_event_time(spark, sf_dir):
    n = odd_nested_spans(spark, sf_dir)
    high = F.coalesce("traceIdHigh", F.lit(0).cast("long"))
    return n.select(*map(F.expr, _NESTED), _ms(fs.event_time("startTime")).alias("ms"), F.concat_ws(":", high, "traceIdLow").alias("trace_key"), fs.trace_id_hex("traceIdLow").alias("trace_id"), F.col("process.serviceName").alias("service"))


@query(o.select(o.FLAT, f"SELECT {_KEY}, service FROM f"))
def decode_json_envelope(spark, sf_dir):
    """Messages of the envelope schema as JSON (the Avro reader needs a package)."""
    messages = nested_spans(spark, sf_dir).select(F.to_json(F.struct(F.lit(1).alias("schema_id"), F.struct("*").alias("msg"))).alias("value"))
    return sp.decode_json_envelope(messages).select(*map(F.expr, _NESTED), F.col("process.serviceName").alias("service"))


def _shared(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/spanloom-{uuid.uuid4().hex}/{name}"


@query(o.select(o.FLAT, f"SELECT {_KEY}, service FROM f"))
def read_spans(spark, sf_dir):
    """Span records written to files and read with the fixed schema."""
    path = _shared(spark, "spans")
    nested_spans(spark, sf_dir).write.parquet(path)
    return sp.read_spans_batch(spark, path).select(*map(F.expr, _NESTED), F.col("process.serviceName").alias("service"))


@query(o.select(o.FLAT, f"SELECT {_KEY}, is_server, is_client FROM f WHERE is_client OR is_server"))
def filter_local_spans(spark, sf_dir):
    return jobs.filter_local_spans(flat_spans(spark, sf_dir)).select("trace_id_low", "span_id", "start_time_us", "is_server", "is_client")


def _session_sql(keys: str, gap: int, where: str, window: int) -> str:
    return o.select(o.sessions(keys, gap, where), f"SELECT {keys}, sid, session_end, {o.window_start(window)} AS window_ms, count(*) AS n FROM t GROUP BY ALL")


def _sessions(traces: DataFrame, keys, window: int) -> DataFrame:
    start, _ = ss.tumble("session_end", window)
    return traces.groupBy(*keys, "sid", "session_end").agg(F.count("*").alias("n")).withColumn("window_ms", _ms(start))


@query(_session_sql(o.HL, 3, "is_client OR is_server", 30))
def session_dependencies(spark, sf_dir):
    return _sessions(jobs.dependency_sessions(flat_spans(spark, sf_dir)), jobs.HIGH_LOW, 30)


@query(_session_sql(o.L, 5, "true", 10))
def session_paths(spark, sf_dir):
    return _sessions(jobs.path_sessions(flat_spans(spark, sf_dir)), jobs.LOW, 10)


@query(_session_sql(o.L, 3, "is_client OR is_server", 60))
def session_quality(spark, sf_dir):
    return _sessions(jobs.quality_sessions(flat_spans(spark, sf_dir)), jobs.LOW, 60)


@query(_session_sql(o.HL, 3, "is_client OR is_server", 30))
def session_slices(spark, sf_dir):
    """Sessions in two levels, as those of hot trace keys are formed: in slices of two minutes, then across
    their borders."""
    kept = jobs.filter_local_spans(flat_spans(spark, sf_dir))
    return _sessions(ss.stitch_sessions(kept, jobs.HIGH_LOW, 3, slice_minutes=2), jobs.HIGH_LOW, 30)


@query(o.select(o.sessions(o.HL, 3), f"SELECT lower(to_hex(trace_id_high)) AS trace_id_high, lower(to_hex(trace_id_low)) AS trace_id_low, sid, count(*) AS n FROM t GROUP BY {o.HL}, sid HAVING count(*) > 8"))
def large_traces(spark, sf_dir):
    return ss.large_traces(jobs.dependency_sessions(flat_spans(spark, sf_dir)), threshold=8)


@query(o.select(o.sessions(o.HL, 3), f"SELECT n AS size, count(*) AS traces FROM (SELECT count(*) AS n FROM t GROUP BY {o.HL}, sid) GROUP BY n"))
def trace_size_histogram(spark, sf_dir):
    return ss.trace_size_histogram(jobs.dependency_sessions(flat_spans(spark, sf_dir)))


_SIZES = o.select(o.sessions(o.HL, 3), f"SELECT {o.window_start(30)} AS window_ms, n AS size, count(*) AS traces FROM (SELECT session_end, count(*) AS n FROM t GROUP BY {o.HL}, sid, session_end) GROUP BY ALL")
_BUCKET = f"CAST(ceil(ln(size) / {math.log(sz.gamma(sz.ACCURACY))!r}) AS INTEGER)"


def _trace_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sz.sizes_by_window(jobs.dependency_sessions(flat_spans(spark, sf_dir)), jobs.HIGH_LOW)


@query(_SIZES)
def trace_sizes_by_window(spark, sf_dir):
    """How many traces of each size end in each half hour."""
    return _trace_sizes(spark, sf_dir).select(_ms("window_start").alias("window_ms"), "size", "traces")


@query(f"""WITH h AS ({_SIZES}), u AS (SELECT *, sum(traces) OVER (PARTITION BY window_ms) AS total, sum(traces) OVER (PARTITION BY window_ms ORDER BY size) AS upto FROM h),
x AS (SELECT window_ms, pct, min(size) AS size FROM u, (SELECT unnest([50, 90, 99]) AS pct) WHERE upto >= greatest(1, ceil(pct / 100.0 * total)) GROUP BY ALL)
SELECT window_ms, pct, size AS exact, {_BUCKET} AS bucket, true AS within FROM x""")
def trace_size_quantiles(spark, sf_dir):
    """Quantiles of each window's sizes, exact and from sketches of even and odd traces merged."""
    spans = jobs.dependency_sessions(flat_spans(spark, sf_dir))
    parts = [sz.sketch(sz.sizes_by_window(spans.where(F.col("trace_id_low") % 2 == n), jobs.HIGH_LOW)) for n in (0, 1)]
    exact = sz.exact_quantiles(sz.sizes_by_window(spans, jobs.HIGH_LOW)).withColumnRenamed("size", "exact")
    both = exact.join(sz.quantiles(sz.merge(parts[0].unionByName(parts[1]))), ["window_start", "window_end", "rank"])
    within = F.abs(F.col("size") - F.col("exact")) <= F.col("exact") * (sz.ACCURACY + 1e-9)
    return both.select(_ms("window_start").alias("window_ms"), F.round(F.col("rank") * 100).cast("int").alias("pct"), "exact", "bucket", within.alias("within"))


@query(o.select(o.deduped(), f"SELECT {o.HL}, sid, start_time_us, service, new_id AS span_id, new_parent AS parent_span_id, renamed FROM e"))
def dedupe_spans(spark, sf_dir):
    out = dedupe_span_ids(jobs.dependency_sessions(flat_spans(spark, sf_dir)), jobs.HIGH_LOW)
    return out.select(*jobs.HIGH_LOW, "sid", "start_time_us", "service", "span_id", "parent_span_id", "renamed")


@query(o.select(o.edges(), f"SELECT {o.HL}, sid, session_end, parent, child FROM ed"))
def trace_edges(spark, sf_dir):
    return dep.trace_edges(dedupe_span_ids(jobs.dependency_sessions(flat_spans(spark, sf_dir)), jobs.HIGH_LOW), jobs.HIGH_LOW)


_COUNTS_SQL = o.select(o.edges(), f"SELECT {o.window_start(30)} AS window_ms, parent, child, count(*) AS call_count FROM ed GROUP BY ALL")


@query(_COUNTS_SQL)
def call_counts(spark, sf_dir):
    """Who calls whom, how often, in each half hour."""
    return jobs.dependency_counts(flat_spans(spark, sf_dir)).select(_ms("window_start").alias("window_ms"), "parent", "child", "call_count")


@query(_COUNTS_SQL)
def call_counts_spread(spark, sf_dir):
    """The same with every trace of over four spans taken as hot: dealt by session and id."""
    return jobs.dependency_counts(flat_spans(spark, sf_dir), hot_spans=4).select(_ms("window_start").alias("window_ms"), "parent", "child", "call_count")


_ROLLUP_SQL = o.select(
    o.edges(),
    f"""SELECT window_ms + 1800000 AS ts_ms, (window_ms + 1800000) // 86400000 * 86400000 AS ts_bucket_ms,
 string_agg(parent || '>' || child || '=' || n || '@jaeger', ',' ORDER BY parent, child) AS dependencies
FROM (SELECT {o.window_start(30)} AS window_ms, parent, child, count(*) AS n FROM ed GROUP BY ALL) GROUP BY window_ms""",
)


def _rollup_rows(rows: DataFrame) -> DataFrame:
    text = F.array_join(F.transform("dependencies", lambda d: F.concat(d["parent"], F.lit(">"), d["child"], F.lit("="), d["call_count"].cast("string"), F.lit("@"), d["source"])), ",")
    return rows.select(_ms("ts").alias("ts_ms"), _ms("ts_bucket").alias("ts_bucket_ms"), text.alias("dependencies"))


@query(_ROLLUP_SQL)
def dependencies_rollup(spark, sf_dir):
    return _rollup_rows(jobs.dependencies_job(flat_spans(spark, sf_dir)))


@query(_ROLLUP_SQL)
def write_dependencies(spark, sf_dir):
    """The job's rows as a table, read again."""
    path = _shared(spark, "dependencies_v2")
    tables.write_dependencies(jobs.dependencies_job(flat_spans(spark, sf_dir)), path)
    return _rollup_rows(tables.read_dependencies(spark, path))


@query(o.select(o.PAIRS, "SELECT t.trace_id_low, t.sid, t.span_id, t.parent_span_id FROM t ANTI JOIN (SELECT DISTINCT trace_id_low, sid, span_id AS parent_span_id FROM t) p USING (trace_id_low, sid, parent_span_id)"))
def orphan_spans(spark, sf_dir):
    return ql.orphan_spans(jobs.quality_sessions(flat_spans(spark, sf_dir)), jobs.LOW).select("trace_id_low", "sid", "span_id", "parent_span_id")


@query(o.select(o.PAIRS, "SELECT trace_id_low, sid, cs AS child, ps AS parent, count(*) AS n FROM pc GROUP BY ALL"))
def parent_child_pairs(spark, sf_dir):
    pairs = ql.parent_child_pairs(jobs.quality_sessions(flat_spans(spark, sf_dir)), jobs.LOW)
    return pairs.groupBy("trace_id_low", "sid", F.col("child.service").alias("child"), F.col("parent.service").alias("parent")).agg(F.count("*").alias("n"))


def _score_sql(*metrics: str) -> str:
    names = ", ".join(f"'{m}'" for m in metrics)
    return o.select(o.SCORES, f"SELECT service, metric, submetric, count(*) AS n FROM good WHERE metric IN ({names}) GROUP BY ALL")


def _scores(spark, sf_dir, span_rules=(), trace_rules=()) -> DataFrame:
    traces = jobs.quality_sessions(flat_spans(spark, sf_dir))
    if not span_rules:
        span_rules = (lambda keys: F.array().cast("array<struct<service: string, metric: string, submetric: string>>"),)
    out = ql.score_all(traces, jobs.LOW, span_rules, trace_rules)
    return out.groupBy("service", "metric", "submetric").agg(F.count("*").alias("n"))


@query(_score_sql("ClientVersion"))
def score_client_version(spark, sf_dir):
    return _scores(spark, sf_dir, (ql.score_client_version,))


@query(_score_sql("MinimumClientVersionCheck"))
def score_minimum_client_version(spark, sf_dir):
    return _scores(spark, sf_dir, (ql.score_minimum_client_version,))


@query(_score_sql("HasUniqueSpanIds"))
def score_unique_span_id(spark, sf_dir):
    return _scores(spark, sf_dir, (ql.score_unique_span_id,))


@query(_score_sql("HasClientSpans", "HasServerSpans"))
def score_has_client_server(spark, sf_dir):
    return _scores(spark, sf_dir, (), (ql.score_has_client_server,))


@query(o.select(o.FLAT, "SELECT l_orderkey, l_linenumber, (l_suppkey % 4) || '.' || (l_partkey % 9) AS version, CASE WHEN l_suppkey % 4 <> 2 THEN l_suppkey % 4 > 2 ELSE l_partkey % 9 >= 6 END AS ok FROM lineitem"))
def version_compare(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey", "l_linenumber", "concat(l_suppkey % 4, '.', l_partkey % 9) AS version")
    return rows.withColumn("ok", version_at_least(F.col("version"), "2.6.0"))


_QUALITY_SQL = o.select(o.COUNTS, "SELECT service, bucket_ms, metric, submetric, n AS count, trace_id FROM q")


def _quality_rows(rows: DataFrame) -> DataFrame:
    return rows.select("service", _ms("time_bucket").alias("bucket_ms"), "metric", "submetric", "count", "trace_id")


@query(_QUALITY_SQL)
def quality_counts(spark, sf_dir):
    return _quality_rows(jobs.quality_job(flat_spans(spark, sf_dir)))


@query(_QUALITY_SQL)
def quality_counts_spread(spark, sf_dir):
    """The same with every trace of over four spans taken as hot."""
    return _quality_rows(jobs.quality_job(flat_spans(spark, sf_dir), hot_spans=4))


@query(_QUALITY_SQL)
def write_quality(spark, sf_dir):
    """Counters of thirds of the traces, written by two runs, one batch twice; three folders are merged
    into a snapshot, a later retry of a merged batch is known; the reader adds what is left."""
    path = _shared(spark, "quality_metrics")
    spans = flat_spans(spark, sf_dir)
    third = [jobs.quality_job(spans.where(F.col("trace_id_low") % 3 == part)) for part in (0, 1, 2)]
    for part, batch, run in ((0, 0, "stream"), (1, 1, "stream"), (1, 1, "stream"), (2, 0, None), (1, 1, "stream")):
        tables.write_quality(third[part], path, batch, run, merge_from=3)
    return _quality_rows(tables.read_quality(spark, path))


@query(o.select(o.FLAT, "SELECT service, 'HasOperation' AS metric, CASE WHEN is_server THEN 'SERVER' ELSE 'CLIENT' END AS submetric, count(*) AS n FROM f WHERE (is_server OR is_client) AND service <> '' GROUP BY ALL"))
def custom_rules(spark, sf_dir):
    """A rule of a user's own in place of the built-in ones."""
    rule = lambda keys: F.array(ql.score("service", "HasOperation", F.when(F.col("is_server"), "SERVER").otherwise("CLIENT")))
    return _scores(spark, sf_dir, (rule,))


@query(o.select(o.REPORT, "SELECT service, metric, submetric, CAST(sum(n) AS BIGINT) AS count, string_agg(trace_id, ',' ORDER BY bucket_ms, metric, submetric, trace_id) AS trace_ids, description, type FROM typed GROUP BY service, metric, submetric, description, type"))
def service_metrics_report(spark, sf_dir):
    report = rp.sorted_metrics(rp.service_metrics_report(jobs.quality_job(flat_spans(spark, sf_dir))))
    return report.withColumn("trace_ids", F.array_join("trace_ids", ","))


@query(o.select(o.REPORT, """SELECT service, CAST(json_object('Metric', metric, 'Submetric', submetric, 'Count', CAST(sum(n) AS BIGINT), 'TraceIDs', list(trace_id ORDER BY bucket_ms, metric, submetric, trace_id), 'Description', description, 'Type', type) AS VARCHAR) AS json
 FROM typed GROUP BY service, metric, submetric, description, type"""))
def report_json(spark, sf_dir):
    """The rows of the web interface."""
    return rp.report_json(rp.service_metrics_report(jobs.quality_job(flat_spans(spark, sf_dir))))


@query(o.select(o.REPORT, "SELECT service, CAST(sum(n) AS BIGINT) AS count FROM typed WHERE bucket_ms >= 1704153600000 - 6 * 3600000 GROUP BY service"))
def recent_metrics(spark, sf_dir):
    """Counts of the last six hours before 2024-01-02."""
    rows = rp.recent(jobs.quality_job(flat_spans(spark, sf_dir)), "2024-01-02 00:00:00", 6)
    return rows.groupBy("service").agg(F.sum("count").alias("count"))


@query(o.select(o.REPORT, "SELECT service, metric, submetric, CAST(sum(n) AS BIGINT) AS count, description, type FROM typed WHERE bucket_ms >= 1704153600000 - 24 * 3600000 AND service = 'svc-5' GROUP BY service, metric, submetric, description, type"))
def report_job(spark, sf_dir):
    """The report on a service's last 24 hours before 2024-01-02, from a written table."""
    path = _shared(spark, "quality_metrics")
    tables.write_quality(jobs.quality_job(flat_spans(spark, sf_dir)), path)
    return jobs.report_job(spark, path, "2024-01-02 00:00:00", 24, "svc-5").drop("trace_ids")


@query(o.select(o.REPORT, """SELECT service, round(c * 1e6) AS completeness_ppm, round(u * 1e6) AS quality_ppm FROM (SELECT service,
 CAST(sum(n) FILTER (WHERE type = 'Completeness' AND submetric = 'PASS') AS DOUBLE) / sum(n) FILTER (WHERE type = 'Completeness' AND submetric IN ('PASS', 'FAIL')) AS c,
 CAST(sum(n) FILTER (WHERE type = 'Quality' AND submetric = 'PASS') AS DOUBLE) / sum(n) FILTER (WHERE type = 'Quality' AND submetric IN ('PASS', 'FAIL')) AS u
 FROM typed GROUP BY service)""").replace("round(c * 1e6)", "CAST(round(c * 1e5) AS BIGINT)").replace("round(u * 1e6)", "CAST(round(u * 1e5) AS BIGINT)").replace("_ppm", "_e5"))
def service_score(spark, sf_dir):
    rows = rp.service_score(jobs.quality_job(flat_spans(spark, sf_dir)))
    return rows.select("service", *[F.round(F.col(c).cast("double") * 1e5).cast("long").alias(f"{c}_e5") for c in ("completeness", "quality")])


def _path_text(path="path"):
    return F.array_join(F.transform(path, lambda n: F.concat(n["service"], F.lit("|"), n["operation"])), ">")


@query(o.select(o.PATHS, "SELECT trace_id_low, sid, session_end, path, trace_id FROM pa"))
def trace_paths(spark, sf_dir):
    out = pt.trace_paths(jobs.path_sessions(flat_spans(spark, sf_dir)))
    return out.withColumn("path", _path_text())


@query(o.select(o.PATHS, "SELECT trace_id_low, sid, CASE WHEN length(replace(replace(path, '|', ''), '>', '')) > 20 THEN 'Exceeded|Length' ELSE path END AS path FROM pa"))
def path_length_cap(spark, sf_dir):
    out = pt.trace_paths(jobs.path_sessions(flat_spans(spark, sf_dir)), limit=20)
    return out.select("trace_id_low", "sid", _path_text().alias("path"))


@query(o.select(o.PATHS, "SELECT trace_id_low, sid, session_end, path, trace_id FROM pa"))
def tree_paths(spark, sf_dir):
    """The same by pointer doubling, as large traces' paths are found."""
    return pt.trace_paths(jobs.path_sessions(flat_spans(spark, sf_dir)), spread=True).withColumn("path", _path_text())


@query(o.select(o.DEDUPED_PATHS, "SELECT window_ms, path, trace_id FROM up"))
def adjusted_paths(spark, sf_dir):
    """Unique paths after shared span ids were told apart."""
    return jobs.unique_paths(flat_spans(spark, sf_dir), dedupe=True).select(_ms("window_start").alias("window_ms"), _path_text().alias("path"), "trace_id")


@query(o.select(o.PATHS, "SELECT window_ms, path, trace_id FROM up"))
def dedupe_paths(spark, sf_dir):
    return jobs.unique_paths(flat_spans(spark, sf_dir)).select(_ms("window_start").alias("window_ms"), _path_text().alias("path"), "trace_id")


_INDEX_SQL = o.select(o.INDEX, "SELECT bucket_ms, service, operation, trace_id, path FROM idx")


def _index_rows(rows: DataFrame) -> DataFrame:
    return rows.select(_ms("ts_bucket").alias("bucket_ms"), "focal_node.service", "focal_node.operation", F.col("attributes")[0]["value"].alias("trace_id"), _path_text().alias("path"))


@query(_INDEX_SQL)
def focal_node_index(spark, sf_dir):
    return _index_rows(jobs.paths_job(flat_spans(spark, sf_dir)))


@query(_INDEX_SQL)
def write_paths(spark, sf_dir):
    path = _shared(spark, "path_based_dependencies")
    tables.write_paths(jobs.paths_job(flat_spans(spark, sf_dir)), path)
    return _index_rows(tables.read_paths(spark, path))


@query(o.select(o.INDEX, "SELECT bucket_ms, service, operation, trace_id, path FROM idx WHERE service = 'svc-3' AND operation = '' AND bucket_ms >= 1704412800000"))
def read_paths(spark, sf_dir):
    """The paths through a service since 2024-01-05, from the written table."""
    path = _shared(spark, "path_based_dependencies")
    tables.write_paths(jobs.paths_job(flat_spans(spark, sf_dir)), path)
    return _index_rows(tables.read_paths(spark, path, "svc-3", since="2024-01-05 00:00:00"))


@query(_INDEX_SQL)
def write_path_postings(spark, sf_dir):
    """The index rows from paths that are stored once, and postings."""
    path = _shared(spark, "path_postings")
    tables.write_path_postings(jobs.unique_paths(flat_spans(spark, sf_dir)), path)
    return _index_rows(tables.read_path_postings(spark, path))


@query(o.select(o.REPORT, "SELECT service, metric, submetric, CAST(sum(n) AS BIGINT) AS count, min(trace_id) AS trace_id FROM q WHERE bucket_ms >= 1704078000000 AND bucket_ms < 1706875200000 GROUP BY service, metric, submetric"))
def quality_range(spark, sf_dir):
    """Counters from 2024-01-01 03:00 to 2024-02-02 12:00, from hours, days and months."""
    path = _shared(spark, "quality_levels")
    tables.write_quality_levels(jobs.quality_job(flat_spans(spark, sf_dir)), path)
    return tables.read_quality_range(spark, path, "2024-01-01 03:00:00", "2024-02-02 12:00:00")


#: Spans for each partition of a stream's state, and those that a stream is given at a time.
_STATE_SPANS, _SLICE_SPANS = 1_000_000, 8_000_000


def _slices(spark: SparkSession, spans: DataFrame, n: int) -> Iterator[DataFrame]:
    """All spans in n tables of about one size, by time. A table and the files that Spark made of it are
    deleted when the next one is asked for."""
    if n < 2:
        yield spans
        return
    path = _shared(spark, "slices")
    borders = sorted(set(spans.approxQuantile("start_time_us", [i / n for i in range(1, n)], 0.1 / n)))
    passed = F.filter(F.array(*[F.lit(int(b)) for b in borders]), lambda b: b <= F.col("start_time_us"))
    spans.withColumn("slice", F.size(passed)).write.partitionBy("slice").parquet(path)
    slices = spark.read.parquet(path)
    for i in range(len(borders) + 1):
        yield slices.where(F.col("slice") == i).drop("slice")
        delete(spark, f"{path}/slice={i}")
        gc.collect()  # shuffle files stay until the driver's garbage is collected, here and there
        spark.sparkContext._jvm.System.gc()


def _streamed(spark: SparkSession, sf_dir: str, job, write) -> None:
    """Run a streaming job over the spans as files, then over one late span that closes all windows. Many spans
    come in slices of time, so that state and shuffles hold a slice; none is late, as the watermark is
    behind the last span of the slices before. Stores then go from one run to the next as they are: the
    changes since the beginning would be written once more and read by each run."""
    path, checkpoint = _shared(spark, "in"), _shared(spark, "checkpoint")
    spans = flat_spans(spark, sf_dir)
    late = spans.groupBy().agg(F.max("start_time_us").alias("m")).select((F.col("m") + 10**12).alias("start_time_us"))
    last = late.select(
        *[(F.col("start_time_us") if c == "start_time_us" else fs.event_time("start_time_us") if c == "ts" else F.lit(True) if c == "is_server" else F.lit(-1).cast("long") if k == "bigint" else F.lit(None).cast(k)).alias(c) for c, k in spans.dtypes]
    )
    n = spans.count()
    slices = max(1, math.ceil(n / _SLICE_SPANS))
    partitions = max(spark.sparkContext.defaultParallelism, math.ceil(n / slices / _STATE_SPANS))
    settings = {CHANGES_KEY: "false", "spark.sql.streaming.minBatchesToRetain": "2"} if slices > 1 else {}
    for part in _slices(spark, spans.unionByName(last), slices):
        part.write.parquet(path)
        st.run_available(job(sp.stream_span_files(spark, path, part.schema)), write, checkpoint, partitions, settings)
        delete(spark, path)


@query(_ROLLUP_SQL)
def stream_dependencies(spark, sf_dir):
    out = _shared(spark, "out")
    _streamed(spark, sf_dir, st.dependencies_stream, lambda rows, n: tables.write_dependencies(rows, out, n, "stream"))
    return _rollup_rows(tables.read_dependencies(spark, out))


@query(_INDEX_SQL)
def stream_paths(spark, sf_dir):
    out = _shared(spark, "out")
    _streamed(spark, sf_dir, st.paths_stream, lambda rows, n: tables.write_paths(rows, out, n, "stream"))
    return _index_rows(tables.read_paths(spark, out))


@query(_QUALITY_SQL)
def stream_quality(spark, sf_dir):
    out = _shared(spark, "out")
    _streamed(spark, sf_dir, st.quality_stream, lambda rows, n: tables.write_quality(rows, out, n, "stream"))
    return _quality_rows(tables.read_quality(spark, out))


@query(f"WITH h AS ({_SIZES}) SELECT window_ms, {_BUCKET} AS bucket, CAST(sum(traces) AS BIGINT) AS traces FROM h GROUP BY ALL")
def stream_trace_sizes(spark, sf_dir):
    """The sketch of each window's trace sizes, from a stream."""
    out = _shared(spark, "out")
    _streamed(spark, sf_dir, st.trace_sizes, lambda rows, n: Commits(spark, out).add(rows, "stream", n))
    return sz.merge(Commits(spark, out).rows()).select(_ms("window_start").alias("window_ms"), "bucket", "traces")


def _streamed_rows(spark: SparkSession, sf_dir: str, job) -> DataFrame:
    out = _shared(spark, "out")
    _streamed(spark, sf_dir, job, lambda rows, n: Commits(spark, out).add(rows, "stream", n))
    return Commits(spark, out).rows()


@query(o.select(o.PAIRS, "SELECT t.trace_id_low, t.sid, t.span_id, t.parent_span_id FROM t ANTI JOIN (SELECT DISTINCT trace_id_low, sid, span_id AS parent_span_id FROM t) p USING (trace_id_low, sid, parent_span_id)"))
def stream_orphan_spans(spark, sf_dir):
    return _streamed_rows(spark, sf_dir, st.orphan_spans).where("trace_id_low >= 0").select("trace_id_low", "sid", "span_id", "parent_span_id")


@query(o.select(o.sessions(o.HL, 3), f"SELECT trace_id_high, trace_id_low, count(*) AS sessions FROM (SELECT {o.HL}, sid FROM t GROUP BY {o.HL}, sid HAVING count(*) > 5) GROUP BY {o.HL}"))
def stream_large_traces(spark, sf_dir):
    """Sessions of over five spans, told of while they are open."""
    found = _streamed_rows(spark, sf_dir, lambda stream: st.large_traces(stream, threshold=5))
    return found.where("n > 5").groupBy("trace_id_high", "trace_id_low").agg(F.count("*").alias("sessions"))


_LATE = "trace_id_low % 20 = 7"


@query(f"""WITH kept AS ({o.select(o.edges(), f"SELECT {o.window_start(30)} AS window_ms, parent, child, count(*) AS n FROM ed WHERE NOT {_LATE} GROUP BY ALL")}),
late AS ({o.select(o.FLAT, f"SELECT lower(to_hex(trace_id_high)) || ':' || lower(to_hex(trace_id_low)) AS late_trace, count(*) AS n FROM f WHERE (is_client OR is_server) AND {_LATE} GROUP BY ALL")})
SELECT window_ms, parent, child, n, '' AS late_trace FROM kept UNION ALL SELECT -1, '', '', n, late_trace FROM late""")
def late_data(spark, sf_dir):
    """Calls of a stream in which a twentieth of the traces comes after the windows have closed, and the late
    spans of each such trace."""
    path, out, spans = _shared(spark, "in"), _shared(spark, "out"), flat_spans(spark, sf_dir)
    last = spans.agg(F.max("start_time_us")).first()[0]
    close = lambda n: spans.limit(1).withColumns({"trace_id_low": F.lit(-1).cast("long"), "trace_id_high": F.lit(0).cast("long"), "parent_span_id": F.lit(0).cast("long"), "is_server": F.lit(True), "is_client": F.lit(False), "start_time_us": F.lit(last + n * 10**12)}).withColumn("ts", fs.event_time("start_time_us"))
    names = spans.columns
    checkpoint = _shared(spark, "checkpoint")
    for part in (spans.where(f"not {_LATE}").unionByName(close(1).select(names)), close(2).select(names), spans.where(_LATE), close(3).select(names), close(4).select(names)):
        part.write.mode("append").parquet(path)  # then the stream goes on with what is new
        stream = sp.stream_span_files(spark, path, spark.read.parquet(path).schema)
        st.run_available(st.dependency_counts_and_late(stream), lambda rows, n: Commits(spark, out).add(rows, "stream", n), checkpoint)
    rows = Commits(spark, out).rows()
    calls = rows.where("late = 0").select(_ms("window.start").alias("window_ms"), "parent", "child", F.col("call_count").alias("n"), F.lit("").alias("late_trace"))
    late = rows.where("late > 0").groupBy("late_trace").agg(F.sum("late").alias("n"))
    return calls.unionByName(late.select(F.lit(-1).cast("long").alias("window_ms"), F.lit("").alias("parent"), F.lit("").alias("child"), "n", "late_trace"))
