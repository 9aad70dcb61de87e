"""Tasks, files and SQL on tables that grow."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom import oracles as o
from spanloom import queries as q
from spanloom.operators import dependencies as dp
from spanloom.operators import paths as pt
from spanloom.operators import quality as ql
from spanloom.operators import report as rp
from spanloom.operators import sessions as ss
from spanloom.operators import sizes as sz
from spanloom.plans import jobs
from spanloom.sources import tables
from spanloom.sources.shared import written
from spanloom.streaming import jobs as st
from spanloom.streaming import sessions as streams
from spanloom.streaming.sessions import joined, merged

from test_scale import T0, closing, counters, random_spans, same, stream_of


@pytest.mark.parametrize("job", [jobs.dependency_sessions, jobs.path_sessions, jobs.quality_sessions, jobs.quality_job, jobs.dependency_counts, jobs.unique_paths])
def test_tasks_follow_the_number_of_spans(spark, monkeypatch, job):
    """Traces are dealt to as many tasks as they have spans for, whatever the number of shuffle partitions."""
    spans = random_spans(spark, 3, 3000, 900).cache()
    want = [r for r in map(repr, job(spans).collect())]
    monkeypatch.setattr(ss, "TASK_SPANS", 100)
    out = job(spans)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, out.collect())) == sorted(want)
    dealt = ss.deal(spans, spans.count(), "trace_id_low").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) > 20


def files(path, table="data"):
    return [p for p in (path / table).rglob("*.parquet")] if table else list(path.rglob("*.parquet"))


def test_a_table_has_a_file_for_each_of_its_folders(spark, tmp_path):
    """400 days of rows from eight tasks: 14 months, not days times tasks."""
    rows = spark.range(0, 4000, 1, 8).select(F.concat(F.lit("s"), F.col("id") % 3).alias("service"), F.lit("M").alias("metric"), F.lit("PASS").alias("submetric"), F.lit(1).cast("long").alias("count"), F.lit("1").alias("trace_id"), F.timestamp_seconds((F.col("id") * 7919 % 400) * 86400).alias("time_bucket"))
    tables.write_quality(rows, str(tmp_path / "q"))
    tables.write_quality_levels(rows, str(tmp_path / "levels"))
    node = F.struct(F.col("service"), F.lit("o").alias("operation"))
    unique = rows.select(F.col("time_bucket").alias("window_start"), F.col("time_bucket").alias("window_end"), F.array(node).alias("path"), "trace_id")
    tables.write_path_postings(unique, str(tmp_path / "p"))
    assert len(files(tmp_path / "q")) == 14 and len(files(tmp_path / "levels")) == 6
    assert len(files(tmp_path / "p" / "paths")) == len(files(tmp_path / "p" / "postings")) == 14
    assert tables.read_quality(spark, str(tmp_path / "q")).agg(F.sum("count")).first()[0] == 4000
    since = tables.read_path_postings(spark, str(tmp_path / "p"), "s1", since="1970-06-15 00:00:00")
    assert since.count() == unique.where("path[0].service = 's1' and window_end >= '1970-06-15'").count() > 0
    tables.write_quality(counters(spark, 5), str(tmp_path / "q"), merge_from=2)
    assert len(files(tmp_path / "q")) >= 14 and tables.read_quality(spark, str(tmp_path / "q")).agg(F.sum("count")).first()[0] == 4005


def test_sessions_that_start_with_equal_times_are_whole_in_sql(spark):
    """Two spans of one time open a session after a silence; whichever is sorted first, both are in it."""
    con = duckdb.connect()
    con.sql(f"CREATE TABLE f AS SELECT 1 AS trace_id_high, CAST(t AS BIGINT) AS trace_id_low, {T0 // 1000} + m AS ms FROM range(5000) r(t), (VALUES (0), (0), (600000), (600000), (600000)) v(m)")
    ctes = o.sessions(o.HL, 3, "true")
    body = ctes[ctes.index("a AS (") :]
    got = con.sql(f"WITH {body} SELECT n, count(*) FROM (SELECT trace_id_low, sid, count(*) AS n FROM t GROUP BY ALL) GROUP BY n ORDER BY n").fetchall()
    assert got == [(2, 5000), (3, 5000)] and "ROWS UNBOUNDED PRECEDING) AS sid" not in ctes
    spans = spark.range(500).selectExpr("1L AS trace_id_high", "id AS trace_id_low", f"explode(array({T0}, {T0}, {T0} + 600000000, {T0} + 600000000, {T0} + 600000000)) AS start_time_us", "1L AS span_id")
    found = sz.sizes_by_window(ss.annotate_sessions(spans, jobs.HIGH_LOW, 3), jobs.HIGH_LOW)
    assert {(r["size"], r.traces) for r in found.collect()} == {(2, 500), (3, 500)}
    same(ss.annotate_sessions(spans, jobs.HIGH_LOW, 3), ss.stitch_sessions(spans, jobs.HIGH_LOW, 3))


def test_streams_call_python_for_many_traces_at_once(spark, tmp_path):
    """Sessions are Spark's own windows; keyed state is held by buckets of traces, not by trace."""
    random_spans(spark, 1, 50).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    for job in (st.dependencies_stream, st.paths_stream, st.quality_stream, st.orphan_spans, st.trace_sizes):
        assert "TransformWithState" not in plan(job(stream)) and "session_window" in plan(job(stream))
    for job in (st.large_traces, st.dependency_counts_and_late):
        assert "bucket" in plan(job(stream)).split("TransformWithState")[1]


def test_tables_of_open_sessions_are_joined_as_merged(spark):
    rng = random.Random(2)
    times = [(rng.randrange(6), rng.randrange(3), rng.randrange(400)) for _ in range(300)]
    first = joined(np.array([(a, b, t, t, 1, 0) for a, b, t in times[:150]], np.int64), 2, 5)
    both = joined(np.concatenate([first, np.array([(a, b, t, t, 1, 0) for a, b, t in times[150:]], np.int64)]), 2, 5)
    want = [(a, b, *s) for a in range(6) for b in range(3) for s in merged([], [t for x, y, t in times if (x, y) == (a, b)], 5)]
    assert [tuple(map(int, r[:4])) for r in both] == want and both[:, 4].sum() == 300


def test_streams_have_as_many_stores_as_tasks(spark, tmp_path):
    """Each store is opened and committed in each micro-batch, so they don't follow spark.sql.shuffle.partitions."""
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    random_spans(spark, 1, 50).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    spark.conf.set(name, "50")
    try:
        for n, given in enumerate((None, 7)):
            run = st.run_available(st.trace_sizes(stream), lambda rows, n: rows.collect(), str(tmp_path / f"checkpoint{n}"), given)
            assert {s["numShufflePartitions"] for s in run.lastProgress["stateOperators"]} == {given or spark.sparkContext.defaultParallelism}
        assert spark.conf.get(name) == "50"
    finally:
        spark.conf.set(name, before)


def test_hot_traces_are_scored_without_looking_up_looked_up_rows(spark):
    """All built-in rules together read a hot trace's spans three times: themselves, by id, by parent's id."""
    hot = ss.hot_sessions(random_spans(spark, 4, 40), jobs.LOW, 3)
    scores = ql.score_all(hot, jobs.LOW, spread=True)
    assert scores._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 3
    same(scores.drop("session_end"), ql.score_all(hot, jobs.LOW).drop("session_end"))


def test_a_report_sorts_months_not_ids(spark):
    """Three years of hours of one metric, in two spellings: the ids are in order, and put in order by month."""
    rng = random.Random(5)
    hours = rng.sample(range(26_000), 3000)
    rows = [("s", h * 3600, rng.choice(("Has", "has")), "PASS", 1, f"{h:x}") for h in hours] + [("s", None, "HAS", "pass", 2, "none")]
    metrics = spark.createDataFrame(rows, "service string, at long, metric string, submetric string, count long, trace_id string").withColumn("time_bucket", F.timestamp_seconds("at"))
    report = rp.service_metrics_report(metrics)
    assert "date_trunc(MONTH" in report._jdf.queryExecution().sparkPlan().toString()
    (got,) = report.collect()
    assert (got.metric, got.submetric, got["count"]) == ("HAS", "pass", 3002)
    assert got.trace_ids == ["none", *[f"{h:x}" for h in sorted(hours)]]
    (same_hour,) = rp.service_metrics_report(metrics.where("at is not null").withColumn("time_bucket", F.timestamp_seconds(F.lit(0)))).collect()
    want = sorted((m, i) for _, h, m, _, _, i in rows if h is not None)
    assert same_hour.trace_ids == [i for _, i in want] and same_hour.metric == "Has"


def test_joins_of_hot_traces_are_dealt_by_their_size(spark, monkeypatch):
    """Counts of hot traces come from tasks of bounded size, whatever shuffle partitions and the size that
    Spark likes best are; both are as before afterwards."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before, spans, seen = [spark.conf.get(n) for n in names], random_spans(spark, 6, 400, 40).cache(), []
    want = jobs.dependency_counts(spans)
    monkeypatch.setattr(ss, "TASK_SPANS", 50)
    monkeypatch.setattr(jobs, "written", lambda df, name: seen.append([spark.conf.get(n) for n in names]) or written(df, name))
    same(jobs.dependency_counts(spans, hot_spans=2), want)
    assert [size for _, size in seen] == [ss.TASK_BYTES] and int(seen[0][0]) > int(before[0]) and [spark.conf.get(n) for n in names] == before


def test_tables_of_large_traces_are_dealt_by_their_size(spark, monkeypatch):
    """Pointer doubling's tables too; traces that need the walk are only looked for where there are some."""
    name, seen = "spark.sql.adaptive.advisoryPartitionSizeInBytes", []
    tree = spark.range(400).selectExpr("id div 20 AS trace_id_low", "id % 20 + 1 AS span_id", "(id % 20 + 1) div 2 AS parent_span_id", "'s' AS service", "concat('o', id % 3) AS operation", "'SERVER' AS span_kind", f"{T0} + id AS start_time_us")
    traces = ss.annotate_sessions(tree, jobs.LOW, 5).cache()
    monkeypatch.setattr(pt, "written", lambda df, table: seen.append(spark.conf.get(name)) or written(df, table))
    found = pt.trace_paths(traces, spread=True)
    assert set(seen) == {ss.TASK_BYTES} and spark.conf.get(name) != ss.TASK_BYTES
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    same(found, pt.trace_paths(traces))


def test_keys_are_counted_only_where_many_spans_meet(spark, monkeypatch):
    """Spans are counted by a few buckets first; keys are counted in buckets that can hold a hot one."""
    seen, plans = [], []
    monkeypatch.setattr(ss, "written", lambda df, name: seen.append(name) or plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or written(df, name))
    spans = spark.range(4000).selectExpr("id div 4 AS trace_id_low", "id AS span_id")
    assert ss.split_hot(spans, jobs.LOW, 400)[1] is None and seen == ["full_buckets"]
    assert "Aggregate [trace_id_low" not in plans[0] and "Aggregate [(id" not in plans[0] and "__bucket" in plans[0]
    more = spans.unionByName(spark.range(900).selectExpr("if(id < 500, 7L, 3000L + id % 3) AS trace_id_low", "id AS span_id"))
    cold, hot = ss.split_hot(more, jobs.LOW, 400)
    assert seen[1:] == ["full_buckets", "hot"] and {r[0] for r in hot.select("trace_id_low").distinct().collect()} == {7}
    assert hot.count() == 504 and cold.count() == 4396
    # a full bucket of keys that aren't hot
    assert ss.split_hot(more, jobs.LOW, 504)[1] is None and ss.split_hot(more, jobs.LOW, 503)[1].count() == 504


def test_a_window_s_row_counts_its_pairs_once(spark):
    """The dependency job's rows come from edges: pairs are dealt once, and the rows are those of partial counts."""
    spans = random_spans(spark, 7, 300, 40).cache()
    out = jobs.dependencies_job(spans)
    assert out._jdf.queryExecution().sparkPlan().toString().count("Aggregate(keys=[window_") == 4  # by pair and by window, each partial and whole
    counts = jobs.dependency_counts(spans)
    for other in (dp.dependencies_rollup(counts), jobs.dependencies_job(spans, hot_spans=2)):
        same(out.withColumn("dependencies", F.to_json("dependencies")), other.withColumn("dependencies", F.to_json("dependencies")))


def test_spans_of_streams_come_in_order_and_as_columns():
    """A step sees each session's spans with their names; sessions without spans give no rows."""
    kind = T.StructType.fromDDL("n long, p array<struct<service: string, operation: string>>")
    made = streams._made(lambda spans: [(s["a"], [(s["b"], None)] * k) for k, s in enumerate(spans)], ["a", "b"], kind).func
    given = pa.array([[{"a": 1, "b": "x"}, {"a": None, "b": "y"}], [], None, [{"a": 3, "b": None}]], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.string())])))
    p = lambda *services: [{"service": s, "operation": None} for s in services]
    want = [[{"n": 1, "p": []}, {"n": None, "p": p("y")}], [], [], [{"n": 3, "p": []}]]
    assert made(given).to_pylist() == want and made(given.slice(1)).to_pylist() == want[1:] and made(given[1:2]).to_pylist() == [[]]


def test_paths_of_streams_are_hashed(spark, tmp_path):
    """The exemplar of a path is found on numbers: a text as the least would have all paths sorted."""
    random_spans(spark, 1, 50).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    plan = st.paths_stream(stream)._jdf.queryExecution().analyzed().toString()
    assert "min(trace_id" not in plan and "sort_array(collect_list" in plan


@pytest.mark.parametrize("years", [1, 30, 2000])
def test_late_spans_are_told_of_however_late_they_are(spark, tmp_path, years):
    """A table of decades has spans that come decades after the watermark has passed them."""
    spans, after = random_spans(spark, 7, 300, 12).where("is_client or is_server").cache(), years * 366 * 86_400
    late = spans.where("trace_id_low = 3")
    parts = [spans.where("trace_id_low <> 3"), closing(spark, spans, after), closing(spark, spans, after + 4000), late, closing(spark, spans, after + 90_000)]
    out = []
    stream = st.dependency_counts_and_late(stream_of(spark, str(tmp_path / "in"), parts))
    st.run_available(stream, lambda rows, n: out.extend(rows.collect()), str(tmp_path / "check"))
    assert {r.late_trace for r in out if r.late} == {"0:3"} and sum(r.late for r in out) == late.count() > 5
    assert sum(r.call_count for r in out) == jobs.dependency_counts(parts[0]).agg(F.sum("call_count")).first()[0]


@pytest.mark.parametrize("name", ["stream_quality", "stream_dependencies", "stream_paths", "stream_trace_sizes", "stream_orphan_spans", "stream_large_traces"])
def test_streams_take_many_spans_in_slices_of_time(spark, monkeypatch, name):
    """State, shuffles and input are those of a slice; results are those of the whole."""
    small, runs, run = "/root/testdata/sf0.001", [], st.run_available
    monkeypatch.setattr(q, "_SLICE_SPANS", 2500)
    monkeypatch.setattr(st, "run_available", lambda *args: runs.append(run(*args)))
    got = q.QUERIES[name](spark, small).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{small}/lineitem.parquet'")
    want = con.sql(q.ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, got[columns].itertuples(index=False, name=None))) == sorted(map(repr, want[columns].itertuples(index=False, name=None)))
    taken = [sum(p["numInputRows"] for p in r.recentProgress) for r in runs]
    assert len(taken) == 3 and sum(taken) == 6001 and max(taken) < 3000
