"""Hot traces, sessions in state, large traces' paths, snapshots of result tables, size sketches."""

import random
import threading
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spanloom.operators import paths as pt
from spanloom.operators import sessions as ss
from spanloom.operators import sizes as sz
from spanloom.plans import jobs
from spanloom.sources import tables
from spanloom.sources.commits import KEPT, Commits
from spanloom.streaming import jobs as st
from spanloom.streaming.sessions import merged, trace_sessions

T0 = 1_000_000_000_000_000
SPANS = "trace_id_high long, trace_id_low long, span_id long, parent_span_id long, service string, operation string, span_kind string, is_server boolean, is_client boolean, peer_service string, client_version string, start_time_us long"


def random_spans(spark, seed, n=3000, traces=60):
    """A third of the spans in the trace 0, most of them without a parent; ids shared, missing and doubled."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        t = 0 if rng.random() < 1 / 3 else rng.randrange(1, traces)
        kind = rng.choice(["SERVER", "CLIENT", "LOCAL", None])
        at = T0 + rng.randrange(40) * 60_000_000 + rng.randrange(20) * 1_000_000 + rng.randrange(3) * 500
        rows.append((0, t, rng.randrange(30), rng.choice([0, 0, rng.randrange(40)]), rng.choice(["a", "b", "c", None]), rng.choice(["x", "y"]), kind, kind == "SERVER", kind == "CLIENT", rng.choice(["p", "", None]), rng.choice(["go-2.6.0", "java-0.0.1", None]), at + len(rows) % 7))
    return spark.createDataFrame(rows, SPANS)


def same(a, b):
    a, b = (Counter(map(repr, x.select(sorted(x.columns)).collect())) for x in (a, b))
    assert a == b and a


@pytest.mark.parametrize("seed", [1])
def test_hot_traces_give_the_same_rows(spark, seed):
    spans = random_spans(spark, seed).cache()
    for job in (jobs.dependency_sessions, jobs.path_sessions, jobs.quality_sessions, jobs.quality_job, jobs.unique_paths):
        same(job(spans, hot_spans=None), job(spans, hot_spans=100))
    for dedupe in (True, False):
        same(jobs.dependency_counts(spans, dedupe, hot_spans=None), jobs.dependency_counts(spans, dedupe, hot_spans=100))
    plain = ss.annotate_sessions(spans, jobs.LOW, 3)
    for minutes in (1, 2, 60, 10_000):
        same(plain, ss.stitch_sessions(spans, jobs.LOW, 3, minutes))
    assert ss.split_hot(spans, jobs.LOW, 2000)[1] is None and jobs.quality_job(spans.limit(0)).count() == 0
    cold, hot = ss.split_hot(spans, jobs.LOW, 100)
    assert hot.select("trace_id_low").distinct().count() == 1 and cold.count() + hot.count() == spans.count()


def test_a_hot_trace_is_dealt_to_all_tasks(spark):
    """One trace, one parent that all ask for: no partition of the look-ups' inputs has over twice the median."""
    spans = spark.range(40_000).select(F.lit(0).cast("long").alias("trace_id_low"), (F.col("id") + 1).alias("span_id"), F.lit(1).cast("long").alias("parent_span_id"), F.lit("a").alias("service"), (F.lit(T0) + F.col("id") * 1_000_000).alias("start_time_us"))
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = ss.over_id(ss.hot_sessions(spans, jobs.LOW, 3), jobs.LOW, {"n": F.count("*")}, spread=True)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]


def walked(spans):
    """Paths of each session by the plain walk."""
    groups = defaultdict(list)
    for r in spans.orderBy("trace_id_low", "sid", "start_time_us", "span_id", "parent_span_id", "service", "operation", "span_kind").collect():
        groups[r.trace_id_low, r.sid].append(r.asDict())
    return Counter((*k, tuple(p)) for k, s in groups.items() for p in pt.walk(s))


@pytest.mark.parametrize("seed", range(3))
def test_paths_by_doubling_equal_the_walk(spark, seed):
    """Random graphs: trees, cycles, orphans, several roots and parents, own parents, doubled ids."""
    rng = random.Random(seed)
    rows = []
    for t in range(150):
        n = rng.randrange(1, 14)
        for i in range(n):
            parent = rng.randrange(i + 1) if rng.random() < 0.6 else rng.choice([0, i, rng.randrange(n + 3)])
            rows.append((t, i if rng.random() < 0.9 else rng.randrange(n), parent, rng.choice(["a", "b", "", None]), rng.choice(["o", None]), rng.choice(["SERVER", "SERVER", "CLIENT", None]), T0 + rng.randrange(30) * 1000))
    spans = jobs.path_sessions(spark.createDataFrame(rows, "trace_id_low long, span_id long, parent_span_id long, service string, operation string, span_kind string, start_time_us long")).cache()
    got = Counter((r.trace_id_low, r.sid, tuple((n.service, n.operation) for n in r.path)) for r in pt.trace_paths(spans, spread=True).collect())
    assert got == walked(spans)
    same(pt.trace_paths(spans, limit=3), pt.trace_paths(spans, limit=3, spread=True))
    nodes, odd = pt.tree_nodes(spans, jobs.LOW)
    assert nodes.select("trace_id_low").distinct().count() > 40 and odd.count() > 5


def test_paths_of_a_wide_and_of_a_deep_trace(spark):
    """100,000 spans under one, and a chain whose path is over the cap: log(depth) rounds, no task per trace."""
    names = [F.lit("service").alias("service"), F.lit("op").alias("operation"), F.lit("SERVER").alias("span_kind")]
    wide = spark.range(100_000).select(F.lit(1).cast("long").alias("trace_id_low"), (F.col("id") + 1).alias("span_id"), F.when(F.col("id") == 0, 0).otherwise(1).cast("long").alias("parent_span_id"), *names, F.lit(T0).alias("start_time_us"))
    deep = spark.range(9000).select(F.lit(2).cast("long").alias("trace_id_low"), (F.col("id") + 1).alias("span_id"), F.col("id").alias("parent_span_id"), *names, F.lit(T0).alias("start_time_us"))
    out = jobs.unique_paths(wide.unionByName(deep), hot_spans=8_000).collect()
    assert sorted((len(r.path), r.path[0].service, r.trace_id) for r in out) == [(1, "Exceeded", "2"), (2, "service", "1")]


def test_sessions_grow_together():
    assert merged([], [5, 0, 11], 5) == [(0, 5), (11, 11)]
    assert merged([(0, 5), (11, 11)], [8], 5) == [(0, 11)] and merged([(0, 0)], [6], 5) == [(0, 0), (6, 6)]
    assert merged([(0, 10)], [3], 1) == [(0, 10)]


def stream_of(spark, path, parts):
    for n, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(path)
        del n
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def closing(spark, spans, after_s):
    """A span of a trace of its own, so much later that all sessions before it end."""
    last = spans.agg(F.max("start_time_us")).first()[0]
    return spark.createDataFrame([(9, 999, 1, 0, None, None, None, True, False, None, None, last + after_s * 1_000_000)], SPANS)


def test_a_long_session_over_many_batches(spark, tmp_path):
    """100,000 spans of one trace in ten micro-batches: added to a list, read once when the session ends."""
    parts = []
    for n in range(10):
        ids = spark.range(n * 10_000, (n + 1) * 10_000)
        parts.append(ids.selectExpr("1L AS trace_id_high", "7L AS trace_id_low", "id + 1 AS span_id", "id div 10 AS parent_span_id", "concat('s', id % 3) AS service", "'o' AS operation", "'SERVER' AS span_kind", "true AS is_server", "false AS is_client", "cast(null AS string) AS peer_service", "cast(null AS string) AS client_version", f"{T0} + id * 10000 AS start_time_us"))
    parts.append(closing(spark, parts[-1], 10_000))
    out = []
    stream = st.dependency_counts(stream_of(spark, str(tmp_path / "in"), parts))
    st.run_available(stream, lambda rows, n: out.extend(rows.collect()), str(tmp_path / "check"))
    whole = parts[0]
    for p in parts[1:-1]:
        whole = whole.unionByName(p)
    want = {(r.parent, r.child): r.call_count for r in jobs.dependency_counts(whole).collect()}
    assert {(r.parent, r.child): r.call_count for r in out} == want and sum(want.values()) == 99_990


def test_sessions_of_a_stream_equal_the_batch(spark, tmp_path):
    """Spans out of order within the watermark bridge sessions that were apart; later ones are dropped."""
    spans = random_spans(spark, 5, 900, 25).where("is_client or is_server").cache()
    rows = sorted(spans.collect(), key=lambda r: r.start_time_us + random.Random(r.start_time_us).randrange(500) * 1_000_000)
    parts = [spark.createDataFrame(rows[i : i + 150], SPANS) for i in range(0, len(rows), 150)]
    late = spark.createDataFrame([(0, 3, 1, 0, "a", "x", "SERVER", True, False, None, None, T0)] * 3, SPANS)
    parts += [closing(spark, spans, 5000), late, closing(spark, spans, 90_000)]
    sizes = trace_sessions(stream_of(spark, str(tmp_path / "in"), parts), jobs.HIGH_LOW, 3, (), lambda s: [(len(s), s[0]["start_time_us"])], "n long, first_us long", 10)
    out = []
    st.run_available(sizes, lambda rows, n: out.extend(rows.collect()), str(tmp_path / "check"))
    got = sorted((r.trace_id_low, r.sid, r.n, r.first_us) for r in out if r.trace_id_low != 999)
    grouped = ss.annotate_sessions(spans, jobs.HIGH_LOW, 3).groupBy("trace_id_low", "sid").agg(F.count("*").alias("n"), F.min("start_time_us").alias("f"))
    assert got == sorted((r.trace_id_low, r.sid, r.n, r.f) for r in grouped.collect())


def counters(spark, n, service="a"):
    rows = [(service, "M", "PASS", n, f"{n:x}")]
    return spark.createDataFrame(rows, "service string, metric string, submetric string, count long, trace_id string").withColumn("time_bucket", F.timestamp_seconds(F.lit(7200)))


def total(spark, path):
    return tables.read_quality(spark, path).agg(F.sum("count")).first()[0]


def test_runs_add_up_and_batches_replace_their_own(spark, tmp_path):
    path = str(tmp_path / "q")
    with pytest.raises(ValueError, match="nothing was written"):
        tables.read_quality(spark, path)
    tables.write_quality(counters(spark, 1), path)
    tables.write_quality(counters(spark, 2), path)  # a second batch run
    for batch, n in ((0, 10), (1, 20), (1, 20)):  # a stream whose last batch is retried
        tables.write_quality(counters(spark, n), path, batch, "checkpoint-1")
    tables.write_quality(counters(spark, 100), path, 0, "checkpoint-2")  # one with a new checkpoint
    assert total(spark, path) == 133
    other = tmp_path / "other"
    other.mkdir()
    (other / "part-0.parquet").write_text("x")
    with pytest.raises(ValueError, match="holds other files"):
        tables.write_dependencies(counters(spark, 1), str(other))


def test_merging_bounds_files_and_knows_merged_batches(spark, tmp_path):
    path = str(tmp_path / "q")
    for batch in range(14):
        before = Commits(spark, path).read()
        tables.write_quality(counters(spark, 1, f"s{batch % 2}"), path, batch, "run", merge_from=3)
        tables.write_quality(counters(spark, 1, f"s{batch % 2}"), path, batch, "run", merge_from=3)  # a retry
        assert len(Commits(spark, path).read()["live"]) < 3
        if before["live"]:
            assert Commits(spark, path).rows(before).agg(F.sum("count")).first()[0] == batch  # readers of the last version go on
    assert total(spark, path) == 14 and Commits(spark, path).read()["merged"] == {"run": 13 if len(Commits(spark, path).read()["live"]) == 1 else 12}
    folders = list((tmp_path / "q" / "data").iterdir())
    assert len(folders) <= 2 * KEPT + 3 and len(Commits(spark, path).versions()) <= 2 * KEPT


def test_parallel_writers_lose_nothing(spark, tmp_path):
    path, failed = str(tmp_path / "q"), []

    def run(name):
        try:
            for batch in range(5):
                tables.write_quality(counters(spark, 1), path, batch, name, merge_from=4)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(f"writer {n}",)) for n in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and total(spark, path) == 15


def test_report_reads_only_its_days(spark, tmp_path):
    path = str(tmp_path / "q")
    days = spark.range(40).select(F.lit("a").alias("service"), F.lit("M").alias("metric"), F.lit("PASS").alias("submetric"), F.lit(1).cast("long").alias("count"), F.lit("1").alias("trace_id"), F.timestamp_seconds(F.col("id") * 86400).alias("time_bucket"))
    tables.write_quality(days, path)
    report = jobs.report_job(spark, path, "1970-02-09 01:00:00", 30)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and report.first()["count"] == 2


def test_sketches_are_within_their_bound_and_merge(spark):
    rng = random.Random(8)
    rows = [(w, int(rng.paretovariate(0.6)) + 1, rng.randrange(1, 4)) for w in range(3) for _ in range(400)]
    hist = spark.createDataFrame(rows, "w int, size long, traces long").selectExpr("timestamp_seconds(w * 1800) AS window_start", "timestamp_seconds(w * 1800 + 1800) AS window_end", "size", "traces")
    ranks = (0.0, 0.01, 0.5, 0.9, 0.999, 1.0)
    for accuracy in (0.01, 0.1):
        parts = [sz.sketch(hist.where(F.col("size") % 3 == n), accuracy) for n in range(3)]
        found = sz.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]))
        rough = {(str(r.window_start), r.rank): r.size for r in sz.quantiles(found, ranks, accuracy).collect()}
        for r in sz.exact_quantiles(hist, ranks).collect():
            every = sorted(s for w, s, n in rows for _ in range(n) if w * 1800 == r.window_start.timestamp())
            assert r.size == every[max(0, -(-int(r.rank * 1000 * len(every)) // 1000) - 1)] or abs(every.index(r.size) - r.rank * len(every)) <= every.count(r.size)
            assert abs(rough[str(r.window_start), r.rank] - r.size) <= accuracy * r.size * 1.000001
    hours = sz.coarser(sz.sketch(hist), 60)
    assert hours.count() < 1200 and hours.agg(F.sum("traces")).first()[0] == sum(n for *_, n in rows)
    assert sz.quantiles(sz.sketch(hist.limit(0))).count() == 0


def test_postings_give_the_index_rows_and_grow_with_the_path(spark, tmp_path):
    def unique(n):
        node = F.struct(F.concat(F.lit("service-"), F.col("i")).alias("service"), F.concat(F.lit("operation-"), F.col("i")).alias("operation"))
        rows = spark.range(n).select(F.col("id").alias("i"), node.alias("n")).agg(F.array_agg("n").alias("path"))
        return rows.select(F.timestamp_seconds(F.lit(0)).alias("window_start"), F.timestamp_seconds(F.lit(600)).alias("window_end"), "path", F.lit("ab").alias("trace_id"))

    size = lambda path: sum(p.stat().st_size for p in path.rglob("*.parquet"))
    one = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "none")
    try:
        written = {}
        for n in (100, 800):
            tables.write_path_postings(unique(n), str(tmp_path / f"{n}"), 0, "run")
            tables.write_path_postings(unique(n), str(tmp_path / f"{n}"), 0, "run")  # a retry
            written[n] = size(tmp_path / f"{n}")
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", one)
    assert written[800] < 9 * written[100]
    path = str(tmp_path / "100")
    tables.write_path_postings(unique(3), path, 1, "run")
    tables.write_path_postings(unique(3).withColumn("path", F.array().cast("array<struct<service: string, operation: string>>")), path, 2, "run")
    index = pt.focal_node_index(unique(100).unionByName(unique(3)))
    same(index, tables.read_path_postings(spark, path))
    some = tables.read_path_postings(spark, path, "service-2", "operation-2", "1970-01-01 00:00:00")
    same(some, index.where("focal_node.service = 'service-2' and focal_node.operation <> ''"))
    assert tables.read_path_postings(spark, path, "service-2", since="1970-01-02").count() == 0


def test_ranges_equal_sums_of_hours(spark, tmp_path):
    rng, path = random.Random(6), str(tmp_path / "levels")
    hours = [(rng.choice("ab"), "M", rng.choice(["PASS", "FAIL"]), rng.randrange(1, 9), f"{rng.randrange(99):x}", rng.randrange(0, 24 * 400)) for _ in range(3000)]
    table = spark.createDataFrame(hours, "service string, metric string, submetric string, count long, trace_id string, hour long").withColumn("time_bucket", F.timestamp_seconds(F.col("hour") * 3600)).drop("hour").cache()
    for n in range(4):
        tables.write_quality_levels(table.where(F.crc32("trace_id") % 4 == n), path, n, "run", merge_from=3)
    assert len(Commits(spark, path).read()["live"]) < 3
    for a, b in ((0, 24 * 400), (5, 24 * 90 + 7), (24 * 31, 24 * 59), (24 * 30 + 23, 24 * 31 + 1), (100, 101), (24 * 364, 24 * 367), (50, 50)):
        since, until = (f"{x // 24} days {x % 24} hours" for x in (a, b))
        at = lambda x: F.timestamp_seconds(F.lit(x * 3600))
        want = table.where((F.col("time_bucket") >= at(a)) & (F.col("time_bucket") < at(b))).groupBy("service", "metric", "submetric").agg(F.sum("count").alias("count"), F.min("trace_id").alias("trace_id"))
        got = tables.read_quality_range(spark, path, at(a), at(b))
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())), (since, until)
    # half a year is some 60 rows for each key, not 4,380
    plan = tables.read_quality_range(spark, path, "1970-01-15 05:00:00", "1970-07-15 20:00:00")
    assert plan.count() == 4


def test_large_traces_are_told_of_while_they_are_open(spark, tmp_path):
    parts = [spark.range(n * 30, n * 30 + 30).selectExpr("0L AS trace_id_high", "5L AS trace_id_low", "id AS span_id", "0L AS parent_span_id", "'a' AS service", "'o' AS operation", "'SERVER' AS span_kind", "true AS is_server", "false AS is_client", "cast(null AS string) AS peer_service", "cast(null AS string) AS client_version", f"{T0} + id * 1000000 AS start_time_us") for n in range(4)]
    out = []
    stream = st.large_traces(stream_of(spark, str(tmp_path / "in"), parts), threshold=50)
    st.run_available(stream, lambda rows, n: out.extend((n, *r) for r in rows.collect()), str(tmp_path / "check"))
    assert out == [(1, 0, 5, T0 // 1000, 60)]  # once, in the second of four batches


def test_late_spans_are_counted_and_kept_plus_late_is_all(spark, tmp_path):
    spans = random_spans(spark, 7, 300, 12).where("is_client or is_server").cache()
    late = spans.where("trace_id_low = 3")
    on_time = spans.where("trace_id_low <> 3").withColumn("parent_span_id", F.col("span_id"))  # each its own parent: an edge for each span
    parts = [on_time.where("service is not null"), closing(spark, spans, 5000), closing(spark, spans, 9000), late, closing(spark, spans, 90_000)]
    out = []
    stream = st.dependency_counts_and_late(stream_of(spark, str(tmp_path / "in"), parts))
    st.run_available(stream, lambda rows, n: out.extend(rows.collect()), str(tmp_path / "check"))
    assert {r.late_trace for r in out if r.late} == {"0:3"} and sum(r.late for r in out) == late.count() > 5
    assert sum(r.call_count for r in out) == jobs.dependency_counts(parts[0]).agg(F.sum("call_count")).first()[0]


def test_traces_by_both_halves_of_their_ids(spark):
    """Traces that share the low half are one by default, and two with both halves as keys."""
    rows = [(h, 1, i, i - 1, s, "o", "SERVER", True, False, None, None, T0 + i * 1000) for h, s in ((1, "a"), (2, "b")) for i in (1, 2)]
    spans = spark.createDataFrame(rows, SPANS)
    chains = lambda out: sorted("".join(n.service for n in r.path) for r in out.collect())
    assert chains(jobs.unique_paths(spans, keys=jobs.HIGH_LOW)) == ["aa", "bb"] != chains(jobs.unique_paths(spans))
    unique = lambda out: {r.submetric for r in out.where("metric = 'HasUniqueSpanIds'").collect()}
    assert unique(jobs.quality_job(spans, keys=jobs.HIGH_LOW)) == {"PASS"} and unique(jobs.quality_job(spans)) == {"FAIL"}
    same(jobs.quality_job(spans, keys=jobs.HIGH_LOW), jobs.quality_job(spans, keys=jobs.HIGH_LOW, hot_spans=1))
    same(jobs.unique_paths(spans, keys=jobs.HIGH_LOW), jobs.unique_paths(spans, keys=jobs.HIGH_LOW, hot_spans=1))


def test_a_restarted_stream_goes_on_where_it_stopped(spark, tmp_path):
    """Two runs on one checkpoint, the last batch of the first written again by hand: as one batch run."""
    spans = random_spans(spark, 11, 400, 20).where("trace_id_low <> 0").cache()
    first, second = spans.where("trace_id_low % 2 = 0"), spans.where("trace_id_low % 2 = 1").withColumn("start_time_us", F.col("start_time_us") + 20_000_000_000)
    path, check, out = str(tmp_path / "in"), str(tmp_path / "check"), str(tmp_path / "out")
    written = []

    def write(rows, n):
        kept = rows.collect()
        written.append((n, kept, rows.schema))
        tables.write_quality(spark.createDataFrame(kept, rows.schema), out, n, check, merge_from=3)

    for parts in ([first, closing(spark, first, 5000)], [second, closing(spark, second, 90_000)]):
        stream = st.quality_stream(stream_of(spark, path, parts))
        st.run_available(stream, write, check)
        n, kept, schema = max((x for x in written if x[1]), key=lambda x: x[0])
        tables.write_quality(spark.createDataFrame(kept, schema), out, n, check, merge_from=3)  # as if it had failed behind the commit
    got = tables.read_quality(spark, out).select("service", "time_bucket", "metric", "submetric", "count", "trace_id")
    want = jobs.quality_job(first.unionByName(second)).select(*got.columns)
    # (the first closing span ends in the second run, as a server without a parent or a service)
    same(want, got.where("trace_id <> '3e7'"))
