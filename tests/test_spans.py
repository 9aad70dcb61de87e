"""Single operators on hand-written spans."""

import random
from collections import Counter
from unittest import mock

import pytest
from pyspark.sql import functions as F

from spanloom.functions import spans as fs
from spanloom.functions.versions import meets_minimum, version_at_least
from spanloom.operators import dependencies as dep
from spanloom.operators import paths as pt
from spanloom.operators import quality as ql
from spanloom.operators import report as rp
from spanloom.operators.dedupe import dedupe_span_ids
from spanloom.operators.sessions import annotate_sessions, large_traces
from spanloom.plans import jobs
from spanloom.schema import ENVELOPE, SPAN, avro_schema
from spanloom.sources import spans as sp
from spanloom.sources import tables
from spanloom.sources.shared import shared_dir
from spanloom.sources.spans import decode_json_envelope
from spanloom.streaming import jobs as st

HL = ("trace_id_high", "trace_id_low")


def flat(spark, rows, t0=1_000_000_000_000_000):
    """rows: (trace, id, parent, service, kind[, peer[, version]]); one ms apart in order."""
    full = [(t, t, i, p, s, k == "server", k == "client", (k or "").upper() or None, s.upper(), (*r, None, None)[0], (*r, None, None)[1], t0 + 1000 * n) for n, (t, i, p, s, k, *r) in enumerate(rows)]
    names = "trace_id_high long, trace_id_low long, span_id long, parent_span_id long, service string, is_server boolean, is_client boolean, span_kind string, operation string, peer_service string, client_version string, start_time_us long"
    return spark.createDataFrame(full, names).withColumn("ts", fs.event_time("start_time_us"))


def test_dedupe_renames_shared_servers(spark):
    rows = [(1, 100, 0, "a", "client"), (1, 100, 0, "a", "server"), (1, 11, 100, "a", "client"), (1, 201, 11, "a", "client"), (1, 201, 11, "a", "server")]
    out = dedupe_span_ids(annotate_sessions(flat(spark, rows), HL, 3), HL)
    assert sorted((r.span_id, r.parent_span_id) for r in out.collect()) == sorted([(100, 0), (1, 100), (11, 1), (201, 11), (2, 201)])
    assert [(s["span_id"], s["parent_span_id"]) for s in st.adjusted([r.asDict() for r in flat(spark, rows).orderBy("start_time_us").collect()])] == [(100, 0), (1, 100), (11, 1), (201, 11), (2, 201)]


def test_dedupe_leaves_others_alone(spark):
    out = dedupe_span_ids(annotate_sessions(flat(spark, [(1, 100, 0, "a", "server"), (1, 11, 100, "a", None)]), HL, 3), HL)
    assert sorted((r.span_id, r.parent_span_id) for r in out.collect()) == [(11, 100), (100, 0)]


@pytest.mark.parametrize(
    ("rows", "pairs"),
    [
        ([(1, 1, 0, "a", "server")], []),
        ([(1, 1, 0, "a", "server"), (1, 2, 1, "a", "server")], [("a", "a")]),
        ([(1, 1, 0, "a", "server"), (1, 2, 1, "b", "server"), (1, 3, 1, "b", "server")], [("a", "b")] * 2),
        ([(1, 1, 0, "a", "s"), (1, 2, 1, "b", "s"), (1, 3, 1, "c", "s"), (1, 4, 2, "d", "s"), (1, 5, 4, "e", "s"), (1, 6, 4, "a", "s"), (1, 7, 6, "c", "s")], [("a", "b"), ("a", "c"), ("b", "d"), ("d", "e"), ("d", "a"), ("a", "c")]),
    ],
)
def test_edges(spark, rows, pairs):
    out = dep.trace_edges(annotate_sessions(flat(spark, rows), HL, 3), HL)
    assert sorted((r.parent, r.child) for r in out.collect()) == sorted(pairs)
    assert sorted(st.edges_of([r.asDict() for r in flat(spark, rows).collect()])) == sorted(pairs)


def test_dependencies_end_to_end(spark):
    rows = [(12, 5, 0, "1", "server"), (12, 6, 5, "2", "client"), (12, 7, 5, "2", "client"), (12, 8, 5, "3", "client"), (12, 8, 5, "3", None), (50, 5, 0, "4", "client"), (50, 5, 0, "5", "server")]
    counts = jobs.dependency_counts(flat(spark, rows))
    assert {(r.parent, r.child, r.call_count) for r in counts.collect()} == {("1", "2", 2), ("1", "3", 1), ("4", "5", 1)}
    # two sessions merge: partial counts of a pair add up
    twice = dep.dependencies_rollup(counts.union(counts)).collect()
    assert len(twice) == 1 and {d.call_count for d in twice[0].dependencies} == {4, 2}


def test_session_gap_is_inclusive(spark):
    at = [0, 180_000, 360_001]
    df = spark.createDataFrame([(1, 1, i, t * 1000) for i, t in enumerate(at)], "trace_id_high long, trace_id_low long, span_id long, start_time_us long")
    assert sorted(r.sid for r in annotate_sessions(df, HL, 3).collect()) == [0, 0, 360_001]
    assert large_traces(annotate_sessions(df, HL, 3), threshold=1).collect()[0].n == 2


def walk(rows):
    return pt.walk([{"span_id": i, "parent_span_id": p, "service": s, "operation": s, "span_kind": k} for i, p, s, k in rows])


def test_walk():
    s, c = "SERVER", "CLIENT"
    assert walk([(1, 0, "A", s)]) == [[("A", "A")]]
    assert walk([(1, 0, "A", s), (2, 1, "B", c), (3, 1, "C", None)]) == [[("A", "A")]] * 2
    assert walk([(1, 0, "A", s), (2, 1, "B", s), (3, 1, "C", s)]) == [[("A", "A"), ("B", "B")], [("A", "A"), ("C", "C")]]
    assert walk([(1, 0, "A", s), (0, 1, "B", s)]) == [[("A", "A"), ("B", "B")]]
    assert walk([(0, 1, "B", s)]) == []
    assert walk([(1, 0, "A", c)]) == [[]]
    deep = [(i, i - 1, "x", s) for i in range(1, 30_000)]
    assert len(walk(deep)[0]) == 29_999


def test_path_index(spark):
    rows = [(100, 1, 0, "a", "server"), (100, 2, 1, "b", "server"), (100, 3, 1, "c", "server")]
    out = jobs.paths_job(flat(spark, rows, 1_196_677_812_000_000)).collect()  # 2007-12-03T10:30:12Z
    assert len(out) == 8 and {str(r.ts_bucket) for r in out} == {"2007-12-03 10:00:00"}
    assert {r.attributes[0].value for r in out} == {"64"}


def counters(spark, rows):
    traces = {}
    for r in ql.score_all(jobs.quality_sessions(flat(spark, rows)), jobs.LOW, (), (ql.score_has_client_server,)).collect():
        k = (r.service, "".join(c for c in r.metric if c.isupper())[:2], r.submetric)
        traces[k] = traces.get(k, 0) + 1
    return traces


def test_client_server_rules(spark):
    big = [(1, 1, 0, "a", "server"), (1, 2, 1, "a", "client"), (1, 3, 1, "a", "client"), (1, 4, 2, "b", "server"), (1, 5, 3, "c", "server")]
    assert counters(spark, big) == {("a", "HS", "PASS"): 1, ("a", "HC", "PASS"): 2, ("b", "HS", "PASS"): 1, ("c", "HS", "PASS"): 1}
    assert counters(spark, [(1, 1, 0, "a", "server", "b")]) == {("a", "HS", "PASS"): 1, ("b", "HC", "FAIL"): 1}
    assert counters(spark, [(1, 1, 0, "a", "client", "b")]) == {("a", "HC", "PASS"): 1, ("b", "HS", "FAIL"): 1}
    assert counters(spark, [(1, 1, 0, "a", "server"), (1, 2, 1, "b", "server")]) == {("a", "HS", "PASS"): 1, ("b", "HC", "FAIL"): 1}
    assert counters(spark, [(1, 1, 0, "a", "server"), (1, 2, 1, "b", "server", "p")]) == {("a", "HS", "PASS"): 1, ("p", "HC", "FAIL"): 1}
    assert counters(spark, [(1, 1, 0, "a", "client"), (1, 2, 1, "b", "client")]) == {("a", "HC", "PASS"): 1, ("b", "HS", "FAIL"): 1}


def test_versions(spark):
    bad = ["Go-2.5.9", "java-0.0.16", "python-3.4.0", "node-2.1.1", "", "go-", "5.5.5", None]
    good = ["Go-2.6.1", "java-0.2.18", "python-3.9.0", "node-3.1.1", "go-2"]
    out = spark.createDataFrame([(v,) for v in bad + good], "v string").select(meets_minimum(F.col("v")).alias("ok")).collect()
    assert [r.ok for r in out] == [False] * len(bad) + [True] * len(good)
    got = spark.createDataFrame([("3",), ("1.2.3",), ("0.2",), ("1.2.3dev",), ("1.99999999999",)], "v string").select(version_at_least(F.col("v"), "1.2.3").alias("ok")).collect()
    assert [r.ok for r in got] == [True, True, False, False, False]
    assert [st._new_enough(v) for v in bad + good] == [False] * len(bad) + [True] * len(good)


def test_unique_ids_and_client_version(spark):
    out = jobs.quality_job(flat(spark, [(1, 1, 0, "a", "client", None, "version-string"), (1, 1, 0, "b", "server"), (1, 2, 1, "c", "server")]))
    got = {(r.service, r.metric, r.submetric): r["count"] for r in out.collect()}
    assert got["a", "HasUniqueSpanIds", "FAIL"] == got["b", "HasUniqueSpanIds", "FAIL"] == got["c", "HasUniqueSpanIds", "PASS"] == 1
    assert got["a", "ClientVersion", "version-string"] == 1


def test_reports(spark):
    rows = [("ueta", "HasServerSpans", "PASS", 100, "123"), ("fry", "HasServerSpans", "PASS", 100, "1"), ("fry", "hasserverspans", "fail", 100, "2"), ("fry", "HasUniqueSpanIds", "PASS", 100, "3"), ("fry", "HasUniqueSpanIds", "FAIL", 300, "4"), ("none", "ClientVersion", "go-1", 5, "6")]
    m = spark.createDataFrame(rows, "service string, metric string, submetric string, count long, trace_id string").withColumn("time_bucket", F.timestamp_seconds(F.lit(7200)))
    report = {(r.service, r.metric, r.submetric): r for r in rp.sorted_metrics(rp.service_metrics_report(m)).collect()}
    one = report["ueta", "HasServerSpans", "PASS"]
    assert (one.description, one.type, one.trace_ids, one["count"]) == ("The service emitted spans with server span.kind", "Completeness", ["123"], 100)
    assert report["none", "ClientVersion", "go-1"].type == "Other"
    scores = {r.service: (r.completeness, r.quality) for r in rp.service_score(m).collect()}
    assert scores == {"ueta": (1.0, None), "fry": (0.5, 0.25), "none": (None, None)}
    assert rp.recent(m, "1970-01-01 04:00:00", 2).count() == 6 and rp.recent(m, "1970-01-01 04:00:01", 2).count() == 0
    assert '"TraceIDs":["123"]' in rp.report_json(rp.service_metrics_report(m).where("service = 'ueta'")).first().json


def test_quality_table_adds_batches(spark, tmp_path):
    row = lambda n: spark.createDataFrame([("a", "M", "PASS", n, f"{n}")], "service string, metric string, submetric string, count long, trace_id string").withColumn("time_bucket", F.timestamp_seconds(F.lit(7200)))
    for batch, n in ((0, 3), (1, 4), (1, 4)):  # the second batch is retried
        tables.write_quality(row(n), str(tmp_path / "q"), batch, "run")
    assert tables.read_quality(spark, str(tmp_path / "q"), "a", "1970-01-01 02:00:00").first()["count"] == 7
    assert tables.read_quality(spark, str(tmp_path / "q"), "b").count() == 0


def test_nested_reading(spark):
    tag = lambda k, v: {"key": k, "vType": "STRING", "vStr": v}
    rows = [
        {"traceIdLow": -1, "spanId": 1, "parentSpanId": 0, "startTime": 1999, "references": [{"refType": "child_of", "spanId": 9}], "tags": [tag("span.kind", "server"), tag("span.kind", "LOCAL"), tag("Peer.Service", "B")], "process": {"serviceName": "a", "tags": [tag("Jaeger.Version", "Go-1"), tag("x", "y")]}},
        {"traceIdLow": 0, "spanId": 2, "startTime": 0, "references": [{"refType": "CHILD_OF", "spanId": 7}], "tags": [tag("span.kind", None)], "process": {"serviceName": "a"}},
        {"traceIdLow": 255, "spanId": 3, "startTime": 0},
    ]
    df = spark.createDataFrame(rows, SPAN)
    exact, any_case = ([r[0] for r in df.select(fs.resolve_parent(c)).collect()] for c in (False, True))
    assert (exact, any_case) == ([0, 0, 0], [0, 7, 0])
    assert [r[0] for r in df.select(fs.span_kind()).collect()] == ["LOCAL", "UNKNOWN", None]
    assert [r[0] for r in df.select(fs.trace_id_hex("traceIdLow")).collect()] == ["f" * 16, "0", "ff"]
    quality = fs.flatten_spans_quality(df).collect()
    assert (quality[0].peer_service, quality[0].client_version, quality[0].is_server, quality[0].trace_id_high) == ("b", "Go-1", True, 0)
    assert fs.flatten_spans_dependencies(df).first().ts.microsecond == 1000


def test_least_trace_id_is_that_of_texts(spark):
    rng = random.Random(3)
    ids = [rng.choice([rng.getrandbits(rng.randint(1, 63)), -rng.getrandbits(60) - 1, 16 ** rng.randrange(15), 0]) for _ in range(3000)]
    groups = [(n % 700, i) for n, i in enumerate(ids)]
    got = {r.g: r.t for r in spark.createDataFrame(groups, "g int, i long").groupBy("g").agg(fs.least_trace_id_hex("i").alias("t")).collect()}
    want = {}
    for g, i in groups:
        want[g] = min(want.get(g, "g"), f"{i % 2**64:x}")
    assert got == want
    assert spark.createDataFrame([], "i long").agg(fs.least_trace_id_hex("i")).first()[0] is None


def test_envelopes_that_do_not_decode_are_skipped(spark):
    df = spark.createDataFrame([('{"schema_id": 1, "msg": {"spanId": 5}}',), ("no json",), ('{"schema_id": 1}',), (None,)], "value string")
    assert [r.spanId for r in decode_json_envelope(df).collect()] == [5]
    assert '"traceIdHigh"' in avro_schema()


def odd_traces(n):
    """Random traces with shared and repeated ids, missing parents, cycles, spans of both kinds, odd versions and names."""
    rng = random.Random(n)
    for t in range(n):
        for k in range(rng.randint(1, 7)):
            ids = rng.choice([(1, 2, 3), (1, 2, -4, 9), (5,)])
            yield (t, rng.choice(ids), rng.choice([0, *ids, 77]), rng.choice(["a", "b", "", None]), rng.choice(["server", "client", "both", None]), rng.choice(["p", "", None]), rng.choice(["go-2.6.0", "java-", "node-3.x", "Python-4", "5", "", None]), k)


def odd_spans(spark, n):
    rows = [(t, t, i, p, s, k in ("server", "both"), k in ("client", "both"), peer, version, 1_000_000_000_000_000 + 1000 * nth) for t, i, p, s, k, peer, version, nth in odd_traces(n)]
    names = "trace_id_high long, trace_id_low long, span_id long, parent_span_id long, service string, is_server boolean, is_client boolean, peer_service string, client_version string, start_time_us long"
    return spark.createDataFrame(rows, names)


def traces_of(rows, kept=lambda r: r["is_client"] or r["is_server"]):
    out = {}
    for r in rows:
        if kept(r):
            out.setdefault(r["trace_id_low"], []).append(r)
    return out


def test_rules_of_streams_equal_those_of_batches(spark):
    spans = odd_spans(spark, 150).cache()
    got = Counter((r.service, r.metric, r.submetric) for r in ql.score_all(jobs.quality_sessions(spans)).collect())
    rows = [r.asDict() for r in spans.orderBy("start_time_us", "span_id").collect()]
    assert got == Counter(x for t in traces_of(rows).values() for x in st.scores_of(t)) and len(got) > 20


def test_dedupe_equals_the_walk_over_a_trace(spark):
    spans = odd_spans(spark, 200).cache()
    out = dedupe_span_ids(jobs.dependency_sessions(spans), HL).collect()
    got = Counter((r.trace_id_low, r.start_time_us, r.span_id, r.parent_span_id) for r in out)
    rows = [r.asDict() for r in spans.orderBy("start_time_us", "span_id").collect()]
    want = Counter((s["trace_id_low"], s["start_time_us"], s["span_id"], s["parent_span_id"]) for t in traces_of(rows).values() for s in st.adjusted(t))
    assert got == want and sum(r.renamed for r in out) > 30


def test_rules_of_a_users_own(spark, tmp_path):
    def long_names(spans):
        for s in spans:
            yield s["service"], "LongName", "PASS" if len(s["service"]) > 1 else "FAIL"

    spans = flat(spark, [(1, 1, 0, "a", "server"), (1, 2, 1, "bb", "client"), (1, 3, 1, "bb", "client")])
    spans.union(flat(spark, [(2, 1, 0, "z", "server")], 1_000_000_000_000_000 + 10 * 3_600_000_000)).write.parquet(str(tmp_path / "in"))
    out = []
    stream = st.quality_stream(spark.readStream.schema(spans.schema).parquet(str(tmp_path / "in")), rules=(long_names,))
    st.run_available(stream, lambda rows, n: out.extend(rows.collect()), str(tmp_path / "check"))
    assert {(r.service, r.metric, r.submetric, r["count"]) for r in out} == {("a", "LongName", "FAIL", 1), ("bb", "LongName", "PASS", 2)}
    # and in a batch
    name = lambda keys: F.array(ql.score("service", "LongName", F.when(F.length("service") > 1, "PASS").otherwise("FAIL")))
    found = {(r.service, r.submetric, r["count"]) for r in jobs.quality_job(spans, span_rules=(name,), trace_rules=()).collect()}
    assert found == {("a", "FAIL", 1), ("bb", "PASS", 2)}


def test_paths_with_shared_ids_told_apart(spark):
    rng = random.Random(21)
    rows = [(t, rng.choice((1, 2, 3, 4)), rng.choice((0, 1, 2, 3)), rng.choice("abc"), rng.choice(("server", "client", None))) for t in range(60) for _ in range(6)]
    spans = flat(spark, rows).cache()
    got = Counter(tuple((n.service, n.operation) for n in r.path) for r in pt.trace_paths(_adjusted(spans)).collect())
    by_trace = traces_of([r.asDict() for r in spans.orderBy("start_time_us").collect()], lambda r: True)
    assert got == Counter(tuple(p) for t in by_trace.values() for p in pt.walk(st.adjusted(t)))
    unique = {tuple((n.service, n.operation) for n in r.path) for r in jobs.unique_paths(spans, dedupe=True).collect()}
    assert unique == set(got)


def _adjusted(spans):
    return dedupe_span_ids(annotate_sessions(spans, jobs.LOW, 5), jobs.LOW)


def test_long_paths_and_run_times(spark):
    name = "x" * 31_999
    rows = [(1, 1, 0, name, "server"), (1, 2, 1, "y", "server"), (1, 3, 2, "zz", "server")]
    paths = lambda n: [[(p.service, p.operation) for p in r.path] for r in pt.trace_paths(jobs.path_sessions(flat(spark, rows[:n]))).collect()]
    assert paths(2) == [[(name, name.upper()), ("y", "Y")]]  # 64,000 characters
    assert paths(3) == [[("Exceeded", "Length")]]
    counts = jobs.dependency_counts(flat(spark, rows))
    row = dep.dependencies_rollup(counts, "2024-05-06 07:08:09").first()
    assert (str(row.ts), str(row.ts_bucket)) == ("2024-05-06 07:08:09", "2024-05-06 00:00:00")


def test_spans_without_a_trace(spark):
    rows = [(0, 1, 0, "a", "server"), (5, 1, 0, "a", "server")]
    assert [r.trace_id_low for r in jobs.drop_untraced(flat(spark, rows)).collect()] == [5]


def test_a_trace_of_many_spans(spark):
    n = 100_000
    wide = spark.range(1, n + 1).select(
        F.lit(7).cast("long").alias("trace_id_low"), F.col("id").alias("span_id"), F.expr("CASE WHEN id = 1 THEN 0 WHEN id % 1000 = 0 THEN 1 WHEN id % 1000 < 20 THEN id - 1 ELSE 1 END").alias("parent_span_id"),
        F.concat(F.lit("s"), F.col("id") % 5).alias("service"), F.lit("op").alias("operation"), F.lit("SERVER").alias("span_kind"), (F.col("id") * 1000).alias("start_time_us"),
    )
    paths = pt.trace_paths(jobs.path_sessions(wide))
    parents = {r.parent_span_id for r in wide.select("parent_span_id").distinct().collect()}
    assert paths.count() == sum(i not in parents for i in range(1, n + 1))
    assert paths.agg(F.max(F.size("path"))).first()[0] == 21


def test_retried_batches_count_once(spark, tmp_path):
    rows = flat(spark, [(100, 1, 0, "a", "server"), (100, 2, 1, "b", "server")], 1_196_677_812_000_000)
    for batch in (0, 1, 1):  # the second batch is retried
        tables.write_dependencies(jobs.dependencies_job(rows), str(tmp_path / "d"), batch, "run")
        tables.write_paths(jobs.paths_job(rows), str(tmp_path / "p"), batch, "run")
    one = jobs.paths_job(rows).count()
    assert tables.read_dependencies(spark, str(tmp_path / "d")).count() == 2 and tables.read_paths(spark, str(tmp_path / "p")).count() == 2 * one
    assert tables.read_paths(spark, str(tmp_path / "p"), "b", since="2007-12-03 10:00:00").count() == 2
    assert tables.read_paths(spark, str(tmp_path / "p"), "b", "B").count() == 2 and tables.read_dependencies(spark, str(tmp_path / "d"), "2030-01-01").count() == 0


def test_options_of_the_topic_reader():
    reader = mock.MagicMock()
    for call in ("format", "options", "option"):
        getattr(reader.readStream, call).return_value = reader.readStream
    with mock.patch.object(sp, "decode_span_envelope", lambda messages: messages):
        sp.read_spans_stream(reader, "spans", {"kafka.bootstrap.servers": "b:9092"})
    reader.readStream.format.assert_called_once_with("kafka")
    reader.readStream.options.assert_called_once_with(**{"kafka.bootstrap.servers": "b:9092"})
    assert [c.args for c in reader.readStream.option.call_args_list] == [("subscribe", "spans"), ("startingOffsets", "latest")]


def test_avro_messages(spark):
    from pyspark.errors import AnalysisException
    from pyspark.sql.avro.functions import to_avro

    try:
        rows = spark.createDataFrame([{"schema_id": 1, "msg": {"traceIdLow": 1, "spanId": 5, "operationName": "o", "flags": 0, "startTime": 0, "duration": 0, "process": {"serviceName": "a"}}}], ENVELOPE)
        messages = rows.select(to_avro(F.struct("schema_id", "msg"), avro_schema()).alias("value"))
        assert [r.spanId for r in sp.decode_span_envelope(messages).collect()] == [5]
    except (AnalysisException, TypeError) as e:
        pytest.skip(f"Spark's Avro package is not here: {str(e)[:80]}")


def test_shared_folder_is_asked_for_on_a_cluster():
    session = mock.MagicMock()
    session.conf.get.return_value = session.sparkContext.getConf().get.return_value = None
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"):
        session.sparkContext.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session)
    session.conf.get.return_value = "/shared/"
    assert shared_dir(session) == "/shared"


def test_late_spans_are_dropped(spark, tmp_path):
    first = flat(spark, [(1, 1, 0, "a", "server"), (1, 2, 1, "b", "server")])
    later = flat(spark, [(9, 1, 0, "z", "server")], 1_000_000_000_000_000 + 10 * 3_600_000_000)
    late = flat(spark, [(2, 1, 0, "late", "server"), (2, 2, 1, "late", "server")])
    path, out = str(tmp_path / "in"), []
    for part in (first, later, late, flat(spark, [(8, 1, 0, "z", "server")], 1_000_000_000_000_000 + 20 * 3_600_000_000)):
        part.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(part.schema).parquet(path)
        st.run_available(st.dependencies_stream(stream), lambda rows, n: out.extend(rows.collect()), str(tmp_path / "check"))
    assert [(d.parent, d.child) for r in out for d in r.dependencies] == [("a", "b")]
