"""Root-to-leaf call paths and their index by each service and operation on them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import least_trace_id_hex, trace_id_hex
from ..sources.shared import forget, written
from .sessions import bounded_tasks, tumble

MAX_LENGTH = 64_000
ALL_OPERATIONS = ""
NODE = "struct<service: string, operation: string>"
EXEMPLAR = "exemplar_trace_id"


def walk(spans) -> list[list[tuple[str, str]]]:
    """Paths of one trace: spans with span_id, parent_span_id, service, operation, span_kind in order.

    Depth first from the last root (parent 0), each id once, the last span of an id describing it. A
    node that no other span names as its parent (0 names none) ends a path; a path shows the server
    spans only and may be empty.
    """
    about, children, root = {}, {}, None
    for s in spans:
        about[s["span_id"]] = s
        if s["parent_span_id"] == 0:
            root = s["span_id"]
        else:
            children.setdefault(s["parent_span_id"], []).append(s["span_id"])
    if root is None:
        return []
    out, path, seen = [], [], set()
    todo = [(root, 0)]  # a node and the length of the path above it
    while todo:
        node, depth = todo.pop()
        if node in seen:  # reached by another way since it was listed
            continue
        seen.add(node)
        del path[depth:]
        s = about[node]
        if s["span_kind"] == "SERVER":
            path.append((s["service"], s["operation"]))
        if node in children:
            todo += [(c, len(path)) for c in reversed(children[node]) if c not in seen]
        else:
            out.append(list(path))
    return out


def _exceeded():
    return F.array(F.struct(F.lit("Exceeded").alias("service"), F.lit("Length").alias("operation")))


def path_length_cap(path, limit: int = MAX_LENGTH):
    """The path, or one node Exceeded/Length where its names sum to more than ``limit`` characters."""
    size = F.aggregate(path, F.lit(0), lambda n, x: n + F.length(F.coalesce(x["service"], F.lit(""))) + F.length(F.coalesce(x["operation"], F.lit(""))))
    return F.when(size > limit, _exceeded()).otherwise(path)


#: Rows of paths that are sent on together.
_ROWS = 4096
_SPAN = ("span_id", "parent_span_id", "service", "operation", "span_kind")


def _walked(names_of: tuple[str, ...]):
    """Rows (keys, sid, session_end, span fields), sorted by trace, as rows (keys, sid, session_end, path)."""
    keys, node = len(names_of), pa.struct([("service", pa.string()), ("operation", pa.string())])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        heads = [pa.array([f[0][i] for f in found], pa.int64()) for i in range(keys + 2)]
        ends = [0]
        for _, path in found:
            ends.append(ends[-1] + len(path))
        names = [pa.array([n[i] for _, path in found for n in path], pa.string()) for i in (0, 1)]
        path = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(names, fields=list(node)))
        return pa.RecordBatch.from_arrays([*heads, path], [*names_of, "sid", "session_end", "path"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trace, held, out = None, [], []

        def flush():
            out.extend((trace, path) for path in walk(dict(zip(_SPAN, s, strict=True)) for s in held))

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for head, span in zip(zip(*columns[: keys + 2], strict=True), zip(*columns[keys + 2 :], strict=True), strict=True):
                if head != trace:
                    flush()
                    trace, held = head, []
                    while len(out) >= _ROWS:
                        yield rows(out[:_ROWS])
                        del out[:_ROWS]
                held.append(span)
        flush()
        for i in range(0, len(out), _ROWS):
            yield rows(out[i : i + _ROWS])

    return run


def trace_paths(spans: DataFrame, keys: tuple[str, ...] = ("trace_id_low",), limit: int = MAX_LENGTH, spread: bool = False, dealt: bool = False) -> DataFrame:
    """(keys, sid, session_end, path, trace_id): every path of every trace session.

    Spans go through an Arrow helper in the order of their traces, row by row: a trace is never one
    value, and the helper holds one trace at a time. Spans are dealt by keys, unless they are (``dealt``). With
    ``spread`` a trace whose ids have one parent each is never in one task (see tree_paths); for others
    the order of the walk decides by which way an id is reached, which only one walk can tell.
    """
    if spread:
        with bounded_tasks(spans.sparkSession, spans.count()):
            nodes, odd = tree_nodes(spans, keys)
            found = tree_paths(nodes, keys, limit)
            if odd.isEmpty():
                return found
        return found.unionByName(trace_paths(spans.join(odd, [*keys, "sid"], "left_semi"), keys, limit))
    ordered = (spans if dealt else spans.repartition(*keys)).sortWithinPartitions(*keys, "sid", "start_time_us", *_SPAN)
    heads = ", ".join(f"{k} long" for k in (*keys, "sid", "session_end"))
    walked = ordered.select(*[F.col(k).cast("long").alias(k) for k in (*keys, "sid", "session_end")], *_SPAN).mapInArrow(_walked(keys), f"{heads}, path array<{NODE}>")
    return walked.select(*keys, "sid", "session_end", path_length_cap(F.col("path"), limit).alias("path"), trace_id_hex(keys[-1]).alias("trace_id"))


def tree_nodes(spans: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Two written tables: the ids (keys, sid, session_end, id, up, root, leaf, size, name) of trace sessions
    in which every id but the root has at most one parent other than itself, and the sessions (keys, sid)
    where one has more.

    up is the parent (null at the root), leaf tells that no span names the id as its parent, name holds
    the id's service and operation if it shows in paths, and size is the number of the session's ids.
    """
    trace = [*keys, "sid"]
    parent, own = F.col("parent_span_id"), F.col("span_id")
    above = F.when((parent != 0) & (parent != own), parent)
    last = F.max(F.struct("start_time_us", "span_id", "parent_span_id", "service", "operation", "span_kind"))  # nulls are least, as in the walk's order
    ids = spans.groupBy(*trace, "session_end", "span_id").agg(last.alias("last"), F.min(above).alias("up"), F.max(above).alias("up2"))
    roots = spans.where(parent == 0).groupBy(*trace).agg(last["span_id"].alias("root_id"))
    sizes = ids.groupBy(*trace).agg(F.count("*").alias("size"))
    named = spans.where(parent != 0).select(*trace, parent.alias("span_id")).distinct().withColumn("named", F.lit(True))
    found = ids.join(roots, trace).join(sizes, trace).join(named, [*trace, "span_id"], "left")
    root = own == F.col("root_id")
    name = F.when(F.col("last.span_kind") == "SERVER", F.struct(F.col("last.service").alias("service"), F.col("last.operation").alias("operation")))
    nodes = written(
        found.select(*trace, "session_end", own.alias("id"), F.when(~root, F.col("up")).alias("up"), root.alias("root"), F.col("named").isNull().alias("leaf"), "size", name.alias("name"), (~root & (F.col("up") != F.col("up2"))).alias("odd")), "nodes"
    )
    odd = written(nodes.where("odd").select(*trace).distinct(), "odd_traces")
    return nodes.join(odd, trace, "left_anti").drop("odd"), odd


def tree_paths(nodes: DataFrame, keys: tuple[str, ...] = ("trace_id_low",), limit: int = MAX_LENGTH) -> DataFrame:
    """trace_paths from the first table of tree_nodes, by pointer doubling.

    In round k each id knows its ancestor 2**k steps up and how long the names up to there are, so after
    as many rounds as the depth has bits all ids know whether and at what length they hang on the root:
    ids under a missing parent find no ancestor, those on or under a cycle go further than the session
    has ids. Then the leaves alone, but for those over ``limit``, gather (leaf, steps, ancestor) rows: in
    round k each row gives the one 2**k steps further up. What is moved is the ids in each round, and
    the paths themselves.
    """
    trace = [*keys, "sid"]
    length = F.length(F.coalesce("name.service", F.lit(""))) + F.length(F.coalesce("name.operation", F.lit("")))
    start = nodes.where("root or up is not null").select(*trace, "id", "up", "size", F.when(F.col("name").isNull(), 0).otherwise(length).cast("long").alias("length"), F.lit(1).cast("long").alias("steps"))
    rounds = [written(start, "ways0")]
    while not rounds[-1].where("up is not null").isEmpty():
        table = rounds[-1]
        top = table.select(*trace, F.col("id").alias("up"), F.col("up").alias("__up"), F.col("length").alias("__length"), F.col("steps").alias("__steps"))
        further = table.where("up is not null").join(top, [*trace, "up"]).select(
            *trace, "id", F.col("__up").alias("up"), "size", (F.col("__length") + F.col("length")).alias("length"), (F.col("__steps") + F.col("steps")).alias("steps")
        )
        rounds.append(written(table.where("up is null").unionByName(further.where("steps <= size")), f"ways{len(rounds)}"))
    leaves = rounds[-1].join(nodes.where("leaf").select(*trace, "id", "session_end"), [*trace, "id"])
    leaves = written(leaves.select(*trace, F.col("id").alias("leaf"), "session_end", "length"), "leaves")

    gathered = leaves.where(F.col("length") <= limit).select(*trace, "leaf", F.col("leaf").alias("id"), F.lit(0).cast("long").alias("steps"))
    for k, table in enumerate(rounds[:-1]):
        ups = table.where("up is not null").select(*trace, "id", "up")
        more = gathered.join(ups, [*trace, "id"]).select(*trace, "leaf", F.col("up").alias("id"), (F.col("steps") + (1 << k)).alias("steps"))
        before, gathered = gathered, written(gathered.unionByName(more), f"gathered{k}")
        if k:
            forget(before)
    shown = gathered.join(nodes.where("name is not null").select(*trace, "id", "name"), [*trace, "id"])
    paths = shown.groupBy(*trace, "leaf").agg(F.sort_array(F.collect_list(F.struct((-F.col("steps")).alias("at"), "name"))).alias("on"))
    out = leaves.join(paths, [*trace, "leaf"], "left")
    path = F.when(F.col("length") > limit, _exceeded()).otherwise(F.coalesce(F.col("on.name"), F.array().cast(f"array<{NODE}>")))
    result = written(out.select(*trace, "session_end", path.alias("path"), trace_id_hex(keys[-1]).alias("trace_id")), "paths")
    forget(*rounds, leaves, *([gathered] if len(rounds) > 1 else []))
    return result


def dedupe_paths(paths: DataFrame, window_minutes: int = 10, low: str = "trace_id_low") -> DataFrame:
    """(window_start, window_end, path, trace_id): each path once per window, with the least trace id."""
    start, end = tumble("session_end", window_minutes)
    return paths.groupBy(start.alias("window_start"), end.alias("window_end"), "path").agg(least_trace_id_hex(low).alias("trace_id"))


def focal_nodes(path):
    """The distinct (service, operation) and (service, all operations) of a path."""
    both = lambda n: F.array(n, F.struct(n["service"].alias("service"), F.lit(ALL_OPERATIONS).alias("operation")))
    return F.array_distinct(F.flatten(F.transform(path, both)))


def focal_node_index(unique: DataFrame) -> DataFrame:
    """(ts_bucket, focal_node, attributes, path): one row for each focal node of each unique path.

    The bucket is the hour of the window's end. Repeats are taken out of the array before it is
    exploded, so no second shuffle is needed; empty paths give no row.
    """
    exemplar = F.array(F.struct(F.lit(EXEMPLAR).alias("key"), F.col("trace_id").alias("value")))
    return unique.select(
        F.date_trunc("HOUR", "window_end").alias("ts_bucket"), F.explode(focal_nodes(F.col("path"))).alias("focal_node"), exemplar.alias("attributes"), "path"
    )
