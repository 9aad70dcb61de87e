"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value calibration.

Fitting. Token counts of toxic and clean labelled texts give log-odds with an informative Dirichlet
prior (the pooled counts, scaled to PRIOR tokens); tokens whose log-odds exceed Z_MIN standard errors
and EFFECT keep their score, all others score -DRIFT. A token is counted once for each distinct token
before it, so that copies of one text count as one.

Scoring. A token that was met within the last REPEAT tokens scores -DRIFT, as repetition is no further
evidence. One linear scan finds all maximal scoring segments of a text (each is a passage that can't
be made better by growing or shrinking). Under the clean token distribution the number of segments
that reach S in n tokens is about E = K * n * exp(-lambda * S); lambda solves
sum(p * exp(lambda * s)) = 1 and K is matched to the clean training texts. A text's evidence is
-ln E of its best segment and the sum of -ln E over its significant ones (E < 1); a logistic curve
fitted on the training texts turns both into a score from 0 to 1.

The fit uses at most SAMPLE texts of either class (those with the smallest hash of their id), and so
the table of scores, which holds every token that passes, is bounded by these texts; everything else
covers all rows and whole texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .text import words

SAMPLE = 4000
PRIOR, Z_MIN, EFFECT, DRIFT, REPEAT = 10_000.0, 3.0, 1.0, 0.1, 200


@dataclass
class ToxicityModel:
    scores: dict[bytes, float]
    lam: float = 1.0
    k: float = 1.0
    bias: float = -3.0
    best: float = 1.0
    total: float = 0.0

    def __post_init__(self):
        self.cache = TokenScores(self.scores)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "cache"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.cache = TokenScores(self.scores)


def maximal_segments(values: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time; end is exclusive.

    values holds (position, score) of the tokens that have their own score; those between score
    -drift each. Candidate segments are kept with the running total before and after them, and are
    merged into the last one that starts lower.
    """
    found: list[list[float]] = []  # start, end, total before, total after, index of the last candidate that starts lower
    total, at = 0.0, 0
    for pos, s in values:
        total -= drift * (pos - at)
        at = pos + 1
        before, total = total, total + s
        if s <= 0:
            continue
        start, after = pos, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = int(found[j][4])
            if j < 0 or found[j][3] >= after:
                found.append([start, at, before, after, j])
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(int(a), int(e), y - x) for a, e, x, y, _ in found]


def beginnings(token: bytes) -> list[bytes]:
    """The proper beginnings of a token that are units of their own, longest first."""
    return [token[:n] + b"*" for n in range(min(8, len(token) - 1), 3, -1)]


class TokenScores(dict):
    """Token -> score or None, filled from the model as tokens are met; emptied when it grows large."""

    def __init__(self, scores: dict[bytes, float]):
        super().__init__()
        self.scores = scores

    def __missing__(self, token: bytes) -> float | None:
        if len(self) > 200_000:
            self.clear()
        got = self.scores.get(token)
        if got is None:
            got = next((s for u in beginnings(token) if (s := self.scores.get(u)) is not None), None)
        self[token] = got
        return got


def passages(text: str | None, m: ToxicityModel) -> tuple[int, list[tuple[int, int, float]]]:
    """(number of tokens, segments) of one whole text."""
    toks = words(text)
    last: dict[bytes, int] = {}
    values = []
    for i, s in enumerate(map(m.cache.__getitem__, toks)):
        if s is not None:
            t = toks[i]
            if i - last.get(t, -REPEAT - 1) > REPEAT:
                values.append((i, s))
            last[t] = i
    return len(toks), maximal_segments(values, DRIFT)


def evidence(n: int, found: list[tuple[int, int, float]], m: ToxicityModel) -> tuple[float, float, int]:
    """Best -ln E, log of 1 + the sum of -ln E, and the number of significant segments."""
    null = math.log(m.k * max(n, 1))
    e = [x for _, _, s in found if (x := m.lam * s - null) > 0]
    return (max(e), math.log1p(sum(e)), len(e)) if e else (0.0, 0.0, 0)


def _contexts(batches):
    for batch in (b.slice(i, 100) for b in batches for i in range(0, b.num_rows, 100)):  # few texts' tokens at a time
        seen = set()
        for text, y in zip(batch.column(0), batch.column(1), strict=True):
            toks, y = words(text.as_py()), y.as_py()
            one: dict[bytes, bytes] = {}
            for a, b in zip([b"", *toks], toks, strict=False):
                if b not in one or a < one[b]:
                    one[b] = a
            stems: dict[bytes, bytes] = {}
            for b, a in one.items():
                for u in beginnings(b):
                    if u not in stems or a < stems[u]:
                        stems[u] = a
            seen.update((a, b, y) for d in (one, stems) for b, a in d.items())
        prev, tok, label = zip(*seen, strict=True) if seen else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(prev, pa.binary()), pa.array(tok, pa.binary()), pa.array(label, pa.int32())], ["prev", "token", "y"]
        )


def _log_odds(sample: DataFrame) -> tuple[dict[bytes, float], float]:
    """Token scores, and lambda of their clean distribution."""
    counts = materialize(
        sample.select("text", "y").mapInArrow(_contexts, "prev binary, token binary, y int").distinct()
        .groupBy("token").agg(F.sum("y").cast("double").alias("t"), F.sum(1 - F.col("y")).cast("double").alias("c")),
        "counts",
    )
    n = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    if not n.t or not n.c:
        return {}, 1.0
    a = PRIOR * (F.col("t") + F.col("c")) / (n.t + n.c)
    odds = F.log((F.col("t") + a) / (n.t + PRIOR - F.col("t") - a)) - F.log((F.col("c") + a) / (n.c + PRIOR - F.col("c") - a))
    kept = (
        counts.select("token", odds.alias("s"), (odds / F.sqrt(1 / (F.col("t") + a) + 1 / (F.col("c") + a))).alias("z"), ((F.col("c") + a) / (n.c + PRIOR)).alias("p"))
        .where((F.abs("z") >= Z_MIN) & (F.abs("s") >= EFFECT)).orderBy("token").collect()
    )
    scores = {bytes(r.token): float(r.s) for r in kept}
    whole = [r for r in kept if not bytes(r.token).endswith(b"*")] or kept  # a token has one score, so stems stay out of the sum
    p, s = np.array([r.p for r in whole]), np.array([r.s for r in whole])
    lo, hi = 0.0, 20.0
    for _ in range(60 if len(kept) and s.max() > 0 else 0):  # the sum is convex, 1 at 0, and falls at first
        lam = (lo + hi) / 2
        up = float((p * np.exp(np.minimum(lam * s, 600.0))).sum() + max(0.0, 1 - p.sum()) * math.exp(-lam * DRIFT))
        lo, hi = (lam, hi) if up < 1 else (lo, lam)
    return scores, max(lo, 1e-3) if len(kept) else 1.0


def _segments_of(model):
    def run(batches):
        for batch in batches:
            y, n, s = [], [], []
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                size, found = passages(text.as_py(), model.value)
                y.append(label.as_py())
                n.append(size)
                s.append([x for _, _, x in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array(n, pa.int64()), pa.array(s, pa.list_(pa.float64()))], ["y", "n", "s"]
            )

    return run


def _evidence_of(m: ToxicityModel):
    lam, k = m.lam, m.k
    bare = ToxicityModel({}, lam, k)

    def run(batches):
        for batch in batches:
            found = [evidence(n, [(0, 0, x) for x in s], bare)[:2] for n, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([e[i] for e in found], pa.float64()) for i in (0, 1))], ["y", "best", "total"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on docs(doc_id, text) with labels(doc_id, toxic); at most ``sample`` texts of a class.

    Null ids, labels or texts are left out; of several labels of an id the largest counts. With no
    toxic or no clean text the model scores every text alike.
    """
    lab = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    known = docs.where("doc_id is not null and text is not null").select("doc_id").distinct()
    lab = materialize(lab.where("y in (0, 1)").join(known, "doc_id", "left_semi"), "labels")
    size = {r.y: r["count"] for r in lab.groupBy("y").count().collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = lab.where("y = 1").orderBy(*order).limit(sample).union(lab.where("y = 0").orderBy(*order).limit(sample))
    # at most 2 * sample ids: a bounded broadcast
    train = materialize(docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y"), "sample")
    scores, lam = _log_odds(train)
    m = ToxicityModel(scores, lam)
    if not scores:
        return m
    segments = materialize(train.mapInArrow(_segments_of(docs.sparkSession.sparkContext.broadcast(m)), "y int, n long, s array<double>"), "segments")
    low = min((x for x in scores.values() if x > 0), default=1.0)
    clean = segments.where("y = 0").agg(F.sum("n").alias("n"), F.sum(F.size(F.filter("s", lambda x: x >= low))).alias("hits")).first()
    m.k = min(1.0, ((clean.hits or 0) + 1) * math.exp(lam * low) / max(1, clean.n or 0))
    rows = segments.mapInArrow(_evidence_of(m), "y int, best double, total double").collect()  # at most 2 * sample
    rows.sort(key=lambda r: (r.y, r.best, r.total))
    x = np.array([(1.0, r.best, r.total) for r in rows])
    y = np.array([float(r.y) for r in rows])
    share = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    w = np.where(y == 1, size.get(1, 1) / share[1], size.get(0, 1) / share[0])
    w /= w.mean()
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x, beta = x / scale, np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - 1e-2 * beta
        beta += np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(3), grad)
    m.bias, m.best, m.total = (float(v) for v in beta / scale)
    return m


def _scorer(model):
    out = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_passages", pa.int64()), ("passages", pa.list_(pa.struct([("first_token", pa.int64()), ("end_token", pa.int64()), ("log_odds", pa.float64()), ("e_value", pa.float64())])))])

    def run(batches):
        m = model.value
        for batch in batches:
            score, count, spans = [], [], []
            for text in batch.column(1):
                n, found = passages(text.as_py(), m)
                best, total, k = evidence(n, found, m)
                score.append(1 / (1 + math.exp(-max(-30.0, min(30.0, m.bias + m.best * best + m.total * total)))))
                count.append(k)
                e = [(a, b, s, m.k * max(n, 1) * math.exp(-m.lam * s)) for a, b, s in found]
                spans.append([{"first_token": a, "end_token": b, "log_odds": s, "e_value": v} for a, b, s, v in e if v < 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array(count, pa.int64()), pa.array(spans, out.field("passages").type)], schema=out
            )

    return run


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, n_passages, passages (token range, log-odds, E-value) of every row.

    Null and empty texts have no passage and get the score of no evidence; null ids stay null;
    repeated rows are each scored; an empty table gives an empty result; other columns aren't read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _scorer(docs.sparkSession.sparkContext.broadcast(model)),
        "doc_id long, score double, n_passages long, passages array<struct<first_token: long, end_token: long, log_odds: double, e_value: double>>",
    )


def held_out(doc_id) -> F.Column:
    """True where crc32 of the id as text leaves 0 when divided by 5; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs without the rows that score threshold or more; same columns, repeated rows kept.

    Null and empty texts, which have no passage, get the score of no evidence and stay unless that
    reaches the threshold; null ids are scored like others; an empty table stays empty.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~held_out(F.col("doc_id"))), labels))
    keep = lambda batches: _keep(batches, model.value, threshold)
    return docs.mapInArrow(keep, docs.schema)


def _keep(batches, m: ToxicityModel, threshold: float):
    for batch in batches:
        good = []
        for text in batch.column(batch.schema.get_field_index("text")):
            n, found = passages(text.as_py(), m)
            best, total, _ = evidence(n, found, m)
            good.append(1 / (1 + math.exp(-max(-30.0, min(30.0, m.bias + m.best * best + m.total * total)))) < threshold)
        yield batch.filter(pa.array(good, pa.bool_()))
