"""Language of a text from averaged hashed subword embeddings and a linear softmax.

Subwords are the 3- and 4-byte pieces of lower-cased words with their edges marked; each is hashed to
a row of an embedding table. A text is the mean of its rows, a linear layer gives one score for each
language, and a temperature fitted on texts kept back makes the softmax a probability. From those
texts also comes the probability below which an answer is rejected: the lowest one that keeps
PRECISION of the accepted answers right.

The fit uses about PER_LANGUAGE texts of each language (those with the smallest hash of their id);
as embedding and softmax are both linear, scoring needs only their product, one row per subword.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .text import encode

PER_LANGUAGE, EPOCHS, RATE, DIM = 300, 8, 0.5, 16
PRECISION = 0.99
BITS3, BITS4 = 14, 16
ROWS = (1 << BITS3) + (1 << BITS4)
UNDETERMINED = "und"
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def subwords(text: str | None) -> np.ndarray:
    """Table rows of all subwords of a whole text."""
    words = encode((text or "").lower()).translate(_LETTERS).split()
    data = np.frombuffer(b" ".join([b"", *words, b" "]), np.uint8).astype(np.uint32)
    inner = data != 32
    tri = (data[:-2] << 16 | data[1:-1] << 8 | data[2:])[inner[1:-1]]
    quad = (data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:])[inner[1:-2] & inner[2:-1]]
    a = (tri * np.uint32(2654435761)) >> np.uint32(32 - BITS3)
    b = (quad * np.uint32(2246822519)) >> np.uint32(32 - BITS4)
    return np.concatenate([a.astype(np.int64), b.astype(np.int64) + (1 << BITS3)])


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # ROWS x languages
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, text: str | None) -> np.ndarray:
        rows = subwords(text)
        z = self.bias + (self.table[rows].mean(axis=0) if len(rows) else 0)
        e = np.exp((z - z.max()) / self.temperature)
        return e / e.sum()


def _features(batches):
    for batch in batches:
        ids, langs, keys, rows, counts = [], [], [], [], []
        for key, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lines = [x for x in text.split("\n") if has_letter(x)]
            step = max(1, len(lines) // 3)
            for i, piece in enumerate([text, *lines[::step][:4]]):  # a few lines besides the whole text, as short texts
                r, c = np.unique(subwords(piece), return_counts=True)
                if len(r):
                    ids.append(i)
                    langs.append(lang)
                    keys.append(key)
                    rows.append(r.astype(np.int32).tobytes())
                    counts.append((c / c.sum()).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(ids, pa.int32()), pa.array(langs, pa.string()), pa.array(rows, pa.binary()), pa.array(counts, pa.binary())],
            ["key", "piece", "lang", "rows", "share"],
        )


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 3) -> LanguageModel:
    """Fit on docs(doc_id, text, lang); rows without text, letters or lang are left out.

    About ``per_language`` texts of each language are used. With no usable row the model knows the
    language "und" alone.
    """
    known = docs.where("text is not null and lang is not null").select(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)).alias("key"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return LanguageModel([UNDETERMINED], np.zeros((ROWS, 1), np.float32), np.zeros(1, np.float32))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, per_language / n))])
    chosen = known.where(F.pmod(F.col("key"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    sample = materialize(chosen.mapInArrow(_features, "key long, piece int, lang string, rows binary, share binary"), "features").toPandas()
    sample = sample.sort_values(["key", "piece", "lang"], kind="stable")
    languages = sorted(counts)
    y = sample["lang"].map({v: i for i, v in enumerate(languages)}).to_numpy()
    rows = [np.frombuffer(r, np.int32) for r in sample["rows"]]
    share = [np.frombuffer(c, np.float32) for c in sample["share"]]
    keep_back = (sample["key"].to_numpy() >> 21) % 5 == 0
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (ROWS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    train = np.flatnonzero(~keep_back) if (~keep_back).any() else np.arange(len(y))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(train):
            r, c = rows[i], share[i]
            h = c @ emb[r]
            z = h @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            emb[r] -= (rate * 30) * np.outer(c, out @ p)
            out -= rate * np.outer(h, p)
            bias -= 0.1 * rate * p
    model = LanguageModel(languages, emb @ out, bias)
    back = np.flatnonzero(keep_back)
    if len(back):
        z = np.array([share[i] @ model.table[rows[i]] + bias for i in back])
        z -= z.max(axis=1, keepdims=True)

        def loss(t: float) -> float:
            return float((np.log(np.exp(z / t).sum(axis=1)) - z[np.arange(len(back)), y[back]] / t).mean())

        model.temperature = float(min(np.geomspace(0.1, 10, 60), key=loss))
        p = np.exp(z / model.temperature)
        p /= p.sum(axis=1, keepdims=True)
        top, right = p.max(axis=1), p.argmax(axis=1) == y[back]
        order = np.argsort(-top)
        good = np.flatnonzero(np.cumsum(right[order]) >= PRECISION * np.arange(1, len(order) + 1))
        model.threshold = float(top[order][good[-1]]) if len(good) else 1.0
    return model


def _predict(model):
    def run(batches):
        m = model.value
        for batch in batches:
            lang, score, accepted = [], [], []
            for t in batch.column(1):
                text = t.as_py()
                if not has_letter(text):
                    lang.append(UNDETERMINED)
                    score.append(0.0)
                    accepted.append(False)
                    continue
                p = m.probabilities(text)
                best = int(p.argmax())
                lang.append(m.languages[best])
                score.append(min(1.0, float(p[best])))
                accepted.append(score[-1] >= m.threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())], ["doc_id", "lang_pred", "score", "accepted"]
            )

    return run


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, accepted of every row of docs(doc_id, text, ...).

    Texts that are null or have no letter are "und" with score 0 and not accepted; null ids stay null;
    repeated rows are each predicted; an empty table gives an empty result. ``accepted`` is false
    where the score is below the calibrated threshold.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # ROWS x languages floats
    return rows.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double, accepted boolean")


def held_out(doc_id) -> F.Column:
    """True where crc32 of the id as text leaves 2 when divided by 4; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
