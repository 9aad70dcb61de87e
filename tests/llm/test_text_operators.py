"""Operators on texts, on small fixtures with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import itertools
import random
import re
import struct
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import groups_by_brute_force, leaked_by_brute_force, sets_by_brute_force
from spanloom.llm import decontam, gif, langid, minhash, pii, repeats, toxicity
from spanloom.llm.components import connected_components
from spanloom.llm.text import chunks
from spanloom.llm.text import words as word_list

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double"


def docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); score is a column with a clashing name."""
    full = [(i, t, (*r, "en", "s")[0] if r else "en", r[1] if len(r) > 1 else "s", len(t or ""), 0.5) for i, t, *r in rows]
    return spark.createDataFrame(full, DOC)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [(None, "no id at all here"), (900, None), (901, ""), (902, "   \n\t "), (903, "x"), (904, "x"), (904, "x")]


# toxicity
def segments_by_brute_force(scores):
    """All maximal scoring segments: repeatedly the best one, then the same to its left and right."""
    def solve(a, b):
        best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 1e-9:
            return []
        _, _, i, j = best
        return [*solve(a, i), (i, j), *solve(j, b)]

    return solve(0, len(scores))


def test_maximal_segments():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-1.0, -1.0, -0.37, 2.11, 1.53]) + rng.random() / 1000 for _ in range(rng.randrange(14))]
        got = toxicity.maximal_segments(list(enumerate(scores)), 0.0)
        assert [(a, b) for a, b, _ in got] == segments_by_brute_force(scores)


def toxic_rows(n=300):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        text = words(rng, 120).split()
        bad = i % 3 == 0
        for _ in range(3 if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["grubble", "grubbling", "snarkish"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_scores(spark):
    rows, labels = toxic_rows()
    table = docs(spark, [*rows, *ODD])
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(table, lab)
    got = toxicity.score(docs(spark, [*rows, (1000, "so grubbled and snarkishly grubblers " * 2 + words(random.Random(5), 3000)), *ODD]), model).collect()
    by_id = {r.doc_id: r for r in got}
    truth = dict(labels)
    assert len(got) == 301 + len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert np.mean([(by_id[i].score >= 0.5) == bool(y) for i, y in truth.items()]) > 0.98
    assert by_id[1000].score >= 0.5 and by_id[1000].passages[0].e_value < 1  # a form never seen, in a long text
    assert by_id[901].score == by_id[900].score < 0.5 and by_id[None].n_passages == 0
    kept = toxicity.drop_toxic(table, lab)
    assert kept.columns == table.columns
    assert kept.where("doc_id < 300").count() <= 204 and kept.where("doc_id >= 900 or doc_id is null").count() == len(ODD)
    assert toxicity.score(table.limit(0), model).count() == 0
    nothing = toxicity.fit(table, lab.limit(0))
    assert {r.score for r in toxicity.score(table, nothing).select("score").collect()} and nothing.scores == {}


def test_toxicity_of_rows_held_out(spark):
    """Fitted without the labelled rows whose crc32 is 0 modulo 5, scored on them."""
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(table.where(~held), labels)
    rows = toxicity.score(table.where(held), model).join(labels.where("toxic is not null"), "doc_id").select("score", "toxic").collect()
    hit = [r.score >= 0.5 for r in rows if r.toxic]
    false = [r.score >= 0.5 for r in rows if not r.toxic]
    assert len(hit) > 30 and sum(hit) / len(hit) > 0.85 and sum(false) <= 0.05 * sum(hit)


# near duplicates
def variants(seed=3):
    """Groups of variants that differ more and more from a common text, with links near the limit."""
    rng = random.Random(seed)
    rows, i = [], 0
    for group in range(8):
        base = words(rng, 60 + 20 * group, 5000).split()
        for edits in [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10] * (3 if group == 0 else 1):
            t = list(base)
            for _ in range(edits):
                t[rng.randrange(len(t))] = f"e{rng.randrange(10**6)}"
            rows.append((i, " ".join(t)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rows = [*variants(), *ODD, (950, "A b C"), (951, "a B c"), (952, "long " * 30_000 + "tail")]
    got = minhash.near_duplicates(docs(spark, rows), k, 80).collect()
    want = groups_by_brute_force(rows, k, 80)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id), r
    sizes = {r.doc_id: r.n_shingles for r in got}
    assert all(sizes[i] == len(sets_by_brute_force(t, k)) for i, t in rows)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(docs(spark, []).limit(0), 2, 80).count() == 0
    table = docs(spark, [(1, "a b c"), (2, "a b c"), (2, "a b c"), (3, None)])
    kept = minhash.drop_near_duplicates(table, 2, 80)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_near_duplicates_whose_ids_share_hash_bits(spark):
    rng = random.Random(15)
    base = words(rng, 300, 5000).split()
    near = [*base[:150], "changed", *base[151:]]
    low = {r.id: r.h for r in spark.createDataFrame([(113611,), (156370,)], "id long").select("id", F.xxhash64("id").bitwiseAND(F.lit(2**32 - 1)).alias("h")).collect()}
    assert low[113611] == low[156370]
    got = minhash.near_duplicates(docs(spark, [(113611, " ".join(base)), (156370, " ".join(near))]), 2, 80).collect()
    assert {r.component_id for r in got} == {113611}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# repeated strings
def cuts_by_brute_force(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[x : x + length] for _, b in raw for x in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for x in range(len(b) - length + 1):
            if seen[b[x : x + length]] > 1:
                gone[x : x + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1])), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_brute_force(spark):
    rng = random.Random(4)
    passage = words(rng, 120, 5000)
    rows = [(i, words(rng, rng.randrange(200), 5000) + (passage[rng.randrange(80) :] if i % 3 == 0 else "") + words(rng, 20, 5000)) for i in range(40)]
    rows += [(50, "shti " * 400), (51, "ä" * 900), (52, rows[3][1]), (53, rows[3][1]), (53, rows[3][1]), (54, words(rng, 9000, 5000) + passage), *ODD, (None, rows[5][1])]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeated_spans(docs(spark, rows)).collect()]
    want = cuts_by_brute_force(rows, 400)
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and sum(x[2] for x in want) > 10_000
    assert repeats.repeated_spans(docs(spark, rows).limit(0)).count() == 0


def test_equal_rolling_hashes_are_not_equal_strings(spark):
    # the Thue-Morse word and its complement have one polynomial hash modulo 2**64
    turns = [bin(i).count("1") & 1 for i in range(1024)]
    one, other = ("".join(letters[t] for t in turns) for letters in ("ac", "ca"))
    values = [repeats.window_hashes([repeats.zstandard.compress(t.encode())], [np.array([[0, 1, 0]]).tobytes()], 1024)[0, 0] for t in (one, other)]
    assert values[0] == values[1] and one != other
    got = repeats.repeated_spans(docs(spark, [(1, one), (2, other), (3, one + "x")]), 1024).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 1024), (2, 0), (3, 1024)]


def test_runs_of_one_byte_trigger_nowhere(spark):
    """No byte's run is cut at every place; a megabyte of = is no more work than prose."""
    assert all(len(repeats.parse(bytes([b]) * 2000)[0]) == 0 for b in range(256))
    prose = words(random.Random(1), 150_000).encode()[:1_000_000]
    assert 8_000 < len(repeats.parse(prose)[0]) < 30_000
    rows = [(1, "=" * 1_000_000), (2, "some text " + "=" * 399), (3, "z" * 400), (4, "y" + "z" * 400)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.repeated_spans(docs(spark, rows)).collect()}
    assert got == {1: (1_000_000, 1), 2: (0, 0), 3: (400, 1), 4: (400, 1)}


def test_longest_shared_run(spark):
    rng = random.Random(14)
    passage = words(rng, 65, 5000)  # below 400 bytes: it stays, but is told of
    rows = [(i, words(rng, 100, 5000) + " " + (passage if i < 3 else "") + " " + words(rng, 100, 5000)) for i in range(9)] + [(20, "short copy of some words"), (21, "short copy of some words"), (22, "longer" * 50), (23, "longer" * 50)]
    got = {r.doc_id: (r.n_removed, r.longest_shared) for r in repeats.repeated_spans(docs(spark, rows)).collect()}
    assert all(got[i][0] == 0 for i in got)
    assert all(200 <= got[i][1] <= len(passage) + 2 for i in range(3)) and all(got[i][1] == 0 for i in range(3, 9))
    assert (got[20][1], got[22][1], got[23][1]) == (0, 300, 300)


# media
def test_gif_round_trip(spark):
    rows = [(1, "hello"), (2, "hello"), (3, "é" * 5000), (4, words(random.Random(6), 30_000)), *ODD]
    got = gif.digests(gif.text_media(docs(spark, rows))).collect()
    assert len(got) == len(rows)
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in got:
        payload = gif.payload_of(texts[r.doc_id][0])
        assert len(payload) % 192 == 0 and (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].media_sha256 == by_id[2].media_sha256 and by_id[1].feature == by_id[2].feature and by_id[901].n_bytes == 0
    assert gif.digests(gif.text_media(docs(spark, rows).limit(0))).count() == 0
    frames = gif.decode_frames(gif.text_media(docs(spark, rows)).where("doc_id = 4")).first().frames
    assert len(frames) > 1 and [f.start_cs for f in frames[:3]] == [0, 10, 20] and sum(frames[0].histogram.values()) == 192 * 128
    assert gif.decode_frames(spark.createDataFrame([(None,), (b"no gif",)], "media binary")).select(F.size("frames").alias("n")).collect()[1].n == 0


def test_gif_rules():
    """Local palettes, transparency, disposal and interlaced rows, written by hand."""
    import struct

    def frame(pixels, w, h, left=0, top=0, disposal=0, transparent=None, interlace=False, palette=b""):
        control = struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (transparent is not None), 7, transparent or 0, 0)
        flags = (0x40 if interlace else 0) | (0x80 if palette else 0)
        return control + struct.pack("<BHHHHB", 0x2C, left, top, w, h, flags) + palette + b"\x02" + gif._blocks(gif.lzw_encode(bytes(pixels), 2))

    head = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x80, 0, 0) + bytes([0, 0, 0, 255, 255, 255])
    file = head + frame([0, 0, 0, 0], 2, 2) + frame([1], 1, 1, 1, 1, disposal=3) + frame([1, 0], 2, 1, disposal=2, transparent=0) + frame([0], 1, 1, palette=bytes([255, 0, 0, 0, 0, 0])) + b"\x3b"
    frames = gif.read_gif(file)
    assert [f.histogram for f in frames] == [{0: 4}, {0: 3, 63: 1}, {0: 3, 63: 1}, {48: 1, 0: 2}]
    assert [(f.start_cs, f.disposal, f.transparent) for f in frames] == [(0, 0, None), (7, 3, None), (14, 2, 0), (21, 0, None)]
    tall = b"GIF89a" + struct.pack("<HHBBB", 1, 9, 0x80, 0, 0) + bytes(6) + frame([0, 1, 0, 1, 1, 0, 0, 1, 1], 1, 9, interlace=True)
    order = [r for s, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for r in range(s, 9, step)]
    rows = dict(zip(order, [0, 1, 0, 1, 1, 0, 0, 1, 1], strict=True))
    assert gif.read_gif(tall)[0].indices == bytes(rows[i] for i in range(9))
    assert gif.read_gif(file[:-40]) and gif.read_gif(b"") == []


#: A public sample: 10 by 10 pixels, 4 colours, code size 2, written by another encoder.
SAMPLE_GIF = bytes.fromhex(
    "474946383961 0a000a00910000 ffffff ff0000 0000ff 000000 21f90400000000002c00000000 0a000a0000 02 16 8c2d99872a1cdc33a00275ec95faa8de608c04914c0100 3b"
)


def test_gif_of_another_encoder():
    a, b = [1] * 5 + [2] * 5, [2] * 5 + [1] * 5
    c, d = [1] * 3 + [0] * 4 + [2] * 3, [2] * 3 + [0] * 4 + [1] * 3
    frame = gif.read_gif(SAMPLE_GIF)[0]
    assert list(frame.indices) == [*a * 3, *c * 2, *d * 2, *b * 3]
    assert frame.histogram == {63: 16, 48: 42, 3: 42}


def test_gif_bombs_and_null_media(spark):
    """A full table whose longest entry is asked for again and again, behind a frame of one pixel."""
    codes = [4, *[1, 6, *range(7, 4096)], *[4095] * 700_000]
    bits, n, out, width = 0, 0, bytearray(), 3
    for k, c in enumerate(codes):
        width = 3 if k < 4 else min(12, max(3, (k + 5 - 1).bit_length()))
        bits |= c << n
        n += width
        while n >= 8:
            out.append(bits & 255)
            bits, n = bits >> 8, n - 8
    head = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6) + struct.pack("<BHHHHB", 0x2C, 0, 0, 1, 1, 0) + b"\x02"
    bomb = head + gif._blocks(bytes(out)) + b";"
    assert len(bomb) > 1_000_000
    tracemalloc.start()
    frames = gif.read_gif(bomb)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(frames) <= 1 and peak < 200e6
    rows = spark.createDataFrame([(1, 5, None), (None, None, b"no gif"), (2, 1, gif.write_gif(b"x" * 192))], "doc_id long, n_bytes long, media binary")
    got = {r.doc_id: r for r in gif.digests(rows).collect()}
    assert got[1].payload_sha256 is None and got[1].n_frames is None and got[None].n_frames == 0 and got[2].payload_bytes == 192


def test_broken_gifs_yield_whole_frames():
    for n in range(len(SAMPLE_GIF)):
        assert len(gif.read_gif(SAMPLE_GIF[:n])) == (n >= len(SAMPLE_GIF) - 1)  # cut anywhere
    size_at = SAMPLE_GIF.index(bytes.fromhex("0216"))
    for size in (0, 9, 255):
        assert gif.read_gif(SAMPLE_GIF[:size_at] + bytes([size]) + SAMPLE_GIF[size_at + 1 :]) == []
    for at in (6, size_at - 5):  # the screen's size (a frame smaller than it is whole), and the frame's
        huge = SAMPLE_GIF[:at] + b"\xff\xff\xff\xff" + SAMPLE_GIF[at + 4 :]
        assert len(gif.read_gif(huge)) == (at == 6)
    rng = random.Random(16)
    for _ in range(3000):
        file = bytearray(SAMPLE_GIF)
        for _ in range(rng.randint(1, 4)):
            file[rng.randrange(6, len(file))] = rng.randrange(256)
        assert len(gif.read_gif(bytes(file))) <= 2
    assert gif.read_gif(b"GIF89a") == gif.read_gif(b"no gif") == []


# language
def test_language(spark):
    rng = random.Random(7)
    parts = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ung", "ver"], "cc": ["ción", "ado", "la"]}
    make = lambda lang, n: " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(n))
    rows = [(i, make(lang := "abc"[i % 3] * 2, rng.randint(5, 60)), lang) for i in range(240)]
    table = docs(spark, [*rows, (500, None, "aa"), (501, "12 34 !", "aa"), (502, "kato", None), (None, "kato", "aa")])
    model = langid.fit(table.where(~langid.held_out(F.col("doc_id"))))
    got = {r.doc_id: r for r in langid.predict(table, model).collect()}
    assert len(got) == 244 and np.mean([got[i].lang_pred == lang for i, _, lang in rows]) > 0.98
    assert (got[500].lang_pred, got[501].lang_pred, got[501].score, got[502].lang_pred) == ("und", "und", 0.0, "aa")
    assert all(0 <= r.score <= 1 for r in got.values()) and not got[500].accepted
    assert langid.predict(table.limit(0), model).count() == 0
    assert langid.predict(table, langid.fit(table.limit(0))).where("lang_pred <> 'und'").count() == 0


# personal data
def pii_by_brute_force(text):
    forms = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    return [(k, m.start(), m.end()) for k, p in forms for m in re.finditer(p, text) if pii._CHECKS[k](m[0])]


def test_patterns_equal_plain_search():
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choices("a1@.+- _2(9é", k=rng.randint(0, 30)))
        assert pii.base_spans(text) == pii_by_brute_force(text)


def test_personal_data(spark):
    rows = [(1, "mail joe.b+x@mail.example.com now, 10.0.0.256 and 10.0.0.255"), (2, "é 4111 1111 1111 1111 and 4111111111111112"), (3, "call (269) 555-3296 today please"), (4, "on 12.03.2024 at 10:45 we paid $12.50 for 3 of 1200"), (5, "x" * 200_000 + " a@b.co"), *ODD]
    got = {r.doc_id: r for r in pii.span_digests(pii.find_personal_data(docs(spark, rows))).collect()}
    assert got[1].n_email == 1 and got[1].n_ip == 1 and got[1].spans == "email:5:29,ip:50:60"
    assert got[2].n_card == 1 and got[2].spans == "card:2:21"
    assert got[3].n_phone == 0 and got[3].spans == "phone:5:19" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[4].spans == "" and got[5].spans == "email:200001:200007" and got[900].spans == "" and got[None].n_added == 0
    assert pii.find_personal_data(docs(spark, rows).limit(0)).count() == 0


def test_chain_field_decodes_like_brute_force():
    import itertools

    field = pii.train(pii._examples(150), epochs=3)
    for words_, _ in pii._examples(25, seed=77):
        seq = words_[:5]
        u = field.unary(seq)
        best = max(itertools.product(range(len(pii.TAGS)), repeat=len(seq)), key=lambda y: sum(u[t, k] for t, k in enumerate(y)) + sum(field.steps[a, b] for a, b in itertools.pairwise(y)))
        assert tuple(field.decode([seq, [], ["x"]])[0]) == best


def test_field_on_sequences_kept_back():
    field = pii.train(pii._examples())
    kept_back = pii._examples(400, seed=77)
    hits = collections.Counter()
    for (words_, tags), path in zip(kept_back, field.decode([w for w, _ in kept_back]), strict=True):
        hits.update((t, pii.TAGS[k]) for t, k in zip(tags, path, strict=True))
    for tag in pii.TAGS:
        assert hits[tag, tag] >= 0.9 * sum(n for (t, _), n in hits.items() if t == tag)
        assert hits[tag, tag] >= 0.9 * sum(n for (_, k), n in hits.items() if k == tag)
    texts = ['the token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" is bad', "password: hunter42!xK", "at checksum = 04dbebab91ab85687d33eeaaf9ac699e1188f962 we saw", "call (555) 123-4567 now", "no data in 2024 at all", ""]
    got = [[(kind, t[a:b]) for kind, a, b in spans] for t, spans in zip(texts, pii.field_spans(texts, field), strict=True)]
    assert got == [[("secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962")], [("secret", "hunter42!xK")], [], [("phone", "(555) 123-4567")], [], []]


# decontamination
def test_leaks_equal_brute_force(spark):
    rng = random.Random(9)
    items = [(i, words(rng, 35, 900)) for i in range(30)] + [(40, "only four words here"), (41, None), (None, "no id"), (42, ""), (40, "only four words here")]
    rows = []
    for i in range(60):
        text = words(rng, 150, 900).split()
        if i % 3 == 0:
            item = items[i % 30][1].split()
            for k in range(i % 5, len(item), 6):  # substitutions
                item[k] = "zzz"
            text[40:40] = item[i % 4 :]
        if i % 20 == 1:
            text[5:5] = "only four words here".split()
        rows.append((i, " ".join(text)))

    leaks = lambda text: leaked_by_brute_force(text, items)
    table, bench = docs(spark, [*rows, *ODD]), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: list(r["items"]) for r in decontam.find_leaks(table, bench).collect()}
    assert {i: got[i] for i, _ in rows} == {i: leaks(t) for i, t in rows} and got[900] == []
    kept = decontam.drop_leaks(table, bench)
    assert kept.columns == table.columns and kept.count() == sum(not leaks(t) for _, t in rows) + len(ODD)
    assert decontam.find_leaks(table, bench.limit(0)).where("best > 0").count() == 0 and decontam.find_leaks(table.limit(0), bench).count() == 0


def leaks_without_spark(items, texts):
    """[{item id: best}] of some texts, by the operator's own steps on Arrow batches."""
    seeds = pa.Table.from_batches(decontam._item_seeds([pa.record_batch([pa.array([i for i, _ in items]), pa.array([t for _, t in items])], ["item_id", "text"])])).to_pandas()
    every = types.SimpleNamespace(value=lambda h: np.arange(len(h)))
    keys = pa.array([b"%d" % i for i in range(len(texts))], pa.binary())
    found = decontam._hits(every, sorted(set(seeds.tag)))([pa.record_batch([keys, pa.array(texts)], ["text_key", "text"])])
    hits = pa.Table.from_batches(found, pa.schema([("text_key", pa.binary()), ("h", pa.int64()), ("tokens", pa.binary())])).to_pandas()
    pairs = pa.RecordBatch.from_pandas(hits.merge(seeds, on="h"))
    out = [{} for _ in texts]
    for r in pa.Table.from_batches(decontam._verified([pairs])).to_pylist():
        found = out[int(r["text_key"])]
        found[r["item_id"]] = max(r["best"], found.get(r["item_id"], 0))
    return out


@pytest.mark.parametrize("n", range(1, 21))
def test_every_allowed_substitution_is_found(n):
    allowed = n - -(-8 * n // 10)
    item = [f"t{i}" for i in range(n)]
    texts = lambda k: ["before " + " ".join("other" if i in gone else t for i, t in enumerate(item)) + " after" for gone in itertools.combinations(range(n), k)]
    assert all(x == {7: n - allowed} for x in leaks_without_spark([(7, " ".join(item))], texts(allowed)))
    assert n >= 12 or not any(leaks_without_spark([(7, " ".join(item))], texts(allowed + 1)))


def test_short_items_equal_brute_force():
    rng = random.Random(11)
    items = [(i, words(rng, 1 + i % 24, 9)) for i in range(90)]
    texts = [words(rng, rng.randrange(60), 9) for _ in range(60)]
    assert [sorted(x) for x in leaks_without_spark(items, texts)] == [leaked_by_brute_force(t, items) for t in texts]


def test_full_filter_changes_nothing(spark, monkeypatch):
    rng = random.Random(10)
    items = [(i, words(rng, 30, 900)) for i in range(20)]
    table = docs(spark, [(i, words(rng, 50, 900) + " " + t) for i, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "LEAST_BITS", 15)
    monkeypatch.setattr(decontam, "FILTER_BITS", 15)  # one byte a block: nearly every bit is set
    assert sorted((r.doc_id, list(r["items"])) for r in decontam.find_leaks(table, bench).collect()) == [(i, [i]) for i in range(20)]


def test_hot_passages_leak_as_without_classes(spark, monkeypatch):
    rng = random.Random(15)
    common, short = words(rng, 25, 900), words(rng, 12, 900)
    put = lambda text, n, part: " ".join([*text.split()[:n], part, *text.split()[n:]])
    changed = lambda text, *at: " ".join("zz" if i in at else w for i, w in enumerate(text.split()))
    items = [(i, put(words(rng, 24, 900), (0, 24, i % 24)[i % 3], common)) for i in range(40)]
    items += [(100 + i, put(words(rng, 30, 900), i, short)) for i in range(20)] + [(200 + i, f"{common} {common}") for i in range(5)] + [(300 + i, common[: common.index(" ", 60)]) for i in range(5)]
    parts = [common, changed(common, 12), changed(common, 4, 9, 20), changed(common, 2, 8, 14, 20), " ".join(common.split()[:17]), " ".join(common.split()[5:]), short, changed(short, 5), items[7][1], changed(items[45][1], 3, 15), f"{common} {short} {common}", "none"]
    rows = [(i, put(words(rng, 60, 900), (0, 60, i)[i % 3], parts[i % len(parts)])) for i in range(48)]
    table, bench = docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    results = []
    for hot in (1, 10**9):
        monkeypatch.setattr(decontam, "HOT", hot)
        results.append({r.doc_id: (list(r["items"]), r.best) for r in decontam.find_leaks(table, bench).collect()})
        if hot == 1:
            dropped = set(results[-1]) - {r.doc_id for r in decontam.drop_leaks(table, bench).collect()}
            assert dropped == {i for i, (found, _) in results[-1].items() if found}
    assert results[0] == results[1]
    assert {i: found for i, (found, _) in results[0].items()} == {i: leaked_by_brute_force(t, items) for i, t in rows}


def test_hot_passage_makes_no_pairs_of_places(spark):
    rng = random.Random(16)
    common, n = words(rng, 25, 900), 200
    around = lambda: f"{words(rng, 20, 9000)} {common} {words(rng, 20, 9000)}"
    table, bench = docs(spark, [(i, around()) for i in range(n)]), spark.createDataFrame([(i, around()) for i in range(n)], "item_id long, text string")
    found = decontam._Found(table, bench)
    assert found.judged.where("best > 0").count() < 100 * n  # a hit for each seed of the passage, whatever the number of items
    assert found.by_set.count() < 2 * n and found.one_by_one(found.by_set.select("text_key", "set_id")).count() == 0
    assert decontam.find_leaks(table, bench).where(f"size(items) = {n} and best = 20").count() == n


def test_odd_rows_leak_one_by_one(spark):
    rng = random.Random(12)
    items = [(i, words(rng, 30, 900)) for i in range(20)]
    rows = [(None, items[0][1]), (None, items[1][1] + " " + items[2][1]), (None, None), (3, items[3][1]), (3, items[4][1]), (3, items[3][1]), (3, "x"), (4, items[5][1] + " and " + items[19][1][: items[19][1].rindex(" ")])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((repr(r.doc_id), list(r["items"]), r.best) for r in decontam.find_leaks(docs(spark, rows), bench).collect())
    assert got == sorted([("None", [0], 20), ("None", [1, 2], 20), ("None", [], 0), ("3", [3], 20), ("3", [4], 20), ("3", [3], 20), ("3", [], 0), ("4", [5, 19], 20)])


def test_hits_of_a_long_text_go_out_in_parts(monkeypatch):
    item = words(random.Random(13), 30, 900)
    text = pa.array([f"{item} " * 400, "few", f"{item} " * 400])
    keys = pa.array([b"a", b"b", b"a"], pa.binary())
    monkeypatch.setattr(decontam, "_SENT", 100)
    every = types.SimpleNamespace(value=lambda h: np.arange(len(h)))
    parts = list(decontam._hits(every, range(5))([pa.record_batch([keys, text], ["text_key", "text"])]))
    assert max(p.num_rows for p in parts) == 100 and len(parts) > 400  # and the copy's hits stand for its own
    assert sum(p.num_rows for p in parts) == sum(400 * 30 - len(m) + 1 for m in decontam.MASKS)


def test_words_of_many_texts_at_once():
    texts = ["", "Ab c", None, "c", "ä-ö x1", "", "ab", " ", "Ab\nC"]
    column = pa.array(["skipped", *texts])[1:]
    one = {}
    for size in (1, 4, 1000):
        got = [[] for _ in texts]
        for first, data, offsets in chunks(column, size):
            for v, t in zip(*decontam.tokens(data, offsets), strict=True):
                got[first + t].append(int(v))
        for vs, t in zip(got, texts, strict=True):
            plain = word_list(t)
            assert len(vs) == len(plain) and all(one.setdefault(w, v) == v for w, v in zip(plain, vs, strict=True))
    assert len(set(one.values())) == len(one) == 5
