"""Line dedup, source divergence and conversation repair against plain versions."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from spanloom.llm import divergence, lines, oracles, turns

SPACE = " \t\n\x0b\x0c\r"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def lines_by_brute_force(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[low(line.strip(SPACE))].add(i)
    keeper = {k: max(i for i in ids if i is not None) for k, ids in holders.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if keeper.get(low(x.strip(SPACE)), i) == i]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows(seed):
    rng = random.Random(seed)
    common = ["é" * 12, "The Same Line of text", "  The same LINE of text\t", "ß" + "x" * 9, " " + "separated by no break", "short", "", " \x0b ", "\x85 kept, as it is no white space here", "a" * 300]
    rows = [(i, "\n".join(rng.choice(common) if rng.random() < 0.5 else f"line {rng.randrange(99)} of its own" for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    return rows + [(7, None), (7, ""), (8, "The Same Line of text\nThe same line of text"), (None, "the same line of text\nother"), (None, "\n\n"), (500, "a" * 300), (500, "a" * 300), (-3, "the same line of text\r\n")]


@pytest.mark.parametrize("path", ["filter and keys sent", "filter joined", "keys joined"])
def test_lines_equal_brute_force(spark, monkeypatch, path):
    rows = line_rows(3)
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_lines int").repartition(5)
    if path == "filter joined":
        monkeypatch.setattr(lines, "FULL", -1)
    out = lines.drop_repeated_lines(table, 10, 4, broadcast_keys=-1 if path == "keys joined" else 1000)
    assert out.columns == ["doc_id", "text", "kept_text", "n_lines", "n_dropped"]
    got = out.collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text or "") for r in got), key=repr) == lines_by_brute_force(rows, 10, 4)
    assert all((r.kept_text is None) == (r.text is None) for r in got)
    assert lines.drop_repeated_lines(table.limit(0)).count() == 0


def test_filter_misses_no_repeat_and_grows(spark):
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2)
    for bits in (20, 24, 30):
        a, b = lines._places(h, bits)
        assert (a < 1 << bits).all() and (b < 1 << bits).all() and ((a >> np.uint64(20)) == (b >> np.uint64(20))).all()
    text = "\n".join(f"{i:050d}" for i in range(3000))
    table = spark.createDataFrame([(1, text), (2, text[:51000]), (3, f"{7:050d}\n" * 2)], "doc_id long, text string").repartition(3)
    twice, bits = lines.twice_seen(table)
    folded = lines._Folded(bits)
    for r in twice.collect():
        folded.add(r["block"], r["bits"])
    data = np.frombuffer(text.encode(), np.uint8)
    keys = lines.Lines(data, np.array([0, len(data)]), 40)
    hit = set(folded(keys.hashes).tolist())
    assert set(range(1000)) <= hit and len(hit) < 1100
    assert bits >= 20 and lines.twice_seen(table.unionByName(table.selectExpr("doc_id", "repeat(text, 200) AS text")))[1] > bits


def test_long_and_many_lines():
    data = np.frombuffer(("x" * 3_000_000 + "\n" * 1000).encode(), np.uint8)
    found = lines.Lines(data, np.array([0, len(data), len(data)]), 40)
    assert len(found.starts) == 1002 and found.long.tolist() == [0] and found.text[-1] == 1


def divergence_by_brute_force(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text or ""))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        of = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])
        p, q = of(counts[lang, source]), of(whole)
        pairs = []
        for other in sorted(s for g, s in groups if g == lang and s != source):
            o = of(counts[lang, other])
            pairs.append((-sum((p[t] - o[t]) ** 2 // o[t] for t in kept), other.encode()))
        terms = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            out |= {(lang, source, part, item.decode(), -v, n) for n, (v, item) in enumerate(sorted(found)[:most], 1)}
    return out


@pytest.mark.parametrize(("bucket", "tile"), [(1 << 16, 8), (4, 2), (7, 1)])
def test_divergence_equals_brute_force(spark, bucket, tile):
    rng = random.Random(2)
    words = ["the", "The", "é", "日本", "a_b", "x9y", "\x7fq", "[z]", *[f"w{chr(97 + i)}" for i in range(20)]]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "ß", None, "Z", "s10"]), " ".join(rng.choices(words, k=rng.randrange(12)))) for _ in range(150)]
    rows += [("one", "only", "word word word"), ("rare", "a", "never"), ("rare", "b", "again"), ("rare", "c", None), ("en", "quiet", None), *[("big", "s", "go " * 50_000)] * 3, ("big", "t", "")]
    table = spark.createDataFrame([(*r, 3) for r in rows], "lang string, source string, text string, n long").repartition(4)
    out = divergence.divergence(table, 3, 5, bucket, tile)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == divergence_by_brute_force(rows, 3, 5)
    assert divergence.divergence(table.limit(0)).count() == 0


def test_shares_are_exact_for_large_counts():
    counts, size = np.array([0, 1, 10**14, 123_456_789_012_345]), 2 * 10**14 + 7
    assert divergence._shares(counts, size).tolist() == [1 + 10**9 * (int(c) + 1) // size for c in counts]


def repair_by_brute_force(rows):
    """rows (turn, role, text, copies) of one conversation, damaged; Dijkstra over (next turn, state)."""
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}:{t}".encode()).digest()
    rows = [(turn, r, t) for turn, r, t, n in rows for _ in range(n)]
    rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, digest(*x[1:])))
    seen, faults = set(), []
    for _, r, t in rows:
        last = t.strip(SPACE)[-1:]
        faults.append("blank" if not last else "duplicate" if (r, t) in seen else "truncated" if last not in ".!?" else "")
        seen.add((r, t))
    known = [t for t, *_ in rows if t is not None]
    counts = [max(known) - min(known) + 1 - len(set(known)) if known else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")]]
    counts.append(sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)))
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, at, out = heapq.heappop(heap)
        if i == len(rows) and at in ("", "a"):
            return (*counts, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
        if (i, at) in done:
            continue
        done.add((i, at))
        for x in allowed[at]:
            name = {"u": "user", "a": "assistant"}.get(x)
            if name:
                heapq.heappush(heap, (cost + 5, audit + "I", i, x, (*out, f"{name}:")))
            if i < len(rows) and faults[i] in ("", "truncated"):
                _, role, text = rows[i]
                more = 5 if faults[i] else 0
                if role[:1] == x:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, x, (*out, f"{role}:{text}")))
                if name:
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, x, (*out, f"{name}:{text}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, at, out))


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out[conv].append((turn, "user" if draw == 4 else role, text, {0: 0, 3: 2}.get(draw, 1)))
    return out


def turn_rows(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "User"]
    texts = ["Yes.", "No!", "cut", "", None, " \t", "What? \n", "é.", "a.b"]
    return [(rng.choice([*range(n // 6), None]), rng.choice([None, *range(12)]), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.5 else f"say {rng.random()}.") for _ in range(n)]


@pytest.mark.parametrize("most", [turns.PIECE_TURNS, 2, 1])
def test_repair_equals_brute_force(spark, most):
    rows = turn_rows(most, 500)
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, key long").repartition(6)
    got = {r.conv_id: tuple(r)[1:] for r in turns.repair(turns.damage(table), most).collect()}
    want = {conv: repair_by_brute_force(r) for conv, r in damaged(rows).items()}
    assert got == want
    kept = turns.repaired_turns(turns.damage(table), most).orderBy("conv_id", "range", "piece", "n").collect()
    text = defaultdict(list)
    for r in kept:
        text[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(text[c]).encode()).hexdigest() == want[c][-1] for c in want)
    assert turns.repair(turns.damage(table.limit(0))).count() == 0


def test_repair_equals_sql(spark):
    table = spark.createDataFrame([r for r in turn_rows(9, 300) if r[0] is not None], "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", table.toArrow())
    assert sorted(map(tuple, turns.repair(turns.damage(table)).collect())) == sorted(con.sql(oracles.TURNS).fetchall())


def test_one_conversation_over_many_ranges(spark):
    """A third of all turns in one conversation: its pieces lie in several ranges and tasks."""
    long = [(1, i, ("user", "assistant")[i % 2] if i % 7 else "assistant", f"turn {i}." if i % 5 else "cut off") for i in range(3000)] + [(1, 5000 + i, "user", "same.") for i in range(900)]
    rows = long + [(2 + i % 2000, i // 2000, ("user", "assistant")[i // 2000 % 2], f"x{i}.") for i in range(8000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    got = {r.conv_id: tuple(r)[1:] for r in turns.repair(turns.damage(table), 64).collect()}
    want = damaged(rows)
    assert len(got) == 2001 and all(got[c] == repair_by_brute_force(want[c]) for c in range(2, 100))
    assert got[1] == turns_one_by_one(want[1])
    pieces = turns.placed_pieces(turns._plain(turns.damage(table)), 64)
    assert pieces[1].where("conv_id = 1").count() > 50 and pieces[0].count() > 1900


def turns_one_by_one(rows):
    """repair_by_brute_force of many turns whose numbers all differ: costs from the end, then choices."""
    rows = sorted((turn, r, t) for turn, r, t, n in rows for _ in range(n))
    seen, runs = set(), []
    for _, r, t in rows:
        fault = turns.DUPLICATE if (r, t) in seen else turns.CUT_OFF if not re.search(r"[.!?]\s*$", t) else turns.CLEAN
        fault = fault if t.strip() else turns.BLANK
        seen.add((r, t))
        runs.append((r[:1], fault))
    after = [turns.END]
    for symbol in reversed(runs):
        after.append(turns.cost_before(turns.power(symbol, 0), after[-1]))
    after.reverse()
    audit, state, out = "", turns.START, []
    for i, symbol in enumerate(runs):
        while True:
            ways = [("D", turns.DELETE + after[i + 1][state], state), *[(x, c + after[i + 1][to], to) for x, c, to in turns.edits(symbol, state)[1:]]]
            to = next(s for x, s in turns.NEXT[state].items() if x != "s")
            ways.append(("I", turns.INSERT + after[i][to], to))
            letter, _, nxt = min(w for w in ways if w[1] == after[i][state])
            audit += letter
            role = "user" if nxt == turns.USER else "assistant"
            if letter != "D":
                out.append(f"{rows[i][1] if letter == 'K' else role}:{'' if letter == 'I' else rows[i][2]}")
            state = nxt
            if letter != "I":
                break
    while state not in (turns.START, turns.ASSISTANT):
        audit, state = audit + "I", turns.ASSISTANT if state == turns.USER else turns.USER
        out.append("assistant:" if state == turns.ASSISTANT else "user:")
    faults = [f for _, f in runs]
    known = {t for t, *_ in rows}
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(runs, runs[1:], strict=False))
    return (max(known) - min(known) + 1 - len(known), faults.count(turns.BLANK), faults.count(turns.DUPLICATE), faults.count(turns.CUT_OFF), illegal, after[0][turns.START], audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_powers_equal_single_steps():
    rng = random.Random(4)
    for _ in range(200):
        symbol, n = (rng.choice(["s", "u", "a", ""]), rng.choice([turns.CLEAN, turns.BLANK, turns.DUPLICATE, turns.CUT_OFF])), rng.randrange(1, 70)
        after = tuple(rng.randrange(20) for _ in range(4))
        step = after
        for _ in range(n):
            step = turns.cost_before(turns.power(symbol, 0), step)
        assert turns.run_before(symbol, n, after) == step == turns.cost_before(turns.transition([(symbol, n)]), after)
