"""Repair of the turn structure of conversations at least cost.

A conversation is in order when the initials of its roles read ``(s?(ua)+)?``: an optional system turn,
then user and assistant in turns, or nothing. Each turn may have a fault: blank (no visible character),
duplicate (role and text were there before) or truncated (the last visible character ends no
sentence). Edits are Keep (0), Rerole to user or assistant (1), Delete (2; blank and duplicate turns
must go) and Insert an empty user or assistant turn (5); a truncated turn that stays costs 5 more. Of
all cheapest edits the one whose initials come first in ASCII order is taken.

What a turn asks of the DP is a symbol: class of its role's initial and fault. Equal symbols in a row
are a run, and a run of n turns is the n-th min-plus power of its symbol's transition between the four
states (nothing, after s, after u, after a), put together from cached powers of two. As such products
are associative, a conversation can be cut anywhere: turns are sorted in ranges, packed into pieces of
bounded size, and each piece is one matrix. Pieces that hold a whole conversation are solved at once.
For others, the costs behind each piece follow from the matrices behind it, then the state before each
piece from those before it; so no task holds the turns of a long conversation, and only its hash and
its audit are put together in one stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from .storage import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
CLEAN, BLANK, DUPLICATE, CUT_OFF = range(4)
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: What may come next in each state: letters and the states they lead to.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NAMES = {"u": "user", "a": "assistant"}
_SPACE = " \t\n\x0b\x0c\r"
_NO = 1 << 60
#: Turns and characters of a piece.
PIECE_TURNS, PIECE_CHARS = 4096, 1 << 20

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]
#: (initial, fault) of a turn: the initial is s, u, a, or empty for all others.
Symbol = tuple[str, int]


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product."""
    return tuple(tuple(min(_NO, *(row[k] + b[k][j] for k in STATES)) for j in STATES) for row in a)


def cost_before(m: Matrix, after: Vector) -> Vector:
    """Least cost from each state on, given the costs behind ``m``."""
    return tuple(min(_NO, *(row[k] + after[k] for k in STATES)) for row in m)


ONE: Matrix = tuple(tuple(0 if i == j else _NO for j in STATES) for i in STATES)
_INSERTED: Matrix = tuple(tuple(INSERT if j in NEXT[i].values() and j != SYSTEM else _NO for j in STATES) for i in STATES)
#: No, one or two inserted turns; more are never needed in one place.
_FREE = tuple(tuple(map(min, a, b, c)) for a, b, c in zip(ONE, _INSERTED, times(_INSERTED, _INSERTED), strict=True))
END: Vector = cost_before(_FREE, (0, _NO, _NO, 0))


@lru_cache(maxsize=None)
def edits(symbol: Symbol, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letter, cost, next state) of the ways to deal with a turn, in ASCII order of the letters."""
    initial, fault = symbol
    out = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT_OFF else 0
        out += [("K", KEEP + more, to) for letter, to in NEXT[state].items() if letter == initial]
        out += [("R", REROLE + more, to) for letter, to in NEXT[state].items() if letter in NAMES]
    return tuple(out)


@lru_cache(maxsize=None)
def power(symbol: Symbol, k: int) -> Matrix:
    """The transition of 2**k turns of a symbol."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    once = [[_NO] * 4 for _ in STATES]
    for state in STATES:
        for _, cost, to in edits(symbol, state):
            once[state][to] = min(once[state][to], cost)
    return times(_FREE, tuple(map(tuple, once)))


def run_before(symbol: Symbol, n: int, after: Vector) -> Vector:
    """Costs before a run of n turns."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            after = cost_before(power(symbol, k), after)
    return after


def transition(runs: list[tuple[Symbol, int]]) -> Matrix:
    """The matrix of some runs, one behind the other."""
    columns = []
    for j in STATES:
        v = tuple(0 if i == j else _NO for i in STATES)
        for symbol, n in reversed(runs):
            v = run_before(symbol, n, v)
        columns.append(v)
    return tuple(zip(*columns, strict=True))


def unroll(runs: list[tuple[Symbol, int]], state: int, after: Vector, last: bool) -> tuple[str, int]:
    """The edits of some turns, cheapest and then first in ASCII order, from ``state`` on where the costs
    behind them are ``after``; and the state behind them. The ``last`` turns also get the edits behind."""
    costs = [after]
    for symbol, n in reversed(runs):
        costs.append(run_before(symbol, n, costs[-1]))
    costs.pop()
    out = []
    for (symbol, n), end in zip(runs, reversed(costs), strict=True):
        # inside a run the costs before each turn are powers too; a few turns' are kept at once
        while n:
            part = min(n, 1024)
            inside = [run_before(symbol, n - part, end)]
            for _ in range(part):
                inside.append(cost_before(power(symbol, 0), inside[-1]))
            n -= part
            while len(inside) > 1:
                here, behind = inside[-1], inside[-2]
                if DELETE + behind[state] == here[state]:
                    out.append("D")
                    inside.pop()
                    continue
                inserted = next(to for letter, to in NEXT[state].items() if letter in NAMES)
                if INSERT + here[inserted] == here[state]:
                    out.append("I")
                    state = inserted
                    continue
                letter, _, state = next(e for e in edits(symbol, state)[1:] if e[1] + behind[e[2]] == here[state])
                out.append(letter)
                inside.pop()
    while last and state not in (START, ASSISTANT):
        out.append("I")
        state = next(to for letter, to in NEXT[state].items() if letter in NAMES)
    return "".join(out), state


def repaired(turns: list[tuple[str, str]], audit: str, state: int) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that edits leave, from ``state`` on."""
    at = iter(turns)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(at)
        if letter in "IR":
            name, state = next((n, to) for n, to in NEXT[state].items() if n in NAMES)
            yield NAMES[name], text
        elif letter == "K":
            state = NEXT[state][role[0]]
            yield role, text


def _runs(roles: list[str], faults: list[int], copies: list[int]) -> list[tuple[Symbol, int]]:
    """Runs of symbols; a turn's further copies are duplicates, or blank as it is."""
    out: list[tuple[Symbol, int]] = []

    def add(symbol: Symbol, n: int) -> None:
        if out and out[-1][0] == symbol:
            out[-1] = symbol, out[-1][1] + n
        elif n:
            out.append((symbol, n))

    for role, fault, n in zip(roles, faults, copies, strict=True):
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        add((initial, fault), 1)
        add((initial, BLANK if fault == BLANK else DUPLICATE), n - 1)
    return out


def damage(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) with nulls of role and text as one space and every 4 of 20 turns
    changed, by the CRC-32 of ``conv_id:turn``: dropped (``copies`` is 0), emptied, without ``.!?``, there
    twice (``copies`` is 2), said by the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    changed = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    return turns.select("conv_id", "turn", F.when(draw == 4, "user").otherwise(text("role")).alias("role"), changed.alias("text"), F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).cast("long").alias("copies"))


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, key, fault), one row for turns alike in all of the first four;
    key is a digest of role and text."""
    alike = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    key = F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
    keyed = materialize(alike.withColumn("key", key), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))  # nulls first
    said = keyed.where("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k")).agg(F.count("*").alias("times"), F.min(place).alias("first"))
    again = said.where("times > 1").select("c", "k", "first")
    joined = keyed.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    trimmed = F.rtrim(F.col("text"), F.lit(_SPACE))
    fault = F.when(trimmed == "", BLANK).when(later, DUPLICATE).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), CUT_OFF).otherwise(CLEAN)
    return joined.select("conv_id", "turn", "role", "text", "copies", "key", fault.alias("fault"))


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


_LONG, _TEXTS = pa.int64(), pa.list_(pa.string())
_STATS = {"blank": _LONG, "duplicate": _LONG, "truncated": _LONG, "illegal": _LONG, "low": _LONG, "high": _LONG, "turns": _LONG, "first": pa.string(), "last": pa.string()}
_PIECE = {"conv_id": _LONG, "range": _LONG, "piece": _LONG, "whole": pa.bool_(), "roles": _TEXTS, "texts": _TEXTS, "faults": pa.list_(pa.int32()), "copies": pa.list_(_LONG), "matrix": pa.list_(_LONG), **_STATS}
_PLACED = {"state": pa.int32(), "after": pa.list_(_LONG), "is_last": pa.bool_()}
_SOLVED = {"conv_id": _LONG, "range": _LONG, "piece": _LONG, "whole": pa.bool_(), "cost": _LONG, "audit": pa.string(), "kept": _LONG, "body": pa.string(), **_STATS}
_REPORT = {"conv_id": _LONG, "gaps": _LONG, "blank": _LONG, "duplicate": _LONG, "truncated": _LONG, "illegal": _LONG, "cost": _LONG, "audit": pa.string(), "repaired_sha256": pa.string()}
_TURNS = {"conv_id": _LONG, "range": _LONG, "piece": _LONG, "n": _LONG, "role": pa.string(), "text": pa.string()}


def _ddl(fields: dict) -> T.StructType:
    return from_arrow_schema(pa.schema(fields))


def _stats(a: dict | None, b: dict) -> dict:
    """The counts of turns that lie one behind the other."""
    if a is None or a["first"] is None:
        return dict(b)
    if b["first"] is None:
        return a
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += _illegal(a["last"], b["first"])
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    known = [x for x in (a["low"], b["low"], a["high"], b["high"]) if x is not None]
    return out | {"low": min(known, default=None), "high": max(known, default=None), "first": a["first"], "last": b["last"]}


def _one_turn(turn, role: str, copies: int, fault: int) -> dict:
    """The counts of a turn that is there ``copies`` times."""
    count = [0] * 4
    count[fault] += 1
    count[BLANK if fault == BLANK else DUPLICATE] += copies - 1
    initial = role[:1]
    return {"blank": count[BLANK], "duplicate": count[DUPLICATE], "truncated": count[CUT_OFF], "illegal": (copies - 1) * _illegal(initial, initial), "low": turn, "high": turn, "turns": int(turn is not None), "first": initial, "last": initial}


_NONE = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "low": None, "high": None, "turns": 0, "first": None, "last": None}


def _packed(most: int):
    """Sorted turns (conv_id, turn, role, text, copies, fault, range) as pieces of at most ``most`` rows,
    numbered within their range; ``whole`` ones hold a conversation with neighbours in the range on both
    sides."""
    return lambda batches: _pieces(batches, most)


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    piece, begun, parts, number, size, held, out = None, 0, 0, 0, 0, 0, []

    def close(whole: bool) -> None:
        matrix = None if whole else [x for row in transition(_runs(piece["roles"], piece["faults"], piece["copies"])) for x in row]
        out.append(piece | {"piece": number, "whole": whole, "matrix": matrix})

    for batch in batches:
        for conv_id, turn, role, text, copies, fault, at in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            new = piece is None or piece["conv_id"] != conv_id
            if new or len(piece["roles"]) >= most or size >= PIECE_CHARS:
                if piece is not None:
                    close(whole=new and begun > 1 and not parts)
                    number += 1
                begun, parts, held, size = begun + new, 0 if new else parts + 1, held + size, 0
                piece = {"conv_id": conv_id, "range": at, "roles": [], "texts": [], "faults": [], "copies": [], **_NONE}
                if len(out) >= 1024 or held >= PIECE_CHARS:
                    yield pa.RecordBatch.from_pylist(out, pa.schema(_PIECE))
                    held, out = 0, []
            if copies:
                for name, x in (("roles", role), ("texts", text), ("faults", fault), ("copies", copies)):
                    piece[name].append(x)
                size += len(role) + len(text)
                piece |= _stats({k: piece[k] for k in _STATS}, _one_turn(turn, role, copies, fault))
    if piece is not None:
        close(whole=False)
        yield pa.RecordBatch.from_pylist(out, pa.schema(_PIECE))


def _square(flat) -> Matrix:
    return tuple(tuple(int(x) for x in flat[4 * i : 4 * i + 4]) for i in STATES)


def _backward(df: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each piece of one conversation."""
    df, after, out = df.sort_values(["range", "piece"], ascending=False), END, []
    for flat in df["matrix"]:
        out.append(list(after))
        after = cost_before(_square(flat), after)
    return df[["conv_id", "range", "piece"]].assign(after=out, is_last=[i == 0 for i in range(len(df))])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the state behind each for every state before it."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            runs = _runs(r.pop("roles"), r.pop("faults"), r.pop("copies"))
            r["ends"] = [unroll(runs, s, tuple(r["after"]), r["is_last"])[1] if cost_before(transition(runs), tuple(r["after"]))[s] < _NO else s for s in STATES]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(_ENDS))


_ENDS = {"conv_id": _LONG, "range": _LONG, "piece": _LONG, "after": pa.list_(_LONG), "is_last": pa.bool_(), "ends": pa.list_(pa.int32())}


def _forward(df: pd.DataFrame) -> pd.DataFrame:
    """The state before each piece of one conversation."""
    df, state, out = df.sort_values(["range", "piece"]), START, []
    for ends in df["ends"]:
        out.append(state)
        state = int(ends[state])
    return df[["range", "piece", "after", "is_last"]].assign(state=out)


def _solution(r: dict) -> tuple[str, list[tuple[str, str]], int]:
    """Edits, turns that stay and cost of a placed piece."""
    runs = _runs(r["roles"], r["faults"], r["copies"])
    audit, _ = unroll(runs, r["state"], tuple(r["after"]), r["is_last"])
    turns = [(role, text) for role, text, n in zip(r["roles"], r["texts"], r["copies"], strict=True) for _ in range(n)]
    cut = [f == CUT_OFF and not i for f, n in zip(r["faults"], r["copies"], strict=True) for i in range(n)]
    prices, at = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}, iter(cut)
    cost = sum(prices[x] + (TRUNCATED if x != "I" and next(at) and x != "D" else 0) for x in audit)
    return audit, list(repaired(turns, audit, r["state"])), cost


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            audit, turns, cost = _solution(r)
            rows.append({k: r.get(k) for k in _SOLVED} | {"audit": audit, "cost": cost, "kept": len(turns), "body": "\n".join(f"{role}:{text}" for role, text in turns)})
        yield pa.RecordBatch.from_pylist(rows, pa.schema(_SOLVED))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solved pieces in the order of their conversations, as one row for each conversation."""
    out, now, stats, cost, audit, sha, kept = [], None, None, 0, [], None, 0

    def close() -> None:
        gaps = 0 if stats["low"] is None else stats["high"] - stats["low"] + 1 - stats["turns"]
        out.append({k: stats[k] for k in ("blank", "duplicate", "truncated", "illegal")} | {"conv_id": now[0], "gaps": gaps, "cost": cost, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()})

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or now[0] != r["conv_id"]:
                if now is not None:
                    close()
                now, stats, cost, audit, sha, kept = (r["conv_id"],), None, 0, [], hashlib.sha256(), 0
            stats, cost = _stats(stats, {k: r[k] for k in _STATS}), cost + r["cost"]
            audit.append(r["audit"])
            if r["kept"]:
                sha.update((b"\n" if kept else b"") + r["body"].encode("utf-8", "surrogatepass"))
                kept += r["kept"]
        if out:
            yield pa.RecordBatch.from_pylist(out, pa.schema(_REPORT))
            out = []
    if now is not None:
        close()
        yield pa.RecordBatch.from_pylist(out, pa.schema(_REPORT))


def _staying(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            turns = _solution(r)[1]
            yield pa.RecordBatch.from_pylist([{"conv_id": r["conv_id"], "range": r["range"], "piece": r["piece"], "n": n, "role": role, "text": text} for n, (role, text) in enumerate(turns)], pa.schema(_TURNS))


def placed_pieces(turns: DataFrame, most: int = PIECE_TURNS) -> tuple[DataFrame, DataFrame]:
    """The turns (conv_id, turn, role, text, copies) of all conversations as pieces, each with the state
    before it and the costs behind it: those that hold a whole conversation, and the others."""
    sorted_ = faults(turns).repartitionByRange("conv_id", "turn", "key").sortWithinPartitions("conv_id", "turn", "key")
    rows = sorted_.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", "copies", "fault", F.spark_partition_id().cast("long").alias("range"))
    pieces = materialize(rows.mapInArrow(_packed(most), _ddl(_PIECE)), "pieces")
    loose = pieces.where("not whole")
    behind = loose.select("conv_id", "range", "piece", "matrix").groupBy("conv_id").applyInPandas(_backward, "conv_id long, range long, piece long, after array<long>, is_last boolean")
    inside = loose.select("range", "piece", "roles", "faults", "copies").join(behind, ["range", "piece"])
    ends = inside.select("conv_id", "range", "piece", "after", "is_last", "roles", "faults", "copies").mapInArrow(_ends, _ddl(_ENDS))
    before = ends.groupBy("conv_id").applyInPandas(_forward, "range long, piece long, after array<long>, is_last boolean, state int")
    alone = pieces.where("whole").withColumns({"after": F.array(*[F.lit(x).cast("long") for x in END]), "is_last": F.lit(True), "state": F.lit(START)})
    return alone, loose.join(before, ["range", "piece"]).select(*alone.columns)


def repaired_turns(turns: DataFrame, most: int = PIECE_TURNS) -> DataFrame:
    """(conv_id, range, piece, n, role, text): the turns of all conversations after repair, in the order of
    range, piece and n; conversations without any have no row."""
    alone, apart = placed_pieces(_plain(turns), most)
    return alone.unionByName(apart).mapInArrow(_staying, _ddl(_TURNS))


def repair(turns: DataFrame, most: int = PIECE_TURNS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation in turns(conv_id, turn, role, text and, if it is there, copies).

    Turns are taken by number, nulls first and ties by a digest of role and text. Null roles and texts
    are one space; turns with 0 copies are not there, but their conversation is reported. Rows without a
    conv_id are one conversation; one of over ``most`` different turns is cut into pieces. A turn that is there twice is a duplicate the second time, whether the
    numbers differ or not. gaps are numbers that no turn has between the least and the greatest. A
    conversation without turns has zeros, an empty audit and the hash of an empty text; an empty table
    gives an empty table; other columns are not read.
    """
    alone, apart = (pieces.mapInArrow(_solved, _ddl(_SOLVED)) for pieces in placed_pieces(_plain(turns), most))
    # (what is one piece is dealt nowhere)
    in_order = apart.repartition("conv_id").sortWithinPartitions("conv_id", "range", "piece")
    return alone.mapInArrow(_joined, _ddl(_REPORT)).unionByName(in_order.mapInArrow(_joined, _ddl(_REPORT)))


def _plain(turns: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"), copies.alias("copies"))
