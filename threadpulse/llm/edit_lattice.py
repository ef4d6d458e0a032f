"""Repair of conversation structure by the cheapest edits.

A conversation is sound when its roles read system (at most once, first), then user and assistant in turn,
ending with the assistant. Every row gets one edit: Keep (0), Rerole to user or assistant (3) or Delete (4);
an empty user or assistant turn may be Inserted anywhere (3). Blank and repeated rows must go; a truncated row
that stays costs 3 more. Of the cheapest edits the one with the least string of initials is taken.

Lattice. A node is (rows read, what came last: nothing, system, user or assistant); edits are its edges. Two
heaps search it, one from the start and one from the sound ends, by cost and then by layer, as only Keep is
free and it leads one layer on. When their smallest costs together exceed the best crossing, every path of least
cost has a node that the forward search has settled and the backward search has reached; all those crossings are
compared by their concatenated initials. Neither of two equally dear paths between the same nodes can begin with
the other (it would hold further insertions), so the least halves give the least whole.

Order and size. Rows are ordered by turn (NULL first), role, the first 64 characters and a hash of the text, and
dealt out by ranges of (conv_id, that order, a number that parts equal rows), so no conversation, turn or group
of copies must fit one task. A conversation within one range and of up to `ROWS` rows is repaired where it is
read. The others are pieces of bounded size: what occurs earlier is found by grouping hashes, every piece is
searched from each state to each state, and the pieces' tables combine pairwise. The edits of one conversation
(a letter a row) meet in one task, as they are one value of the result; its texts pass through the hash in
order, a piece at a time.

Defined results: a NULL role or text reads as one space, a NULL turn comes first and counts for no gap, a NULL
conv_id is a conversation. A role whose first letter is not s, u or a, or that is empty, cannot be kept; texts may
be of any length. Rows that repeat role and text of an earlier row of the conversation are duplicates, also
within one turn. Conversations without rows left have zeros. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.llm import folders

WHITE = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows and bytes of a piece (4096 rows at most: a row's place in its piece takes 12 bits).
ROWS, BYTES = 1024, 4 << 20
_SEQ_BITS, _POS_BITS = 28, 12

# What came last: nothing, system, user, assistant. An inserted or re-roled turn continues the alternation.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ENDS = (_START, _ASSISTANT)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_BEFORE = {_START: (), _SYSTEM: (), _USER: (_START, _SYSTEM, _ASSISTANT), _ASSISTANT: (_USER,)}
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_INITIALS = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_GOOD_PAIRS = ("su", "ua", "au")

STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_TURNS = "turns array<struct<role:string,text:string>>"


def _kept(code: str, state: int) -> int | None:
    """The state after keeping a row, or None where that is not sound."""
    after = _INITIALS.get(code.lower())
    if after == _SYSTEM:
        return after if state == _START else None
    return after if after is not None and _NEXT[state] == after else None


def _out(codes: str, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    yield INSERT, "I", i, _NEXT[state]
    if i < len(codes):
        code = codes[i]
        yield DELETE, "D", i + 1, state
        if code not in "bd":
            more = TRUNCATED if code.isupper() else 0
            yield REROLE + more, "R", i + 1, _NEXT[state]
            after = _kept(code, state)
            if after is not None:
                yield KEEP + more, "K", i + 1, after


def _into(codes: str, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    for before in _BEFORE[state]:
        yield INSERT, "I", i, before
    if i:
        code = codes[i - 1]
        yield DELETE, "D", i - 1, state
        if code not in "bd":
            more = TRUNCATED if code.isupper() else 0
            for before in _BEFORE[state]:
                yield REROLE + more, "R", i - 1, before
            for before in _NEXT:
                if _kept(code, before) == state:
                    yield KEEP + more, "K", i - 1, before


def cheapest(codes: str, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and initials of the best path from start to one of ends, or None if there is none.

    codes has a letter for each row: its role's initial (x if that cannot stay), a capital if the text is
    truncated; b for blank and d for duplicate rows.
    """
    reached = [{(0, start): (0, "")}, {(len(codes), end): (0, "") for end in ends}]
    settled: list[set[tuple[int, int]]] = [set(), set()]
    heaps = [[(0, 0, start)], [(0, 0, end) for end in ends]]
    best = None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, _, state = top = heapq.heappop(heaps[side])
        node = (top[1] if side == 0 else len(codes) - top[1], state)
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = reached[side][node][1]
        other = reached[1 - side].get(node)
        if other is not None:
            best = cost + other[0] if best is None else min(best, cost + other[0])
        for price, letter, i, to in (_into if side else _out)(codes, *node):
            label = (cost + price, letter + audit if side else audit + letter)
            old = reached[side].get((i, to))
            if old is None or label < old:
                reached[side][i, to] = label
                if old is None or label[0] < old[0]:
                    heapq.heappush(heaps[side], (label[0], len(codes) - i if side else i, to))
                across = reached[1 - side].get((i, to))
                if across is not None:
                    best = label[0] + across[0] if best is None else min(best, label[0] + across[0])
    crossings = [(reached[0][v], reached[1][v]) for v in settled[0] if v in reached[1]]
    found = [(f[0] + b[0], f[1] + b[1]) for f, b in crossings if f[0] + b[0] == best]
    return min(found) if found else None


@lru_cache(maxsize=1 << 16)
def _whole(codes: str) -> tuple[int, str]:
    return cheapest(codes, _START, _ENDS)


@lru_cache(maxsize=1 << 10)
def _table(codes: str) -> dict[tuple[int, int], tuple[int, str]]:
    """The best paths through a piece from each state to each state."""
    paths = {(x, y): cheapest(codes, x, (y,)) for x in _NEXT for y in _NEXT}
    return {ends: path for ends, path in paths.items() if path is not None}


def _combined(one: dict, two: dict) -> dict[tuple[int, int], tuple[int, str]]:
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for (x, y), (cost, audit) in one.items():
        for (y2, z), (more, rest) in two.items():
            if y == y2 and ((x, z) not in out or cost + more <= out[x, z][0]):
                path = (cost + more, audit + rest)
                out[x, z] = min(path, out.get((x, z), path))
    return out


def edited(turns: list[tuple[str, str]], codes: str, state: int, letters: str) -> tuple[list[tuple[str, str]], int]:
    """The turns after the edits, from a state on, and the state reached."""
    out, i = [], 0
    for letter in letters:
        if letter in "IR":
            state = _NEXT[state]
            out.append((_NAMES[state], "" if letter == "I" else turns[i][1]))
        elif letter == "K":
            state = _kept(codes[i], state)
            out.append(turns[i])
        i += letter != "I"
    return out, state


def _code(role: str, text: str) -> str:
    body = text.rstrip(WHITE)
    if not body:
        return "b"
    initial = role[:1] if role[:1] in _INITIALS else "x"
    return initial if body[-1] in ".!?" else initial.upper()


def _counts(codes: str) -> dict[str, int]:
    return {"blank": codes.count("b"), "duplicate": codes.count("d"), "truncated": sum(map(str.isupper, codes))}


class _Piece:
    """Rows of a conversation that follow one another."""

    def __init__(self, conv_id, alone: bool) -> None:
        self.conv_id, self.alone = conv_id, alone
        self.turns: list[tuple[str, str]] = []
        self.codes: list[str] = []
        self.numbers: list[int] = []
        self.bytes = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append((role, text))
        self.codes.append(_code(role, text))
        self.bytes += len(role) + len(text)
        if turn is not None and (not self.numbers or self.numbers[-1] != turn):
            self.numbers.append(turn)

    def row(self, piece: int, whole: bool) -> dict:
        initials = [role[:1] for role, _ in self.turns]
        illegal = sum(a + b not in _GOOD_PAIRS for a, b in zip(initials, initials[1:], strict=False))
        row = {"conv_id": self.conv_id, "piece": piece, "whole": whole, "illegal": illegal}
        if whole:
            seen: set[tuple[str, str]] = set()
            for i, turn in enumerate(self.turns):
                if self.codes[i] != "b":
                    if turn in seen:
                        self.codes[i] = "d"
                    seen.add(turn)
            codes = "".join(self.codes)
            cost, audit = _whole(codes)
            numbers = self.numbers
            gaps = numbers[-1] - numbers[0] + 1 - len(numbers) if numbers else 0
            turns = edited(self.turns, codes, _START, audit)[0]
            row |= _counts(codes) | {"gaps": gaps, "cost": cost, "audit": audit, "codes": codes}
        else:
            turns = self.turns
            keys = [None if c == "b" else _key(t) for c, t in zip(self.codes, turns, strict=True)]
            row |= {"codes": "".join(self.codes), "keys": keys, "numbers": self.numbers[:1] + self.numbers[-1:]}
            row |= {"n_numbers": len(self.numbers), "initials": [*initials[:1], *initials[-1:]]}
        return row | {"turns": [{"role": r, "text": t} for r, t in turns]}


def _key(turn: tuple[str, str]) -> bytes:
    role, text = turn
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


_FIRST_PASS = f"piece long, whole boolean, {_TURNS}, codes string, {STATS}, " + (
    "keys array<binary>, numbers array<long>, n_numbers long, initials array<string>"
)


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 512, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    batch, held = [], 0
    for row in rows:
        batch.append(row)
        held += sum(len(t["text"]) for t in row.get("turns") or ())
        if len(batch) >= most or held >= size:
            yield pa.RecordBatch.from_pylist(batch, schema)
            batch, held = [], 0
    if batch:
        yield pa.RecordBatch.from_pylist(batch, schema)


def _pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[dict]:
    """Pieces of a sorted range; a conversation that cannot go on elsewhere is repaired at once."""
    part = TaskContext.get().partitionId()
    now, seq = None, 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present"))
        for conv_id, turn, role, text, present in zip(*columns, strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now.row(part << _SEQ_BITS | seq, now.alone)
                    seq += 1
                now = _Piece(conv_id, alone=now is not None)
            elif len(now.turns) >= rows or now.bytes >= BYTES:
                yield now.row(part << _SEQ_BITS | seq, False)
                seq += 1
                now = _Piece(conv_id, alone=False)
            if present:
                now.add(turn, role, text)
    if now is not None:
        yield now.row(part << _SEQ_BITS | seq, False)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Duplicates marked, and the best paths from state to state."""
    for batch in batches:
        for row in batch.to_pylist():
            first = set(row.pop("firsts") or ())
            codes = "".join(c if c == "b" or i in first else "d" for i, c in enumerate(row["codes"]))
            paths = [{"x": x, "y": y, "cost": c, "audit": a} for (x, y), (c, a) in _table(codes).items()]
            yield row | {"codes": codes, "paths": paths}


def _compose(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """The edits of one conversation from the tables of its pieces."""
    rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
    level = [{(p["x"], p["y"]): (p["cost"], p["audit"]) for p in r["paths"]} for r in rows]
    while len(level) > 1:
        pairs = zip(level[::2], level[1::2], strict=False)
        level = [_combined(a, b) for a, b in pairs] + level[len(level) // 2 * 2 :]
    cost, audit = min(path for (x, y), path in level[0].items() if x == _START and y in _ENDS)
    codes = "".join(r["codes"] for r in rows)
    stats = _counts(codes) | {"cost": cost, "audit": audit, "illegal": sum(r["illegal"] for r in rows)}
    ends = [r["initials"] for r in rows if r["initials"]]
    stats["illegal"] += sum(a[-1] + b[0] not in _GOOD_PAIRS for a, b in zip(ends, ends[1:], strict=False))
    runs = [(r["numbers"], r["n_numbers"]) for r in rows if r["numbers"]]
    distinct = sum(n for _, n in runs) - sum(a[-1] == b[0] for (a, _), (b, _) in zip(runs, runs[1:], strict=False))
    stats["gaps"] = runs[-1][0][-1] - runs[0][0][0] + 1 - distinct if runs else 0
    out, at, state = [], 0, _START
    for k, r in enumerate(rows):
        left, end = len(r["codes"]), at
        while left:
            left -= audit[end] != "I"
            end += 1
        end = len(audit) if k == len(rows) - 1 else end
        row = {"piece": r["piece"], "codes": r["codes"], "state": state, "letters": audit[at:end]}
        out.append(row | (stats if k == len(rows) - 1 else {}))
        state = edited([("", "")] * len(r["codes"]), r["codes"], state, audit[at:end])[1]
        at = end
    return pa.Table.from_pylist(out, schema)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in batch.to_pylist():
            turns = [(t["role"], t["text"]) for t in row["turns"]]
            new = edited(turns, row.pop("codes"), row.pop("state"), row.pop("letters"))[0]
            yield row | {"turns": [{"role": r, "text": t} for r, t in new]}


def _arrow(ddl: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl)


def _mapped(df: DataFrame, function, ddl: str) -> DataFrame:
    """mapInArrow with a function from batches to rows as dicts."""
    schema = _arrow(ddl, df.sparkSession)
    return df.mapInArrow(lambda batches: _batches(function(batches), schema), ddl)


def repaired(
    rows: DataFrame, present: str | None = None, piece_rows: int = ROWS, ranges: int | None = None
) -> DataFrame:
    """conv_id, piece, whole, turns (role, text) after the edits, and the statistics of the conversation.

    rows has conv_id, turn, role, text; where the column named by present is false, a row only names its
    conversation. Pieces are in order; a conversation of several pieces has its statistics on the last one alone.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    wanted = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col(present) if present else F.lit(True)).alias("present"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(256)).alias("copy"),
    )
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text")]
    dealt = wanted.repartitionByRange(*([ranges] if ranges else []), *order, "copy").sortWithinPartitions(*order)
    first = _mapped(dealt.drop("copy"), partial(_pieces, rows=piece_rows), f"conv_id {kind}, {_FIRST_PASS}")
    stored = folders.written(first, "conversation-pieces")
    stats = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    whole = stored.where("whole").select("conv_id", "piece", "whole", "turns", *stats)

    parts = stored.where("NOT whole")
    place = F.shiftleft("piece", _POS_BITS) + F.col("pos")
    keyed = parts.select("conv_id", "piece", F.posexplode("keys").alias("pos", "key")).where("key IS NOT NULL")
    firsts = keyed.groupBy("conv_id", "key").agg(F.min(place).alias("place"))
    firsts = firsts.select(
        F.shiftright("place", _POS_BITS).alias("piece"), F.col("place").bitwiseAND((1 << _POS_BITS) - 1).alias("pos")
    )
    firsts = firsts.groupBy("piece").agg(F.collect_list("pos").alias("firsts"))
    inner = f"conv_id {kind}, piece long, codes string, illegal long, numbers array<long>, n_numbers long, initials array<string>"
    lean = parts.select("conv_id", "piece", "codes", "illegal", "numbers", "n_numbers", "initials")
    paths = "paths array<struct<x:int,y:int,cost:long,audit:string>>"
    tables = _mapped(lean.join(firsts, "piece", "left").select(*lean.columns, "firsts"), _tables, f"{inner}, {paths}")
    composed = f"piece long, codes string, state int, letters string, {STATS}"
    schema = _arrow(composed, rows.sparkSession)
    edits = tables.groupBy("conv_id").applyInArrow(lambda t: _compose(t, schema), composed)
    joined = parts.select("conv_id", "piece", "whole", "turns").join(edits, "piece")
    joined = joined.select("conv_id", "piece", "whole", "turns", "codes", "state", "letters", *stats)
    return whole.unionByName(_mapped(joined, _apply, f"conv_id {kind}, piece long, whole boolean, {_TURNS}, {STATS}"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One SHA-256 a conversation over its pieces in order; the last piece has the cost."""
    digest, begun = hashlib.sha256(), False
    for batch in batches:
        for row in batch.to_pylist():
            for turn in row.pop("turns"):
                digest.update(f"{'\n' if begun else ''}{turn['role']}:{turn['text']}".encode())
                begun = True
            if row["cost"] is not None:
                yield row | {"repaired_sha256": digest.hexdigest()}
                digest, begun = hashlib.sha256(), False


def audits(repairs: DataFrame) -> DataFrame:
    """Statistics, edits and the hash of the repaired text (role:text lines) of each conversation."""
    kind = repairs.schema["conv_id"].dataType.simpleString()
    stats = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    digest = F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    whole = repairs.where("whole").select("conv_id", *stats, digest)
    parts = repairs.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    hashed = _mapped(parts.select("conv_id", "turns", *stats), _hashed, f"conv_id {kind}, {STATS}, repaired_sha256 string")
    return whole.unionByName(hashed)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: faults put in by a hash of conv_id and turn; a dropped row only names
    its conversation."""

    def known(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(known("text"), "[.!?]", ""))
    times = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(known("role")).alias("role"),
        text.otherwise(known("text")).alias("text"),
        (fault != 0).alias("present"),
        F.explode(times).alias("copy"),
    ).drop("copy")
