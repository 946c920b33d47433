"""Conversation structure repair: the cheapest edits that make the turns a dialogue.

A dialogue's role initials are ``(s?(ua)+)?``.  The edit lattice of a conversation has a
node for each number of turns read and each state (nothing yet, system read, user read,
assistant read).  Its edges are the edits: K(eep), R(erole to user or assistant),
D(elete) and I(nsert an empty turn).  The least cost comes from a bidirectional Dijkstra
search: a forward heap from the start and a reverse heap from the ends meet, both go on
until no crossing of that cost is left, and of all cheapest paths through the crossings
the one with the least audit (the edits' initials) is read off.  From one node, equal
initials lead to one node, so the least audit fixes the repaired roles as well.

A conversation may hold a third of all rows.  Turns are sorted by ranges of
(conversation, turn), so that such a conversation spreads over tasks, and cut into
blocks of BLOCK_ROWS turns or BLOCK_BYTES of text.  The search runs per block: over the
whole lattice where the conversation begins and ends in it, else for each pair of states
at its borders.  A second, narrow step picks the pairs by dynamic programming over the
blocks.  That step holds at most 16 audits of a block at once per block of one
conversation, about 16 bytes a turn, where the result's own audit takes one.  The
repaired text of a conversation is hashed while it streams through in order.

Rows are ordered by turn (nulls first), then role and text.  Null roles and texts read
as one space.  A null conv_id is a conversation of its own.  Repeated rows are
duplicates.  An empty table gives no rows.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dealwise.llm.common import small_batches, stored

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 18
WHITE = " \t\n\x0b\x0c\r"
#: States: nothing read, system read, user read, assistant read; a dialogue ends in ENDS.
STATES, ENDS = (0, 1, 2, 3), (0, 3)
SPEAKS = {0: 2, 1: 2, 2: 3, 3: 2}  # the state after the next user or assistant turn
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
ROLE = {2: "user", 3: "assistant"}


# ------------------------------------------------------------------ search

def _ahead(marks: str, i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits from node (i, q): (initial, cost, node reached).  ``marks`` has one letter a
    turn: the role's initial (o: another), upper case if cut off, x if it has to go."""
    if i < len(marks):
        m = marks[i]
        yield "D", DELETE, i + 1, q
        if m != "x":
            more = CUT_OFF if m.isupper() else 0
            kept = KEPT.get((m.lower(), q))
            if kept is not None:
                yield "K", KEEP + more, i + 1, kept
            yield "R", REROLE + more, i + 1, SPEAKS[q]
    yield "I", INSERT, i, SPEAKS[q]


def _behind(marks: str, i: int, q: int) -> Iterator[tuple[int, int, int]]:
    """Edits into node (i, q): (cost, node they come from)."""
    for p in (i, i - 1) if i else (i,):
        for state in STATES:
            for _, cost, j, r in _ahead(marks, p, state):
                if j == i and r == q:
                    yield cost, p, state


def least_edits(marks: str, entry: int = 0, exits: Iterable[int] = ENDS) -> tuple[int, str, int] | None:
    """(cost, least audit, exit state) of the cheapest edits from ``entry`` to one of
    ``exits``; None if none leads there."""
    n = len(marks)
    ahead, back = {(0, entry): 0}, {(n, q): 0 for q in exits}
    heap_f, heap_b = [(0, 0, entry)], [(0, n, q) for q in exits]
    best = min((0 for v in back if v in ahead), default=None)
    while heap_f and heap_b and (best is None or heap_f[0][0] + heap_b[0][0] <= best):
        forward = heap_f[0][0] <= heap_b[0][0]
        heap, mine, other = (heap_f, ahead, back) if forward else (heap_b, back, ahead)
        d, i, q = heappop(heap)
        if d > mine[i, q]:
            continue
        edges = ((c, j, r) for _, c, j, r in _ahead(marks, i, q)) if forward else _behind(marks, i, q)
        for c, j, r in edges:
            v = (j, r)
            if d + c < mine.get(v, d + c + 1):
                mine[v] = d + c
                heappush(heap, (d + c, j, r))
            if v in other and (best is None or d + c + other[v] < best):
                best = d + c + other[v]
    if best is None:
        return None
    # forward nodes that lie on a cheapest path: back from the crossings
    todo = [u for u, d in ahead.items() if back.get(u, best + 1) + d == best
            or any(d + c + back.get((j, r), best + 1) == best for _, c, j, r in _ahead(marks, *u))]
    on = set(todo)
    while todo:
        u = todo.pop()
        for c, p, state in _behind(marks, *u):
            w = (p, state)
            if w not in on and w in ahead and ahead[w] + c == ahead[u]:
                on.add(w)
                todo.append(w)
    audit, i, q, d = [], 0, entry, 0
    while not (d == best and i == n and (i, q) in back and back[i, q] == 0):
        letter, c, i, q = min(e for e in _ahead(marks, i, q) if d + e[1] + back.get(e[2:], best + 1) == best
                              or (e[2:] in on and ahead[e[2:]] == d + e[1]))
        audit.append(letter)
        d += c
    return best, "".join(audit), q


def edited(audit: str, entry: int, turns: list[tuple[str, str] | None]) -> Iterator[tuple[str, str, str]]:
    """(initial, role, text) of the turns that the edits of one block leave."""
    q, i = entry, 0
    for letter in audit:
        if letter == "I":
            q = SPEAKS[q]
            yield letter, ROLE[q], ""
            continue
        turn, i = turns[i], i + 1
        if letter == "R":
            q = SPEAKS[q]
            yield letter, ROLE[q], turn[1]
        elif letter == "K":
            q = KEPT[turn[0][0], q]
            yield letter, turn[0], turn[1]


# ------------------------------------------------------------------ blocks

_OPTION = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "n_turns")
_BLOCK = [("part", pa.int64()), ("seq", pa.int64()), ("turns", pa.list_(_TURN)), ("options", pa.list_(_OPTION)),
          *[(c, pa.int64()) for c in _COUNTS], ("first_turn", pa.int64()), ("last_turn", pa.int64()),
          ("first_role", pa.string()), ("last_role", pa.string())]
_OPTION_SQL = "array<struct<entry:int,exit:int,cost:bigint,audit:string>>"
_BLOCK_SQL = ("part long, seq long, turns array<struct<role:string,text:string>>, options " + _OPTION_SQL
              + "".join(f", {c} long" for c in _COUNTS) + ", first_turn long, last_turn long, first_role string, last_role string")
LEGAL = ("su", "ua", "au")


class _Block:
    """Turns of one conversation that follow each other, with what is counted in them."""

    def __init__(self, begins: bool):
        self.begins, self.marks, self.turns, self.bytes = begins, [], [], 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.turn = [None, None]
        self.role = [None, None]

    def add(self, row: dict, again: bool) -> None:
        role, text, fault = row["role"], row["text"], row["fault"]
        if fault != "blank" and (again or row["seen"]):
            fault = "duplicate"
        if fault:
            self.counts[fault] += 1
        if fault in ("blank", "duplicate"):
            self.marks.append("x")
            self.turns.append(None)
        else:
            kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
            self.marks.append(kind.upper() if fault else kind)
            self.turns.append({"role": role, "text": text})
            self.bytes += len(text)
        if self.role[0] is None:
            self.role[0] = role[:1]
        else:
            self.counts["illegal"] += self.role[1] + role[:1] not in LEGAL
        self.role[1] = role[:1]
        turn = row["turn"]
        if turn is not None:
            self.counts["n_turns"] += turn != self.turn[1]
            self.turn = [turn if self.turn[0] is None else self.turn[0], turn]

    def full(self) -> bool:
        return len(self.marks) >= BLOCK_ROWS or self.bytes >= BLOCK_BYTES

    def row(self, conv, place: tuple[int, int], ends: bool) -> dict:
        marks, options = "".join(self.marks), []
        for entry in (0,) if self.begins else STATES:
            for exits in (ENDS,) if ends else [(q,) for q in STATES]:
                found = least_edits(marks, entry, exits)
                if found:
                    options.append({"entry": entry, "exit": found[2], "cost": found[0], "audit": found[1]})
        return {"conv_id": conv, "part": place[0], "seq": place[1], "turns": self.turns, "options": options, **self.counts,
                "first_turn": self.turn[0], "last_turn": self.turn[1],
                "first_role": self.role[0], "last_role": self.role[1]}


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _blocks(kind: pa.DataType):
    schema = pa.schema([("conv_id", kind), *_BLOCK])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        first = True  # the first conversation of a task may have begun in the task before
        for conv, rows in groupby(_rows(batches), lambda r: r["conv_id"]):
            block, last = _Block(begins=not first), None
            for row in rows:
                if block.full():
                    yield pa.RecordBatch.from_pylist([block.row(conv, (part, seq), False)], schema)
                    block, seq = _Block(False), seq + 1
                now = (row["turn"], row["role"], row["text"])
                block.add(row, now == last)
                last = now
            held = (conv, block)
            if not first:
                yield pa.RecordBatch.from_pylist([pending[1].row(pending[0], (part, seq), True)], schema)
                seq += 1
            pending, first = held, False
        if not first:  # and the last one may go on in the task behind
            yield pa.RecordBatch.from_pylist([pending[1].row(pending[0], (part, seq), False)], schema)

    return run


def _marked(turns: DataFrame) -> DataFrame:
    """Turns with their own fault (null, blank or truncated) and whether the same role
    and text was said at an earlier turn."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    tail = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(tail == "", "blank").when(~F.substring(tail, -1, 1).isin(".", "!", "?"), "truncated")
    rows = rows.select("*", fault.alias("fault"), F.sha2(F.concat("role", F.lit("\0"), "text").cast("binary"), 256).alias("print"))
    said = (rows.where("fault is null or fault != 'blank'").groupBy("conv_id", "print")
            .agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.max(F.col("turn").isNull()).alias("lost")))
    said = said.where((F.col("low") != F.col("high")) | (F.col("lost") & F.col("low").isNotNull())).select(
        F.col("conv_id").alias("c"), F.col("print").alias("p"), "low", "lost")
    seen = F.when(F.col("lost"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("low"))
    return rows.join(said, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("print") == F.col("p")), "left").select(
        "conv_id", "turn", "role", "text", "fault", F.coalesce(seen, F.lit(False)).alias("seen"))


def conversation_blocks(turns: DataFrame) -> DataFrame:
    """The turns cut into blocks with each block's cheapest edits, in order of (part, seq)."""
    small_batches(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType
    order = ("conv_id", "turn", "role")
    ranges = _marked(turns).repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    return stored(ranges.mapInArrow(_blocks(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {_BLOCK_SQL}"),
                  "turn-blocks")


# ------------------------------------------------------------------ choice over blocks

_CHOICE = [("part", pa.int64()), ("seq", pa.int64()), ("entry", pa.int32()), ("piece", pa.string()), ("opens", pa.bool_()),
           ("cost", pa.int64()), ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS[:4]]]
_CHOICE_SQL = ("part long, seq long, entry int, piece string, opens boolean, cost long, gaps long"
               + "".join(f", {c} long" for c in _COUNTS[:4]))


def _letters(way) -> Iterator[str]:
    while way:
        yield from way[0]["audit"]
        way = way[1]


def _less(a, b) -> bool:
    """Whether the audit of way ``a`` precedes that of ``b`` (neither begins the other)."""
    return next(((x < y) for x, y in zip(_letters(a), _letters(b)) if x != y), False)


def choose(blocks: list[dict]) -> list[dict]:
    """One option per block: the cheapest edits of the conversation, least audit first."""
    after = {q: (0, None) for q in ENDS}
    for block in reversed(blocks):
        here = {}
        for option in block["options"]:
            if option["exit"] in after:
                cost, rest = after[option["exit"]]
                cost, way, old = cost + option["cost"], (option, rest), here.get(option["entry"])
                if old is None or cost < old[0] or (cost == old[0] and _less(way, old[1])):
                    here[option["entry"]] = (cost, way)
        after = here
    way, chosen = after[0][1], []
    while way:
        chosen.append(way[0])
        way = way[1]
    return chosen


def _choices(kind: pa.DataType):
    schema = pa.schema([("conv_id", kind), *_CHOICE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, group in groupby(_rows(batches), lambda r: r["conv_id"]):
            blocks = list(group)
            total = {c: sum(b[c] for b in blocks) for c in _COUNTS}
            turn, low = None, None
            for a, b in zip([None, *blocks], blocks):
                if a:
                    total["illegal"] += a["last_role"] + b["first_role"] not in LEGAL
                if b["first_turn"] is not None:
                    total["n_turns"] -= b["first_turn"] == turn
                    low, turn = b["first_turn"] if low is None else low, b["last_turn"]
            total["gaps"] = 0 if low is None else turn - low + 1 - total.pop("n_turns")
            total.pop("n_turns", None)
            picks = choose(blocks)
            total["cost"] = sum(p["cost"] for p in picks)
            out = [{"conv_id": conv, "part": b["part"], "seq": b["seq"], "entry": p["entry"], "piece": p["audit"],
                    "opens": k == 0, **(total if k == 0 else {})} for k, (b, p) in enumerate(zip(blocks, picks))]
            for k in range(0, len(out), 256):
                yield pa.RecordBatch.from_pylist(out[k:k + 256], schema)

    return run


def _decided(turns: DataFrame) -> DataFrame:
    """Blocks, each after the row with its edits, whole conversations in order per task."""
    blocks = conversation_blocks(turns)
    kind = blocks.schema["conv_id"].dataType
    order = ("conv_id", "part", "seq")
    narrow = blocks.drop("turns").repartition("conv_id").sortWithinPartitions(*order)
    picks = narrow.mapInArrow(_choices(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {_CHOICE_SQL}")
    both = picks.unionByName(blocks.select(*order, "turns"), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*order, F.col("turns").isNotNull())


def _edited_blocks(rows: Iterable[dict]) -> Iterator[tuple[dict, Iterator[tuple[str, str, str]]]]:
    pick = None
    for row in rows:
        if row["turns"] is None:
            pick = row
        else:
            turns = [t and (t["role"], t["text"]) for t in row["turns"]]
            yield pick, edited(pick["piece"], pick["entry"], turns)


_REPORT = ("gaps", *_COUNTS[:4], "cost")


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): gaps in the turn
    numbers, faults, adjacent roles out of order, least cost, audit, and the SHA-256 of
    the repaired ``role:text`` lines."""
    decided = _decided(turns)
    kind = decided.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *[(c, pa.int64()) for c in _REPORT],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, group in groupby(_rows(batches), lambda r: r["conv_id"]):
            digest, gap, audit, total = hashlib.sha256(), b"", [], None
            for pick, rows in _edited_blocks(group):
                total = total or pick
                audit.append(pick["piece"])
                for _, role, text in rows:
                    digest.update(gap + f"{role}:{text}".encode())
                    gap = b"\n"
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, **{c: total[c] for c in _REPORT}, "audit": "".join(audit),
                                               "repaired_sha256": digest.hexdigest()}], schema)

    return decided.mapInArrow(run, f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in _REPORT)
                              + ", audit string, repaired_sha256 string")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, turn (numbered from 0), edit (K, R or I), role, text."""
    decided = _decided(turns)
    kind = decided.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("turn", pa.int64()), ("edit", pa.string()),
                        ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, group in groupby(_rows(batches), lambda r: r["conv_id"]):
            n = 0
            for _, rows in _edited_blocks(group):
                out = [(conv, n + k, *row) for k, row in enumerate(rows)]
                n += len(out)
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    return decided.mapInArrow(run, f"conv_id {kind.simpleString()}, turn long, edit string, role string, text string")


# ------------------------------------------------------------------ damage, for trials

def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20``: 0 drops, 1 empties, 2 removes ``.!?``,
    3 repeats, 4 sets role user (null: one space)."""
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), code.alias("code"))
    text = (F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return (rows.where("code != 0")
            .withColumn("copy", F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text")))
