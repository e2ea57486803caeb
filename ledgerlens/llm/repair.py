"""Repair of conversation structure (operator 11).

The edits of a conversation are paths through a lattice of (row, state of the
pattern ``(s?(ua)+)?``).  A bidirectional Dijkstra search finds the cheapest:
a forward and a reverse heap grow until their costs together exceed the best
meeting, every crossing of that cost is finished, and the least concatenated
audit among them is taken.  Conversations are searched in stretches, whose
cheapest paths between any two states are then joined in order.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize, pick

#: Rows of a stretch, and the text bytes after which it ends early.
STRETCH_ROWS, STRETCH_BYTES = 128, 4 << 20
# Costs of the edits; Keep is free.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The state after a turn whose role has this initial.
MOVES = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The state that a user or assistant turn leads to, the one turn that fits.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = (NOTHING, ASSISTANT)
SPACE = " \t\n\v\f\r"
FAULTS = ("blank", "duplicate", "truncated")

Node = tuple[int, int]
Row = tuple[str, int]  # initial of the role, 0 or 1 + index in FAULTS


def _edits_from(rows: list[Row], node: Node) -> Iterator[tuple[str, int, Node]]:
    """(edit, cost, node it leads to) of the edits at a node."""
    i, q = node
    yield "I", INSERT, (i, NEXT[q])
    if i == len(rows):
        return
    initial, fault = rows[i]
    yield "D", DELETE, (i + 1, q)
    if fault in (0, 3):
        late = TRUNCATED if fault == 3 else 0
        to = MOVES.get(initial, {}).get(q)
        if to is not None:
            yield "K", late, (i + 1, to)
        yield "R", REROLE + late, (i + 1, NEXT[q])


def _edits_to(rows: list[Row], node: Node) -> Iterator[tuple[str, int, Node]]:
    """(edit, cost, node it comes from) of the edits that lead to a node."""
    i, q = node
    for before in range(4):
        if NEXT[before] == q:
            yield "I", INSERT, (i, before)
    if i == 0:
        return
    initial, fault = rows[i - 1]
    yield "D", DELETE, (i - 1, q)
    if fault in (0, 3):
        late = TRUNCATED if fault == 3 else 0
        for before in range(4):
            if MOVES.get(initial, {}).get(before) == q:
                yield "K", late, (i - 1, before)
            if NEXT[before] == q:
                yield "R", REROLE + late, (i - 1, before)


class _Side:
    """One of the two searches: tentative and finished (cost, audit) of nodes.

    Nodes leave the heap by cost, then by rows passed: an edit that costs
    nothing passes a row, so a node's audit is the least of its cost by then.
    Audits of equal cost between the same two nodes are never prefixes of one
    another, as the rest would be Inserts; so the lesser stays the lesser
    whatever is added to either end.
    """

    def __init__(self, starts: list[Node], origin: int, forward: bool) -> None:
        self.origin, self.forward = origin, forward
        self.open = {n: (0, "") for n in starts}
        self.done: dict[Node, tuple[int, str]] = {}
        self.heap = [(0, abs(n[0] - origin), n) for n in starts]
        heapq.heapify(self.heap)

    def top(self) -> float:
        while self.heap and self.heap[0][2] in self.done:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def step(self, rows: list[Row]) -> Node:
        """Finish the nearest node and try the edits from it."""
        cost, _, node = heapq.heappop(self.heap)
        _, audit = self.done[node] = self.open[node]
        for edit, more, other in (_edits_from if self.forward else _edits_to)(rows, node):
            new = (cost + more, audit + edit if self.forward else edit + audit)
            old = self.open.get(other)
            if other not in self.done and (old is None or new < old):
                self.open[other] = new
                if old is None or new[0] < old[0]:
                    heapq.heappush(self.heap, (new[0], abs(other[0] - self.origin), other))
        return node


def search(rows: list[Row], start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, least audit) of the cheapest edits of ``rows`` from state ``start`` to one of ``ends``; None if there are none."""
    ahead = _Side([(0, start)], 0, True)
    back = _Side([(len(rows), q) for q in ends], len(rows), False)
    best = float("inf")
    while ahead.top() + back.top() <= best and min(ahead.top(), back.top()) < float("inf"):
        side, other = (ahead, back) if ahead.top() <= back.top() else (back, ahead)
        node = side.step(rows)
        cost = side.done[node][0]
        if node in other.done:
            best = min(best, cost + other.done[node][0])
        for _, more, to in (_edits_from if side.forward else _edits_to)(rows, node):
            if to in other.done:
                best = min(best, cost + more + other.done[to][0])
    found = []
    for node, (cost, audit) in ahead.done.items():
        if node in back.done and cost + back.done[node][0] == best:
            found.append(audit + back.done[node][1])
        for edit, more, to in _edits_from(rows, node):
            if to in back.done and cost + more + back.done[to][0] == best:
                found.append(audit + edit + back.done[to][1])
    return (best, min(found)) if found else None


def apply(audit: str, state: int, rows: list[tuple[str, str]]) -> tuple[list[str], int]:
    """``role:text`` of the turns that the edits leave of ``rows`` (role, text), and the state reached."""
    out, at = [], 0
    for edit in audit:
        if edit == "K":
            role, text = rows[at]
            state = MOVES[role[:1]][state]
            out.append(f"{role}:{text}")
        elif edit != "D":
            state = NEXT[state]
            out.append(f"{NAMES[state]}:{rows[at][1] if edit == 'R' else ''}")
        at += edit != "I"
    return out, state


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``[.!?]`` from it, 3
    repeats the row, 4 sets role user.  A null role or text, and a null id or
    turn in the checked string, is one space.
    """
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    d = pick(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), known("role").alias("role"), known("text").alias("text"), kind.alias("k"))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return d.filter("k <> 0").select(
        "conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _fault(text: str, repeated: bool) -> int:
    body = text.rstrip(SPACE)
    return 1 if not body else 2 if repeated else 3 if body[-1] not in ".!?" else 0


_KEY = "part int, at long"
_TABLE = "array<struct<start:int,end:int,cost:long,audit:string>>"
_STRETCH = (f"conv_id {{kind}}, {_KEY}, first string, last string, low long, high long, n_turns long, blank long, duplicate long, "
            f"truncated long, illegal long, roles array<string>, texts array<string>, paths {_TABLE}")


def _illegal(a: str, b: str) -> bool:
    return a[:1] + b[:1] not in ("su", "ua", "au")


class _Stretch:
    """Consecutive rows of one conversation."""

    def __init__(self, conv_id: object, opens: bool, limit: int) -> None:
        self.conv_id, self.opens, self.limit = conv_id, opens, limit  # opens: certainly the conversation's first rows
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        self.rows.append((turn, role, text, _fault(text, repeated)))
        self.size += len(text)

    def full(self) -> bool:
        return len(self.rows) >= self.limit or self.size >= STRETCH_BYTES

    def line(self, part: int, at: int, closes: bool) -> dict:
        roles = [r[1] for r in self.rows]
        turns = sorted({r[0] for r in self.rows if r[0] is not None})
        faults = [r[3] for r in self.rows]
        rows = [(role[:1], fault) for role, fault in zip(roles, faults)]
        paths = []
        for q in [NOTHING] if self.opens else range(4):
            # a whole conversation ends in a state that the pattern allows; otherwise every state may be the way on
            for ends in [ENDS] if closes else [(e,) for e in range(4)]:
                if found := search(rows, q, ends):
                    paths.append({"start": q, "end": apply(found[1], q, [(r[1], "") for r in self.rows])[1],
                                  "cost": found[0], "audit": found[1]})
        return {"conv_id": self.conv_id, "part": part, "at": at, "first": roles[0], "last": roles[-1],
                "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "n_turns": len(turns),
                **{name: faults.count(i + 1) for i, name in enumerate(FAULTS)},
                "illegal": sum(map(_illegal, roles, roles[1:])), "roles": roles, "texts": [r[2] for r in self.rows], "paths": paths}


def stretches(rows: DataFrame, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Stretches of damaged ``rows``, each with the cheapest paths between the states at its ends.

    Rows are dealt by ranges of (conv_id, turn, role, text), so a conversation
    of very many rows is spread over tasks like any others; a stretch ends
    with its conversation, its task or ``stretch_rows`` rows.  (part, at) orders
    the stretches of a conversation.  Paths are told from all states except
    where the stretch is known to begin or end its conversation.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = _STRETCH.format(kind=kind)
    own = F.monotonically_increasing_id()  # tells equal rows apart
    d = materialize(rows.withColumn("own", own).withColumn("key", F.sha2(F.to_json(F.struct("role", "text")), 256)), "damaged")
    seen = d.groupBy("conv_id", "key").agg(F.count("*").alias("n"), F.min(F.struct("turn", "own")).alias("first")).filter("n > 1")
    seen = seen.select(F.col("conv_id").alias("_conv"), F.col("key").alias("_key"), "first")
    d = d.join(seen, F.expr("conv_id <=> _conv AND key = _key"), "left")
    repeated = F.coalesce(F.struct("turn", "own") > F.col("first"), F.lit(False))
    order = ["conv_id", "turn", "role", "text", "own"]
    d = d.select("conv_id", "turn", "role", "text", "own", repeated.alias("repeated")).repartitionByRange(*order)
    d = d.sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "repeated")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, now, lines, size = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            for conv_id, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if now is not None and (conv_id != now.conv_id or now.full()):
                    same = conv_id == now.conv_id
                    lines.append(now.line(part, at, not same))
                    size, at = size + now.size, at + 1
                    now = _Stretch(conv_id, not same, stretch_rows)
                    if len(lines) >= 1000 or size >= STRETCH_BYTES:
                        yield pa.RecordBatch.from_pylist(lines, arrow)
                        lines, size = [], 0
                elif now is None:
                    now = _Stretch(conv_id, False, stretch_rows)
                now.add(*row)
        if now is not None:
            lines.append(now.line(part, at, False))
        if lines:
            yield pa.RecordBatch.from_pylist(lines, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)
    return d.mapInArrow(run, schema)


def _joined(parts: list[dict]) -> tuple[int, str, list[int]]:
    """(cost, audit, path of every stretch) of the cheapest way through the stretches of a conversation."""
    # from the last stretch backwards: by state before it, the best (cost, audit, choices)
    best: dict[int, tuple[int, str, tuple]] = {q: (0, "", ()) for q in ENDS}
    for part in reversed(parts):
        new: dict[int, tuple[int, str, tuple]] = {}
        for i, path in enumerate(part["paths"]):
            rest = best.get(path["end"])
            if rest is not None:
                whole = (path["cost"] + rest[0], path["audit"] + rest[1])
                if path["start"] not in new or whole < new[path["start"]][:2]:
                    new[path["start"]] = (*whole, (i, rest[2]))
        best = new
    cost, audit, chain = best[NOTHING]
    choices = []
    while chain:
        choices.append(chain[0])
        chain = chain[1]
    return cost, audit, choices


def repair_conversations(rows: DataFrame, stretch_rows: int = STRETCH_ROWS) -> tuple[DataFrame, DataFrame]:
    """(told, repaired) of ``rows`` (conv_id, turn, role, text; no nulls in the last two).

    told: a row per conversation: gaps, blank, duplicate, truncated, illegal,
    cost and audit.  repaired: its turns after the edits, as rows (conv_id,
    part, at, lines), a row per stretch in the order of (part, at); lines are
    ``role:text``.

    Rows go by turn (nulls first), then role and text.  A row is blank without
    a character other than white space, else a duplicate if an earlier row of
    its conversation has its role and text, else truncated if its last such
    character is not one of ``.!?``.  A role is judged by its first character;
    one that is empty or begins otherwise cannot be kept.  Rows with a null id
    are one conversation.  Repeated rows are duplicates; an empty table gives
    empty results.
    """
    schema = rows.schema["conv_id"].dataType.simpleString()
    s = materialize(stretches(rows, stretch_rows), "stretches")
    facts = F.struct("part", "at", "first", "last", "low", "high", "n_turns", "blank", "duplicate", "truncated", "illegal", "paths")
    whole = s.groupBy("conv_id").agg(F.sort_array(F.collect_list(facts)).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv_id, parts in zip(*[c.to_pylist() for c in batch.columns]):
                cost, audit, choices = _joined(parts)
                turns = sum(p["n_turns"] for p in parts)
                known = [p for p in parts if p["low"] is not None]
                turns -= sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
                gaps = known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0
                illegal = sum(p["illegal"] for p in parts) + sum(_illegal(a["last"], b["first"]) for a, b in zip(parts, parts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv_id], batch.column(0).type), *[pa.array([x], pa.int64()) for x in (
                        gaps, *(sum(p[f] for p in parts) for f in FAULTS), illegal, cost)], pa.array([audit], pa.string()),
                     pa.array([choices], pa.list_(pa.int32()))],
                    ["conv_id", "gaps", *FAULTS, "illegal", "cost", "audit", "choices"])

    told = materialize(whole.mapInArrow(run, f"conv_id {schema}, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                             "cost long, audit string, choices array<int>"), "told")
    chosen = whole.select("conv_id", F.transform("parts", lambda p: F.struct(p["part"], p["at"])).alias("keys"))
    chosen = told.select(F.col("conv_id").alias("_conv"), "choices").join(chosen, F.expr("conv_id <=> _conv"))
    chosen = chosen.select(F.explode(F.arrays_zip("keys", "choices")).alias("x")).select(
        F.col("x.keys.part").alias("_part"), F.col("x.keys.at").alias("_at"), F.col("x.choices").alias("choice"))
    picked = s.join(chosen, F.expr("part = _part AND at = _at")).select(
        "conv_id", "part", "at", "roles", "texts", F.get("paths", F.col("choice")).alias("path"))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [apply(path["audit"], path["start"], list(zip(roles, texts)))[0]
                     for roles, texts, path in zip(*[batch.column(c).to_pylist() for c in ("roles", "texts", "path")])]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "part", "at")], pa.array(lines, pa.list_(pa.string()))],
                                             ["conv_id", "part", "at", "lines"])

    return told.drop("choices"), picked.mapInArrow(edit, f"conv_id {schema}, {_KEY}, lines array<string>")


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the newline-joined lines, hashed while they stream by in order."""
    schema = repaired.schema["conv_id"].dataType.simpleString()
    d = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, begun, some = None, None, False, False
        for batch in batches:
            ids, hashes = [], []
            for conv_id, lines in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if not some or conv_id != now:
                    if some:
                        ids.append(now)
                        hashes.append(digest.hexdigest())
                    now, digest, begun, some = conv_id, hashlib.sha256(), False, True
                if lines:
                    digest.update((("\n" if begun else "") + "\n".join(lines)).encode())
                    begun = True
            kind = batch.column(0).type
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(hashes, pa.string())], ["conv_id", "repaired_sha256"])
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()], pa.string())],
                                             ["conv_id", "repaired_sha256"])

    return d.mapInArrow(run, f"conv_id {schema}, repaired_sha256 string")


def repair_report(conversations: DataFrame, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """One row per conv_id of ``conversations``, damaged and repaired; ids without rows after the damage have zeros."""
    told, repaired = repair_conversations(damage(conversations), stretch_rows)
    digests = repaired_digests(repaired).withColumnRenamed("conv_id", "_digest_id")
    told = told.withColumnRenamed("conv_id", "_told_id")
    ids = pick(conversations, "conv_id").distinct()
    d = ids.join(told, F.expr("conv_id <=> _told_id"), "left").join(digests, F.expr("conv_id <=> _digest_id"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return d.select("conv_id", *[zero(c) for c in ("gaps", *FAULTS, "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
