"""Repair of conversations by weighted finite-state composition.

Three machines: the input acceptor, a chain of a conversation's rows; the edit transducer, which keeps, reroles or deletes a row and
inserts rows without text, at a cost; the grammar, an acceptor of role initials. Their composition is built lazily: a state is a
place in the chain and a state of the grammar, and what leaves it depends on the row's symbol alone (its initial and its fault). Places
in rising order are a topological order, and weights are (cost, edit string), compared in that order. Shortest paths are found from
the end backwards: there an edit is put before what follows it, which keeps the order of strings; forwards, a string that begins
another would spoil it.

Of the weights to the right of a place only differences in cost and the order of the strings matter, so there are finitely many such
vectors. ``Machine`` lists those that occur, with the vector and the choices that each symbol leads to. A stretch of rows is then a
map from vectors to vectors and from grammar states to grammar states, and maps compose: a conversation is split over as many tasks
as its rows need. Rows are range-partitioned by conversation and turn and numbered; chunks report the maps of the conversations that may
go on beyond them, at most two per chunk, whose composition tells each chunk what lies to its right and left.

Equal rows are one numbered row with a count; all but the first are duplicates. Texts take no part in this: they are shuffled once,
by range, to meet their rows' edits.

Order: by turn (null first), then role, then a digest of the text; equal rows are adjacent. Defined cases: null conversation ids are one
conversation; a null role or text counts as one space; roles that begin with another letter than s, u, a (or with none) can only be
reroled or deleted; rows that repeat role and text are duplicates, whatever their turn; an empty table gives no rows; very long
conversations and texts are streamed; columns besides the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written

#: The grammar of role initials, (s?(ua)+)?, and the states where it may end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
GRAMMAR = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
FINAL = {START, AFTER_A}
#: Roles that rows are given, by initial.
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
#: Faults, and the initials that a symbol tells apart: symbol = 3 * place of the initial + whether the row is sound, must go or is truncated.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = ("", "blank", "duplicate", "truncated")
INITIALS = "sua"
#: Rows that one task walks at a time.
CHUNK = 1 << 16
WHITE = " \t\n\x0b\x0c\r"

PLACED = "conv_id long, has_turn boolean, turn long, role string, digest binary, copies long, fault int, part long, at long, chunk long"
EDITS = "conv_id long, has_turn boolean, turn long, role string, digest binary, place long, fault int, before string, edit string, new_role string, after string, copies long"
EDITED = "conv_id long, place long, step long, edit string, fault string, cost long, turn long, old_role string, role string, text string"


def symbol(role: str, fault: int) -> int:
    initial = INITIALS.find(role[:1]) if role else -1
    return 3 * (initial if initial >= 0 else 3) + (0 if fault == SOUND else 2 if fault == TRUNCATED else 1)


def edits_of(sym: int) -> list[tuple[str, str, int]]:
    """The edit transducer's arcs for a symbol: (edit, output initial, cost)."""
    initial, state = (*INITIALS, "")[sym // 3], sym % 3
    out = [("D", "", DELETE)]
    if state != 1:
        extra = UNFINISHED if state == 2 else 0
        out += [("K", initial, KEEP + extra)] * bool(initial) + [("R", i, REROLE + extra) for i in ROLES]
    return out


def insertions(g: int) -> Iterator[tuple[str, int]]:
    """(inserted initials, state reached) from a state of the grammar, without coming back to one."""
    seen, done = [g], ""
    yield done, g
    while True:
        i, g = next((i, s) for i, s in GRAMMAR[g].items() if i in ROLES)
        if g in seen:
            return
        seen.append(g)
        done += i
        yield done, g


class Machine:
    """The vectors that occur, numbered (0: at the end), and for each vector to the right, symbol and grammar state the best choice.

    left[v][sym]: the vector to the row's left. choice[v][sym][g]: (initials inserted before the row, edit, output initial, state after it).
    end[g]: initials inserted after the last row.
    """

    def __init__(self) -> None:
        best = [min((len(ins) * INSERT, "I" * len(ins), ins) for ins, s in insertions(g) if s in FINAL) for g in GRAMMAR]
        self.end = [ins for _, _, ins in best]
        vectors = [self._vector([(cost, key) for cost, key, _ in best])]
        number = {vectors[0]: 0}
        self.left, self.choice = [], []
        for v in vectors:  # grows while it is walked
            lefts, choices = [], []
            for sym in range(12):
                row = [self._best(v, sym, g) for g in GRAMMAR]
                new = self._vector([r[:2] for r in row])
                if new not in number:
                    number[new] = len(vectors)
                    vectors.append(new)
                lefts.append(number[new])
                choices.append([r[2:] for r in row])
            self.left.append(lefts)
            self.choice.append(choices)

    @staticmethod
    def _vector(weights: list[tuple]) -> tuple:
        """Costs above the least, and the strings' order."""
        least, keys = min(c for c, _ in weights), sorted({k for _, k in weights})
        return tuple((c - least, keys.index(k)) for c, k in weights)

    @staticmethod
    def _best(v: tuple, sym: int, g: int) -> tuple:
        """(cost, string's key, inserted initials, edit, output initial, next state) of the best way on from g."""
        ways = []
        for ins, state in insertions(g):
            for edit, out, cost in edits_of(sym):
                after = GRAMMAR[state].get(out) if out else state
                if after is not None:
                    # Keys compare as the strings do: what follows the inserts is no insert, so no key begins another.
                    ways.append((len(ins) * INSERT + cost + v[after][0], ("I" * len(ins) + edit, v[after][1]), ins, edit, out, after))
        return min(ways)


@lru_cache(1)
def machine() -> Machine:
    return Machine()


def maps(symbols: list[int], m: Machine) -> tuple[bytes, bytes]:
    """What a stretch of rows does: for each vector to its right that to its left, and the grammar state after it for each before it."""
    left, after = np.array(m.left), np.array([[[c[3] for c in row] for row in rows] for rows in m.choice])
    v, state = np.arange(len(left)), np.tile(np.arange(4), (len(left), 1))
    for sym in reversed(symbols):
        state = np.take_along_axis(state, after[v, sym], 1)
        v = left[v, sym]
    return v.astype(np.uint32).tobytes(), state.astype(np.uint8).tobytes()


def walked(symbols: list[int], m: Machine, right: int = 0, g: int = START) -> list[tuple]:
    """The choice for each row of a stretch, given the vector to its right and the grammar state to its left."""
    vectors = [right]
    for sym in reversed(symbols):
        vectors.append(m.left[vectors[-1]][sym])
    vectors.pop()
    out = []
    for sym, v in zip(symbols, reversed(vectors), strict=True):
        out.append(m.choice[v][sym][g])
        g = out[-1][3]
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of "conv_id:turn" modulo 20: 0 drops, 1 empties, 2 removes ends of sentences, 3 repeats, 4 makes it the user's; null roles and texts are a space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


KEY = ("conv_id", "has_turn", "turn", "role", "digest")


def _rows(rows: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    found = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    return found.select("conv_id", F.col("turn").isNotNull().alias("has_turn"), "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")


def _fault(text: Column) -> Column:
    """Of a row by itself."""
    solid = F.rtrim(text, F.lit(WHITE))
    return F.when(solid == "", BLANK).when(F.substring(solid, -1, 1).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)


def _placed(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number, the fault of the first of them, and their place: partition, number in it, chunk."""
    thin = written(rows.groupBy(*KEY, _fault(F.col("text")).alias("fault")).agg(F.count("*").alias("copies")), "talk-rows")
    # The same role and text at several turns: those after the first turn are duplicates.
    when = F.struct("has_turn", "turn")
    again = thin.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest")).agg(F.min(when).alias("first"), F.max(when).alias("last")).where("first < last").drop("last")
    found = thin.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")), "left")
    fault = F.when((F.col("fault") != BLANK) & F.coalesce(when > F.col("first"), F.lit(False)), DUPLICATE).otherwise(F.col("fault"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = len(batch)
            places = np.arange(at, at + n)
            at += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part)), pa.array(places), pa.array(places // CHUNK)], [*batch.schema.names, "part", "at", "chunk"])

    ordered = found.select(*KEY, "copies", fault.alias("fault")).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    return written(ordered.mapInArrow(number, PLACED), "talk-placed")


def _runs(t: pa.Table) -> Iterator[tuple[int | None, int, int]]:
    """(conversation, first row, end) of the conversations in a sorted chunk."""
    ids = t.column("conv_id").to_pylist()
    start = 0
    for k in range(1, len(ids) + 1):
        if k == len(ids) or ids[k] != ids[start]:
            yield ids[start], start, k
            start = k


def _symbols(t: pa.Table) -> list[int]:
    return [symbol(r, f) for r, f in zip(t.column("role").to_pylist(), t.column("fault").to_pylist(), strict=True)]


def _open_ends(placed: DataFrame) -> DataFrame:
    """(part, chunk, conv_id, right, g, last) of the first and last conversation of each chunk: what lies to its right, the grammar state to its left, and whether it ends there."""
    def report(t: pa.Table) -> pa.Table:
        t, m = t.sort_by("at"), machine()
        runs, syms = list(_runs(t)), _symbols(t)
        rows = [(c, *maps(syms[a:b], m)) for c, a, b in dict.fromkeys((runs[0], runs[-1]))]
        n = len(rows)
        return pa.table({
            "conv_id": pa.array([r[0] for r in rows], pa.int64()), "part": pa.array([t.column("part")[0].as_py()] * n, pa.int64()), "chunk": pa.array([t.column("chunk")[0].as_py()] * n, pa.int64()),
            "left": pa.array([r[1] for r in rows], pa.binary()), "states": pa.array([r[2] for r in rows], pa.binary())})

    def compose(t: pa.Table) -> pa.Table:
        rows = t.sort_by([("part", "ascending"), ("chunk", "ascending")])
        lefts = [np.frombuffer(b, np.uint32) for b in rows.column("left").to_pylist()]
        states = [np.frombuffer(b, np.uint8).reshape(-1, 4) for b in rows.column("states").to_pylist()]
        right, rights, g, before = 0, [], START, []
        for left in reversed(lefts):
            rights.append(right)
            right = int(left[right])
        rights.reverse()
        for v, s in zip(rights, states, strict=True):
            before.append(g)
            g = int(s[v, g])
        last = [False] * (len(rights) - 1) + [True]
        return pa.table({"part": rows.column("part"), "chunk": rows.column("chunk"), "conv_id": rows.column("conv_id"), "right": pa.array(rights, pa.int64()), "g": pa.array(before, pa.int64()), "last": pa.array(last)})

    found = placed.groupBy("part", "chunk").applyInArrow(report, "conv_id long, part long, chunk long, left binary, states binary")
    return found.groupBy("conv_id").applyInArrow(compose, "part long, chunk long, conv_id long, right long, g long, last boolean")


def edits(rows: DataFrame) -> DataFrame:
    """One row per distinct row: its key, place, fault, edit, the role that it gets, and the initials inserted before and after it."""
    placed = _placed(_rows(rows))

    def walk(t: pa.Table, ends: pa.Table) -> pa.Table:
        t, m = t.sort_by("at"), machine()
        context = {c: (v, g, last) for c, v, g, last in zip(*(ends.column(x).to_pylist() for x in ("conv_id", "right", "g", "last")), strict=True)}
        syms, chosen, after = _symbols(t), [], [""] * len(t)
        for conv, a, b in _runs(t):
            right, g, last = context.get(conv, (0, START, True))
            chosen += walked(syms[a:b], m, right, g)
            if last:
                after[b - 1] = m.end[chosen[-1][3]]
        place = (t.column("part").to_numpy() << 40) | t.column("at").to_numpy()
        roles = [ROLES[out] if edit == "R" else None for _, edit, out, _ in chosen]
        return pa.table({
            **{k: t.column(k) for k in KEY}, "place": pa.array(place), "fault": t.column("fault"), "before": pa.array([c[0] for c in chosen], pa.string()), "edit": pa.array([c[1] for c in chosen], pa.string()),
            "new_role": pa.array(roles, pa.string()), "after": pa.array(after, pa.string()), "copies": t.column("copies")})

    ends = written(_open_ends(placed), "talk-ends")
    return written(placed.groupBy("part", "chunk").cogroup(ends.groupBy("part", "chunk")).applyInArrow(walk, EDITS), "talk-edits")


def edited(rows: DataFrame) -> DataFrame:
    """One row per edit, in the order of (place, step) within a conversation: conv_id, place, step, edit, fault, cost, turn, old_role, role, text.

    What was deleted has no role, what was inserted no turn and no old_role. The rows whose role is not null are the repaired conversations.
    """
    known = edits(rows).select(*KEY, F.lit(None).cast("string").alias("text"), F.struct("place", "fault", "before", "edit", "new_role", "after", "copies").alias("e"))
    texts = _rows(rows).select(*KEY, "text", F.lit(None).cast(known.schema["e"].dataType).alias("e"))
    both = known.union(texts).repartitionByRange(*KEY).sortWithinPartitions(*KEY, F.col("e").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, step, left = None, 0, 0
        for batch in batches:
            out = []

            def add(at: int | None, edit: str, fault: int, turn: int | None, old: str | None, role: str | None) -> None:
                nonlocal step
                cost = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (UNFINISHED if fault == TRUNCATED and edit in "KR" else 0)
                out.append((conv, e["place"], step, edit, FAULTS[fault], cost, turn, old, role, at))
                step += 1

            for at, (conv, turn, old, known) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "e")), strict=True)):
                if known is not None:
                    e, step, left = known, 0, known["copies"]
                    for initial in e["before"]:
                        add(None, "I", SOUND, None, None, ROLES[initial])
                    continue
                if left == e["copies"]:
                    add(at, e["edit"], e["fault"], turn, old, None if e["edit"] == "D" else e["new_role"] or old)
                else:
                    add(at, "D", BLANK if e["fault"] == BLANK else DUPLICATE, turn, old, None)
                left -= 1
                if not left:
                    for initial in e["after"]:
                        add(None, "I", SOUND, None, None, ROLES[initial])
            columns = list(zip(*out, strict=True)) if out else [()] * 10
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            text = batch.column("text").take(pa.array(columns[9], pa.int64())).fill_null("")
            yield pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], text], [c.split()[0] for c in EDITED.split(", ")])

    return both.select("conv_id", "turn", "role", "text", "e").mapInArrow(run, EDITED)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, step (their order), turn, role, text."""
    return edited(rows).where(F.col("role").isNotNull()).select("conv_id", "place", "step", "turn", "role", "text")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDIT = f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"


def audited(edits_made: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per id of ``ids`` (conv_id), of what ``edited`` gave: gaps, faults, illegal pairs, cost, audit, and the digest of the repaired conversation.

    A digest of one message can only be taken in order, so each conversation is streamed through one task, a row at a time.
    """
    legal = {"su", "ua", "au"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        conv, c, low, high, turns, initial, audit, digest, begun = nothing, {}, None, None, 0, None, [], None, False

        def done() -> tuple:
            gaps = high - low + 1 - turns if turns else 0
            return (conv, gaps, *(c[k] for k in COUNTS[1:]), "".join(audit), digest.hexdigest())

        for batch in batches:
            out = []
            for own, edit, fault, cost, turn, old, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "edit", "fault", "cost", "turn", "old_role", "role", "text")), strict=True):
                if conv is nothing or own != conv:
                    if conv is not nothing:
                        out.append(done())
                    conv, c, low, high, turns, initial, audit, digest, begun = own, dict.fromkeys(COUNTS, 0), None, None, 0, None, [], hashlib.sha256(), False
                c["cost"] += cost
                audit.append(edit)
                if edit != "I":
                    if fault:
                        c[fault] += 1
                    if initial is not None and initial + old[:1] not in legal:
                        c["illegal"] += 1
                    initial = old[:1]
                    if turn is not None and turn != high:  # turns rise
                        low, high, turns = turn if low is None else low, turn, turns + 1
                if role is not None:
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
            yield _audits(out)
        if conv is not nothing:
            yield _audits([done()])

    thin = edits_made.select("conv_id", "place", "step", "edit", "fault", "cost", "turn", "old_role", "role", F.when(F.col("role").isNotNull(), F.col("text")).alias("text"))
    found = thin.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step").mapInArrow(run, AUDIT)
    every = ids.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    all_ids = every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    return all_ids.select(F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], *[F.coalesce(c, F.lit(v)).alias(c) for c, v in none.items()])


def _audits(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in AUDIT.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    kinds = [pa.int64()] * (len(names) - 2) + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
