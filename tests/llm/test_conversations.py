"""Repair of conversations against enumeration of edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidewater.llm import common, conversations, queries

SF = "/root/testdata/sf0.001"
KINDS = "conv_id long, turn long, role string, text string, place int, e string"
GOOD = re.compile(r"(s?(ua)+)?")


def damage(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))


def faults(rows: list[tuple]) -> list[str]:
    out, seen = [], set()
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows: list[tuple], found: list[str]) -> tuple[int, str, str]:
    """(cost, audit, repaired), by all ways to edit each row and to insert up to two rows in each gap."""
    gaps = ["", "u", "a", "ua", "au"]
    each = []
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        extra = 5 * (fault == "truncated")
        ways = [(2, "D", "", None)]
        if fault in ("", "truncated"):
            ways += [(extra, "K", role[:1], f"{role}:{text}")] + [(1 + extra, "R", r[0], f"{r}:{text}") for r in ("user", "assistant")]
        each.append(ways)
    inserts = [[(5 * len(g), "I" * len(g), g, "\n".join({"u": "user:", "a": "assistant:"}[i] for i in g) if g else None) for g in gaps]] * (len(rows) + 1)
    layers = [inserts[0]]
    for ways in each:
        layers += [ways, inserts[0]]
    # Partial results by what has been written so far: all audits are kept, only dearer ones with the same initials' end and audit go.
    best: dict[tuple[str, str], tuple[int, str]] = {("", ""): (0, "")}
    for layer in layers:
        new: dict[tuple[str, str], tuple[int, str]] = {}
        for (initials, audit), (cost, text) in best.items():
            for c, label, out, said in layer:
                both = initials + out
                if out is None or not re.fullmatch(r"s?(ua)*u?", both) or (label in "KR" and label and not out):
                    continue
                key = (both, audit + label)
                if key not in new or cost + c < new[key][0]:
                    new[key] = (cost + c, text + ("" if said is None else said + "\0"))
        best = new
    cost, audit, text = min((c, a, t) for (i, a), (c, t) in best.items() if GOOD.fullmatch(i))
    return cost, audit, "\n".join(text.split("\0")[:-1])


def by_dynamic_programme(rows: list[tuple], found: list[str]) -> tuple[int, str, str]:
    """(cost, audit, repaired) for long conversations, from the end, with whole strings."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    names = {"u": "user", "a": "assistant"}

    def closed(at: dict) -> dict:
        for _ in range(4):
            for g in step:
                for i, r in names.items():
                    if i in step[g] and step[g][i] in at:
                        c, a, t = at[step[g][i]]
                        at[g] = min(at.get(g, (10**9, "", ())), (c + 5, "I" + a, (f"{r}:", *t)))
        return at

    at = closed({0: (0, "", ()), 3: (0, "", ())})
    for (_, _, role, text), fault in zip(reversed(rows), reversed(found), strict=True):
        extra, new = 5 * (fault == "truncated"), {}
        for g in step:
            ways = [(at[g][0] + 2, "D" + at[g][1], at[g][2])]
            if fault in ("", "truncated"):
                for cost, label, r in [(0, "K", role), (1, "R", "user"), (1, "R", "assistant")]:
                    if r[:1] in step[g]:
                        c, a, t = at[step[g][r[:1]]]
                        ways.append((c + cost + extra, label + a, (f"{r}:{text}", *t)))
            new[g] = min(ways)
        at = closed(new)
    return at[0][0], at[0][1], "\n".join(at[0][2])


def audit(rows: list[tuple], best) -> dict:
    """What op12 returns, from the conversations."""
    out, kept = {}, {}
    for r in damage(rows):
        kept.setdefault(r[0], []).append(r)
    for conv in {r[0] for r in rows}:
        own = in_order(kept.get(conv, []))
        found = faults(own)
        turns = {t for _, t, _, _ in own if t is not None}
        cost, edits, text = best(own, found) if own else (0, "", "")
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, edits, hashlib.sha256(text.encode()).hexdigest())
    return out


def asked(df) -> dict:
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def run(spark, rows: list[tuple], parts: int = 3) -> dict:
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], KINDS).repartition(parts)
    return asked(conversations.audited(conversations.edited(conversations.damaged(df)), df))


def invented(seed: int, longest: int, convs: int) -> list[tuple]:
    r, out = random.Random(seed), []
    for conv in range(convs):
        for turn in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant"]) if r.random() < 0.3 else ["user", "assistant"][turn % 2]
            role = r.choice(["system", "tool", "", None, "agent", "System"]) if r.random() < 0.15 else role
            text = r.choice(["Yes.", "No", "  ", "Why?\n", "So be it! ", "é", None, f"word {r.randrange(9)}."])
            out.append((conv, None if r.random() < 0.05 else turn + r.randrange(2), role, text))
    return out


def test_the_machine_is_finite_and_rows_that_go_change_nothing():
    m = conversations.Machine()
    assert len(m.left) < 200
    for v in range(len(m.left)):
        for s in (1, 4, 7, 10):
            assert m.left[v][s] == v and all(m.choice[v][s][g] == ("", "D", "", g) for g in range(4))


def test_choices_are_the_cheapest():
    """All conversations of up to three rows, over all symbols."""
    m, texts = conversations.machine(), {0: "Yes.", 1: " ", 2: "No"}
    for n in range(4):
        for syms in itertools.product(range(12), repeat=n):
            if n == 3 and hash(syms) % 4:
                continue
            rows = [(1, k, ["system", "user", "assistant", "tool"][s // 3], texts[s % 3] if s % 3 == 1 else f"{k}{texts[s % 3]}") for k, s in enumerate(syms)]
            chosen = conversations.walked(list(syms), m)
            edits = "".join("I" * len(c[0]) + c[1] for c in chosen) + "I" * len(m.end[chosen[-1][3] if chosen else 0])
            want = cheapest(rows, faults(rows))
            assert edits == want[1]
            assert want == by_dynamic_programme(rows, faults(rows))


@pytest.mark.parametrize("chunk", [1, 3, conversations.CHUNK])
def test_invented_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK", chunk)
    rows = invented(1, 12, 60)
    assert run(spark, rows) == audit(rows, by_dynamic_programme)


def test_a_conversation_with_most_rows_is_split(spark, monkeypatch):
    """One conversation lies in many chunks and partitions; its edits are those of the whole."""
    monkeypatch.setattr(conversations, "CHUNK", 50)
    r = random.Random(5)
    rows = [(7, t, r.choice(["user", "assistant", "assistant", "system"]), f"{t}{r.choice('.?, ')}") for t in range(3000)] + invented(2, 5, 20)
    rows += [(7, 1500, "user", "Again.")] * 400
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], KINDS).repartition(5)
    placed = conversations._placed(conversations._rows(conversations.damaged(df)))
    assert placed.where("conv_id = 7").select("part", "chunk").distinct().count() > 40
    assert asked(conversations.audited(conversations.edited(conversations.damaged(df)), df)) == audit(rows, by_dynamic_programme)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hm."), (None, 1, "user", "Hm."), (1, None, "user", ""), (2, 5, "assistant", "x" * 200_000 + "."), (2, -3, "user", "\x0b\x0c."), (3, 2**62, "", "?"), (3, 0, "u", "."),
        (4, 1, "user", "a. "), (4, 1, "user", "a. "), (4, 1, "assistant", "b.")]
    assert run(spark, rows) == audit(rows, by_dynamic_programme)


def test_empty_table_and_lost_conversations(spark):
    none = spark.createDataFrame([], KINDS)
    assert asked(conversations.audited(conversations.edited(conversations.damaged(none)), none)) == {}
    gone = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    assert run(spark, [(*gone, "user", "Hm.")]) == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "So?"), (1, 3, "assistant", "So."), (1, 3, "assistant", "So."), (1, 4, "user", "Well")]
    found = conversations.repaired(spark.createDataFrame([(*r, 1, "x") for r in rows], KINDS)).orderBy("place", "step").collect()
    cost, edits, text = by_dynamic_programme(in_order(rows), faults(in_order(rows)))
    assert "\n".join(f"{r.role}:{r.text}" for r in found) == text


def test_given_conversations(spark):
    rows = [tuple(r) for r in common.table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = queries.QUERIES["op12_conversation_repair"](spark, SF)
    assert [c for c, _ in found.dtypes] == ["conv_id", *conversations.COUNTS, "audit", "repaired_sha256"]
    assert asked(found) == audit(rows, by_dynamic_programme)
