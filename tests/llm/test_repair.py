"""Conversation repair: the search against all edit sequences, blocks against whole conversations, and edge cases."""

import hashlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import repair
from tablewright.llm.repair import BLANK, DUPLICATE, END, ENDS, KEPT, NONE, STATES, TRUNCATED

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from([NONE, BLANK, DUPLICATE, TRUNCATED])), max_size=7)


def every_repair(rows):
    """The least (cost, audit) over all edit sequences, written out: roles are strings held against the pattern at the end."""
    import re

    valid, best = re.compile(r"(s?(ua)+)?"), [None]

    def go(i, roles, cost, audit, inserts):
        if best[0] and cost > best[0][0]:
            return
        if i == len(rows):
            if valid.fullmatch(roles) and (best[0] is None or (cost, audit) < best[0]):
                best[0] = (cost, audit)
        else:
            initial, fault = rows[i]
            go(i + 1, roles, cost + 3, audit + "D", 0)
            if fault not in (BLANK, DUPLICATE):
                more = 1 if fault == TRUNCATED else 0
                go(i + 1, roles + initial, cost + more, audit + "K", 0)
                for role in "ua":
                    go(i + 1, roles + role, cost + 2 + more, audit + "R", 0)
        if inserts < 2:
            for role in "ua":
                go(i, roles + role, cost + 2, audit + "I", inserts + 1)

    go(0, "", 0, "", 0)
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from([NONE, BLANK, DUPLICATE, TRUNCATED])), max_size=4))
def test_search_finds_the_least_of_all_edits(rows):
    assert repair.search([r[0] for r in rows], [r[1] for r in rows], 0, ENDS) == every_repair(rows)


@lru_cache(None)
def forward(rows):
    """The same by a table of all nodes, for longer conversations."""
    table = {0: (0, "")}

    def closed(t):
        for _ in range(3):
            for s in STATES:
                if s in t:
                    to = repair.FITTING[s][1]
                    new = (t[s][0] + 2, t[s][1] + "I")
                    if to not in t or new < t[to]:
                        t[to] = new
        return t

    table = closed(table)
    for initial, fault in rows:
        nxt = {}
        for s, (c, a) in table.items():
            moves = [(s, c + 3, a + "D")]
            if fault not in (BLANK, DUPLICATE):
                more = fault == TRUNCATED
                moves.append((repair.FITTING[s][1], c + 2 + more, a + "R"))
                if (s, initial) in KEPT:
                    moves.append((KEPT[s, initial], c + more, a + "K"))
            for to, *new in moves:
                if to not in nxt or tuple(new) < nxt[to]:
                    nxt[to] = tuple(new)
        table = closed(nxt)
    return min(table[s] for s in ENDS if s in table)


@settings(max_examples=200, deadline=None)
@given(ROWS, st.integers(1, 4), st.data())
def test_blocks_join_to_the_whole(rows, size, data):
    """Cut anywhere, with or without knowing where the conversation begins and ends."""
    chain, last = repair._Chain(), len(rows)
    begins, ends = data.draw(st.booleans()), data.draw(st.booleans())
    cuts = list(range(0, last, size))
    if not cuts:
        return
    results = {}
    for k in cuts:
        part = rows[k:k + size]
        found = []
        for entry in (0,) if begins and k == 0 else STATES:
            for leave, goal in ((END, ENDS),) if ends and k == cuts[-1] else ((s, {s}) for s in STATES):
                if best := repair.search([r[0] for r in part], [r[1] for r in part], entry, goal):
                    found.append({"entry": entry, "exit": leave, "cost": best[0], "audit": best[1]})
        results[k] = {(f["entry"], f["exit"]): f for f in found}
        chain.add({"part": 0, "place": k, "found": found, "head": part[0][0], "tail": part[-1][0]})
    path = [results[place][entry, leave] for _, place, entry, leave, _ in reversed(list(chain.path()))]
    assert (sum(f["cost"] for f in path), "".join(f["audit"] for f in path)) == forward(tuple(rows))


def plain(rows):
    """The digest of one conversation's turns, in one place."""
    import re

    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.md5(v[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append(BLANK if not body else DUPLICATE if (role, text) in seen else TRUNCATED if body[-1] not in ".!?" else NONE)
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    cost, audit = forward(tuple(zip(initials, faults)))
    state, lines, left = 0, [], iter(rows)
    for letter in audit:
        if letter == "I":
            role, state = repair.FITTING[state]
            lines.append(f"{role}:")
            continue
        _, role, text = next(left)
        if letter == "K":
            state = KEPT[state, role[:1]]
        elif letter == "R":
            role, state = repair.FITTING[state]
        if letter != "D":
            lines.append(f"{role}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def digests(frame, turns, size=repair.BLOCK):
    return {r.conv_id: tuple(r)[1:] for r in repair.digest(frame, turns, size).collect()}


def test_edges(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, None, "user", "a."), (2, 5, "user", "a."), (2, 5, "user", "a."), (2, 9, "system", " \t\x0b\x0c"),
            (3, None, None, None), (3, None, "assistant", "off"), (None, 1, "user", "x!"), (None, 4, "tool", "y? \n"), (None, 7, "", "z."), (None, 8, "assistant", "."),
            (4, 3, "system", "s."), (4, 4, "assistant", "f"), (5, 2, "user", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    expected = {c: plain([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    more = frame.withColumns({"key": F.lit("k"), "part": F.lit(3), "fault": F.lit(9), "id": F.lit(0)})
    assert digests(more, more) == expected
    assert digests(frame, frame, 1) == expected
    gone = digests(frame, frame.where("conv_id = 1"))
    assert gone[4] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) and gone[1] == expected[1] and len(gone) == 6
    assert digests(frame.where("false"), frame.where("false")) == {}


def test_a_long_conversation_lies_over_parts_and_blocks(spark):
    """One conversation with most rows, in ranges and small blocks, among small ones; texts repeat and faults abound."""
    text = F.concat(F.pmod(F.xxhash64("id"), F.lit(400)).cast("string"), F.element_at(F.array(*map(F.lit, [".", "!", "", "?", "..."])), (F.pmod(F.hash("id"), F.lit(5)) + 1).cast("int")))
    turns = spark.range(1500).select(
        F.when(F.col("id") < 1200, F.lit(None).cast("long")).otherwise(F.col("id") % 40).alias("conv_id"), (F.col("id") * 7 % 1501).alias("turn"),
        F.element_at(F.array(*map(F.lit, ["user", "assistant", "user", "assistant", "system", None])), (F.pmod(F.hash("id", F.lit(1)), F.lit(6)) + 1).cast("int")).alias("role"),
        F.when(F.col("id") % 11 == 0, F.lit("")).otherwise(text).alias("text"))
    rows = [tuple(r) for r in turns.collect()]
    expected = {c: plain([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert digests(turns, turns, 5) == expected
        out = repair.repaired(turns, 7).collect()
        assert len({r.part for r in out if r.key == ""}) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert digests(turns, turns) == expected
    by = {}
    for r in sorted(out, key=lambda r: (r.key, r.part, r.place, r.step)):
        by.setdefault(r.key, []).append(r)
    for c, e in expected.items():
        mine = by["" if c is None else f"={c}"]
        assert "".join(r.edit for r in mine) == e[6]
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine if r.edit != "D").encode()).hexdigest() == e[7]


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "x" * 2_000_000 + "."), (1, 1, "assistant", "y " * 1_000_000), (1, 2, "user", "x" * 2_000_000 + ".")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert digests(frame, frame) == {1: plain([r[1:] for r in rows])}


def test_damage_is_planted_by_conversation_and_turn(spark):
    from zlib import crc32

    rows = [(c, t, "assistant", "One. Two!") for c in range(12) for t in range(12)] + [(None, 3, None, None), (7, None, "user", "q?")]
    got = {}
    for r in repair.damage(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        kind = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want = {0: None, 1: [(role, "")], 2: [(role, text.replace(".", "").replace("!", "").replace("?", ""))], 3: [(role, text)] * 2, 4: [("user", text)]}
        assert got.get((c, t)) == want.get(kind, [(role, text)])


def test_bounds_are_the_costs():
    initials, faults = list("uusaxau"), [NONE, TRUNCATED, NONE, BLANK, NONE, DUPLICATE, NONE]
    bounds = repair.suffix_bounds(initials, faults, ENDS)
    for i in range(len(faults) + 1):
        for s in STATES:
            found = repair.search(initials[i:], faults[i:], s, ENDS)
            assert bounds[i][s] == found[0]
    assert repair.search([], [], 2, {0}) is None


@pytest.mark.parametrize("n", [2000])
def test_search_is_linear_on_rows_all_alike(n):
    cost, audit = repair.search(["u"] * n, [NONE] * n, 0, ENDS)
    assert (cost, audit) == forward(tuple([("u", NONE)] * n))
