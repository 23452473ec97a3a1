"""Repair of conversations by depth-first branch-and-bound.

A conversation's rows get the cheapest edits that leave roles of the form system? (user assistant)+, or nothing. Keep costs
0, Rerole to user or assistant 2, Delete 3 (the only edit of a blank or duplicate row), Insert of an empty user or assistant
turn 2; a truncated row that stays costs 1 more. Among the cheapest edits those whose initials (the audit) come first count.

`search` is the method: an explicit stack of prefixes (row, state, cost, audit), taken depth first in the order of the
initials; a lower bound on the cost of every suffix; the incumbent, the best complete (cost, audit) so far; and a table per
node (row, state) of the best prefix seen there, which a worse prefix cannot pass. The suffix bounds leave only ties out of
account: they take one backward pass, the first is the cost that has to be reached, and what the search proves is the order
among equals. So it takes time in proportion to the rows, whatever they are. An insert returns to a row only at a higher
cost, and of two prefixes with the same cost at the same node none begins the other, so a node's better prefix stays better
whatever follows.

At scale: rows are sorted by conversation and turn into ranges, and each range is cut into blocks of BLOCK rows, so a
conversation that holds a third of all rows is solved by many tasks. A block that does not begin (end) its conversation is
searched from (to) each of the four states; `_chain` joins the blocks of a conversation from these few results, without
their rows. Duplicates are found by a map-side aggregate and a join that may be split. `repaired` never gathers a
conversation. Only the digest reads one in order in one task, streaming, because a hash of the whole text is defined so.

Null roles and texts count as one space, an empty role has no initial; neither can be kept as it is, only reroled or deleted.
Null conversation ids form a conversation of their own, null turns come first. Rows with equal turns are sorted by role
and the MD5 of the text. Very long texts are hashed in pieces as they come. Empty tables give no rows; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored
from tablewright.operators.rowids import ranged

#: Rows that one search covers.
BLOCK = 256
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, after system, after user, after assistant. END stands for "nothing" or "after assistant" at the end.
STATES, END = (0, 1, 2, 3), 4
ENDS = {0, 3}
#: (state, initial of a kept row) to state; the one role that fits a state and where it leads.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FITTING = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
DELETE, INSERT, REROLE, STAY = 3, 2, 2, 1
SPACE = "\\u0020\\u0009\\u000A\\u000B\\u000C\\u000D"
_FAR = 1 << 60


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults planted by the CRC of conversation and turn."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    return (conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), case.alias("case"))
            .where("case <> 0")
            .select("conv_id", "turn", F.when(F.col("case") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("case") == 1, F.lit("")).when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.sequence(F.lit(1), F.when(F.col("case") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def suffix_bounds(initials: list[str], faults: list[int], ends: set[int]) -> list[list[int]]:
    """For every row and state the least cost of all that follows, whatever its audit."""
    bounds = [[_FAR] * 4 for _ in range(len(faults) + 1)]
    for i in range(len(faults), -1, -1):
        here = bounds[i]
        for state in STATES:
            if i == len(faults):
                here[state] = 0 if state in ends else _FAR
                continue
            least, after = DELETE + bounds[i + 1][state], bounds[i + 1]
            if faults[i] not in (BLANK, DUPLICATE):
                stay = STAY if faults[i] == TRUNCATED else 0
                least = min(least, REROLE + stay + after[FITTING[state][1]])
                if (state, initials[i]) in KEPT:
                    least = min(least, stay + after[KEPT[state, initials[i]]])
            here[state] = least
        for _ in range(2):  # a user and an assistant may both be missing
            for state in STATES:
                here[state] = min(here[state], INSERT + here[FITTING[state][1]])
    return bounds


def search(initials: list[str], faults: list[int], state: int, ends: set[int]) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from the state over all rows into one of the ends; None if nothing does."""
    bounds, last = suffix_bounds(initials, faults, ends), len(faults)
    incumbent: tuple[int, str] | None = None
    best_at: dict[tuple[int, int], tuple[int, str]] = {}
    stack, reachable = [(0, state, 0, "")], bounds[0][state]
    while stack and reachable < _FAR:
        i, state, cost, audit = stack.pop()
        least = cost + bounds[i][state]
        if least > reachable:
            continue
        if incumbent and (least > incumbent[0] or least == incumbent[0] and audit > incumbent[1][:len(audit)]):
            continue
        if (i, state) in best_at and best_at[i, state] <= (cost, audit):
            continue
        best_at[i, state] = (cost, audit)
        if i == last and state in ends:
            if incumbent is None or (cost, audit) < incumbent:
                incumbent = (cost, audit)
            continue
        fits = FITTING[state][1]
        moves = [(i, fits, cost + INSERT, audit + "I")]
        if i < last:
            moves.insert(0, (i + 1, state, cost + DELETE, audit + "D"))
            if faults[i] not in (BLANK, DUPLICATE):
                stay = STAY if faults[i] == TRUNCATED else 0
                if (state, initials[i]) in KEPT:
                    moves.append((i + 1, KEPT[state, initials[i]], cost + stay, audit + "K"))
                moves.append((i + 1, fits, cost + REROLE + stay, audit + "R"))
        stack.extend(reversed(moves))
    return incumbent


def _columns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def conversation_key(conv_id: Column) -> Column:
    """The conversation as text; null is one of its own."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def faulted(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text in conversation order: files of consecutive rows with part and place, key, initial and fault."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    rows = stored(turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), conversation_key(F.col("conv_id")).alias("key"),
                               F.md5(text.cast("binary")).alias("digest"), F.monotonically_increasing_id().alias("id")), "repair_rows")
    same = ["key", "role", "digest"]
    repeated = (rows.groupBy(*same).agg(F.min(F.struct("turn", "id")).alias("first"), F.count("*").alias("n"))
                .where("n > 1").select(*same, F.col("first.id").alias("first")))
    body = F.expr(f"rtrim('{SPACE}', text)")
    fault = (F.when(body == "", BLANK).when(F.col("first").isNotNull() & (F.col("first") != F.col("id")), DUPLICATE)
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(NONE))
    marked = rows.join(repeated, same, "left").select(
        "conv_id", "turn", "role", "text", "key", "digest", "id", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    order = [F.col(c) for c in ("key", "turn", "role", "digest", "id")]
    return ranged(marked, order, "part", "place", unique=True).drop("digest", "id")


_BLOCK = ("key string, part int, place long, illegal int, head string, tail string, last boolean, "
          "found array<struct<entry:int, exit:int, cost:int, audit:string>>")


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Each block's cheapest edits between the states it may have to join. place is the block's first."""
    count = (rows.agg(F.max("part")).first()[0] or 0) + 1
    light = (rows.select("key", "part", "place", "initial", "fault").repartitionById(count, F.col("part"))
             .sortWithinPartitions("part", "place"))

    def solved(block: list[tuple], begins: bool, ends: bool) -> dict:
        initials, faults = [r[3] for r in block], [r[4] for r in block]
        found = []
        for entry in (0,) if begins else STATES:
            for leave, goal in ((END, ENDS),) if ends else ((s, {s}) for s in STATES):
                if best := search(initials, faults, entry, goal):
                    found.append({"entry": entry, "exit": leave, "cost": best[0], "audit": best[1]})
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        return {"key": block[0][0], "part": block[0][1], "place": block[0][2], "illegal": illegal, "head": initials[0],
                "tail": initials[-1], "last": ends, "found": found}

    def run(batches):
        kind = pa.schema([("key", pa.string()), ("part", pa.int32()), ("place", pa.int64()), ("illegal", pa.int32()),
                          ("head", pa.string()), ("tail", pa.string()), ("last", pa.bool_()),
                          ("found", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int32()), ("audit", pa.string())])))])
        block: list[tuple] = []
        begins, out = False, []
        for row in _columns(batches):
            follows = block and row[:2] == block[-1][:2]
            if block and (not follows or len(block) == size):
                out.append(solved(block, begins, not follows and row[1] == block[-1][1]))
                # A later row of another conversation in the same part begins it; the first of a part may go on from the one before.
                block, begins = [], not follows and row[1] == block[-1][1]
                if len(out) == 1000:
                    yield pa.RecordBatch.from_pylist(out, kind)
                    out = []
            elif not block:
                begins = row[1] == 0 and row[2] == 0
            block.append(row)
        if block:
            out.append(solved(block, begins, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)

    return stored(light.mapInArrow(run, _BLOCK), "repair_blocks")


def _common(texts: list[str]) -> int:
    low, high = min(texts), max(texts)
    return next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))


class _Chain:
    """Joins the blocks of one conversation: per state the least cost and what its audit has after the part all share."""

    def __init__(self) -> None:
        self.alive: dict[int, tuple[int, str]] = {0: (0, "")}
        self.came: list[dict[int, int]] = []
        self.where: list[tuple[int, int]] = []
        self.joints: list[int] = []
        self.tail: str | None = None

    def add(self, block: dict) -> None:
        ahead: dict[int, tuple[int, str]] = {}
        came: dict[int, int] = {}
        for f in block["found"]:
            if f["entry"] in self.alive:
                cost, audit = self.alive[f["entry"]]
                candidate = (cost + f["cost"], audit + f["audit"])
                if f["exit"] not in ahead or candidate < ahead[f["exit"]]:
                    ahead[f["exit"]], came[f["exit"]] = candidate, f["entry"]
        settled = _common([a for _, a in ahead.values()])
        self.alive = {s: (c, a[settled:]) for s, (c, a) in ahead.items()}
        self.came.append(came)
        self.where.append((block["part"], block["place"]))
        self.joints.append(0 if self.tail is None else int(self.tail + block["head"] not in ("su", "ua", "au")))
        self.tail = block["tail"]

    def path(self) -> Iterator[tuple[int, int, int, int, int]]:
        """part, place, entry, exit, illegal joint of every block."""
        state = END if END in self.alive else min(ENDS & self.alive.keys(), key=self.alive.__getitem__)
        for k in range(len(self.came) - 1, -1, -1):
            entry = self.came[k][state]
            yield *self.where[k], entry, state, self.joints[k]
            state = entry


def chosen(found: DataFrame) -> DataFrame:
    """key, part, place, entry, audit, cost, illegal of every block, as the whole conversation has it."""
    schema = "part int, place long, entry int, exit int, joint int"

    def run(batches):
        names = [f.strip().split()[0] for f in schema.split(",")]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

        def emitted(rows):
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        chain, key, out = None, None, []
        for batch in batches:
            for block in batch.to_pylist():
                if block["key"] != key:
                    if chain:
                        out.extend(chain.path())
                    chain, key = _Chain(), block["key"]
                    if len(out) >= 10_000:
                        yield emitted(out)
                        out = []
                chain.add(block)
        if chain:
            out.extend(chain.path())
        if out:
            yield emitted(out)

    path = found.repartition("key").sortWithinPartitions("key", "part", "place").mapInArrow(run, schema)
    picked = F.filter("found", lambda f: (f["entry"] == F.col("entry")) & (f["exit"] == F.col("exit")))[0]
    return stored(found.join(path, ["part", "place"]).select(
        "key", "part", "place", "entry", picked["audit"].alias("audit"), picked["cost"].alias("cost"),
        (F.col("illegal") + F.col("joint")).alias("illegal")), "repair_edits")


def _lined_up(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The rows, and in front of each block's first the block's edits."""
    return rows.select("key", "part", "place", F.lit(1).alias("kind"), F.lit(0).alias("entry"), "role", "text").unionByName(
        edits.select("key", "part", "place", F.lit(0).alias("kind"), "entry", F.lit("").alias("role"), F.col("audit").alias("text")))


def _edited(lines: Iterable[tuple]) -> Iterator[tuple]:
    """(conversation's line, step, edit, role, text): lines come in order, a block's edits before its rows."""
    state, letters, at, end, seen = 0, "", 0, 0, None

    def inserted():
        nonlocal state, at
        while at < len(letters) and letters[at] == "I":
            role, state = FITTING[state]
            at += 1
            yield seen, at, "I", role, ""

    for line in lines:
        if line[3] == 0:  # edits of the next block; those of the last have all been used
            state, letters, at = line[4], line[6], 0
            end = len(letters.rstrip("I"))
            continue
        seen = line
        yield from inserted()
        edit = letters[at]
        at += 1
        role, before = line[5], state
        if edit == "K":
            state = KEPT[state, role[:1]]
        elif edit == "R":
            role, state = FITTING[before]
        yield line, at, edit, role, line[6]
        if at == end:
            yield from inserted()


_REPAIRED = "key string, part int, place long, step int, edit string, role string, text string"


def repaired(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """key (see conversation_key), part, place, step, edit, role, text: the edited turns, deleted ones included.

    part, place and step sort a conversation. A conversation may lie in several parts, and no task holds more than one.
    """
    rows = faulted(turns)
    edits = chosen(blocks(rows, size))
    count = (rows.agg(F.max("part")).first()[0] or 0) + 1

    def run(batches):
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        names = [f.strip().split()[0] for f in _REPAIRED.split(",")]
        out, held = [], 0
        for line, step, edit, role, text in _edited(_columns(batches)):
            out.append((line[0], line[1], line[2], step, edit, role, text))
            held += len(text)
            if len(out) == 10_000 or held > 1 << 22:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    lines = _lined_up(rows, edits).repartitionById(count, F.col("part")).sortWithinPartitions("part", "place", "kind")
    return lines.mapInArrow(run, _REPAIRED)


def _hashes(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """key, audit, repaired_sha256 of every conversation; its lines stream through one task."""
    def run(batches):
        def emitted(out):
            return pa.record_batch([pa.array(c, pa.string()) for c in zip(*out)], ["key", "audit", "repaired_sha256"])

        key, audit, digest, lines, out = None, [], hashlib.sha256(), 0, []
        for line, _, edit, role, text in _edited(_columns(batches)):
            if line[0] != key:
                if key is not None:
                    out.append((key, "".join(audit), digest.hexdigest()))
                    if len(out) == 10_000:
                        yield emitted(out)
                        out = []
                key, audit, digest, lines = line[0], [], hashlib.sha256(), 0
            audit.append(edit)
            if edit != "D":
                digest.update((f"\n{role}:" if lines else f"{role}:").encode())
                digest.update(text.encode())
                lines += 1
        if key is not None:
            yield emitted([*out, (key, "".join(audit), digest.hexdigest())])

    lines = _lined_up(rows, edits).repartition("key").sortWithinPartitions("key", "part", "place", "kind")
    return lines.mapInArrow(run, "key string, audit string, repaired_sha256 string")


def digest(conversations: DataFrame, turns: DataFrame | None = None, size: int = BLOCK) -> DataFrame:
    """The figures of every conversation's repair; `turns` (else the damaged rows) are what is repaired."""
    rows = faulted(damage(conversations) if turns is None else turns)
    edits = chosen(blocks(rows, size))
    marks = {"blank": BLANK, "duplicate": DUPLICATE, "truncated": TRUNCATED}
    per_turn = rows.groupBy("key", "turn").agg(*[F.count(F.when(F.col("fault") == m, 1)).alias(c) for c, m in marks.items()])
    counts = per_turn.groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"), *[F.sum(c).alias(c) for c in marks])
    costs = edits.groupBy("key").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    every = conversations.select("conv_id", conversation_key(F.col("conv_id")).alias("key")).distinct()
    out = every.join(counts, "key", "left").join(costs, "key", "left").join(_hashes(rows, edits), "key", "left")
    return out.select("conv_id", *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("gaps", *marks, "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _sql() -> str:
    """The same by a cost table per conversation, row by row."""
    def after(state: str, cost: str, letter: str, line: str | None, when: str = "true") -> str:
        text = f"{state}.t" if line is None else f"{state}.t || chr(10) || {line}"
        return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"

    may, stay = "r.fault NOT IN (1, 2)", "CASE WHEN r.fault = 3 THEN 1 ELSE 0 END"
    kept = {s: [after(f"p.s{e}", stay, "K", "r.role || ':' || r.text", f"{may} AND r.initial = '{i}'") for (e, i), x in KEPT.items() if x == s] for s in STATES}
    put = {s: [after(f"p.s{e}", f"2 + {stay}", "R", f"'{role}:' || r.text", may) for e, (role, x) in FITTING.items() if x == s] for s in STATES}
    moved = ", ".join(f"list_min([{', '.join([after(f'p.s{s}', '3', 'D', None), *kept[s], *put[s]])}]) AS n{s}" for s in STATES)
    closed = ("n0 AS s0, n1 AS s1, list_min([n2, " + ", ".join(after(f"n{e}", "2", "I", "'user:'") for e in (0, 1, 3)) + "]) AS s2, n3")
    return rf"""
WITH RECURSIVE o AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
      4294967295::BIGINT) % 20 AS kind
  FROM conversations),
d AS MATERIALIZED (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM o, range(2) copies(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)),
k AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS k, left(role, 1) AS initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM d),
r AS MATERIALIZED (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 THEN 2
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY conv ORDER BY k) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM k),
p AS (
  SELECT conv, 0::BIGINT AS k, {{'c': 0, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s1,
    {{'c': 2, 'a': 'I', 't': chr(10) || 'user:'}} AS s2, {{'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM (SELECT DISTINCT conv FROM r)
  UNION ALL
  SELECT conv, k, s0, s1, s2, list_min([n3, {after('s2', '2', 'I', "'assistant:'")}]) AS s3 FROM (
    SELECT conv, k, {closed} FROM (
      SELECT p.conv, r.k, {moved} FROM p JOIN r ON r.conv = p.conv AND r.k = p.k + 1))),
f AS (
  SELECT conv, conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (illegal) AS illegal, max(k) AS k
  FROM r GROUP BY conv, conv_id),
e AS (SELECT f.*, list_min([p.s0, p.s3]) AS best FROM f JOIN p USING (conv, k))
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
"""


SQL = _sql()
