"""Conversation structure repair by iterative-deepening A*.

A conversation is sound if its roles' initials read ``(s?(ua)+)?`` and no row is blank or a duplicate.  Edits:
Delete a row (3; required for blank rows and duplicates), Insert an empty user or
assistant row (2), Keep a row (0), Rerole a row to user or assistant (2); a truncated row
that stays adds 1.  The repair is the cheapest sequence of edits; of equally
cheap ones, the one whose initials D, I, K, R come first in ASCII order.

``search`` goes depth first through the edits in ASCII order, under a cost
bound that rises to the least cost that a cut-off branch asked for.  A state is (row, state
of the pattern); what a failed state is known to cost at least is kept in a transposition
table for later branches and bounds.  The first accepting path is the answer.

A conversation may hold a third of all rows, so none is ever one group:

1. ``numbered``: rows, without their texts, are numbered in (conversation, turn) order by running counts over range partitions.
2. ``segments``: a conversation is cut into stretches of ``SEGMENT`` rows.  Each is
   searched for every state that it may be entered in and left in (a conversation
   of one stretch: start to accepting).  A stretch but the last ends with a row's letter, so of two
   paths from one state none is a prefix of the other, and their order is a rank.
3. ``chosen``: stretches are joined ``FAN`` at a time, level by level, keeping
   (cost, rank) for each pair of states; then the choice is handed down again.
4. ``repaired_turns``: the repaired rows.  ``digests`` streams them in order through sha256,
   which no cut can share out: a task holds one hash state, not the conversation.

Defined cases: a null role or text is one space, a null conversation or turn
too in the seeded damage; null turns come first and do not count in ``gaps``; rows of one turn go by role,
then by a hash of the text; an empty role counts as a space; a null ``conv_id`` is one
conversation; a conversation without rows left has zeros, an empty audit and the hash of
empty text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk.llm.common import WS, map_arrow, stored, table
from clinrisk.llm.crc_sql import CRC, crc32
from clinrisk.operators.prefix import prefix_sums

SEGMENT = 128                   # rows that are searched at once
FAN = 64                        # stretches that are joined at once
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)       # states: nothing yet, after s, after u, after a
STATES = range(4)
ACCEPTING = (START, ASSISTANT)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 30


# --- The search ---------------------------------------------------------------------

def kept(state: int, initial: str) -> int | None:
    """The state after a row with this initial, if the pattern allows it."""
    if initial == "s" and state == START:
        return SYSTEM
    if (initial == "u" and NEXT[state] == USER) or (initial == "a" and state == USER):
        return NEXT[state]
    return None


def search(initials: str, faults: bytes, entry: int, goal: int, last: bool, need: dict) -> tuple[int, str] | None:
    """(cost, audit) of the best path through the rows from ``entry`` to
    ``goal``.  ``last``: rows may be inserted behind the last one.  ``need``
    is the transposition table of this goal: least cost from a failed state."""
    n = len(initials)
    if goal == START and entry != START:
        return None
    keeps_system = any(c == "s" and f in (OK, TRUNCATED) for c, f in zip(initials, faults))
    if goal == SYSTEM and not (entry == SYSTEM or (entry == START and keeps_system)):
        return None
    rest = [0] * (n + 1)            # what the rows from here on cost at least
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (3 if faults[i] in (BLANK, DUPLICATE) else 1 if faults[i] == TRUNCATED else 0)
    path: list[str] = []

    def least(i: int, state: int) -> int:
        if (goal == START and state != START) or (goal == SYSTEM and state in (USER, ASSISTANT)):
            return NEVER
        return max(need.get((i, state), 0), rest[i])

    def moves(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(letter, cost, row, state) in ASCII order."""
        row = i < n
        if row:
            yield "D", 3, i + 1, state
        if row or last:
            yield "I", 2, i, NEXT[state]
        if row and faults[i] in (OK, TRUNCATED):
            extra = 1 if faults[i] == TRUNCATED else 0
            to = kept(state, initials[i])
            if to is not None:
                yield "K", extra, i + 1, to
            yield "R", 2 + extra, i + 1, NEXT[state]

    def deeper(i: int, state: int, left: int) -> bool:
        if i == n and state == goal:
            return True
        best = NEVER
        for letter, cost, j, to in moves(i, state):
            asked = cost + least(j, to)
            if asked <= left:
                path.append(letter)
                if deeper(j, to, left - cost):
                    return True
                path.pop()
                asked = cost + least(j, to)
            best = min(best, asked)
        need[i, state] = max(best, need.get((i, state), 0))
        return False
    bound = least(0, entry)
    while bound < NEVER:
        if deeper(0, entry, bound):
            return bound, "".join(path)
        bound = max(bound + 1, least(0, entry))
    return None


@lru_cache(maxsize=100_000)
def solved(initials: str, faults: bytes, first: bool, last: bool) -> tuple[list[int], list[int], list[str | None]]:
    """Costs, ranks and audits by 4 x entry + goal; a rank orders the audits of one entry."""
    costs, ranks, audits = [NEVER] * 16, [0] * 16, [None] * 16
    for goal in ACCEPTING if last else STATES:
        need: dict = {}
        for entry in (START,) if first else STATES:
            found = search(initials, faults, entry, goal, last, need)
            if found:
                costs[4 * entry + goal], audits[4 * entry + goal] = found
    for entry in STATES:
        of = sorted((a, 4 * entry + g) for g in STATES if (a := audits[4 * entry + g]) is not None)
        for rank, (_, k) in enumerate(of):
            ranks[k] = rank
    return costs, ranks, audits


def joined(children: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int], list[bytes | None]]:
    """Costs and ranks of a row of stretches, and the states that each child is left in."""
    costs, ranks, paths = [NEVER] * 16, [0] * 16, [None] * 16
    order: dict[int, list] = {e: [] for e in STATES}
    for goal in STATES:
        # From the back: the best cost to the goal and the exit taken; equal costs go by the rank in the earliest child.
        after = [0 if s == goal else NEVER for s in STATES]
        taken: list[list[int]] = []
        for cost, rank in reversed(children):
            best = [min((cost[4 * e + x] + after[x], rank[4 * e + x], x) for x in STATES) for e in STATES]
            after = [min(b[0], NEVER) for b in best]
            taken.append([b[2] for b in best])
        for entry in STATES:
            if after[entry] < NEVER:
                state, exits, marks = entry, [], []
                for choice, (_, rank) in zip(reversed(taken), children):
                    exits.append(choice[state])
                    marks.append(rank[4 * state + choice[state]])
                    state = choice[state]
                costs[4 * entry + goal], paths[4 * entry + goal] = after[entry], bytes(exits)
                order[entry].append((marks, 4 * entry + goal))
    for entry in STATES:
        for rank, (_, k) in enumerate(sorted(order[entry])):
            ranks[k] = rank
    return costs, ranks, paths


def actions(initials: str, audit: str, entry: int) -> list[tuple[list[str], bool, str | None, list[str]]]:
    """Per row: the roles inserted before it, whether it stays, its new role if
    it gets one, and (for the last row) the roles inserted behind it."""
    out, state, waiting = [], entry, []
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            waiting.append(ROLES[state])
            continue
        role = None
        if letter == "K":
            state = kept(state, initials[len(out)])
        elif letter == "R":
            state = NEXT[state]
            role = ROLES[state]
        out.append((waiting, letter != "D", role, []))
        waiting = []
    out[-1][3].extend(waiting)
    return out


# --- Rows ---------------------------------------------------------------------------

def plain(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copy), nulls of role and text as one space."""
    return turns.select(F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(0).alias("copy"))


def damaged(turns: DataFrame) -> DataFrame:
    """``plain`` rows with seeded damage: one in twenty each is dropped, emptied, loses its ``.!?``, stands twice, is the user's."""
    space = F.lit(" ")
    h = F.crc32(F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    rows = plain(turns).withColumn("h", h).where("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))


def marked(rows: DataFrame) -> DataFrame:
    """The rows, stored, with a number ``rid`` of their own: all but the last step work on narrow rows, without the texts."""
    return stored(rows.withColumn("rid", F.monotonically_increasing_id()), "turns")


def numbered(rows: DataFrame) -> DataFrame:
    """Per row of ``marked``: rid, conv, turn, ``at`` (its number in (conversation, turn) order), ``cid`` (number of the
    conversation's first row), ``n`` (its rows), ``initial`` and ``fault``."""
    end = F.rtrim(F.col("text"), F.lit(WS))
    initial = F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1))
    key = [F.xxhash64(F.lit(i), F.col("conv").isNull(), "conv", "role", "text").alias(f"k{i}") for i in (1, 2)]
    narrow = rows.select("rid", "conv", "turn", "role", F.xxhash64("text").alias("th"), initial.alias("initial"), (end == "").alias("blank"),
                         F.substring(end, -1, 1).isin(".", "!", "?").alias("ended"), *key)
    at = prefix_sums(narrow, [], ["conv", "turn", "role", "th", "rid"], {"at": F.lit(1).cast("bigint")}, once=False)
    at = stored(at.drop("role", "th"), "turn-numbers")
    whole = at.groupBy(F.col("conv").alias("c")).agg(F.min("at").alias("cid"), F.count(F.lit(1)).alias("n"))
    seen = at.where(~F.col("blank")).groupBy("k1", "k2").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    out = at.join(seen, ["k1", "k2"], "left").join(whole, F.col("conv").eqNullSafe(F.col("c")))
    fault = F.when(F.col("blank"), BLANK).when(F.col("first") < F.col("at"), DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(OK)
    return out.select("rid", "cid", "conv", "at", "n", "turn", "initial", fault.alias("fault"))


# --- Segments -------------------------------------------------------------------------

def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows that share their first columns (never null), of batches sorted by them."""
    held: list[pa.RecordBatch] = []

    def keys(b: pa.RecordBatch, i: int) -> tuple:
        return tuple(b.column(k)[i].as_py() for k in range(n_keys))
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in range(n_keys):
            values = batch.column(k).to_numpy()
            change |= values[1:] != values[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            part = batch.slice(a, b - a)
            if held and keys(held[0], 0) != keys(part, 0):
                yield keys(held[0], 0), pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield keys(held[0], 0), pa.Table.from_batches(held)


def per_group(rows: DataFrame, keys: list[str], order: str, function: Callable[[tuple, pa.Table], list[tuple]], schema: str) -> DataFrame:
    """``function`` of every group, streamed: groups are dealt by key and sorted, and a task holds one at a time."""
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, order)
    target = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, group in grouped(batches, len(keys)):
            out += function(key, group)
            if len(out) >= 5_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)
    return map_arrow(dealt, run, schema)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
          "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}
_NODE = "costs array<int>, ranks array<int>"


def segments(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Per (cid, seg): start (``at`` of its first row), initials, counts of its faults and illegal steps, costs, ranks, audits."""
    place = F.col("at") - F.col("cid")
    # The last row of a stretch is also sent to the next one, for the step between them.
    sent = F.when((place % segment == segment - 1) & (place + 1 < F.col("n")), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    dealt = rows.select("cid", (place - place % segment).alias("from"), "at", "n", "initial", "fault", F.explode(sent).alias("ahead"))
    dealt = dealt.select("cid", (F.col("from") / segment + F.col("ahead")).cast("bigint").alias("seg"), "at", "n", "initial", F.col("fault").cast("int").alias("fault"), "ahead")

    def solve(key: tuple, group: pa.Table) -> list[tuple]:
        cid, seg = key
        ahead = group.column("ahead").to_pylist()
        letters, faults = group.column("initial").to_pylist(), group.column("fault").to_pylist()
        legal = {"su", "ua", "au"}
        illegal = sum(a + b not in legal for a, b in zip(letters, letters[1:]))
        skip = ahead[0]
        initials, own = "".join(letters[skip:]), bytes(faults[skip:])
        n = group.column("n")[0].as_py()
        costs, ranks, audits = solved(initials, own, seg == 0, cid + n == group.column("at")[-1].as_py() + 1)
        return [(cid, seg, group.column("at")[skip].as_py(), initials, own.count(BLANK), own.count(DUPLICATE), own.count(TRUNCATED), illegal, costs, ranks, audits)]
    return per_group(dealt, ["cid", "seg"], "at", solve, "cid bigint, seg bigint, start bigint, initials string, blank bigint, duplicate bigint, "
                     f"truncated bigint, illegal bigint, {_NODE}, audits array<string>")


def _level(nodes: DataFrame, fan: int) -> DataFrame:
    """``fan`` neighbouring nodes (cid, idx, costs, ranks) as one, with the states between them."""
    def run(key: tuple, group: pa.Table) -> list[tuple]:
        return [(*key, *joined(list(zip(group.column("costs").to_pylist(), group.column("ranks").to_pylist()))))]
    up = nodes.select("cid", F.floor(F.col("idx") / fan).alias("up"), "idx", "costs", "ranks")
    return per_group(up, ["cid", "up"], "idx", run, f"cid bigint, idx bigint, {_NODE}, paths array<binary>")


def chosen(found: DataFrame, fan: int = FAN) -> DataFrame:
    """(cid, seg, entry, goal) of the best path through each conversation's stretches."""
    nodes = found.select("cid", F.col("seg").alias("idx"), "costs", "ranks")
    most = nodes.agg(F.max("idx")).first()[0] or 0
    levels = []
    while most > 0:
        levels.append(stored(_level(nodes, fan), "level"))
        nodes = levels[-1]
        most //= fan
    best = F.least(*[F.struct(F.get("costs", g).alias("cost"), F.get("ranks", g).alias("rank"), F.lit(g).alias("goal")) for g in ACCEPTING])
    out = nodes.select("cid", "idx", F.lit(START).alias("entry"), best["goal"].alias("goal"))
    for level in reversed(levels):
        path = F.get("paths", F.col("entry") * 4 + F.col("goal"))
        down = level.select("cid", "idx", "paths").join(out, ["cid", "idx"]).select("cid", "idx", "entry", path.alias("path"))
        each = down.select("cid", "idx", "entry", "path", F.explode(F.sequence(F.lit(1), F.octet_length("path"))).alias("k"))

        def state(k: Column) -> Column:
            return F.conv(F.hex(F.substring("path", k, F.lit(1))), 16, 10).cast("int")
        out = each.select("cid", (F.col("idx") * fan + F.col("k") - 1).alias("idx"), F.when(F.col("k") == 1, F.col("entry")).otherwise(state(F.col("k") - 1)).alias("entry"),
                          state(F.col("k")).alias("goal"))
    return out.withColumnRenamed("idx", "seg")


# --- Results ----------------------------------------------------------------------------

def repairs(rows: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """Per (cid, seg): the fields of ``segments`` with entry, audit and cost of the best repair."""
    found = stored(segments(rows, segment), "segments")
    pick = F.col("entry") * 4 + F.col("goal")
    out = found.join(chosen(found, fan), ["cid", "seg"])
    return out.select("cid", "seg", "start", "initials", "blank", "duplicate", "truncated", "illegal", "entry",
                      F.get("audits", pick).alias("audit"), F.get("costs", pick).cast("bigint").alias("cost"))


def repaired_turns(turns: DataFrame, rows: DataFrame, best: DataFrame) -> DataFrame:
    """(cid, at, k, role, text): the rows of the repaired conversations, in the order of (at, k), of the ``marked`` turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, before, stays, role, behind = [], [], [], [], []
            for start, initials, audit, entry in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for i, (a, b, c, d) in enumerate(actions(initials, audit, entry)):
                    at.append(start + i)
                    before.append(a)
                    stays.append(b)
                    role.append(c)
                    behind.append(d)
            roles = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(before, roles), pa.array(stays, pa.bool_()), pa.array(role, pa.string()),
                                              pa.array(behind, roles)], names=["at", "before", "stays", "new_role", "behind"])
    each = map_arrow(best.select("start", "initials", "audit", "entry"), run,
                     "at bigint, before array<string>, stays boolean, new_role string, behind array<string>")
    both = turns.select("rid", "role", "text").join(rows.select("rid", "cid", "at").join(each, "at"), "rid")

    def inserted(c: str) -> Column:
        return F.transform(c, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    own = F.when(F.col("stays"), F.array(F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text").alias("text"))))
    lines = F.concat(inserted("before"), F.coalesce(own, F.array().cast("array<struct<role:string,text:string>>")), inserted("behind"))
    out = both.select("cid", "at", F.posexplode(lines).alias("k", "line"))
    return out.select("cid", "at", "k", "line.role", "line.text")


def digests(turns: DataFrame) -> DataFrame:
    """(cid, sha256) of the conversations' ``role:text`` lines, joined by newlines."""
    dealt = turns.select("cid", "at", "k", F.concat_ws(":", "role", "text").alias("line"))
    dealt = dealt.repartition("cid").sortWithinPartitions("cid", "at", "k").select("cid", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cid, state = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key != cid:
                    if state:
                        done.append((cid, state.hexdigest()))
                    cid, state = key, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["cid", "sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([cid], pa.int64()), pa.array([state.hexdigest()])], names=["cid", "sha256"])
    return map_arrow(dealt, run, "cid bigint, sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """Per conversation (null too) of ``conversations`` (conv_id): conv_id, gaps, the counts of faults and illegal steps, cost,
    audit, repaired_sha256, of the ``plain`` rows ``rows``."""
    turns = marked(rows)
    rows = stored(numbered(turns), "numbered")
    best = stored(repairs(rows, segment, fan), "repairs")
    spans = rows.groupBy("cid", "conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda s: s["audit"]), "")
    whole = best.groupBy("cid").agg(*[F.sum(c).alias(c) for c in counts], audit.alias("audit"))
    found = spans.join(whole, "cid").join(digests(repaired_turns(turns, rows, best)), "cid", "left")
    ids = conversations.select("conv_id").distinct()
    out = ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *counts)]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair_report(turns, damaged(turns))


_SQL_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: The cheapest path row by row: of every state after a row, the least (cost, audit) stays.  More than two
#: insertions in a row are never cheapest.
ORACLE = f"""
WITH RECURSIVE {CRC},
q AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations, crc),
m AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM q WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, {_SQL_WS}) AS body,
             CASE WHEN role = '' THEN ' ' ELSE role[1] END AS c FROM m),
k AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                     WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS step FROM o),
a AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal FROM k GROUP BY conv_id),
j(old, inserts, mid) AS (VALUES ('', 0, ''), ('', 1, 'u'), ('', 2, 'a'), ('s', 0, 's'), ('s', 1, 'u'), ('s', 2, 'a'),
                                ('u', 0, 'u'), ('u', 1, 'a'), ('u', 2, 'u'), ('a', 0, 'a'), ('a', 1, 'u'), ('a', 2, 'a')),
x AS (SELECT conv_id, 0::BIGINT AS i, '' AS state, 0::BIGINT AS cost, '' AS audit, ''::VARCHAR AS lines FROM a
      UNION ALL
      SELECT conv_id, i, state, cost, audit, lines FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS place FROM (
          SELECT x.conv_id, k.i, e.state, x.cost + 2 * j.inserts + e.cost AS cost, x.audit || repeat('I', j.inserts) || e.letter AS audit,
                 x.lines || CASE WHEN j.inserts = 0 THEN '' WHEN j.inserts = 2 THEN CASE WHEN j.mid = 'a' THEN 'user:' || chr(10) || 'assistant:' ELSE 'assistant:' || chr(10) || 'user:' END || chr(10)
                                 WHEN j.mid = 'u' THEN 'user:' || chr(10) ELSE 'assistant:' || chr(10) END
                 || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN k.role || ':' || k.text || chr(10)
                         ELSE CASE e.state WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || k.text || chr(10) END AS lines
          FROM x JOIN k ON k.conv_id IS NOT DISTINCT FROM x.conv_id AND k.i = x.i + 1 JOIN j ON j.old = x.state,
               LATERAL (SELECT unnest([
                 {{letter: 'D', state: j.mid, cost: 3, ok: true}},
                 {{letter: 'K', state: k.c, cost: (k.fault = 'truncated')::INT, ok: k.fault NOT IN ('blank', 'duplicate') AND
                   ((k.c = 's' AND j.mid = '') OR (k.c = 'u' AND j.mid <> 'u') OR (k.c = 'a' AND j.mid = 'u'))}},
                 {{letter: 'R', state: CASE j.mid WHEN 'u' THEN 'a' ELSE 'u' END, cost: 2 + (k.fault = 'truncated')::INT,
                   ok: k.fault NOT IN ('blank', 'duplicate')}}], max_depth := 2)) e
          WHERE e.ok)) WHERE place = 1),
z AS (SELECT x.conv_id, x.cost + 2 * j.inserts AS cost, x.audit || repeat('I', j.inserts) AS audit,
             x.lines || CASE WHEN j.inserts = 0 THEN '' WHEN j.inserts = 2 THEN 'user:' || chr(10) || 'assistant:' || chr(10) ELSE 'assistant:' || chr(10) END AS lines
      FROM x JOIN a ON a.conv_id IS NOT DISTINCT FROM x.conv_id AND x.i = a.n JOIN j ON j.old = x.state
      WHERE j.mid = 'a' OR (x.state = '' AND j.inserts = 0)),
y AS (SELECT conv_id, first({{cost: cost, audit: audit, lines: lines}} ORDER BY cost, audit) AS best FROM z GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
       sha256(CASE WHEN coalesce(best.lines, '') = '' THEN '' ELSE left(best.lines, length(best.lines) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM c.conv_id
"""
