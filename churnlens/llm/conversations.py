"""Conversation structure repair: iterative-deepening A*.

A conversation's rows are put in order (by turn, nulls first; rows of one turn by role, then
by the digest of their text) and marked: blank, duplicate (role and text stand earlier),
truncated (its last character is none of ``.!?``), each row by its first fault. The repair
is the cheapest list of edits after which the initials of the roles read ``(s?(ua)+)?``:

    D delete 4 (required for blank and duplicate rows), I insert an empty user or assistant
    turn 3, K keep 0, R change the role to user or assistant 3; a truncated row that is not
    deleted costs 3 more.

The search goes depth first through the edits in ASCII order under a cost bound; a row's
least possible cost is the heuristic, the least cost beyond the bound is the next bound, and
a table of failed states (row, state of the pattern -> what was left to spend) cuts what
cannot succeed. The first accepted path is therefore the cheapest, and the ASCII-least of
those. Conversations longer than ``CHUNK`` rows are searched chunk by chunk, against the
exact cost to go of each state at the chunk's end.

Conversations of ordinary length are gathered whole, one row each. One of more than
``LONG_ROWS`` rows or ``LONG_CHARS`` characters is never gathered: its rows are dealt by
range of their order into segments, the segments give cost tables (4 x 4 states), these are
chained backward for each conversation, the segments are searched for every state they may
begin with, and the true beginnings are chained forward. Its duplicates come from an
aggregate by digest. Only the digest of its repaired text reads it in one task, row by row:
that is what SHA-256 asks for.

Defined results: null roles and texts count as one space (blank), null ids are one
conversation, null turns come first and do not count for gaps; a role other than system,
user or assistant counts by its initial, an empty one has none; without rows there are no
edits; rows that repeat are duplicates; an empty table gives an empty result; columns other
than the four are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common as C

DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
CHUNK, SEGMENT = 16, 4096
LONG_ROWS, LONG_CHARS = 50_000, 64 << 20
ENDS = ".!?"
LEGAL = frozenset("su ua au".split())
#: States of the pattern: nothing yet, after s, after u, after a; the last but s and u may end.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDING = (START, ASSISTANT)
#: What a new turn must be in a state, and where it leads.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: (state, initial) -> state for a turn that is kept.
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
INITIALS = "sua-"
NONE, MUST_GO, TRUNCATED = range(3)


def code(initial: str, fault: int) -> int:
    """A row as the search sees it."""
    return (INITIALS.index(initial) if initial in ("s", "u", "a") else 3) + 4 * fault


def steps(row: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row in ASCII order without inserts: (initial, cost, next state)."""
    fault, out = row // 4, [("D", DELETE, state)]
    if fault != MUST_GO:
        more = CUT if fault == TRUNCATED else 0
        to = KEEP.get((state, INITIALS[row % 4]))
        if to is not None:
            out.append(("K", more, to))
        out.append(("R", REROLE + more, NEXT[state][1]))
    return out


_STEPS = [[steps(row, q) for q in range(4)] for row in range(12)]
_LEAST = [DELETE if row // 4 == MUST_GO else CUT if row // 4 == TRUNCATED else 0 for row in range(12)]


def to_go(codes: bytes, end: tuple[float, ...] | None = None) -> tuple[float, ...]:
    """Least cost from each state before the rows to their end (``end``: what each state
    still costs there; None: the conversation's end)."""
    t = [0.0, math.inf, math.inf, 0.0] if end is None else list(end)

    def inserts() -> None:
        for _ in range(3):
            for q in range(4):
                t[q] = min(t[q], INSERT + t[NEXT[q][1]])

    inserts()
    for row in reversed(codes):
        t = [min(cost + t[to] for _, cost, to in _STEPS[row][q]) for q in range(4)]
        inserts()
    return tuple(t)


@lru_cache(maxsize=1 << 16)
def search(codes: bytes, state: int, end: tuple[float, ...] | None) -> tuple[str, float, int]:
    """Edits, their cost and the state after a chunk: the ASCII-least of the cheapest."""
    n = len(codes)
    low = 0 if end is None else min(end)
    least = [low] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + _LEAST[codes[i]]
    path: list[str] = []
    bound, over = least[0], math.inf
    failed: dict[int, float] = {}

    def go(i: int, q: int, spent: float) -> int:
        """The state reached, or -1."""
        nonlocal over
        if i == n:
            if end is not None:
                if spent + end[q] <= bound:
                    return q
                over = min(over, spent + end[q])
                return -1
            if q in ENDING:
                return q
        key, left = 4 * i + q, bound - spent
        if failed.get(key, -1) >= left:
            return -1
        failed[key] = left
        moves = _STEPS[codes[i]][q] if i < n else []
        tries = [(e, c, to, i + 1) for e, c, to in moves]
        tries.insert(1 if moves else 0, ("I", INSERT, NEXT[q][1], i))  # D < I < K < R
        for edit, cost, to, at in tries:
            total = spent + cost + least[at]
            if total > bound:
                over = min(over, total)
                continue
            path.append(edit)
            found = go(at, to, spent + cost)
            if found >= 0:
                return found
            path.pop()
        return -1

    while True:
        found = go(0, state, 0)
        if found >= 0:
            return "".join(path), bound - (0 if end is None else end[found]), found
        bound, over = over, math.inf
        failed.clear()


def solve(codes: bytes, state: int = START, end: tuple[float, ...] | None = None) -> tuple[str, float, int]:
    """Edits, cost and last state of rows that follow ``state``."""
    ends = [end]
    chunks = [codes[i:i + CHUNK] for i in range(0, len(codes), CHUNK)] or [b""]
    for chunk in reversed(chunks[1:]):
        ends.append(to_go(chunk, ends[-1]))
    audit, cost = [], 0.0
    for chunk, then in zip(chunks, reversed(ends)):
        part, spent, state = search(chunk, state, then)
        audit.append(part)
        cost += spent
    return "".join(audit), cost, state


def repaired(audit: str, state: int, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Turns after the edits of ``audit``."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            role, state = NEXT[state]
            out.append((role, ""))
            continue
        role, text = rows[i]
        i += 1
        if edit == "K":
            state = KEEP[state, role[:1]]
            out.append((role, text))
        elif edit == "R":
            role, state = NEXT[state]
            out.append((role, text))
    return out


def fault_of(text: str, seen: bool) -> tuple[str, int]:
    last = text.rstrip(C.WS)[-1:]
    if not last:
        return "blank", MUST_GO
    if seen:
        return "duplicate", MUST_GO
    return ("truncated", TRUNCATED) if last not in ENDS else ("", NONE)


def review(rows: list[tuple[int | None, str, str]]) -> dict:
    """Everything about one conversation whose rows (turn, role, text) are in order."""
    turns = [t for t, _, _ in rows if t is not None]
    out = {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": 0, "duplicate": 0, "truncated": 0}
    seen, codes = set(), bytearray()
    for _, role, text in rows:
        name, fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        if name:
            out[name] += 1
        codes.append(code(role[:1], fault))
    initials = [r[:1] for _, r, _ in rows]
    out["illegal"] = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    out["audit"], cost, _ = solve(bytes(codes))
    out["cost"] = int(cost)
    out["turns"] = repaired(out["audit"], START, [(r, t) for _, r, t in rows])
    return out


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = f"{', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"


def _text(role: str, text: str) -> str:
    return f"{role}:{text}"


def _ordinary(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            found = []
            for rows in part.column("rows").to_pylist():
                one = review([(r["turn"], r["role"], r["text"]) for r in rows or ()])
                one["repaired_sha256"] = hashlib.sha256("\n".join(_text(*x) for x in one["turns"]).encode("utf-8", "surrogatepass")).hexdigest()
                found.append(one)
            yield pa.RecordBatch.from_arrays([
                part.column("conv"), *[pa.array([x[c] for x in found], pa.int64()) for c in COUNTS],
                *[pa.array([x[c] for x in found], pa.string()) for c in ("audit", "repaired_sha256")]], names=["conv", *COUNTS, "audit", "repaired_sha256"])


def prepared(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text and there (false: the row only names its conversation), with
    null roles and texts as one space."""
    return turns.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
                        F.lit(True).alias("there"))


def repair(rows: DataFrame, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS) -> DataFrame:
    """Rows of ``prepared`` -> one row per conversation: conv, gaps, blank, duplicate,
    truncated, illegal, cost, audit and the digest of its repaired turns."""
    key = F.when(F.col("conv").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("conv").cast("string")))
    rows = rows.withColumn("ck", key)
    sizes = rows.groupBy("ck").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text") + F.length("role")).alias("chars"))
    long = cut_lineage(sizes.where((F.col("n") > long_rows) | (F.col("chars") > long_chars)).select("ck", "n", F.lit(True).alias("is_long")))
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, {RESULT}"
    any_long = bool(long.limit(1).collect())
    marked = C.attach(rows, long, ["ck"], "n", ["is_long"], F.xxhash64("turn", "role", "text")) if any_long else rows
    plain = marked.where(F.col("is_long").isNull()) if any_long else marked
    one = F.when(F.col("there"), F.struct("turn", "role", F.md5("text").alias("digest"), "text"))
    gathered = plain.groupBy("conv").agg(F.sort_array(F.collect_list(one)).alias("rows"))
    out = gathered.mapInArrow(_ordinary, schema)
    return out.unionByName(_repair_long(cut_lineage(marked.where("is_long")), schema)) if any_long else out


# conversations too long for one task

def _segments(batches):
    """Sorted rows -> segments of one conversation each, with their codes."""
    part, no, held, names = TaskContext.get().partitionId(), 0, [], ["ck", "part", "seg", "turns", "roles", "texts", "codes"]

    def made():
        return pa.RecordBatch.from_arrays([
            pa.array([held[0]["ck"]]), pa.array([part], pa.int32()), pa.array([no], pa.int32()), pa.array([[r["turn"] for r in held]], pa.list_(pa.int64())),
            pa.array([[r["role"] for r in held]], pa.list_(pa.string())), pa.array([[r["text"] for r in held]], pa.list_(pa.string())),
            pa.array([bytes(code(r["role"][:1], {"blank": MUST_GO, "duplicate": MUST_GO, "truncated": TRUNCATED}.get(r["fault"], NONE)) for r in held)])], names=names)

    size = 0
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            for r in batch.slice(a, 512).to_pylist():
                if held and (r["ck"] != held[0]["ck"] or len(held) >= SEGMENT or size > 8 << 20):
                    yield made()
                    held, no, size = [], no + 1, 0
                held.append(r)
                size += len(r["text"])
    if held:
        yield made()


def _tables(batches):
    """Codes of a segment -> its cost table, state by state."""
    for batch in batches:
        costs = [[x for to in range(4) for x in to_go(c, tuple(0.0 if q == to else math.inf for q in range(4)))] for c in batch.column("codes").to_pylist()]
        roles = batch.column("roles").to_pylist()
        inner = [sum(a[:1] + b[:1] not in LEGAL for a, b in zip(r, r[1:])) for r in roles]
        yield pa.RecordBatch.from_arrays([
            *[batch.column(c) for c in ("ck", "part", "seg")], pa.array(costs, pa.list_(pa.float64())), pa.array([r[0][:1] for r in roles]),
            pa.array([r[-1][:1] for r in roles]), pa.array(inner, pa.int64())], names=["ck", "part", "seg", "costs", "head", "tail", "illegal"])


def _backward(got: pa.Table) -> pa.Table:
    """Of a conversation: what each state still costs after each segment (null: the end)."""
    got = got.sort_by([("part", "ascending"), ("seg", "ascending")])
    then, ends, t = None, [], None
    for costs in reversed(got.column("costs").to_pylist()):
        ends.append(then)
        t = to_go(b"", None) if then is None else then
        then = tuple(min(costs[4 * to + q] + t[to] for to in range(4)) for q in range(4))
    heads, tails = got.column("head").to_pylist(), got.column("tail").to_pylist()
    joint = [0] + [int(a + b not in LEGAL) for a, b in zip(tails, heads[1:])]
    return pa.table({"ck": got.column("ck"), "part": got.column("part"), "seg": got.column("seg"), "end": pa.array(ends[::-1], pa.list_(pa.float64())),
                     "illegal": pa.array([a + b for a, b in zip(got.column("illegal").to_pylist(), joint)], pa.int64())})


def _searched(batches):
    """Codes and end of a segment -> for each state that may begin it edits, cost and last state."""
    for batch in batches:
        found = []
        for codes, end in zip(batch.column("codes").to_pylist(), batch.column("end").to_pylist()):
            found.append([dict(zip(("audit", "cost", "state"), solve(codes, q, None if end is None else tuple(end)))) for q in range(4)])
        kind = pa.list_(pa.struct([("audit", pa.string()), ("cost", pa.float64()), ("state", pa.int32())]))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("ck", "part", "seg")], pa.array(found, kind)], names=["ck", "part", "seg", "found"])


def _forward(got: pa.Table) -> pa.Table:
    """Of a conversation: the state that each segment begins with."""
    got = got.sort_by([("part", "ascending"), ("seg", "ascending")])
    state, begins = START, []
    for to in got.column("to").to_pylist():
        begins.append(state)
        state = to[state]
    return pa.table({"ck": got.column("ck"), "part": got.column("part"), "seg": got.column("seg"), "begin": pa.array(begins, pa.int32())})


def _digested(batches):
    """Pieces of repaired text in order -> the digest of each conversation's."""
    now, h, first = None, None, True
    for batch in batches:
        for ck, roles, texts, begin, audit in zip(*(batch.column(c).to_pylist() for c in ("ck", "roles", "texts", "begin", "audit"))):
            if ck != now:
                if h is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([h.hexdigest()])], names=["ck", "repaired_sha256"])
                now, h, first = ck, hashlib.sha256(), True
            for turn in repaired(audit, begin, list(zip(roles, texts))):
                h.update((("" if first else "\n") + _text(*turn)).encode("utf-8", "surrogatepass"))
                first = False
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([h.hexdigest()])], names=["ck", "repaired_sha256"])


def _blank(text: Column) -> Column:
    return F.btrim(text, F.lit(C.WS)) == ""


def _repair_long(rows: DataFrame, schema: str) -> DataFrame:
    """The same for stored rows (ck, conv, turn, role, text, there) of long conversations."""
    ids = rows.groupBy("ck").agg(F.max("conv").alias("conv"))
    live = cut_lineage(rows.where("there").select("ck", "turn", "role", "text", F.md5("text").alias("digest"), F.monotonically_increasing_id().alias("rid")))
    firsts = cut_lineage(live.groupBy("ck", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "rid")).alias("first"), F.count(F.lit(1)).alias("n")))
    flagged = C.attach(live, firsts, ["ck", "role", "digest"], "n", ["first"], F.col("rid"))
    fault = (F.when(_blank(F.col("text")), "blank").when(F.col("rid") != F.col("first.rid"), "duplicate")
             .when(~F.substring(F.rtrim(F.col("text"), F.lit(C.WS)), -1, 1).isin(*ENDS), "truncated"))
    flagged = cut_lineage(flagged.select("ck", "turn", "role", "digest", "rid", fault.alias("fault"), "text"))
    order = [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("rid")]
    parts = C.shuffle_partitions(rows.sparkSession)
    segs = cut_lineage(flagged.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("ck", "turn", "role", "text", "fault").mapInArrow(
        _segments, "ck string, part int, seg int, turns array<bigint>, roles array<string>, texts array<string>, codes binary"))
    at = ["ck", "part", "seg"]
    tables = cut_lineage(segs.select(*at, "roles", "codes").mapInArrow(_tables, "ck string, part int, seg int, costs array<double>, head string, tail string, illegal long"))
    ends = cut_lineage(tables.groupBy("ck").applyInArrow(_backward, "ck string, part int, seg int, end array<double>, illegal long"))
    found = cut_lineage(segs.select(*at, "codes").join(ends.select(*at, "end"), at).mapInArrow(
        _searched, "ck string, part int, seg int, found array<struct<audit:string,cost:double,state:int>>"))
    begins = cut_lineage(found.select(*at, F.transform("found", lambda x: x["state"]).alias("to")).groupBy("ck").applyInArrow(
        _forward, "ck string, part int, seg int, begin int"))
    chosen = cut_lineage(found.join(begins, at).select(*at, "begin", F.col("found")[F.col("begin")].alias("x")).select(
        *at, "begin", F.col("x.audit").alias("audit"), F.col("x.cost").alias("cost")))
    audits = chosen.groupBy("ck").agg(F.sum("cost").cast("long").alias("cost"),
                                      F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    pieces = segs.select(*at, "roles", "texts").join(chosen.select(*at, "begin", "audit"), at)
    hashes = pieces.repartition(parts, "ck").sortWithinPartitions(*at).select("ck", "roles", "texts", "begin", "audit").mapInArrow(
        _digested, "ck string, repaired_sha256 string")
    is_ = lambda x: F.sum(F.when(F.col("fault") == x, 1).otherwise(0)).alias(x)
    faults = flagged.groupBy("ck").agg(is_("blank"), is_("duplicate"), is_("truncated"))
    spans = flagged.where("turn IS NOT NULL").groupBy("ck", "turn").count().groupBy("ck").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    illegal = ends.groupBy("ck").agg(F.sum("illegal").alias("illegal"))
    out = ids
    for more in (spans, faults, illegal, audits, hashes):
        out = out.join(more, "ck", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """The query's input: rows of ``turns`` with the contract's faults put in by
    crc32(conv_id:turn) % 20. A dropped row still names its conversation."""
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = prepared(turns).withColumn("k", F.crc32(F.concat(show("conv"), F.lit(":"), show("turn"))) % 20)
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    again = F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), (F.col("k") != 0).alias("there"), again.alias("copy")).drop("copy")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Query: faults, edits and digest of the repaired turns of every conversation."""
    out = repair(damaged(C.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
    return out.withColumnRenamed("conv", "conv_id")


def _sql() -> str:
    """The contract as dynamic programming: of each state the cheapest and ASCII-least
    edits so far, row by row."""
    step = "list_reduce(list_concat([xor(a, b)], range(8)), lambda t, z: xor(t >> 1, (t & 1) * 3988292384))"
    crc = ("xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))), "
           f"lambda a, b: {step}), 4294967295)")

    def add(state: str, edit: str, cost: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    none = "{'c': CAST(1000000000 AS BIGINT), 'a': ''}"
    more = f"CASE WHEN fault = 2 THEN {CUT} ELSE 0 END"

    def kept(state: str, who: str) -> str:
        return f"CASE WHEN fault <> 1 AND who = '{who}' THEN {add(state, 'K', more)} ELSE {none} END"

    def changed(state: str) -> str:
        return f"CASE WHEN fault <> 1 THEN {add(state, 'R', f'{REROLE} + {more}')} ELSE {none} END"

    inserted_u = least("f2", add("f0", "I", INSERT), add("f1", "I", INSERT), add("f3", "I", INSERT))
    return rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
hit AS (SELECT *, {crc} % 20 AS k FROM src),
live AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hit, LATERAL (SELECT unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END)) c WHERE k <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS rn FROM live),
faulty AS MATERIALIZED (
  SELECT *, left(role, 1) AS who,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS name,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM num),
rows_ AS MATERIALIZED (SELECT *, CASE name WHEN 'truncated' THEN 2 WHEN '' THEN 0 ELSE 1 END AS fault FROM faulty),
convs AS (SELECT DISTINCT conv_id FROM conversations),
sums AS (
  SELECT c.conv_id, count(r.rn) AS n, coalesce(max(r.turn) - min(r.turn) + 1 - count(DISTINCT r.turn), 0) AS gaps,
         count(*) FILTER (WHERE r.name = 'blank') AS blank, count(*) FILTER (WHERE r.name = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE r.name = 'truncated') AS truncated,
         count(*) FILTER (WHERE r.before IS NOT NULL AND r.before || r.who NOT IN ('su', 'ua', 'au')) AS illegal
  FROM convs c LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
dp(conv_id, i, f0, f1, f2, f3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), {{'c': CAST(0 AS BIGINT), 'a': ''}}, {none}, {none}, {none} FROM convs
  UNION ALL
  SELECT conv_id, rn, {add('f0', 'D', DELETE)}, {least(add('f1', 'D', DELETE), kept('f0', 's'))},
         {least(add('f2', 'D', DELETE), *[kept(f, 'u') for f in ('f0', 'f1', 'f3')], *[changed(f) for f in ('f0', 'f1', 'f3')])},
         {least(add('f3', 'D', DELETE), kept('f2', 'a'), changed('f2'))}
  FROM (
    SELECT conv_id, rn, who, fault, f0, f1, f2, {least('f3', add('f2', 'I', INSERT))} AS f3 FROM (
      SELECT d.conv_id, r.rn, r.who, r.fault, f0, f1, {inserted_u} AS f2, f3
      FROM dp d JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.rn = d.i + 1))),
ends AS (
  SELECT s.*, {least('f0', 'f3', add('f2', 'I', INSERT), add(add('f1', 'I', INSERT), 'I', INSERT))} AS best
  FROM sums s JOIN dp d ON d.conv_id IS NOT DISTINCT FROM s.conv_id AND d.i = s.n),
edits AS (SELECT conv_id, unnest(range(1, length(best.a) + 1)) AS j, best.a AS audit FROM ends),
placed AS (
  SELECT conv_id, j, substr(audit, j, 1) AS e, length(replace(substr(audit, 1, j), 'I', '')) AS rn,
         length(replace(substr(audit, 1, j), 'D', '')) AS place FROM edits),
turned AS (
  SELECT p.conv_id, p.j, p.e, p.place, r.role, r.text, max(CASE WHEN p.place = 1 AND p.e = 'K' AND r.who = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS has_s
  FROM placed p LEFT JOIN rows_ r ON p.e <> 'I' AND r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.rn = p.rn),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                             CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS t FROM turned WHERE e <> 'D' GROUP BY conv_id)
SELECT e.conv_id, gaps, blank, duplicate, truncated, illegal, best.c AS cost, best.a AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM ends e LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM e.conv_id
"""


SQL = _sql()
