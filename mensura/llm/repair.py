"""Repair of conversation structure by an auction shortest-path algorithm.

A conversation's rows, in order of turns, are to be edited into
``(system? (user assistant)+)?`` at least cost.  The edits form a lattice: a
node is the number of rows passed and the last role put out; arcs keep, rerole
or delete the next row, or insert an empty turn.

Auction: every node has a price, at most any arc's cost plus the price of the
arc's end.  A path grows from the origin.  Where its last node's price is less
than its cheapest way on, the price rises to it and the path contracts by that
node; else the path extends along that arc.  Costs are integers, so prices
converge, and when the path arrives the origin's price is the least cost.
Feasible prices that are exact at the origin make the arcs of every cheapest
path tight (price = cost + price of the end), and a path of tight arcs to the
target is cheapest; the audit is the lexicographically least of them.

Long conversations are priced in blocks of rows from the last to the first -
several origins, one target, prices kept - and traced from the first to the
last, so that a block's lattice and four prices a block are all that is held.
Rows stream through the tasks sorted by conversation; texts are hashed as they
pass.  What is kept of a conversation is one byte a row, as in its audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table

DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Rows whose lattice is held at a time.
BLOCK = 64
#: Blanks of a text: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
LEGAL = ("su", "ua", "au")
OTHER, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: A row in one byte: its role, whether it must go, whether it is cut off.
MUST_GO, CUT_OFF = 4, 8
#: States: nothing put out yet, after system, after user, after assistant.
STATES = 4
FAR = 1 << 60


def follows(state: int, role: int) -> int | None:
    """State after putting out a role, None where the pattern forbids it."""
    if role == USER:
        return USER if state != USER else None
    if role == ASSISTANT:
        return ASSISTANT if state == USER else None
    return SYSTEM if role == SYSTEM and state == 0 else None


def wanted(state: int) -> int:
    """The role that a rerole or an insert puts out."""
    return ASSISTANT if state == USER else USER


Arc = tuple[int, int, str]


def lattice(rows: bytes, exits: tuple[int, ...], last: bool) -> list[list[Arc]]:
    """Arcs (cost, end, initial) of each node ``STATES * row + state``; the
    node after the last is the target, reached from state q at ``exits[q]``."""
    n = len(rows)
    target = STATES * (n + 1)
    arcs: list[list[Arc]] = [[] for _ in range(target)]
    for k in range(n + 1):
        for q in range(STATES):
            own = arcs[STATES * k + q]
            if k < n:
                row = rows[k]
                own.append((DELETE, STATES * (k + 1) + q, "D"))
                if not row & MUST_GO:
                    more = TRUNCATED if row & CUT_OFF else 0
                    kept = follows(q, row & 3)
                    if kept is not None:
                        own.append((more, STATES * (k + 1) + kept, "K"))
                    own.append((REROLE + more, STATES * (k + 1) + wanted(q), "R"))
            elif exits[q] < FAR:
                own.append((exits[q], target, ""))
            if k < n or last:  # inserts at a block's end belong to the next block
                own.append((INSERT, STATES * k + wanted(q), "I"))
    return arcs


def first_prices(rows: bytes, exits: tuple[int, ...]) -> list[int]:
    """What rows cost at least whatever is done: prices to start from."""
    price = min(exits)
    out = [price] * STATES
    for row in reversed(rows):
        price += DELETE if row & MUST_GO else TRUNCATED if row & CUT_OFF else 0
        out += [price] * STATES
    grouped = [out[i:i + STATES] for i in range(0, len(out), STATES)]
    return [p for group in reversed(grouped) for p in group] + [0]


def auction(arcs: list[list[Arc]], prices: list[int], origins: list[int]) -> None:
    """Raise ``prices`` until they are exact at every origin."""
    exact = {len(arcs)}
    for origin in origins:
        path = [origin]
        while path[-1] not in exact:
            node = path[-1]
            cost, end = min((c + prices[j], j) for c, j, _ in arcs[node])
            if prices[node] < cost:
                prices[node] = cost
                if node != origin:
                    path.pop()
            else:
                path.append(end)
        exact.add(origin)


def trace(arcs: list[list[Arc]], prices: list[int], origin: int) -> tuple[str, int]:
    """(least initials of the tight paths, state at the block's end)."""
    target = len(arcs)
    before: list[list[int]] = [[] for _ in range(target + 1)]
    for i, own in enumerate(arcs):
        for c, j, _ in own:
            if prices[i] == c + prices[j]:
                before[j].append(i)
    arrives, stack = {target}, [target]
    while stack:
        for i in before[stack.pop()]:
            if i not in arrives:
                arrives.add(i)
                stack.append(i)
    node, out = origin, []
    while True:
        # An initial leads from a node to one node only, so the least is one arc.
        initial, end = min((a, j) for c, j, a in arcs[node] if j in arrives and prices[node] == c + prices[j])
        if end == target:
            return "".join(out), node % STATES
        out.append(initial)
        node = end


@lru_cache(maxsize=1 << 14)
def _solved(rows: bytes) -> tuple[int, str]:
    finish = (0, FAR, FAR, 0)  # nothing put out, or the last was an assistant
    cuts = [*range(0, len(rows), BLOCK), len(rows)]
    blocks = list(zip(cuts[:-1], cuts[1:])) or [(0, 0)]
    exits, kept = finish, [finish]
    for lo, hi in reversed(blocks[1:]):
        part = rows[lo:hi]
        arcs, prices = lattice(part, exits, hi == len(rows)), first_prices(part, exits)
        auction(arcs, prices, list(range(STATES)))
        exits = tuple(prices[:STATES])
        kept.append(exits)
    state, audit, cost = 0, [], 0
    for (lo, hi), exits in zip(blocks, reversed(kept)):
        part = rows[lo:hi]
        arcs, prices = lattice(part, exits, hi == len(rows)), first_prices(part, exits)
        auction(arcs, prices, [state])
        if lo == 0:
            cost = prices[state]
        piece, state = trace(arcs, prices, state)
        audit.append(piece)
    return cost, "".join(audit)


def cheapest_edits(rows: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation given as one byte a row."""
    if not rows:
        return 0, ""
    return _solved(rows) if len(rows) <= BLOCK else _solved.__wrapped__(rows)


def applied(audit: str) -> Iterator[tuple[str, bool]]:
    """(initial, whether it takes a row) of each edit."""
    for a in audit:
        yield a, a != "I"


class Digest:
    """Repaired rows hashed as they come: ``role:text``, newline-joined."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.some = audit, 0, 0, False
        self.sha = hashlib.sha256()

    def _put(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.some else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.some = True

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = wanted(self.state)
            self._put("user" if self.state == USER else "assistant", "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = follows(self.state, ROLES[role[0]])
            self._put(role, text)
        elif edit == "R":
            self.state = wanted(self.state)
            self._put("user" if self.state == USER else "assistant", text)

    def done(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


FAULTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _examine(name: str):
    """Streams (id, turn, role, times, seen, blank, cut_off, real), sorted, to
    one row of findings a conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_ = None, False
        kept: list[tuple] = []

        def start():
            return {"rows": bytearray(), "low": None, "high": None, "turns": 0, "turn": None, "initial": None,
                    "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

        def finding(c) -> tuple:
            cost, audit = cheapest_edits(bytes(c["rows"]))
            gaps = min(c["high"] - c["low"] + 1 - c["turns"], (1 << 63) - 1) if c["turns"] else 0
            return (key, gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], cost, audit)

        def flush() -> pa.RecordBatch:
            cols = list(zip(*kept))
            types = [kind] + [pa.int64()] * 6 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              [name, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

        state, kind = start(), None
        for rb in batches:
            kind = rb.schema.field(0).type
            for ident, turn, role, times, seen, blank, cut_off, real in zip(*(c.to_pylist() for c in rb.columns)):
                if not open_ or ident != key:
                    if open_:
                        kept.append(finding(state))
                    key, open_, state = ident, True, start()
                if not real:
                    continue
                c = state
                initial = role[:1]
                if c["initial"] is not None and c["initial"] + initial not in LEGAL:
                    c["illegal"] += 1
                if initial + initial not in LEGAL:
                    c["illegal"] += times - 1
                c["initial"] = initial
                if turn is not None and turn != c["turn"]:
                    c["turns"] += 1
                    c["low"] = turn if c["low"] is None else c["low"]
                    c["turn"] = c["high"] = turn
                code = ROLES.get(initial, OTHER)
                if blank:
                    c["blank"] += times
                    c["rows"] += bytes([code | MUST_GO]) * times
                else:
                    again = times if seen else times - 1
                    c["duplicate"] += again
                    if not seen:
                        c["truncated"] += cut_off
                        c["rows"].append(code | (CUT_OFF if cut_off else 0))
                    c["rows"] += bytes([code | MUST_GO]) * again
            if len(kept) >= 1000:
                yield flush()
                kept.clear()
        if open_:
            kept.append(finding(state))
            yield flush()

    return run


def _digest(name: str):
    """Streams (id, head, audit, role, text), each conversation led by its
    audit, to (id, repaired_sha256)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, kept, kind = None, None, [], None

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], kind), pa.array([h for _, h in kept], pa.string())], [name, "repaired_sha256"])

        for rb in batches:
            kind = rb.schema.field(0).type
            for ident, head, audit, role, text in zip(*(c.to_pylist() for c in rb.columns)):
                if head:
                    if digest is not None:
                        kept.append((key, digest.done()))
                    key, digest = ident, Digest(audit)
                else:
                    digest.row(role, text)
            if len(kept) >= 1000:
                yield flush()
                kept.clear()
        if digest is not None:
            kept.append((key, digest.done()))
            yield flush()

    return run


def repair(rows: DataFrame, ids: DataFrame | None = None, id_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``rows`` (and of ``ids``, where given): id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, null turns first; equal turns by role, then by
    the hash of the text; rows equal in all of these are equal.  A null role
    or text counts as one space; a role of other than s, u or a at its start
    can only be reroled or deleted.  Null ids make one conversation.  Ids of
    ``ids`` without rows give zeros, an empty audit and the hash of nothing.
    Turns are integers; other columns are not read.
    """
    own = rows.select(F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"),
                      F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    sha = F.sha2(F.col("text").cast("binary"), 256)
    solid = F.rtrim(F.col("text"), F.lit(BLANKS))
    # Findings need a row's hash and flags only; equal rows are counted first.
    marks = (own.select("id", "turn", "role", sha.alias("sha"), (solid == "").alias("blank"), (~F.right(solid, F.lit(1)).isin(*STOPS)).alias("cut_off"))
             .groupBy("id", "turn", "role", "sha", "blank", "cut_off").agg(F.count("*").alias("times")))
    same = Window.partitionBy("id", "role", "sha").orderBy(F.asc_nulls_first("turn"))
    marks = marks.withColumn("seen", F.row_number().over(same) > 1).select("id", "turn", "role", "sha", "times", "seen", "blank", "cut_off", F.lit(True).alias("real"))
    if ids is not None:
        void = ids.select(F.col(id_col).alias("id")).distinct().select(
            "id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("sha"), F.lit(0).cast("long").alias("times"),
            F.lit(False).alias("seen"), F.lit(False).alias("blank"), F.lit(False).alias("cut_off"), F.lit(False).alias("real"))
        marks = marks.unionByName(void)
    order = ["id", F.asc_nulls_first("turn"), "role", "sha"]
    found = staged(marks.repartition("id").sortWithinPartitions(*order)
                   .select("id", "turn", "role", "times", "seen", "blank", "cut_off", "real")
                   .mapInArrow(_examine("id"), f"id {kind}, {FAULTS}"), "op12-found")
    none = F.lit(None)
    heads = found.select("id", F.lit(True).alias("head"), "audit", none.cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit("").alias("sha"))
    texts = own.select("id", F.lit(False).alias("head"), none.cast("string").alias("audit"), "turn", "role", "text", sha.alias("sha"))
    hashed = (heads.unionByName(texts).repartition("id").sortWithinPartitions("id", F.desc("head"), *order[1:])
              .select("id", "head", "audit", "role", "text").mapInArrow(_digest("id"), f"id {kind}, repaired_sha256 string"))
    other = hashed.select(F.col("id").alias("_id"), "repaired_sha256")
    return (found.join(other, F.col("id").eqNullSafe(F.col("_id"))).drop("_id").withColumnRenamed("id", id_col))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the CRC of ``conv_id:turn`` modulo
    20: rows dropped (0), emptied (1), without stops (2), doubled (3), of a
    user (4).  Nulls count as one space."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op12_repair(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair(damaged(rows), rows)


def _sql() -> str:
    def plus(s: str, cost: str, initial: str) -> str:
        return f"{{'c': {s}.c + {cost}, 'a': {s}.a || '{initial}'}}"

    def only(when: str, s: str) -> str:
        return f"CASE WHEN {when} THEN {s} ELSE {{'c': 1000000000::BIGINT, 'a': ''}} END"

    keep = {x: f"NOT must_go AND role[1] = '{x}'" for x in "sua"}
    rerole = [only("NOT must_go", plus(s, "3 + more", "R")) for s in ("s0", "s1", "s3", "s2")]
    r = {
        "r0": plus("s0", "4", "D"),
        "r1": f"least({plus('s1', '4', 'D')}, {only(keep['s'], plus('s0', 'more', 'K'))})",
        "r2": f"least({plus('s2', '4', 'D')}, " + ", ".join([only(keep["u"], plus(s, "more", "K")) for s in ("s0", "s1", "s3")] + rerole[:3]) + ")",
        "r3": f"least({plus('s3', '4', 'D')}, {only(keep['a'], plus('s2', 'more', 'K'))}, {rerole[3]})",
    }
    steps = ", ".join(f"{x} AS {k}" for k, x in r.items())
    closed = f"least(r2, {plus('r0', '3', 'I')}, {plus('r1', '3', 'I')}, {plus('r3', '3', 'I')})"
    close = f"SELECT conv_id, i, r0 AS s0, r1 AS s1, i2 AS s2, least(r3, {plus('i2', '3', 'I')}) AS s3 FROM (SELECT *, {closed} AS i2 FROM"
    far = "{'c': 1000000000::BIGINT, 'a': ''}"
    start = f"(SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS r0, {far} AS r1, {far} AS r2, {far} AS r3 FROM conversations)"
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS tab
  FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) t(i))),
hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda h: CAST(ord(h) AS BIGINT)),
                         lambda c, x: xor(c >> 8, tab[xor(c, x) % 256 + 1]), 4294967295), 4294967295) % 20 AS fault
  FROM conversations, crc),
rows_ AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM hit)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid FROM rows_),
faults AS (
  SELECT *, solid = '' AS blank, solid <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM placed),
r AS (
  SELECT *, blank OR duplicate AS must_go, NOT blank AND NOT duplicate AND right(solid, 1) NOT IN ('.', '!', '?') AS truncated,
         CASE WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS more FROM faults),
dp AS (
  {close} {start})
  UNION ALL
  {close} (SELECT dp.conv_id, r.i, {steps} FROM dp JOIN r ON r.conv_id = dp.conv_id AND r.i = dp.i + 1))),
found AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM r GROUP BY 1),
best AS (
  SELECT dp.conv_id, least(s0, s3) AS b FROM dp LEFT JOIN found USING (conv_id) WHERE dp.i = coalesce(n, 0)),
edits AS (SELECT conv_id, unnest(string_split(b.a, '')) AS e, generate_subscripts(string_split(b.a, ''), 1) AS p FROM best WHERE b.a <> ''),
spread AS (
  SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER o AS i, sum(CASE WHEN e <> 'D' THEN 1 ELSE 0 END) OVER o AS k FROM edits
  WINDOW o AS (PARTITION BY conv_id ORDER BY p)),
out_ AS (SELECT s.conv_id, e, p, k, r.role, r.text FROM spread s JOIN r ON r.conv_id = s.conv_id AND r.i = s.i WHERE e IN ('K', 'R')
         UNION ALL SELECT conv_id, e, p, k, '', '' FROM spread WHERE e = 'I'),
lead_ AS (SELECT *, max(CASE WHEN k = 1 AND e = 'K' AND role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS s FROM out_),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (k - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS t
  FROM lead_ GROUP BY 1)
SELECT best.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM best LEFT JOIN found USING (conv_id) LEFT JOIN texts USING (conv_id)
"""


OP12_SQL = _sql()
