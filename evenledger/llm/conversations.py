"""Cheapest repair of conversations by the auction algorithm for shortest paths.

A conversation is a lattice: node (i, s) says that i of its rows are dealt with and that the roles written so far end in
state s of the pattern ``(s?(ua)+)?`` (0 nothing, 1 after the system row, 2 after a user, 3 after an assistant). Edits
are arcs with integer costs. The auction keeps a price for every node, none above the price of an arc's head plus its
cost. A path grows from its end along a tight arc (price = cost + price of the head); without one the end's price rises
to the least such sum and the path shrinks. Origins are served from the last row back, and a path ends where it meets a
node with a final price, so every node's price becomes its distance to the end. Arcs tight under these prices are
exactly those of cheapest repairs; following the least letter among them gives the least audit string.

Conversations may be of any length. Rows are dealt out by ranges of (conversation, turn, role, text) and streamed; a
conversation that is longer than a piece or reaches over the edge of a task becomes several pieces, whose costs from
each state to each state are joined first, whose paths are traced next for each state they may be entered in, and whose
texts are read in order last. No task holds more than a piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenledger.llm.common import drop_saved, saved

PIECE_ROWS = 2048
FAR = 1 << 60
STATES = range(4)
#: The state after a role's initial, the role that an inserted or renamed row gets, and the states within reach.
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = ("user", "user", "assistant", "user")
REACHED = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
CLOSED = (0, FAR, FAR, 0)
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

PIECES = (
    "conv_id {conv}, piece long, closed boolean, n long, blank long, duplicate long, truncated long, illegal long, "
    "first_turn long, last_turn long, turns long, first_role string, last_role string, cost long, audit string, "
    "repaired_sha256 string, costs array<long>, signature string, roles array<string>, texts array<string>"
)


def arcs(signature: str, node: int, last: bool, ends: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """(letter, cost, head) of a node's arcs, by letter. Two characters a row: role initial (``o``: another) and fault
    (``x``: must be deleted, ``t``: truncated). Head -1 is the end."""
    i, state = divmod(node, 4)
    found = []
    rows = len(signature) // 2
    to = AFTER[state, WANTED[state][0]]
    if i < rows:
        found.append(("D", DELETE, node + 4))
    if i < rows or last:
        found.append(("I", INSERT, 4 * i + to))
    if i < rows:
        initial, fault = signature[2 * i : 2 * i + 2]
        if fault != "x":
            more = TRUNCATED * (fault == "t")
            if (state, initial) in AFTER:
                found.append(("K", more, 4 * (i + 1) + AFTER[state, initial]))
            found.append(("R", REROLE + more, 4 * (i + 1) + to))
    elif ends[state] < FAR:
        found.append(("", ends[state], -1))
    return found


def auction(signature: str, ends: tuple[int, ...], last: bool) -> list[int]:
    """The distance of every node to the end, which the states after the last row reach at the given costs."""
    size = 4 * (len(signature) // 2 + 1)
    prices, final = [0] * size + [0], [False] * size + [True]  # the end is at -1
    open_ends = {s for s in STATES if ends[s] < FAR}
    for origin in range(size - 1, -1, -1):
        path = [origin]
        while not final[path[-1]]:
            node = path[-1]
            reach = open_ends.intersection(REACHED[node % 4]) if node < size - 4 or last else open_ends.intersection([node % 4])
            least, head = min(((cost + prices[to], to) for _, cost, to in arcs(signature, node, last, ends)), default=(FAR, -1)) if reach else (FAR, -1)
            if least >= FAR:
                prices[node], final[node] = FAR, True
            elif prices[node] < least:  # contraction
                prices[node] = least
                if len(path) > 1:
                    path.pop()
            else:  # extension
                path.append(head)
        if prices[path[-1]] >= FAR:
            final[origin], prices[origin] = True, FAR
        for node in path:
            final[node] = True
    return prices


@lru_cache(maxsize=20_000)
def solve(signature: str, ends: tuple[int, ...] = CLOSED, last: bool = True) -> tuple:
    """(cost, audit, state at the end) for each state of entry; None where the end is out of reach."""
    prices, found = auction(signature, ends, last), []
    for node in STATES:
        cost, letters = prices[node], []
        if cost >= FAR:
            found.append(None)
            continue
        while node >= 0:
            state = node % 4
            letter, _, node = next(a for a in arcs(signature, node, last, ends) if a[1] + prices[a[2]] == prices[node])
            letters.append(letter)
        found.append((cost, "".join(letters), state))
    return tuple(found)


def repaired(audit: str, state: int, rows) -> Iterator[str]:
    """``role:text`` of the rows that the edits leave, from a state of entry."""
    rows = iter(rows)
    for letter in audit:
        role, text = next(rows) if letter != "I" else (None, "")
        if letter == "D":
            continue
        wanted = WANTED[state] if letter in "IR" else role
        state = AFTER[state, wanted[0]]
        yield f"{wanted}:{text}"


def digest(lines) -> str:
    """SHA-256 of the lines joined by line feeds."""
    made = hashlib.sha256()
    for k, line in enumerate(lines):
        made.update(("\n" * bool(k) + line).encode("utf-8", "surrogatepass"))
    return made.hexdigest()


class Piece:
    """Neighbouring rows of one conversation."""

    def __init__(self, conv, open_start: bool):
        self.conv, self.open_start, self.rows, self.signature = conv, open_start, [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, initial: str, fault: str) -> None:
        self.blank += fault == "b"
        self.duplicate += fault == "d"
        self.truncated += fault == "t"
        if self.signature:
            self.illegal += (self.signature[-1][0], initial) not in LEGAL
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.rows.append((role, text))
        self.signature.append(initial + ("x" if fault in "bd" else fault))

    def row(self, number: int, closed: bool) -> tuple:
        signature = "".join(self.signature)
        ends = [self.signature[0][0], self.signature[-1][0]] if self.signature else [None, None]
        head = (self.conv, number, closed, len(self.rows), self.blank, self.duplicate, self.truncated, self.illegal)
        head += (self.first_turn, self.last_turn, self.turns, *ends)
        if closed:
            cost, audit, _ = solve(signature)[0]
            return (*head, cost, audit, digest(repaired(audit, 0, self.rows)), None, None, None, None)
        costs = [[x[0] if (x := found) else FAR for found in solve(signature, tuple(0 if s == end else FAR for s in STATES), False)] for end in STATES]
        by_entry = [costs[end][entry] for entry in STATES for end in STATES]
        return (*head, None, None, None, by_entry, signature, [r for r, _ in self.rows], [t for _, t in self.rows])


def piece_batches(batches, rows: int, schema: pa.Schema):
    """Pieces of sorted rows. A conversation that lies wholly inside the task and in one piece is solved at once."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    now, out = None, []

    def made(piece: Piece, closed: bool):
        nonlocal number
        out.append(piece.row(number, closed))
        number += 1

    def flushed():
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return batch

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "here", "turn", "role", "text", "initial", "fault", "copies")]
        for conv, here, turn, role, text, initial, fault, copies in zip(*columns):
            if now is None or conv != now.conv:
                if now is not None:
                    made(now, not now.open_start)
                now = Piece(conv, now is None)
            if not here:
                continue
            for copy in range(copies):
                if len(now.rows) == rows:
                    made(now, False)
                    now = Piece(conv, True)
                again = "d" if copy and fault != "b" else fault
                now.add(turn, role, text, initial, again)
            if out and (len(out) >= 200 or not out[-1][2]):
                yield flushed()
    if now is not None:
        made(now, False)
        yield flushed()


def joined_costs(pieces: pd.DataFrame) -> pd.DataFrame:
    """For the pieces of a conversation, in order: what the rest costs from each state after them, and its totals."""
    pieces = pieces.sort_values("piece")
    ends = tuple(x[0] if x else FAR for x in solve(""))
    every, illegal, turns, before, role = [], 0, 0, None, None
    for costs in reversed(pieces["costs"].tolist()):
        every.append(list(ends))
        ends = tuple(min(min(FAR, costs[4 * entry + end] + ends[end]) for end in STATES) for entry in STATES)
    for piece in pieces.itertuples():
        if piece.n:
            illegal += piece.illegal + (role is not None and (role, piece.first_role) not in LEGAL)
            role = piece.last_role
        if piece.turns:
            turns += piece.turns - (before is not None and int(piece.first_turn) == before)
            before = int(piece.last_turn)
    firsts, lasts = pieces["first_turn"].dropna(), pieces["last_turn"].dropna()
    gaps = int(lasts.max()) - int(firsts.min()) + 1 - turns if len(firsts) else 0
    totals = {c: int(pieces[c].sum()) for c in ("blank", "duplicate", "truncated")}
    return pd.DataFrame({"piece": pieces["piece"], "ends": every[::-1], "gaps": gaps, "illegal": int(illegal), "cost": ends[0], **totals})


def traced_batches(batches, schema: pa.Schema):
    """Each piece's letters and last state for every state of entry, under the prices of what follows."""
    for batch in batches:
        numbers, signatures, ends = (batch.column(c).to_pylist() for c in ("piece", "signature", "ends"))
        found = [solve(s, tuple(min(e, FAR) for e in end), False) for s, end in zip(signatures, ends)]
        audits = [[x[1] if x else None for x in f] for f in found]
        states = [[x[2] if x else None for x in f] for f in found]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((numbers, audits, states), schema)], schema=schema)


def entries(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece of a conversation is entered, and the one after it."""
    pieces = pieces.sort_values("piece")
    state, found = 0, []
    for states in pieces["states"]:
        found.append(state)
        state = int(states[state])
    return pd.DataFrame({"piece": pieces["piece"], "entry": found, "left": [*found[1:], state]})


def assembled_batches(batches, schema: pa.Schema):
    """(conv_id, totals, audit, hash) of conversations whose pieces stream by in order."""
    conv, made, audit, at, totals, state = None, None, [], 0, None, 0

    def closing():
        cost, rest, _ = solve("")[state]
        for line in repaired(rest, state, ()):
            made.update(("\n" * bool(at) + line).encode("utf-8", "surrogatepass"))
        row = (conv, *totals, "".join(audit) + rest, made.hexdigest())
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

    for batch in batches:
        names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audits", "entry", "left", "roles", "texts")
        for key, *now, audits, entry, left, roles, texts in zip(*(batch.column(c).to_pylist() for c in names)):
            if made is None or key != conv:
                if made is not None:
                    yield closing()
                conv, made, audit, at = key, hashlib.sha256(), [], 0
            totals, state = now, left
            audit.append(audits[entry])
            for line in repaired(audits[entry], entry, zip(roles, texts)):
                made.update(("\n" * bool(at) + line).encode("utf-8", "surrogatepass"))
                at += 1
    if made is not None:
        yield closing()


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, here, turn, role, text, initial, fault (``b``, ``d``, ``t`` or ``-``) and copies of every different row.

    Equal rows of one turn become one with its number of copies, so that no key has more rows than different texts.
    """
    kinds = rows.groupBy("conv_id", "here", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    same = [F.col("conv_id"), F.col("role"), F.sha2("text", 256).alias("print")]
    order = F.struct(F.col("turn").isNotNull().alias("a"), F.coalesce("turn", F.lit(0)).alias("b"))
    first = kinds.where("here").groupBy(*same).agg(F.min(order).alias("first")).toDF("_conv", "_role", "_print", "first")
    met = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.sha2("text", 256) == F.col("_print"))
    solid, stop = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
    fault: Column = (
        F.when(~F.col("text").rlike(solid), "b").when(order > F.col("first"), "d").when(~F.col("text").rlike(stop), "t").otherwise("-")
    )
    initial = F.substring("role", 1, 1)
    return kinds.join(first, met, "left").select(
        "conv_id", "here", "turn", "role", "text", "copies",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        fault.alias("fault"),
    )


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None,
    copies: str | None = None, piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    Rows stand by turn (nulls first), then role and text. A row counts for its first fault: blank (only white space),
    duplicate (role and text seen before), truncated (its last solid character is none of ``.!?``). ``illegal`` counts
    neighbours whose role initials are not su, ua or au, ``gaps`` the turns missing between the least and the greatest
    (null turns do not count). The audit has one letter an edit: Keep (0), Rerole to user or assistant (2), Delete (3;
    the only edit of a blank or duplicate row), Insert an empty user or assistant row (2); a truncated row that stays
    costs 1 more. It is the cheapest that leads to the role initials ``(s?(ua)+)?``, of several the least in ASCII order.
    ``repaired_sha256`` is the hash of ``role:text`` of the repaired rows, joined by line feeds.

    Null roles and texts count as one space; a null conversation is one conversation. Where ``present`` is given, rows
    for which it is not true only announce their conversation: one without rows has zeros, an empty audit and the hash
    of an empty string. ``copies`` (a positive number, null as 1) says how often a row stands there. Other columns are
    not read, and an empty table gives an empty one.
    """
    here = F.coalesce(F.col(f"`{present}`"), F.lit(False)) if present else F.lit(True)
    blank = F.lit(" ")
    given = rows.select(
        F.col(f"`{conv}`").alias("conv_id"),
        here.alias("here"),
        F.when(here, F.col(f"`{turn}`").cast("long")).alias("turn"),
        F.when(here, F.coalesce(F.col(f"`{role}`"), blank)).alias("role"),
        F.when(here, F.coalesce(F.col(f"`{text}`"), blank)).alias("text"),
        (F.coalesce(F.col(f"`{copies}`").cast("long"), F.lit(1)) if copies else F.lit(1).cast("long")).alias("copies"),
    )
    order = ["conv_id", "turn", "role", "text"]
    ranged = faults(given).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = given.schema["conv_id"].dataType
    ddl = PIECES.format(conv=kind.simpleString())
    found = saved(ranged.mapInArrow(partial(piece_batches, rows=piece_rows, schema=_arrow(rows, ddl)), ddl), "pieces")

    result = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    gaps = F.when(F.col("turns") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).otherwise(F.lit(0).cast("long"))
    closed = found.where("closed").withColumn("gaps", gaps).select(*result)

    pieces = found.where("not closed")
    small = pieces.select("conv_id", "piece", "n", "blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns", "first_role", "last_role", "costs")
    totals = "piece long, ends array<long>, gaps long, illegal long, cost long, blank long, duplicate long, truncated long"
    after = saved(small.groupBy("conv_id").applyInPandas(joined_costs, totals), "costs")
    ddl = "piece long, audits array<string>, states array<int>"
    traces = pieces.select("piece", "signature").join(after.select("piece", "ends"), "piece").mapInArrow(partial(traced_batches, schema=_arrow(rows, ddl)), ddl)
    traces = saved(traces, "traces")
    way = pieces.select("conv_id", "piece").join(traces.select("piece", "states"), "piece").groupBy("conv_id").applyInPandas(entries, "piece long, entry int, left int")
    whole = pieces.select("conv_id", "piece", "roles", "texts").join(after.drop("ends"), "piece").join(traces.select("piece", "audits"), "piece").join(way, "piece")
    ddl = f"conv_id {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    streamed = whole.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    long = saved(streamed.mapInArrow(partial(assembled_batches, schema=_arrow(rows, ddl)), ddl), "long")
    drop_saved(after, traces)
    return closed.unionByName(long)


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
