"""Conversation structure repair with a survivor-coalescence Viterbi search.

A legal conversation is empty or has the role initials ``s?(ua)+``. Rows are
kept (cost 0), given the role user or assistant (3), deleted (4) or joined by
inserted rows without text (3); a row that is cut off costs 3 more unless it is
deleted, a blank row or a repeated one must be deleted. The cheapest edits win,
ties go to the ASCII-least string of edit initials.

The search walks the rows once. Four survivors stand for the states of the
pattern (nothing yet, after ``s``, after ``u``, after ``a``); their edits hang
in one tree of back pointers whose nodes count who refers to them. A node that
nobody refers to goes, and as soon as all survivors share an ancestor below the
root, the edits down to it are certain: they are emitted and forgotten. Equal
costs are settled by comparing both whole paths; for each two survivors, what
decides between their paths is carried from row to row.
A survivor that another one undercuts whatever follows (``_UNDERCUT``) is
dropped, so that "delete everything" doesn't keep the root open. Two paths of
equal cost to one state are never a prefix of each other (the longer one would
hold more inserts and cost more), so the least prefix stays least.

Rows are dealt by conversation and sorted; a task reads them as a stream and
holds the open edits of one conversation, never a conversation. Whether a row
repeats an earlier one is found before, by an aggregation of digests. One
conversation passes through one task as a stream, because its digest is one.

Defined cases: NULL role or text counts as one space; rows go by turn (NULL
first), then role and text; rows with NULL conv_id are one conversation; a
conversation whose rows are all absent has zeros, an empty audit and the hash
of the empty string; no rows give none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3  # costs
_START, _SYSTEM, _USER, _ASSISTANT = range(4)      # what was last put out
_TO_USER = (_START, _SYSTEM, _ASSISTANT)           # states that a user row may follow
#: (cheaper state, other state, most that the cheaper one pays to follow the other)
_UNDERCUT = ((_ASSISTANT, _START, DELETE), (_ASSISTANT, _SYSTEM, 0), (_START, _SYSTEM, 0))
_BLANK = " \t\n\x0b\x0c\r"

AUDIT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
         "repaired_sha256 string, most_open long")


class _Edit:
    """A node of the tree of back pointers."""

    __slots__ = ("above", "kind", "row", "below", "held")

    def __init__(self, above: _Edit | None, kind: str, row: tuple):
        self.above, self.kind, self.row, self.below, self.held = above, kind, row, [], 0
        if above is not None:
            above.below.append(self)


def _apart(a: str, b: str) -> tuple[str, str]:
    """What decides between two strings: their first letters that differ, or,
    if one begins with the other, the empty string and the rest."""
    k = 0
    while k < len(a) and k < len(b) and a[k] == b[k]:
        k += 1
    return (a[k], b[k]) if k < len(a) and k < len(b) else (a[k:], b[k:])


class Survivors:
    """Cheapest edits of one conversation, emitted as soon as they are certain.

    ``emit(kind, role, text)`` is called once for every edit, in order; role is
    None for a deleted row. A path that is still being weighed is
    (cost, state, kinds, rows): a survivor's path and up to three edits more.
    ``apart[x][y]`` is what decides between the whole paths of survivors x and
    y, carried along from row to row, so that a tie needs no walk back.
    """

    def __init__(self, emit: Callable[[str, str | None, str], None]):
        self.emit, self.open, self.most_open = emit, 0, 0
        self.root = _Edit(None, "", ())
        self.cost: list[int | None] = [0, None, None, None]
        self.last: list[_Edit | None] = [self.root, None, None, None]
        self.apart = [[("", "")] * 4 for _ in range(4)]
        self.root.held = 1
        self._settle([(0, _START, "", ()), None, None, None])

    def _decides(self, a: tuple, b: tuple) -> tuple[str, str]:
        x, y = self.apart[a[1]][b[1]]
        return _apart(x + a[2], y + b[2])

    def _better(self, new: tuple, old: tuple | None) -> bool:
        if old is None or new[0] != old[0]:
            return old is None or new[0] < old[0]
        x, y = self._decides(new, old)
        return x < y

    def _settle(self, best: list) -> None:
        """Insert rows where that is cheaper, drop paths that are undercut, grow
        the tree by the rest, and emit what all survivors share."""
        for frm, to, role in ((_START, _USER, "user"), (_SYSTEM, _USER, "user"), (_ASSISTANT, _USER, "user"), (_USER, _ASSISTANT, "assistant")):
            if best[frm] is not None:
                cost, state, kinds, rows = best[frm]
                new = (cost + INSERT, state, kinds + "I", (*rows, (role, "")))
                if self._better(new, best[to]):
                    best[to] = new
        for low, high, most in _UNDERCUT:
            if best[low] and best[high] and best[low][0] + most < best[high][0]:
                best[high] = None
        self.apart = [[self._decides(a, b) if a and b else ("", "") for b in best] for a in best]
        made: dict[tuple, _Edit] = {}
        before, self.last, self.cost = self.last, [None] * 4, [None] * 4
        for state, path in enumerate(best):
            if path is not None:
                self.cost[state], frm, kinds, rows = path
                node = before[frm]
                for k, row in enumerate(rows):
                    key = (frm, kinds[:k + 1])
                    if key not in made:
                        made[key] = _Edit(node, kinds[k], row)
                        self.open += 1
                    node = made[key]
                node.held += 1
                self.last[state] = node
        for node in before:
            if node is not None:
                node.held -= 1
                self._release(node)
        self.most_open = max(self.most_open, self.open)
        while not self.root.held and len(self.root.below) == 1:
            node = self.root.below[0]
            self.root.below, node.above, self.root = [], None, node
            self.open -= 1
            self.emit(node.kind, *node.row)

    def _release(self, node: _Edit) -> None:
        """Let nodes go that no survivor and no later edit refers to."""
        while node.above is not None and not node.held and not node.below:
            above = node.above
            above.below.remove(node)
            node.above = None
            self.open -= 1
            node = above

    def step(self, role: str, text: str, must_delete: bool, cut: bool) -> None:
        """One row of the conversation."""
        best: list = [None] * 4

        def offer(to: int, cost: int, frm: int, kind: str, row: tuple) -> None:
            new = (cost, frm, kind, (row,))
            if self._better(new, best[to]):
                best[to] = new

        initial, more = role[:1], CUT if cut else 0
        for state, cost in enumerate(self.cost):
            if cost is None:
                continue
            offer(state, cost + DELETE, state, "D", (None, ""))
            if must_delete:
                continue
            if initial == "s" and state == _START:
                offer(_SYSTEM, cost + KEEP + more, state, "K", (role, text))
            to, name = (_USER, "user") if state in _TO_USER else (_ASSISTANT, "assistant")
            if initial == name[0]:
                offer(to, cost + KEEP + more, state, "K", (role, text))
            else:
                offer(to, cost + REROLE + more, state, "R", (name, text))
        self._settle(best)

    def finish(self) -> int:
        """Emit the rest; the cost of all edits."""
        ends = [(self.cost[s], s, "", ()) for s in (_START, _ASSISTANT) if self.cost[s] is not None]
        best = ends[0]
        for end in ends[1:]:
            if self._better(end, best):
                best = end
        node, path = self.last[best[1]], []
        while node is not self.root:
            path.append(node)
            node = node.above
        for n in reversed(path):
            self.emit(n.kind, *n.row)
        return best[0]


class _Conversation:
    """Counts, edits and digests of one conversation, row by row."""

    def __init__(self, conv_id, each: Callable | None = None):
        self.conv_id, self.each, self.audit, self.hash, self.first = conv_id, each, [], hashlib.sha256(), True
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.before: tuple | None = None
        self.search = Survivors(self.emit)

    def emit(self, kind: str, role: str | None, text: str) -> None:
        self.audit.append(kind)
        if role is not None:
            self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.first = False
        if self.each is not None:
            self.each(self.conv_id, len(self.audit) - 1, kind, role, text)

    def row(self, turn, role: str, text: str, later: bool) -> None:
        last = text.rstrip(_BLANK)[-1:]
        blank = last == ""
        duplicate = not blank and (later or self.before == (turn, role, text))
        cut = not blank and not duplicate and last not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + cut
        if self.before is not None and self.before[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.before = (turn, role, text)
        self.search.step(role, text, blank or duplicate, cut)

    def result(self) -> tuple:
        cost = self.search.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit),
                self.hash.hexdigest(), self.search.most_open)


def in_order(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """Rows dealt by conversation and sorted, with ``later``: whether a row of
    a smaller turn says the same in the same role."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    r = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"),
                    (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"))
    r = r.withColumn("digest", F.sha2(F.col("text"), 256)).withColumn("at", F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    same = (r.filter("present").groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first"), F.max("at").alias("end"))
            .filter(F.col("first") < F.col("end")).select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    r = r.join(same, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    r = r.select("conv_id", "turn", "role", "text", "present", F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("later"))
    return r.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")


_NONE = object()


def _walk(batches: Iterator[pa.RecordBatch], each: Callable | None) -> Iterator[list[tuple]]:
    """Results of the conversations of one sorted stream, batch by batch."""
    now = None
    done: list[tuple] = []
    for b in batches:
        for conv, turn, role, text, present, later in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "later"))):
            if now is None or (now.conv_id != conv):
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv, each)
            if present:
                now.row(turn, role, text, later)
        yield done
        done = []
    if now is not None:
        yield [now.result()]


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def audit_conversations(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row (``AUDIT``) per conv_id of ``rows`` (conv_id, turn, role, text);
    rows for which ``present`` is not true only name their conversation."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(AUDIT))
    return in_order(rows, present).mapInArrow(lambda it: (_as_batch(got, schema) for got in _walk(it, None) if got), AUDIT)


REPAIRED = "conv_id long, step long, edit string, role string, text string"


def repaired_turns(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per edit (``REPAIRED``); role and text are those of the repaired
    conversation, role is NULL for deleted rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(REPAIRED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _ in _walk(batches, lambda *edit: out.append(edit)):
            yield _as_batch(out, schema)
            out.clear()

    return in_order(rows, present).mapInArrow(run, REPAIRED)
