"""Repair of conversations by a Viterbi search with few survivors.

A conversation should read as role initials `(s?(ua)+)?`: nothing, or a system turn at most and then user and
assistant in turns. Every row is kept, given another role or deleted, and empty turns may be inserted; the search has one
survivor for each state (nothing yet, after system, after user, after assistant). Their edits are paths in one tree
of back pointers. A node counts the children and the survivors that refer to it; one that nothing refers to goes, and as
soon as the root has a single child and no survivor all survivors share that edit, so it is written out and becomes
the root. A survivor that can't win any more, since another one could imitate each of its continuations at less
cost, is dropped, so the survivors soon share their past: memory holds the unresolved edits only, however long the
conversation. Survivors of equal cost are compared by their whole unresolved edits: at the node where the two
paths part, found by jump pointers, the smaller letter wins. (Neither can be a prefix of the other: both have
edited the same rows, so the longer one would have more insertions and cost more.)

Rows are dealt out by conversation and sorted, so a conversation is a stream through one task, which its
hash (of one text after another) demands; sorts spill, and the task holds what is unresolved and the edits' letters.

Definitions. Null roles, texts and ids in the damage's hash are one space; the null id is one conversation. Turns are
in ascending order, nulls first, rows of one turn by role and text. Equal rows are repeats of each other. An empty table
gives no rows. Columns beyond the four named ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm._frame import table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
ROLES = {"u": "user", "a": "assistant"}
WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after a role's initial, from each state that allows it.
AFTER = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: (x, y): cost of imitating any continuation of x from y, at most.
IMITATED = {
    (NOTHING, ASSISTANT): COST[DELETE], (NOTHING, USER): COST[INSERT] + COST[DELETE],
    (SYSTEM, ASSISTANT): 0, (SYSTEM, USER): COST[INSERT], (USER, ASSISTANT): COST[INSERT], (ASSISTANT, USER): COST[INSERT],
}


class Node:
    """An edit: its letter, the turn it leaves (None for a deletion), and what refers to it."""

    __slots__ = ("parent", "jump", "depth", "letter", "turn", "children", "heads")

    def __init__(self, parent: Node | None, letter: str, turn: tuple[str, str] | None):
        self.parent, self.letter, self.turn, self.heads = parent, letter, turn, 0
        self.children: dict[str, Node] = {}
        self.depth = parent.depth + 1 if parent else 0
        self.jump = self
        if parent:
            near = parent.jump
            far = near.jump
            self.jump = far if parent.depth - near.depth == near.depth - far.depth else parent


def above(node: Node, depth: int) -> Node:
    while node.depth > depth:
        node = node.jump if node.jump.depth >= depth else node.parent
    return node


def precedes(x: Node, y: Node) -> bool:
    """Do the letters of x's path come before those of y's? Neither path is a prefix of the other."""
    x, y = above(x, y.depth), above(y, x.depth)
    while x.parent is not y.parent:
        if x.jump is not y.jump and x.jump.depth == y.jump.depth:
            x, y = x.jump, y.jump
        else:
            x, y = x.parent, y.parent
    return x.letter < y.letter


class Search:
    """The survivors of one conversation; `emit` gets each edit once it is certain, as letter and turn."""

    def __init__(self, emit: Callable[[str, tuple[str, str] | None], None]):
        self.emit = emit
        self.root = Node(None, "", None)
        self.root.heads = 1
        self.best: dict[int, tuple[int, Node]] = {NOTHING: (0, self.root)}
        self.unresolved = 0  # nodes in the tree below its root
        self._next({NOTHING: (0, self.root)}, [])

    def _offer(self, found: dict, made: list, state: int, cost: int, parent: Node, letter: str, turn) -> None:
        have = found.get(state)
        if have is not None and have[0] < cost or letter in parent.children:
            return
        node = Node(parent, letter, turn)
        if have is None or cost < have[0] or precedes(node, have[1]):
            parent.children[letter] = node
            made.append(node)
            found[state] = (cost, node)

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        found: dict[int, tuple[int, Node]] = {}
        made: list[Node] = []
        extra = TRUNCATED if truncated else 0
        for state, (cost, node) in self.best.items():
            self._offer(found, made, state, cost + COST[DELETE], node, DELETE, None)
            if must_go:
                continue
            after = AFTER.get(role[:1], {}).get(state)
            if after is not None:
                self._offer(found, made, after, cost + COST[KEEP] + extra, node, KEEP, (role, text))
            for initial, name in ROLES.items():
                after = AFTER[initial].get(state)
                if after is not None:
                    self._offer(found, made, after, cost + COST[REROLE] + extra, node, REROLE, (name, text))
        self._next(found, made)

    def _next(self, found: dict[int, tuple[int, Node]], made: list[Node]) -> None:
        """Insertions after the last row; hopeless survivors go; certain edits are written out."""
        for _ in range(2):
            for state, (cost, node) in list(found.items()):
                for initial, name in ROLES.items():
                    after = AFTER[initial].get(state)
                    if after is not None:
                        self._offer(found, made, after, cost + COST[INSERT], node, INSERT, (name, ""))
        kept = {
            x: (cost, node) for x, (cost, node) in found.items()
            if not any((x, y) in IMITATED and cost > found[y][0] + IMITATED[x, y] for y in found)
        }
        old, self.best = [node for _, node in self.best.values()], kept
        for _, node in kept.values():
            node.heads += 1
        for node in old:
            node.heads -= 1
        self.unresolved += len(made)
        for node in [*reversed(made), *old]:
            while node is not self.root and not node.heads and not node.children and node.parent.children.get(node.letter) is node:
                del node.parent.children[node.letter]
                self.unresolved -= 1
                node = node.parent
        while len(self.root.children) == 1 and not self.root.heads:
            (only,) = self.root.children.values()
            self.emit(only.letter, only.turn)
            self.root.children.clear()
            only.parent = only.turn = None
            self.root = only
            self.unresolved -= 1

    def finish(self) -> int:
        """The cost of the cheapest whole repair; the rest of its edits is written out."""
        ends = [self.best[s] for s in (NOTHING, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or other_cost == cost and precedes(other, node):
                cost, node = other_cost, other
        rest = []
        while node is not self.root:
            rest.append(node)
            node = node.parent
        for edit in reversed(rest):
            self.emit(edit.letter, edit.turn)
        return cost


# -- rows ----------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, present): the rows after damage; dropped ones stay as marks of their conversation."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), shown("role").alias("role"),
        shown("text").alias("text"), kind.alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") != 0).alias("present"), F.explode(times).alias("time"),
    ).drop("time")


def arranged(rows: DataFrame) -> DataFrame:
    """Rows of whole conversations in order, in few streams, each with `repeated`: an equal role and text came before."""
    same = Window.partitionBy("conv", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    marked = rows.repartition("conv").withColumn("repeated", (F.row_number().over(same) > 1) & F.col("present"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "repeated"]
    return marked.select("conv", "turn", "role", "text", "present", "repeated").sortWithinPartitions(*order)


class Conversation:
    """Counts and repair of one conversation, row by row."""

    def __init__(self, emit):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.role = None
        self.search = Search(emit)

    def row(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        inner = text.strip(WHITE)
        blank = not inner
        duplicate = not blank and repeated
        truncated = not blank and not duplicate and inner[-1] not in ENDS
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if self.role is not None and self.role[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = role
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        self.search.row(role, text, blank or duplicate, truncated)

    @property
    def gaps(self) -> int:
        return self.last - self.first + 1 - self.turns if self.turns else 0


def streamed(batches: Iterator[pa.RecordBatch], begin: Callable, close: Callable) -> Iterator[dict | None]:
    """Runs the rows of each conversation; `begin` gives what takes its edits. Yields after each row: nothing, or at
    a conversation's end what `close` makes of it."""
    now = emit = name = None
    for batch in batches:
        for conv, turn, role, text, present, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv != name:
                if now is not None:
                    yield close(name, now, emit)
                name, emit = conv, begin(conv)
                now = Conversation(emit)
            if present:
                now.row(turn, role, text, repeated)
                yield None
    if now is not None:
        yield close(name, now, emit)


class Digest:
    """The edits' letters and the hash of the repaired turns."""

    def __init__(self, conv):
        self.letters, self.hash, self.empty = bytearray(), hashlib.sha256(), True

    def __call__(self, letter: str, turn: tuple[str, str] | None) -> None:
        self.letters += letter.encode()
        if turn is not None:
            self.hash.update(("" if self.empty else "\n").encode() + f"{turn[0]}:{turn[1]}".encode())
            self.empty = False


DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair_digests(rows: DataFrame) -> DataFrame:
    """A row for each conversation of (conv, turn, role, text, present): counts, cost, letters and hash."""

    def close(conv, now: Conversation, digest: Digest) -> dict:
        cost = now.search.finish()
        return {
            "conv": conv, "gaps": now.gaps, "blank": now.blank, "duplicate": now.duplicate, "truncated": now.truncated,
            "illegal": now.illegal, "cost": cost, "audit": digest.letters.decode(), "repaired_sha256": digest.hash.hexdigest(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed((row for row in streamed(batches, Digest, close) if row), schema)

    sorted_rows = arranged(rows)
    schema = pa.schema([(c, arrow) for c, arrow in zip(["conv", *NAMES], [to_arrow(sorted_rows, "conv"), *TYPES], strict=True)])
    return sorted_rows.mapInArrow(run, f"conv {rows.schema['conv'].dataType.simpleString()}, {DIGEST}")


NAMES = [part.split()[0] for part in DIGEST.split(", ")]
TYPES = [pa.int64() if part.split()[1] == "long" else pa.string() for part in DIGEST.split(", ")]


def to_arrow(frame: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(frame.schema[column].dataType)


def packed(rows: Iterator[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    block = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield pa.RecordBatch.from_pylist(block, schema=schema)
            block = []
    if block:
        yield pa.RecordBatch.from_pylist(block, schema=schema)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): the edits of each conversation of (conv, turn, role, text, present) in
    order, written out as they become certain; deletions have no role and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits: list[dict] = []

        class Rows:
            def __init__(self, conv):
                self.conv, self.place = conv, 0

            def __call__(self, letter: str, turn: tuple[str, str] | None) -> None:
                role, text = turn or (None, None)
                edits.append({"conv": self.conv, "place": self.place, "edit": letter, "role": role, "text": text})
                self.place += 1

        def each() -> Iterator[dict]:
            for _ in streamed(batches, Rows, lambda conv, now, emit: now.search.finish()):
                yield from edits
                edits.clear()

        yield from packed(each(), schema)

    sorted_rows = arranged(rows)
    kind = rows.schema["conv"].dataType.simpleString()
    schema = pa.schema([("conv", to_arrow(sorted_rows, "conv")), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    return sorted_rows.mapInArrow(run, f"conv {kind}, place long, edit string, role string, text string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    rows = damage(table(spark, sf_dir, "conversations"))
    return repair_digests(rows).withColumnRenamed("conv", "conv_id")
