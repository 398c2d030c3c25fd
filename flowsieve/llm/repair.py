"""Conversation repair: a streaming Viterbi search that emits edits as soon as all survivors agree on them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.batches import small_batches

#: Cost of each edit; Keep is free, and a truncated turn that stays adds one.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn. The first and last may end.
NONE, SYSTEM, USER, ASSISTANT = range(4)
_BEFORE_USER = (NONE, SYSTEM, ASSISTANT)
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, copies: the rows after damage by the hash of conversation and turn; 0 copies are dropped."""
    name = F.concat(F.coalesce(F.col(conv).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    slot = F.crc32(name.cast("binary")) % 20
    said, who = F.coalesce(F.col(text).cast("string"), F.lit(" ")), F.coalesce(F.col(role).cast("string"), F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(slot == 4, F.lit("user")).otherwise(who).alias("role"),
        F.when(slot == 1, F.lit("")).when(slot == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(slot == 0, 0).when(slot == 3, 2).otherwise(1).alias("copies"),
    )


def _stream(rows: DataFrame) -> DataFrame:
    """conv, turn, kind, role, text, digest in the order of the search.

    Kind 0 tells that a conversation exists, kind 1 that a turn's role and text came earlier, kind 2 is a turn. What
    came earlier is found on digests alone: least turn per conversation, role and text, combined map-side.
    """
    there = rows.filter("copies > 0")
    keyed = there.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(
        "conv", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    )
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    first = (
        keyed.groupBy("conv", "role", "digest")
        .agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .filter("first < last")
        .select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    repeated = keyed.join(first, same).filter(at > F.col("first")).select("conv", "turn", "role", "digest").distinct()
    nothing, no_digest = F.lit(None).cast("string"), F.lit(None).cast("binary")
    return (
        rows.filter("copies = 0").select("conv", "turn", F.lit(0).alias("kind"), nothing.alias("role"), nothing.alias("text"), no_digest.alias("digest"))
        .unionByName(repeated.select("conv", "turn", F.lit(1).alias("kind"), "role", nothing.alias("text"), "digest"))
        .unionByName(
            there.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
                "conv", "turn", F.lit(2).alias("kind"), "role", "text", no_digest.alias("digest")
            )
        )
    )


@dataclass(eq=False)
class Node:
    """A stretch of edits between two branchings of the survivors' tree; ``refs`` counts children and survivors."""

    parent: Node | None = None
    letters: bytearray = field(default_factory=bytearray)
    said: list[tuple[str, str]] = field(default_factory=list)
    refs: int = 0
    children: set[Node] = field(default_factory=set)


def _path(node: Node) -> list[Node]:
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out[::-1]


def _letters_after(path: list[Node], shared: int, last: bytes):
    for node in path[shared:]:
        for low in range(0, len(node.letters), 64):
            yield bytes(node.letters[low : low + 64])
    yield last


def smaller(a: Node, x: bytes, b: Node, y: bytes) -> bool:
    """Whether the edits up to ``a`` and then ``x`` come before those up to ``b`` and then ``y``.

    Only what follows the last common node is compared, but all of it.
    """
    one, other = _path(a), _path(b)
    shared = 0
    while shared < min(len(one), len(other)) and one[shared] is other[shared]:
        shared += 1
    left, right = _letters_after(one, shared, x), _letters_after(other, shared, y)
    p, q = b"", b""
    while True:
        p, q = p or next(left, b""), q or next(right, b"")
        if not p or not q:
            return not p and bool(q)
        n = min(len(p), len(q))
        if p[:n] != q[:n]:
            return p[:n] < q[:n]
        p, q = p[n:], q[n:]


class Search:
    """Viterbi search over the turns of one conversation, in order; ``audit`` and ``repaired`` grow as edits settle."""

    def __init__(self):
        self.root = Node(refs=1)
        self.best: dict[int, tuple[int, Node]] = {NONE: (0, self.root)}
        self.audit, self.repaired, self.lines = bytearray(), hashlib.sha256(), 0
        self._inserted()

    def add(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """The next turn: kept, given another role or deleted; then turns may be inserted after it."""
        offers: dict[int, list] = {}
        extra = TRUNCATED if truncated else 0
        for state, (cost, node) in self.best.items():
            offers.setdefault(state, []).append((cost + DELETE, node, b"D", None))
            if must_go:
                continue
            target, name = (USER, "user") if state in _BEFORE_USER else (ASSISTANT, "assistant")
            if role[:1] == name[:1]:
                offers.setdefault(target, []).append((cost + extra, node, b"K", (role, text)))
            elif role[:1] == "s" and state == NONE:
                offers.setdefault(SYSTEM, []).append((cost + extra, node, b"K", (role, text)))
            offers.setdefault(target, []).append((cost + REROLE + extra, node, b"R", (name, text)))
        chosen = {}
        for state, every in offers.items():
            best = every[0]
            for other in every[1:]:
                if other[0] < best[0] or (other[0] == best[0] and smaller(other[1], other[2], best[1], best[2])):
                    best = other
            chosen[state] = best
        self._grow({state: (cost, node, letter, said) for state, (cost, node, letter, said) in chosen.items()})
        self._inserted()
        self._drop_hopeless()
        self._settle()

    def finish(self) -> int:
        """The least cost; afterwards ``audit`` and ``repaired`` are complete."""
        ends = [self.best[s] for s in (NONE, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or (other_cost == cost and smaller(other, b"", node, b"")):
                cost, node = other_cost, other
        for part in _path(node):
            self._emit(part)
        return cost

    def _grow(self, chosen: dict[int, tuple]) -> None:
        """Replace all survivors by the chosen (cost, node, letter, said)."""
        old = [node for _, node in self.best.values()]
        new: dict[int, tuple[int, Node]] = {}
        for state, (cost, node, letter, said) in chosen.items():
            child = Node(node, bytearray(letter), [said] if said else [], 1)
            node.refs += 1
            node.children.add(child)
            new[state] = (cost, child)
        self.best = new
        for node in old:
            self._release(node)
        for _, node in new.values():
            self._join(node.parent)

    def _inserted(self) -> None:
        """Let every state be reached by inserted turns as well, until nothing gets better."""
        changed = True
        while changed:
            changed = False
            for state in list(self.best):
                target, name = (USER, "user") if state in _BEFORE_USER else (ASSISTANT, "assistant")
                cost, node = self.best[state]
                have = self.best.get(target)
                if have and (have[0] < cost + INSERT or (have[0] == cost + INSERT and not smaller(node, b"I", have[1], b""))):
                    continue
                child = Node(node, bytearray(b"I"), [(name, "")], 1)
                node.refs += 1
                node.children.add(child)
                self.best[target] = (cost + INSERT, child)
                if have:
                    self._release(have[1])
                changed = True

    def _drop_hopeless(self) -> None:
        """A survivor goes if the one after an assistant turn can follow all its ways and still be cheaper.

        It can do without the system turn that only an empty beginning may keep, at the price of a deletion.
        """
        if ASSISTANT in self.best:
            for state, allowance in ((NONE, DELETE), (SYSTEM, 0)):
                if state in self.best and self.best[state][0] > self.best[ASSISTANT][0] + allowance:
                    self._release(self.best.pop(state)[1])

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node.parent is not None:
            parent = node.parent
            parent.children.discard(node)
            parent.refs -= 1
            node = parent
        self._join(node)

    def _join(self, node: Node) -> None:
        """An inner node with one reference left, its child, becomes one with it."""
        if node.refs == 1 and len(node.children) == 1 and node is not self.root:
            (child,) = node.children
            node.letters += child.letters
            node.said += child.said
            node.refs, node.children = child.refs, child.children
            for grandchild in child.children:
                grandchild.parent = node
            for state, (cost, survivor) in self.best.items():
                if survivor is child:
                    self.best[state] = (cost, node)

    def _settle(self) -> None:
        """While all survivors share the root's only child, its edits are final."""
        while self.root.refs == 1 and len(self.root.children) == 1:
            self._emit(self.root)
            (self.root,) = self.root.children
            self.root.parent = None
        if not any(node is self.root for _, node in self.best.values()):
            self._emit(self.root)
            self.root.letters, self.root.said = bytearray(), []

    def _emit(self, node: Node) -> None:
        self.audit += node.letters
        for role, text in node.said:
            self.repaired.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.lines += 1

    def pending(self) -> int:
        """Edits that are not final yet."""
        seen, total = set(), 0
        for _, node in self.best.values():
            for part in _path(node):
                if id(part) not in seen:
                    seen.add(id(part))
                    total += len(part.letters)
        return total


class Audit:
    """Counts and search of one conversation."""

    def __init__(self):
        self.search = Search()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last = self.initial = None
        self.repeats: set[tuple[str, bytes]] = set()
        self.at, self.before = None, None

    def mark(self, turn, role: str, digest: bytes) -> None:
        if self.at != (turn,):
            self.at, self.repeats = (turn,), set()
        self.repeats.add((role, digest))

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        said = text.strip(_SPACE)
        blank = not said
        repeated = self.before == (turn, role, text) or (
            self.at == (turn,) and (role, hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()) in self.repeats
        )
        self.before = (turn, role, text)
        duplicate = repeated and not blank
        truncated = not blank and not duplicate and said[-1] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.search.add(role, text, blank or duplicate, truncated)

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        cost = self.search.finish()
        return (
            gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, self.search.audit.decode(),
            self.search.repaired.hexdigest(),
        )


_COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(rows: DataFrame) -> DataFrame:
    """conv and its counts, cost, audit and digest, of rows (conv, turn, role, text, copies)."""
    stream = _stream(rows)
    ordered = stream.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "kind", "role", "text")
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches):
        audit, name, first = None, None, True

        def out(batch_type, done):
            columns = [pa.array([d[0] for d in done], batch_type)]
            columns += [pa.array([d[1][k] for d in done], pa.int64() if k < 6 else pa.string()) for k in range(8)]
            return pa.RecordBatch.from_arrays(columns, names=["conv", *_COLUMNS])

        batch_type = None
        for batch in batches:
            batch_type, done = batch.schema.field(0).type, []
            for conv, turn, what, role, text, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if first or conv != name:
                    if not first:
                        done.append((name, audit.row()))
                    audit, name, first = Audit(), conv, False
                if what == 1:
                    audit.mark(turn, role, digest)
                elif what == 2:
                    audit.add(turn, role, text)
            yield out(batch_type, done)
        if not first:
            yield out(batch_type, [(name, audit.row())])

    return ordered.mapInArrow(
        run, f"conv {kind}, " + ", ".join(f"{c} {'long' if k < 6 else 'string'}" for k, c in enumerate(_COLUMNS))
    )


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its identifier, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are damaged by their hash first. Turns are then kept, given another role, deleted or inserted so that role
    initials read system? (user assistant)*, at the least cost; of equal costs the audit that sorts first wins. The
    search walks a conversation once. It holds four survivors in a tree of back pointers with reference counts: when
    all of them share an ancestor the edits up to it are final, are hashed and forgotten.

    The digest chains all turns of a conversation, so one conversation is one task's stream, however long; that task
    holds one Arrow batch, the unsettled edits and a letter per edit.

    Nulls count as one space, also in the hashed name; a null conversation is one conversation. Turns come in order,
    nulls first, and by role and text where a turn number repeats; rows that repeat turn, role and text are
    duplicates of the first. A role without a usable first letter cannot be kept. A conversation without rows after
    damage has zeros, no audit and the digest of nothing. Other columns are not read. An empty table gives no rows.
    """
    small_batches(rows.sparkSession)
    return repaired(damaged(rows, conv, turn, role, text)).withColumnRenamed("conv", conv)
