"""Conversation structure repair: the cheapest edits that make each conversation alternate between user and assistant.

Rows are shuffled by conversation and sorted by turn; a task streams them and runs a dynamic program over four states (nothing yet,
after a system turn, after a user, after an assistant).  The edits of a state are a node of a persistent trie: states that come from one
another share their prefix, a node knows its parent, a jump pointer (binary lifting, one ancestor for each node) and a rolling hash of
its prefix.  Of two equally cheap states the one of the ASCII-least edits stays: their longest common prefix is searched by hashes along
the jumps, and an equal hash is verified letter by letter down to nodes known to be equal, once for each pair.  A state also carries the
running SHA-256 of its repaired text, so no text is held, however long the conversation; of the edits only those on which the states
still differ stay in the trie.  Repeated turns are found by a shuffle on conversation, role and text, so no task holds what was seen.

All rows of a conversation pass through one task one after the other, since a digest of their joined texts can be had in no other way;
the task's memory does not grow with them, but for the one letter a row that the result holds.

Defined cases: null roles and texts are one space, and so are null ids and turns in the damage's key; a null conv_id is a conversation;
rows of one turn are taken in order of role, then text; an empty role fits no place and has to be changed or deleted; conversations
without rows after the damage have zeros, an empty audit and the hash of nothing; very long texts pass through as they are; an empty
table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._scratch import Scratch, settings

KEEP, REROLE, DELETE, INSERT = b"KRDI"
#: Costs of an edit, and of a truncated turn that stays.
COST = {"rerole": 2, "delete": 3, "insert": 2, "truncated": 1}
_BLANK = " \t\n\x0b\x0c\r"
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state after a role's initial.
_AFTER = {(_NONE, "s"): _SYSTEM, (_NONE, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: b"user", _ASSISTANT: b"assistant"}
_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E68B
_BATCH_BYTES = 4_000_000


class Trie:
    """Strings as nodes that share their prefixes; node 0 is the empty one."""

    #: Nodes after which what all live strings share is written out.
    MOST = 1 << 16

    def __init__(self):
        self.done = bytearray()
        self._clear()
        self._due = self.MOST

    def _clear(self) -> None:
        self.up, self.jump, self.depth, self.hash, self.same = array("l", [0]), array("l", [0]), array("l", [0]), array("q", [0]), array("l", [0])
        self.letter = bytearray(1)

    def push(self, node: int, letter: int) -> int:
        far = self.jump[node]
        # the jumps' lengths follow the skew binary numbers, so nodes of one depth jump to one depth
        jump = self.jump[far] if self.depth[node] - self.depth[far] == self.depth[far] - self.depth[self.jump[far]] else node
        self.up.append(node)
        self.jump.append(jump)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + letter) % _PRIME)
        self.letter.append(letter)
        self.same.append(len(self.same))
        return len(self.up) - 1

    def at(self, node: int, depth: int) -> int:
        """The prefix of so many letters."""
        while self.depth[node] > depth:
            node = self.jump[node] if self.depth[self.jump[node]] >= depth else self.up[node]
        return node

    def _root(self, x: int) -> int:
        while self.same[x] != x:
            self.same[x] = self.same[self.same[x]]
            x = self.same[x]
        return x

    def _fork(self, x: int, y: int) -> tuple[int, int]:
        """Of two strings of one length with equal hashes: the ends of the first letters that differ, both 0 if none do. Equal prefixes are joined, so a pair is walked once."""
        walked, odd = [], (0, 0)
        while (a := self._root(x)) != (b := self._root(y)):
            walked.append((a, b))
            if self.letter[x] != self.letter[y]:
                odd, walked = (x, y), []
            x, y = self.up[x], self.up[y]
        for a, b in walked:  # what lies below the last difference
            self.same[max(self._root(a), self._root(b))] = min(self._root(a), self._root(b))
        return odd

    def less(self, x: int, y: int) -> bool:
        """Whether the string of x comes before that of y."""
        if x == y:
            return False
        level = min(self.depth[x], self.depth[y])
        a, b = self.at(x, level), self.at(y, level)
        if self.hash[a] == self.hash[b]:
            p, q = self._fork(a, b)
            return self.letter[p] < self.letter[q] if p else self.depth[x] < self.depth[y]
        while self.hash[self.up[a]] != self.hash[self.up[b]]:
            far = self.hash[self.jump[a]] != self.hash[self.jump[b]]
            a, b = (self.jump[a], self.jump[b]) if far else (self.up[a], self.up[b])
        p, q = self._fork(self.up[a], self.up[b])
        return self.letter[p] < self.letter[q] if p else self.letter[a] < self.letter[b]

    def text(self, node: int) -> bytes:
        out = bytearray()
        while node:
            out.append(self.letter[node])
            node = self.up[node]
        return bytes(self.done) + bytes(out[::-1])

    def shrink(self, live: list[int]) -> list[int]:
        """Once there are many nodes: write out what all live strings share and forget what none needs. The nodes' new names."""
        if len(self.up) < self._due:
            return live
        level = min(self.depth[x] for x in live)
        tops = {self.at(x, level) for x in live}
        while len(tops) > 1:
            tops = {self.up[x] for x in tops}
        top = tops.pop()
        paths = []
        for x in live:
            path = []
            while x != top:
                path.append(x)
                x = self.up[x]
            paths.append(path[::-1])
        self.done = bytearray(self.text(top))
        letters, names = self.letter, {top: 0}
        self._clear()
        for path in paths:
            at = 0
            for x in path:
                if x not in names:
                    names[x] = self.push(at, letters[x])
                at = names[x]
        self._due = max(self.MOST, 2 * len(self.up))
        return [names[path[-1]] if path else 0 for path in paths]


class _Audit:
    """One conversation's rows, one after the other."""

    def __init__(self):
        self.trie = Trie()
        # state: (cost, edits, SHA-256 so far)
        self.states: dict[int, tuple] = {_NONE: (0, 0, hashlib.sha256())}
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.turn = self.last = None
        self.turns = 0

    def _take(self, into: dict[int, tuple], state: int, cost: int, node: int, letter: int, digest, role: bytes | None, text, first: bool) -> None:
        """The better of what `into` has for a state and one more edit."""
        held = into.get(state)
        if held is not None and held[0] < cost:
            return
        node = self.trie.push(node, letter)
        if held is not None and held[0] == cost and not self.trie.less(node, held[1]):
            return
        into[state] = (cost, node, (digest, role, text, first) if role is not None else digest)

    @staticmethod
    def _settle(states: dict[int, tuple]) -> None:
        """Digests of the edits that stay."""
        for s, (cost, node, digest) in states.items():
            if isinstance(digest, tuple):
                before, role, text, first = digest
                after = before.copy()
                after.update((b"" if first else b"\n") + role + b":")
                after.update(text)
                states[s] = (cost, node, after)

    def _insert(self, states: dict[int, tuple]) -> None:
        for kinds in ((_NONE, _SYSTEM, _ASSISTANT), (_USER,)):
            for s in kinds:
                if s in states:
                    cost, node, digest = states[s]
                    self._take(states, _NEXT[s], cost + COST["insert"], node, INSERT, digest, _ROLE[_NEXT[s]], b"", s == _NONE)
            self._settle(states)

    def row(self, turn: int | None, role: str, initial: str, text: memoryview, fault: int) -> None:
        self.rows += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn
            self.turn = turn
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        self._insert(self.states)
        own = role.encode()
        extra = COST["truncated"] * (fault == 3)
        new: dict[int, tuple] = {}
        for s, (cost, node, digest) in self.states.items():
            self._take(new, s, cost + COST["delete"], node, DELETE, digest, None, b"", False)
            if fault in (1, 2):
                continue
            to = _AFTER.get((s, initial))
            if to is not None:
                self._take(new, to, cost + extra, node, KEEP, digest, own, text, s == _NONE)
            if to != _NEXT[s]:
                self._take(new, _NEXT[s], cost + COST["rerole"] + extra, node, REROLE, digest, _ROLE[_NEXT[s]], text, s == _NONE)
        # all that these could still become, an assistant's state becomes at less cost
        if _ASSISTANT in new:
            cost, node, _ = new[_ASSISTANT]
            if _SYSTEM in new and ((cost, new[_SYSTEM][0]) == (cost, cost) and self.trie.less(node, new[_SYSTEM][1]) or cost < new[_SYSTEM][0]):
                del new[_SYSTEM]
            if _NONE in new and new[_NONE][0] > cost + COST["delete"]:
                del new[_NONE]
        self._settle(new)
        names = self.trie.shrink([node for _, node, _ in new.values()])
        self.states = {s: (cost, name, digest) for (s, (cost, _, digest)), name in zip(new.items(), names, strict=True)}

    def result(self) -> tuple:
        self._insert(self.states)
        cost, node, digest = self.states.get(_NONE, (None, 0, None))
        if _ASSISTANT in self.states:
            c, n, d = self.states[_ASSISTANT]
            if digest is None or c < cost or c == cost and self.trie.less(n, node):
                cost, node, digest = c, n, d
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, self.trie.text(node).decode(), digest.hexdigest()


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _audits(id_type: pa.DataType):
    """Rows sorted by conversation and place, of columns conv_id, turn, role, initial, text, fault (null: no row, only the conversation's name)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, audit, out = None, None, []

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = (id_type, *(pa.int64() for _ in _RESULT), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", *_RESULT, "audit", "repaired_sha256"])

        size = 0
        for batch in batches:
            ids, turns, roles, initials, _, faults = (batch.column(k).to_pylist() if k != 4 else None for k in range(6))
            for i in range(batch.num_rows):
                if audit is None or ids[i] != name:
                    if audit is not None:
                        out.append((name, *audit.result()))
                        size += len(out[-1][-2])
                        if len(out) >= 5000 or size > _BATCH_BYTES:
                            size = 0
                            yield made()
                    name, audit = ids[i], _Audit()
                if faults[i] is not None:
                    audit.row(turns[i], roles[i], initials[i], memoryview(batch.column(4)[i].as_buffer()), faults[i])
        if audit is not None:
            out.append((name, *audit.result()))
        if out:
            yield made()

    return scan


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of a table of conv_id, turn, role, text after the damage that is dealt by crc32 of `conv_id:turn` modulo 20: 0 drops a row (there = false: only its conversation's name stays), 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))), F.lit(20)).alias("_kind"))
    kind = F.col("_kind")
    d = d.withColumn("_copies", F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    changed = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return d.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), changed.alias("text"), (kind != 0).alias("there"), F.explode("_copies").alias("copy")).drop("copy")


def _faulty(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, initial, text, fault: 0 none, 1 blank, 2 duplicate, 3 truncated, null where the row is not there; nth: number among equal rows."""
    ink = F.rtrim(F.col("text"), F.lit(_BLANK))
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "text", "there").orderBy(F.col("turn").asc_nulls_first()))
    fault: Column = F.when(~F.col("there"), None).when(ink == "", 1).when(F.col("nth") > 1, 2).when(F.right(ink, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), *([F.col("there")] if "there" in rows.columns else [F.lit(True).alias("there")]))
    return rows.withColumn("nth", nth).select("conv_id", "turn", "role", F.substring("role", 1, 1).alias("initial"), F.when(F.col("there"), F.col("text")).otherwise("").alias("text"), fault.alias("fault"), "nth")


def _placed(spark: SparkSession, rows: DataFrame, *before: str) -> DataFrame:
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *before, F.col("turn").asc_nulls_first(), "role", "text", "nth")


def audit(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """conv_id, faults, cost, cheapest edits (a letter each, in order) and SHA-256 of the repaired turns of each conversation in rows of conv_id, turn, role, text; where there is a column `there`, rows without it only name their conversation."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    out = f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in _RESULT) + ", audit string, repaired_sha256 string"
    placed = _placed(spark, _faulty(rows)).select("conv_id", "turn", "role", "initial", F.col("text").cast("binary").alias("text"), "fault")
    with settings(spark, spark__sql__execution__arrow__maxBytesPerBatch=_BATCH_BYTES):
        return Scratch(spark, "audit").result(placed.mapInArrow(_audits(to_arrow_type(kind)), out))


def _repairs(id_type: pa.DataType):
    """Rows of each conversation, its audit (lead 0) first: the turns that stay or come in."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, at, place, last = "", 0, 0, None
        for batch in batches:
            out: list[tuple] = []
            for name, lead, turn, role, text, fault, audit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not lead:
                    edits, at, place, last = audit, 0, 0, None
                elif fault is None:
                    continue
                rows = []
                while at < len(edits) and edits[at] == "I":  # also those at the end, since the last row stops behind them
                    rows.append((None, "", "I"))
                    at += 1
                if lead:
                    if edits[at] != "D":
                        rows.append((turn, text, edits[at]))
                    at += 1
                    while at < len(edits) and edits[at] == "I":
                        rows.append((None, "", "I"))
                        at += 1
                for t, x, edit in rows:
                    role_now = role if edit == "K" else "assistant" if last == "user" else "user"
                    out.append((name, place, t, role_now, x, edit))
                    # a kept role need not be spelt in full
                    last = "user" if role_now[:1] == "u" else None
                    place += 1
            if out:
                types = (id_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["conv_id", "place", "turn", "role", "text", "edit"])

    return scan


def repaired(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place (from 0), turn (null where inserted), role, text, edit (K, R or I). rows must be a deterministic frame."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    none = lambda t: F.lit(None).cast(t)
    lead = audit(spark, rows).select("conv_id", F.lit(0).alias("lead"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("int").alias("fault"), "audit", none("int").alias("nth"))
    body = _faulty(rows).select("conv_id", F.lit(1).alias("lead"), "turn", "role", "text", "fault", none("string").alias("audit"), "nth")
    both = _placed(spark, lead.unionByName(body), "lead").select("conv_id", "lead", "turn", "role", "text", "fault", "audit")
    out = f"conv_id {kind.simpleString()}, place long, turn long, role string, text string, edit string"
    with settings(spark, spark__sql__execution__arrow__maxBytesPerBatch=_BATCH_BYTES):
        return Scratch(spark, "repaired").result(both.mapInArrow(_repairs(to_arrow_type(kind)), out))
