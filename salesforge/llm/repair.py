"""Conversation structure repair by a persistent dynamic program over edits.

A conversation should be an optional system turn and then user and assistant in turn:
role initials ``(s?(ua)+)?``.  Edits: Keep a row (0), Rerole it to user or assistant (1),
Delete it (2; blank rows and duplicates must go), Insert an empty user or assistant turn
(5); a truncated row that stays costs 5 more.  The audit is the string of initials of the
cheapest edits, the ASCII-least of equally cheap ones; which role an edit gives follows
from the edits before it.

The program holds one cheapest audit per state of the pattern (nothing yet, after system,
after user, after assistant).  Audits share their prefixes as linked nodes; a node knows
its depth, a rolling hash of the whole string and its ancestors at powers of two.  Equal
costs are decided by a search for the longest common prefix: lift to one depth, then jump
up while the hashes differ; the prefixes found equal are walked and compared, and a
collision falls back to the plain strings.  Two audits of one state and cost that consume
the same rows are never a prefix of one another, so the smaller prefix stays the smaller
audit.  Every ``settle`` rows, states that can no longer win are dropped and what all
audits share is put out, so that a long conversation is held from there on only.

A row's first fault counts: blank, duplicate (role and text of an earlier row), truncated.

Scale: texts are shuffled once, by conversation, and streamed in the order of their turns
(an output hash over the whole conversation has to be made in order).  Rows that repeat an
earlier turn's role and text are found on digests before, combined on the map side and
with frequent ones joined by broadcast, and their narrow rows are sorted in beside the
records, so no set of seen texts is held and no group is collected.

Edge cases: null role or text is one space; a null ``conv_id`` is a conversation of its
own; null turns come first, rows of one turn stand in the order of role and digest; a row
with ``present`` false only announces its conversation, and one with no other rows has
zeros, an empty audit and the hash of nothing; an empty role cannot be kept; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesforge.llm.common import join_groups, slices

SPACE = " \t\n\x0b\x0c\r"
AUDITS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
TURNS = "conv_id long, place long, edit string, role string, text string"

START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # a given or inserted role
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What it costs at most to go on from the second state as one would from the first.
DETOUR = {(START, ASSISTANT): 2, (SYSTEM, ASSISTANT): 0, (USER, ASSISTANT): 5, (ASSISTANT, USER): 5, (SYSTEM, USER): 5,
          (START, USER): 7, (ASSISTANT, START): 0, (SYSTEM, START): 0, (USER, START): 5}


class Strings:
    """Strings that share prefixes: a node is a string, its parent the string without the
    last character."""

    def __init__(self, modulus: int = (1 << 61) - 1, base: int = 911_382_323):
        self.modulus, self.base = modulus, base
        self.char, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, parent: int, char: str) -> int:
        node = len(self.char)
        up = [parent]
        while len(self.up[up[-1]]) >= len(up):  # the ancestor at 2^k of the ancestor at 2^k
            up.append(self.up[up[-1]][len(up) - 1])
        self.char.append(char)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.base + ord(char)) % self.modulus)
        self.up.append(up)
        return node

    def prefix(self, node: int, depth: int) -> int:
        """The node of the first ``depth`` characters."""
        k = self.depth[node] - depth
        while k:
            node = self.up[node][k.bit_length() - 1]
            k -= 1 << k.bit_length() - 1
        return node

    def text(self, node: int, above: int = 0) -> str:
        """The characters after those of the ancestor ``above``."""
        out = []
        while node != above:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(out[::-1])

    def same(self, a: int, b: int) -> bool:
        """Whether two strings of one length are equal, up to where they share nodes."""
        while a != b:
            if self.char[a] != self.char[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        depth = min(self.depth[a], self.depth[b])
        x, y = self.prefix(a, depth), self.prefix(b, depth)
        if self.hash[x] == self.hash[y]:
            return self.depth[a] < self.depth[b] if self.same(x, y) else self.text(a) < self.text(b)
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]):
                px, py = self.up[x][k], self.up[y][k]
                if self.hash[px] != self.hash[py]:
                    x, y = px, py
        if self.char[x] != self.char[y] and self.same(self.up[x][0], self.up[y][0]):
            return self.char[x] < self.char[y]
        return self.text(a) < self.text(b)  # equal hashes of different prefixes

    def shared(self, nodes: list[int]) -> int:
        """The deepest node that all descend from."""
        depth = min(self.depth[n] for n in nodes)
        nodes = [self.prefix(n, depth) for n in nodes]
        for k in reversed(range(len(self.up[nodes[0]]))):
            if len(set(nodes)) > 1 and k < len(self.up[nodes[0]]):
                above = [self.up[n][k] for n in nodes]
                if len(set(above)) > 1:
                    nodes = above
        return nodes[0] if len(set(nodes)) == 1 else self.up[nodes[0]][0]


class Audit:
    """The cheapest audits of the rows so far, one for each state."""

    def __init__(self, **hashing):
        self.hashing = hashing
        self.strings = Strings(**hashing)
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}  # state: cost, node
        self._insert()

    def _offer(self, found: dict, state: int, cost: int, parent: int, char: str) -> None:
        held = found.get(state)
        if held is not None and held[0] < cost:
            return
        node = self.strings.add(parent, char)
        if held is None or cost < held[0] or self.strings.less(node, held[1]):
            found[state] = (cost, node)

    def _insert(self) -> None:
        """An inserted user turn, then an inserted assistant turn."""
        for made, before in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            for state in before:
                if state in self.best:
                    cost, node = self.best[state]
                    self._offer(self.best, made, cost + INSERT, node, "I")

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        found: dict[int, tuple[int, int]] = {}
        stays = TRUNCATED if truncated else 0
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + DELETE, node, "D")
            if not must_go:
                if (state, initial) in KEEPS:
                    self._offer(found, KEEPS[state, initial], cost + stays, node, "K")
                self._offer(found, NEXT[state], cost + stays + REROLE, node, "R")
        self.best = found
        self._insert()

    def settle(self) -> str:
        """What all audits that can still win begin with; they go on from there."""
        cost = {s: c for s, (c, _) in self.best.items()}
        live = {s: v for s, v in self.best.items()
                if not any((s, t) in DETOUR and cost[t] + DETOUR[s, t] < cost[s] for t in cost)}
        old, base = self.strings, self.strings.shared([n for _, n in live.values()])
        done = old.text(base)
        self.strings, made = Strings(**self.hashing), {}
        self.best = {}
        for state, (c, node) in live.items():
            at = 0
            for char in old.text(node, base):
                if (at, char) not in made:
                    made[at, char] = self.strings.add(at, char)
                at = made[at, char]
            self.best[state] = (c, at)
        return done

    def end(self) -> tuple[int, str]:
        """(cost, rest of the audit) of the best whole conversation."""
        ends = [self.best[s] for s in (START, ASSISTANT) if s in self.best]
        best = ends[0]
        for e in ends[1:]:
            if e[0] < best[0] or e[0] == best[0] and self.strings.less(e[1], best[1]):
                best = e
        return best[0], self.strings.text(best[1])


class Conversation:
    """One conversation's rows, in order."""

    def __init__(self, conv_id: int | None, settle: int):
        self.conv_id, self.every = conv_id, settle
        self.first = self.last = None
        self.turns = self.rows = 0
        self.before: tuple | None = None
        self.initial: str | None = None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.audit, self.done = Audit(), []
        self.pending: list[tuple[str, str]] = []
        self.state, self.place, self.sha = START, 0, sha256()

    def add(self, turn: int | None, role: str, text: str, key: bytes, seen: bool) -> Iterator[tuple]:
        again = seen or self.before == (turn, key)
        self.before = (turn, key)
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        solid = text.rstrip(SPACE)
        fault = "blank" if not solid else "duplicate" if again else "truncated" if solid[-1] not in ".!?" else None
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.faults["illegal"] += 1
        self.initial, self.rows = initial, self.rows + 1
        self.pending.append((role, text))
        self.audit.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
        if self.rows % self.every == 0:
            yield from self._apply(self.audit.settle())

    def _apply(self, edits: str) -> Iterator[tuple]:
        """(conv_id, place, edit, role, text) of the turns that the edits give."""
        at = 0
        for edit in edits:
            role = text = ""
            if edit != "I":
                role, text = self.pending[at]
                at += 1
            if edit == "D":
                continue
            if edit == "K":
                self.state = KEEPS[self.state, role[:1]]
            else:
                self.state = NEXT[self.state]
                role = ROLES[self.state]
            self.sha.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
            yield self.conv_id, self.place, edit, role, text
            self.place += 1
        del self.pending[:at]
        self.done.append(edits)

    def end(self) -> Iterator[tuple]:
        self.cost, rest = self.audit.end()
        yield from self._apply(rest)

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.cost, "".join(self.done), self.sha.hexdigest())


def _repaired(turns: DataFrame, want: str, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column, settle: int) -> DataFrame:
    def text(name):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    conv, role, body = F.col(f"`{conv_col}`").cast("long"), text(role_col), text(text_col)
    key = F.unhex(F.sha2(F.concat(F.coalesce(conv.cast("string"), F.lit("")), F.lit(":"), F.char_length(role), F.lit(":"), role, body), 256))
    rows = turns.select(conv.alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"), key.alias("key"),
                        body.alias("text"), F.coalesce(present, F.lit(False)).alias("present"))
    narrow = rows.where("present").select("conv_id", "turn", "role", "key")
    # Role and text at more than one turn of a conversation (the key holds all three).
    groups = narrow.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count("turn").alias("known"), F.min("turn").alias("low"), F.max("turn").alias("high"))
    groups = groups.where((F.col("low") < F.col("high")) | (F.col("known") > 0) & (F.col("known") < F.col("n")))
    later = F.when(F.col("known") < F.col("n"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("low"))
    seen = join_groups(narrow, groups, ["key"], "n").where(later).select("conv_id", "turn", "role", "key").distinct()
    both = rows.withColumn("kind", F.lit(1)).unionByName(seen.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    dealt = both.select("conv_id", "turn", "role", "key", "kind", "text", "present").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "key", "kind")
    audits = want == AUDITS
    kinds = [pa.int64(), *([pa.int64()] * 6 if audits else [pa.int64()]), *[pa.string()] * (2 if audits else 3)]
    names = [x.split()[0] for x in want.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, decided, out, held = None, None, [], 0

        def put() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

        def made(found: Iterator[tuple], whole: Conversation | None = None) -> int:
            """The characters that were put out."""
            rows = list(found)
            if audits:
                rows = [whole.result()] if whole else []
            out.extend(rows)
            return sum(200 + len(r[-1]) + len(r[-2]) for r in rows)

        for b in slices(batches, 500):
            for conv_id, turn, role, key, kind, text, there in zip(*(c.to_pylist() for c in b.columns)):
                if not kind:
                    decided = (conv_id, turn, key)
                    continue
                if own is None or own.conv_id != conv_id:
                    if own is not None:
                        held += made(own.end(), own)
                    own = Conversation(conv_id, settle)
                if there:
                    held += made(own.add(turn, role, text, key, decided == (conv_id, turn, key)))
                if held > 8 << 20:
                    yield put()
                    out, held = [], 0
        if own is not None:
            made(own.end(), own)
        yield put()

    return dealt.mapInArrow(run, want)


def audits(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present: Column | None = None, settle: int = 512) -> DataFrame:
    """One row per conversation (schema ``AUDITS``).  ``present``: rows for which it is
    not true only announce their conversation."""
    return _repaired(turns, AUDITS, conv_col, turn_col, role_col, text_col, F.lit(True) if present is None else present, settle)


def repaired(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             present: Column | None = None, settle: int = 512) -> DataFrame:
    """The turns of the repaired conversations (schema ``TURNS``) with their place from 0
    and the edit (K, R or I) that made them."""
    return _repaired(turns, TURNS, conv_col, turn_col, role_col, text_col, F.lit(True) if present is None else present, settle)


def damaged(turns: DataFrame) -> DataFrame:
    """The conversations with the faults that the id of a row decides: (conv_id, turn,
    role, text, present); ``present`` is false for a dropped row."""
    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    said = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), said.alias("text"),
                       (F.col("fault") != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy")
