"""Repair of conversation structure by survivor-coalescence Viterbi.

A conversation's rows are edited at least cost so that its roles read
``(s?(ua)+)?`` by their initials. The states are the places in that pattern. Each state
keeps one survivor: the cheapest edits that lead to it, of equally cheap ones
the least string of edit letters. Survivors share a backpointer tree whose
nodes count their references: a node nobody refers to goes, and as soon as all
survivors descend from one child of the root, that child's edit is final and is
emitted; a survivor that can no longer win is dropped. Memory therefore holds the
unresolved tail only, however long the conversation is; a tie is decided on the
whole unresolved tails. A tail stays unresolved as long as the rows themselves leave
it open: a first system row before blank rows only is kept or deleted by what comes
after them (the texts of such rows are not held).

Rows are partitioned by conversation and sorted on disk by Spark; each task
streams its conversations row by row. One conversation stays in one task,
since its edits (and a digest of the repaired text) depend on all rows before;
it is never held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5

#: Places in (s?(ua)+)?: nothing yet, after s, after u, after a.
_EMPTY, _S, _U, _A = range(4)
_ACCEPTING = (_EMPTY, _A)
#: initial -> [(from, to)].
_MOVES = {"s": [(_EMPTY, _S)], "u": [(_EMPTY, _U), (_S, _U), (_A, _U)], "a": [(_U, _A)]}
_NAMES = {"u": "user", "a": "assistant"}
_LEGAL_PAIRS = {"su", "ua", "au"}

#: White space of the contract: blank, and tab to carriage return.
_VISIBLE = r"[^\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\x0c\r"

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


class _Node:
    __slots__ = ("parent", "letter", "role", "row", "refs", "depth")

    def __init__(self, parent, letter, role, row):
        self.parent, self.letter, self.role, self.row, self.refs = parent, letter, role, row, 0
        self.depth = parent.depth + 1 if parent is not None else 0


class Viterbi:
    """Edits of one conversation. ``emit(letter, role, row)`` is called once per
    edit, in order; ``row`` is what ``add`` got, None for an insertion."""

    def __init__(self, emit: Callable[[str, str | None, object], None]):
        self.emit = emit
        self.root = _Node(None, "", None, None)
        self.tips: list[tuple[int, _Node] | None] = [None] * 4
        self._hold({_EMPTY: (0, self.root)})
        self._insertions()
        self._settle()

    # -- survivors -----------------------------------------------------
    @staticmethod
    def _release(node: _Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            node = node.parent
            node.refs -= 1

    def _hold(self, tips: dict[int, tuple[int, _Node]]) -> None:
        """Make ``tips`` the survivors of their states."""
        for state, (cost, node) in tips.items():
            if node.refs == 0 and node.parent is not None:
                node.parent.refs += 1
            node.refs += 1
            old, self.tips[state] = self.tips[state], (cost, node)
            if old is not None:
                self._release(old[1])

    @staticmethod
    def _before(x: _Node, y: _Node) -> bool:
        """Whether x's edits read less than y's, from where they part."""
        a, b = [], []
        while x is not y:
            if x.depth >= y.depth:
                a.append(x.letter)
                x = x.parent
            else:
                b.append(y.letter)
                y = y.parent
        return a[::-1] < b[::-1]

    def _better(self, new: tuple[int, _Node], old: tuple[int, _Node] | None) -> bool:
        if old is None or new[0] != old[0]:
            return old is None or new[0] < old[0]
        return self._before(new[1], old[1])

    def _insertions(self) -> None:
        changed = True
        while changed:
            changed = False
            for initial in "ua":
                for source, target in _MOVES[initial]:
                    tip, held = self.tips[source], self.tips[target]
                    if tip is None or held is not None and tip[0] + COST[INSERT] > held[0]:
                        continue
                    new = (tip[0] + COST[INSERT], _Node(tip[1], INSERT, _NAMES[initial], None))
                    if self._better(new, held):
                        self._hold({target: new})
                        changed = True

    def _settle(self) -> None:
        """Emit what all survivors share."""
        if self.root.refs != 1:
            return
        path, node = [], next(t for t in self.tips if t is not None)[1]
        while node is not self.root:
            path.append(node)
            node = node.parent
        while path and self.root.refs == 1:
            self._final(path.pop())

    def _final(self, child: _Node) -> None:
        self.emit(child.letter, child.role, child.row)
        self.root, child.parent = child, None

    # -- input -----------------------------------------------------------
    def add(self, role: str, fault: str | None, row: object) -> None:
        """The next row; ``fault`` is its first fault."""
        best: dict[int, tuple[int, _Node]] = {}

        def offer(source: int, target: int, letter: str, new_role: str | None, extra: int) -> None:
            if (tip := self.tips[source]) is not None:
                cost = tip[0] + COST[letter] + extra
                if target not in best or cost <= best[target][0]:
                    new = (cost, _Node(tip[1], letter, new_role, row))
                    if self._better(new, best.get(target)):
                        best[target] = new

        for state in range(4):
            offer(state, state, DELETE, None, 0)
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            for source, target in _MOVES.get(role[:1], ()):
                offer(source, target, KEEP, role, extra)
            for initial, name in _NAMES.items():
                for source, target in _MOVES[initial]:
                    offer(source, target, REROLE, name, extra)
        old, self.tips = self.tips, [None] * 4
        self._hold(best)
        for tip in old:
            if tip is not None:
                self._release(tip[1])
        self._insertions()
        self._drop_beaten()
        self._settle()

    def _drop_beaten(self) -> None:
        """Drop survivors that can no longer win, so that the others meet.

        What follows the empty place or an s can also follow an a, at the same
        cost but for a kept s row, deleted there for 2.
        """
        if self.tips[_A] is None:
            return
        for state, more in ((_EMPTY, COST[DELETE]), (_S, 0)):
            if (tip := self.tips[state]) is not None and tip[0] > self.tips[_A][0] + more:
                self.tips[state] = None
                self._release(tip[1])

    def close(self) -> int:
        """Emit the rest of the best edits; their cost."""
        end = None
        for state in _ACCEPTING:
            if self.tips[state] is not None and self._better(self.tips[state], end):
                end = self.tips[state]
        path, node = [], end[1]
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self.emit(node.letter, node.role, node.row)
        return end[0]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after the damage of the op11 contract: conv_id, turn, role, text.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text,
    2 removes its ``.!?``, 3 repeats it, 4 sets role user. A null counts as one
    space, in the key as in role and text; turn and conv_id stay null.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their first fault, each conversation in one task and in order.

    The shuffle by conversation also serves the window that finds repeats.
    """
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn")))
    visible = F.col("text").rlike(_VISIBLE)
    last = F.substring(F.rtrim(F.translate("text", _SPACES, " " * len(_SPACES))), -1, 1)
    fault = (F.when(~visible, BLANK).when(seen > 1, DUPLICATE)
             .when(~last.isin(".", "!", "?"), TRUNCATED))
    return (rows.repartition(F.col("conv_id")).select("conv_id", "turn", "role", "text", fault.alias("fault"))
            .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text"))


_EDITS = "conv_id {id_type}, step long, edit string, turn {turn_type}, old_role string, role string, text string, " \
         "fault string"
_EDIT_COLUMNS = ["conv_id", "step", "edit", "turn", "old_role", "role", "text", "fault"]
_OUT_ROWS, _OUT_CHARS = 5_000, 8_000_000


def _stream_edits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []
    chars = 0
    current, search, step = None, None, 0

    def emit(letter, role, row):
        nonlocal chars, step
        turn, old_role, text, fault = row if row is not None else (None, None, "", None)
        text = None if letter == DELETE else text
        out.append((current, step, letter, turn, old_role, role, text, fault))
        chars += len(text or "")
        step += 1

    def flush():
        return pd.DataFrame(out, columns=_EDIT_COLUMNS, dtype=object)

    for batch in batches:
        for conv, turn, role, text, fault in zip(*(batch[c].tolist() for c in batch.columns)):
            if search is None or conv != current:
                if search is not None:
                    search.close()
                current, step, search = conv, 0, Viterbi(emit)
            forced = fault in (BLANK, DUPLICATE)        # deleted in any case: its text need not wait
            search.add(role, fault, (turn, role, None if forced else text, fault))
            if len(out) >= _OUT_ROWS or chars > _OUT_CHARS:
                yield flush()
                out, chars = [], 0
    if search is not None:
        search.close()
    if out:
        yield flush()


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation in ``rows`` (conv_id, turn, role, text).

    One row per edit, in order of ``step`` within a conversation: edit (K, R, D
    or I), turn, old_role and fault of the row it is about (null for I), role
    and text after it (null for D). A null role or
    text counts as one space; such a text is blank, and such a role (like any
    whose first letter is not s, u or a, the empty one included) is never kept.
    Rows are taken by turn, nulls first, equal turns by role and text; repeated
    rows are duplicates. A null conv_id is a conversation of its own. Other
    columns are ignored; no rows give no edits.
    """
    given = rows.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
                                             for c in ("role", "text")))
    types = {f.name: f.dataType for f in given.schema}
    through = _ordered(given).select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
                                     .alias("conv_id"),
                                     F.col("turn").cast("string").alias("turn"), "role", "text", "fault")
    done = through.mapInPandas(_stream_edits, _EDITS.format(id_type="string", turn_type="string"))
    return done.withColumns({
        "conv_id": F.when(F.col("conv_id") != "", F.substr("conv_id", F.lit(2))).cast(types["conv_id"]),
        "turn": F.col("turn").cast(types["turn"])})


def repaired(found: DataFrame) -> DataFrame:
    """The repaired conversations from ``edits``: conv_id, position, role, text."""
    at = Window.partitionBy("conv_id").orderBy("step")
    return found.filter(F.col("edit") != DELETE).select(
        "conv_id", (F.row_number().over(at) - 1).cast("long").alias("position"), "role", "text")


_DIGEST = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


class _Digest:
    """Figures of one conversation from its edits, taken in order."""

    def __init__(self, conv):
        self.conv, self.turns, self.low, self.high, self.last_turn = conv, 0, None, None, None
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal = self.cost = 0
        self.initial, self.letters, self.sha, self.any = None, [], hashlib.sha256(), False

    def add(self, edit, turn, old_role, role, text, fault):
        self.letters.append(edit)
        self.cost += COST[edit]
        if edit != INSERT:
            if fault is not None:
                self.faults[fault] += 1
            if edit != DELETE and fault == TRUNCATED:
                self.cost += TRUNCATED_COST
            if self.initial is not None:
                self.illegal += self.initial + old_role[:1] not in _LEGAL_PAIRS
            self.initial = old_role[:1]
            if turn is not None:
                turn = int(turn)
                self.turns += turn != self.last_turn
                self.low = turn if self.low is None else self.low
                self.high = self.last_turn = turn
        if edit != DELETE:
            self.sha.update(b"\n" * self.any + f"{role}:{text}".encode("utf-8", "replace"))
            self.any = True

    def row(self):
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, min(gaps, (1 << 63) - 1), self.faults[BLANK], self.faults[DUPLICATE],
                self.faults[TRUNCATED], self.illegal, self.cost, "".join(self.letters), self.sha.hexdigest())


_DIGEST_COLUMNS = [c.split(" ")[0] for c in _DIGEST.split(", ")]


def _stream_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    current, out = None, []
    for batch in batches:
        for conv, *edit in zip(*(batch[c].tolist() for c in batch.columns)):
            if current is None or conv != current.conv:
                if current is not None:
                    out.append(current.row())
                current = _Digest(conv)
            current.add(*edit)
        if out:
            yield pd.DataFrame(out, columns=_DIGEST_COLUMNS)
            out = []
    if current is not None:
        yield pd.DataFrame([current.row()], columns=_DIGEST_COLUMNS)


def digest(found: DataFrame, all_ids: DataFrame) -> DataFrame:
    """One row per conv_id of ``all_ids`` (repeats and null included once) with the op11 figures of ``found``.

    ``found`` is what ``edits`` returned, as it returned it: the digest reads
    the edits in the order of that stream, in the same tasks. The audit is one
    letter per edit. Turns are whole numbers; a gap beyond a long counts as
    the largest long. A conversation without edits has zeros, an empty audit
    and the hash of the empty string.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    figures = found.select(key.alias("conv_id"), "edit", F.col("turn").cast("string").alias("turn"), "old_role", "role",
                           "text", "fault").mapInPandas(_stream_digests, _DIGEST).withColumnRenamed("conv_id", "_key")
    ids = all_ids.select("conv_id").distinct().withColumn("_id_key", key)
    joined = ids.join(figures, F.col("_id_key") == F.col("_key"), "left")

    def or_else(name: str, value) -> Column:
        return F.coalesce(F.col(name), F.lit(value)).alias(name)

    return joined.select("conv_id", *(or_else(c, 0).cast("long").alias(c) for c in _DIGEST_COLUMNS[1:7]),
                         or_else("audit", ""), or_else("repaired_sha256", hashlib.sha256().hexdigest()))
