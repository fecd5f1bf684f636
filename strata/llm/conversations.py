"""Operator 12: conversation structure repair by secondary-sorted streaming.

A conversation is well formed when the first letters of its roles give ``(s?(ua)+)?``: an optional system turn, then
user and assistant in turns, or nothing. :func:`audit` finds for each conversation the cheapest edits that make it so:
K keeps a row (0), R gives it the role user or assistant (2), D deletes it (3, and the only choice for a blank or
repeated row), I inserts an empty row of role user or assistant (2); a truncated row that is not deleted costs 1 more.
Among edits of one cost the ASCII-least string of letters counts.

Rows are repartitioned by conversation and sorted by turn, and each partition passes through one ``mapInArrow`` as a
stream. The programme's state after a row is, for each of the grammar's four states (nothing yet, after the system
turn, after a user, after an assistant), the least cost so far over the least of them, and the rank of its letters
among the others'. Letters of different states differ within their common length (they end with a letter of the same
row), so ranks order all continuations, and costs that cannot win any more are dropped. Few such states exist; each
(state, kind of row) pair is worked out once and then looked up. A row's backpointer is the number of its pair: two
bytes, written to an unnamed temporary file of the worker beyond ``HELD_ROWS`` rows. The digest of the repaired
text is carried per state as well, so no text is held back. What a task holds does not grow with a conversation but
for its backpointers on disk and the letters of the answer.

Whether a row repeats an earlier one is a window over the same partitions (conversation, role, text), sorted by Spark,
which spills; there is one shuffle. A conversation is one stream by nature, as its digest is: a conversation with a
third of all rows takes one task, of bounded memory.

Defined results: null roles and texts count as one space; null turns come first and are left out of gaps; rows of one
turn go by role, then text, then repetition; a null conversation id is a conversation; empty texts are blank rows; a
row whose ``present`` column is false only names its conversation; an empty table gives an empty result. Other
columns play no part.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh

#: Backpointers of a conversation held in memory; those of longer ones go to a temporary file.
HELD_ROWS = 1 << 20
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: First faults of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_KEPT = {("s", _START): _SYSTEM, ("u", _START): _USER, ("u", _SYSTEM): _USER, ("u", _ASSISTANT): _USER, ("a", _USER): _ASSISTANT}
_LEGAL = {"su", "ua", "au"}

_RESULT = ("rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string, repaired_rows long")


# ---- the programme ---------------------------------------------------------------------------------
def _inserted(states):
    """Each state's cheapest way there by inserting rows after the last one: {state: (cost, rank, letters, from)}."""
    best = {q: (cost, rank, "", q) for q, (cost, rank) in states.items()}
    for q, (cost, rank) in states.items():
        to, letters = q, ""
        for _ in range(2):
            to, letters, cost = _NEXT[to], letters + "I", cost + INSERT
            if to not in best or (cost, rank, letters) < best[to][:3]:
                best[to] = (cost, rank, letters, q)
    return best


class Repair:
    """Transitions between programme states, worked out when first met."""

    def __init__(self):
        self.numbers: dict = {}
        self.moves: list = []  # (next states, added to the base cost, {state: (from, letters)})

    def move(self, states: tuple, initial: str, fault: int) -> int:
        """``states``: ((state, cost, rank), ...); the number of the transition for a row."""
        key = (states, initial if initial in "sua" else "", fault)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.moves)
            self.moves.append(self._work_out(*key))
        return number

    @staticmethod
    def _work_out(states, initial, fault):
        before = _inserted({q: (cost, rank) for q, cost, rank in states})
        best: dict = {}

        def offer(to, cost, rank, letters, come):
            if to not in best or (cost, rank, letters) < best[to][:3]:
                best[to] = (cost, rank, letters, come)

        for q, (cost, rank, letters, come) in before.items():
            offer(q, cost + DELETE, rank, letters + "D", come)
            if fault in (BLANK, DUPLICATE):
                continue
            more = CUT if fault == TRUNCATED else 0
            to = _KEPT.get((initial, q))
            if to is not None:
                offer(to, cost + KEEP + more, rank, letters + "K", come)
            offer(_NEXT[q], cost + REROLE + more, rank, letters + "R", come)
        after = _inserted({q: (x[0], x[1]) for q, x in best.items()})
        for q, bound in ((_START, after[_ASSISTANT][0] + DELETE), (_SYSTEM, after[_ASSISTANT][0])):
            if q in best and best[q][0] > bound:  # the assistant's state does what this one can for less
                del best[q]
        for q in (_USER, _ASSISTANT):
            if q in best and after[q][0] < best[q][0]:
                del best[q]
        least = min(x[0] for x in best.values())
        order = sorted(best, key=lambda q: (best[q][1], best[q][2]))
        states = tuple((q, best[q][0] - least, order.index(q)) for q in sorted(best))
        return states, least, {q: (x[3], x[2]) for q, x in best.items()}

    @staticmethod
    def end(states: tuple) -> tuple:
        """(cost over the base, letters inserted at the end, state before them) of the cheapest whole edit."""
        last = _inserted({q: (cost, rank) for q, cost, rank in states})
        cost, rank, letters, come = min(last[q] for q in (_START, _ASSISTANT) if q in last)
        return cost, letters, come


FIRST = ((_START, 0, 0),)


class Backpointers:
    """Two bytes a row, in memory up to a bound, then in blocks of a temporary file; read from the last to the first."""

    def __init__(self, held: int):
        self.held, self.now, self.file, self.blocks = held, array("H"), None, 0

    def add(self, number: int) -> None:
        if len(self.now) >= self.held:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.now.tobytes())
            self.blocks, self.now = self.blocks + 1, array("H")
        self.now.append(number)

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.now)
        for block in reversed(range(self.blocks)):
            self.file.seek(block * self.held * 2)
            yield from reversed(array("H", self.file.read(self.held * 2)))
        if self.file:
            self.file.close()


def _put(digest, rows: int, text: str) -> int:
    digest.update((("\n" if rows else "") + text).encode("utf-8", "surrogatepass"))
    return rows + 1


class Conversation:
    """One conversation as its rows pass by."""

    def __init__(self, repair: Repair, held: int):
        self.repair, self.states, self.cost = repair, FIRST, 0
        self.back = Backpointers(held)
        self.texts = {_START: (hashlib.sha256(), 0)}  # digest and rows of each state's repaired text
        self.rows = self.illegal = self.turns = 0
        self.faults = [0, 0, 0, 0]
        self.last = self.least = self.most = self.turn = None

    def row(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.rows and self.last + initial not in _LEGAL:
            self.illegal += 1
        self.rows, self.last = self.rows + 1, initial
        self.faults[fault] += 1
        if turn is not None:
            self.turns += turn != self.turn
            self.turn = self.most = turn
            self.least = turn if self.least is None else self.least
        number = self.repair.move(self.states, initial, fault)
        self.states, more, ways = self.repair.moves[number]
        self.cost += more
        self.back.add(number)
        self.texts = {q: self._text(come, letters, q, role, text) for q, (come, letters) in ways.items()}

    def _text(self, come: int, letters: str, to: int, role: str, text: str):
        digest, rows = self.texts[come]
        if letters == "D":
            return digest, rows  # shared until a row is added to a copy
        digest = digest.copy()
        for letter in letters:
            come = to if letter == "K" else come if letter == "D" else _NEXT[come]
            if letter != "D":
                rows = _put(digest, rows, (role if letter == "K" else _ROLE[come]) + ":" + ("" if letter == "I" else text))
        return digest, rows

    def result(self) -> tuple:
        cost, letters, state = self.repair.end(self.states)
        digest, rows = self.texts[state]
        digest, at = digest.copy(), state
        for _ in letters:
            at = _NEXT[at]
            rows = _put(digest, rows, _ROLE[at] + ":")
        pieces = [letters]
        for number in self.back.backwards():
            state, letters = self.repair.moves[number][2][state]
            pieces.append(letters)
        gaps = self.most - self.least + 1 - self.turns if self.most is not None else 0
        return (self.rows, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal,
                self.cost + cost, "".join(reversed(pieces)), digest.hexdigest(), rows)


# ---- rows in, conversations out ----------------------------------------------------------------------
_BODY = r"[^ \t-\r]"


def _sorted_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """conv, turn, role, text, fault, present; a conversation's rows in one partition, in order."""
    plain = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                        (F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)).alias("present"))
    dealt = plain.withColumn("key", F.expr("xxhash64(role, text)")).repartition("conv")
    # The window's partitions lie inside the conversations', so it needs no shuffle of its own.
    earlier = Window.partitionBy("conv", "present", "key", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    again = dealt.withColumn("again", F.row_number().over(earlier) > 1)
    fault = (f"case when not (text rlike r'{_BODY}') then {BLANK} when again then {DUPLICATE} "
             rf"when not (text rlike r'[.!?][ \t-\r]*\z') then {TRUNCATED} else {SOUND} end")
    return again.selectExpr("conv", "turn", "role", "text", f"cast({fault} as tinyint) as fault", "present").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "again")


def audit(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
          present_col: str | None = None, held_rows: int = HELD_ROWS) -> DataFrame:
    """One row per conversation: ``conv_col``, rows, gaps (turn numbers missing between the least and the greatest),
    blank, duplicate, truncated (rows by first fault), illegal (neighbours that may not meet), cost, audit (the
    edits' letters), repaired_sha256 (of the repaired ``role:text`` lines), repaired_rows."""
    ordered = _sorted_rows(rows, conv_col, turn_col, role_col, text_col, present_col)
    kind = rows.schema[conv_col].dataType
    names = [c.split()[0] for c in _RESULT.split(", ")]

    def run(batches):
        repair, conversation, current, began = Repair(), None, None, False
        done: list = []

        def flush():
            columns = list(zip(*[(c, *r) for c, r in done]))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], conv_type), *[
                pa.array(v, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n, v in zip(names, columns[1:])]], ["conv", *names])

        held = 0
        for batch in batches:
            conv_type = batch.schema.field("conv").type
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "fault", "present")]
            for conv, turn, role, text, fault, present in zip(*columns):
                if not began or conv != current:
                    if began:
                        done.append((current, conversation.result()))
                        held += len(done[-1][1][7])
                        if len(done) >= 5000 or held > 8 << 20:
                            yield flush()
                            held = 0
                    conversation, current, began = Conversation(repair, held_rows), conv, True
                if present:
                    conversation.row(turn, role, text, fault)
        if began:
            done.append((current, conversation.result()))
            yield flush()

    return ordered.mapInArrow(run, f"conv {kind.simpleString()}, {_RESULT}").withColumnRenamed("conv", conv_col)


def repaired(rows: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", present_col: str | None = None) -> DataFrame:
    """The repaired conversations by the edits of :func:`audit`: ``conv_col``, position (from 1), ``role_col``,
    ``text_col``, edit (K, R or I). Each conversation's edits lead its rows through the same stream."""
    ordered = _sorted_rows(rows, conv_col, turn_col, role_col, text_col, present_col).where("present")
    kind = rows.schema[conv_col].dataType
    led = ordered.selectExpr("conv", "false as leads", "turn", "role", "text", "cast(null as string) as audit").unionByName(
        audits.select(F.col(conv_col).alias("conv"), F.lit(True).alias("leads"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                      F.lit("").alias("text"), "audit"))
    led = led.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), F.desc("leads"), F.col("turn").asc_nulls_first(), "role", "text")

    def run(batches):
        edits, at, state, position = "", 0, _START, 0
        conv = None
        for batch in batches:
            out: list = []

            def put(letter, role, text):
                nonlocal position
                position += 1
                out.append((conv, position, role, text, letter))

            def inserts():
                nonlocal at, state
                while at < len(edits) and edits[at] == "I":
                    at, state = at + 1, _NEXT[state]
                    put("I", _ROLE[state], "")

            for conv, leads, role, text, letters in zip(*[batch.column(c).to_pylist() for c in ("conv", "leads", "role", "text", "audit")]):
                if leads:
                    edits, at, state, position = letters, 0, _START, 0
                    inserts()
                    continue
                letter, at = edits[at], at + 1
                if letter == "K":
                    state = _KEPT[(role[:1], state)]
                    put("K", role, text)
                elif letter == "R":
                    state = _NEXT[state]
                    put("R", _ROLE[state], text)
                inserts()
            if out:
                types = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], ["conv", "position", "role", "text", "edit"])

    (edit,) = fresh(rows.select(conv_col, role_col, text_col), "edit")
    return led.mapInArrow(run, f"conv {kind.simpleString()}, position long, role string, text string, edit string").toDF(
        conv_col, "position", role_col, text_col, edit)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: the rows of ``conversations`` with faults put in by
    crc32(``conv_id:turn``) % 20 (nulls: one space): 0 drops a row (present is false), 1 empties its text, 2 removes its
    ``[.!?]``, 3 repeats it, 4 gives it the role user."""
    marked = conversations.selectExpr(
        "conv_id", "turn", "coalesce(role, ' ') as role", "coalesce(text, ' ') as text",
        "crc32(cast(concat(coalesce(cast(conv_id as string), ' '), ':', coalesce(cast(turn as string), ' ')) as binary)) % 20 as fault")
    return marked.selectExpr(
        "conv_id", "turn", "if(fault = 4, 'user', role) as role",
        "case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '') else text end as text", "fault <> 0 as present",
        "explode(sequence(1, if(fault = 3, 2, 1))) as copy").drop("copy")
