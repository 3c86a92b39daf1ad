"""Conversation structure repair: dynamic programming over rows in secondary-sorted streams.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Rows may
be kept (cost 0), given the role user or assistant (2) or deleted (3, forced for blank and
duplicate rows), and empty user or assistant rows may be inserted anywhere (2); a truncated
row that stays costs 1. Of the cheapest edits, those with the ASCII-least initials are taken.

Conversations are dealt by id and sorted by turn in Spark, from the last row to the first. A
task streams over the Arrow batches and carries, for the conversation at hand, what each of the
four places in the pattern (start, after system, after user, after assistant) still costs to the
end. Costs relative to the least of them take few values, so a step is a look-up in a table that
fills as it is used. A row leaves one byte, the best edit at each place (its backpointers). At the
conversation's first row they are followed forward, which yields the ASCII-least audit, since an
edit's initial fixes the next place. Rows are held for that up to ``hold_rows`` rows and
``hold_bytes`` of text. A longer conversation holds no texts: its backpointers are spilled, as
rows of a table in the shared folder, one for ``hold_rows`` rows, and a second stream, now in
turn order, follows them chunk by chunk over the conversation's rows. So a task holds a bounded
number of rows of any conversation, besides the audit string that is asked for.

The batches are streamed by ``mapInArrow`` rather than ``mapInPandas``: pandas would turn ids with
nulls into floats.

Defined results: a null role or text, and a null in the damage key, counts as one space; rows
without an id are one conversation; rows of one turn are taken in the order of role and text, a
missing turn comes first; a role's initial is its first character, an empty role has none and can
only be changed or deleted; an empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import SPACES, release, stored

#: Places in the pattern, and the one that a user or assistant row leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
#: What is missing at the end of the rows: nothing, user and assistant, assistant, nothing.
AT_END = (0, 4, 2, 0)
#: Edits by their initials, in ASCII order.
EDITS = "DIKR"
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
HOLD_ROWS = 65_536
HOLD_BYTES = 8 << 20
#: Relative costs met so far that a task remembers; they are few, and forgotten beyond this.
_KNOWN = 1 << 16

RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def damage(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) after the damage that the CRC of id and turn asks for.

    A dropped row stays as a mark (``gone``), so that its conversation is known.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col("turn")
    key = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    hit = rows.select(
        conv.alias("conv_id"),
        turn.cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind != 0, text).otherwise("").alias("text"),
        (kind == 0).alias("gone"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return hit.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("_", "copies")


def _faults(rows: DataFrame) -> DataFrame:
    """Rows with their place in the conversation and their first fault (b, d, t or none), last rows first.

    All windows are clustered by the conversation, so they share its one exchange, and the
    order of the last one is the order of the stream.
    """
    order = Window.partitionBy("conv_id").orderBy("gone", F.col("turn").asc_nulls_first(), "role", "text")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("pos")
    last_first = Window.partitionBy("conv_id").orderBy(F.col("pos").desc())
    trimmed = F.rtrim("text", F.lit(SPACES))
    placed = rows.withColumn("pos", F.row_number().over(order).cast("bigint") - 1)
    seen = placed.withColumn("seen", F.row_number().over(same) > 1)
    fault = (
        F.when(trimmed == "", "b").when(F.col("seen"), "d").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")
    )
    initial = F.when(~F.col("gone"), F.left("role", F.lit(1)))
    return seen.select(
        "conv_id", "pos", "gone", "turn", "role", "text", fault.alias("fault"), F.lag(initial).over(last_first).alias("later")
    )


# -- one conversation ----------------------------------------------------------------


def step(after: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int]:
    """Costs to the end at each place before a row, from those after it; and its backpointers.

    Backpointers: for each place two bits, the number of the edit in ``EDITS``.
    """
    worst = TRUNCATED if fault == "t" else 0
    ways = []
    for place in range(4):
        cost = {0: DELETE + after[place]}
        if fault not in ("b", "d"):
            kept = ASSISTANT if place == USER else USER
            if (initial == "a") == (place == USER) and initial in ("u", "a"):
                cost[2] = worst + after[kept]
            elif initial == "s" and place == START:
                cost[2] = worst + after[SYSTEM]
            cost[3] = REROLE + worst + after[NEXT[place]]
        ways.append(cost)
    best = [min(w.values()) for w in ways]
    for _ in range(3):  # no more than three inserts in a row can help
        best = [min(best[p], INSERT + best[NEXT[p]]) for p in range(4)]
    back = 0
    for place, cost in enumerate(ways):
        cost[1] = INSERT + best[NEXT[place]]
        back |= min(k for k, c in cost.items() if c == best[place]) << (2 * place)
    return tuple(best), back


class Steps:
    """``step`` by look-up: costs relative to the least repeat over and over."""

    def __init__(self) -> None:
        self.known: dict = {}

    def __call__(self, after: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int, int]:
        """(relative costs, what to add to them, backpointers)"""
        key = (after, initial if initial in ("s", "u", "a") else "", fault)
        found = self.known.get(key)
        if found is None:
            costs, back = step(*key)
            least = min(costs)
            if len(self.known) >= _KNOWN:
                self.known.clear()
            found = self.known[key] = (tuple(c - least for c in costs), least, back)
        return found


@dataclass
class Trace:
    """Follows backpointers from the first row on: audit, and hash of the repaired rows."""

    place: int = START
    audit: bytearray = field(default_factory=bytearray)
    digest: object = field(default_factory=hashlib.sha256)
    lines: int = 0

    def _add(self, role: str, text: str) -> None:
        self.digest.update((f"{role}:{text}" if self.lines == 0 else f"\n{role}:{text}").encode())
        self.lines += 1

    def _other(self) -> str:
        role = "assistant" if self.place == USER else "user"
        self.place = NEXT[self.place]
        return role

    def row(self, back: int, role: str, text: str) -> None:
        while True:
            edit = EDITS[back >> (2 * self.place) & 3]
            self.audit.append(ord(edit))
            if edit == "I":
                self._add(self._other(), "")
                continue
            if edit == "K":
                self.place = SYSTEM if self.place == START and role[:1] == "s" else NEXT[self.place]
                self._add(role, text)
            elif edit == "R":
                self._add(self._other(), text)
            return

    def end(self) -> tuple[str, str]:
        while AT_END[self.place]:
            self.audit.append(ord("I"))
            self._add(self._other(), "")
        return self.audit.decode(), self.digest.hexdigest()


class Conversation:
    """The state that one conversation carries from row to row, last row first."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.costs, self.base = AT_END, 0
        self.faults = {"b": 0, "d": 0, "t": 0, "": 0}
        self.top = self.low = self.turn = None
        self.turns = self.illegal = self.rows = 0
        self.back = bytearray()
        self.held: list[tuple[str, str]] | None = []
        self.size = 0

    def feed(self, steps: Steps, turn: int | None, role: str, text: str, fault: str, later: str | None) -> None:
        initial = role[:1]
        self.costs, added, back = steps(self.costs, initial, fault)
        self.base += added
        self.back.append(back)
        self.faults[fault] += 1
        if later is not None and initial + later not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and (self.low is None or turn != self.low):
            self.turns += 1
            self.low = turn
            self.top = turn if self.top is None else self.top
        self.rows += 1
        if self.held is not None:
            self.held.append((role, text))
            self.size += len(text) + 16

    def counts(self) -> tuple:
        """gaps, the three faults, illegal neighbours, cost."""
        gaps = 0 if self.top is None else self.top - self.low + 1 - self.turns
        f = self.faults
        return gaps, f["b"], f["d"], f["t"], self.illegal, self.base + self.costs[START] if self.rows else 0

    def finish(self) -> tuple[str, str]:
        trace = Trace()
        for back, (role, text) in zip(reversed(self.back), reversed(self.held), strict=True):
            trace.row(back, role, text)
        return trace.end()


# -- streams ---------------------------------------------------------------------------


def _values(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _backward(conv_type: pa.DataType, hold_rows: int, hold_bytes: int):
    """Rows, last first, to one finished row for a conversation, or to spilled backpointers and its counts."""
    names = ["conv_id", "first", "back", *[f.split()[0] for f in RESULT.split(", ")]]
    kinds = [conv_type, pa.int64(), pa.binary(), *[pa.int64()] * 6, pa.string(), pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, now, done, size = Steps(), None, [], 0

        def spill(first: int) -> None:
            done.append((now.conv, first, bytes(reversed(now.back)), *[None] * 8))
            now.back.clear()

        def close() -> int:
            if now.held is None:
                if now.back:
                    spill(0)
                done.append((now.conv, None, None, *now.counts(), None, None))
                return 0
            audit, digest = now.finish()
            done.append((now.conv, None, None, *now.counts(), audit, digest))
            return len(audit)

        for batch in batches:
            for conv, gone, pos, *row in _values(batch, "conv_id", "gone", "pos", "turn", "role", "text", "fault", "later"):
                if now is None or conv != now.conv:
                    if now is not None:
                        size += close() + 128
                    now = Conversation(conv)
                if not gone:
                    now.feed(steps, *row)
                    if len(now.back) >= hold_rows or now.size >= hold_bytes:
                        now.held, now.size = None, 0
                    if len(now.back) >= hold_rows:
                        spill(pos)
                        size += hold_rows
                if size >= 1 << 20:
                    yield out(done)
                    done, size = [], 0
        if now is not None:
            close()
            yield out(done)
        release()

    return run, "first bigint, back binary, " + RESULT


def _forward(conv_type: pa.DataType):
    """Rows of giant conversations in order, each chunk led by its backpointers, to audit and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trace, back, at = None, None, b"", 0

        def out() -> pa.RecordBatch:
            arrays = [pa.array([now[0]], conv_type), *[pa.array([x], pa.string()) for x in trace.end()]]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            for conv, pos, role, text, chunk in _values(batch, "conv_id", "pos", "role", "text", "back"):
                if now is None or now[0] != conv:
                    if now is not None:
                        yield out()
                    now, trace = (conv,), Trace()
                if chunk is not None:
                    back, at = chunk, pos
                else:
                    trace.row(back[pos - at], role, text)
        if now is not None:
            yield out()
        release()

    return run


def repair_conversations(rows: DataFrame, hold_rows: int = HOLD_ROWS, hold_bytes: int = HOLD_BYTES) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, gone): counts, cost, audit, hash.

    ``gone`` marks rows that only tell that their conversation exists.
    """
    if hold_rows < 1 or hold_bytes < 1:
        raise ValueError("hold_rows, hold_bytes: at least 1")
    conv = rows.schema["conv_id"].dataType
    conv_type = pa.int64() if conv.typeName() == "long" else pa.string()
    if conv.typeName() not in ("long", "string"):
        raise ValueError("conv_id: long or string")
    name = conv.simpleString()
    placed = _faults(rows)
    run, schema = _backward(conv_type, hold_rows, hold_bytes)
    last_first = placed.sortWithinPartitions("conv_id", F.col("pos").desc())
    found = stored(last_first.mapInArrow(run, f"conv_id {name}, {schema}"), "repairs")
    result = [f.split()[0] for f in RESULT.split(", ")]
    finished = found.where("back IS NULL").select("conv_id", *result)
    if found.where("back IS NOT NULL").isEmpty():
        return finished
    chunks = found.where("back IS NOT NULL").select("conv_id", F.col("first").alias("pos"), "back")
    giant = finished.where("audit IS NULL")
    # Null ids are one conversation too, so ids are compared null-safe.
    big = giant.select(F.col("conv_id").alias("_giant"))
    texts = placed.where("NOT gone").join(big, F.col("conv_id").eqNullSafe(F.col("_giant")), "left_semi")
    both = texts.select("conv_id", "pos", "role", "text", F.lit(None).cast("binary").alias("back")).unionByName(
        chunks.select("conv_id", "pos", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "back")
    )
    in_order = both.repartition("conv_id").sortWithinPartitions("conv_id", "pos", F.col("back").isNull())
    traced = in_order.mapInArrow(_forward(conv_type), f"conv_id {name}, audit string, repaired_sha256 string")
    traced = traced.withColumnRenamed("conv_id", "_conv")
    whole = giant.drop("audit", "repaired_sha256").join(traced, F.col("conv_id").eqNullSafe(F.col("_conv")))
    return finished.where("audit IS NOT NULL").unionByName(whole.select("conv_id", *result))
